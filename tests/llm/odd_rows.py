"""Rows (doc_id, text) that every operator has to take."""

ODD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "Don't 'tis x'tion '' ''s 12's <|endoftext|> <|"),
    (6, "É à ß × ÷ œ 漢字 é \x0b\x0c\x1c é"), (7, "many words here " * 9_000),
    (8, "x" * 70_000), (9, "same text in three rows, word for word"),
    (10, "same text in three rows, word for word"), (11, "same text in three rows, word for word"),
    (11, "same text in three rows, word for word"), (None, "no id but a text of some words"),
    (None, None), (12, "!!! ### $$$"), (13, "line\n\n\nline\n"), (-5, "a b c d e f g h"),
]
