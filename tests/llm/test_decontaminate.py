"""Decontamination against a plain version, on odd rows and odd items."""

import re
from collections import Counter

import pytest
from odd_rows import ODD

from millrace.llm import decontaminate

PLAIN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return PLAIN_WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, items):
    words, hit, found = plain_words(text), set(), set()
    for item, content in items:
        own = plain_words(content)
        n = min(10, len(own))
        windows = {tuple(own[k:k + n]) for k in range(len(own) - n + 1)} if own else set()
        for at in range(len(words) - n + 1):
            if tuple(words[at:at + n]) in windows:
                hit |= set(range(at, at + n))
                found.add("" if item is None else str(item))
    return len(words), hit, sorted(found)


ITEMS = [
    (1, "many words here"), (2, "A B c d"), (10, "same text in three rows, WORD for word"), (None, "漢字 é"),
    (3, None), (4, ""), (5, "?!"), (6, "Zé ÉÉ one two three four five six seven eight nine ten"), (7, "k1"),
    (7, "É à ß"), (8, "one two three four five six seven eight nine ten eleven"), (None, "K1"),
    (9, "three four five six seven eight nine ten eleven twelve"),
]
TEXTS = ODD + [
    (20, "- zé ÉÉ One two; three four five six seven eight NINE ten eleven, zé"),
    (21, "zé éé one two three four five six seven eight nine tenth"),
    (22, "x k1 " + "one two three four five six seven eight nine ten " * 3), (23, "ﬀ K1.\x00k1\x7fK1"),
]


@pytest.fixture
def texts(spark):
    rows = [(i, t, f"w{n}", n, True, 7) for n, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, words string, n_hit int, "
                                       "contaminated boolean, hash int").repartition(3)


@pytest.fixture
def items(spark):
    rows = [(i, t, "x", 1) for i, t in ITEMS]
    return spark.createDataFrame(rows, "item_id long, text string, phrase string, length int")


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_against_a_plain_version(texts, items, limit):
    out = decontaminate.contamination(texts, items, broadcast_bytes=limit)
    got = Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"],
                   sum(s["end"] - s["start"] for s in r["spans"]), r["words"]) for r in out.collect())
    want = Counter()
    for n, (doc, text) in enumerate(TEXTS):
        words, hit, found = plain(text, ITEMS)
        want[doc, words, len(hit), tuple(found), bool(hit), len(hit), f"w{n}"] += 1
    assert got == want
    told = decontaminate.report(texts, items, ["doc_id", "words"], broadcast_bytes=limit).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"],
                    sum(s["end"] - s["start"] for s in r["spans"]), r["words"]) for r in told) == want


def test_documents_and_spans_go(spark, texts, items):
    clean = Counter((i, t) for i, t in TEXTS if not plain(t, ITEMS)[1])
    kept = decontaminate.without_documents(texts, items)
    assert kept.columns == texts.columns and kept.schema == texts.schema
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == clean
    assert decontaminate.without_documents(texts, items, share=1.0).count() == len(TEXTS)
    cut = decontaminate.without_spans(texts, items)
    assert cut.columns == texts.columns
    left = Counter()
    for doc, text in TEXTS:
        words, hit, _ = plain(text, ITEMS)
        left[doc, tuple(w for k, w in enumerate(plain_words(text)) if k not in hit)] += 1
    rows = cut.select("doc_id", "text").collect()
    assert Counter((r["doc_id"], tuple(plain_words(r["text"]))) for r in rows) == left
    assert clean <= Counter((r["doc_id"], r["text"]) for r in rows)
    by = {r["doc_id"]: r["text"] for r in rows}
    assert by[20] == "- zé" and by[22] == "x " and by[1] is None and by[2] == ""


def test_empty_tables(spark, texts, items, empty):
    assert decontaminate.contamination(empty, items).count() == 0
    nothing = decontaminate.contamination(texts, items.limit(0)).collect()
    assert len(nothing) == len(TEXTS) and not any(r["contaminated"] or r["n_hit"] or r["items"] for r in nothing)
    assert decontaminate.without_spans(empty, items).columns == empty.columns


def test_long_and_common_passages(spark):
    """A passage in a third of many texts, and an item whose windows all are the same."""
    passage = " ".join(f"p{k}" for k in range(30))
    rows = [(k, f"w{k} a b " + (passage if k % 3 == 0 else "c d") + " tail") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    items = spark.createDataFrame([(k, passage) for k in range(50)] + [(99, "p1 " * 30)], "item_id long, text string")
    out = decontaminate.contamination(docs, items)
    got = out.groupBy("n_hit", "items").count().collect()
    assert {(r["n_hit"], len(r["items"]), r["count"]) for r in got} == {(30, 50, 1000), (0, 0, 2000)}
