"""Pages of any depth in linear time, with the same text as by the plain way."""

import time
from collections import Counter

import numpy as np

from millrace.llm import html_text
from millrace.llm.html_text import INLINE, PLAIN, VOID, Weights


def plain_marks(page):
    """The text of each token with the set of marks around it, rebuilt from the whole stack."""
    out, stack, at = [], [], 0
    for match in html_text.TOKEN.finditer(page):
        if page[at:match.start()].strip():
            out.append((page[at:match.start()], {k for _, keys in stack for k in keys}))
        at = match.end()
        if match.lastgroup not in ("tag", "torn"):
            continue
        name, marks, closed = html_text.parsed(match[0])
        if match[0][1] == "/":
            if not (name in INLINE and name != "a"):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        del stack[k:]
                        break
        elif not (name in VOID or closed or name in INLINE and name != "a" and not marks):
            body = name == "header" and any(n in ("article", "main") for n, _ in stack)
            keys = ("a",) if name == "a" else marks if name in PLAIN or body else (*marks, name)
            while stack and name not in INLINE and stack[-1][0] == "a":
                stack.pop()
            if keys or name not in ("p", "li"):
                stack.append((name, keys))
    if page[at:].strip():
        out.append((page[at:], {k for _, keys in stack for k in keys}))
    return out


def path_of(around):
    keys = []
    while around is not None:
        keys += around.keys
        around = around.parent
    return keys


def random_page(rng):
    names = ["div", "p", "a", "nav", "header", "article", "li", "span", "b", "section", "form", "br"]
    parts = []
    for _ in range(int(rng.integers(5, 120))):
        name, mark = names[int(rng.integers(len(names)))], int(rng.integers(4))
        parts.append([f"<{name}>", f'<{name} class="m{mark} menu">', f"</{name}>", f" word{mark} more "][int(rng.integers(4))])
    return "".join(parts)


def test_marks_are_those_of_the_whole_stack():
    rng = np.random.default_rng(6)
    for _ in range(300):
        page = random_page(rng)
        got = [(t.text, path_of(t.around)) for t in html_text.tokens(page) if not t.tag]
        want = plain_marks(page)
        assert [(text, set(keys)) for text, keys in got] == want
        assert all(len(keys) == len(set(keys)) for _, keys in got)


def test_counts_and_scores_are_those_of_whole_stacks():
    rng = np.random.default_rng(7)
    total = Counter()
    for _ in range(400):
        page = random_page(rng)
        tokens = html_text.tokens(page)
        span = html_text.labelled(tokens)
        if span is None:
            continue
        want = Counter()
        for k, token in enumerate(tokens):
            inside = span[0] <= k < span[1]
            if token.tag:
                want[f"<{token.tag}", inside] += 1
            else:
                want["word", inside] += len(token.text.split())
                for key in set(path_of(token.around)):
                    want[f"in {key}", inside] += len(token.text.split())
        assert html_text.counts(tokens) == want
        total += want
    assert total
    weights = Weights.of({what: (total[what, True], total[what, False]) for what, _ in total})
    known = {}
    for _ in range(100):
        for token in html_text.tokens(random_page(rng)):
            keys = path_of(token.around)
            assert weights.word(token.around, known) == min([weights.plain_word(), *map(weights.key, keys)])


def test_deep_and_torn_pages_take_linear_time():
    def seconds(page):
        begin = time.process_time()
        text = html_text.extract(page, Weights())
        html_text.counts(html_text.tokens(f"<article>{page}</article>"))
        return time.process_time() - begin, text
    n = 100_000
    for make in (lambda n: "".join(f'<div class="c{k}">' for k in range(n)) + "deep words here" + "</div>" * n,
                 lambda n: "words here" + "</section>" * n + " and there",
                 lambda n: "<div>" + "<i class=x>" * n + "words" + "</u></form>" * n):
        small, _ = seconds(make(n // 10))
        large, text = seconds(make(n))
        assert "words" in text and large < 20 and large < 40 * max(small, 0.05)
