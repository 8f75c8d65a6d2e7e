"""Conversation repair against exhaustive search, plain dynamic programming and odd rows."""

import hashlib
import re
from functools import cache

import numpy as np
import pytest

from millrace.llm import structure_repair as sr

GOOD = re.compile(r"(s?(ua)+)?")


def exhaustive(symbols):
    """All edits with at most three insertions, told by the pattern alone."""
    found = []

    def go(at, cost, audit, initials, inserted):
        if at == len(symbols) and GOOD.fullmatch(initials):
            found.append((cost, audit))
        if inserted < 3:
            for letter in "ua":
                go(at, cost + 5, audit + "I", initials + letter, inserted + 1)
        if at < len(symbols):
            symbol = symbols[at]
            go(at + 1, cost + 2, audit + "D", initials, inserted)
            if symbol != sr.GONE:
                cut = 5 * (symbol % 2)
                go(at + 1, cost + cut, audit + "K", initials + "sua?"[symbol // 2], inserted)
                for letter in "ua":
                    go(at + 1, cost + cut + 1, audit + "R", initials + letter, inserted)
    go(0, 0, "", "", 0)
    return min(found)


def plain(symbols):
    """Cheapest edits by plain dynamic programming over texts."""
    def insert(cells):
        for _ in range(3):
            new = dict(cells)
            for i, (cost, audit) in cells.items():
                for letter in "ua":
                    j = sr.STEPS[letter].get(i)
                    if j is not None:
                        new[j] = min(new.get(j, (10**9, "")), (cost + 5, audit + "I"))
            cells = new
        return cells
    cells = {sr.NOTHING: (0, "")}
    for symbol in symbols:
        new = {}
        for i, (cost, audit) in insert(cells).items():
            ways = [(i, cost + 2, "D")]
            if symbol != sr.GONE:
                cut = 5 * (symbol % 2)
                own = "sua?"[symbol // 2]
                ways += [(sr.STEPS.get(letter, {}).get(i), cost + cut + more, edit)
                         for letter, more, edit in ((own, 0, "K"), ("u", 1, "R"), ("a", 1, "R"))]
            for j, total, edit in ways:
                if j is not None:
                    new[j] = min(new.get(j, (10**9, "")), (total, audit + edit))
        cells = new
    ended = insert(cells)
    return min(ended[k] for k in (sr.NOTHING, sr.PAIRED) if k in ended)


def test_short_rows_against_exhaustive_search():
    rng = np.random.default_rng(1)
    rows = [bytes(rng.integers(0, sr.GONE + 1, n).tolist()) for n in (1, 2, 3, 4) for _ in range(30)]
    assert sr.repairs([[row] for row in rows]) == [exhaustive(row) for row in rows]
    assert sr.repairs([[]]) == [(0, "")]


@pytest.mark.parametrize("symbols", [sr.GONE + 1, 3])
def test_long_rows_in_segments(symbols):
    """Rows that share many parts, longer than a plain rope and cut at other places."""
    rng = np.random.default_rng(2)
    words = [rng.integers(0, symbols, 9).tolist() for _ in range(4)]
    rows = [bytes(sum((words[k] for k in rng.integers(0, 4, n)), [])) for n in rng.integers(1, 60, 25)]
    rows += [bytes([0] * 300), bytes([6, 6, 6] * 100), bytes([2, 4] * 200), bytes([4, 2] * 200)]
    want = [plain(row) for row in rows]
    assert sr.repairs([[row] for row in rows]) == want
    assert sr.repairs([[row[:7], row[7:50], row[50:]] if len(row) > 50 else [row] for row in rows]) == want


def test_grammar_gives_the_rows_back():
    rng = np.random.default_rng(3)
    rows = [rng.integers(0, 3, n) for n in (0, 1, 5, 200, 300)] + [np.zeros(n, np.int64) for n in (2, 7, 64, 129)]
    left, rules = sr.re_pair(rows, 2)

    @cache
    def spelled(symbol):
        if symbol <= sr.GONE:
            return (symbol,)
        a, b = rules[symbol - sr.GONE - 1]
        return spelled(a) + spelled(b)
    assert [sum((spelled(s) for s in row.tolist()), ()) for row in left] == [tuple(row.tolist()) for row in rows]
    assert len(rules) > 10 and sum(map(len, left)) < sum(map(len, rows)) / 2


def brute(turns):
    """Report and repaired turns of one conversation, rows as (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in turns]
    rows.sort(key=lambda row: (row[0] is not None, row[0] or 0, hashlib.md5(
        f"{len(row[1].encode())}:{row[1]}{row[2]}".encode()).hexdigest()))
    counts, symbols, seen = [0, 0, 0], [], set()
    for _, role, text in rows:
        content = text.strip(" \t\n\x0b\f\r")
        fault = 0 if not content else 1 if (role, text) in seen else 2 if content[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        initial = "sua".find(role[:1]) if role[:1] in tuple("sua") else 3
        symbols.append(sr.GONE if fault in (0, 1) else 2 * initial + (fault == 2))
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    known = {t for t, _, _ in rows if t is not None}
    cost, audit = plain(symbols)
    out, state, at = [], sr.NOTHING, iter(rows)
    for edit in audit:
        row = next(at) if edit != "I" else None
        if edit != "D":
            role = row[1] if edit == "K" else "assistant" if state == sr.OPEN else "user"
            out.append((role, row[2] if row else ""))
            state = sr.STEPS[role[0]][state]
    return ((max(known) - min(known) + 1 - len(known) if known else 0), *counts,
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit), out


SAID = ["Fine.", "What?", "cut short", "", " \t", None, "Yes!  \n", "漢字。", "Fine.", "x" * 70_000 + "."]
ROLES = ["user", "assistant", "system", "tool", "", None, "u", "Assistant"]


@pytest.fixture
def turns():
    rng = np.random.default_rng(4)
    rows = []
    for conv in [None, -3, 0, *range(5, 60)]:
        for _ in range(int(rng.integers(1, 14))):
            turn = None if rng.random() < 0.1 else int(rng.integers(-2, 12))
            role = ROLES[int(rng.integers(0, len(ROLES)))] if rng.random() < 0.4 else ROLES[int(rng.integers(0, 2))]
            rows.append((conv, turn, role, SAID[int(rng.integers(0, len(SAID)))]))
    return rows


def frame(spark, rows):
    """With further columns that are named like the operator's own."""
    return spark.createDataFrame([(*row, "k", n, True, "a") for n, row in enumerate(rows)],
                                 "conv_id long, turn long, role string, text string, digest string, position int, "
                                 "is_row boolean, audit string").repartition(5)


def test_conversations_against_a_plain_version(spark, turns):
    of = {}
    for conv, *row in turns:
        of.setdefault(conv, []).append(tuple(row))
    ids = spark.createDataFrame([(c, 1) for c in [*of, 777, 777]], "conv_id long, turn int")
    df = frame(spark, turns)
    got = {r["conv_id"]: tuple(r)[1:] for r in sr.repair_report(df, ids).collect()}
    want = {}
    for conv, rows in {**of, 777: []}.items():
        report, out = brute(rows)
        lines = "\n".join(f"{role}:{text}" for role, text in out)
        want[conv] = (*report, hashlib.sha256(lines.encode()).hexdigest())
    assert got == want and want[777][-2] == ""
    placed = {}
    for row in sr.repaired(df, sr.audit(df)).orderBy("conv_id", "position").collect():
        placed.setdefault(row["conv_id"], []).append((row["role"], row["text"]))
        assert row["position"] == len(placed[row["conv_id"]]) - 1
    assert placed == {conv: out for conv, rows in of.items() if (out := brute(rows)[1])}


def test_one_conversation_holds_a_third_of_the_rows(spark):
    rows = [(None, k, ROLES[k % 2], f"said {k // 3}.") for k in range(3000)]
    rows += [(k // 4, k % 4, ROLES[k % 2], "Fine.") for k in range(6000)]
    report = {r["conv_id"]: r for r in sr.audit(frame(spark, rows)).collect()}
    assert len(report) == 1501 and tuple(report[None])[1:] == brute([row[1:] for row in rows[:3000]])[0]


def test_no_rows(spark):
    none = frame(spark, [(1, 1, "user", "x")]).limit(0)
    assert sr.repair_report(none).count() == 0 and sr.repaired(none, sr.audit(none)).count() == 0
    assert [tuple(r) for r in sr.repair_report(none, spark.createDataFrame([(4,)], "conv_id long")).collect()] == [
        (4, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
