"""Cheapest repair of conversations whose turns are blank, repeated, cut short or out of order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.arrow import schema_of
from millrace.sinks.files import staged

# What counts as blank, what ends a sentence, the roles that edits can give.
BLANKS = " \t\n\x0b\f\r"
ENDS = ".!?"
USER, ASSISTANT = "user", "assistant"

# What edits cost. An undeleted row that was cut short adds CUT.
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5

# A repaired conversation is nothing, or pairs of user and assistant, perhaps after a system
# turn. States: nothing yet, a system turn alone, an open user turn, complete pairs.
NOTHING, SYSTEM, OPEN, PAIRED = range(4)
STATES = 4
# Which state an initial leads to, from each state where it may stand.
STEPS = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: OPEN, SYSTEM: OPEN, PAIRED: OPEN}, "a": {OPEN: PAIRED}}
INITIALS = "sua"
OTHER = len(INITIALS)
# Symbols: initial and whether it was cut short, and one for all rows that have to go.
GONE = 2 * (OTHER + 1)

# Symbols that one grammar is made for, and uses below which a rule does not pay.
GRAMMAR_SYMBOLS = 1 << 16
LEAST_USES = 4
# An audit of at most so many letters is a plain text.
SHORT = 64
_BASE, _PRIME = 911_382_323, (1 << 61) - 1

REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class Rope:
    """A text as a tree of shared parts, joined in constant time and compared by hashes."""

    __slots__ = ("size", "hash", "power", "text", "left", "right")

    def __init__(self, text: str | None, left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        if left is None:
            self.size, self.hash = len(text), 0
            for letter in text:
                self.hash = (self.hash * _BASE + ord(letter)) % _PRIME
            self.power = pow(_BASE, len(text), _PRIME)
        else:
            self.size = left.size + right.size
            self.hash = (left.hash * right.power + right.hash) % _PRIME
            self.power = left.power * right.power % _PRIME

    def __add__(self, other: Rope) -> Rope:
        if not other.size:
            return self
        if not self.size:
            return other
        return Rope(self.text + other.text if self.size + other.size <= SHORT else None, self, other)

    def __str__(self) -> str:
        parts, todo = [], [self]
        while todo:
            part = todo.pop()
            if part.text is not None:
                parts.append(part.text)
            else:
                todo += [part.right, part.left]
        return "".join(parts)

    def __lt__(self, other: Rope) -> bool:
        """By the first letter that differs; parts with equal hashes are skipped whole."""
        mine, theirs = [self], [other]
        while mine and theirs:
            a, b = mine.pop(), theirs.pop()
            if a.size == b.size and a.hash == b.hash:
                continue
            if a.text is not None and b.text is not None:
                n = min(a.size, b.size)
                if a.text[:n] != b.text[:n]:
                    return a.text < b.text
                mine += [Rope(a.text[n:])] if a.size > n else []
                theirs += [Rope(b.text[n:])] if b.size > n else []
            elif a.text is None and (a.size >= b.size or b.text is not None):
                mine += [a.right, a.left]
                theirs.append(b)
            else:
                theirs += [b.right, b.left]
                mine.append(a)
        return bool(theirs)


# A matrix has, for each pair of states, the cheapest edits between them as (cost, rope), or
# None. Of equally cheap ones the least text counts. Texts of equal cost are never beginnings
# of one another, as more letters cost more, so the least one stays the least when joined.
Cell = tuple[int, Rope] | None
Matrix = list[list[Cell]]


def _better(a: Cell, b: Cell) -> Cell:
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if b[1] < a[1] else a


def _row_times(row: list[Cell], matrix: Matrix) -> list[Cell]:
    out: list[Cell] = [None] * STATES
    for k, first in enumerate(row):
        if first is not None:
            for j, second in enumerate(matrix[k]):
                if second is not None:
                    cost = first[0] + second[0]
                    if out[j] is None or cost <= out[j][0]:
                        out[j] = _better(out[j], (cost, first[1] + second[1]))
    return out


def times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product: the edits of ``a``, then those of ``b``."""
    return [_row_times(row, b) for row in a]


def _insertions() -> Matrix:
    """No insertion, one, or two in a row; more only lead back to where they began."""
    step: Matrix = [[(0, Rope("")) if i == j else None for j in range(STATES)] for i in range(STATES)]
    for role in (USER, ASSISTANT):
        for i, j in STEPS[role[0]].items():
            step[i][j] = _better(step[i][j], (INSERT, Rope("I")))
    return times(step, step)


def _of_symbol(symbol: int) -> Matrix:
    """Insertions before a row, then what may be done with the row itself."""
    edits: Matrix = [[(DELETE, Rope("D")) if i == j else None for j in range(STATES)] for i in range(STATES)]
    if symbol != GONE:
        initial, cut = INITIALS[symbol // 2:symbol // 2 + 1], CUT * (symbol % 2)
        for role, letter, cost in ((initial, "K", KEEP), (USER, "R", REROLE), (ASSISTANT, "R", REROLE)):
            for i, j in STEPS.get(role[:1], {}).items():
                edits[i][j] = _better(edits[i][j], (cost + cut, Rope(letter)))
    return times(INSERTIONS, edits)


INSERTIONS = _insertions()
SYMBOLS = [_of_symbol(symbol) for symbol in range(GONE + 1)]
START: list[Cell] = [(0, Rope("")) if state == NOTHING else None for state in range(STATES)]


def cheapest(row: list[Cell]) -> tuple[int, str]:
    """Cost and audit of the cheapest way to a complete conversation."""
    ended = _row_times(row, INSERTIONS)
    cost, audit = _better(ended[NOTHING], ended[PAIRED])
    return cost, str(audit)


def re_pair(sequences: list[np.ndarray], least_uses: int = LEAST_USES) -> tuple[
        list[np.ndarray], list[tuple[int, int]]]:
    """The sequences after the most frequent pair of neighbours was replaced by a new symbol,
    time and again, and the pairs: the n-th stands for symbol GONE + 1 + n."""
    lengths = np.array([len(s) for s in sequences], np.int64)
    # Each sequence is followed by a number of its own below 0, so that no pair reaches over it.
    joined = np.empty(int(lengths.sum()) + len(sequences), np.int64)
    stops = np.cumsum(lengths + 1) - 1
    inside = np.ones(len(joined), bool)
    inside[stops] = False
    joined[inside] = np.concatenate(sequences) if sequences else []
    joined[stops] = -1
    rules: list[tuple[int, int]] = []
    while True:
        new = GONE + 1 + len(rules)
        at = np.flatnonzero((joined[:-1] >= 0) & (joined[1:] >= 0))
        if not len(at):
            break
        pairs, counts = np.unique(joined[at] * new + joined[at + 1], return_counts=True)
        if counts.max() < least_uses:
            break
        left, right = divmod(int(pairs[counts.argmax()]), new)
        hits = at[(joined[at] == left) & (joined[at + 1] == right)]
        if left == right:
            # In a run of one symbol every second pair overlaps the one before it.
            begins = np.flatnonzero(np.diff(hits, prepend=-2) != 1)
            nth = np.arange(len(hits)) - np.repeat(begins, np.diff(begins, append=len(hits)))
            hits = hits[nth % 2 == 0]
        joined[hits] = new
        kept = np.ones(len(joined), bool)
        kept[hits + 1] = False
        joined = joined[kept]
        rules.append((left, right))
    bounds = np.flatnonzero(joined < 0)
    begins = np.concatenate([[0], bounds[:-1] + 1]).astype(int) if len(bounds) else bounds
    return [joined[a:b] for a, b in zip(begins.tolist(), bounds.tolist())], rules


def repairs(segments: list[list[bytes]]) -> list[tuple[int, str]]:
    """(cost, audit) of each conversation, given as segments of symbols.

    One grammar is made of all distinct segments, one matrix for each of its rules, bottom
    up, and the matrices are shared by all conversations. What is left of a conversation is a
    short row of symbols, whose matrices are applied to the row of the start.
    """
    distinct = sorted({part for segment in segments for part in segment})
    compressed, rules = re_pair([np.frombuffer(part, np.uint8).astype(np.int64) for part in distinct])
    matrices = list(SYMBOLS)
    for left, right in rules:
        matrices.append(times(matrices[left], matrices[right]))
    grammar = dict(zip(distinct, compressed))
    known: dict[tuple[bytes, ...], tuple[int, str]] = {}
    out = []
    for segment in segments:
        name = tuple(segment)
        if name not in known:
            symbols = [symbol for part in segment for symbol in grammar[part].tolist()]
            known[name] = cheapest(reduce(lambda row, s: _row_times(row, matrices[s]), symbols, START))
        out.append(known[name])
    return out


def _digest(role: Column, text: Column) -> Column:
    """Equal for equal roles and texts; the order of rows with equal turns."""
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def _rows(turns: DataFrame) -> DataFrame:
    role = F.coalesce(turns["role"], F.lit(" "))
    text = F.coalesce(turns["text"], F.lit(" "))
    return turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"),
                        text.alias("text"), _digest(role, text).alias("digest"))


def _classes(rows: DataFrame) -> DataFrame:
    """The rows without their texts: initial as a number, and 0 blank, 1 whole, 2 cut short."""
    initial = reduce(lambda done, k: F.when(F.substring("role", 1, 1) == INITIALS[k], k).otherwise(done),
                     range(len(INITIALS)), F.lit(OTHER))
    last = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    state = F.when(last == "", 0).when(last.isin(*ENDS), 1).otherwise(2)
    return rows.select("conv_id", F.lit(True).alias("is_row"), "turn", "digest",
                       initial.cast("byte").alias("initial"), state.cast("byte").alias("state"))


class _Conversation:
    """What has been read of a conversation, in its order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.symbols, self.parts = conv_id, bytearray(), []
        self.seen: set[bytes] = set()
        self.counts = [0, 0, 0, 0]
        self.before, self.first, self.last, self.turns = None, None, None, 0

    def add(self, turn: int | None, digest: str, initial: int, state: int) -> None:
        if self.before is not None and (self.before, initial) not in ((0, 1), (1, 2), (2, 1)):
            self.counts[3] += 1
        self.before = initial
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        key = bytes.fromhex(digest)
        fault = 0 if state == 0 else 1 if key in self.seen else 2 if state == 2 else None
        self.seen.add(key)
        if fault is not None:
            self.counts[fault] += 1
        self.symbols.append(GONE if fault in (0, 1) else 2 * initial + (fault == 2))
        if len(self.symbols) == GRAMMAR_SYMBOLS:
            self.cut()

    def cut(self) -> None:
        if self.symbols:
            self.parts.append(bytes(self.symbols))
            self.symbols = bytearray()

    def gaps(self) -> int:
        return self.last - self.first + 1 - self.turns if self.turns else 0


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reports of conversations that come in order, some ten thousand rows at a time."""
    done: list[_Conversation] = []
    current: _Conversation | None = None
    waiting = 0

    def flush() -> Iterator[pa.RecordBatch]:
        found = repairs([c.parts for c in done])
        columns = list(zip(*[(c.conv_id, c.gaps(), *c.counts, *result) for c, result in zip(done, found)]))
        kinds = [pa.int64()] * 7 + [pa.string()]
        names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        if columns:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    for batch in batches:
        for conv_id, is_row, *row in zip(*[batch.column(c).to_pylist() for c in (
                "conv_id", "is_row", "turn", "digest", "initial", "state")]):
            if current is None or current.conv_id != conv_id:
                if current is not None:
                    current.cut()
                    current.seen.clear()
                    done.append(current)
                    waiting += sum(map(len, current.parts)) + 1
                    if waiting >= GRAMMAR_SYMBOLS:
                        yield from flush()
                        done, waiting = [], 0
                current = _Conversation(conv_id)
            if is_row:
                current.add(*row)
    if current is not None:
        current.cut()
        done.append(current)
    yield from flush()


def audit(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    The rows of a conversation are taken by turn, those without one first, and rows with
    equal turns by a digest of role and text. NULL roles and texts are one space. The first
    fault of a row counts: blank; duplicate, if role and text came before; truncated, if its
    last character that is no blank ends no sentence. ``gaps`` are the turns missing between
    the first and the last, ``illegal`` the neighbours whose initials are not su, ua or au.
    Roles are told by their first letter; an empty or other one fits nowhere.

    ``audit`` has a letter for each edit, in order: K keeps a row, R makes it the user's or
    the assistant's, D deletes it, I inserts an empty turn. It is the cheapest one after
    which the initials are those of pairs of user and assistant, perhaps after a system turn,
    or of nothing; of equally cheap ones the first in ASCII order. Blank and duplicate rows
    have to go. A conversation without rows, as ``conversations`` may name some, has zeros
    and an empty audit. Rows without a conv_id are one conversation.

    Only a digest and two classes of each row are shuffled, by conversation; a conversation is
    read by one task as a stream, which keeps a digest and a letter for each of its rows.
    """
    rows = _classes(_rows(turns))
    if conversations is not None:
        ids = conversations.select("conv_id").distinct()
        rows = rows.unionByName(ids.withColumn("is_row", F.lit(False)), allowMissingColumns=True)
    ordered = rows.withColumn("conv_id", F.col("conv_id").cast("long")).repartition("conv_id").sortWithinPartitions(
        F.asc_nulls_first("conv_id"), "is_row", F.asc_nulls_first("turn"), "digest")
    return ordered.mapInArrow(_audits, schema_of(f"conv_id long, {REPORT}"))


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[tuple[str, str, str]]]]:
    """(report, edited rows) of conversations that come in order, each after its audit.

    The rows of a conversation have to be used up before the next one is asked for.
    """
    rows = (row for batch in batches for row in batch.to_pylist())
    ahead = next(rows, None)
    while ahead is not None:
        report, state = ahead, NOTHING

        def edited() -> Iterator[tuple[str, str, str]]:
            nonlocal ahead, state
            edits = iter(report["audit"])

            def placed(role: str | None) -> str:
                nonlocal state
                role = role or (ASSISTANT if state == OPEN else USER)
                state = STEPS[role[0]][state]
                return role
            ahead = next(rows, None)
            for edit in edits:
                if edit == "I":
                    yield edit, placed(None), ""
                    continue
                row, ahead = ahead, next(rows, None)
                if edit == "D":
                    yield edit, row["role"], row["text"]
                else:
                    yield edit, placed(row["role"] if edit == "K" else None), row["text"]
        yield report, edited()


def _turns_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "position", "edit", "role", "text"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    out, size = [], 0
    for report, edited in _applied(batches):
        position = 0
        for edit, role, text in edited:
            if edit != "D":
                out.append((report["conv_id"], position, edit, role, text))
                position, size = position + 1, size + len(text) + 64
                if size > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                    out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


REPORTED = ["conv_id", *[column.split()[0] for column in REPORT.split(", ")]]


def _digests_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reports, digests = [], []

    def flush() -> pa.RecordBatch:
        columns = [pa.array([r[c] for r in reports], pa.string() if c == "audit" else pa.int64()) for c in REPORTED]
        return pa.RecordBatch.from_arrays([*columns, pa.array(digests, pa.string())], [*REPORTED, "repaired_sha256"])

    for report, edited in _applied(batches):
        digest, between = hashlib.sha256(), b""
        for edit, role, text in edited:
            if edit != "D":
                digest.update(between + f"{role}:{text}".encode())
                between = b"\n"
        reports.append(report)
        digests.append(digest.hexdigest())
        if len(reports) >= 4096:
            yield flush()
            reports, digests = [], []
    if reports:
        yield flush()


def _with_audits(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """The rows of each conversation in order, after its audit; one shuffle of the texts."""
    rows = _rows(turns).withColumns({"conv_id": F.col("conv_id").cast("long"), "is_row": F.lit(True)})
    return (audits.withColumn("is_row", F.lit(False)).unionByName(rows, allowMissingColumns=True)
            .repartition("conv_id").sortWithinPartitions(
                F.asc_nulls_first("conv_id"), "is_row", F.asc_nulls_first("turn"), "digest"))


def repaired(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """The turns after the edits of ``audit``: conv_id, position, edit, role, text.

    Inserted turns have an empty text. The texts stream through the task of their
    conversation and are not held there.
    """
    return _with_audits(turns, audits).mapInArrow(_turns_of, schema_of(
        "conv_id long, position long, edit string, role string, text string"))


def repair_report(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """The rows of ``audit`` with ``repaired_sha256``, of the lines ``role:text`` of the
    repaired turns; that of the empty text where nothing is left."""
    audits = staged(audit(turns, conversations), "audits")
    return _with_audits(turns, audits).mapInArrow(_digests_of, schema_of(
        f"conv_id long, {REPORT}, repaired_sha256 string"))
