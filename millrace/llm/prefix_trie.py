"""The trie of conversations that begin alike, from sorted neighbours by union-find."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.arrow import schema_of
from millrace.sinks.files import staged

# Bytes of a turn's digest in the key of a conversation.
DIGEST = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string")
# A node of one partition. Those that other partitions share have a name; ``above`` is the
# name of the parent where that one is shared.
PART = ("name binary, above binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, spoken long, stored long, ends_sha256 string")


def ordered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, nth, digest, length) of each turn; ``nth`` counts from 0 by turn, NULL first,
    then role and text. A NULL role or text is empty. Rows without a conv_id belong to none."""
    role, text = (F.coalesce(turns[c], F.lit("")) for c in ("role", "text"))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    rows = turns.filter(turns["conv_id"].isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(said)).alias("digest"), F.char_length(text).cast("long").alias("length"))
    # Equal turns are told apart by their digests, so that texts need not be sorted.
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest")
    return rows.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("nth"), "digest", "length")


def _ends_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per group of equal conversations, whose ids come in order."""
    group, digest, first, count = None, None, None, 0
    for batch in batches:
        out = []
        for name, conv in zip(batch.column("name").to_pylist(), batch.column("conv_id").to_pylist()):
            if name != group:
                if count:
                    out.append((group, first, count, digest.hexdigest()))
                group, digest, first, count = name, hashlib.sha256(), conv, 0
            digest.update(f",{conv}".encode() if count else str(conv).encode())
            count += 1
        if out:
            yield _batch(out, ["name", "first", "n", "sha"], [pa.binary(), pa.int64(), pa.int64(), pa.string()])
    if count:
        yield _batch([(group, first, count, digest.hexdigest())], ["name", "first", "n", "sha"],
                     [pa.binary(), pa.int64(), pa.int64(), pa.string()])


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def sequences(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """(key, lengths, conv_id, n_convs, ends_sha256) of each distinct sequence of turns.

    ``turns`` has (conv_id, nth, digest, length), ``conversations`` every conv_id, of which
    those without turns are the empty sequence. ``key`` is the turns' digests in a row. Equal
    conversations are reduced by each task before they are shuffled; only their ids, whose
    list is digested in order, go through one task for each sequence, as a stream.
    """
    parts = F.array_sort(F.collect_list(F.struct("nth", "digest", "length")))
    each = (conversations.select(F.col("conv_id").cast("long").alias("conv_id"))
            .join(turns.groupBy("conv_id").agg(parts.alias("parts")), "conv_id", "left"))
    key = F.coalesce(F.unhex(F.array_join(F.transform("parts.digest", lambda d: F.hex(d)), "")), F.lit(b""))
    keyed = staged(each.select("conv_id", key.alias("key"),
                               F.coalesce("parts.length", F.array().cast("array<bigint>")).alias("lengths"))
                   .withColumn("name", F.unhex(F.sha2("key", 256))), "trie-keys")
    ends = (keyed.select("name", "conv_id").repartition("name").sortWithinPartitions("name", "conv_id")
            .mapInArrow(_ends_of, schema_of("name binary, first long, n long, sha string")))
    distinct = keyed.groupBy("name").agg(F.any_value("key").alias("key"), F.any_value("lengths").alias("lengths"))
    return distinct.join(ends, "name").select(
        "key", "lengths", F.col("first").alias("conv_id"), F.col("n").alias("n_convs"), F.col("sha").alias("ends_sha256"))


def common_turns(a: bytes, b: bytes) -> int:
    """With how many equal turns two keys begin."""
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size // DIGEST
    differs = np.frombuffer(a, np.uint8, size) != np.frombuffer(b, np.uint8, size)
    return int(differs.argmax()) // DIGEST


def prefix_names(key: bytes, depth: int) -> list[bytes]:
    """A digest of each beginning of the key, from no turn up to ``depth`` turns."""
    running, names = hashlib.sha256(), []
    for d in range(depth + 1):
        names.append(running.copy().digest())
        running.update(key[d * DIGEST:(d + 1) * DIGEST])
    return names


class Forest:
    """The trie of sequences that are distinct and in order, as branching nodes and chains.

    ``before`` and ``after`` are the turns that the first and the last sequence share with
    their neighbours outside, -1 without a neighbour. Nodes up to there are shared: what is
    counted of them, and all that is counted of other nodes, adds up over partitions, as a
    node is stored by the partition that has its first sequence.
    """

    def __init__(self, keys: list[bytes], lengths: list[list[int]], convs: list[int], copies: list[int],
                 shas: list[str], before: int, after: int):
        n = len(keys)
        self.keys, self.lengths, self.before, self.after = keys, lengths, before, after
        depths = [len(key) // DIGEST for key in keys]
        shared = [common_turns(a, b) for a, b in zip(keys, keys[1:])]
        # One node for the end of each sequence; nodes where components merge follow.
        self.depth, self.conv, self.copies = depths, list(convs), list(copies)
        extended = [*(s == d for s, d in zip(shared, depths)), after >= depths[-1]]
        self.leaves = [0 if more else 1 for more in extended]
        self.children, self.spoken, self.stored = [0] * n, [0] * n, [0] * n
        self.sha: list[str] = list(shas)
        self.low, self.high = list(range(n)), list(range(n))
        self.rows: list[list] = []
        self.above: list[int] = []
        self.opened = [prefix_names(keys[0], before), prefix_names(keys[-1], after)]

        root = list(range(n))  # of the union-find forest over sequences
        top = list(range(n))  # the uppermost node of a component

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        # Deepest first, and from left to right: a component is whole when it gets a parent.
        for edge in sorted(range(n - 1), key=lambda e: -shared[e]):
            left, right, depth = find(edge), find(edge + 1), shared[edge]
            node = top[left]
            if self.depth[node] != depth:
                node = self._branch(depth, top[left])
            self._hang(top[right], node)
            root[right] = left
            top[left] = node
        whole = top[find(0)]
        self._chain(whole, 0, None)

    def _branch(self, depth: int, child: int) -> int:
        node = len(self.depth)
        for column in (self.copies, self.leaves, self.children, self.spoken, self.stored):
            column.append(0)
        self.depth.append(depth)
        self.sha.append(NO_ENDS)
        self.conv.append(self.conv[child])
        self.low.append(self.low[child])
        self.high.append(self.high[child])
        self._hang(child, node)
        return node

    def _hang(self, child: int, node: int) -> None:
        """Give a whole component its parent, with the chain of nodes in between."""
        spoken, stored, new = self._chain(child, self.depth[node] + 1, node)
        self.spoken[node] += spoken
        self.stored[node] += stored
        self.children[node] += new
        self.copies[node] += self.copies[child]
        self.leaves[node] += self.leaves[child]
        self.conv[node] = min(self.conv[node], self.conv[child])
        self.low[node] = min(self.low[node], self.low[child])
        self.high[node] = max(self.high[node], self.high[child])

    def _name(self, node: int, depth: int) -> bytes | None:
        if self.low[node] == 0 and depth <= self.before:
            return self.opened[0][depth]
        if self.high[node] == len(self.keys) - 1 and depth <= self.after:
            return self.opened[1][depth]
        return None

    def _chain(self, node: int, stop: int, parent: int | None) -> tuple[int, int, int]:
        """Rows of a node and of those above it down to depth ``stop``, which lead to it alone;
        what they add up to, and whether the last of them is stored here."""
        spoken, stored, children = self.spoken[node], self.stored[node], self.children[node]
        lengths, name, sha, new = self.lengths[self.low[node]], self._name(node, self.depth[node]), self.sha[node], 0
        for depth in range(self.depth[node], stop - 1, -1):
            new = int(self.low[node] > 0 or depth > self.before)
            if depth:
                spoken += self.copies[node] * lengths[depth - 1]
                stored += new * lengths[depth - 1]
            over = self._name(node, depth - 1) if depth else None
            # The parent's least id is known once its component is whole.
            self.rows.append([name, over, self.conv[node], depth, None if depth == 0 else self.conv[node],
                              self.copies[node], children, self.leaves[node], spoken, stored, sha])
            self.above.append(parent if depth == stop and parent is not None else -1)
            name, sha, children = over, NO_ENDS, new
        return spoken, stored, new

    def nodes(self) -> Iterator[tuple]:
        for row, above in zip(self.rows, self.above):
            if above >= 0:
                row[4] = self.conv[above]
                row[1] = self._name(above, row[3] - 1)
            yield tuple(row)


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of each partition, whose sequences come in order between their neighbours."""
    names = [column.split()[0] for column in PART.split(", ")]
    kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 8, pa.string()]

    def made(held: list[dict]) -> Iterator[pa.RecordBatch]:
        inside = [row for row in held if row["n_convs"] is not None]
        if not inside:
            return
        before = common_turns(held[0]["key"], inside[0]["key"]) if held[0]["n_convs"] is None else -1
        after = common_turns(held[-1]["key"], inside[-1]["key"]) if held[-1]["n_convs"] is None else -1
        forest = Forest([row["key"] for row in inside], [row["lengths"] for row in inside],
                        *[[row[c] for row in inside] for c in ("conv_id", "n_convs", "ends_sha256")], before, after)
        out = []
        for node in forest.nodes():
            out.append(node)
            if len(out) == 10_000:
                yield _batch(out, names, kinds)
                out = []
        if out:
            yield _batch(out, names, kinds)

    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[-1]["part"] != row["part"]:
                yield from made(held)
                held = []
            held.append(row)
    yield from made(held)


def _with_neighbours(parts: DataFrame) -> DataFrame:
    """The sequences of each partition, in order, between the last one before and the first
    one after it, which have no count."""
    edges = staged(parts.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high")), "trie-edges")
    line = Window.partitionBy().orderBy("part")  # two keys for each partition
    sides = edges.select("part", F.array(F.lag("high").over(line), F.lead("low").over(line)).alias("keys"))
    outside = sides.select("part", F.explode("keys").alias("key")).filter(F.col("key").isNotNull())
    return (parts.unionByName(outside, allowMissingColumns=True).repartition("part")
            .sortWithinPartitions("part", "key"))


def prefix_nodes(found: DataFrame) -> DataFrame:
    """The nodes of the trie of distinct sequences, as ``sequences`` gives them.

    The sequences are dealt out by ranges of their keys and sorted, so that those that begin
    alike are neighbours. In each partition the numbers of turns that neighbours share are
    the edges of a union-find, which takes the deepest first: each merge of components makes
    a branching node or adds a branch to one, and the nodes between it and the one below are
    a chain. Nodes on the way to the first and the last sequence, as deep as those share turns
    with the neighbouring partitions, are the contracted forest: a few rows with partial
    counts, merged by the digest of their turns.
    """
    key_order = found.repartitionByRange("key").sortWithinPartitions("key")
    parts = staged(key_order.withColumn("part", F.spark_partition_id()), "trie-sequences")
    made = staged(_with_neighbours(parts).mapInArrow(_forests, schema_of(PART)), "trie-parts")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "spoken", "stored")]
    # A sequence ends in one partition; elsewhere its node has the digest of no ids.
    ends = F.coalesce(F.max(F.when(F.col("ends_sha256") != NO_ENDS, F.col("ends_sha256"))), F.lit(NO_ENDS))
    merged = staged(made.filter("name IS NOT NULL").groupBy("name", "depth").agg(
        F.any_value("above").alias("above"), F.min("conv_id").alias("conv_id"), *sums, ends.alias("ends_sha256")),
        "trie-shared")
    over = merged.select(F.col("name").alias("over"), F.col("conv_id").alias("over_conv"))
    columns = ["conv_id", "depth", "n_convs", "n_children", "n_leaves",
               (F.col("spoken") - F.col("stored")).alias("saved_tokens"), "ends_sha256"]
    own = made.filter("name IS NULL")
    rows = (own.filter("above IS NULL").select("parent_conv_id", *columns)
            .unionByName(_under(own.filter("above IS NOT NULL"), over, columns))
            .unionByName(_under(merged, over, columns)))
    return rows.select(*[column.split()[0] for column in NODE.split(", ")])


def _under(rows: DataFrame, over: DataFrame, columns: list[str | Column]) -> DataFrame:
    """The rows with the ids of their shared parents; the root has none."""
    return (rows.drop("parent_conv_id").join(over, rows["above"] == over["over"], "left")
            .select(F.col("over_conv").alias("parent_conv_id"), *columns))


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Every distinct beginning of a conversation: conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` is as ``ordered_turns`` gives it, ``conversations`` has a conv_id for each
    conversation, of which those without turns end at the root. A node is named by its depth
    and the least conversation that begins so; ``n_convs`` begin so, ``n_leaves`` nodes under
    it, itself included, have no child, and ``saved_tokens`` sums, over the same nodes, the
    length of the last turn for each conversation but one. ``ends_sha256`` digests the ids of
    those that end there, in order of number and with commas. The root has no parent and no
    last turn; without conversations there is no node.

    A conversation is held as digests and lengths, 24 bytes a turn, in one row. Any number of
    conversations may be equal or share a beginning: the ranges are of whole keys.
    """
    return prefix_nodes(sequences(turns, conversations))
