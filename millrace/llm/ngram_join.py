"""Documents whose word shingles are alike, by MinHash with Bayesian pruning.

1. Documents with the same shingles form a class; from here on a class is one row.
2. Each class has MinHash values. Runs of them, the bands, put it into buckets. Two classes
   of similarity s share no bucket with probability (1 - s**ROWS)**BANDS, below 1e-6 at 0.8.
3. Buckets of several classes are cut into blocks of bounded size, and pairs of blocks are
   compared, a step of MinHash values at a time. A pair is dropped once the posterior
   probability that its similarity reaches the threshold is below ``TOLERANCE``. A pair that
   shares several buckets is compared in the first one only.
4. Pairs that are left are verified on their texts. A block pair reports how many documents
   each class is linked to and which classes hang together, not the links one by one.
5. Classes that hang together, over any number of links, are numbered alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm import words
from millrace.llm.arrow import text_slices
from millrace.sinks.files import staged

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 28, 4
STEP = 16
TOLERANCE = 1e-6
# Classes and shingles of a block, on average; a pair of blocks is what one task holds.
BLOCK_CLASSES, BLOCK_SHINGLES = 512, 200_000

HASHES = BANDS * ROWS
_random = np.random.default_rng(2024)
FACTORS = _random.integers(1, 1 << 62, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _random.integers(1, 1 << 62, HASHES, dtype=np.uint64)
SKETCH_BYTES = BANDS * 8 + HASHES


def least_agreements(threshold: float, tolerance: float = TOLERANCE) -> dict[int, int]:
    """By number of compared values, how many must agree for a pair to go on.

    With a uniform prior, the probability that the similarity is at least t after m of n
    values agreed is that of at most m successes in n + 1 trials of probability t. Values
    are compared by one byte, which may agree by chance.
    """
    t = threshold + (1 - threshold) / 256
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        below, m = 0.0, -1
        while below < tolerance:
            m += 1
            below += comb(n + 1, m) * t**m * (1 - t)**(n + 1 - m)
        out[n] = m
    return out


def sketches(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each shingle set: its band hashes, eight bytes each, then a byte of each value."""
    sets = len(bounds) - 1
    out = np.zeros((sets, SKETCH_BYTES), np.uint8)
    full = np.flatnonzero(np.diff(bounds))
    if not len(full):
        return out
    least = np.empty((HASHES, len(full)), np.uint64)
    starts = bounds[:-1][full]
    for k in range(HASHES):
        least[k] = np.minimum.reduceat((values * FACTORS[k] + SHIFTS[k]) >> np.uint64(20), starts)
    bands = np.zeros((BANDS, len(full)), np.uint64)
    for k in range(ROWS):
        bands = words.mix(bands * np.uint64(3) + least[k::ROWS], 11)
    bands = words.mix(bands + np.arange(BANDS, dtype=np.uint64)[:, None], 12)
    out[full, :BANDS * 8] = np.ascontiguousarray(bands.T).view(np.uint8).reshape(len(full), -1)
    # The low byte: a minimum's high bits are the smaller, the more shingles there are.
    out[full, BANDS * 8:] = (least & np.uint64(0xFF)).astype(np.uint8).T
    return out


def set_keys(values: np.ndarray, bounds: np.ndarray) -> list[bytes | None]:
    """A 128-bit digest of each shingle set; None for an empty one."""
    raw = values.astype("<u8").tobytes()
    return [xxhash.xxh3_128_digest(raw[8 * a:8 * b]) if b > a else None
            for a, b in zip(bounds.tolist(), bounds[1:].tolist())]


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the text, and text. Id and digest together name a text."""
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select("doc_id", F.unhex(F.md5(text.cast("binary"))).alias("digest"), text.alias("text"))


def _hashed(docs: DataFrame) -> DataFrame:
    """doc_id, digest, key, n_shingles and sketch of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_slices(batch):
                values, bounds = words.shingles(data, offsets, SHINGLE)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(first, end - first) for c in ("doc_id", "digest")],
                     pa.array(set_keys(values, bounds), type=pa.binary()),
                     pa.array(np.diff(bounds).astype(np.int32)),
                     pa.array([row.tobytes() for row in sketches(values, bounds)], type=pa.binary())],
                    names=["doc_id", "digest", "key", "n_shingles", "sketch"])

    return _texts(docs).mapInArrow(
        run, f"doc_id {kind}, digest binary, key binary, n_shingles int, sketch binary")


# --- Buckets and blocks ----------------------------------------------------------------

def _band_hashes(sketch: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(
        F.substring(sketch, k * 8 + 1, F.lit(8)), k))


def _members(classes: DataFrame) -> DataFrame:
    """The classes of each bucket that has several, and the block of the bucket each is in."""
    banded = classes.select("key", "n_shingles", F.posexplode(_band_hashes(F.col("sketch")))
                            .alias("band", "bucket"))
    crowded = (banded.groupBy("band", "bucket")
               .agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("shingles"))
               .filter("n > 1")
               .select("band", "bucket", F.greatest(
                   F.ceil(F.col("n") / BLOCK_CLASSES),
                   F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks")))
    return (banded.select("band", "bucket", "key").join(staged(crowded, "ngram-buckets"), ["band", "bucket"])
            .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")))


MEMBER = ["key", "rep", "size", "sketch"]


def _block_pairs(classes: DataFrame) -> DataFrame:
    """Rows (band, bucket, low, high, members): the classes of one or of two blocks.

    Each block meets itself and each other block of its bucket once. A member carries the
    number of its block.
    """
    members = _members(classes).join(classes.select(*MEMBER), "key")
    blocks = (members.groupBy("band", "bucket", "blocks", "block")
              .agg(F.collect_list(F.struct("block", *MEMBER)).alias("members")))
    alone = blocks.filter("blocks = 1").select(
        "band", "bucket", F.col("block").alias("low"), F.col("block").alias("high"), "members")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = (blocks.filter("blocks > 1").withColumn("other", other)
              .groupBy("band", "bucket", F.least("block", "other").alias("low"),
                       F.greatest("block", "other").alias("high"))
              .agg(F.flatten(F.collect_list("members")).alias("members")))
    return alone.union(paired)


def surviving(sketch: np.ndarray, block: np.ndarray, band: int, low: int, high: int,
              least: dict[int, int]) -> np.ndarray:
    """Pairs (i, j) of rows that stay after Bayesian pruning and meet in this band first."""
    if low == high:
        one, two = np.triu_indices(len(block), 1)
    else:
        a, b = np.flatnonzero(block == low), np.flatnonzero(block == high)
        one, two = np.repeat(a, len(b)), np.tile(b, len(a))
    bands = np.ascontiguousarray(sketch[:, :BANDS * 8]).view("<u8")
    value = sketch[:, BANDS * 8:]
    agreed = np.zeros(len(one), np.int16)
    for n in range(STEP, HASHES + 1, STEP):
        agreed += (value[one, n - STEP:n] == value[two, n - STEP:n]).sum(axis=1, dtype=np.int16)
        stay = agreed >= least[n]
        one, two, agreed = one[stay], two[stay], agreed[stay]
    earlier = (bands[one, :band] == bands[two, :band]).any(axis=1)
    here = bands[one, band] == bands[two, band]
    return np.stack([one, two], axis=1)[here & ~earlier].astype("<u4")


def _rep(kind: str) -> str:
    """What stands for a class: the least id, one without an id last, and its text."""
    return f"struct<absent:boolean,doc_id:{kind},digest:binary>"


def _candidates(pairs: DataFrame, kind: str, threshold: float) -> DataFrame:
    """Of each block pair, the members in a pair that stays, and those pairs."""
    least = least_agreements(threshold)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                band, bucket, low, high = (batch.column(k)[row].as_py() for k in range(4))
                members = batch.column(4)[row].values
                sketch = np.frombuffer(b"".join(members.field("sketch").to_pylist()), np.uint8)
                found = surviving(sketch.reshape(-1, SKETCH_BYTES), members.field("block").to_numpy(),
                                  band, low, high, least)
                if not len(found):
                    continue
                used, index = np.unique(found, return_inverse=True)
                kept = members.take(pa.array(used))
                n = len(used)
                packed = index.reshape(found.shape).astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{band}:{bucket}:{low}:{high}"] * n), pa.array(np.arange(n, dtype=np.int32)),
                     kept.field("key"), kept.field("rep"), kept.field("size"),
                     pa.array([packed] + [None] * (n - 1), type=pa.binary())],
                    names=["task", "nth", "key", "rep", "size", "pairs"])

    return pairs.mapInArrow(
        run, f"task string, nth int, key binary, rep {_rep(kind)}, size long, pairs binary")


# --- Verification ----------------------------------------------------------------------

def verified(values: np.ndarray, bounds: np.ndarray, pairs: np.ndarray,
             threshold: float) -> np.ndarray:
    """Of the pairs of shingle sets, those whose Jaccard similarity reaches the threshold."""
    _, place = np.unique(values, return_inverse=True)
    marked = np.zeros(len(values) + 1, bool)
    sizes = np.diff(bounds)
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    out = np.zeros(len(pairs), bool)
    heads, at = np.unique(pairs[:, 0], return_index=True)
    for head, a, b in zip(heads.tolist(), at.tolist(), [*at[1:].tolist(), len(pairs)]):
        own = place[bounds[head]:bounds[head + 1]]
        marked[own] = True
        tails = pairs[a:b, 1]
        n = sizes[tails]
        inside = np.cumsum(n) - n
        member = place[np.repeat(bounds[:-1][tails] - inside, n) + np.arange(n.sum())]
        both = np.add.reduceat(marked[member].astype(np.int64), inside)
        # As integers, so that a similarity of exactly the threshold counts.
        out[a:b] = both * 1_000_000 >= round(threshold * 1_000_000) * (sizes[head] + n - both)
        marked[own] = False
    return pairs[out]


def roots(n: int, pairs: np.ndarray) -> np.ndarray:
    """For each of ``n`` rows, the least row that the pairs connect it with."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs.tolist():
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return np.array([find(x) for x in range(n)])


def _one_text_each(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """(text_id, text_digest, text), once for each id and digest.

    Only rows that are repeated, as the hashes of all rows have told, are reduced to one; each
    task does so before it sends them.
    """
    texts = _texts(docs).withColumnsRenamed({"doc_id": "text_id", "digest": "text_digest"})
    same = (texts["text_id"].eqNullSafe(repeated["doc_id"]) & (texts["text_digest"] == repeated["digest"]))
    return texts.join(repeated, same, "left_anti").union(
        texts.join(repeated, same, "left_semi").dropDuplicates(["text_id", "text_digest"]))


def _links(candidates: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Of each class in each block pair: (key, links, peer): documents it is linked to, and
    a class that it hangs together with."""
    # By id and digest, as rows without an id and rows that share one are no single text.
    same = candidates["rep.doc_id"].eqNullSafe(texts["text_id"]) & (candidates["rep.digest"] == texts["text_digest"])
    tasks = (candidates.join(texts, same)
             .groupBy("task").agg(F.collect_list(F.struct("nth", "key", "size", "text", "pairs"))
                                  .alias("members")).select("members"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                # A StructArray of a slice; its texts are read as a batch of their own.
                members = batch.column(0)[row].values
                nth, size = members.field("nth").to_numpy(), members.field("size").to_numpy()
                keys = members.field("key").to_pylist()
                packed = next(x for x in members.field("pairs").to_pylist() if x is not None)
                pairs = np.frombuffer(packed, "<u4").reshape(-1, 2).astype(np.int64)
                n = int(nth.max()) + 1
                sets, sizes, of = [None] * n, np.zeros(n, np.int64), [None] * n
                texts = pa.RecordBatch.from_arrays([members.field("text")], names=["text"])
                for first, end, data, offsets in text_slices(texts):
                    values, bounds = words.shingles(data, offsets, SHINGLE)
                    for k, key in enumerate(set_keys(values, bounds)):
                        if key == keys[first + k]:
                            at = int(nth[first + k])
                            sets[at] = values[bounds[k]:bounds[k + 1]]
                            sizes[at], of[at] = size[first + k], key
                bounds = np.append(0, np.cumsum([len(s) for s in sets]))
                found = verified(np.concatenate(sets), bounds, pairs, threshold)
                if not len(found):
                    continue
                links = (np.bincount(found[:, 0], sizes[found[:, 1]], n)
                         + np.bincount(found[:, 1], sizes[found[:, 0]], n)).astype(np.int64)
                root = roots(n, found)
                linked = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([of[k] for k in linked.tolist()], type=pa.binary()),
                     pa.array(links[linked]),
                     pa.array([of[k] for k in root[linked].tolist()], type=pa.binary())],
                    names=["key", "links", "peer"])

    return tasks.mapInArrow(run, "key binary, links long, peer binary")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of the nodes of (u, v) edges; nodes that hang together share a label.

    Large and small stars in turn: each node hands its greater, then its lesser neighbours
    on to the least one it knows. The edges become stars in a logarithmic number of rounds.
    Each round is written to the shared folder, and the driver sees two numbers of it.
    """
    def state(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    def star(edges: DataFrame, large: bool) -> DataFrame:
        # Staged, so that the join below shuffles both sides itself and Spark can split a
        # node with very many neighbours.
        least = staged(edges.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u"), F.least("u", "m").alias("m")), "component-least")
        with_least = edges.join(least, "u")
        if large:
            return with_least.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return (with_least.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                .union(least.filter("u != m").select("u", F.col("m").alias("v"))))

    def once(edges: DataFrame, name: str) -> DataFrame:
        return staged(edges.filter("u != v").select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)

    edges = once(edges, "component-edges")
    before = state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = once(star(once(star(both, True), "component-large"), False), "component-small")
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _grouped(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Every row's doc_id, digest, key, class, copy_of and n_links, where class and copy_of are
    the rows that stand for the group and for those with the same shingles; and the (doc_id,
    digest) of rows that are there several times."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    # Each text is hashed once; its row of 350 bytes is read from here on.
    rows = staged(_hashed(docs), "ngram-rows")
    repeated = staged(rows.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                      .select("doc_id", "digest"), "ngram-repeated")
    own = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "digest")
    # Sketches of copies are equal: one of each task that read some is shuffled.
    classes = staged(rows.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("sketch").alias("sketch"), F.min("n_shingles").alias("n_shingles"), F.min(own).alias("rep"),
        F.count(F.lit(1)).alias("size")), "ngram-classes")
    candidates = staged(_candidates(_block_pairs(classes), kind, threshold), "ngram-candidates")
    links = staged(_links(candidates, _one_text_each(docs, repeated), threshold), "ngram-links")
    numbered = components(links.select(F.col("key").alias("u"), F.col("peer").alias("v")))
    numbered = staged(numbered, "ngram-components")
    least = (numbered.join(classes.select(F.col("key").alias("node"), "rep"), "node")
             .groupBy("label").agg(F.min("rep").alias("class")))
    of_class = (links.groupBy("key").agg(F.sum("links").alias("links"))
                .join(numbered.withColumnRenamed("node", "key"), "key").join(least, "label")
                .select("key", "links", "class"))
    known = staged(
        classes.select("key", "rep", "size").join(of_class, "key", "left")
        .filter("links IS NOT NULL OR size > 1")
        .select("key", F.col("rep").alias("copy_of"), F.coalesce("class", "rep").alias("class"),
                (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "ngram-known")
    return rows.join(known, "key", "left").select(
        "doc_id", "digest", "key", F.coalesce("class", own).alias("class"), F.coalesce("copy_of", own).alias("copy_of"),
        F.coalesce("n_links", F.lit(0)).alias("n_links")), repeated

def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, copy_of and n_links of every row.

    Words are runs of letters and digits in lower case; a document's shingles are its
    distinct runs of five words, or all its words if it has fewer. Documents are linked when
    the Jaccard similarity of their shingles is at least ``threshold``. ``n_links`` counts
    the other documents that a document is linked to, ``class_id`` is the least id of all
    documents that hang together over links, ``copy_of`` the least id of those with the same
    shingles.

    A NULL or empty text, or one without words, has no shingles and no links, and is a class
    of its own. Repeated rows count as documents and are linked. Rows that share an id, and
    those without one, are told apart by their texts; a class id is NULL only where all ids of
    the class are. Other columns are ignored. An empty table gives no rows.
    """
    found = _grouped(docs, threshold)[0]
    return found.select("doc_id", F.col("class.doc_id").alias("class_id"), F.col("copy_of.doc_id").alias("copy_of"),
                        "n_links")


def without_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The table with one row of each group of near duplicates, all columns as they came.

    The row with the least id stays, one without an id only where no row of the group has
    one; of several with that id, the one whose text has the least digest, and of equal rows
    one. Rows without a word are no near duplicates of anything and stay.
    """
    found, repeated = _grouped(docs, threshold)
    own = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "digest")
    # Those that go are the fewer, so that the texts are shuffled only if even they are many.
    gone = staged(found.filter(F.col("key").isNotNull() & (F.col("class") != own))
                  .select(F.col("doc_id").alias("gone_id"), F.col("digest").alias("gone_digest")).distinct(), "near-gone")
    wordless = found.filter("key IS NULL").select(F.col("doc_id").alias("of_id"), F.col("digest").alias("of_digest"))
    again = staged(repeated.join(wordless, F.col("doc_id").eqNullSafe(F.col("of_id"))
                                 & (F.col("digest") == F.col("of_digest")), "left_anti"), "near-again")
    named = docs.select(F.struct("*").alias("__row"), F.col("doc_id").alias("__id"),
                        F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("__digest"))
    left = named.join(gone, F.col("__id").eqNullSafe(F.col("gone_id")) & (F.col("__digest") == F.col("gone_digest")),
                      "left_anti")
    same = F.col("__id").eqNullSafe(again["doc_id"]) & (F.col("__digest") == again["digest"])
    return left.join(again, same, "left_anti").select("__row.*").union(
        left.join(again, same, "left_semi").dropDuplicates(["__id", "__digest"]).select("__row.*"))
