"""BPE encoding that encodes text shared by documents once, and decoding.

Texts are cut where a rolling hash of their last bytes says so, so that equal passages give
equal chunks wherever they stand. Chunks of several documents form a dictionary, in which
each is encoded once; other chunks are encoded where they are read. A document joins the ids
of its chunks. Only the pieces that touch a join may differ from those of the whole text, so
the join is encoded again, from the last white space before it to the first one after it.
No piece of the tokenizer spans white space, so both ends agree exactly there; a chunk
without white space extends the join to the next.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.llm.arrow import only, schema_of, text_slices
from millrace.llm.encoder import Decoder, Encoder, decoder_of, encoder
from millrace.llm.words import powers
from millrace.sinks.files import staged

# Bytes that the rolling hash covers, its base, and the bits that are zero at a cut.
WINDOW = 32
BASE = 0x5851F42D4C957F2D
CUT_BITS = 10
MIN_BYTES, MAX_BYTES = 256, 16_384
# Bits of the filter that tells, in any task, whether a chunk may be shared. It is sent to
# all executors, and its size, 8 MB, does not depend on the data. With three bits a chunk it
# takes one chunk in ten for a shared one at 14 million shared chunks, some 20 GB of text that
# documents share, and one in two at 35 million; then more chunks pass through the dictionary,
# with equal results. ``shared_filter`` logs how full it is.
FILTER_BITS = 26
# Copies of a repeated row that one task makes.
COPIES_AT_ONCE = 1_000

log = logging.getLogger(__name__)

BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0D]] = True

def cuts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For each text of the buffer, its cut positions, first and last byte included.

    The hash at a position is a polynomial over the bytes before it, rolled by prefix sums
    modulo 2**64, and does not depend on where in the buffer the bytes stand.
    """
    size = len(data)
    found = np.zeros(0, np.int64)
    if size > WINDOW:
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, size), out=sums[1:])
        rolled = sums[WINDOW:-1] - sums[:-1 - WINDOW]
        rolled *= powers(pow(BASE, -1, 1 << 64), size)[:len(rolled)]
        found = np.flatnonzero((rolled >> np.uint64(64 - CUT_BITS)) == 0) + WINDOW
        found = found[(data[found] & 0xC0) != 0x80]  # a character stays whole
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        own, last = [a], a
        low, high = np.searchsorted(found, [a + WINDOW, b])
        for at in [*found[low:high].tolist(), b]:
            while at - last > MAX_BYTES:
                last += MAX_BYTES
                while data[last] & 0xC0 == 0x80:
                    last -= 1
                own.append(last)
            if at == b or (at - last >= MIN_BYTES and b - at >= MIN_BYTES):
                if at > last:
                    own.append(at)
                last = at
        out.append(np.array(own, np.int64))
    return out


class Cut(NamedTuple):
    """The chunks of some texts: bounds in the buffer, number of each text's, and digests."""
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray
    h1: np.ndarray
    h2: np.ndarray


def cut(data: np.ndarray, offsets: np.ndarray) -> Cut:
    positions = cuts(data, offsets)
    starts = np.concatenate([p[:-1] for p in positions])
    ends = np.concatenate([p[1:] for p in positions])
    raw = data.tobytes()
    digests = b"".join(xxhash.xxh3_128_digest(raw[a:b])
                       for a, b in zip(starts.tolist(), ends.tolist()))
    pair = np.frombuffer(digests, "<i8").reshape(-1, 2)
    counts = np.array([len(p) - 1 for p in positions], np.int64)
    return Cut(starts, ends, counts, pair[:, 0], pair[:, 1])


def _bits(h1, h2):
    mask = (1 << FILTER_BITS) - 1
    return h1 & mask, (h1 >> FILTER_BITS) & mask, h2 & mask


def chunk_digests(docs: DataFrame) -> DataFrame:
    """(h1, h2), once for each document and distinct chunk of it."""
    def run(batches):
        for batch in batches:
            for _, _, data, offsets in text_slices(batch):
                got = cut(data, offsets)
                of = np.repeat(np.arange(len(got.counts)), got.counts)
                order = np.lexsort((got.h2, got.h1, of))
                new = np.ones(len(order), bool)
                a, b = order[1:], order[:-1]
                new[1:] = (of[a] != of[b]) | (got.h1[a] != got.h1[b]) | (got.h2[a] != got.h2[b])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(got.h1[order[new]]), pa.array(got.h2[order[new]])],
                    names=["h1", "h2"])
    return only(docs, "text").mapInArrow(run, "h1 long, h2 long")


def shared_filter(docs: DataFrame) -> np.ndarray:
    """A Bloom filter of the chunks that at least two documents hold, 2**FILTER_BITS bits.

    What the driver gets is a row for each of its 64-bit words at most.
    """
    shared = (chunk_digests(docs).groupBy("h1", "h2").count().filter("count > 1")
              .select("h1", "h2"))
    mask = F.lit((1 << FILTER_BITS) - 1)
    bits = [F.col("h1").bitwiseAND(mask), F.shiftright("h1", FILTER_BITS).bitwiseAND(mask),
            F.col("h2").bitwiseAND(mask)]
    words = (shared.select(F.explode(F.array(*bits)).alias("bit"))
             .select(F.shiftright("bit", 6).alias("word"), (F.col("bit") % 64).cast("int").alias("at"))
             .groupBy("word").agg(F.expr("bit_or(shiftleft(1L, at))").alias("bits"))).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    log.info("%.1f %% of the filter of shared chunks is set", 100 * np.bitwise_count(out).sum() / (64 * len(out)))
    return out


def _may_be_shared(words: np.ndarray, got: Cut) -> np.ndarray:
    hit = np.ones(len(got.h1), bool)
    for bit in _bits(got.h1, got.h2):
        hit &= (words[bit >> 6] >> (bit & 63)) & 1 == 1
    return hit


# --- A chunk's ids, and how chunks are joined -----------------------------------------

class Piece(NamedTuple):
    """An encoded chunk: the ids between its first and last white space, and the text
    before and after; without white space, ``head`` is all of it and ``open`` is set."""
    ids: bytes
    head: bytes
    tail: bytes
    open: bool


PIECE = "ids binary, head binary, tail binary, open boolean"


def encode_chunks(enc: Encoder, data: np.ndarray, starts: np.ndarray,
                  ends: np.ndarray) -> list[Piece]:
    blanks = np.flatnonzero(BLANK[data])
    first = np.searchsorted(blanks, starts)
    last = np.searchsorted(blanks, ends) - 1
    has = first <= last
    inner_a, inner_b = starts.copy(), starts.copy()
    inner_a[has], inner_b[has] = blanks[first[has]], blanks[last[has]]
    raw = data.tobytes()
    bounds = np.append(0, np.cumsum(inner_b - inner_a))
    inner = np.frombuffer(
        b"".join(raw[a:b] for a, b in zip(inner_a.tolist(), inner_b.tolist())), np.uint8)
    ids, at = enc.encode(inner, bounds)
    out = []
    for k, (a, b, c, d) in enumerate(zip(starts.tolist(), inner_a.tolist(), inner_b.tolist(),
                                         ends.tolist())):
        if has[k]:
            out.append(Piece(ids[at[k]:at[k + 1]].astype("<u4").tobytes(), raw[a:b], raw[c:d], False))
        else:
            out.append(Piece(b"", raw[a:d], b"", True))
    return out


def join_pieces(enc: Encoder, documents: list[list[Piece]]) -> list[bytes]:
    """The ids of each document, its joins encoded again; all joins of a batch at once."""
    joins: list[bytes] = []
    plans: list[list] = []
    for pieces in documents:
        plan, pending = [], b""
        for piece in pieces:
            pending += piece.head
            if piece.open:
                continue
            plan.append(len(joins))
            joins.append(pending)
            plan.append(piece.ids)
            pending = piece.tail
        plan.append(len(joins))
        joins.append(pending)
        plans.append(plan)
    data = np.frombuffer(b"".join(joins), np.uint8)
    ids, at = enc.encode(data, np.append(0, np.cumsum([len(j) for j in joins])))
    ids = ids.astype("<u4")
    return [b"".join(part if isinstance(part, bytes) else ids[at[part]:at[part + 1]].tobytes()
                     for part in plan) for plan in plans]


# --- Over a table ----------------------------------------------------------------------

def _per_text(shared: np.ndarray, got: Cut) -> np.ndarray:
    of = np.repeat(np.arange(len(got.counts)), got.counts)
    return np.bincount(of, weights=shared, minlength=len(got.counts)) > 0


def _mapped(docs: DataFrame, work: Callable, schema: T.StructType, words) -> DataFrame:
    names = schema.names

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            doc_ids = batch.column("doc_id")
            for first, end, data, offsets in text_slices(batch):
                got = cut(data, offsets)
                hit = _may_be_shared(words.value, got)
                for columns in work(doc_ids.slice(first, end - first), data, offsets, got, hit):
                    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
                    yield pa.RecordBatch.from_arrays(
                        [a.cast(id_type) if n == "doc_id" else a for n, a in zip(names, arrays)],
                        names=names)

    return only(docs, "doc_id", "text").mapInArrow(run, schema)


def _dictionary(docs: DataFrame, tokenizer: str, words) -> DataFrame:
    """Every chunk that may be shared, encoded once: h1, h2 and the columns of a piece."""
    def texts(doc_ids, data, offsets, got, hit):
        at = np.flatnonzero(hit)
        order = at[np.lexsort((got.h2[at], got.h1[at]))]
        new = np.ones(len(order), bool)
        a, b = order[1:], order[:-1]
        new[1:] = (got.h1[a] != got.h1[b]) | (got.h2[a] != got.h2[b])
        one = order[new]
        raw = data.tobytes()
        yield (got.h1[one], got.h2[one],
               pa.array([raw[x:y] for x, y in zip(got.starts[one].tolist(), got.ends[one].tolist())],
                        type=pa.binary()))

    chunks = (_mapped(docs, texts, schema_of("h1 long, h2 long, chunk binary"), words)
              .groupBy("h1", "h2").agg(F.first("chunk").alias("chunk")))

    def run(batches):
        for batch in batches:
            enc = encoder(tokenizer)
            as_text = batch.set_column(2, "text", batch.column("chunk").cast(pa.large_binary())
                                       .view(pa.large_string()))
            for first, end, data, offsets in text_slices(as_text):
                pieces = encode_chunks(enc, data, offsets[:-1], offsets[1:])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first),
                     batch.column(1).slice(first, end - first),
                     *piece_arrays(pieces)], names=["h1", "h2", "ids", "head", "tail", "open"])

    return chunks.mapInArrow(run, f"h1 long, h2 long, {PIECE}")


def piece_arrays(pieces: list[Piece]) -> list[pa.Array]:
    columns = list(zip(*pieces)) or [(), (), (), ()]
    return [*(pa.array(c, type=pa.binary()) for c in columns[:3]), pa.array(columns[3], type=pa.bool_())]


def _results(ids: list[bytes], decoder: Decoder | None) -> list[pa.Array]:
    """The ids as a column, and with a decoder their texts as another."""
    out = [pa.array(ids, type=pa.binary())]
    if decoder is not None:
        texts = [decoder.decode(np.frombuffer(x, "<u4")) for x in ids]
        out.append(pa.array(texts, type=pa.binary()).cast(pa.string()))
    return out


def _alone(docs: DataFrame, tokenizer: str, words, schema: T.StructType) -> DataFrame:
    """The ids of the documents that hold no chunk which may be shared."""
    decoded = "text" in schema.names

    def work(doc_ids, data, offsets, got, hit):
        enc = encoder(tokenizer)
        rows = np.flatnonzero(~_per_text(hit, got))
        of = np.repeat(np.arange(len(got.counts)), got.counts)
        mine = np.isin(of, rows)
        pieces = encode_chunks(enc, data, got.starts[mine], got.ends[mine])
        bounds = np.append(0, np.cumsum(got.counts[rows])).tolist()
        ids = join_pieces(enc, [pieces[a:b] for a, b in zip(bounds, bounds[1:])]) if len(rows) else []
        yield doc_ids.take(pa.array(rows)), *_results(ids, decoder_of(tokenizer) if decoded else None)
    return _mapped(docs, work, schema, words)


def _together(docs: DataFrame, tokenizer: str, words, schema: T.StructType) -> DataFrame:
    """The ids of the other documents, from the dictionary and chunks of their own."""
    def work(doc_ids, data, offsets, got, hit):
        enc = encoder(tokenizer)
        of = np.repeat(np.arange(len(got.counts)), got.counts)
        part = np.arange(len(of)) - np.repeat(np.cumsum(got.counts) - got.counts, got.counts)
        mine = _per_text(hit, got)[of]
        raw = data.tobytes()
        texts = {int(k): xxhash.xxh3_128_digest(raw[offsets[k]:offsets[k + 1]])
                 for k in np.unique(of[mine])}
        own = np.flatnonzero(mine & ~hit)
        refs = np.flatnonzero(mine & hit)
        pieces = piece_arrays(encode_chunks(enc, data, got.starts[own], got.ends[own]))
        empty = pa.nulls(len(refs), pa.binary())
        for rows, columns, known in ((own, pieces, False),
                                     (refs, [empty] * 3 + [pa.nulls(len(refs), pa.bool_())], True)):
            h1, h2 = pa.array(got.h1[rows]), pa.array(got.h2[rows])
            if not known:
                h1 = h2 = pa.nulls(len(rows), pa.int64())
            yield (doc_ids.take(pa.array(of[rows])),
                   pa.array([texts[k] for k in of[rows].tolist()], type=pa.binary()),
                   pa.array(part[rows].astype(np.int32)), h1, h2, *columns)

    id_field = schema["doc_id"]
    parts = _mapped(docs, work, T.StructType([id_field] + schema_of(
        f"text_hash binary, part int, h1 long, h2 long, {PIECE}").fields), words)
    columns = ["ids", "head", "tail", "open"]
    found = (parts.filter("h1 IS NOT NULL").drop(*columns)
             .join(_dictionary(docs, tokenizer, words), ["h1", "h2"])
             .select("doc_id", "text_hash", "part", *columns))
    own = parts.filter("h1 IS NULL").select("doc_id", "text_hash", "part", *columns)
    # A group is the pieces of one document, as repeated rows are encoded elsewhere.
    grouped = (own.union(found).groupBy("doc_id", "text_hash")
               .agg(F.collect_list(F.struct("part", *columns)).alias("pieces")))

    decoded, names = "text" in schema.names, schema.names

    def assemble(batches):
        for batch in batches:
            enc = encoder(tokenizer)
            decoder = decoder_of(tokenizer) if decoded else None
            for n in range(0, len(batch), 64):
                some = batch.slice(n, 64)
                documents = []
                for pieces in some.column("pieces").to_pylist():
                    by_part = {p["part"]: Piece(p["ids"], p["head"], p["tail"], p["open"])
                               for p in pieces}
                    documents.append([by_part[k] for k in sorted(by_part)])
                ids = join_pieces(enc, documents)
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), *_results(ids, decoder)], names=names)

    return grouped.select("doc_id", "pieces").mapInArrow(assemble, schema)


def _repeated(docs: DataFrame) -> DataFrame:
    """(same_id, same_text, copies) of rows that are there several times, by a digest."""
    same = docs.select(F.col("doc_id").alias("same_id"), _digest().alias("same_text"))
    return staged(same.groupBy("same_id", "same_text").agg(F.count(F.lit(1)).alias("copies"))
                  .filter("copies > 1"), "bpe-repeated")


def _digest():
    return F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))


def _copied(docs: DataFrame, repeated: DataFrame, tokenizer: str, schema: T.StructType) -> DataFrame:
    """The ids of repeated rows: each is encoded once, as a whole, and then multiplied by
    several tasks, however often it is there."""
    decoded = "text" in schema.names
    same = docs["doc_id"].eqNullSafe(repeated["same_id"]) & (_digest() == repeated["same_text"])
    once = docs.join(repeated, same).dropDuplicates(["same_id", "same_text"]).select("doc_id", "text", "copies")

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            enc = encoder(tokenizer)
            for first, end, data, offsets in text_slices(batch):
                ids, at = enc.encode(data, offsets)
                each = [ids[a:b].astype("<u4").tobytes() for a, b in zip(at.tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, end - first),
                     *_results(each, decoder_of(tokenizer) if decoded else None),
                     batch.column("copies").slice(first, end - first)], names=[*schema.names, "copies"])

    coded = once.mapInArrow(run, T.StructType([*schema.fields, T.StructField("copies", T.LongType())]))
    parts = F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / COPIES_AT_ONCE)))
    left = F.least(F.col("copies") - F.col("part") * COPIES_AT_ONCE, F.lit(COPIES_AT_ONCE))
    return (coded.select(*schema.names, "copies", parts.alias("part")).repartition("doc_id", "part")
            .select(*schema.names, F.explode(F.sequence(F.lit(1), left)).alias("copy")).select(*schema.names))


def encode(docs: DataFrame, tokenizer: str, decoded: bool = False) -> DataFrame:
    """doc_id and ids of every row, as the tokenizers library encodes the text without
    special tokens of its own; ids are little-endian unsigned 32-bit integers.

    With ``decoded``, also the ``text`` that the ids decode to, as ``decode`` gives it, made
    by the same worker.

    Equal for any division into chunks. A NULL or empty text has no ids. Repeated rows and
    NULL ids give a row each. Other columns are ignored. An empty table gives no rows.
    """
    if not encoder(tokenizer).by_pieces:
        raise ValueError("joins are repaired at white space, which this tokenizer may span")
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("ids", T.BinaryType())]
                          + [T.StructField("text", T.StringType())] * decoded)
    rows = only(docs, "doc_id", "text")
    repeated = _repeated(rows)
    copied = None
    if not repeated.isEmpty():
        copied = _copied(rows, repeated, tokenizer, schema)
        rows = rows.join(repeated, rows["doc_id"].eqNullSafe(repeated["same_id"])
                         & (_digest() == repeated["same_text"]), "left_anti")
    words = docs.sparkSession.sparkContext.broadcast(shared_filter(rows))
    coded = _alone(rows, tokenizer, words, schema).union(_together(rows, tokenizer, words, schema))
    return coded if copied is None else coded.union(copied)


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """The rows with a column ``text``: the ids decoded, special tokens included."""
    def run(batches):
        decoder = decoder_of(tokenizer)
        for batch in batches:
            texts = [decoder.decode(np.frombuffer(ids.as_py() or b"", "<u4"))
                     for ids in batch.column("ids")]
            yield batch.append_column("text", pa.array(texts, type=pa.binary()).cast(pa.string()))
    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields,
                                                 T.StructField("text", T.StringType())]))
