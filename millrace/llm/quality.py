"""A quality score: logistic regression on hashed word n-grams, fitted by FTRL."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.llm.arrow import only, text_slices
from millrace.llm.words import mix, span_hashes

HASH_BITS = 18
# Labelled rows that the model is fitted on at most, those with the least hash of their id.
FIT_ROWS = 6_000
EPOCHS = 3
# Follow the regularised leader: step size, its offset, and the two penalties.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.1, 0.5
THRESHOLD = 0.3

SPACE, LETTER, DIGIT, SIGN = range(4)
LOWER_CASE, CAPITALISED, UPPER_CASE, MIXED, NUMBER, REPEATED = range(1, 7)


def _tables():
    kind = np.full(256, SIGN, np.uint8)
    kind[:0x21] = SPACE
    kind[0x30:0x3A] = DIGIT
    kind[0x41:0x5B] = kind[0x61:0x7B] = LETTER
    kind[0x80:] = LETTER
    lower = np.arange(256, dtype=np.uint8)
    lower[0x41:0x5B] += 0x20
    return kind, lower


KIND, LOWER = _tables()


@dataclass
class Grams:
    """Buckets of the n-grams of some texts, those of a text together, and their bounds."""
    buckets: np.ndarray
    bounds: np.ndarray


def grams(data: np.ndarray, offsets: np.ndarray, bits: int = HASH_BITS) -> Grams:
    """Hashed word n-grams of each text: words and pairs of words, and one to three shapes.

    A word is a run of letters, of digits or of other signs. The shape of a run of letters is
    its case, or that it repeats the word before; a run of signs is its own shape. Shapes say
    what the words of a text look like where the words themselves were never seen.
    """
    texts = len(offsets) - 1
    size = len(data)
    if not size:
        return Grams(np.zeros(0, np.int64), np.zeros(texts + 1, np.int64))
    kind = KIND[data]
    cut = np.ones(size, bool)
    cut[1:] = kind[1:] != kind[:-1]
    cut[offsets[:-1][offsets[:-1] < size]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], size)
    kept = kind[starts] != SPACE
    starts, ends = starts[kept], ends[kept]
    kinds = kind[starts]
    word = mix(span_hashes(LOWER[data], starts, ends), 1)
    of = np.searchsorted(offsets, starts, side="right") - 1

    capital = (data >= 0x41) & (data <= 0x5A)
    capital[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    capitals = np.append(0, np.cumsum(capital))
    letters = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    n_capital, n_letter = capitals[ends] - capitals[starts], letters[ends] - letters[starts]
    # A capital outside ASCII shows at its second byte.
    first = capital[starts] | capital[np.minimum(starts + 1, size - 1)] & (data[starts] == 0xC3)
    shape = np.full(len(starts), MIXED, np.uint64)
    shape[n_capital == 0] = LOWER_CASE
    shape[(n_capital == 1) & first] = CAPITALISED
    shape[(n_capital == n_letter) & (n_letter > 1)] = UPPER_CASE
    shape[kinds == DIGIT] = NUMBER
    signs = kinds == SIGN
    shape[signs] = word[signs] | np.uint64(1 << 32)
    is_letter = np.flatnonzero(kinds == LETTER)
    again = (word[is_letter[1:]] == word[is_letter[:-1]]) & (of[is_letter[1:]] == of[is_letter[:-1]])
    shape[is_letter[1:][again]] = REPEATED
    shape = mix(shape, 2)

    def before(values: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros_like(values)
        out[n:] = np.where(of[n:] == of[:-n], values[:-n], 0) if n < len(values) else out[n:]
        return out

    one, two = before(shape, 1), before(shape, 2)
    pair = mix(shape * np.uint64(3) + one, 5)
    columns = np.stack([
        word, mix(word * np.uint64(3) + before(word, 1), 3), mix(shape, 4), pair,
        mix(pair * np.uint64(5) + two, 6)], axis=1)
    buckets = (columns >> np.uint64(64 - bits)).astype(np.int64).ravel()
    return Grams(buckets, np.searchsorted(starts, offsets) * columns.shape[1])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """A score from 0 to 1 for each text: the sparse dot product of its n-gram counts,
        scaled to length one, with the weights."""
        got = grams(data, offsets, int(np.log2(len(self.weights))))
        out = np.full(len(offsets) - 1, self.bias)
        for k, (a, b) in enumerate(zip(got.bounds.tolist(), got.bounds[1:].tolist())):
            if b > a:
                index, value = features(got.buckets[a:b])
                out[k] += float(value @ self.weights[index])
        return _sigmoid(out)


def features(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, value): one plus the logarithm of the count, scaled to length one."""
    index, count = np.unique(buckets, return_counts=True)
    value = 1 + np.log(count)
    return index, value / np.sqrt(value @ value)


def fit(texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, bits: int = HASH_BITS,
        epochs: int = EPOCHS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1,
        l2: float = L2) -> Model:
    """FTRL-proximal over (buckets, values) of texts, in an order that the labels do not set."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    z0 = n0 = 0.0
    rate = float(labels.mean()) if len(labels) else 0.5
    rate = min(max(rate, 1e-3), 1 - 1e-3)
    base = float(np.log(rate / (1 - rate)))

    def weights_of(z, n):
        return -np.sign(z) * np.maximum(np.abs(z) - l1, 0) / ((beta + np.sqrt(n)) / alpha + l2)

    order = np.random.default_rng(7)
    for _ in range(epochs if len(labels) else 0):
        for k in order.permutation(len(labels)).tolist():
            index, value = texts[k]
            w = weights_of(z[index], n[index])
            w0 = -z0 / ((beta + np.sqrt(n0)) / alpha + l2)
            error = _sigmoid(base + w0 + float(value @ w)) - labels[k]
            g = error * value
            sigma = (np.sqrt(n[index] + g * g) - np.sqrt(n[index])) / alpha
            z[index] += g - sigma * w
            n[index] += g * g
            z0 += error - (np.sqrt(n0 + error * error) - np.sqrt(n0)) / alpha * w0
            n0 += error * error
    return Model(weights_of(z, n), base - z0 / ((beta + np.sqrt(n0)) / alpha + l2))


# --- Over tables -----------------------------------------------------------------------

def train(docs: DataFrame, labels: DataFrame, label: str = "quality",
          rows: int = FIT_ROWS) -> Model:
    """A model of ``label``, 0 or 1, from at most ``rows`` labelled documents.

    The labels with the least hash of their id are taken, whatever else the tables hold, and of
    the documents that share an id the one whose text has the least digest. Repeated labels
    count once; rows without a label or an id teach nothing. With no labelled row at all, every
    score is 0.5.
    """
    chosen = (labels.select(F.col("doc_id").alias("labelled_id"), F.col(label).alias("label"))
              .filter("labelled_id IS NOT NULL AND label IN (0, 1)").distinct()
              .orderBy(F.xxhash64("labelled_id"), "labelled_id", "label").limit(rows))
    # At most ``rows`` pairs of an id and a label, so small enough for every executor.
    texts = (docs.select("doc_id", "text")
             .join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id"))
             .select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("label").cast("int").alias("label"))
             .groupBy("doc_id", "label").agg(F.min_by("text", F.md5(F.col("text").cast("binary"))).alias("text")))

    def run(batches):
        for batch in batches:
            for first, end, data, offsets in text_slices(batch):
                got = grams(data, offsets)
                found = [features(got.buckets[a:b]) for a, b in zip(got.bounds, got.bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, end - first).cast(pa.string()),
                     batch.column("label").slice(first, end - first),
                     pa.array([f[0].astype("<i4").tobytes() for f in found], type=pa.binary()),
                     pa.array([f[1].astype("<f4").tobytes() for f in found], type=pa.binary())],
                    names=["doc", "label", "buckets", "counts"])

    got = texts.mapInArrow(run, "doc string, label int, buckets binary, counts binary").toArrow()
    # The order in which rows arrive must not matter to the fit.
    got = got.sort_by([("doc", "ascending"), ("label", "ascending"), ("buckets", "ascending")])
    pairs = [(np.frombuffer(a.as_py(), "<i4"), np.frombuffer(b.as_py(), "<f4").astype(float))
             for a, b in zip(got["buckets"], got["counts"])]
    return fit(pairs, got["label"].to_numpy().astype(float))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score, from 0 to 1, of every row.

    A NULL or empty text gets the score of no n-gram at all, which is the share of good rows
    as the model has it. Repeated rows and NULL ids give a row each. Other columns are
    ignored. An empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for first, end, data, offsets in text_slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, end - first),
                     pa.array(held.value.scores(data, offsets))], names=["doc_id", "score"])

    return only(docs, "doc_id", "text").mapInArrow(run, T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("score", T.DoubleType())]))


def accepted(docs: DataFrame, model: Model, least: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is at least ``least``."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for first, end, data, offsets in text_slices(batch):
                good = held.value.scores(data, offsets) >= least
                yield batch.slice(first, end - first).filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
