"""The language of a text: a convolutional network over its bytes, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.llm.arrow import only, text_slices
from millrace.sinks.files import staged

# Bytes of a window, sizes of the filters, filters of each size, numbers that a byte becomes.
LENGTH = 256
WIDTHS = (2, 3, 4, 5)
FILTERS = 8
EMBEDDING = 8
# Documents of each language that the network is fitted on, about: fewer of each beyond so many
# languages, down to the least number. Windows of a document.
FIT_DOCS, FIT_LANGUAGES, FIT_LEAST, FIT_WINDOWS = 1_000, 256, 32, 4
STEPS, BATCH, RATE = 800, 128, 5e-3
# Windows that are evaluated at a time, few enough for the processor's cache.
AT_ONCE = 16
UNDETERMINED = "und"


def plain_bytes(data: np.ndarray) -> np.ndarray:
    """Capital letters of ASCII and Latin-1 in lower case, as writing in capitals is no language."""
    out = data.copy()
    out[(data >= 0x41) & (data <= 0x5A)] += 0x20
    if len(out) > 1:
        second = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
        out[1:][second] += 0x20
    return out


def windows(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH):
    """(windows, text of each, bytes in each): all bytes of all texts, padded with zeros."""
    sizes = np.diff(offsets)
    counts = -(-sizes // length)
    of = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = offsets[:-1][of] + nth * length
    filled = np.minimum(offsets[1:][of] - starts, length)
    padded = np.append(plain_bytes(data), np.zeros(length, np.uint8))
    out = padded[starts[:, None] + np.arange(length)]
    out[np.arange(length) >= filled[:, None]] = 0
    return out, of, filled


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # (EMBEDDING, 256)
    filters: list[np.ndarray]  # for each width (width, FILTERS, EMBEDDING)
    offsets: list[np.ndarray]
    dense: np.ndarray  # (languages, filters of all widths)
    bias: np.ndarray

    def pooled(self, batch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greatest response of each filter in each window, and where it is."""
        n, length = batch.shape
        x = np.ascontiguousarray(self.embedding[:, batch.ravel()])
        tops, places = [], []
        for w, kernel, offset in zip(WIDTHS, self.filters, self.offsets):
            parts = (kernel.reshape(-1, EMBEDDING) @ x).reshape(w, FILTERS, n, length)
            span = length - w + 1
            out = parts[0, :, :, :span].copy()
            for j in range(1, w):
                out += parts[j, :, :, j:j + span]
            place = out.argmax(axis=2)
            tops.append(np.take_along_axis(out, place[:, :, None], 2)[:, :, 0] + offset[:, None])
            places.append(place)
        return np.concatenate(tops).T, np.concatenate(places).T

    def kernel(self) -> np.ndarray:
        """All filters as one matrix over the embeddings of a byte and those after it."""
        out = np.zeros((len(WIDTHS), FILTERS, max(WIDTHS), EMBEDDING), np.float32)
        for k, (w, own) in enumerate(zip(WIDTHS, self.filters)):
            out[k, :, :w] = own.transpose(1, 0, 2)
        return out.reshape(len(WIDTHS) * FILTERS, -1)

    def probabilities(self, batch: np.ndarray) -> np.ndarray:
        """As ``pooled`` and the dense layer give them, with one product for all filters."""
        out = np.empty((len(batch), len(self.languages)), np.float32)
        kernel, offset = self.kernel(), np.concatenate(self.offsets)[:, None]
        for a in range(0, len(batch), AT_ONCE):
            some = batch[a:a + AT_ONCE]
            n, length = some.shape
            x = np.zeros((max(WIDTHS), EMBEDDING, n * length), np.float32)
            x[0] = self.embedding[:, some.ravel()]
            for j in range(1, max(WIDTHS)):
                x[j, :, :-j] = x[0, :, j:]
            got = (kernel @ x.reshape(len(kernel.T), -1)).reshape(len(WIDTHS), FILTERS, n, length)
            top = np.concatenate([g[:, :, :length - w + 1].max(axis=2) for w, g in zip(WIDTHS, got)])
            out[a:a + AT_ONCE] = softmax(np.maximum(top + offset, 0).T @ self.dense.T + self.bias)
        return out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(batch: np.ndarray, labels: np.ndarray, languages: list[str], steps: int = STEPS,
        seed: int = 11) -> Network:
    """Fit on windows by Adam; part of them cut short, as short texts have little to go by."""
    rng = np.random.default_rng(seed)

    def start(*shape: int) -> np.ndarray:
        return rng.normal(0, 1 / np.sqrt(shape[-1]), shape).astype(np.float32)

    net = Network(languages, start(EMBEDDING, 256) * 4, [start(w, FILTERS, EMBEDDING) for w in WIDTHS],
                  [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
                  start(len(languages), FILTERS * len(WIDTHS)), np.zeros(len(languages), np.float32))
    params = [net.embedding, *net.filters, *net.offsets, net.dense, net.bias]
    first, second = ([np.zeros_like(p) for p in params] for _ in range(2))
    # Each language equally often, however many windows it has.
    share = 1 / np.bincount(labels, minlength=len(languages))[labels]
    share /= share.sum()
    for step in range(1, steps + 1):
        chosen = rng.choice(len(batch), BATCH, p=share)
        x, y = batch[chosen].copy(), labels[chosen]
        cut = np.where(rng.random(BATCH) < 0.4, rng.integers(12, LENGTH, BATCH), LENGTH)
        x[np.arange(LENGTH) >= cut[:, None]] = 0
        raw, place = net.pooled(x)
        top = np.maximum(raw, 0)
        error = softmax(top @ net.dense.T + net.bias)
        error[np.arange(BATCH), y] -= 1
        error /= BATCH
        back = (error @ net.dense) * (raw > 0)
        grads = [np.zeros_like(net.embedding), *[np.zeros_like(k) for k in net.filters],
                 *[back[:, k * FILTERS:(k + 1) * FILTERS].sum(axis=0) for k in range(len(WIDTHS))],
                 error.T @ top, error.sum(axis=0)]
        rows = np.arange(BATCH)[:, None]
        for k, w in enumerate(WIDTHS):
            own = slice(k * FILTERS, (k + 1) * FILTERS)
            g = back[:, own]
            for j in range(w):
                byte = x[rows, place[:, own] + j]
                seen = net.embedding[:, byte]  # (EMBEDDING, BATCH, FILTERS)
                grads[1 + k][j] = np.einsum("bf,ebf->fe", g, seen)
                flow = g[:, :, None] * net.filters[k][j][None]
                for e in range(EMBEDDING):
                    grads[0][e] += np.bincount(byte.ravel(), flow[:, :, e].ravel(), 256)
        rate = RATE * min(1, 2 * (1 - step / (steps + 1)))
        for p, g, m, v in zip(params, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    folded = data | 0x20
    ascii_letter = np.append(0, np.cumsum((folded >= 0x61) & (folded <= 0x7A) & (data < 0x80)))
    out = ascii_letter[offsets[1:]] > ascii_letter[offsets[:-1]]
    for k in np.flatnonzero(~out).tolist():
        text = data[offsets[k]:offsets[k + 1]].tobytes().decode("utf-8", "replace")
        out[k] = any(c.isalpha() for c in text)
    return out


# --- Over tables -----------------------------------------------------------------------

def train(docs: DataFrame, per_language: int = FIT_DOCS, label: str = "lang") -> Network | None:
    """A network for the values of ``label``, from a sample of about ``per_language``
    documents of each, chosen by a hash of the id, and some windows of each document.

    Every value is learned. Beyond ``FIT_LANGUAGES`` values, documents of each are fewer, and
    steps of the fit more, in proportion. Rows without a label, an id or a text teach nothing;
    without any row that does, there is no network.
    """
    known = docs.select("doc_id", "text", F.col(label).alias("language")).filter(
        "language IS NOT NULL AND text != '' AND doc_id IS NOT NULL")
    counts = staged(known.groupBy("language").agg(F.count(F.lit(1)).alias("n")), "language-counts")
    found = counts.count()
    if not found:
        return None
    scale = 1 << 20
    many = max(1, found / FIT_LANGUAGES)
    each = max(min(FIT_LEAST, per_language), int(per_language / many))
    bound = counts.select("language", F.least(F.lit(scale), F.ceil(F.lit(scale * each) / F.col("n"))).alias("bound"))
    sample = (known.join(bound, "language")
              .filter(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < F.col("bound"))
              .select(F.col("doc_id").cast("string").alias("doc"), "language", "text"))

    def run(batches):
        for batch in batches:
            for first, end, data, offsets in text_slices(batch):
                got, of, _ = windows(data, offsets)
                counts = np.bincount(of, minlength=end - first)
                nth = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
                step = np.maximum(1, -(-counts // FIT_WINDOWS))[of]
                taken = np.flatnonzero(nth % step == 0)
                rows = pa.array(of[taken] + first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").take(rows), pa.array(nth[taken]),
                     batch.column("language").take(rows),
                     pa.array([got[k].tobytes() for k in taken.tolist()], type=pa.binary())],
                    names=["doc", "nth", "language", "window"])

    got = (sample.mapInArrow(run, "doc string, nth long, language string, window binary").toArrow()
           .sort_by([("doc", "ascending"), ("nth", "ascending"), ("window", "ascending")]))
    names = got["language"].to_pylist()
    languages = sorted(set(names))
    if not languages:
        return None
    place = {name: k for k, name in enumerate(languages)}
    batch = np.frombuffer(b"".join(x.as_py() for x in got["window"]), np.uint8).reshape(-1, LENGTH)
    return fit(batch, np.array([place[name] for name in names]), languages, int(STEPS * many))


def identified(net: Network | None, data: np.ndarray,
               offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(language, score) of each text of a buffer."""
    n = len(offsets) - 1
    names, scores = np.full(n, UNDETERMINED, object), np.zeros(n)
    if net is not None and len(data):
        got, of, filled = windows(data, offsets)
        weighed = net.probabilities(got).astype(float) * filled[:, None]
        sums = np.stack([np.bincount(of, column, n) for column in weighed.T], axis=1)
        sums /= np.maximum(np.diff(offsets), 1)[:, None]
        best = sums.argmax(axis=1)
        told = has_letter(data, offsets)
        names[told] = np.array(net.languages, object)[best[told]]
        scores[told] = np.clip(sums[np.arange(n), best][told], 0, 1)
    return names, scores


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, lang_pred and score, from 0 to 1, of every row.

    All windows of a text count, by the bytes in them. A NULL or empty text, a text without
    a letter, and every text where nothing was learned, is ``und`` with score 0. Repeated
    rows and NULL ids give a row each. Other columns are ignored. An empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches):
        for batch in batches:
            for first, end, data, offsets in text_slices(batch):
                names, scores = identified(held.value, data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, end - first),
                     pa.array(names.tolist(), type=pa.string()), pa.array(scores)],
                    names=["doc_id", "lang_pred", "score"])

    return only(docs, "doc_id", "text").mapInArrow(run, T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def floor(network: Network | None, certainty: float) -> float:
    """The score that lies so far, from 0 to 1, between an even guess among the languages of
    the network and 1."""
    guess = 1 / len(network.languages) if network else 0.0
    return guess + certainty * (1 - guess)


def accepted(docs: DataFrame, network: Network | None, least: float) -> DataFrame:
    """The rows of ``docs``, with all their columns, in a language told with a score of at
    least ``least``. Where nothing was learned, all rows stay."""
    if network is None:
        return docs
    held = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches):
        for batch in batches:
            for first, end, data, offsets in text_slices(batch):
                names, scores = identified(held.value, data, offsets)
                good = (names != UNDETERMINED) & (scores >= least)
                yield batch.slice(first, end - first).filter(pa.array(good.astype(bool)))

    return docs.mapInArrow(run, docs.schema)
