"""The classifiers' scores against plain loops over bytes and words."""

import math
import re
from collections import Counter

import numpy as np
from odd_rows import ODD
from pyspark.sql import functions as F

from millrace.llm import language, quality, words

TEXTS = [t for _, t in ODD if t and len(t) < 2_000] + [
    "The Quick brown FOX, the the 12 foxes!!! été Été ÉTÉ été", "a", "A b C\n\n-- -- 3.14", "é", "ab" * 300,
    "Zürich ist größer als Äpfel, 2024.", "x y z " * 100]


def buffers(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw]))


def plain_probabilities(net, window):
    """One window by four loops: positions, filters, bytes of a filter, numbers of a byte."""
    pooled = []
    for w, kernel, offset in zip(language.WIDTHS, net.filters, net.offsets):
        for f in range(language.FILTERS):
            best = max(sum(float(kernel[j][f] @ net.embedding[:, window[p + j]]) for j in range(w))
                       for p in range(len(window) - w + 1))
            pooled.append(max(best + float(offset[f]), 0.0))
    logits = [sum(float(a) * b for a, b in zip(row, pooled)) + float(bias) for row, bias in zip(net.dense, net.bias)]
    parts = [math.exp(v - max(logits)) for v in logits]
    return [part / sum(parts) for part in parts]


def some_network(rng):
    def draw(*shape):
        return rng.normal(0, 0.5, shape).astype(np.float32)
    return language.Network(
        ["a", "b", "c"], draw(language.EMBEDDING, 256),
        [draw(w, language.FILTERS, language.EMBEDDING) for w in language.WIDTHS],
        [draw(language.FILTERS) for _ in language.WIDTHS], draw(3, language.FILTERS * len(language.WIDTHS)), draw(3))


def test_convolution():
    rng = np.random.default_rng(1)
    net = some_network(rng)
    got, of, filled = language.windows(*buffers(TEXTS))
    chosen = np.unique(np.concatenate([rng.integers(0, len(got), 12), [0, len(got) - 1]]))
    want = [plain_probabilities(net, got[k]) for k in chosen.tolist()]
    assert np.allclose(net.probabilities(got)[chosen], want, atol=1e-4)
    raw, _ = net.pooled(got)
    assert np.allclose(language.softmax(np.maximum(raw, 0) @ net.dense.T + net.bias), net.probabilities(got), atol=1e-4)


def test_language_of_a_text_is_that_of_its_bytes():
    """Windows count by the bytes in them; all bytes of a text are in one."""
    net = some_network(np.random.default_rng(2))
    data, offsets = buffers(TEXTS)
    names, scores = language.identified(net, data, offsets)
    for k, text in enumerate(TEXTS):
        raw = language.plain_bytes(np.frombuffer(text.encode(), np.uint8))
        total = np.zeros(3)
        for at in range(0, len(raw), language.LENGTH):
            part = raw[at:at + language.LENGTH]
            window = np.zeros(language.LENGTH, np.uint8)
            window[:len(part)] = part
            total += net.probabilities(window[None])[0] * len(part)
        total /= len(raw)
        if any(c.isalpha() for c in text):
            assert names[k] == net.languages[int(total.argmax())] and abs(scores[k] - total.max()) < 1e-5
        else:
            assert names[k] == language.UNDETERMINED and scores[k] == 0


MASK = (1 << 64) - 1
PIECE = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\x00-\x20A-Za-z0-9\x80-\xff]+")


def mixed(x, salt):
    x = (x + salt * 0x9E3779B97F4A7C15) * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 31
    return x * 0x94D049BB133111EB & MASK


def plain_buckets(text, bits):
    """Buckets of words, pairs of words and one to three shapes, one word after the other."""
    out, former = [], [(0, 0), (0, 0)]  # (word, shape) of the two before
    last_letters = None
    for piece in PIECE.findall(text.encode()):
        lower = bytes(b + 32 if 65 <= b <= 90 else b for b in piece)
        word = mixed(sum((b + 1) * pow(words.BASE, k, 1 << 64) for k, b in enumerate(lower)) & MASK, 1)
        if piece[:1].isdigit():
            shape = quality.NUMBER
        elif re.match(rb"[A-Za-z\x80-\xff]", piece):
            capitals = sum(65 <= b <= 90 for b in piece) + sum(
                a == 0xC3 and 0x80 <= b <= 0x9E for a, b in zip(piece, piece[1:]))
            letters = sum(b & 0xC0 != 0x80 for b in piece)
            first = 65 <= piece[0] <= 90 or piece[0] == 0xC3 and len(piece) > 1 and 0x80 <= piece[1] <= 0x9E
            shape = (quality.UPPER_CASE if capitals == letters and letters > 1 else
                     quality.CAPITALISED if capitals == 1 and first else
                     quality.LOWER_CASE if capitals == 0 else quality.MIXED)
            if word == last_letters:
                shape = quality.REPEATED
            last_letters = word
        else:
            shape = word | 1 << 32
        shape = mixed(shape, 2)
        pair = mixed(shape * 3 + former[0][1] & MASK, 5)
        columns = [word, mixed(word * 3 + former[0][0] & MASK, 3), mixed(shape, 4), pair,
                   mixed(pair * 5 + former[1][1] & MASK, 6)]
        out += [c >> (64 - bits) for c in columns]
        former = [(word, shape), former[0]]
    return out


def test_sparse_dot_products():
    rng = np.random.default_rng(3)
    model = quality.Model(rng.normal(0, 1, 1 << 12), 0.3)
    scores = model.scores(*buffers(TEXTS))
    for text, got in zip(TEXTS, scores.tolist()):
        counted = Counter(plain_buckets(text, 12))
        values = {bucket: 1 + math.log(n) for bucket, n in counted.items()}
        length = math.sqrt(sum(v * v for v in values.values())) or 1
        total = 0.3 + sum(v / length * model.weights[bucket] for bucket, v in values.items())
        assert abs(got - 1 / (1 + math.exp(-total))) < 1e-9


def test_rows_that_share_an_id_teach_once(spark):
    """The fit is bounded by its parameter, whatever the number of rows of an id."""
    docs = spark.range(3000).selectExpr("CAST(id % 3 AS BIGINT) AS doc_id", "concat('good words ', id % 3) AS text")
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1), (2, 1), (None, 1)], "doc_id long, quality int")
    once = docs.groupBy("doc_id").agg(F.min("text").alias("text"))
    a, b = quality.train(docs, labels), quality.train(once, labels.distinct())
    assert np.allclose(a.weights, b.weights) and a.bias == b.bias
    assert np.array_equal(quality.train(docs.limit(0), labels).weights, np.zeros(1 << quality.HASH_BITS))
