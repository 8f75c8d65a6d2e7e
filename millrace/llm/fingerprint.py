"""Document fingerprints by consistent weighted sampling, in SQL expressions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.sinks.files import staged

SHINGLE = 5
# Samples of a fingerprint. Each is drawn from the slices of terms that a hash gives to its bin.
BINS = 128
SIGN_BITS, VALUE_BITS = 16, 38
BIN_SHIFT = SIGN_BITS + VALUE_BITS


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def shingles(text: Column, size: int = SHINGLE) -> Column:
    """Hashes of all runs of ``size`` words, sorted; of all words where there are fewer.

    Words are runs of letters and digits, in lower case.
    """
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")

    def runs(h: Column) -> Column:
        at = F.transform(F.sequence(F.lit(0), F.size(h) - size), lambda i: F.xxhash64(
            *[F.get(h, i + k) for k in range(size)]))
        return (F.when(F.size(h) >= size, F.sort_array(at))
                .when(F.size(h) > 0, F.array(F.xxhash64(h)))
                .otherwise(F.array().cast("array<bigint>")))

    return bound(F.transform(words, lambda word: F.xxhash64(word)), runs)


# 2 * 24 * ln 2: numbers of 24 bits are multiplied in place of fractions.
LOG_SCALE = 33.271064666877266


def _bits(word: Column, shift: int) -> Column:
    """24 of the word's bits, as a number above 0 and below 2**24."""
    return F.shiftrightunsigned(word, shift).bitwiseAND(F.lit((1 << 24) - 1)) + 0.5


def _draw(term: Column) -> Column:
    """The bin of a term of weight 1, its value and its sign, packed so that the least value
    comes first.

    With r and c from Gamma(2, 1) and b uniform, all from the term alone, the draw of weight w
    has t = floor(ln(w) / r + b), value = ln c - r (t - b + 1) and sign = hash of (term, t);
    ln(1) makes t = 0. The term with the least value wins its bin. Two texts agree there with
    a probability equal to the Jaccard similarity of the terms in the bin.

    The term is itself a hash: its low bits give the bin, others r, a further hash the rest.
    """
    more = F.xxhash64(term, F.lit(1))
    r = F.lit(LOG_SCALE) - F.log(_bits(term, 40) * _bits(term, 16))
    c = F.lit(LOG_SCALE) - F.log(_bits(more, 40) * _bits(more, 16))
    b = (more.bitwiseAND(F.lit(0xFFFF)) + 0.5) / 65536.0
    # The value lies between -120 and 8: 38 bits hold it to a part in 2**30.
    scaled = ((F.log(c) - r * (F.lit(1.0) - b) + 128.0) * float(1 << 30)).cast("long")
    sign = F.xxhash64(term, F.lit(0).cast("long")).bitwiseAND(F.lit((1 << SIGN_BITS) - 1))
    return (F.shiftleft(term.bitwiseAND(F.lit(BINS - 1)), BIN_SHIFT)
            + F.shiftleft(scaled, SIGN_BITS) + sign)


def slices(s: Column) -> Column:
    """The terms of sorted shingles, with a term of its own for each further occurrence.

    A shingle that occurs w times has w slices of weight 1: itself, and hashes of it with 1 to
    w - 1. The shared slices of two texts are the minima of their weights, and all slices the
    maxima, so the Jaccard similarity of the slices is the generalised one of the weights.
    """
    at = F.sequence(F.lit(0), F.size(s) - 1)
    firsts = F.filter(at, lambda i: (i == 0) | (F.get(s, i - 1) != F.get(s, i)))
    again = F.filter(at, lambda i: (i > 0) & (F.get(s, i - 1) == F.get(s, i)))
    # Up to the k-th repeat, at i, there are i - k firsts; the last of them began its run.
    return bound(firsts, lambda f: F.when(F.size(f) == F.size(s), s).otherwise(F.concat(
        F.transform(f, lambda i: F.get(s, i)),
        F.transform(again, lambda i, k: F.xxhash64(i - F.get(f, i - k - 1), F.get(s, i))))))


def fingerprint(text: Column) -> Column:
    """The samples of a text, for each bin that has a term: bin and sign in one number.

    The terms are the slices of the shingles, which are weighted by how often they occur.
    """
    def least(packed: Column) -> Column:
        first = F.filter(packed, lambda x, i: (i == 0) | (
            F.shiftright(F.get(packed, i - 1), BIN_SHIFT) != F.shiftright(x, BIN_SHIFT)))
        return F.transform(first, lambda x: (
            F.shiftleft(F.shiftright(x, BIN_SHIFT), SIGN_BITS)
            + x.bitwiseAND(F.lit((1 << SIGN_BITS) - 1))).cast("int"))

    return bound(shingles(text), lambda s: F.when(
        F.size(s) > 0, bound(F.sort_array(F.transform(slices(s), _draw)), least))
        .otherwise(F.array().cast("array<int>")))


def text_of(fingerprint_column: Column) -> Column:
    """The samples as a string, six hexadecimal digits for each: two of its bin, four its sign."""
    return F.array_join(F.transform(fingerprint_column, lambda x: F.lower(F.lpad(F.hex(x), 6, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Of the bins that either of two fingerprints has a sample in, the share that agree.

    Two fingerprints without any sample agree: 1.
    """
    def bins(x: Column) -> Column:
        return F.transform(x, lambda sample: F.shiftright(sample, SIGN_BITS))

    either = F.size(F.array_union(bins(a), bins(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


# --- Each text beside its edited text --------------------------------------------------

# Stands for a NULL id, below all others, in joins and sorting.
NO_ID = -(1 << 63)


def neighbours(docs: DataFrame) -> DataFrame:
    """For each distinct id: the next and the previous one, around the end, and how many
    characters the previous document wants of this one.

    Ids are dealt out by range and compared within a part; the parts' first and last ids, a
    row for each part, are compared among themselves.
    """
    half = F.floor(F.max(F.char_length("body")) / 2)
    dealt = staged(docs.groupBy("id").agg(half.alias("half")).repartitionByRange("id")
                   .withColumn("part", F.spark_partition_id()), "fingerprint-ids")
    inside = Window.partitionBy("part").orderBy("id")
    edges = dealt.groupBy("part").agg(
        F.min("id").alias("first"), F.max("id").alias("last"), F.max_by("half", "id").alias("last_half"))
    across, everything = Window.orderBy("part"), Window.partitionBy()
    edges = edges.select(
        "part",
        F.coalesce(F.lead("first").over(across), F.min("first").over(everything)).alias("then"),
        F.coalesce(F.lag("last").over(across), F.max("last").over(everything)).alias("before"),
        F.coalesce(F.lag("last_half").over(across),
                   F.max_by("last_half", "last").over(everything)).alias("half_before"))
    return staged(
        dealt.withColumns({"next_id": F.lead("id").over(inside), "previous_id": F.lag("id").over(inside),
                           "wanted": F.lag("half").over(inside)})
        .join(edges, "part")
        .select(F.col("id"), F.coalesce("next_id", "then").alias("next_id"),
                F.coalesce("previous_id", "before").alias("previous_id"),
                F.coalesce("wanted", "half_before").alias("wanted")), "fingerprint-neighbours")


def with_edited(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited text, the fingerprints of text, edited text and next text.

    The edited text has its last floor(n_chars / 2) code points replaced by as many, or all,
    of the first ones of the next document in ascending order of ids; after the last comes
    the first, and a single document is its own next. A NULL text is empty, and a NULL id
    lower than any other. Rows that share an id are each edited with the next id; of a next
    document's rows, the one with the least beginning counts. Other columns are ignored. An empty
    table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
                       F.coalesce("text", F.lit("")).alias("body"))
    made = rows.join(neighbours(rows), "id").select(
        "id", "previous_id", F.xxhash64("body").alias("hash"),
        F.substring("body", F.lit(1), F.col("wanted").cast("int")).alias("prefix"),
        fingerprint(F.col("body")).alias("samples"))
    # A text's samples are computed once, and sent to its own row and to the previous one.
    own, following = F.struct("hash", "samples"), F.struct("prefix", "samples")
    def row(to: str, mine: bool) -> Column:
        return F.struct(F.col(to).alias("id"), F.when(F.lit(mine), own).alias("own"),
                        F.when(F.lit(not mine), following).alias("following"))

    sent = made.select(F.inline(F.array(row("id", True), row("previous_id", False))))
    sent = sent.groupBy("id").agg(F.min("own").alias("own"), F.min("following").alias("following"))
    n = F.char_length("body")
    half = F.floor(n / 2).cast("int")
    # Rows that share an id have but one row of samples, which may be another text's.
    samples = F.when(F.col("own.hash") == F.xxhash64("body"), F.col("own.samples")).otherwise(
        fingerprint(F.col("body")))
    return (rows.join(sent, "id")
            .select("id", n.cast("long").alias("n_chars"), samples.alias("samples"),
                    F.concat(F.substring("body", F.lit(1), n - half),
                             F.substring("following.prefix", F.lit(1), half)).alias("edited"),
                    F.col("following.samples").alias("next_samples"))
            .select(F.nullif("id", F.lit(NO_ID)).cast(kind).alias("doc_id"), "n_chars", "edited",
                    "samples", fingerprint(F.col("edited")).alias("edited_samples"), "next_samples"))
