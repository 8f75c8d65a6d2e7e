"""Passages of benchmark items in training documents, in DataFrame operations only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.line_dedup import LOWER, UPPER
from millrace.sinks.files import staged

WINDOW = 10
# A word, in lower-cased text and in text as it stands.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Bytes of windows up to which they are broadcast, and what a row takes besides its words.
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 64


def lowered(text: Column) -> Column:
    """The text with A-Z in lower case and no other letter changed."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The lower-cased words of a text; none where it is NULL."""
    return F.coalesce(F.regexp_extract_all(lowered(text), F.lit(WORD), F.lit(0)),
                      F.array().cast("array<string>"))


def _phrase(of: Column, start: Column, length: Column) -> Column:
    """Consecutive words as one text; no word holds a space, so equal texts are equal words."""
    return F.array_join(F.slice(of, start + 1, length), " ")


def _window_hashes(of: Column, lengths: list[int]) -> Column:
    """(length, start, hash) of every run of as many words, for each of the lengths."""
    def runs(h: Column, length: int) -> Column:
        return F.when(F.size(h) >= length, F.transform(
            F.sequence(F.lit(0), F.size(h) - length),
            lambda i: F.struct(F.lit(length).alias("length"), i.alias("start"), F.xxhash64(
                *[F.get(h, i + k) for k in range(length)]).alias("hash"))))
    empty = F.array().cast("array<struct<length:int,start:int,hash:bigint>>")
    # Bound as a variable, so that a word is hashed once and not for each window that has it.
    return F.get(F.transform(F.array(F.transform(of, lambda word: F.xxhash64(word))), lambda h: F.concat(
        *[F.coalesce(runs(h, length), empty) for length in lengths])), 0)


def item_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, length, phrase) of the windows of each item: every run of ``size`` words, or
    all words of an item that has fewer. Items without words have none. Items that share an
    id, and those without one, count as one item each time."""
    items = benchmark.select("item_id", words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(size))
    each = items.select("item_id", "words", length.alias("length"), F.explode(
        F.sequence(F.lit(0), F.size("words") - length)).alias("start"))
    return each.select("item_id", "length", _phrase(F.col("words"), F.col("start"), F.col("length"))
                       .alias("phrase")).distinct()


def text_key(text: Column) -> Column:
    """What stands for a text: equal texts have the same passages."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def scanned(docs: DataFrame, windows: DataFrame, names: list[str],
            broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One pass over the documents: of each, a row with the named columns in ``carried``, text_key
    and n_words, and ``head`` set; and a row (text_key, length, start, phrase) for each window that occurs.
    A row may be both.

    The hashes of all windows of a document are looked up in the hash set of the items'
    windows, and what is found is compared word by word. The set is broadcast if its size,
    which is counted first, is within ``broadcast_bytes``; beyond that both sides are
    shuffled by hash. Texts that several documents share are found once for each.
    """
    lengths = sorted(row["length"] for row in windows.select("length").distinct().collect()) or [WINDOW]
    # The phrase is as long as its length says, so the hash of its own length is looked up.
    known = reduce(DataFrame.unionByName, [
        windows.filter(F.col("length") == n).select("length", "phrase").distinct().withColumn(
            "hash", F.get(_window_hashes(F.split("phrase", " "), [n]), 0)["hash"])
        for n in lengths])
    known = staged(known, "benchmark-windows").withColumnsRenamed(
        {"length": "known_length", "phrase": "known_phrase", "hash": "known_hash"})
    size = known.agg(F.sum(F.octet_length("known_phrase") + ROW_BYTES)).first()[0] or 0
    # In a struct, as their names may be those of the columns here.
    carried = F.struct(F.lit(True).alias("__any"), *[F.col(name) for name in names]).alias("carried")
    texts = docs.select(carried, text_key(F.col("text")).alias("text_key"), words(F.col("text")).alias("words"))
    hashed = texts.select("carried", "text_key", "words", _window_hashes(F.col("words"), lengths).alias("hashes"))
    # An outer generator, as Spark would compute the input of another one once more to filter
    # it, and so that a document without a window has a row as well.
    places = hashed.select("carried", "text_key", "words", F.inline_outer("hashes"))
    phrase = _phrase(F.col("words"), F.col("start"), F.col("length"))
    same = (F.col("hash") == F.col("known_hash")) & (F.col("length") == F.col("known_length"))
    # The shortest windows come first, so this is the first row of each document.
    head = F.col("hash").isNull() | ((F.col("start") == 0) & (F.col("length") == lengths[0]))
    out = [F.when(head, F.col("carried")).alias("carried"), head.alias("head"), "text_key",
           F.when(head, F.size("words")).alias("n_words"), "length", "start"]
    if size <= broadcast_bytes:
        # No equality, which would become a key of the join and be computed for every window.
        equal = phrase.between(F.col("known_phrase"), F.col("known_phrase"))
        found = places.join(F.broadcast(known), same & equal, "left")
        return found.filter(head | F.col("known_phrase").isNotNull()).select(*out, F.col("known_phrase").alias("phrase"))
    # The words of a document must not travel with each of its windows.
    slim = places.filter("hash IS NOT NULL").select("text_key", "length", "start", "hash", phrase.alias("phrase"))
    found = slim.join(known, same & (F.col("phrase") == F.col("known_phrase")))
    return places.filter(head).select(*out, F.lit(None).cast("string").alias("phrase")).unionByName(
        found.select("text_key", "length", "start", F.col("known_phrase").alias("phrase")).withColumn(
            "head", F.lit(False)), allowMissingColumns=True)


def _merged(positions: Column) -> Column:
    """Runs of consecutive numbers among sorted ones, as (start, end) with the end excluded."""
    def runs(p: Column) -> Column:
        last = F.size(p) - 1
        begins = F.filter(p, lambda x, i: (i == 0) | (F.get(p, i - 1) != x - 1))
        ends = F.filter(p, lambda x, i: (i == last) | (F.get(p, i + 1) != x + 1))
        return F.zip_with(begins, ends, lambda a, b: F.struct(a.alias("start"), (b + 1).alias("end")))
    return F.get(F.transform(F.array(positions), runs), 0)


def passages(found: DataFrame, windows: DataFrame) -> DataFrame:
    """One row per contaminated text, of the rows of ``scanned``: text_key, spans, n_hit, items.

    ``spans`` are the (start, end) of the runs of words that lie in an occurrence, ``n_hit``
    how many words those are, ``items`` the sorted ids, as text, of the items found. An item
    without an id is the empty text.
    """
    found = found.filter("phrase IS NOT NULL")
    covered = (found.select("text_key", F.struct("start", "length").alias("at")).groupBy("text_key")
               .agg(F.collect_set("at").alias("at"))
               .select("text_key", F.array_sort(F.array_distinct(F.flatten(F.transform("at", lambda s: F.sequence(
                   s["start"], s["start"] + s["length"] - 1))))).alias("positions")))
    name = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")
    items = (found.select("text_key", "phrase").distinct()
             .join(windows.select("phrase", name), "phrase").select("text_key", "item").distinct()
             .groupBy("text_key").agg(F.array_sort(F.collect_list("item")).alias("items")))
    return covered.join(items, "text_key").select(
        "text_key", _merged(F.col("positions")).alias("spans"),
        F.size("positions").cast("long").alias("n_hit"), "items")


def report(docs: DataFrame, benchmark: DataFrame, names: list[str], size: int = WINDOW,
           broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The named columns of every document with text_key, n_words, n_hit, spans, items and
    contaminated; the texts are read once and not shuffled.

    Words are runs of ASCII letters, digits and all characters beyond ASCII, with A-Z in
    lower case. A document word is hit if it lies in any occurrence of a window: of ``size``
    consecutive words of an item, or all words of a shorter item. NULL and empty texts have
    no words, and no item is found in them; spans and items are then empty, as they are for
    an empty benchmark. Rows with equal ids are told apart by their texts.
    """
    windows = staged(item_windows(benchmark, size), "item-windows")
    found = staged(scanned(docs, windows, names, broadcast_bytes), "occurrences")
    known = staged(passages(found, windows), "passages").withColumnRenamed("text_key", "__key")
    rows = found.filter("head").select("carried", "text_key", F.col("n_words").cast("long").alias("n_words"))
    return rows.join(known, F.col("text_key") == F.col("__key"), "left").select(
        *[F.col("carried").getField(name).alias(name) for name in names], "text_key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("__key").isNotNull().alias("contaminated"))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW,
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Every document with what ``report`` has of its text beside its columns, of which those
    with the names of results are replaced. Texts are shuffled only if those with a hit are
    too many to be broadcast."""
    found = report(docs.select("text"), benchmark, [], size, broadcast_bytes).dropDuplicates(["text_key"])
    hit = staged(found.filter("contaminated"), "contaminated").withColumnsRenamed(
        {c: f"__{c}" for c in ("text_key", "n_words", "n_hit", "spans", "items", "contaminated")})
    counted = F.size(F.regexp_extract_all("text", F.lit(WORD_ANY_CASE), F.lit(0)))
    # Before the join, so that texts which nobody asks for are not shuffled.
    keyed = docs.withColumns({"__own": text_key(F.col("text")), "n_words": F.when(
        F.col("text").isNull(), 0).otherwise(counted).cast("long")})
    joined = keyed.join(hit, F.col("__own") == F.col("__text_key"), "left")
    return joined.withColumns({
        "n_hit": F.coalesce("__n_hit", F.lit(0).cast("long")),
        "spans": F.coalesce("__spans", F.array().cast("array<struct<start:int,end:int>>")),
        "items": F.coalesce("__items", F.array().cast("array<string>")),
        "contaminated": F.col("__contaminated").isNotNull()}).drop(
            "__own", "__text_key", "__n_words", "__n_hit", "__spans", "__items", "__contaminated")


def without_documents(docs: DataFrame, benchmark: DataFrame, share: float = 0.0,
                      size: int = WINDOW) -> DataFrame:
    """The documents of whose words at most ``share`` are hit; as they came."""
    marked = contamination(docs.select(F.struct("*").alias("__row"), "text"), benchmark, size)
    return marked.filter(F.col("n_hit") <= share * F.col("n_words")).select("__row.*")


def without_spans(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """All documents, without the words that are hit and what follows each up to the next
    word. Texts without a hit, NULL among them, are as they came."""
    columns = [F.col(f"__row.`{c}`").alias(c) if c != "text" else F.when(
        F.col("contaminated"), _without("text", "spans")).otherwise(F.col("text")).alias(c)
        for c in docs.columns]
    return contamination(docs.select(F.struct("*").alias("__row"), "text"), benchmark, size).select(*columns)


def _without(text: str, spans: str) -> Column:
    """The text without the words of the spans: what is before the first word, and the pieces
    between spans, each a word with all that follows it."""
    def kept(pair: Column) -> Column:
        pieces, cut = pair["pieces"], pair["cut"]
        starts = F.concat(F.array(F.lit(0)), cut["end"])
        ends = F.concat(cut["start"], F.array(F.size(pieces)))
        return F.array_join(F.flatten(F.zip_with(
            starts, ends, lambda a, b: F.slice(pieces, a + 1, F.greatest(b - a, F.lit(0))))), "")
    other = WORD_ANY_CASE.replace("[^", "[").replace("]+", "]*")
    pieces = F.regexp_extract_all(text, F.lit(WORD_ANY_CASE + other), F.lit(0))
    lead = F.regexp_extract(text, f"^({other})", 1)
    pair = F.struct(pieces.alias("pieces"), F.col(spans).alias("cut"))
    return F.concat(lead, F.get(F.transform(F.array(pair), kept), 0))
