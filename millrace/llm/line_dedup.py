"""Lines that recur across documents, as per-document bitmaps of what to keep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.sinks.files import staged

# What is stripped from a line, and the letters that are lower-cased.
BLANKS = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

MIN_CHARS = 40
MIN_DOCS = 5
# Parts that the lines of one key are split into, so that no task gets all of them.
PARTS = 1024


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z in lower case."""
    stripped = F.trim(line, F.lit(BLANKS))
    return F.translate(stripped, UPPER, LOWER)


def _text(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"], F.lit(""))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def drop_positions(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                   parts: int = PARTS) -> DataFrame:
    """(doc_id, text_hash, position) of each line that goes.

    The hashes of the lines are dealt out by range, with a part number that depends on the
    id, and sorted by document and position; a running window streams over them, flags the
    first line of each document and counts documents. Parts of a key are then merged.
    """
    text = _text(docs)
    lines = (docs.select("doc_id", F.xxhash64(text).alias("text_hash"),
                         F.posexplode(_lines(text)).alias("position", "line"))
             .select("doc_id", "text_hash", "position", line_key(F.col("line")).alias("key"))
             .filter(F.char_length("key") >= min_chars)
             .select("doc_id", "text_hash", "position",
                     F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
                     F.pmod(F.xxhash64("doc_id"), F.lit(parts)).alias("part")))
    same = Window.partitionBy("h1", "h2", "part")
    in_order = same.orderBy(F.desc_nulls_last("doc_id"), "position", "text_hash")
    before = F.lag(F.struct("doc_id")).over(in_order)
    streamed = staged(
        lines.repartitionByRange("h1", "h2", "part")
        .select("*", F.row_number().over(in_order).alias("nth"),
                (~before.eqNullSafe(F.struct("doc_id"))).cast("int").alias("opens"))
        .select("doc_id", "text_hash", "position", "h1", "h2", "nth",
                F.sum("opens").over(same).alias("part_docs")), "lines-streamed")
    frequent = staged(
        streamed.filter("nth = 1").groupBy("h1", "h2")
        .agg(F.sum("part_docs").alias("n_docs"), F.max("doc_id").alias("keeper"))
        .filter(F.col("n_docs") >= min_docs).select("h1", "h2", "keeper"), "lines-frequent")
    return (streamed.join(frequent, ["h1", "h2"]).filter("NOT (doc_id <=> keeper)")
            .select("doc_id", "text_hash", "position"))


def _runs(positions: Column, n_lines: Column) -> Column:
    """Run lengths, kept and dropped in turn, starting with kept, from sorted positions."""
    def bits(p: Column) -> Column:
        last = F.size(p) - 1
        begins = F.filter(p, lambda x, i: (i == 0) | (F.get(p, i - 1) != x - 1))
        ends = F.filter(p, lambda x, i: (i == last) | (F.get(p, i + 1) != x + 1))
        edges = F.flatten(F.zip_with(begins, ends, lambda a, b: F.array(a, b + 1)))
        edges = F.concat(F.array(F.lit(0)), edges, F.array(n_lines))
        return F.zip_with(F.slice(edges, 2, F.size(edges) - 1),
                          F.slice(edges, 1, F.size(edges) - 1), lambda a, b: a - b)
    # Bound as a variable, so that the sorted positions are not computed for each line.
    return F.get(F.transform(F.array(F.array_sort(positions)), bits), 0)


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS,
                 min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per document that loses lines: doc_id, text_hash, n_dropped, keep_bitmap.

    A line's key is the line stripped of blanks with A-Z in lower case. Keys of at least
    ``min_chars`` code points found in at least ``min_docs`` documents lose all their lines
    except in the largest ``doc_id`` that holds them. ``keep_bitmap`` has run lengths, kept
    and dropped in turn, over the document's lines.

    A NULL or empty text is one empty line, which no key covers. Rows that share an id count
    as one document; a NULL id is a document below all others. Other columns are ignored.
    """
    dropped = (drop_positions(docs, min_chars, min_docs).groupBy("doc_id", "text_hash")
               .agg(F.collect_set("position").alias("positions"))
               .select("doc_id", "text_hash", F.size("positions").cast("long").alias("n_dropped"),
                       "positions"))
    # The last run reaches to the end of the document, however many lines that is.
    return staged(dropped.select("doc_id", "text_hash", "n_dropped",
                                 _runs(F.col("positions"), F.lit(2**31 - 1)).alias("keep_bitmap")),
                  "line-bitmaps")


def kept_text(text: Column, bitmap: Column) -> Column:
    """The text without the lines that the bitmap drops; all of it where there is no bitmap."""
    def join(pair: Column) -> Column:
        lines, runs = pair["lines"], pair["runs"]
        starts = F.aggregate(
            F.slice(runs, 1, F.size(runs) - 1),
            F.array(F.lit(1)), lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n)))
        kept = F.filter(F.arrays_zip(starts.alias("start"), runs.alias("length")),
                        lambda run, i: (i % 2 == 0) & (run["length"] > 0))
        return F.array_join(F.flatten(F.transform(
            kept, lambda run: F.slice(lines, run["start"], run["length"]))), "\n")
    pair = F.struct(_lines(text).alias("lines"), bitmap.alias("runs"))
    return F.when(bitmap.isNull(), text).otherwise(F.get(F.transform(F.array(pair), join), 0))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_text of every row; see ``keep_bitmaps``."""
    bitmaps = keep_bitmaps(docs, min_chars, min_docs).withColumnsRenamed(
        {"doc_id": "of_id", "text_hash": "of_hash"})
    rows = docs.select("doc_id", _text(docs).alias("body"))
    joined = rows.join(
        bitmaps, rows["doc_id"].eqNullSafe(bitmaps["of_id"])
        & (F.xxhash64(rows["body"]) == bitmaps["of_hash"]), "left")
    breaks = F.char_length("body") - F.char_length(F.replace(F.col("body"), F.lit("\n"), F.lit("")))
    return joined.select(
        "doc_id", (breaks + 1).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"),
        kept_text(F.col("body"), F.col("keep_bitmap")).alias("kept_text"))
