"""Exact duplicates by sorting content."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from millrace.sinks.files import staged

# Characters of a text that sampled splitters compare; whole texts never go to the driver.
SPLITTER_CHARS = 32
# Parts that the copies of one text are split into, so that no task gets all of them.
PARTS = 1024


def sorted_parts(docs: DataFrame, normalise=None, parts: int = PARTS) -> DataFrame:
    """doc_id, nth, part_size, text_sha256 of every row: its place, from the largest id, among
    the equal texts of its part, and their number.

    The normalised texts are dealt out by sampled splitters over their first characters, a
    digest and a part number that depends on the id, and sorted externally. Equal texts of
    one part are then neighbours, and the window compares neighbours in full.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", (normalise(text) if normalise else text).alias("body")).select(
        "doc_id", "body",
        F.substring("body", 1, SPLITTER_CHARS).alias("head"),
        F.xxhash64("body").alias("digest"),
        F.pmod(F.xxhash64("doc_id"), F.lit(parts)).alias("part"))
    equal = Window.partitionBy("head", "digest", "part", "body")
    in_order = equal.orderBy(F.desc_nulls_last("doc_id"))
    return keyed.repartitionByRange("head", "digest", "part").select(
        "doc_id", F.row_number().over(in_order).alias("nth"),
        F.count(F.lit(1)).over(equal).alias("part_size"),
        F.sha2("body", 256).alias("text_sha256"))


def content_groups(docs: DataFrame, normalise=None, parts: int = PARTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    The parts of a text, at most ``parts`` rows however many copies it has, are merged by
    SHA-256; see ``sorted_parts``.

    The row with the largest ``doc_id`` stays. ``normalise`` maps the text column to what is
    compared; without it nothing is changed. A NULL text counts as empty. A NULL id is less
    than any other. Of rows that also share their id, one stays. Other columns are ignored.
    An empty table gives no rows.
    """
    sorted_rows = staged(sorted_parts(docs, normalise, parts), "content-sorted")
    totals = staged(
        sorted_rows.filter("nth = 1").groupBy("text_sha256")
        .agg(F.max("doc_id").alias("keep_id"), F.sum("part_size").alias("group_size")),
        "content-groups")
    return sorted_rows.join(totals, "text_sha256").select(
        "doc_id", "keep_id", "group_size",
        ((F.col("nth") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256")


def kept_rows(docs: DataFrame, normalise=None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; see ``content_groups``.

    Rows that share both id and content stay or go together. Which row stays is told by the
    first row of each part of a text, so one narrow table is staged, a row for each text.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    kept = staged(sorted_parts(docs, normalise).filter("nth = 1")
                  .groupBy(F.col("text_sha256").alias("kept_sha256")).agg(F.max("doc_id").alias("kept_id")),
                  "content-kept")
    same = F.sha2(normalise(text) if normalise else text, 256) == kept["kept_sha256"]
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]) & same, "left_semi")
