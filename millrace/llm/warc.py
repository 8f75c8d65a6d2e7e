"""WARC records of pages, and an audit of replicas by Merkle trees over their offsets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.sinks.files import staged

# Records of an archive file, on average, and the time that all records are stamped with.
RECORDS = 4_096
STAMP = "2024-01-01T00:00:00Z"
# Bytes that a node above the records covers, and how many nodes the next one covers.
RANGE, FAN = 1 << 16, 16


def _hex_number(digest: Column, start: int, digits: int) -> Column:
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("long")


def records(pages: DataFrame, per_file: int = RECORDS) -> DataFrame:
    """page_id, file and record of every row.

    A record is a WARC/1.1 ``resource`` with the page's HTML as its block. Pages are dealt out
    to files by a digest of their id, ``per_file`` to a file on average; those without an id
    by a digest of the record. A NULL page or address is empty. Rows that share an id are
    records of their own. Other columns are ignored.
    """
    files = max(1, -(-pages.count() // per_file))
    name = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    block = F.coalesce(F.col("html"), F.lit(""))
    ident = F.md5(F.concat(name, F.lit(" "), F.coalesce("url", F.lit(""))))
    uuid = F.concat_ws("-", *[F.substring(ident, a, n) for a, n in
                              ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce("url", F.lit("")),
        F.lit(f"\r\nWARC-Date: {STAMP}\r\nWARC-Record-ID: <urn:uuid:"), uuid,
        F.lit(">\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block, F.lit("\r\n\r\n"))
    dealt = F.md5(F.when(F.col("page_id").isNull(), F.col("record")).otherwise(name))
    return pages.select("page_id", record.alias("record")).select(
        "page_id", (_hex_number(dealt, 1, 8) % files).alias("file"), "record")


def hashed(made: DataFrame) -> DataFrame:
    """page_id, file, length and digest of each record; what is shuffled in place of records."""
    return made.select("page_id", "file", F.octet_length("record").cast("long").alias("length"),
                       F.sha2("record", 256).alias("digest"))


def manifest(rows: DataFrame) -> DataFrame:
    """The rows of ``hashed``, further columns among them, with the offset of each record.

    Records stand in a file in the order of ids, and of digests where ids are equal.
    """
    in_file = Window.partitionBy("file").orderBy("page_id", "digest")
    upto = F.sum("length").over(in_file.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("offset", upto - F.col("length"))


def write_archive(made: DataFrame, path: str) -> None:
    """The records as text files under ``path/file=…``, each where the manifest says."""
    (made.withColumn("digest", F.sha2("record", 256)).repartition("file")
     .sortWithinPartitions("file", "page_id", "digest")
     .select("file", F.expr("substring(record, 1, char_length(record) - 4)").alias("value"))
     .write.partitionBy("file").option("lineSep", "\r\n\r\n").text(path))


def leaves(rows: DataFrame) -> DataFrame:
    """file, offset, length and digest of each record: what a tree is made of."""
    return rows.select("file", "offset", "length", "digest")


def stored_leaves(spark: SparkSession, path: str, known: DataFrame) -> DataFrame:
    """The leaves of an archive as it is stored: the bytes found where the manifest says.

    Each file is read once, by the task that gets it, and cut at the manifest's offsets. A
    record of which no byte is left, or whose file is gone, is no leaf. Bytes beyond the last
    record are a leaf of their own. A file holds less than 2 GB.
    """
    places = F.array_sort(F.collect_list(F.struct("offset", "length")))
    per_file = known.groupBy("file").agg(places.alias("places"),
                                         F.max(F.col("offset") + F.col("length")).alias("end"))
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(
        F.regexp_extract("path", r"/file=(\d+)/", 1).cast("long").alias("stored"), "content")
    every = F.concat("places", F.array(F.struct(
        F.col("end").alias("offset"), (F.octet_length("content") - F.col("end")).alias("length"))))
    cut = (per_file.join(found, F.col("file") == F.col("stored"))
           .select("file", "content", F.explode(every).alias("at"))
           .select("file", F.col("at.offset").alias("offset"), F.expr(
               "substring(content, CAST(at.offset + 1 AS INT), CAST(greatest(at.length, 0) AS INT))").alias("bytes")))
    return cut.filter(F.octet_length("bytes") > 0).select(
        "file", "offset", F.octet_length("bytes").cast("long").alias("length"),
        F.sha2("bytes", 256).alias("digest"))


def audit_stored(known: DataFrame, path: str) -> DataFrame:
    """file, offset and status of what is wrong with a stored archive; see ``audit``.

    Bytes that were put in or taken out move all that follows in their file, so the records
    behind them are ``changed`` as well; ``missing`` ones lie beyond the end of their file.
    """
    return audit(leaves(known), staged(stored_leaves(known.sparkSession, path, known), "stored-leaves"))


def tree(records_of: DataFrame, levels: int) -> list[DataFrame]:
    """The nodes (file, node, digest) of each level, records first, whole files last.

    A record's node is its offset. Above, a node covers a range of offsets, ``FAN`` times as
    long as one below, and its digest is that of its children's nodes and digests in order;
    whatever is missing, moved or too much in a range changes the digests above it and none
    beside it. Rows that share
    file and offset are one node, in which repeated rows count once.
    """
    record = F.concat_ws(":", F.col("offset"), F.col("length"), F.col("digest"))
    level = records_of.select("file", F.col("offset").alias("node"), record.alias("digest")).distinct()
    level = level.groupBy("file", "node").agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list("digest")), "|"), 256).alias("digest"))
    out = [level]
    for k in range(levels + 1):
        below = out[-1]
        node = F.lit(0) if k == levels else F.floor(F.col("node") / (RANGE if k == 0 else FAN))
        child = F.struct("node", "digest")
        level = below.select("file", node.cast("long").alias("above"), child.alias("child")).groupBy(
            "file", "above").agg(F.sha2(F.array_join(F.transform(
                F.array_sort(F.collect_list("child")),
                lambda c: F.concat_ws(":", c["node"].cast("string"), c["digest"])), "|"), 256).alias("digest"))
        out.append(level.withColumnRenamed("above", "node"))
    return [staged(df, "merkle-level") for df in out]


def _above(k: int, levels: int) -> Column:
    """The node above a node of level ``k``."""
    if k == levels:
        return F.lit(0).cast("long")
    return F.floor(F.col("node") / (RANGE if k == 0 else FAN)).cast("long")


def differing(one: list[DataFrame], two: list[DataFrame]) -> DataFrame:
    """file, offset of the records in which two trees differ, found from the roots down.

    Only the children of differing nodes are compared.
    """
    levels = len(one) - 2
    wrong = None
    for k in range(levels + 1, -1, -1):
        a, b = one[k], two[k]
        if wrong is not None:
            above = wrong.select("file", F.col("node").alias("above"))
            a, b = (side.withColumn("above", _above(k, levels)).join(above, ["file", "above"], "left_semi")
                    .drop("above") for side in (a, b))
        wrong = staged(
            a.join(b.withColumnRenamed("digest", "other"), ["file", "node"], "full")
            .filter("NOT (digest <=> other)").select("file", "node"), "merkle-differing")
    return wrong.select("file", F.col("node").alias("offset"))


def levels_for(*replicas: DataFrame) -> int:
    """Levels of ranges, so that the topmost covers every file."""
    ends = reduce(DataFrame.union, [r.select("offset") for r in replicas])
    last = ends.agg(F.max("offset")).first()[0] or 0
    levels, covered = 1, RANGE
    while covered <= last:
        levels, covered = levels + 1, covered * FAN
    return levels


def audit(original: DataFrame, replica: DataFrame) -> DataFrame:
    """file, offset and status of each damaged record, given the ``leaves`` of two replicas.

    ``changed``: both have a record at the offset, with other bytes. ``missing``: the replica
    has none. ``extra``: only the replica has one. Equal replicas give no rows.
    """
    levels = levels_for(original, replica)
    wrong = differing(tree(original, levels), tree(replica, levels))
    here = original.select("file", "offset").distinct().withColumn("here", F.lit(True))
    there = replica.select("file", "offset").distinct().withColumn("there", F.lit(True))
    return (wrong.join(here, ["file", "offset"], "left").join(there, ["file", "offset"], "left")
            .select("file", "offset", F.when(F.col("there").isNull(), "missing")
                    .when(F.col("here").isNull(), "extra").otherwise("changed").alias("status")))
