"""Fields that messages have, beside those that a contract promises."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.contracts import Contract
from millrace.functions.missing import column
from millrace.sinks.files import staged

NEW, VANISHED, RETYPED, KEPT = "new", "vanished", "retyped", "ok"
NULL_ONLY, MIXED = "null", "mixed"


def _family(kind: Column) -> Column:
    """The family of a type that messages agree on; ``mixed`` where they do not."""
    return (F.when(kind == "VOID", NULL_ONLY).when(kind == "VARIANT", MIXED)
            .when(kind.rlike("^(TINYINT|SMALLINT|INT|BIGINT)$"), "int")
            .when(kind.rlike("^(FLOAT|DOUBLE|DECIMAL)"), "float").when(kind == "STRING", "string")
            .when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array")
            .otherwise(F.lower(kind)))


def message_fields(messages: DataFrame, value: str, period: Column) -> DataFrame:
    """(period, field, kind, family, n_messages): the fields of the messages of a period.

    A message is parsed once, as a VARIANT that keeps whatever it has, and its fields are
    aggregated by name: the type of a field is the one that all its values have, and each task
    sends one row for each period and field. Rows with a NULL field stand for the period
    itself, so that one without any field is there; texts that are no object count there.
    """
    parsed = messages.select(period.alias("period"), F.try_parse_json(column(value).cast("string")).alias("v"))
    exploded = parsed.lateralJoin(parsed.sparkSession.tvf.variant_explode_outer(F.col("v").outer()))
    found = exploded.groupBy("period", F.col("key").alias("field")).agg(
        F.schema_of_variant_agg("value").alias("kind"), F.count("*").alias("n_messages"))
    return found.withColumn("family", F.when(F.col("field").isNotNull(), _family(F.col("kind"))))


def _expected(contract: Contract) -> Column:
    return F.array(*[F.struct(F.lit(name).alias("field"), F.lit(rule.family).alias("expected"))
                     for name, rule in contract.items()])


def field_drift(fields: DataFrame, contract: Contract) -> DataFrame:
    """(period, field, expected, observed, n_messages, status) of each field that a period's
    messages have or that the contract expects.

    Fields beyond the contract are ``new``; those that no message of the period has are
    ``vanished``; those with values of another family are ``retyped``, where whole numbers do
    for ``float`` and a field that is always null for any family. Parsing under a schema loses
    the first silently and makes NULLs of the others.
    """
    found = staged(fields, "fields")
    promised = found.select("period").distinct().select("period", F.inline(_expected(contract)))
    both = found.where("field IS NOT NULL").select("period", "field", "family", "n_messages").unionByName(
        promised, allowMissingColumns=True)
    merged = both.groupBy("period", "field").agg(
        F.max("expected").alias("expected"), F.max("family").alias("observed"),
        F.coalesce(F.sum("n_messages"), F.lit(0)).alias("n_messages"))
    fits = ((F.col("observed") == F.col("expected")) | (F.col("observed") == NULL_ONLY)
            | ((F.col("expected") == "float") & (F.col("observed") == "int")))
    status = (F.when(F.col("expected").isNull(), NEW).when(F.col("observed").isNull(), VANISHED)
              .when(fits, KEPT).otherwise(RETYPED))
    return merged.withColumn("status", status)
