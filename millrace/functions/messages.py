"""Text and JSON expressions for the message format."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F, types as T

CORRUPT = "_corrupt_record"


# A date, a time and an offset. A text without one of them means another time tomorrow or
# in another session, so it is no time at all.
ISO_TIME = (r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}([.]\d{1,9})?"
            r"(Z|[+-]\d{2}(:?\d{2})?)$")


def iso_utc(time: Column) -> Column:
    """ISO-8601 text with microseconds of a zone-less UTC time, in any session zone.

    Bring an instant to UTC with ``utc`` first.
    """
    text = time.cast("timestamp_ntz").cast("string")
    fraction = F.rpad(F.regexp_extract(text, r"[.](\d+)$", 1), 6, "0")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("."),
                    fraction, F.lit("+00:00"))


def utc(instant: Column) -> Column:
    """The zone-less UTC time of an instant, in any session zone."""
    seconds = F.unix_micros(instant).cast("decimal(24,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    since = F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since


def parse_time(text: Column) -> Column:
    """Zone-less UTC time of an ISO-8601 date-time with an offset; NULL for any other text."""
    return utc(F.try_to_timestamp(F.when(text.rlike(ISO_TIME), text)))


def message_json(fields: Mapping[str, Column]) -> Column:
    """JSON text of the fields in the given order; NULL fields are written out."""
    record = F.struct(*[value.alias(name) for name, value in fields.items()])
    return F.to_json(record, {"ignoreNullFields": "false"})


def decoded(value: Column, schema: T.StructType) -> Column:
    """Struct of a JSON message given as bytes or text.

    Text that is no JSON object leaves every field NULL and is kept whole in
    ``_corrupt_record``, which tells it apart from an object that lacks its key.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(value.cast("string"), with_corrupt,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
