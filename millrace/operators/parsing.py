"""Messages to typed rows, and rows to messages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.contracts import (COINS, CURRENCIES, EVENT_TIME, MESSAGE_KEY, MESSAGE_TIME,
                                NESTED_PRICES, PRICE_MESSAGE)
from millrace.functions.messages import CORRUPT, decoded, message_json, parse_time

RAW = "raw_value"
REASON = "reject_reason"
MALFORMED, NO_KEY, BAD_TIME = "malformed", "missing_key", "bad_timestamp"


def _typed(message: Column, fields: Sequence[str]) -> list[Column]:
    return [parse_time(message[MESSAGE_TIME]).alias(EVENT_TIME) if name == MESSAGE_TIME
            else message[name].alias(name) for name in fields]


def parse_messages(raw: DataFrame, value: str = "value",
                   schema: T.StructType = PRICE_MESSAGE) -> DataFrame:
    """Typed rows of the messages that carry a key; an unreadable time is NULL.

    Emitting the row from a generator parses each message once. A filter on the
    parsed struct would be pushed below the projection and parse it twice.
    """
    keyed = F.filter(F.array(decoded(F.col(value), schema)), lambda m: m[MESSAGE_KEY].isNotNull())
    rows = F.transform(keyed, lambda m: F.struct(*_typed(m, schema.fieldNames())))
    return raw.select(F.inline(rows))


def sort_messages(raw: DataFrame, value: str = "value",
                  schema: T.StructType = PRICE_MESSAGE) -> DataFrame:
    """Every message as a typed row, with the reason why it is rejected, if it is.

    Rejected messages keep their whole text; accepted ones do not need it. Text and time
    are parsed inside the generator, once, whatever is filtered afterwards.
    """
    text = F.col(value).cast("string")
    pair = F.struct(text.alias(RAW), decoded(F.col(value), schema).alias("m"))
    fields = schema.fieldNames()
    rows = F.transform(F.array(pair), lambda p: F.struct(
        p[RAW].alias(RAW), *_typed(p["m"], fields),
        (p["m"][CORRUPT].isNotNull() | p[RAW].isNull() | (F.trim(p[RAW]) == "")).alias("no_object")))
    reason = (F.when(F.col(MESSAGE_KEY).isNull(),
                     F.when(F.col("no_object"), MALFORMED).otherwise(NO_KEY))
               .when(F.col(EVENT_TIME).isNull(), BAD_TIME))
    rejects = F.when(F.col(MESSAGE_KEY).isNull() | F.col(EVENT_TIME).isNull(), F.col(RAW))
    columns = [EVENT_TIME if name == MESSAGE_TIME else name for name in fields]
    return raw.select(F.inline(rows)).select(*columns, rejects.alias(RAW), reason.alias(REASON))


def accepted(sorted_rows: DataFrame) -> DataFrame:
    return sorted_rows.where(F.col(REASON).isNull()).drop(RAW, REASON)


def rejected(sorted_rows: DataFrame) -> DataFrame:
    return sorted_rows.where(F.col(REASON).isNotNull()).select(MESSAGE_KEY, RAW, REASON)


def flatten_prices(documents: DataFrame, value: str = "value", time: str = MESSAGE_TIME,
                   coins: Sequence[str] | None = COINS,
                   currencies: Sequence[str] = CURRENCIES) -> DataFrame:
    """One row per coin of documents ``{coin: {currency: price}}``.

    Only the wanted coins (``None``: all) and currencies are kept. A currency the coin
    lacks is NULL. All rows of a document share its time.
    """
    nested = F.from_json(F.col(value).cast("string"), NESTED_PRICES)
    rows = documents.select(F.explode(nested).alias(MESSAGE_KEY, "prices"), F.col(time))
    if coins is not None:
        rows = rows.where(F.col(MESSAGE_KEY).isin(*coins))
    return rows.select(MESSAGE_KEY,
                       *[F.try_element_at("prices", F.lit(c)).alias(c) for c in currencies],
                       time)


def to_messages(df: DataFrame, key: Column, fields: Mapping[str, Column]) -> DataFrame:
    """Rows as keyed JSON messages, in the two columns a Kafka sink expects."""
    return df.select(key.cast("string").alias("key"), message_json(fields).alias("value"))
