"""Copies of a message told apart across micro-batches, by keyed state that expires."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.missing import column
from millrace.streaming.append import start_append


@dataclass(frozen=True)
class DedupReport:
    rows_in: int
    rows_repeated: int
    rows_late: int
    rows_untimed: int

    @property
    def rows_kept(self) -> int:
        return self.rows_in - self.rows_repeated - self.rows_late - self.rows_untimed


UNTIMED = "untimed"


def first_arrivals(rows: DataFrame, key: str, time: str, within: str) -> DataFrame:
    """A stream without the rows whose key came before, less than ``within`` ago.

    Producers that resend, and sources that deliver at least once, repeat a message in the
    same micro-batch or in a later one. A key stays in the state until the latest time seen
    has passed the key's own time by ``within``, so the state holds the keys of that span and
    not those of all time. Rows more than that behind the latest time of earlier batches are
    late: nobody knows any more whether they came before, so they are left out and counted.

    A row without a key repeats another one only if it is equal in all columns. A row without
    a time cannot expire; it is left out and counted. The key is hashed into the shuffle
    partitions of the first start, which cannot be changed later; a key that repeats very
    often costs the state one entry.
    """
    named = [column(name) for name in rows.columns]
    # One column for both cases; digests of 256 bits, as equal ones would lose a row.
    same = F.when(column(key).isNotNull(), F.concat(F.lit("k"), column(key).cast("string"))).otherwise(
        F.concat(F.lit("r"), F.sha2(F.to_json(F.struct(*named)), 256)))
    timed = rows.observe(UNTIMED, F.count_if(column(time).isNull()).alias("rows")).where(column(time).isNotNull())
    instant = F.to_timestamp(column(time))
    return (timed.withColumns({"__same": same, "__time": instant}).withWatermark("__time", within)
            .dropDuplicatesWithinWatermark(["__same"]).select(*named))


def start_dedup(rows: DataFrame, path: str, checkpoint: str, key: str, time: str, within: str,
                interval: str | None = None) -> StreamingQuery:
    """Append the first arrivals of a stream to a table, exactly once."""
    return start_append(first_arrivals(rows, key, time, within), path, checkpoint, interval)


def dedup_report(progress: Iterable) -> DedupReport:
    """What the batches of ``StreamingQuery.recentProgress`` did, added up.

    Spark keeps the last hundred; add up now and then what a long stream did.
    """
    told = list(progress)
    states = [state for p in told for state in p.stateOperators]
    return DedupReport(
        sum(p.numInputRows for p in told),
        sum(int(state.customMetrics.get("numDroppedDuplicateRows", 0)) for state in states),
        sum(state.numRowsDroppedByWatermark for state in states),
        sum(p.observedMetrics[UNTIMED]["rows"] for p in told if UNTIMED in p.observedMetrics))
