"""A stream appended to a Parquet table, exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def start_append(rows: DataFrame, path: str, checkpoint: str,
                 interval: str | None = None) -> StreamingQuery:
    """Append the rows of a stream; readers see whole batches only.

    The checkpoint is the cursor: each start copies what is new since the last one, so a
    poll costs as much as the new rows, not as much as the table. ``interval=None`` works
    off what is there and stops. Files of the source must not be rewritten.
    """
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return (rows.writeStream.outputMode("append").format("parquet")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**trigger).start())
