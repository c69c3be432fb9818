"""Event-time windows with a watermark: an extra, the batch operators being the contract.

Late rows within the watermark change their window, later ones are dropped by
it; in append mode a window is emitted once, when the watermark passes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.semantics import nan_sum


def tumbling(events: DataFrame, keys: list[str], ts: str = "ts", value: str = "value", width: str = "1 day", late: str = "2 days") -> DataFrame:
    """(start, keys, n, mean, max, min, total) over windows of event time."""
    if dict(events.dtypes)[ts] == "timestamp_ntz":  # watermarks need an instant
        events = events.withColumn(ts, F.col(ts).cast("timestamp"))
    grouped = events.withWatermark(ts, late).groupBy(F.window(ts, width), *keys)
    out = grouped.agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.max(value).alias("max"), F.min(value).alias("min"), nan_sum(value).alias("total"))
    return out.select(F.col("window.start").alias("start"), *keys, "n", "mean", "max", "min", "total")


def start(windows: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None) -> StreamingQuery:
    writer = windows.writeStream.outputMode(mode).format("memory").queryName(name)
    return (writer.option("checkpointLocation", checkpoint) if checkpoint else writer).start()
