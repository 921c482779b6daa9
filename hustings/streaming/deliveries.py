"""Deliveries as a stream: repeats left out within a watermark, each micro-batch applied as a whole.

The domain is a batch one - snapshots are delivered now and then - so this only
carries new deliveries into the same operators.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def without_repeats(stream: DataFrame, keys: Sequence[str], received: str, late: str = "7 days") -> DataFrame:
    """Rows of a stream once for each key; a repeat is recognised while it is no later than ``late``, and state is kept no longer."""
    return stream.withWatermark(received, late).dropDuplicatesWithinWatermark(list(keys))


def windowed_counts(stream: DataFrame, received: str, by: Sequence[str], width: str = "1 day", late: str = "7 days") -> DataFrame:
    """The number of deliveries in each window of time; a window is told once nothing for it can come any more."""
    return stream.withWatermark(received, late).groupBy(F.window(received, width), *by).agg(F.count(F.lit(1)).alias("n"))


def apply_batches(stream: DataFrame, apply: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Writes what ``apply`` makes of each micro-batch to its own folder ``batch=N``; a batch run again replaces its own result."""

    def write(batch: DataFrame, number: int) -> None:
        apply(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
