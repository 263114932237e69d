"""Bars and quarantine over streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cindermill.operators import bars as B
from cindermill.operators import quality


def four_hour_stream(bars: DataFrame, lateness: str = "1 day", market: Column | None = None) -> DataFrame:
    """Four-hour bars of a stream of hourly ones, all columns of bars.four_hour, emitted when the watermark passes their end."""
    grouped = bars.withWatermark("timestamp", lateness).groupBy("symbol", F.window("timestamp", "4 hours").alias("span")).agg(*B.block_measures())
    named = grouped.select("symbol", F.col("span.start").alias("timestamp"), *[c for c in grouped.columns if c not in ("symbol", "span")])
    return B.add_completeness(named, market)


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """The rows of a micro-batch in a folder of its own, which a replay of the batch replaces; read back, the table has a column batch_id."""
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def quarantine_stream(rows: DataFrame, registry: T.StructType, good_path: str, bad_path: str, checkpoint: str):
    """Writes every micro-batch to the good and the quarantine table, every row once, however often a batch is run."""

    def split(batch: DataFrame, batch_id: int) -> None:
        good, bad = quality.route(batch, registry)
        write_batch(good, good_path, batch_id)
        write_batch(bad, bad_path, batch_id)

    return rows.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint)
