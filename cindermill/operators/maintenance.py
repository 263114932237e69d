"""Upkeep of stored layers: outliers written back to their files, stale series built anew from what has landed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cindermill.operators import quality
from cindermill.operators.bars import series_keys, silver
from cindermill.sources import versions
from cindermill.sources.scratch import Scratch


def write_back_outliers(spark: SparkSession, root: str, *partitions: str, limit: float = 4.0) -> list[str]:
    """Turn is_clean from true to false for outliers in the table's newest version; the files that were replaced.

    Outliers are told by their series, over all files. Only files that hold a clean one are read again and written
    anew, in one commit; where there is none, there is no commit. The driver holds the names of files, as the commit does.
    """
    number, schema, files = versions.commit_of(spark, root)
    bars = versions.with_places(versions.read_files(spark, root, schema, files), root)
    turned = quality.outliers(bars, limit).where("is_outlier AND is_clean").select("file_", "row_", F.lit(True).alias("turned_"))
    touched = sorted(r["file_"] for r in turned.select("file_").distinct().collect())
    if touched:
        held = versions.with_places(versions.read_files(spark, root, schema, touched), root).join(turned, ["file_", "row_"], "left")
        versions.replace_files(held.withColumn("is_clean", F.when(F.col("turned_"), False).otherwise(F.col("is_clean"))).select(*schema.names), root, touched, *partitions)
    return touched


def rebuild_plan(stored: DataFrame, landed: DataFrame, version: str) -> DataFrame:
    """symbol, timeframe, stale_rows of series that another version made, and landed_rows to build them from."""
    stale = quality.stale_versions(stored, version)
    counts = landed.groupBy("symbol", "timeframe").agg(F.count("*").alias("landed_rows"))
    return stale.join(counts, ["symbol", "timeframe"], "left").withColumn("landed_rows", F.coalesce("landed_rows", F.lit(0).cast("long")))


def reprocess(spark: SparkSession, root: str, landed: DataFrame, version: str, *partitions: str, dry_run: bool = False, only: Column | None = None) -> DataFrame:
    """Build the stale series of a stored silver table anew from landed bars; the plan of what that is.

    A dry run gives the same plan and writes nothing. Series without landed rows stay as they are. Only the
    partitions of series that are built are replaced, with the rows of their other series, in one commit.
    `only` restricts the plan, for example to some symbols.
    """
    stored = versions.read(spark, root)
    plan = rebuild_plan(stored, landed, version)
    plan = plan if only is None else plan.where(only)
    if dry_run:
        return plan
    keys = list(series_keys(stored))
    rows = Scratch(spark).keep("plan", plan)  # as it was before the table changes
    made = rows.where("landed_rows > 0").select(*keys)
    fresh = silver(quality.rows_to_reprocess(landed, made), "1D", version=version).select(*stored.columns)
    cells = stored.join(made, keys, "left_semi").select(*partitions).distinct() if partitions else None
    beside = stored if cells is None else stored.join(cells, list(partitions), "left_semi")
    if not made.isEmpty():
        versions.replace_partitions(beside.join(made, keys, "left_anti").unionByName(fresh), root, *partitions)
    return rows
