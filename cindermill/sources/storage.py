"""Layer tables as partitioned Parquet: scans, snapshots, appends, replacements and views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cindermill.sources import versions
from cindermill.sources.scratch import Scratch

CONTEXT = "context"
VIEWS = ("v_ohlcv_1D", "v_ohlcv_1H", "v_ohlcv_all", "v_macro_enriched", "v_macro_regime", "v_mtf_alignment", "v_tech_signals_1D", "v_sector_weights", "v_correlation", "v_screener", "v_sentiment", "v_active_symbols", "v_watchlist_latest")


def scan(spark: SparkSession, root: str, **partition) -> DataFrame:
    """A layer table, of versions the newest; named partition values prune its files."""
    df = versions.read(spark, root) if exists(spark, f"{root}/commits") else spark.read.parquet(root)
    for name, value in partition.items():
        df = df.where(F.col(name).isin(*value) if isinstance(value, (list, tuple)) else F.col(name) == value)
    return df


def layer_one(bars: DataFrame) -> DataFrame:
    return bars.where(F.col("market") != CONTEXT)


def layer_two(bars: DataFrame) -> DataFrame:
    return bars.where(F.col("market") == CONTEXT)


def stamp(df: DataFrame, source: str, symbol: str = "symbol") -> DataFrame:
    """Audit columns of landed rows: where and when they were ingested, and the symbol that was asked for."""
    return df.withColumns({"_source": F.lit(source), "_ingested_at": F.current_timestamp(), "_symbol": F.col(symbol)})


def exists(spark: SparkSession, path: str) -> bool:
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(location)


def append_new(df: DataFrame, path: str, keys: list[str], partitions: list[str], source: str | None = None) -> DataFrame:
    """Append the rows whose keys the table does not have yet, stamped if a source is named; returns what was appended.

    Only the partitions that df has rows for are read.
    """
    spark, fresh = df.sparkSession, df if source is None else stamp(df, source)
    if exists(spark, path):
        present = spark.read.parquet(path)
        same = [c for c in partitions if c in present.columns]
        if same:
            present = present.join(F.broadcast(df.select(*same).distinct()), same, "left_semi")
        fresh = fresh.join(present.select(*keys).distinct(), keys, "left_anti")
    fresh = Scratch(spark).keep("appended", fresh)  # what is written and what is returned are the same rows, with one time of ingestion
    fresh.write.mode("append").partitionBy(*partitions).option("compression", "snappy").parquet(path)
    return fresh


def replace_partitions(df: DataFrame, path: str, partitions: list[str]) -> None:
    """Overwrite only the partitions that df has rows for."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*partitions).parquet(path)


def upsert(current: DataFrame, rows: DataFrame, *keys: str) -> DataFrame:
    """The current rows without those keys, and the new ones; columns may differ."""
    return current.join(rows.select(*keys), list(keys), "left_anti").unionByName(rows, allowMissingColumns=True)


def snapshot(df: DataFrame, date_column: str, run_date) -> DataFrame:
    """Rows of one run date; an empty snapshot is an error."""
    rows = df.where(F.col(date_column) == run_date)
    if rows.isEmpty():
        raise LookupError(f"no snapshot for {run_date}")
    return rows


#: Where the views' tables are below the root of the layers; views of bars leave the context layer out.
LAYERS = {"v_ohlcv_1D": "silver/market_ohlcv", "v_ohlcv_1H": "silver/market_ohlcv", "v_ohlcv_all": "silver/market_ohlcv", "v_macro_enriched": "silver/macro_enriched", "v_macro_regime": "gold/macro", "v_mtf_alignment": "gold/mtf", "v_tech_signals_1D": "gold/signals", "v_sector_weights": "gold/sector", "v_correlation": "gold/correlation", "v_screener": "gold/screener", "v_sentiment": "silver/sentiment", "v_active_symbols": "silver/active_symbols", "v_watchlist_latest": "gold/screener"}
TIMEFRAMES = {"v_ohlcv_1D": "1D", "v_ohlcv_1H": "1H", "v_tech_signals_1D": "1D"}


def register_views(spark: SparkSession, tables: dict[str, DataFrame | None]) -> list[str]:
    """Temporary views for the tables that exist; the names that were made."""
    made = []
    for name in VIEWS:
        if tables.get(name) is not None:
            tables[name].createOrReplaceTempView(name)
            made.append(name)
    return made


def newest_watchlist(watchlists: DataFrame) -> DataFrame:
    """The rows of the last watchlist_date."""
    last = watchlists.agg(F.max("watchlist_date").alias("last_"))
    return watchlists.join(F.broadcast(last), F.col("watchlist_date") == F.col("last_"), "left_semi")


def layer_views(spark: SparkSession, root: str) -> dict[str, DataFrame | None]:
    """The table of every view from the layers stored below a root, versioned or plain; None where there is none yet."""
    out: dict[str, DataFrame | None] = {}
    for name, place in LAYERS.items():
        path = f"{root.rstrip('/')}/{place}"
        df = scan(spark, path) if exists(spark, path) else None
        if df is not None and name in TIMEFRAMES and "timeframe" in df.columns:
            df = df.where(F.col("timeframe") == TIMEFRAMES[name])
        if df is not None and name.startswith("v_ohlcv") and "market" in df.columns:
            df = layer_one(df)
        out[name] = newest_watchlist(df) if df is not None and name == "v_watchlist_latest" else df
    return out


def list_views(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables() if t.name in {v.lower() for v in VIEWS} | set(VIEWS))


def file_freshness(spark: SparkSession, path: str) -> DataFrame:
    """Files, bytes and newest change of a dataset."""
    meta = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    return meta.agg(F.count("*").alias("n_files"), F.sum("file_size").alias("n_bytes"), F.max("file_modification_time").alias("last_change"))


def replace_table(df: DataFrame, path: str) -> None:
    """Replace a plain Parquet table: the old one is there until the new one is complete, but for the moment between two renames.

    `publish` has no such moment; its tables are read by `scan`.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    target, staged, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path.rstrip('/')}.staged", f"{path.rstrip('/')}.old"))
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    df.write.mode("overwrite").option("compression", "zstd").parquet(staged.toString())
    files.delete(old, True)
    if files.exists(target):
        files.rename(target, old)
    if not files.rename(staged, target):
        files.rename(old, target)
        raise OSError(f"{path} could not be replaced")
    files.delete(old, True)


def try_replace_table(df: DataFrame, path: str) -> bool:
    """Like replace_table, but a failed write leaves the old table and gives False."""
    from py4j.protocol import Py4JError
    from pyspark.errors import PySparkException

    try:
        replace_table(df, path)
    except (OSError, PySparkException, Py4JError):
        return False
    return True


def publish(df: DataFrame, path: str, *partitions: str, whole: bool = True) -> bool:
    """A new version of a table (`versions`), of these rows alone or with them in place of their partitions.

    Readers see the old rows or the new ones, at no time neither; a write that fails, or that another
    writer came before, leaves the newest version and gives False.
    """
    from py4j.protocol import Py4JError
    from pyspark.errors import PySparkException

    try:
        (versions.replace if whole else versions.replace_partitions)(df, path, *partitions)
    except (OSError, PySparkException, Py4JError, versions.Conflict):
        return False
    return True
