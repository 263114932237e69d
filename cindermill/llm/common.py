"""Helpers shared by the training-data operators."""

from __future__ import annotations

import binascii
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo `modulus`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def bounded_sample(df: DataFrame, key: str, fraction: Column | float) -> DataFrame:
    """Rows whose hashed key falls below `fraction`: the same rows on every run and any partitioning."""
    million = 1_000_000
    share = fraction if isinstance(fraction, Column) else F.lit(float(fraction))
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(million)) < share * million)


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder; set that folder only where the session has none."""
    base = spark.conf.get("spark.checkpoint.dir", None) or _context_dir(spark)
    return f"{base.rstrip('/')}/tables/{uuid.uuid4().hex}"


def _context_dir(spark: SparkSession) -> str:
    existing = spark.sparkContext._jsc.sc().getCheckpointDir()
    if existing.isDefined():
        return existing.get()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    base = f"file:///tmp/checkpoints/{uuid.uuid4().hex}"
    spark.sparkContext.setCheckpointDir(base)
    return base


def materialise(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives a lost executor."""
    path = scratch(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(column: pa.Array) -> Iterator[str]:
    """The strings of an Arrow column one by one, null as the empty text."""
    for value in column:
        text = value.as_py()
        yield "" if text is None else text


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores until df has no such column in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def unsigned_crc32(data: bytes) -> int:
    return binascii.crc32(data) & 0xFFFFFFFF
