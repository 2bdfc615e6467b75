"""Parquet tables of a scale-factor directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``ts`` as stored (TIMESTAMP_NTZ)."""
    return load_table(spark, sf_dir, "events")


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread ``df`` over at least ``min_partitions`` tasks (default: the
    cluster's default parallelism) with a round-robin repartition, but only
    when the scan yields fewer splits than that (e.g. one unsplittable row
    group).  Used before CPU-heavy per-row work such as tokenising text; on
    a large input with many splits it is a no-op.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)
