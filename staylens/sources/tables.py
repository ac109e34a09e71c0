"""Column-pruned Parquet scans of the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


_SCANS: dict[tuple[int, str], DataFrame] = {}


def _scan(spark: SparkSession, path: str) -> DataFrame:
    """One relation (file listing + footer read) per session and path."""
    key = (id(spark), path)
    hit = _SCANS.get(key)
    if hit is None or hit.sparkSession is not spark:
        hit = _SCANS[key] = spark.read.parquet(path)
    return hit


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one table; with ``columns`` only those reach the Parquet ReadSchema. How a scan is
    split is the session's business (``spark.sql.files.maxPartitionBytes``)."""
    df = _scan(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
