"""Driver-generated test tables (parquet) and their row identities."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

ROW_INDEX = "__row_index"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def lineitem_key():
    """Natural row id of lineitem (P20).  (l_orderkey, l_linenumber) is not
    unique in the test data; (l_orderkey, l_linenumber, l_partkey, l_suppkey)
    is.  Padded with zeros, so up to the given widths string order is numeric
    order; a longer key is kept whole."""
    def padded(c: str, width: int):
        digits = F.col(c).cast("long").cast("string")
        return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))

    return F.concat_ws("-", padded("l_orderkey", 12), F.col("l_linenumber").cast("string"), padded("l_partkey", 10), padded("l_suppkey", 10))


# DuckDB twin of ``lineitem_key`` for oracle SQL.
LINEITEM_KEY_SQL = (
    "concat_ws('-', printf('%012d', l_orderkey), CAST(l_linenumber AS VARCHAR), "
    "printf('%010d', l_partkey), printf('%010d', l_suppkey))"
)


def lineitem_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with its natural row id in ``__row_index`` (spread over the
    cores when the scan is a single split; no-op on a many-file table)."""
    return spread(table(spark, sf_dir, "lineitem")).withColumn(ROW_INDEX, lineitem_key())


def events_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as raw activity rows: row id = ``event_id``."""
    return table(spark, sf_dir, "events").withColumn(ROW_INDEX, F.col("event_id"))


def register_views(spark: SparkSession, sf_dir: str) -> None:
    for name in TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def spread(df: DataFrame, factor: int = 2) -> DataFrame:
    """Round-robin repartition before CPU-heavy per-row work (text
    featurisation), but only when the scan produced fewer partitions than the
    cluster has cores -- e.g. a file with a single row group.  Planning-only
    check (no job); on a cluster reading many files it is a no-op."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores * factor)
    return df
