"""Helpers shared by the corpus operators: input views and stored tables."""

from __future__ import annotations

import atexit
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

# Word separators of every contract here: space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Bounds an Arrow batch by bytes as well as by rows (texts differ in
    length by orders of magnitude) and lets Python workers import this package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2048")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (_ROOT, env.get("PYTHONPATH", "")) if x)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) only, so other columns cannot clash; a null text is empty."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, removed when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark)}/tessera-llm/{tag}-{uuid.uuid4().hex}"
    atexit.register(_remove_quietly, spark, path)
    return path


def remove(spark: SparkSession, *paths: str) -> None:
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(hadoop).delete(p, True)


def _remove_quietly(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
        return
    try:
        remove(spark, path)
    except Exception as exc:  # at interpreter exit only: the JVM may be gone
        print(f"left behind: {path}: {exc}")


def store(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """Cut lineage: write ``df`` to the shared folder once and read it back."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path
