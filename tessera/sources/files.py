"""File sources and sinks.

Readers take explicit schemas where known (no inference pass at scale) and
normalise pandas-style missing spellings after the scan.  Sinks rely on
Spark's commit protocol for all-or-nothing visibility (the reference writes a
temp file and renames).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.scalar import PANDAS_NA_TOKENS
from tessera.session import ensure_checkpoint_dir
from tessera.sources.records import read_records

# Record schemas of the study documents (FIXTURES.md section 3).
ISSUE = T.StructType([T.StructField("code", T.StringType()), T.StructField("path", T.StringType()),
                      T.StructField("message", T.StringType())])
MANIFEST_SCHEMA = T.StructType([
    T.StructField("record_type", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("case_id", T.StringType()), T.StructField("parent_case_id", T.StringType()),
    T.StructField("scientific_config_id", T.StringType()), T.StructField("execution_label", T.StringType()),
    T.StructField("config_path", T.StringType()),
    T.StructField("factors", T.MapType(T.StringType(), T.StringType())),
    T.StructField("execution_factors", T.MapType(T.StringType(), T.StringType())),
    T.StructField("issues", T.ArrayType(ISSUE)),
])
ATTEMPT_SCHEMA = T.StructType([
    T.StructField("record_type", T.StringType()), T.StructField("backend", T.StringType()),
    T.StructField("execution_id", T.StringType()), T.StructField("case_id", T.StringType()),
    T.StructField("parent_case_id", T.StringType()), T.StructField("scientific_config_id", T.StringType()),
    T.StructField("execution_label", T.StringType()), T.StructField("state", T.StringType()),
    T.StructField("return_code", T.IntegerType()), T.StructField("start_time", T.StringType()),
    T.StructField("end_time", T.StringType()), T.StructField("elapsed_seconds", T.DoubleType()),
    T.StructField("config_path", T.StringType()), T.StructField("run_dir", T.StringType()),
    T.StructField("run_status", T.StringType()), T.StructField("failure_reason", T.StringType()),
    T.StructField("log_path", T.StringType()),
])
SPLIT_METRICS_SCHEMA = T.StructType([
    T.StructField("train", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("val", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("test", T.MapType(T.StringType(), T.DoubleType())),
])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a
    machine-local temp dir on a cluster)."""
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def normalize_na(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pandas NA spellings (``''``, ``NA``, ``N/A``, ``NaN``, ``null``,
    ``None`` ...) in string columns -> NULL."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    target = [c for c in (cols or strings) if c in strings]
    return df.select(*[(F.when(F.trim(F.col(f"`{c}`")).isin(*PANDAS_NA_TOKENS), F.lit(None))
                        .otherwise(F.col(f"`{c}`")).alias(c) if c in target else F.col(f"`{c}`"))
                       for c in df.columns])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             typed: dict[str, str] | None = None) -> DataFrame:
    """Header CSV; everything read as text (no inference pass), NA
    spellings -> NULL, then ``typed`` columns parsed with ``try_cast`` (ANSI:
    a bad cell becomes NULL instead of failing the job)."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("multiLine", False)
    if schema is not None:
        return normalize_na(reader.schema(schema).csv(path))
    df = normalize_na(reader.option("inferSchema", False).csv(path))
    for c, t in (typed or {}).items():
        df = df.withColumn(c, F.col(f"`{c}`").try_cast(t))
    return df


def read_report_csv(spark: SparkSession, path: str) -> DataFrame:
    """Re-scan of a written metrics report, NULL -> ''."""
    return spark.read.option("header", True).csv(path).na.fill("")


def read_line_records(spark: SparkSession, path: str, names=("key", "name")) -> DataFrame:
    """One key (+ name) per line, space separated."""
    df = spark.read.option("sep", " ").option("header", False).csv(path)
    return df.toDF(*list(names)[: len(df.columns)] + [f"_c{i}" for i in range(len(names), len(df.columns))])


def read_multi_records(spark: SparkSession, path: str, delimiter: str = "$$$$\n") -> DataFrame:
    """Records separated by a delimiter line (gzip handled by the
    source); empty / malformed records are skipped by the caller's parse."""
    df = spark.read.option("lineSep", delimiter).text(path)
    return df.filter(F.trim("value") != "")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """JSONL manifest; blank lines skipped by the reader; keep
    ``status = 'valid'`` records that are not parents and have a config path."""
    df = spark.read.schema(MANIFEST_SCHEMA).json(path)
    rt = F.coalesce(F.col("record_type"), F.lit(""))
    return df.filter((F.col("status") == "valid") & (rt != "parent") &
                     F.col("config_path").isNotNull() & (F.trim("config_path") != ""))


def read_attempts(spark: SparkSession, path: str) -> DataFrame:
    """S3: execution attempts: ``record_type`` empty or ``execution_attempt``."""
    df = spark.read.schema(ATTEMPT_SCHEMA).json(path)
    rt = F.coalesce(F.trim("record_type"), F.lit(""))
    return df.filter(rt.isin("", "execution_attempt"))


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Per-run JSON documents (multi-line); a corrupt document becomes a
    row of NULLs (PERMISSIVE), keyed by its file path."""
    full = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
    df = spark.read.schema(full).option("multiLine", True).option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    return df.select("*", F.col("_metadata.file_path").alias("file_path"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S16 (full overwrite, header, no index) / S17 (``mode='append'``; one
    header per written file)."""
    df.write.mode(mode).option("header", True).csv(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines; the commit protocol makes the output visible all at once."""
    df.write.mode(mode).json(path)


def write_line_list(df: DataFrame, col: str, path: str) -> None:
    """Sorted unique values, one per line."""
    df.select(F.col(col).cast("string")).distinct().orderBy(col).coalesce(1).write.mode("overwrite").text(path)


# Source registry, name -> reader(spark, options) -> DataFrame.
SOURCES: dict[str, Callable[..., DataFrame]] = {
    "csv": lambda spark, opts: read_csv(spark, opts["path"], opts.get("schema"), opts.get("typed")),
    "parquet": lambda spark, opts: spark.read.parquet(opts["path"]),
    "jsonl": lambda spark, opts: spark.read.schema(opts["schema"]).json(opts["path"]) if opts.get("schema")
    else spark.read.json(opts["path"]),
    "lines": lambda spark, opts: read_line_records(spark, opts["path"]),
    "sdf": lambda spark, opts: read_records(spark, opts["path"], opts.get("delimiter", "$$$$\n"), opts.get("split_bytes")),
    "records": lambda spark, opts: read_multi_records(spark, opts["path"], opts.get("delimiter", "$$$$\n")),
}


def get_data(spark: SparkSession, source: str, **opts) -> DataFrame:
    """Look up a reader by name."""
    if source not in SOURCES:
        raise ValueError(f"unknown source {source!r}; known: {sorted(SOURCES)}")
    return SOURCES[source](spark, opts)


def register_source(name: str, reader: Callable[..., DataFrame]) -> None:
    SOURCES[name] = reader
