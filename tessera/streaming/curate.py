"""Streaming curation.

The reference has no stream processing; what carries over is that the
stateless curation operators (P1-P19, class labels, run-state rules) run
unchanged on a ``readStream`` DataFrame.  Keep-first dedupe across
micro-batches is done in ``foreachBatch`` against the keys already written:
each batch writes to its own ``batch=<id>`` folder with overwrite, so a
replayed batch after an executor or driver failure rewrites the same output
(idempotent), and the checkpoint location records progress.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.errors import AnalysisException

from tessera.operators.dedupe import keep_first


def stream_source(spark: SparkSession, directory: str, file_glob: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Parquet files arriving in ``directory``; schema taken from the
    existing files (metadata only)."""
    schema = spark.read.option("pathGlobFilter", file_glob).parquet(directory).schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
            .option("maxFilesPerTrigger", max_files_per_trigger).parquet(directory))


def keep_first_sink(out_path: str, key: str, order: str):
    """foreachBatch function: keep the first row per key of the batch, drop
    keys already written by earlier batches, write this batch's folder.
    Within a batch ``order`` decides; across batches the earlier batch wins."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        firsts = keep_first(batch, key, order)
        try:  # keys of earlier batches (partition discovery on batch=<id>)
            written = spark.read.parquet(out_path)
        except AnalysisException as exc:
            if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            written = None  # the first batch
        if written is not None:
            earlier = written.filter(F.col("batch") < batch_id).select(key).distinct()
            firsts = firsts.join(earlier, key, "left_anti")
        firsts.write.mode("overwrite").parquet(os.path.join(out_path, f"batch={batch_id}"))

    return run


def run_available(stream: DataFrame, sink, checkpoint: str) -> StreamingQuery:
    """Process everything available now, then stop (the batch-style trigger)."""
    q = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
