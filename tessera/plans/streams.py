"""Streaming query: stateless curation on a file stream of events plus
cross-batch keep-first dedupe in ``foreachBatch``."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tessera.operators import curate as C
from tessera.plans import register
from tessera.sources.files import scratch_path
from tessera.streaming.curate import keep_first_sink, run_available, stream_source


@register("st1_streaming_curate_keep_first", """
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events
  WHERE event_type IN ('click', 'view', 'purchase', 'error') AND value IS NOT NULL AND NOT isnan(value)) WHERE rn = 1""")
def st1(spark, sf_dir):
    stream = stream_source(spark, sf_dir, "events.parquet")
    cur = C.require_non_null(stream, ["value"])
    cur = C.row_filters(cur, {"event_type": ["click", "view", "purchase", "error"]})
    base = scratch_path(spark, "stream")
    out, ckpt = os.path.join(base, "out"), os.path.join(base, "checkpoint")
    run_available(cur.select("user_id", "event_id", "event_type"), keep_first_sink(out, "user_id", "event_id"), ckpt)
    return spark.read.parquet(out).select("user_id", "event_id", "event_type")
