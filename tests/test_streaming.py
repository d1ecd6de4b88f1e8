import os

from tessera.plans import QUERIES, load_all

SMOKE = "/root/testdata/sf0.001"


def test_streaming_keep_first_matches_batch(spark):
    load_all()
    got = QUERIES["st1_streaming_curate_keep_first"](spark, SMOKE)
    ev = spark.read.parquet(os.path.join(SMOKE, "events.parquet"))
    ev = ev.filter("event_type in ('click','view','purchase','error') and value is not null")
    first = ev.groupBy("user_id").agg({"event_id": "min"}).withColumnRenamed("min(event_id)", "event_id")
    assert sorted(map(tuple, got.select("user_id", "event_id").collect())) == \
        sorted(map(tuple, first.select("user_id", "event_id").collect()))
