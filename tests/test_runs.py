import pytest
from pyspark.sql import functions as F

from tessera.operators import runs as R


def _gen_rows(spark, rows):
    schema = ("case_name string, case_index long, parent_case_id string, scientific_config_id string, state string, "
              "train map<string,double>, test map<string,double>, val map<string,double>")
    return spark.createDataFrame(rows, schema)


def test_two_completed_folds(spark):
    rows = [(f"case_{i:04d}__p__rf__cv__random", i, "parent_0001", "sid", "COMPLETED", {"r2": 0.9}, {"r2": t}, None)
            for i, t in ((1, 0.6), (2, 0.8))]
    agg = R.aggregate_generalization(R.generalization(_gen_rows(spark, rows))).first()
    assert agg.metric_slices_used == 2 and agg.slice_count == 2 and agg.state == "COMPLETED"
    assert agg.test_value == pytest.approx(0.7)


def test_fold_aggregate_mean_and_population_std(spark):
    rows = [("case_0001", 1, "p1", "s", "COMPLETED", {"r2": 0.9}, {"r2": 0.2, "mae": 1.0}, None),
            ("case_0002", 2, "p1", "s", "COMPLETED", {"r2": 0.9}, {"r2": 0.4, "mae": 2.0}, None)]
    g = R.generalization(_gen_rows(spark, rows))
    agg = R.aggregate_generalization(g).first()
    assert agg.test_value == pytest.approx(0.3)
    assert agg.gap_train_minus_test_std == pytest.approx(0.1)


def test_partial_config_gap(spark):
    rows = [("case_0001", 1, "p1", "s", "COMPLETED", {"r2": 0.8}, {"r2": 0.5}, None),
            ("case_0002", 2, "p1", "s", "COMPLETED", {"r2": 0.9}, {"r2": 0.7}, None)]
    g = R.generalization(_gen_rows(spark, rows))
    summary = spark.createDataFrame([("p1", 3, 2)], "aggregate_key string, slice_count long, completed_slices long")
    a = R.aggregate_generalization(g, summary).first()
    assert a.train_value == pytest.approx(0.85) and a.test_value == pytest.approx(0.6)
    assert a.gap_train_minus_test == pytest.approx(0.25) and a.gap_train_minus_test_std == pytest.approx(0.05)
    assert a.state == "PARTIAL" and a.failed_slices == 1


def test_missing_generalization_metrics(spark):
    rows = [("case_0001", 1, "p1", "s", "COMPLETED", {"r2": 0.8}, {"r2": 0.5}, None),
            ("case_0002", 2, "p1", "s", "COMPLETED", {"r2": 0.9}, {"r2": 0.7}, None)]
    g = R.generalization(_gen_rows(spark, rows))
    summary = spark.createDataFrame([("p1", 3, 3)], "aggregate_key string, slice_count long, completed_slices long")
    a = R.aggregate_generalization(g, summary).first()
    assert a.state == "PARTIAL" and a.failure_reason == "missing_generalization_metrics=1"


def test_state_merge_rules(spark):
    df = spark.createDataFrame(
        [("success", "", "", "SKIPPED", 0), ("running", "", "", "FAILED", 1), (None, "", "", "COMPLETED", 0),
         ("failed", "train", "ValueError", None, None)],
        "status string, node string, exc string, a_state string, rc int")
    s, c, r = R.state_from_status(F.col("status"), F.col("status").isNotNull(), F.col("node"), F.col("exc"))
    df = df.withColumn("ss", s).withColumn("sc", c).withColumn("sr", r)
    st, code, reason = R.merge_state(F.col("ss"), F.col("sc"), F.col("sr"), F.col("a_state").isNotNull(),
                                     F.col("a_state"), F.col("rc"), F.lit(None))
    got = [(x.s, x.r) for x in df.select(st.alias("s"), reason.alias("r")).collect()]
    assert got == [("COMPLETED", None), ("FAILED", "nonzero_return_code"), ("COMPLETED", None),
                   ("FAILED", "train:ValueError")]


def test_scheduler_failure_class(spark):
    df = spark.createDataFrame([("COMPLETED", []), ("FAILED", ["OUT_OF_MEMORY"]), ("CANCELLED by 1", []),
                                ("PENDING", None)], "s string, steps array<string>")
    got = [r.c for r in df.select(R.scheduler_failure_class(F.col("s"), F.col("steps")).alias("c")).collect()]
    assert got == [None, "out_of_memory", "cancelled", "pending"]


def test_missing_metrics_marks_partial(spark):
    df = spark.createDataFrame([("COMPLETED", None, False), ("COMPLETED", "x", True)],
                               "state string, failure_reason string, has boolean")
    out = R.mark_missing_metrics(df, F.col("has"), F.col("has")).collect()
    assert (out[0].state, out[0].failure_reason) == ("PARTIAL", "missing_metrics")
    assert out[1].state == "COMPLETED"
