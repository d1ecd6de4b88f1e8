"""Rules that only bite beyond the size of the test tables."""

import time

import pytest
from pyspark.sql import functions as F

from tessera.operators import curate as C
from tessera.operators import eda as E
from tessera.operators import features as V
from tessera.operators import metrics as K
from tessera.operators import runs as R
from tessera.operators import split as S
from tessera.operators import stats as ST
from tessera.plans.runs import run_table
from tessera.session import ensure_checkpoint_dir
from tessera.sources.tables import lineitem_key


def test_ids_are_not_cut(spark, tmp_path):
    ids = [99_999, 100_000, 100_001, 1_000_001, 12_345_678]
    rows = [(i, 1, '{"k": 3}', "view", 10.0, "2024-01-01 00:00:00") for i in ids]
    ev = spark.createDataFrame(rows, "event_id long, user_id long, props string, event_type string, value double, ts string")
    ev.withColumn("ts", F.to_timestamp("ts")).write.parquet(f"{tmp_path}/events.parquet")
    got = run_table(spark, str(tmp_path)).select("case_name", "config_path", "run_dir").distinct().count()
    assert got == len(ids)
    keys = spark.createDataFrame([(10**12 + i, 1, 10**11 + i, 10**10 + i) for i in range(4)], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long")
    assert keys.select(lineitem_key()).distinct().count() == 4


def test_counts_do_not_overflow(spark):
    n = 5_000_000_000
    per = spark.createDataFrame([("d", n, n, float(n) * n, 0.0)], "descriptor string, n1 long, n2 long, r1 double, tie double")
    assert ST.u_statistic(per).first().statistic == pytest.approx(n * n - n * (n + 1) / 2)
    cells = spark.createDataFrame([("a", "x", n), ("a", "y", n), ("b", "x", n), ("b", "y", n)], "r string, c string, observed long")
    assert ST.chi_squared_cells(cells, "d").first().statistic == 0.0
    assert "double" in dict(K.auc_ap(spark.createDataFrame([(1.0, 0.5), (0.0, 0.4)], "y double, s double"), "y", "s").dtypes)["auc"]


def test_chi_squared_guards_its_levels(spark):
    df = spark.createDataFrame([(str(i), "x") for i in range(40)], "r string, c string")
    with pytest.raises(ValueError):
        ST.chi_squared(df, "r", "c")


def test_all_columns_are_described(spark):
    df = spark.createDataFrame([tuple(float(i * j % 7) for j in range(25)) + ("a",) for i in range(20)], [f"c{j}" for j in range(25)] + ["k"])
    names = [f"c{j}" for j in range(25)]
    assert E.histograms(df, names).select("column").distinct().count() == 25
    assert E.correlation_long(df, names).count() == 300
    assert E.box_stats(df, "k", names[:9]).select("column").distinct().count() == 9


@pytest.mark.parametrize(
    "values, ok",
    [(["active", "inactive"], True), ([" Active", "INACTIVE", None], True), (["1", "0"], True), (["1"], True), (["active"], False), (["1", "inactive"], False), (["0", "2"], False)],
)
def test_strict_binary(spark, values, ok):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    if ok:
        assert set(r.y for r in C.strict_binary(df, "v", "y").collect()) <= {0, 1, None}
    else:
        with pytest.raises(ValueError):
            C.strict_binary(df, "v", "y")


def test_neg_log10_follows_numpy(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (None,), (1000.0,)], "v double")
    got = [r.p for r in df.select(C.neg_log10_nano(F.col("v")).alias("p")).collect()]
    assert got[0] == float("inf") and got[1] != got[1] and got[2] is None and got[3] == pytest.approx(6)


def test_feature_input(spark):
    rows = [(["featurize.rdkit", "featurize.morgan"], "x", "svm"), (["use.curated_features"], "x", "svm"), (["train"], " use.curated_features ", "svm"),
            (["train"], "own", "svm"), (["train"], "", "Chemprop"), (["train"], None, "svm"), ([], "", "svm")]
    df = spark.createDataFrame(rows, "nodes array<string>, declared string, model string")
    got = [r[0] for r in df.select(R.feature_input("nodes", "declared", "model")).collect()]
    assert got == ["featurize.morgan", "featurize.none", "featurize.none", "own", "smiles_native", "none", None]


def test_fold_plan_with_many_sizes_plans_quickly(spark):
    plan, _ = S.group_kfold_plan([(s, 1 + s % 3) for s in range(1, 20_001)], 5)
    ranked = spark.range(100).select((F.col("id") + 1).alias("__s"), F.lit(1).alias("__rn"))
    began = time.time()
    seg = S.fold_segments_table(spark, plan)
    j = ranked.join(seg, (F.col("__s") == F.col("__fs")) & (F.col("__rn") > F.col("__after")) & (F.col("__rn") <= F.col("__upto")))
    assert j.count() == 100
    assert time.time() - began < 20


def test_featuriser_halves_failing_batches(spark):
    calls = []

    def fn(pdf):
        calls.append(len(pdf))
        if (pdf["x"] == 7).any():
            raise ValueError("bad row")
        return pdf.assign(y=pdf["x"] * 2.0)[["y"]]

    from pyspark.sql.types import DoubleType, LongType, StructField, StructType

    schema = StructType([StructField("id", LongType()), StructField("y", DoubleType())])
    df = spark.range(64).select("id", F.col("id").alias("x")).coalesce(1)
    kept = V.map_features(df, fn, schema, ["id"]).collect()
    assert [r.id for r in kept if r.y is None] == [7] and len(kept) == 64
    assert V.map_features(df, fn, schema, ["id"], on_error="drop").count() == 63


def test_pattern_catalogue_has_no_join(spark):
    texts = spark.createDataFrame([(1, "abc 12"), (2, "zzz"), (3, None)], "id long, t string")
    pats = spark.createDataFrame([("digits", r"\d+"), ("letters", "[a-c]{3}"), ("letters", "z{3}")], "catalog string, pattern string")
    out = V.catalogue_flags(texts, "id", "t", pats)
    assert sorted((r.id, r.catalogs, r.n_matches) for r in out.collect()) == [(1, ["digits", "letters"], 2), (2, ["letters"], 1)]
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_checkpoint_folder_must_be_set_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://somewhere:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context
        conf = type("C", (), {"get": staticmethod(lambda key, default=None: default)})

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session)


def test_audit_is_clean_on_a_clean_study(spark):
    m = {"r2": 0.5, "mae": 0.1}
    rows = [(f"c{i}", i, f"p{i // 2}", "COMPLETED", None, f"/c{i}", str(i), "robust", m, m, m, None) for i in range(6)]
    schema = "case_name string, case_index long, parent string, state string, failure_reason string, config_path string, job_id string, scaler string, train map<string,double>, test map<string,double>, val map<string,double>, top map<string,double>"
    raw = R.metric_rows(spark.createDataFrame(rows, schema))
    assert raw.first()["r2"] == 0.5 and raw.first()["val_mae"] == 0.1 and raw.first()["auc"] is None
    groups = R.aggregate_metric_rows(raw, "parent").withColumnRenamed("group_state", "state").withColumn("scaler", F.lit("robust"))
    records = groups.select("state")
    audit = R.integrity_audit(raw, groups, records, raw, raw, expected_folds=2)
    assert {r.issue: r.n for r in audit.collect() if r.n} == {}
    assert R.final_claim_ready(audit).first()[0]
    broken = R.integrity_audit(raw.where("case_index > 0"), groups, records, raw, raw, expected_folds=4)
    assert {r.issue for r in broken.collect() if r.n} == {"mapping_mismatch", "expected_not_divisible_by_folds", "execution_rows_differ_from_expected", "groups_with_missing_or_failed_slices"}
