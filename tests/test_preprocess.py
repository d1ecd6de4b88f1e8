import pytest
from pyspark.sql import functions as F

from tessera.operators import preprocess as X


def test_standard_scale_mean_zero(spark):
    df = spark.createDataFrame([(float(a), float(10 * a)) for a in range(1, 5)], "a double, b double")
    f = X.fit(df, ["a", "b"], scaler="standard", variance_threshold=0.0, corr_threshold=1.1)
    out = X.transform(df, f).agg(F.avg("a").alias("a"), F.avg("b").alias("b")).first()
    assert out.a == pytest.approx(0.0) and out.b == pytest.approx(0.0)


def test_identity_scale_unchanged(spark):
    df = spark.createDataFrame([(1.0, 4.0), (2.0, 5.0), (3.0, 6.0)], "a double, b double")
    f = X.fit(df, ["a", "b"], scaler="none", variance_threshold=0.0, corr_threshold=1.1)
    assert [tuple(r) for r in X.transform(df, f).collect()] == [(1.0, 4.0), (2.0, 5.0), (3.0, 6.0)]


def test_minmax_clipped_on_new_data(spark):
    train = spark.createDataFrame([(1.0, 10.0), (2.0, 20.0), (3.0, 30.0)], "a double, b double")
    new = spark.createDataFrame([(0.0, 0.0), (4.0, 40.0)], "a double, b double")
    f = X.fit(train, ["a", "b"], scaler="minmax", variance_threshold=0.0, corr_threshold=1.1)
    out = [tuple(r) for r in X.transform(new, f).collect()]
    assert out == [(0.0, 0.0), (1.0, 1.0)]


def test_robust_scale_matches_numpy_quantiles(spark):
    import numpy as np
    vals = [1.0, 2.0, 2.0, 3.0, 7.0, 11.0, 12.0]
    df = spark.createDataFrame([(v,) for v in vals], "a double")
    f = X.fit(df, ["a"], scaler="robust", variance_threshold=0.0)
    q25, q50, q75 = np.percentile(vals, [25, 50, 75])
    assert f.center["a"] == pytest.approx(q50) and f.scale["a"] == pytest.approx(q75 - q25)


def test_correlation_prune_uses_earlier_dropped_columns(spark):
    rows = [(float(i), float(2 * i), float(-i) + (i % 3)) for i in range(30)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    f = X.fit(df, ["a", "b", "c"], scaler="standard", variance_threshold=0.0, corr_threshold=0.95)
    assert "b" in f.corr_drop


def test_no_feature_left_raises(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "a double")
    with pytest.raises(ValueError):
        X.fit(df, ["a"], scaler="standard")


def test_leakage_query_compares_all_features(spark, tmp_path):
    """One quantity and discount everywhere: two columns call every test row
    seen, but prices tell the rows apart."""
    from tessera.plans import QUERIES, load_all

    load_all()
    rows = [(k, 1, k, k, 5.0, 100.0 + k, 0.05, 0.02) for k in range(200)]
    columns = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double"
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert QUERIES["x8_leakage_check_after_transform"](spark, str(tmp_path)).first()[0] == 40
    assert QUERIES["x8_leakage_check_all_features"](spark, str(tmp_path)).first()[0] == 0


def test_quality_checks_judge_whole_rows(spark, tmp_path):
    """Equal in the three columns of the short check, different in others."""
    from tessera.plans import QUERIES, load_all

    load_all()
    rows = [(k, k, 7, "R", "F", 5.0) for k in range(20)]
    columns = "l_orderkey long, l_linenumber long, l_partkey int, l_returnflag string, l_linestatus string, l_quantity double"
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert QUERIES["x11_quality_checks"](spark, str(tmp_path)).first().has_duplicates
    got = QUERIES["x11_quality_checks_all_columns"](spark, str(tmp_path)).first()
    assert (got.n_distinct_rows, got.has_duplicates, got.n_constant_columns) == (20, False, 4)


def test_reports_hold_all_features_and_bits(spark):
    from tessera.plans import QUERIES, load_all

    load_all()
    small = "/root/testdata/sf0.001"
    assert QUERIES["x10_stable_top_k_features"](spark, small).count() == 4
    assert QUERIES["v5_fingerprint_expansion_documents"](spark, small).count() == 2048
