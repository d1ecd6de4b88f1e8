import pytest
from pyspark.sql import functions as F

from tessera.operators import curate as C
from tessera.operators import dedupe as D
from tessera.sources.tables import ROW_INDEX


def test_required_columns(spark):
    df = spark.createDataFrame([("CCO", 1.0, 10.0), ("CCN", None, 20.0), (None, 3.0, None)],
                               "canonical_smiles string, target double, aux double")
    out = C.require_non_null(df, ["canonical_smiles", "target"])
    assert [r.canonical_smiles for r in out.collect()] == ["CCO"]
    with pytest.raises(ValueError):
        C.require_non_null(df, ["nope"])


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "t double")
    assert C.drop_missing_target(df, "t").count() == 1


def test_filter_before_dedupe_changes_winner(spark):
    df = spark.createDataFrame([(0, "CCO", "T1", 1.0), (1, "CCO", "T2", 2.0), (2, "CCN", "T2", 3.0)],
                               f"{ROW_INDEX} long, canonical_smiles string, target_chembl_id string, standard_value double")
    out = D.dedupe(C.row_filters(df, {"target_chembl_id": "T2"}), "canonical_smiles", "first")
    got = {r.canonical_smiles: r.standard_value for r in out.collect()}
    assert got == {"CCO": 2.0, "CCN": 3.0}
    with pytest.raises(ValueError):
        C.row_filters(df, {"target_chembl_id": []})


def test_row_id_kept_and_projection(spark):
    df = spark.createDataFrame([(100, "C", 1.0, "x"), (101, "N", 2.0, "y")],
                               f"{ROW_INDEX} long, SMILES string, target double, ignored string")
    out = C.select_columns(df, "SMILES", properties=["target"])
    assert out.columns == [ROW_INDEX, "SMILES", "target"]


def test_class_bucket(spark):
    df = spark.createDataFrame([(500.0,), (5000.0,), (20000.0,)], "standard_value double")
    out = C.label_classes(df, "standard_value")
    assert [r["class"] for r in out.orderBy("standard_value").collect()] == ["active", "intermediate", "inactive"]


def test_label_mapping_mixed_and_text(spark):
    df = spark.createDataFrame([("1",), ("0",), (" 1.0 ",), ("0.0",), ("active",), ("inactive",), ("other",)], "v string")
    out = C.normalize_binary_labels(df, "v", "y", positive=["active"], negative=["inactive"])
    assert sorted(r.y for r in out.collect()) == [0, 0, 0, 1, 1, 1]


def test_strict_binary_rejects_three_values(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "v string")
    with pytest.raises(ValueError):
        C.strict_binary(df, "v")


def test_neg_log10_and_cap(spark):
    df = spark.createDataFrame([(1000.0,), (1e9,)], "v double")
    vals = [r.p for r in df.select(C.neg_log10_nano(F.col("v")).alias("p")).collect()]
    assert vals[0] == pytest.approx(6.0) and vals[1] == pytest.approx(1.0)


def test_feature_name_sanitising():
    pairs = C.sanitize_feature_names(["a[1]", "a<1>", "", "feature"])
    assert [p[1] for p in pairs] == ["a_1_", "a_1___2", "feature", "feature__2"]


def test_one_hot_and_exclusions(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id int, c string")
    out = C.one_hot(df, ["c"])
    assert out.columns == ["id", "c_missing", "c_x"]
    assert C.exclude_columns(df, ["c", "c", "zzz"]).columns == ["id"]
