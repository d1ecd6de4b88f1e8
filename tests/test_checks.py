import pytest
from pyspark.sql import functions as F

from tessera.operators import checks as K


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_finite_rows(spark):
    df = frame(spark, [(1, 1.0), (2, None), (3, float("inf")), (4, float("nan"))], "__row_index long, x double")
    assert [r[0] for r in K.finite_rows(df, ["x"]).collect()] == [1]
    assert K.finite_rows(df, ["x"], mode="keep").count() == 4
    with pytest.raises(ValueError, match="3 rows"):
        K.finite_rows(df, ["x"], mode="fail")
    assert K.finite_rows(df.limit(1), ["x"], mode="fail").count() == 1


def test_distinct_feature_rows(spark):
    df = frame(spark, [(3, 1.0, None, "c"), (1, 1.0, None, "a"), (2, 2.0, "y", "b")], "__row_index long, x double, y string, note string")
    assert sorted(map(tuple, K.distinct_feature_rows(df, ["x", "y"]).collect())) == [(1, 1.0, None, "a"), (2, 2.0, "y", "b")]
    assert K.distinct_feature_rows(df, ["x", "y"], mode="keep").count() == 3
    with pytest.raises(ValueError, match="1 rows"):
        K.distinct_feature_rows(df, ["x", "y"], mode="fail")


@pytest.mark.parametrize("ids, ok", [(["1", "2.0"], True), (["1", None], False), (["1", "x"], False), (["1", "1.5"], False), (["1", "1"], False)])
def test_valid_row_index(spark, ids, ok):
    df = frame(spark, [(i,) for i in ids], "__row_index string")
    if ok:
        assert dict(K.valid_row_index(df).dtypes) == {"__row_index": "bigint"}
    else:
        with pytest.raises(ValueError):
            K.valid_row_index(df)


def test_numeric_features(spark):
    df = frame(spark, [("1", "a", 3), ("2", None, 4)], "x string, y string, target int")
    with pytest.raises(ValueError, match="'y': 1"):
        K.numeric_features(df, "target")
    with pytest.raises(ValueError):
        K.numeric_features(df.select("target"), "target")
    assert K.numeric_features(df.select("x", "target"), "target").first()["x"] == 1.0


def test_checked_fold(spark):
    folds = frame(spark, [(i, r, (i + r) % 3) for i in range(6) for r in range(2)], "__row_index long, repeat int, fold int")
    assert sorted(r[0] for r in K.checked_fold(folds, 1, 2).where("split = 'test'").collect()) == [1, 4]
    for bad in ((2, 0), (0, 3), (-1, 0)):
        with pytest.raises(ValueError):
            K.checked_fold(folds, *bad)


def splits(spark, **parts):
    return frame(spark, [(i, p) for p, ids in parts.items() for i in ids], "__row_index long, split string")


def test_checked_split(spark):
    rows = spark.range(10).withColumnRenamed("id", "__row_index")
    good = splits(spark, train=[0, 1, 2, 3], val=[4], test=[5])
    assert K.checked_split(good, rows, min_coverage=0.6).count() == 6
    for bad, kw in [
        (splits(spark, train=[0, 99], val=[1], test=[2]), {}),
        (good, {"min_coverage": 0.7}),
        (splits(spark, train=[0, 1], val=[2], test=[1]), {}),
        (splits(spark, train=[0, 1], test=[2]), {}),
        (splits(spark, val=[0, 1], test=[2]), {}),
    ]:
        with pytest.raises(ValueError):
            K.checked_split(bad, rows, **kw)
    K.checked_split(splits(spark, train=[0, 1], test=[2]), rows, val_expected=False)
    with pytest.warns(UserWarning):
        K.checked_split(splits(spark, train=[0, 1], val=[2], test=[1]), rows, disjoint=False)


def test_resolved_partitions(spark):
    rows = spark.range(8).withColumnRenamed("id", "__row_index")
    got = K.resolved_partitions(splits(spark, train=[1, 2, 20], val=[3, 30]), rows)
    assert sorted(map(tuple, got.collect())) == [(1, "train"), (2, "train"), (3, "test")]
    with pytest.raises(ValueError, match="test: 1 of 2"):
        K.resolved_partitions(splits(spark, train=[1], test=[3, 30]), rows, min_coverage={"test": 1.0})
    with pytest.raises(ValueError, match="empty"):
        K.resolved_partitions(splits(spark, train=[1], test=[30]), rows)


def test_split_positions(spark):
    rows = frame(spark, [(30,), (10,), (20,)], "__row_index long")
    got = K.split_positions(splits(spark, train=[20, 30], val=[10]), rows)
    assert sorted(map(tuple, got.collect())) == [(0, "test"), (1, "train"), (2, "train")]
    old = splits(spark, train=[0, 1], test=[2])
    with pytest.raises(ValueError, match="look like positions"):
        K.split_positions(old, rows)
    assert sorted(map(tuple, K.split_positions(old, rows, positions_allowed=True).collect())) == [(0, "train"), (1, "train"), (2, "test")]
    with pytest.raises(ValueError):
        K.split_positions(splits(spark, train=[20], test=[77]), rows, positions_allowed=True)
    with pytest.raises(ValueError):
        K.split_positions(old, rows.union(rows))
