"""Row ids, sparse one-hot codes and flags of missing documents."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import checks, curate
from tessera.operators import runs as R
from tessera.sources.tables import ROW_INDEX


def test_ids_beyond_doubles_are_told_apart(spark):
    big = 1 << 53
    df = spark.createDataFrame([(big,), (big + 1,), (-(1 << 62),)], f"{ROW_INDEX} long")
    assert [r[0] for r in checks.valid_row_index(df).collect()] == [big, big + 1, -(1 << 62)]
    text = spark.createDataFrame([("7.0",), (" 8 ",), ("1E3",), ("9007199254740993",)], f"{ROW_INDEX} string")
    assert [r[0] for r in checks.valid_row_index(text).collect()] == [7, 8, 1000, 9007199254740993]
    for bad in ("7.5", "x", "99999999999999999999"):
        with pytest.raises(ValueError):
            checks.valid_row_index(spark.createDataFrame([(bad,)], f"{ROW_INDEX} string"))
    with pytest.raises(ValueError, match="more than once"):
        checks.valid_row_index(spark.createDataFrame([(big + 1,), (big + 1,)], f"{ROW_INDEX} long"))


def test_dense_row_ids(spark, tmp_path):
    df = spark.createDataFrame([(f"v{i}",) for i in range(1000)], "v string").repartition(7)
    out = curate.assign_row_index(df.where("v <> 'v3'"))
    rows = out.collect()
    assert [r[ROW_INDEX] for r in rows] == list(range(999)) and len({r.v for r in rows}) == 999
    assert "PythonRDD" not in out._jdf.queryExecution().toRdd().toDebugString()
    df.write.parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    one, two = (sorted(map(tuple, curate.assign_row_index(stored, stored=True).collect())) for _ in range(2))
    assert one == two and sorted(i for _, i in one) == list(range(1000))
    assert curate.assign_row_index(df.limit(0)).collect() == []
    assert curate.assign_row_index(out).columns == out.columns


def test_sparse_one_hot(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("b", 4), ("é", 5)], "c string, n int").repartition(3)
    rows, dictionary = curate.one_hot_sparse(df, "c")
    assert {r.value: r.position for r in dictionary.collect()} == {"a": 0, "b": 1, "missing": 2, "é": 3}
    got = {r.n: (r.c.size, list(r.c.indices), list(r.c["values"])) for r in rows.collect()}
    assert got == {1: (4, [1], [1.0]), 2: (4, [0], [1.0]), 3: (4, [2], [1.0]), 4: (4, [1], [1.0]), 5: (4, [3], [1.0])}
    assert rows.columns == ["c", "n"]


def test_one_hot_of_many_values(spark):
    many = spark.range(50_000).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError):
        curate.one_hot(many, ["c"])
    rows, dictionary = curate.one_hot_sparse(many, "c")
    at = rows.select(F.col("c.indices")[0].alias("i"), F.col("c.size").alias("s"))
    assert at.agg(F.count_distinct("i"), F.max("i"), F.min("s")).first()[:] == (50_000, 49_999, 50_000)


def test_missing_split_metrics(spark):
    rows = [("COMPLETED", None, False, False), ("COMPLETED", "x", True, False), ("COMPLETED", None, True, True), ("FAILED", "y", True, False)]
    df = spark.createDataFrame(rows, "state string, failure_reason string, m boolean, s boolean")
    got = [(r.state, r.failure_reason) for r in R.mark_missing_metrics(df, F.col("m"), F.col("s")).collect()]
    assert [g[0] for g in got] == ["PARTIAL", "PARTIAL", "COMPLETED", "FAILED"]
    assert "missing_metrics" in got[0][1] and "missing_split_metrics" in got[1][1] and got[2][1] is None and got[3][1] == "y"
