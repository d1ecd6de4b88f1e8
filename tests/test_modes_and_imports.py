import json

import pytest
from pyspark.sql import functions as F

from tessera.operators import eda as E
from tessera.operators import grid as G
from tessera.operators import grid_rules as R
from tessera.operators import metrics as K
from tessera.operators import runs as U
from tessera.operators import split as S
from tessera.sources.files import scratch_path


def test_task_modes_and_profiles(spark):
    binary = E.probe(spark.createDataFrame([("yes",), (" No",), (None,)], "y string"), "y", ["Smiles", "y"])
    numbers = E.probe(spark.createDataFrame([(1.5,)], "y double"), "y", ["Smiles"])
    assert (binary.first()["resolved_key"], numbers.first()["resolved_key"]) == ("y", None)
    assert [E.task_of(binary, "auto", True), E.task_of(numbers, " AUTO", True), E.task_of(binary, "Regression")] == \
        ["classification", "regression", "regression"]
    for asked, confirmed, says in (("auto", False, "confirmed"), ("", True, "must be"), ("rank", True, "must be")):
        with pytest.raises(ValueError, match=says):
            E.task_of(binary, asked, confirmed)
    with pytest.raises(ValueError, match="no target"):
        E.task_of(binary.withColumn("binary_target", F.lit(None).cast("boolean")), "auto", True)
    assert [R.resolve_profile(*a).name for a in (("regression",), ("classification", " ChEMBL"), ("regression", "chembl"), ("classification", "tdc"),
            ("regression", "local_csv", "reg_local_csv_ic50"))] == ["reg_local_csv", "clf_local_csv", "reg_chembl_ic50", "clf_tdc_benchmark", "reg_local_csv_ic50"]
    for bad in (("regression", "tdc"), ("regression", "local_csv", "nope"), ("classification", "local_csv", "reg_local_csv")):
        with pytest.raises(ValueError):
            R.resolve_profile(*bad)


def test_contract_modes_and_row_types(spark):
    df = spark.createDataFrame([("1", "2.0", "t", "x"), (None, "2.5", "maybe", "y"), ("q", "12345678901234567890", "0", None)],
                               "n string, i string, b string, s string")
    types = {"n": "number", "i": "integer", "b": "boolean", "s": "string", "absent": "number"}
    assert sorted(map(tuple, E.row_type_violations(df, types).collect())) == [("not_boolean", "b", 1), ("not_integer", "i", 1), ("not_number", "n", 1)]
    assert E.row_type_violations(df, {"s": "string"}).count() == 0 and E.row_type_violations(df.limit(0), types).count() == 0
    with pytest.raises(ValueError, match="unknown row types"):
        E.row_type_violations(df, {"s": "smell"})
    assert E.checked_contract(df, "rows", ["n"], [["s", "q"], []], 4, {"s": "string"}, mode="fail")
    with pytest.warns(UserWarning, match="missing_required_column z"):
        assert not E.checked_contract(df, "rows", ["z"])
    with pytest.raises(ValueError, match="too_few_columns 9 .4.; not_number n .1."):
        E.checked_contract(df, "rows", min_columns=9, types={"n": "number"}, mode="fail")
    with pytest.raises(ValueError, match="mode"):
        E.checked_contract(df, "rows", mode="maybe")


def test_metric_inputs_error_mode(spark):
    good = spark.createDataFrame([(1, 0.5), (0, 0.2)], "y int, p double")
    assert K.checked_inputs(good, "y", "p").count() == 2
    bad = good.unionByName(spark.createDataFrame([(None, float("nan")), (1, None)], "y int, p double"))
    assert [tuple(r) for r in K.input_problems(bad, ["y", "p"]).collect()] == [("y", 4, 1, 0), ("p", 4, 1, 1)]
    with pytest.raises(ValueError, match="test scores: y: 1 of 4 missing, 0 not finite; p: 1 of 4 missing, 1 not finite"):
        K.checked_inputs(bad, "y", "p", "test scores")


def test_nested_payload(spark):
    path = scratch_path(spark, "payload")
    doc = {"note": "x", "By_Scaffold": {"train": ["a", "b"], "Valid": ["c"], "test": []}, "random": {"train": ["c"], "test": ["a"]}}
    spark.createDataFrame([(json.dumps(doc),)], "value string").write.text(path)
    rows = S.split_payload(spark.read.json(path))
    got = S.chosen_parts(rows, "scaffold")
    assert sorted((r.split, r.key, r.position) for r in got.collect()) == [("train", "a", 0), ("train", "b", 1), ("val", "c", 0)]
    flat = spark.createDataFrame([("Train", "a"), ("TEST", "b"), ("validation", "c"), ("scaffold.train", "z"), (None, "n")], "path string, key string")
    assert sorted((r.split, r.key) for r in S.chosen_parts(flat, "scaffold").collect()) == [("test", "b"), ("train", "a"), ("val", "c")]
    with pytest.raises(ValueError, match="no split for 'time'"):
        S.chosen_parts(rows, "time")
    with pytest.raises(ValueError, match="no list"):
        S.split_payload(spark.createDataFrame([("x",)], "note string"))


def test_split_coverage(spark):
    ids = lambda n: spark.range(n).withColumnRenamed("id", "__row_index")
    splits = spark.createDataFrame([(0, "train"), (1, "test"), (1, "val")], "__row_index long, split string")
    assert tuple(S.split_coverage(splits, ids(8), ids(10)).first()) == (10, 8, 2, 2, 0.25)
    assert tuple(S.split_coverage(splits.limit(0), ids(0), ids(0)).first()) == (0, 0, 0, 0, 0.0)
    assert tuple(S.split_coverage(splits, ids(8), ids(5)).first())[2] == 0


def test_dotted_paths(spark):
    df = spark.createDataFrame([({"a.b": "1", "a.bc": "2", "d": "3"},), ({},), (None,)], "m map<string,string>")
    run = lambda c: [r[0] for r in df.select(c).collect()]
    m = F.col("m")
    assert run(G.set_dotted(m, "a", "9")) == [{"a": "9", "d": "3"}, {"a": "9"}, {"a": "9"}]
    assert run(G.set_dotted(m, "d.e.f", "9")) == [{"a.b": "1", "a.bc": "2", "d.e.f": "9"}, {"d.e.f": "9"}, {"d.e.f": "9"}]
    assert run(G.set_dotted(m, "..", "9")) == [{"a.b": "1", "a.bc": "2", "d": "3"}, {}, {}]
    assert run(G.remove_dotted(m, "a.b")) == [{"a.bc": "2", "d": "3"}, {}, None]
    assert run(G.remove_dotted(m, "a")) == [{"d": "3"}, {}, None]
    assert run(G.extract_prefixed(m, "a.")) == [{"b": "1", "bc": "2"}, {}, None]
    assert run(G.extract_prefixed(m, "a.b")) == [{"c": "2"}, {}, None]


def test_factor_counts(spark):
    df = spark.createDataFrame([("x", 1, "ok"), ("x", None, "ok"), ("y", 1, "no")], "a string, b int, state string")
    got = U.factor_counts(df, {"a": F.col("a"), "b": F.col("b")}, by=["state"])
    assert sorted(map(tuple, got.collect())) == [("no", "a", "y", 1), ("no", "b", "1", 1), ("ok", "a", "x", 2), ("ok", "b", "", 1), ("ok", "b", "1", 1)]
