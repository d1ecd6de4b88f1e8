import importlib.util
import os

import pytest
from pyspark.sql import functions as F

from tessera.operators import grid as G

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_size_guard_refuses_large_grid(spark):
    axes = {"a": spark.range(200).select(F.col("id").cast("string")),
            "b": spark.range(100).select(F.col("id").cast("string"))}
    row = G.axes_row(axes)
    with pytest.raises(ValueError):
        G.size_guard(row, ["a", "b"], max_cases=10_000)
    with pytest.raises(ValueError):
        G.axes_row(axes, max_cases=150)
    assert G.size_guard(row, ["a", "b"], max_cases=20_000) == 20_000


def test_expand_product_order(spark):
    axes = {"b": spark.createDataFrame([("x",), ("y",)], "v string"),
            "a": spark.createDataFrame([("1",), ("2",), ("3",)], "v string")}
    out = G.expand(G.axes_row(axes), ["a", "b"]).orderBy("combo_index").collect()
    assert [(r.a, r.b, r.combo_index) for r in out] == [("1", "x", 0), ("1", "y", 1), ("2", "x", 2),
                                                        ("2", "y", 3), ("3", "x", 4), ("3", "y", 5)]


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(REPO, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_contract(spark):
    mod = _entry()
    df = mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 3 and {r.split for r in rows} == {"train", "val", "test"}
    q, o = mod.queries(), mod.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 200
    # the corpus queries come from their own folder, and only when it is there
    from tessera.plans import QUERIES

    corpus = sorted(set(q) - set(QUERIES))
    assert not [name for name in QUERIES if name == "pipeline" or name.startswith("op")]
    present = os.path.isdir(os.path.join(REPO, "tessera", "llm")) and os.path.exists(os.path.join(REPO, "corpus_pipeline.py"))
    assert sorted(name.split("_")[0] for name in corpus) == (sorted([*(f"op{n}" for n in range(1, 14)), "pipeline"]) if present else [])
