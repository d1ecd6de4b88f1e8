"""Quantiles by radix select, blocked correlations and hash cuts against numpy and plain sorts."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import correlation, radix_select
from tessera.operators import preprocess as X
from tessera.operators import split as S
from tessera.operators.ranks import hash_cuts
from tessera.functions.hashing import hash_key


def test_sort_keys_order_like_values():
    v = np.array([-np.inf, -1e300, -2.5, -1e-310, -0.0, 0.0, 5e-324, 1.0, 1.0000000000000002, 3e200, np.inf])
    keys = radix_select.sort_keys(v)
    assert (np.diff(keys.astype(object)) >= 0).all() and keys[4] == keys[5]
    assert [radix_select.key_value(int(k)) for k in keys] == v.tolist()


def test_column_quantiles_match_numpy(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(3000):
        group = rnd.choice(["a", "a", "a", "b", None, 'q"uote'])
        rows.append((group, rnd.choice([None, math.nan, rnd.gauss(0, 1e6)]), float(rnd.randrange(4)), -(10 ** rnd.uniform(-300, 300)), None))
    rows.append(("single", 7.0, None, -0.0, None))
    df = spark.createDataFrame(rows, "k string, a double, `b.c` double, d double, none double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    for groups in ([], ["k"]):
        got = radix_select.column_quantiles(df, ["a", "b.c", "d", "none"], probs, groups).collect()
        want = {}
        for g in {r[0] for r in rows} if groups else {"all"}:
            for j, c in enumerate(["a", "b.c", "d", "none"]):
                v = [r[j + 1] for r in rows if (not groups or r[0] == g) and r[j + 1] is not None and not math.isnan(r[j + 1])]
                if v:
                    want[g, c] = np.percentile(v, [100 * p for p in probs])
        assert len(got) == len(want)
        for r in got:
            assert [r[f"q{i}"] for i in range(5)] == pytest.approx(list(want[r.k if groups else "all", r.column]), rel=1e-12)
    assert radix_select.exact_quantiles(df.limit(0), "a", [0.5], ["k"]).collect() == []
    with pytest.raises(ValueError):
        radix_select.exact_quantiles(df, "d", [0.5], ["k"], max_groups=2)


def test_counters_pass_on_when_full(spark, monkeypatch):
    """The held counters are bounded; the result does not depend on it."""
    counters = radix_select._Counters(1)
    for part in range(3):
        counters.add(0, np.zeros(4, np.uint64), np.array([1, 1, 2, part], np.uint64))
    counters.merge()
    assert [x.tolist() for x in counters.parts[0][0]] == [[0, 1, 2], [1, 7, 4]]


def test_quantile_plan_moves_no_value(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)], "v double")
    rows = df.select(F.lit("").alias("g"), F.col("v").alias("v0"))
    plan = rows.mapInArrow(radix_select._count_digits(0, 1, [], None), "g string, c int, prefix long, digit int, n long")._jdf.queryExecution().toString()
    assert "Exchange" not in plan


def frame(spark, x, names):
    return spark.createDataFrame([tuple(None if v is None else float(v) for v in r) for r in x], ", ".join(f"`{n}` double" for n in names)).repartition(4)


@pytest.mark.parametrize("block", [3, 256])
def test_correlations_match_pandas(spark, block):
    import pandas as pd

    rng = np.random.default_rng(7)
    x = rng.normal(1e6, 1.0, (400, 8))
    x[:, 1] = 2 * x[:, 0] - 3
    x[:, 2] += -x[:, 0]
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 5] = 4.0  # constant
    x[:, 6] = rng.normal(size=400)  # complete
    x[:, 7] = np.nan
    names = [f"c.{i}" for i in range(8)]
    want = pd.DataFrame(x).corr().to_numpy()
    got = {(r.i, r.j): r.r for r in correlation.correlations(frame(spark, x, names), names, block=block).collect()}
    assert set(got) == {(i, j) for j in range(8) for i in range(j)}
    for (i, j), r in got.items():
        if np.isnan(want[i, j]):
            assert r is None
        else:
            assert r == pytest.approx(want[i, j], abs=1e-9)
    assert correlation.correlations(frame(spark, x[:, :1], ["a"]), ["a"]).collect() == []


def test_correlations_of_many_columns_in_one_scan(spark):
    """600 columns are three blocks: one scan, and no expression per pair."""
    rng = np.random.default_rng(9)
    base = rng.normal(size=(60, 20))
    x = base @ rng.normal(size=(20, 600))
    names = [f"c{i}" for i in range(600)]
    df = frame(spark, x, names)
    out = correlation.correlations(df, names, shift=[0.0] * 600)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    got = np.eye(600)
    for r in out.collect():
        got[r.i, r.j] = got[r.j, r.i] = r.r
    assert np.allclose(got, np.corrcoef(x.T), atol=1e-9)


def test_fit_drops_the_later_of_a_pair(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(300, 4))
    x[:, 2] = x[:, 0] + 0.01 * rng.normal(size=300)
    x[:, 3] = -x[:, 2] + 0.01 * rng.normal(size=300)
    fitted = X.fit(frame(spark, x, list("abcd")), list("abcd"), scaler="robust")
    assert fitted.corr_drop == ["c", "d"] and fitted.kept == ["a", "b"]
    q = np.percentile(x[:, 1], [25, 50, 75])
    assert fitted.center["b"] == pytest.approx(q[1]) and fitted.scale["b"] == pytest.approx(q[2] - q[0])


@pytest.mark.parametrize("few", [10_000, 3])
def test_hash_cuts_are_the_ranks(spark, few):
    ids = [f"r{i}" for i in range(2000)] + ["same"] * 40
    df = spark.createDataFrame([(i,) for i in ids], "id string").repartition(3)
    order = sorted((hashlib.md5(f"9:{i}".encode()).hexdigest(), i) for i in ids)
    wanted = [0, 1, 77, 1000, 2040]
    n, cuts = hash_cuts(df, hash_key(9, "id"), "id", lambda n: wanted, few)
    assert n == 2040 and cuts == [None if r == 0 else order[r - 1] for r in wanted]
    assert hash_cuts(df.limit(0), hash_key(9, "id"), "id", lambda n: [n, n])[1] == [None, None]


def test_holdout_has_no_exchange(spark):
    df = spark.range(1000).select(F.col("id").alias("__row_index"))
    out = S.random_holdout(df, test_size=0.2, val_size=0.1, seed=3)
    assert "Exchange" not in out._jdf.queryExecution().toString()
    assert {r.split: r["count"] for r in out.groupBy("split").count().collect()} == {"test": 200, "val": 100, "train": 700}
    assert S.random_holdout(df.limit(0), test_size=0.2, val_size=0.1).collect() == []
