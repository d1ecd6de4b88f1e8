import pytest

from tessera.functions import distributions as dist
from tessera.operators import stats as ST


def test_p_value_helpers():
    assert dist.t_sf_two_sided(2.0, 10) == pytest.approx(0.073388, abs=1e-6)
    assert dist.chi2_sf(3.84, 1) == pytest.approx(0.050044, abs=1e-6)
    assert 2 * dist.normal_sf(1.96) == pytest.approx(0.049996, abs=1e-6)


def _mw_bruteforce(a, b):
    allv = sorted(a + b)
    ranks = {}
    for v in set(allv):
        first = allv.index(v) + 1
        cnt = allv.count(v)
        ranks[v] = first + (cnt - 1) / 2
    r1 = sum(ranks[v] for v in a)
    return r1 - len(a) * (len(a) + 1) / 2


def test_mann_whitney_u_with_ties(spark):
    a = [1.0, 2.0, 2.0, 3.0, 5.0, 5.0, 8.0]
    b = [2.0, 3.0, 4.0, 4.0, 6.0, 9.0, 9.0, 10.0]
    rows = [("active", v) for v in a] + [("inactive", v) for v in b]
    df = spark.createDataFrame(rows, "class string, x double")
    r = ST.mann_whitney(df, "class", "active", "inactive", ["x"]).first()
    assert r.statistic == pytest.approx(_mw_bruteforce(a, b))
    t = ST.t_test(df, "class", "active", "inactive", ["x"]).first()
    assert t.dof == len(a) + len(b) - 2


def test_chi_squared_yates_2x2(spark):
    rows = [("a", "x")] * 10 + [("a", "y")] * 20 + [("b", "x")] * 30 + [("b", "y")] * 40
    df = spark.createDataFrame(rows, "r string, c string")
    res = ST.chi_squared(df, "r", "c").first()
    # expected 12,18,28,42 ; |O-E| = 2 -> Yates 1.5
    exp = sum(1.5 ** 2 / e for e in (12, 18, 28, 42))
    assert res.statistic == pytest.approx(exp) and res.dof == 1
