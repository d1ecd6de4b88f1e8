"""Group-test queries (H1-H7): lineitem, class ``l_returnflag`` A vs R."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import stats as ST
from tessera.plans import register
from tessera.sources.tables import table

DESCRIPTORS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

LONG_SQL = """long AS (
  SELECT descriptor, l_returnflag = 'A' AS is_a, v FROM (
    UNPIVOT (SELECT l_returnflag, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem
             WHERE l_returnflag IN ('A', 'R'))
    ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME descriptor VALUE v)
  WHERE v IS NOT NULL AND NOT isnan(v))"""

MW_SQL = f"""{LONG_SQL},
vc AS (SELECT descriptor, v, count(*) FILTER (WHERE is_a) AS na, count(*) FILTER (WHERE NOT is_a) AS nb,
              count(*) AS n FROM long GROUP BY 1, 2),
r AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY descriptor ORDER BY v
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM vc),
per AS (SELECT descriptor, CAST(sum(na) AS DOUBLE) AS n1, CAST(sum(nb) AS DOUBLE) AS n2,
               sum(na * (before + (n + 1) / 2.0)) AS r1, sum(n::DOUBLE * n * n - n) AS tie FROM r GROUP BY 1),
u AS (SELECT *, r1 - n1 * (n1 + 1) / 2.0 AS u1 FROM per),
mw AS (SELECT descriptor, CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, u1 AS statistic,
       (greatest(u1, n1 * n2 - u1) - n1 * n2 / 2.0 - 0.5)
         / sqrt(n1 * n2 / 12.0 * ((n1 + n2 + 1) - tie / ((n1 + n2) * (n1 + n2 - 1)))) AS z FROM u)"""

TT_SQL = f"""{LONG_SQL},
g AS (SELECT descriptor, count(*) FILTER (WHERE is_a) AS n1, count(*) FILTER (WHERE NOT is_a) AS n2,
             avg(v) FILTER (WHERE is_a) AS m1, avg(v) FILTER (WHERE NOT is_a) AS m2,
             var_samp(v) FILTER (WHERE is_a) AS s1, var_samp(v) FILTER (WHERE NOT is_a) AS s2 FROM long GROUP BY 1),
tt AS (SELECT descriptor, n1, n2, (m1 - m2) / sqrt(((n1 - 1) * s1 + (n2 - 1) * s2) / (n1 + n2 - 2)
         * (1.0 / n1 + 1.0 / n2)) AS statistic, CAST(n1 + n2 - 2 AS DOUBLE) AS dof FROM g)"""


def _chi2_sql(src: str, r: str, c: str, name: str) -> str:
    return f"""
cnt_{name} AS (SELECT CAST({r} AS VARCHAR) AS r, CAST({c} AS VARCHAR) AS c, count(*) AS o FROM {src}
        WHERE {r} IS NOT NULL AND {c} IS NOT NULL GROUP BY 1, 2),
grid_{name} AS (SELECT rr.r, cc.c FROM (SELECT DISTINCT r FROM cnt_{name}) rr, (SELECT DISTINCT c FROM cnt_{name}) cc),
cells_{name} AS (SELECT g.r, g.c, coalesce(o, 0) AS o FROM grid_{name} g LEFT JOIN cnt_{name} USING (r, c)),
rt_{name} AS (SELECT r, sum(o) AS rt FROM cells_{name} GROUP BY r),
ct_{name} AS (SELECT c, sum(o) AS ct FROM cells_{name} GROUP BY c),
tot_{name} AS (SELECT sum(o) AS n, count(DISTINCT r) AS nr, count(DISTINCT c) AS nc FROM cells_{name}),
ex_{name} AS (SELECT o, rt * ct / n AS e, (nr - 1) * (nc - 1) AS dof FROM cells_{name}
        JOIN rt_{name} USING (r) JOIN ct_{name} USING (c), tot_{name}),
chi_{name} AS (SELECT '{c}' AS descriptor, sum(power(CASE WHEN dof = 1 THEN greatest(abs(o - e) - 0.5, 0)
        ELSE abs(o - e) END, 2) / e) AS statistic, CAST(first(dof) AS DOUBLE) AS dof FROM ex_{name})"""


@register("h1_mann_whitney_u", "WITH " + MW_SQL + """
SELECT descriptor, n1, n2, round(statistic, 6) AS statistic, round(z, 6) AS z FROM mw""")
def h1(spark, sf_dir):
    res = ST.mann_whitney(table(spark, sf_dir, "lineitem"), "l_returnflag", "A", "R", DESCRIPTORS)
    return res.select("descriptor", "n1", "n2", F.round("statistic", 6).alias("statistic"), F.round("z", 6).alias("z"))


@register("h2_student_t_test", "WITH " + TT_SQL + """
SELECT descriptor, n1, n2, round(statistic, 6) AS statistic, dof FROM tt""")
def h2(spark, sf_dir):
    res = ST.t_test(table(spark, sf_dir, "lineitem"), "l_returnflag", "A", "R", DESCRIPTORS)
    return res.select("descriptor", "n1", "n2", F.round("statistic", 6).alias("statistic"), "dof")


@register("h3_crosstab", """
SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') AS "F", count(*) FILTER (WHERE l_linestatus = 'O') AS "O"
FROM lineitem GROUP BY 1""")
def h3(spark, sf_dir):
    return ST.crosstab_wide(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus")


@register("h4_chi_squared_yates", "WITH " + _chi2_sql("(SELECT * FROM lineitem WHERE l_returnflag IN ('A', 'R'))", "l_returnflag",
                                                       "l_linestatus", "a") + """
SELECT descriptor, round(statistic, 6) AS statistic, dof FROM chi_a""")
def h4(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag").isin("A", "R"))
    res = ST.chi_squared(li, "l_returnflag", "l_linestatus")
    return res.select("descriptor", F.round("statistic", 6).alias("statistic"), "dof")


@register("h4_chi_squared_multi", "WITH " + _chi2_sql("orders", "o_orderstatus", "o_orderpriority", "b") + """
SELECT descriptor, round(statistic, 6) AS statistic, dof FROM chi_b""")
def h4b(spark, sf_dir):
    res = ST.chi_squared(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")
    return res.select("descriptor", F.round("statistic", 6).alias("statistic"), "dof")


@register("h5_cardinality_guard", """
SELECT 'o_orderpriority' AS column_name, count(DISTINCT o_orderpriority) AS n_distinct,
       count(DISTINCT o_orderpriority) <= 20 AS chi2_allowed FROM orders
UNION ALL SELECT 'o_custkey', count(DISTINCT o_custkey), count(DISTINCT o_custkey) <= 20 FROM orders""")
def h5(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    out = None
    for c in ("o_orderpriority", "o_custkey"):
        allowed = ST.cardinality_guard(o, c)
        row = o.agg(F.count_distinct(c).alias("n_distinct")).select(
            F.lit(c).alias("column_name"), "n_distinct", F.lit(allowed).alias("chi2_allowed"))
        out = row if out is None else out.unionByName(row)
    return out


@register("h6_p_values_and_decisions")
def h6(spark, sf_dir):
    """p-values (special functions on the one-row-per-test table): rows-only."""
    li = table(spark, sf_dir, "lineitem")
    mw = ST.with_p_value(ST.mann_whitney(li, "l_returnflag", "A", "R", DESCRIPTORS), "mannwhitney")
    tt = ST.with_p_value(ST.t_test(li, "l_returnflag", "A", "R", DESCRIPTORS), "ttest")
    ch = ST.with_p_value(ST.chi_squared(li.filter(F.col("l_returnflag").isin("A", "R")), "l_returnflag",
                                        "l_linestatus"), "chi2")
    cols = ["descriptor", "statistic", "p", "alpha", "interpretation"]
    return mw.select(*cols, F.lit("Mann-Whitney U").alias("test")).unionByName(
        tt.select(*cols, F.lit("t-test").alias("test"))).unionByName(ch.select(*cols, F.lit("chi-squared").alias("test")))


@register("h7_test_battery", "WITH " + MW_SQL + ",\n" + TT_SQL.replace(LONG_SQL + ",", "") + ","
          + _chi2_sql("(SELECT * FROM lineitem WHERE l_returnflag IN ('A', 'R'))", "l_returnflag", "l_linestatus", "a") + """
SELECT descriptor, 'Mann-Whitney U' AS test, round(statistic, 6) AS statistic FROM mw
UNION ALL SELECT descriptor, 't-test', round(statistic, 6) FROM tt
UNION ALL SELECT descriptor, 'chi-squared', round(statistic, 6) FROM chi_a""")
def h7(spark, sf_dir):
    res = ST.battery(table(spark, sf_dir, "lineitem"), "l_returnflag", "A", "R", DESCRIPTORS, "l_linestatus")
    return res.select("descriptor", "test", F.round("statistic", 6).alias("statistic"))
