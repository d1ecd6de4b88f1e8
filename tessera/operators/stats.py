"""Two-group tests and contingency statistics (H1-H7).

Statistics are exact aggregates; only the p-value (a special function of the
one-row-per-test result) is evaluated in Python, in an Arrow batch.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tessera.functions import distributions as dist
from tessera.operators.ranks import bounded_broadcast, running_sum

ALPHA = 0.05
# Fixed values that must equal the reference's behaviour.
SAME = "Same distribution (fail to reject H0)"
DIFFERENT = "Different distribution (reject H0)"
MAX_CHI2_VALUES = 20


def long_values(df: DataFrame, class_col: str, a: str, b: str, descriptors: list[str]) -> DataFrame:
    """(descriptor, is_a, v) for the two classes; missing values dropped."""
    two = df.filter(F.col(class_col).isin(a, b))
    long = two.select(F.col(class_col).alias("__cls"), F.explode(F.array(*[
        F.struct(F.lit(d).alias("descriptor"), F.col(d).cast("double").alias("v")) for d in descriptors])).alias("s"))
    return long.select("s.descriptor", (F.col("__cls") == a).alias("is_a"), "s.v").filter(
        F.col("v").isNotNull() & ~F.isnan("v"))


def mann_whitney(df: DataFrame, class_col: str, a: str, b: str, descriptors: list[str]) -> DataFrame:
    """H1: U of group ``a``, mid-ranks over both groups, tie-corrected z with
    continuity correction (two-sided asymptotic form).

    Per descriptor: value counts -> running count of smaller values (W3,
    skew-safe ``running_sum``) -> mid-rank -> rank sum.  No per-row sort.
    """
    long = long_values(df, class_col, a, b, descriptors)
    vc = long.groupBy("descriptor", "v").agg(F.count_if("is_a").alias("na"), F.count_if(~F.col("is_a")).alias("nb")) \
        .withColumn("n", F.col("na") + F.col("nb"))
    run = running_sum(vc, "descriptor", "v", ["n"])
    mid = F.col("n_before") + (F.col("n") + 1) / 2.0
    per = run.groupBy("descriptor").agg(
        F.sum("na").alias("n1"), F.sum("nb").alias("n2"),
        F.sum(F.col("na") * mid).alias("r1"),
        F.sum(F.col("n").cast("double") ** 3 - F.col("n")).alias("tie"))
    return u_statistic(per)


def u_statistic(per: DataFrame) -> DataFrame:
    """H1 from (descriptor, n1, n2, r1, tie).  Counts become doubles before
    they are multiplied: products of counts overflow a long from 3e9 rows."""
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n = n1 + n2
    u1 = F.col("r1") - n1 * (n1 + 1) / 2.0
    mu = n1 * n2 / 2.0
    sigma = F.sqrt(n1 * n2 / 12.0 * ((n + 1) - F.col("tie") / (n * (n - 1))))
    u_big = F.greatest(u1, n1 * n2 - u1)
    return per.select("descriptor", F.col("n1").cast("long").alias("n1"), F.col("n2").cast("long").alias("n2"),
                      u1.alias("statistic"), ((u_big - mu - 0.5) / sigma).alias("z"))


def t_test(df: DataFrame, class_col: str, a: str, b: str, descriptors: list[str]) -> DataFrame:
    """H2: pooled-variance two-sample t; one grouped aggregate."""
    long = long_values(df, class_col, a, b, descriptors)
    g = long.groupBy("descriptor").agg(
        F.count_if("is_a").alias("n1"), F.count_if(~F.col("is_a")).alias("n2"),
        F.avg(F.when(F.col("is_a"), F.col("v"))).alias("m1"), F.avg(F.when(~F.col("is_a"), F.col("v"))).alias("m2"),
        F.var_samp(F.when(F.col("is_a"), F.col("v"))).alias("s1"), F.var_samp(F.when(~F.col("is_a"), F.col("v"))).alias("s2"))
    dof = F.col("n1") + F.col("n2") - 2
    sp2 = ((F.col("n1") - 1) * F.col("s1") + (F.col("n2") - 1) * F.col("s2")) / dof
    t = (F.col("m1") - F.col("m2")) / F.sqrt(sp2 * (1.0 / F.col("n1") + 1.0 / F.col("n2")))
    return g.select("descriptor", F.col("n1").cast("long").alias("n1"), F.col("n2").cast("long").alias("n2"),
                    t.alias("statistic"), dof.cast("double").alias("dof"))


def crosstab_long(df: DataFrame, row_col: str, col_col: str) -> DataFrame:
    """H3 (long form): every (row, col) cell, zeros kept.  The cell grid is
    the product of the two distinct-value lists, which the H5 guard bounds;
    it is generated with ``explode`` (no join)."""
    counts = df.groupBy(F.col(row_col).cast("string").alias("r"), F.col(col_col).cast("string").alias("c")).count()
    levels = counts.agg(F.array_sort(F.collect_set("r")).alias("rs"), F.array_sort(F.collect_set("c")).alias("cs"))
    grid = levels.select(F.explode("rs").alias("r"), "cs").select("r", F.explode("cs").alias("c"))
    return grid.join(counts, ["r", "c"], "left").select("r", "c", F.coalesce("count", F.lit(0)).alias("observed"))


def crosstab_wide(df: DataFrame, row_col: str, col_col: str) -> DataFrame:
    """H3: ``pd.crosstab`` shape, zeros filled."""
    return df.groupBy(row_col).pivot(col_col).count().na.fill(0)


def cardinality_guard(df: DataFrame, col: str, limit: int = MAX_CHI2_VALUES) -> bool:
    """H5: the chi-squared test only when the column has <= 20 distinct non-null values."""
    n = df.select(col).filter(F.col(col).isNotNull()).distinct().limit(limit + 1).count()
    return n <= limit


def chi_squared(df: DataFrame, row_col: str, col_col: str, descriptor: str | None = None) -> DataFrame:
    """H4: sum (O-E)^2/E over the full contingency table, Yates-corrected
    when dof == 1."""
    for col in (row_col, col_col):
        if not cardinality_guard(df, col):
            raise ValueError(f"chi-squared test: {col!r} has more than {MAX_CHI2_VALUES} values")
    cells = crosstab_long(df.filter(F.col(row_col).isNotNull() & F.col(col_col).isNotNull()), row_col, col_col)
    return chi_squared_cells(cells, descriptor or col_col)


def chi_squared_cells(cells: DataFrame, descriptor: str) -> DataFrame:
    """H4 from (r, c, observed), the full table."""
    rt = cells.groupBy("r").agg(F.sum("observed").alias("rt"))
    ct = cells.groupBy("c").agg(F.sum("observed").alias("ct"))
    tot = cells.agg(F.sum("observed").alias("n"), F.count_distinct("r").alias("nr"), F.count_distinct("c").alias("nc"))
    e = cells.join(rt, "r").join(ct, "c").join(bounded_broadcast(tot, 1), how="inner")
    dof = (F.col("nr") - 1) * (F.col("nc") - 1)
    exp = F.col("rt").cast("double") * F.col("ct") / F.col("n")
    dev = F.abs(F.col("observed") - exp)
    dev = F.when(dof == 1, F.greatest(dev - 0.5, F.lit(0.0))).otherwise(dev)
    return e.groupBy(F.lit(descriptor).alias("descriptor")).agg(
        F.sum(dev * dev / exp).alias("statistic"), F.first(dof).cast("double").alias("dof"))


@F.pandas_udf(DoubleType())
def _p_normal(z: pd.Series) -> pd.Series:
    return z.map(lambda v: min(1.0, 2.0 * dist.normal_sf(v)) if v == v else float("nan"))


@F.pandas_udf(DoubleType())
def _p_t(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([dist.t_sf_two_sided(abs(a), b) for a, b in zip(t, dof)])


@F.pandas_udf(DoubleType())
def _p_chi2(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([dist.chi2_sf(a, b) for a, b in zip(x, dof)])


def with_p_value(res: DataFrame, test: str) -> DataFrame:
    """H6: p-value + decision column on a one-row-per-test table."""
    if test == "mannwhitney":
        p = _p_normal(F.col("z"))
    elif test == "ttest":
        p = _p_t(F.col("statistic"), F.col("dof"))
    else:
        p = _p_chi2(F.col("statistic"), F.col("dof"))
    return res.withColumn("p", p).withColumn("alpha", F.lit(ALPHA)).withColumn(
        "interpretation", F.when(F.col("p") > ALPHA, F.lit(SAME)).otherwise(F.lit(DIFFERENT)))


def battery(df: DataFrame, class_col: str, a: str, b: str, descriptors: list[str], chi2_col: str) -> DataFrame:
    """H7: Mann-Whitney and t-test per descriptor plus one chi-squared test,
    stacked with a ``test`` column."""
    mw = mann_whitney(df, class_col, a, b, descriptors).select(
        "descriptor", F.lit("Mann-Whitney U").alias("test"), "statistic")
    tt = t_test(df, class_col, a, b, descriptors).select("descriptor", F.lit("t-test").alias("test"), "statistic")
    two = df.filter(F.col(class_col).isin(a, b))
    ch = chi_squared(two, class_col, chi2_col).select("descriptor", F.lit("chi-squared").alias("test"), "statistic")
    return mw.unionByName(tt).unionByName(ch)


def decision(p_col: str = "p"):
    return F.when(F.col(p_col) > ALPHA, F.lit(SAME)).otherwise(F.lit(DIFFERENT))

