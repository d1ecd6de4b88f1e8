"""EDA queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import hash_key
from tessera.operators import curate as C
from tessera.operators import eda as E
from tessera.operators.radix_select import exact_quantiles
from tessera.plans import register
from tessera.sources.tables import table

LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
           "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _li_missing(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.withColumn("l_discount", F.nullif("l_discount", F.lit(0.0))).withColumn(
        "l_tax", F.nullif("l_tax", F.lit(0.0)))


LI_MISSING = ("(SELECT * REPLACE (nullif(l_discount, 0.0) AS l_discount, nullif(l_tax, 0.0) AS l_tax) FROM lineitem)")


@register("h8_overview", f"""
SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns, CAST(8 AS BIGINT) AS n_numeric_columns,
       count(*) FILTER (WHERE l_discount IS NULL) + count(*) FILTER (WHERE l_tax IS NULL) AS missing_cells
FROM {LI_MISSING}""")
def h8(spark, sf_dir):
    df = _li_missing(spark, sf_dir)
    num = E.numeric_columns(df)
    return E.overview(df, num)


@register("h9_missingness_top20", f"""
SELECT "column", n_missing FROM (
  SELECT 'l_discount' AS "column", count(*) FILTER (WHERE l_discount IS NULL) AS n_missing FROM {LI_MISSING}
  UNION ALL SELECT 'l_tax', count(*) FILTER (WHERE l_tax IS NULL) FROM {LI_MISSING})
WHERE n_missing > 0 ORDER BY n_missing DESC, "column" LIMIT 20""")
def h9(spark, sf_dir):
    return E.missingness_top(_li_missing(spark, sf_dir), 20)


@register("h10_numeric_column_detection", """
SELECT "column", n_numeric, round(n_numeric / n, 6) AS numeric_fraction, n_numeric > 0 AND n_numeric / n >= 0.5 AS is_numeric
FROM (SELECT count(*) AS n,
        count(TRY_CAST(CAST(p_partkey AS VARCHAR) AS DOUBLE)) AS p_partkey,
        count(TRY_CAST(p_name AS DOUBLE)) AS p_name, count(TRY_CAST(p_brand AS DOUBLE)) AS p_brand,
        count(TRY_CAST(p_type AS DOUBLE)) AS p_type, count(TRY_CAST(CAST(p_size AS VARCHAR) AS DOUBLE)) AS p_size
      FROM part)
UNPIVOT (n_numeric FOR "column" IN (p_partkey, p_name, p_brand, p_type, p_size))""")
def h10(spark, sf_dir):
    return E.numeric_fraction(table(spark, sf_dir, "part"), target="p_retailprice")


def _hist_sql(src: str, cols: list[str]) -> str:
    longs = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS v FROM {src}" for c in cols)
    return f"""
long AS (SELECT * FROM ({longs}) WHERE v IS NOT NULL AND NOT isnan(v)),
rng AS (SELECT "column", min(v) AS lo, max(v) AS hi FROM long GROUP BY 1),
cnt AS (SELECT l."column", CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((v - lo) / ((hi - lo) / 30)), 29) END AS INTEGER)
          AS bin, count(*) AS n FROM long l JOIN rng USING ("column") GROUP BY 1, 2),
grid AS (SELECT "column", lo, hi, CAST(unnest(range(0, 30)) AS INTEGER) AS bin FROM rng)
SELECT g."column", g.bin, round(lo + g.bin * ((hi - lo) / 30), 6) AS bin_start,
       round(lo + (g.bin + 1) * ((hi - lo) / 30), 6) AS bin_end, coalesce(n, 0) AS count
FROM grid g LEFT JOIN cnt c ON g."column" = c."column" AND g.bin = c.bin"""


def _hist_spark(df, cols):
    h = E.histograms(df, cols)
    return h.select("column", "bin", F.round("bin_start", 6).alias("bin_start"), F.round("bin_end", 6).alias("bin_end"),
                    "count")


@register("h11_histograms", "WITH " + _hist_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount"]))
def h11(spark, sf_dir):
    return _hist_spark(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


@register("h12_correlation_matrix", """
SELECT col_a, col_b, round(r, 6) AS r FROM (
  SELECT 'l_quantity' AS col_a, 'l_extendedprice' AS col_b, corr(l_quantity, l_extendedprice) AS r FROM lineitem
  UNION ALL SELECT 'l_quantity', 'l_discount', corr(l_quantity, l_discount) FROM lineitem
  UNION ALL SELECT 'l_extendedprice', 'l_discount', corr(l_extendedprice, l_discount) FROM lineitem
  UNION ALL SELECT 'l_quantity', 'l_tax', corr(l_quantity, l_tax) FROM lineitem
  UNION ALL SELECT 'l_extendedprice', 'l_tax', corr(l_extendedprice, l_tax) FROM lineitem
  UNION ALL SELECT 'l_discount', 'l_tax', corr(l_discount, l_tax) FROM lineitem)""")
def h12(spark, sf_dir):
    c = E.correlation_long(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return c.select("col_a", "col_b", F.round("r", 6).alias("r"))


@register("h13_target_distribution_classification", """
SELECT coalesce(CAST(l.quality AS VARCHAR), 'nan') AS value, count(*) AS count
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""")
def h13(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return E.value_counts(d, "quality")


@register("h13_target_distribution_regression", "WITH " + _hist_sql("orders", ["o_totalprice"]))
def h13r(spark, sf_dir):
    return _hist_spark(table(spark, sf_dir, "orders"), ["o_totalprice"])


@register("h14_class_balance", """
SELECT coalesce(CAST(l_returnflag AS VARCHAR), 'nan') AS value, count(*) AS count FROM lineitem GROUP BY 1""")
def h14(spark, sf_dir):
    return E.value_counts(table(spark, sf_dir, "lineitem"), "l_returnflag")


@register("h15_box_statistics", """
WITH long AS (SELECT l_returnflag AS class, "column", v FROM (
    UNPIVOT (SELECT l_returnflag, l_quantity, l_discount FROM lineitem) ON l_quantity, l_discount
    INTO NAME "column" VALUE v) WHERE v IS NOT NULL AND NOT isnan(v)),
q AS (SELECT class, "column", quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3 FROM long GROUP BY 1, 2),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q)
SELECT class, "column", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(min(v) FILTER (WHERE v >= lo_f AND v <= hi_f), 6) AS whisker_low,
       round(max(v) FILTER (WHERE v >= lo_f AND v <= hi_f), 6) AS whisker_high,
       count(*) FILTER (WHERE NOT (v >= lo_f AND v <= hi_f)) AS n_outliers, count(*) AS n
FROM long JOIN f USING (class, "column") GROUP BY class, "column", q1, median, q3""")
def h15(spark, sf_dir):
    b = E.box_stats(table(spark, sf_dir, "lineitem"), "l_returnflag", ["l_quantity", "l_discount"])
    return b.select("class", "column", *[F.round(c, 6).alias(c) for c in
                                         ["q1", "median", "q3", "whisker_low", "whisker_high"]], "n_outliers", "n")


@register("h16_scatter_table", """
SELECT l_quantity AS x, l_extendedprice AS y, l_returnflag AS colour FROM lineitem
WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL""")
def h16(spark, sf_dir):
    """The points of a scatter plot: every row with both coordinates."""
    li = table(spark, sf_dir, "lineitem").where("l_quantity is not null and l_extendedprice is not null")
    return li.select(F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"), F.col("l_returnflag").alias("colour"))


@register("h17_class_density", """
WITH base AS (SELECT o_orderstatus AS class, o_totalprice AS v FROM orders WHERE o_totalprice IS NOT NULL),
st AS (SELECT class, count(*) AS n, stddev_samp(v) AS sd, min(v) AS lo, max(v) AS hi FROM base GROUP BY 1),
st2 AS (SELECT *, sd * pow(n::DOUBLE, -0.2) AS h, (hi - lo) / 256 AS w FROM st),
binned AS (SELECT b.class, CAST(CASE WHEN w = 0 THEN 0 ELSE least(floor((v - lo) / w), 255) END AS INTEGER) AS bb,
                  count(*) AS nb FROM base b JOIN st2 USING (class) GROUP BY 1, 2),
pts AS (SELECT bn.class, nb, st2.*, lo + (bb + 0.5) * w AS c, unnest(range(0, 100)) AS k FROM binned bn JOIN st2 USING (class))
SELECT class, CAST(k AS INTEGER) AS k, round(first(lo + k * (hi - lo) / 99), 6) AS x,
       round(sum(nb * exp(-0.5 * ((lo + k * (hi - lo) / 99 - c) / h) * ((lo + k * (hi - lo) / 99 - c) / h))
             / (n * h * sqrt(2 * pi()))) * 1e6, 6) AS density_e6
FROM pts GROUP BY class, k""")
def h17(spark, sf_dir):
    d = E.class_density(table(spark, sf_dir, "orders"), "o_orderstatus", "o_totalprice")
    return d.select("class", F.col("k").cast("int").alias("k"), F.round("x", 6).alias("x"),
                    F.round(F.col("density") * 1e6, 6).alias("density_e6"))


RULES_SQL = """f AS (SELECT coalesce(o_totalprice <= 300000.0, false) AS r_price,
                  coalesce(o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM'), false) AS r_priority,
                  coalesce(o_orderstatus <> 'P', false) AS r_status,
                  coalesce(o_custkey % 2 = 0, false) AS r_even FROM orders),
g AS (SELECT *, r_price::INT + r_priority::INT + r_status::INT + r_even::INT AS np FROM f)"""


@register("h18_rule_compliance_counts", f"""
WITH {RULES_SQL}
SELECT 'compliance' AS metric, 'pass_all' AS key, count(*) FILTER (WHERE np = 4) AS count FROM g
UNION ALL SELECT 'compliance', 'fail_any', count(*) FILTER (WHERE np < 4) FROM g
UNION ALL SELECT 'rule_pass', 'r_price', count(*) FILTER (WHERE r_price) FROM g
UNION ALL SELECT 'rule_pass', 'r_priority', count(*) FILTER (WHERE r_priority) FROM g
UNION ALL SELECT 'rule_pass', 'r_status', count(*) FILTER (WHERE r_status) FROM g
UNION ALL SELECT 'rule_pass', 'r_even', count(*) FILTER (WHERE r_even) FROM g
UNION ALL SELECT 'rule_fail', 'r_price', count(*) FILTER (WHERE NOT r_price) FROM g
UNION ALL SELECT 'rule_fail', 'r_priority', count(*) FILTER (WHERE NOT r_priority) FROM g
UNION ALL SELECT 'rule_fail', 'r_status', count(*) FILTER (WHERE NOT r_status) FROM g
UNION ALL SELECT 'rule_fail', 'r_even', count(*) FILTER (WHERE NOT r_even) FROM g
UNION ALL SELECT 'pass_count', CAST(i AS VARCHAR), (SELECT count(*) FROM g WHERE np = i) FROM range(0, 5) t(i)""")
def h18(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    rules = {
        "r_price": F.col("o_totalprice") <= 300000.0,
        "r_priority": F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"),
        "r_status": F.col("o_orderstatus") != "P",
        "r_even": F.pmod(F.col("o_custkey"), F.lit(2)) == 0,
    }
    flagged = C.rule_flags(o, rules)
    return E.rule_compliance(flagged, list(rules))


BAND_EDGES = [float("-inf"), 0.30, 0.50, 0.67, 0.85, float("inf")]
BAND_NAMES = ["<0.30", "0.30-0.50", "0.50-0.67", "0.67-0.85", ">0.85"]


@register("h19_summary_numbers_and_bands", """
WITH s AS (SELECT o_totalprice / 500000.0 AS score FROM orders),
b AS (SELECT CASE WHEN score <= 0.30 THEN '<0.30' WHEN score <= 0.50 THEN '0.30-0.50' WHEN score <= 0.67 THEN '0.50-0.67'
                  WHEN score <= 0.85 THEN '0.67-0.85' ELSE '>0.85' END AS band FROM s),
labels AS (SELECT * FROM (VALUES (0, '<0.30'), (1, '0.30-0.50'), (2, '0.50-0.67'), (3, '0.67-0.85'), (4, '>0.85')) t(pos, band))
SELECT 'band' AS metric, labels.band AS key, CAST(count(b.band) AS DOUBLE) AS value
FROM labels LEFT JOIN b ON labels.band = b.band GROUP BY labels.band
UNION ALL SELECT 'mean', 'score', round(avg(score), 6) FROM s
UNION ALL SELECT 'median', 'score', round(median(score), 6) FROM s
UNION ALL SELECT 'count_ge', '0.67', CAST(count(*) FILTER (WHERE score >= 0.67) AS DOUBLE) FROM s
UNION ALL SELECT 'count_ge', '0.85', CAST(count(*) FILTER (WHERE score >= 0.85) AS DOUBLE) FROM s""")
def h19(spark, sf_dir):
    s = table(spark, sf_dir, "orders").select((F.col("o_totalprice") / 500000.0).alias("score"))
    banded = s.withColumn("band", C.band(F.col("score"), BAND_EDGES, BAND_NAMES))
    labels = spark.createDataFrame(list(enumerate(BAND_NAMES)), "pos int, band string")
    counts = labels.join(banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")), "band", "left").select(
        F.lit("band").alias("metric"), F.col("band").alias("key"), F.coalesce("n", F.lit(0)).cast("double").alias("value"))
    med = exact_quantiles(s, "score", [0.5], max_groups=1).select(F.round("q0", 6).alias("median"))
    nums = s.agg(F.round(F.avg("score"), 6).alias("mean"),
                 F.count_if(F.col("score") >= 0.67).cast("double").alias("ge67"),
                 F.count_if(F.col("score") >= 0.85).cast("double").alias("ge85")).join(med, how="inner")
    def kv(metric, key, col):
        return F.struct(F.lit(metric).alias("metric"), F.lit(key).alias("key"), F.col(col).cast("double").alias("value"))

    long = nums.select(F.explode(F.array(kv("mean", "score", "mean"), kv("median", "score", "median"),
                                         kv("count_ge", "0.67", "ge67"), kv("count_ge", "0.85", "ge85"))).alias("s")) \
        .select("s.*")
    return counts.unionByName(long)


@register("h20_h21_dataset_probe_task_inference", """
SELECT 'quality' AS target, count(*) AS n_rows, count(DISTINCT quality) AS n_distinct_target,
       bool_and(quality IN (0, 1)) AS binary_target,
       CASE WHEN bool_and(quality IN (0, 1)) THEN 'classification' ELSE 'regression' END AS task_type FROM labels
UNION ALL
SELECT 'o_totalprice', count(*), count(DISTINCT o_totalprice), bool_and(o_totalprice IN (0, 1)),
       CASE WHEN bool_and(o_totalprice IN (0, 1)) THEN 'classification' ELSE 'regression' END FROM orders
UNION ALL
SELECT 'l_linestatus', count(*), count(DISTINCT l_linestatus), false, 'regression' FROM lineitem""")
def h20(spark, sf_dir):
    a = E.probe(table(spark, sf_dir, "labels"), "quality").select(F.lit("quality").alias("target"), "*")
    b = E.probe(table(spark, sf_dir, "orders"), "o_totalprice").select(F.lit("o_totalprice").alias("target"), "*")
    c = E.probe(table(spark, sf_dir, "lineitem"), "l_linestatus").select(F.lit("l_linestatus").alias("target"), "*")
    return a.unionByName(b).unionByName(c)


@register("h21_task_modes", """
WITH p AS (SELECT 'quality' AS target, bool_and(quality IN (0, 1)) AS b FROM labels
           UNION ALL SELECT 'o_totalprice', bool_and(o_totalprice IN (0, 1)) FROM orders),
m(requested, confirmed) AS (VALUES ('Regression', false), (' classification ', false), ('auto', true), ('AUTO', false), ('ranking', true), (NULL, true))
SELECT target, coalesce(requested, '-') AS requested, confirmed,
       CASE WHEN lower(trim(requested)) IN ('regression', 'classification') THEN lower(trim(requested))
            WHEN lower(requested) = 'auto' AND confirmed THEN CASE WHEN b THEN 'classification' ELSE 'regression' END END AS task,
       CASE WHEN lower(requested) = 'auto' AND NOT confirmed THEN 'an automatic task must be confirmed'
            WHEN requested = 'ranking' OR requested IS NULL THEN 'the task must be classification, regression or auto' END AS problem
FROM p, m""")
def h21_modes(spark, sf_dir):
    modes = [("Regression", False), (" classification ", False), ("auto", True), ("AUTO", False), ("ranking", True), (None, True)]
    cells = [F.struct(F.lit(r).cast("string").alias("requested"), F.lit(c).alias("confirmed")) for r, c in modes]
    probes = [E.probe(table(spark, sf_dir, t), c).select(F.lit(c).alias("target"), "binary_target", F.inline(F.array(*cells)))
              for t, c in (("labels", "quality"), ("orders", "o_totalprice"))]
    found = probes[0].unionByName(probes[1]).withColumn("r", E.resolved_task(F.col("requested"), F.col("confirmed"), F.col("binary_target")))
    return found.select("target", F.coalesce("requested", F.lit("-")).alias("requested"), "confirmed", "r.task", "r.problem")


@register("h22_row_types", """
SELECT 'not_number' AS rule, 'o_orderpriority' AS detail, count(*) AS count FROM orders WHERE o_orderpriority IS NOT NULL
UNION ALL SELECT 'not_integer', 'o_totalprice', count(*) FROM orders WHERE o_totalprice % 1 <> 0
UNION ALL SELECT 'not_boolean', 'o_orderstatus', count(*) FROM orders WHERE o_orderstatus <> 'F'""")
def h22_row_types(spark, sf_dir):
    """Every cell of orders against declared types; F reads as a boolean."""
    return E.row_type_violations(table(spark, sf_dir, "orders"), {
        "o_orderkey": "integer", "o_totalprice": "integer", "o_orderpriority": "number", "o_orderstatus": "boolean",
        "o_orderdate": "timestamp", "o_custkey": "number", "absent": "number"})


@register("h22_contract_check", """
SELECT 'missing_required_column' AS rule, 'missing_col' AS detail, CAST(1 AS BIGINT) AS count
UNION ALL SELECT 'missing_any_of', 'smiles|SMILES', 1
UNION ALL SELECT 'too_few_columns', '10', 6
UNION ALL SELECT 'non_numeric_values', 'p_brand', count(*) FROM part WHERE TRY_CAST(p_brand AS DOUBLE) IS NULL""")
def h22(spark, sf_dir):
    return E.contract_violations(table(spark, sf_dir, "part"), required=["p_partkey", "missing_col"],
                                 any_of=[["smiles", "SMILES"], ["p_name", "name"]], min_columns=10,
                                 numeric=["p_size", "p_brand"])


@register("h23_groups_with_count_above_one", """
SELECT o_custkey, n, o_orderkey AS member FROM orders JOIN (
  SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1) USING (o_custkey)""")
def h23(spark, sf_dir):
    return E.shared_groups(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey")
