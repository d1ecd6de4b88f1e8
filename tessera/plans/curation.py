"""Curation and label queries (P1-P27, S9-S15) over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import hash_key
from tessera.functions.scalar import safe_float
from tessera.operators import curate as C
from tessera.plans import register
from tessera.sources.tables import LINEITEM_KEY_SQL, ROW_INDEX, lineitem_rows, table


def _li_missing(spark, sf_dir):
    """lineitem with missing values made from zeros (TESTDATA has none)."""
    li = lineitem_rows(spark, sf_dir)
    return li.withColumn("l_discount", F.nullif(F.col("l_discount"), F.lit(0.0))).withColumn(
        "l_tax", F.nullif(F.col("l_tax"), F.lit(0.0)))


LI_MISSING_SQL = f"""li AS (SELECT *, {LINEITEM_KEY_SQL} AS rid FROM (
    SELECT * REPLACE (nullif(l_discount, 0.0) AS l_discount, nullif(l_tax, 0.0) AS l_tax) FROM lineitem))"""


@register("p1_p3_drop_missing_key_and_target", f"""
WITH {LI_MISSING_SQL}
SELECT l_returnflag, count(*) AS n_rows, round(sum(l_discount), 6) AS sum_target
FROM li WHERE l_partkey IS NOT NULL AND l_discount IS NOT NULL AND NOT isnan(l_discount)
GROUP BY l_returnflag""")
def p1_p3(spark, sf_dir):
    df = C.drop_missing_key(_li_missing(spark, sf_dir), "l_partkey")
    df = C.drop_missing_target(df, "l_discount")
    return df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_rows"),
                                          F.round(F.sum("l_discount"), 6).alias("sum_target"))


@register("p2_key_rename", """
SELECT l_partkey AS canonical_smiles, count(*) AS n_rows FROM lineitem GROUP BY l_partkey""")
def p2(spark, sf_dir):
    df = C.rename_key(table(spark, sf_dir, "lineitem"), C.resolve_key(["l_partkey"], ["l_partkey"]))
    return df.groupBy("canonical_smiles").agg(F.count(F.lit(1)).alias("n_rows"))


@register("p4_required_non_null", f"""
WITH {LI_MISSING_SQL}
SELECT l_returnflag, l_linestatus, count(*) AS n_rows, round(sum(l_discount * l_tax), 6) AS s
FROM li WHERE l_discount IS NOT NULL AND NOT isnan(l_discount) AND l_tax IS NOT NULL AND NOT isnan(l_tax)
GROUP BY ALL""")
def p4(spark, sf_dir):
    df = C.require_non_null(_li_missing(spark, sf_dir), ["l_discount", "l_tax"])
    return df.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum(F.col("l_discount") * F.col("l_tax")), 6).alias("s"))


@register("p5_row_filters", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority IN ('1-URGENT')""")
def p5(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return C.row_filters(o, {"o_orderstatus": ["F", "O"], "o_orderpriority": "1-URGENT"})


@register("p6_selective_projection", """
SELECT o_orderkey AS __row_index, o_custkey AS canonical_smiles, o_totalprice, o_orderstatus FROM orders""")
def p6(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn(ROW_INDEX, F.col("o_orderkey"))
    o = C.rename_key(o, "o_custkey")
    return C.select_columns(o, "canonical_smiles", properties=["o_totalprice", "missing_col"], label="o_orderstatus")


CLASS_SQL = ("CASE WHEN o_totalprice <= 50000.0 THEN 'active' WHEN o_totalprice > 150000.0 THEN 'inactive' "
             "ELSE 'intermediate' END")


@register("p8_class_bucket", f"""
SELECT {CLASS_SQL} AS class, count(*) AS n_rows, round(avg(o_totalprice), 6) AS mean_value
FROM orders WHERE o_totalprice IS NOT NULL AND NOT isnan(o_totalprice) GROUP BY 1""")
def p8(spark, sf_dir):
    o = C.label_classes(table(spark, sf_dir, "orders"), "o_totalprice", 50000.0, 150000.0)
    return o.groupBy("class").agg(F.count(F.lit(1)).alias("n_rows"),
                                  F.round(F.avg("o_totalprice"), 6).alias("mean_value"))


PIC50_SQL = ("CASE WHEN o_totalprice = 0 THEN 'inf'::DOUBLE WHEN o_totalprice < 0 THEN 'nan'::DOUBLE "
             "ELSE -log10(least(o_totalprice, 1e8) * 1e-9) END")


@register("p9_cap_neg_log10", f"""
SELECT o_orderstatus, round(avg({PIC50_SQL}), 6) AS mean_p, round(min({PIC50_SQL}), 6) AS min_p,
       round(max({PIC50_SQL}), 6) AS max_p
FROM orders GROUP BY o_orderstatus""")
def p9(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("p", C.neg_log10_nano(F.col("o_totalprice")))
    return o.groupBy("o_orderstatus").agg(F.round(F.avg("p"), 6).alias("mean_p"),
                                          F.round(F.min("p"), 6).alias("min_p"),
                                          F.round(F.max("p"), 6).alias("max_p"))


@register("p10_two_class_subset", f"""
SELECT {CLASS_SQL} AS class, count(*) AS n_rows, round(avg({PIC50_SQL}), 6) AS mean_p
FROM orders WHERE {CLASS_SQL} <> 'intermediate' AND isfinite({PIC50_SQL}) GROUP BY 1""")
def p10(spark, sf_dir):
    o = C.label_classes(table(spark, sf_dir, "orders"), "o_totalprice", 50000.0, 150000.0)
    o = o.withColumn("pIC50", C.neg_log10_nano(F.col("o_totalprice")))
    o = C.two_class_subset(o)
    return o.groupBy("class").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("pIC50"), 6).alias("mean_p"))


@register("p11_binary_label_normalisation", """
SELECT CASE WHEN lower(trim(l_returnflag)) = 'a' THEN 1 WHEN lower(trim(l_returnflag)) = 'r' THEN 0 END AS label,
       count(*) AS n_rows
FROM lineitem WHERE lower(trim(l_returnflag)) IN ('a', 'r') GROUP BY 1""")
def p11(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    out = C.normalize_binary_labels(li, "l_returnflag", "label", positive=["A"], negative=["R"], drop_unmapped=True)
    return out.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"))


@register("p11_binary_label_numeric_path", """
SELECT doc_id, CAST(quality AS INTEGER) AS label FROM labels WHERE quality IN (0, 1)""")
def p11b(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    return C.normalize_binary_labels(lab, "quality", "label", positive=["good"], negative=["bad"]).select(
        "doc_id", "label")


@register("p12_strict_binary_labels", """
SELECT CAST(toxic AS INTEGER) AS toxic, count(*) AS n_rows FROM labels GROUP BY 1""")
def p12(spark, sf_dir):
    out = C.strict_binary(table(spark, sf_dir, "labels"), "toxic")
    return out.groupBy("toxic").agg(F.count(F.lit(1)).alias("n_rows"))


@register("p13_p14_exclude_columns", """
SELECT p_partkey, p_brand, p_size, p_retailprice FROM part""")
def p13(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumnRenamed("p_name", "SMILES")
    p = C.exclude_columns(p, ["p_type", "p_type", "not_there"])
    return C.drop_key_columns(p)


@register("p15_numeric_coercion", """
SELECT count(p_size_num) AS n_size, CAST(sum(p_size_num) AS DOUBLE) AS sum_size,
       count(p_retail_num) AS n_price, round(sum(p_retail_num), 6) AS sum_price
FROM (SELECT TRY_CAST(CAST(p_size AS VARCHAR) AS DOUBLE) AS p_size_num,
             TRY_CAST(CAST(p_retailprice AS VARCHAR) AS DOUBLE) AS p_retail_num FROM part)""")
def p15(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_brand", "p_size", "p_retailprice")
    coerced = C.numeric_coerce(p, ["p_brand", "p_size", "p_retailprice"])  # p_brand becomes all-missing
    assert "p_brand" not in coerced.columns
    return coerced.agg(F.count("p_size").alias("n_size"), F.sum("p_size").alias("sum_size"),
                       F.count("p_retailprice").alias("n_price"),
                       F.round(F.sum("p_retailprice"), 6).alias("sum_price"))


@register("p17_complete_cases", f"""
WITH {LI_MISSING_SQL}
SELECT l_returnflag, count(*) AS n_rows, round(sum(l_quantity * l_discount * l_tax), 6) AS s
FROM li WHERE isfinite(l_quantity) AND isfinite(l_discount) AND isfinite(l_tax) GROUP BY 1""")
def p17(spark, sf_dir):
    df = C.complete_cases(_li_missing(spark, sf_dir), ["l_quantity", "l_discount", "l_tax"])
    return df.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.sum(F.col("l_quantity") * F.col("l_discount") * F.col("l_tax")), 6).alias("s"))


@register("p18_one_hot", """
SELECT CAST(sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS l_returnflag_A,
       CAST(sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS l_returnflag_N,
       CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS l_returnflag_R,
       CAST(sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS l_linestatus_F,
       CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS l_linestatus_O
FROM lineitem""")
def p18(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus")
    oh = C.one_hot(li, ["l_returnflag", "l_linestatus"])
    return oh.agg(*[F.sum(c).cast("long").alias(c) for c in oh.columns])


@register("p19_clip", """
SELECT l_returnflag, round(sum(least(greatest(l_extendedprice, 1000.0), 50000.0)), 6) AS clipped_sum,
       round(max(least(greatest(l_extendedprice, 1000.0), 50000.0)), 6) AS clipped_max
FROM lineitem GROUP BY 1""")
def p19(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("c", C.clip("l_extendedprice", 1000.0, 50000.0))
    return li.groupBy("l_returnflag").agg(F.round(F.sum("c"), 6).alias("clipped_sum"),
                                          F.round(F.max("c"), 6).alias("clipped_max"))


@register("p20_p21_row_index_validation", """
WITH ids AS (SELECT l_orderkey * 10 + l_linenumber AS rid FROM lineitem),
per AS (SELECT rid, count(*) AS n FROM ids GROUP BY rid)
SELECT (SELECT count(*) FROM ids) AS n_rows,
       (SELECT count(*) FILTER (WHERE rid IS NULL) FROM ids) AS null_ids,
       CAST(0 AS BIGINT) AS non_integer_ids,
       (SELECT CAST(coalesce(sum(n) FILTER (WHERE n > 1 AND rid IS NOT NULL), 0) AS BIGINT) FROM per) AS duplicate_rows,
       (SELECT count(*) FILTER (WHERE n > 1 AND rid IS NOT NULL) FROM per) AS duplicate_ids""")
def p20_p21(spark, sf_dir):
    """The short key (orderkey, linenumber) is NOT unique in the test data;
    the validator reports it (why lineitem uses the 4-column key)."""
    li = C.assign_row_index(table(spark, sf_dir, "lineitem"), F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return C.row_index_report(li)


@register("p20_dense_row_index", """
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS first_id, count(*) - 1 AS last_id, count(*) AS n_ids FROM lineitem""")
def p20_dense(spark, sf_dir):
    """Row ids of a table without a key of its own: dense positions."""
    li = C.assign_row_index(table(spark, sf_dir, "lineitem"), stored=True)
    return li.agg(F.count(F.lit(1)).alias("n_rows"), F.min(C.ROW_INDEX).alias("first_id"), F.max(C.ROW_INDEX).alias("last_id"),
                  F.count_distinct(C.ROW_INDEX).alias("n_ids"))


@register("p18_one_hot_sparse", """
WITH d AS (SELECT l_partkey, row_number() OVER (ORDER BY CAST(l_partkey AS VARCHAR)) - 1 AS position FROM (SELECT DISTINCT l_partkey FROM lineitem))
SELECT position, (SELECT count(*) FROM d) AS size, count(*) AS n FROM lineitem JOIN d USING (l_partkey) GROUP BY 1""")
def p18_sparse(spark, sf_dir):
    """One-hot of a column with many values: sparse vectors, summed up."""
    rows, _ = C.one_hot_sparse(table(spark, sf_dir, "lineitem").select("l_partkey"), "l_partkey")
    v = F.col("l_partkey")
    return rows.groupBy(v["indices"][0].alias("position"), v["size"].alias("size")).agg(F.sum(v["values"][0]).cast("long").alias("n"))


@register("p22_rule_flags", """
WITH f AS (SELECT coalesce(o_totalprice <= 300000.0, false) AS r_price,
                  coalesce(o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM'), false) AS r_priority,
                  coalesce(o_orderstatus <> 'P', false) AS r_status,
                  coalesce(o_custkey % 2 = 0, false) AS r_even FROM orders)
SELECT n_pass, passes, count(*) AS n_rows FROM (
  SELECT CAST(r_price AS INTEGER) + CAST(r_priority AS INTEGER) + CAST(r_status AS INTEGER)
         + CAST(r_even AS INTEGER) AS n_pass,
         (CAST(r_price AS INTEGER) + CAST(r_priority AS INTEGER) + CAST(r_status AS INTEGER)
         + CAST(r_even AS INTEGER)) >= 3 AS passes FROM f) GROUP BY ALL""")
def p22(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    rules = {
        "r_price": F.col("o_totalprice") <= 300000.0,
        "r_priority": F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"),
        "r_status": F.col("o_orderstatus") != "P",
        "r_even": F.pmod(F.col("o_custkey"), F.lit(2)) == 0,
    }
    flagged = C.rule_flags(o, rules, min_pass=3)
    return flagged.groupBy("n_pass", "passes").agg(F.count(F.lit(1)).alias("n_rows"))


BANDS = [0.0, 100000.0, 200000.0, 300000.0, 400000.0, 500000.0]
BAND_LABELS = ["very_low", "low", "mid", "high", "very_high"]


@register("p23_band_binning", """
SELECT CASE WHEN o_totalprice > 0 AND o_totalprice <= 100000 THEN 'very_low'
            WHEN o_totalprice > 100000 AND o_totalprice <= 200000 THEN 'low'
            WHEN o_totalprice > 200000 AND o_totalprice <= 300000 THEN 'mid'
            WHEN o_totalprice > 300000 AND o_totalprice <= 400000 THEN 'high'
            WHEN o_totalprice > 400000 AND o_totalprice <= 500000 THEN 'very_high' END AS band,
       count(*) AS n_rows
FROM orders GROUP BY 1""")
def p23(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("band", C.band(F.col("o_totalprice"), BANDS, BAND_LABELS))
    return o.groupBy("band").agg(F.count(F.lit(1)).alias("n_rows"))


@register("p24_fixed_seed_sample", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 240""")
def p24(spark, sf_dir):
    """Sampling operator: the limit is the feature (top-n of a hash order,
    a TakeOrderedAndProject, no full sort)."""
    o = table(spark, sf_dir, "orders")
    return o.orderBy(hash_key(42, "o_orderkey"), "o_orderkey").limit(240).select("o_orderkey", "o_totalprice")


@register("p25_feature_name_sanitising", r"""
WITH raw AS (SELECT DISTINCT '[' || l_returnflag || '<' || l_linestatus || '>]' AS original FROM lineitem
             UNION SELECT DISTINCT '[' || l_returnflag || '>' || l_linestatus || '<]' FROM lineitem),
b AS (SELECT original, regexp_replace(original, '[\[\]<>]', '_', 'g') AS base FROM raw)
SELECT original, base || CASE WHEN rn > 1 THEN '__' || CAST(rn AS VARCHAR) ELSE '' END AS sanitized
FROM (SELECT *, row_number() OVER (PARTITION BY base ORDER BY original) AS rn FROM b)""")
def p25(spark, sf_dir):
    """Feature names derived from data (one per flag/status pair), then
    sanitised with collision suffixes; the rename map is a DataFrame."""
    li = table(spark, sf_dir, "lineitem")
    raw = li.select(F.concat(F.lit("["), "l_returnflag", F.lit("<"), "l_linestatus", F.lit(">]")).alias("original")) \
        .union(li.select(F.concat(F.lit("["), "l_returnflag", F.lit(">"), "l_linestatus", F.lit("<]")).alias("original"))) \
        .distinct()
    from pyspark.sql import Window as W
    base = F.regexp_replace("original", r"[\[\]<>]", "_")
    rn = F.row_number().over(W.partitionBy(base).orderBy("original"))
    return raw.withColumn("rn", rn).select(
        "original", F.concat(base, F.when(F.col("rn") > 1, F.concat(F.lit("__"), F.col("rn").cast("string")))
                             .otherwise(F.lit(""))).alias("sanitized"))


@register("p26_numeric_feature_guard", """
SELECT count(*) FILTER (WHERE p_brand IS NOT NULL AND TRY_CAST(p_brand AS DOUBLE) IS NULL) AS bad_p_brand,
       count(*) FILTER (WHERE p_size IS NOT NULL AND TRY_CAST(CAST(p_size AS VARCHAR) AS DOUBLE) IS NULL) AS bad_p_size,
       count(*) FILTER (WHERE p_retailprice IS NOT NULL
                        AND TRY_CAST(CAST(p_retailprice AS VARCHAR) AS DOUBLE) IS NULL) AS bad_p_retailprice
FROM part""")
def p26(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    cols = ["p_brand", "p_size", "p_retailprice"]
    return p.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).cast("string").try_cast("double").isNull())
                   .cast("long").alias(f"bad_{c}") for c in cols])


@register("p27_invalid_key_mask", r"""
WITH c AS (SELECT doc_id, nullif(regexp_replace(lower(trim(text)), '\s+', ' ', 'g'), '') AS canon FROM documents)
SELECT count(*) AS n_valid, count(DISTINCT canon) AS n_distinct_keys FROM c WHERE canon IS NOT NULL""")
def p27(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    canon = F.nullif(F.regexp_replace(F.lower(F.trim("text")), r"\s+", " "), F.lit(""))
    kept = C.invalid_key_mask(d.select("doc_id", "text"), "text", canon, drop_invalid=True)
    return kept.agg(F.count(F.lit(1)).alias("n_valid"), F.count_distinct("text").alias("n_distinct_keys"))


@register("s9_head_sample", f"""
SELECT {LINEITEM_KEY_SQL} AS __row_index, l_extendedprice FROM lineitem ORDER BY 1 LIMIT 100""")
def s9(spark, sf_dir):
    """Head sample in row order; limit is the feature."""
    return lineitem_rows(spark, sf_dir).orderBy(ROW_INDEX).limit(100).select(ROW_INDEX, "l_extendedprice")


@register("s10_in_filter", """
SELECT user_id, count(*) AS n_events, round(sum(value), 6) AS total_value
FROM events WHERE event_type IN ('click', 'view') GROUP BY user_id""")
def s10(spark, sf_dir):
    e = table(spark, sf_dir, "events").filter(F.col("event_type").isin("click", "view"))
    return e.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"), F.round(F.sum("value"), 6).alias("total_value"))


@register("s11_flatten_nested", """
SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k, count(*) AS n_rows
FROM events GROUP BY event_type""")
def s11(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("props", F.from_json("props", "k long"))
    flat = C.flatten(e.select("event_type", "props"))
    return flat.groupBy("event_type").agg(F.sum(F.col("`props.k`")).cast("long").alias("sum_k"),
                                          F.count(F.lit(1)).alias("n_rows"))


@register("s12_drop_nested_columns", "SELECT vec_id, label FROM embeddings")
def s12(spark, sf_dir):
    return C.drop_nested_columns(table(spark, sf_dir, "embeddings"))


@register("r11_safe_float", """
SELECT event_type, count(v) AS n_parsed, round(sum(v), 6) AS total
FROM (SELECT event_type, TRY_CAST(nullif(trim(json_extract_string(props, '$.k')), '') AS DOUBLE) AS v FROM events)
GROUP BY event_type""")
def r11(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("v", safe_float(F.get_json_object("props", "$.k")))
    return e.groupBy("event_type").agg(F.count("v").alias("n_parsed"), F.round(F.sum("v"), 6).alias("total"))


@register("p7_labelled_projection", f"""
SELECT {LINEITEM_KEY_SQL} AS __row_index, l_partkey AS canonical_smiles, l_extendedprice AS standard_value,
       CASE WHEN l_extendedprice <= 20000.0 THEN 'active' WHEN l_extendedprice > 60000.0 THEN 'inactive'
            ELSE 'intermediate' END AS class
FROM lineitem""")
def p7(spark, sf_dir):
    li = lineitem_rows(spark, sf_dir)
    li = li.withColumnRenamed("l_partkey", "canonical_smiles").withColumnRenamed("l_extendedprice", "standard_value")
    return C.labelled_projection(C.label_classes(li, "standard_value", 20000.0, 60000.0))


@register("p16_target_numeric_coercion", """
SELECT 'numeric' AS target_kind, CAST(sum(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS DOUBLE) AS total
FROM events
UNION ALL SELECT 'text', CAST(count(*) AS DOUBLE) FROM events""")
def p16(spark, sf_dir):
    """A target whose cells all parse is converted; ``event_type`` (0 %
    numeric) is left as text."""
    e = table(spark, sf_dir, "events").select(F.get_json_object("props", "$.k").alias("k"), "event_type")
    a = C.coerce_target(e, "k")
    b = C.coerce_target(e, "event_type")
    assert dict(a.dtypes)["k"] == "double" and dict(b.dtypes)["event_type"] == "string"
    return a.agg(F.sum("k").alias("total")).select(F.lit("numeric").alias("target_kind"), "total").unionByName(
        b.agg(F.count("event_type").cast("double").alias("total")).select(F.lit("text").alias("target_kind"), "total"))


@register("s13_source_column_rename", """
SELECT p_name AS smiles, p_size AS label, p_brand FROM part""")
def s13(spark, sf_dir):
    """``Drug`` and ``Y`` get their standard names."""
    p = table(spark, sf_dir, "part").select(F.col("p_name").alias("Drug"), F.col("p_size").alias("Y"), "p_brand")
    return C.rename_source_columns(p)


@register("s14_column_resolution", """
SELECT c_name AS "key", c_acctbal AS target FROM customer""")
def s14(spark, sf_dir):
    """The key is the first known alias present, the target any case of its name."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("Smiles"), F.col("c_acctbal").alias("PIC50"))
    key, target = C.resolve_key(c.columns), C.resolve_target(c.columns, "pic50")
    return c.select(F.col(key).alias("key"), F.col(target).alias("target"))


@register("s15_header_cleaning", """
SELECT n_nationkey, n_name AS name, n_regionkey AS region FROM nation""")
def s15(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("\ufeffn_nationkey"), F.col("n_name").alias(" name "),
                                              F.col("n_regionkey").alias("region\t"))
    return C.clean_header(n)
