"""Scalar-function queries (F1-F17) and the UDF / hook surface."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import steps
from tessera.functions import scalar as FN
from tessera.operators import curate as C
from tessera.operators.split import split_summary
from tessera.plans import register
from tessera.plans.dedupe import KEYED_SQL, _keyed
from tessera.session import import_in_workers, written
from tessera.sources.tables import ROW_INDEX, events_rows, table

K_SQL = "CAST(json_extract(props, '$.k') AS BIGINT)"


@register("f1_f2_token_and_binary_parse", f"""
SELECT lower(trim(' ' || upper(event_type) || ' ')) AS token,
       CASE WHEN TRY_CAST(trim(CAST({K_SQL} % 3 AS VARCHAR) || '.0') AS DOUBLE) IN (0.0, 1.0)
            THEN CAST(TRY_CAST(trim(CAST({K_SQL} % 3 AS VARCHAR) || '.0') AS DOUBLE) AS INTEGER) END AS bin,
       count(*) AS n FROM events GROUP BY ALL""")
def f1_f2(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    tok = FN.token(F.concat(F.lit(" "), F.upper("event_type"), F.lit(" ")))
    b = FN.binary01(F.concat((k % 3).cast("string"), F.lit(".0")))
    return e.groupBy(tok.alias("token"), b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@register("f3_f4_comma_lists", f"""
SELECT event_type, CAST(sum(len(list_filter(list_transform(string_split(event_type || ', ,' || CAST(user_id AS VARCHAR),
       ','), lambda x: trim(x)), lambda x: x <> ''))) AS BIGINT) AS n_items,
       CAST(sum(list_sum(list_transform(list_filter(list_transform(string_split(CAST({K_SQL} AS VARCHAR) || ', ' ||
       CAST(user_id AS VARCHAR), ','), lambda x: trim(x)), lambda x: x <> ''), lambda x: CAST(x AS INTEGER)))) AS BIGINT)
       AS int_sum FROM events GROUP BY 1""")
def f3_f4(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    lst = FN.csv_list(F.concat_ws(", ,", "event_type", F.col("user_id").cast("string")))
    ints = FN.int_list(F.concat_ws(", ", F.get_json_object("props", "$.k"), F.col("user_id").cast("string")))
    return e.groupBy("event_type").agg(
        F.sum(F.size(lst)).cast("long").alias("n_items"),
        F.sum(F.aggregate(ints, F.lit(0).cast("long"), lambda a, x: a + x)).cast("long").alias("int_sum"))


BOOL_SRC = ("CASE event_type WHEN 'click' THEN ' Yes ' WHEN 'view' THEN 'on' WHEN 'purchase' THEN 'false' "
            "WHEN 'error' THEN '1' ELSE 'maybe' END")


@register("f5_boolean_parse", f"""
SELECT event_type, coalesce(lower(trim({BOOL_SRC})) IN ('1', 'true', 'yes', 'on'), false) AS flag, count(*) AS n
FROM events GROUP BY ALL""")
def f5(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    src = F.when(F.col("event_type") == "click", " Yes ").when(F.col("event_type") == "view", "on") \
        .when(F.col("event_type") == "purchase", "false").when(F.col("event_type") == "error", "1").otherwise("maybe")
    return e.groupBy("event_type", FN.as_bool(src).alias("flag")).agg(F.count(F.lit(1)).alias("n"))


@register("f6_f7_tokens_and_prefix", r"""
SELECT regexp_replace(p_type, '[^\p{L}\p{N}_-]', '_', 'g') AS type_token,
       replace(CAST(CAST(p_size AS DOUBLE) AS VARCHAR), '.', 'p') AS size_token,
       CASE WHEN starts_with(p_brand, 'Brand#') THEN substr(p_brand, 7) ELSE p_brand END AS brand_suffix,
       count(*) AS n FROM part GROUP BY ALL""")
def f6_f7(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.groupBy(FN.safe_token("p_type").alias("type_token"), FN.float_token("p_size").alias("size_token"),
                     FN.strip_prefix("p_brand", "Brand#").alias("brand_suffix")).agg(F.count(F.lit(1)).alias("n"))


@register("f8_f9_math_cap_floor", """
SELECT o_orderstatus, round(sum(log10(o_totalprice)), 6) AS s_log10, round(sum(1 / (1 + exp(-(o_totalprice / 100000 - 2)))), 6) AS s_sigmoid,
       round(sum(sqrt(o_totalprice)), 6) AS s_sqrt, CAST(sum(floor(o_totalprice / 1000)) AS BIGINT) AS s_floor,
       round(sum(round_even(o_totalprice / 1000, 0)), 6) AS s_bround,
       round(sum(least(greatest(o_totalprice, 50000.0), 400000.0)), 6) AS s_capped
FROM orders GROUP BY 1""")
def f8_f9(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    v = F.col("o_totalprice")
    return o.groupBy("o_orderstatus").agg(
        F.round(F.sum(F.log10(v)), 6).alias("s_log10"), F.round(F.sum(FN.sigmoid(v / 100000 - 2)), 6).alias("s_sigmoid"),
        F.round(F.sum(F.sqrt(v)), 6).alias("s_sqrt"), F.sum(F.floor(v / 1000)).cast("long").alias("s_floor"),
        # Python round() is half-even: bround, not round.
        F.round(F.sum(F.bround(v / 1000, 0)), 6).alias("s_bround"),
        F.round(F.sum(F.least(F.greatest(v, F.lit(50000.0)), F.lit(400000.0))), 6).alias("s_capped"))


@register("f10_finite_test", """
SELECT event_type, count(*) FILTER (WHERE isfinite(x)) AS n_finite, count(*) AS n FROM (
  SELECT event_type, CASE WHEN value < 1 THEN 'nan'::DOUBLE WHEN value > 480 THEN 'inf'::DOUBLE
                          WHEN value > 470 THEN NULL ELSE value END AS x FROM events) GROUP BY 1""")
def f10(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    x = F.when(F.col("value") < 1, F.lit(float("nan"))).when(F.col("value") > 480, F.lit(float("inf"))) \
        .when(F.col("value") > 470, F.lit(None)).otherwise(F.col("value"))
    return e.groupBy("event_type").agg(F.count_if(FN.is_finite(x)).alias("n_finite"), F.count(F.lit(1)).alias("n"))


@register("f11_iso_time_parse_difference", """
SELECT event_type, CAST(sum(greatest(0, CAST(epoch(CAST(strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' AS TIMESTAMPTZ))
       + floor(value) - epoch(CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP)) AS BIGINT))) AS BIGINT) AS total_seconds,
       count(*) AS n FROM events GROUP BY 1""")
def f11(spark, sf_dir):
    """ISO strings with 'Z' and naive ones (naive = UTC) parsed, differenced
    in whole seconds, floored at 0."""
    e = table(spark, sf_dir, "events")
    end = F.concat(F.date_format(F.timestamp_seconds(F.unix_seconds(F.col("ts").cast("timestamp"))
                                                     + F.floor("value").cast("long")), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    start = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return e.groupBy("event_type").agg(F.sum(FN.elapsed_seconds(start, end)).cast("long").alias("total_seconds"),
                                       F.count(F.lit(1)).alias("n"))


@register("f12_sha256", "SELECT c_custkey, sha256(c_name) AS name_sha256 FROM customer")
def f12(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", F.sha2("c_name", 256).alias("name_sha256"))


@register("f13_json_write_read", f"""
SELECT event_type, CAST(sum({K_SQL}) AS BIGINT) AS sum_k, count(*) AS n FROM events GROUP BY 1""")
def f13(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    doc = F.to_json(F.struct(F.col("event_type").alias("t"), F.from_json("props", "k long").alias("p")))
    back = e.select(doc.alias("doc")).select(F.get_json_object("doc", "$.t").alias("event_type"),
                                             F.from_json("doc", "t string, p struct<k: long>").alias("d"))
    return back.groupBy("event_type").agg(F.sum("d.p.k").cast("long").alias("sum_k"), F.count(F.lit(1)).alias("n"))


@register("f14_array_functions", r"""
WITH t AS (SELECT doc_id, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'),
                                                          lambda x: x <> ''))) AS u FROM documents)
SELECT doc_id, len(u) AS n_unique, md5(array_to_string(u, ',')) AS joined_md5, list_contains(u, 'the') AS has_the FROM t""")
def f14(spark, sf_dir):
    """Per-row arrays over the whole text: unique, sorted, joined, membership
    (no per-group collection)."""
    from tessera.operators.features import tokens
    from tessera.sources.tables import spread
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    u = F.array_sort(F.array_distinct(tokens(F.col("text"))))
    x = d.select("doc_id", u.alias("u"))
    return x.select("doc_id", F.size("u").cast("long").alias("n_unique"), F.md5(F.concat_ws(",", "u")).alias("joined_md5"),
                    F.array_contains("u", "the").alias("has_the"))


@register("f15_f16_append_reason_first_non_blank", """
WITH r AS (SELECT event_type, CASE WHEN value < 100 THEN 'slow' WHEN value < 200 THEN '' ELSE NULL END AS reasons,
                  CASE WHEN value < 50 THEN '  ' ELSE NULL END AS a, CASE WHEN value < 300 THEN ' x ' END AS b FROM events),
s AS (SELECT *, CASE WHEN reasons IS NULL OR trim(reasons) = '' THEN 'missing_metrics'
                     WHEN list_contains(regexp_split_to_array(reasons, '; ?'), 'missing_metrics') THEN reasons
                     ELSE reasons || '; missing_metrics' END AS appended,
              coalesce(nullif(trim(a), ''), nullif(trim(b), ''), 'default') AS first_value FROM r)
SELECT appended, first_value, count(*) AS n FROM s GROUP BY ALL""")
def f15_f16(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    reasons = F.when(F.col("value") < 100, "slow").when(F.col("value") < 200, "")
    a = F.when(F.col("value") < 50, "  ")
    b = F.when(F.col("value") < 300, " x ")
    x = e.select(FN.append_reason(reasons, "missing_metrics").alias("appended"),
                 F.coalesce(FN.first_non_blank(a, b), F.lit("default")).alias("first_value"))
    return x.groupBy("appended", "first_value").agg(F.count(F.lit(1)).alias("n"))


@register("f17_regex_search_replace", r"""
SELECT url_host, count(*) AS n FROM (
  SELECT regexp_replace(regexp_extract(url, '^https?://([^/]+)', 1), '^(www|m)\.', '') AS url_host FROM pages) GROUP BY 1""")
def f17(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    host = F.regexp_replace(F.regexp_extract("url", r"^https?://([^/]+)", 1), r"^(www|m)\.", "")
    return p.groupBy(host.alias("url_host")).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ hooks


@steps.step("curate")
def _curate(df):
    return C.require_non_null(df, ["o_totalprice"])


@steps.step("label.class")
def _label(df):
    return C.label_classes(df, "o_totalprice", 50000.0, 150000.0)


@steps.step("split")
def _split(df):
    from tessera.operators.split import random_holdout
    return df.join(random_holdout(df.select(ROW_INDEX), test_size=0.2, val_size=0.1, seed=42), ROW_INDEX)


@register("b1_b2_composed_steps", """
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS rn,
                  count(*) OVER () AS n FROM orders WHERE o_totalprice IS NOT NULL AND NOT isnan(o_totalprice))
SELECT split, count(*) AS n_rows, round(count(*) / sum(count(*)) OVER (), 6) AS fraction FROM (
  SELECT CASE WHEN rn <= ceil(0.2::DOUBLE * n) THEN 'test' WHEN rn <= ceil(0.2::DOUBLE * n)
              + ceil((0.1::DOUBLE / (1 - 0.2::DOUBLE)) * (n - ceil(0.2::DOUBLE * n))) THEN 'val' ELSE 'train' END AS split
  FROM r) GROUP BY 1""")
def b1_b2(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn(ROW_INDEX, F.col("o_orderkey"))
    out = steps.run_steps(o, ["curate", "label.class", "split"])
    return split_summary(out.select("split"))


@F.pandas_udf(T.StructType([T.StructField("value", T.StringType()), T.StructField("ok", T.BooleanType())]))
def _canonicalise(s: pd.Series) -> pd.DataFrame:
    """Example per-row canonicaliser returning struct(value, ok)."""
    v = s.fillna("").str.strip().str.lower()
    return pd.DataFrame({"value": v.where(v != "", None), "ok": v != ""})


@register("b5_scalar_pandas_udf_struct", """
SELECT lower(trim(p_name)) AS value, count(*) AS n FROM part WHERE trim(p_name) <> '' GROUP BY 1""")
def b5(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(_canonicalise("p_name").alias("c"))
    return p.filter("c.ok").groupBy(F.col("c.value").alias("value")).agg(F.count(F.lit(1)).alias("n"))


@register("b6_one_to_many_udtf", """
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) WHERE word <> '' GROUP BY 1""")
def b6(spark, sf_dir):
    """Per-row -> many rows with an Arrow-batched Python UDTF."""
    from pyspark.sql.functions import udtf

    @udtf(returnType="word string", useArrow=True)
    class Words:
        def eval(self, name: str):
            for w in (name or "").split(" "):
                if w:
                    yield (w,)

    p = table(spark, sf_dir, "part").select("p_name")
    words = p.lateralJoin(Words(F.col("p_name").outer())) if hasattr(p, "lateralJoin") else None
    if words is None:
        spark.udtf.register("tessera_words", Words)
        p.createOrReplaceTempView("__parts")
        words = spark.sql("SELECT w.word FROM __parts, LATERAL tessera_words(p_name) w")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


MAJ_SCHEMA = "__first long, __win long, __nl long, __ntop long"
MAJ_ROWS = 50_000  # counts decided at once
NO_ID = (1 << 63) - 1


def _decide(pdf: pd.DataFrame) -> pd.DataFrame:
    """B7 escape hatch: majority decisions in pandas over the per-label counts
    of a block of whole keys (never raw rows)."""
    key = pdf.groupby(["__null", "__k"], sort=False).ngroup()
    first = pdf["__f"].groupby(key).min()
    voted = pdf["__l"].notna()
    top = pdf["__n"].where(voted, 0).groupby(key).transform("max")
    won = voted & (pdf["__n"] == top)
    return pd.DataFrame({"__first": first, "__win": pdf["__f"].where(won, NO_ID).groupby(key).min(),
                         "__nl": voted.groupby(key).sum(), "__ntop": won.groupby(key).sum()})


@register("b7_group_apply_majority", f"""
WITH {KEYED_SQL},
bl AS (SELECT key, event_type AS l, count(*) AS n, min(__row_index) AS first_id FROM k GROUP BY 1, 2),
pk AS (SELECT key, count(l) AS nl, max(CASE WHEN l IS NOT NULL THEN n END) AS top, min(first_id) AS first_any
       FROM bl GROUP BY key),
win AS (SELECT bl.key, count(*) AS ntop, min(bl.first_id) AS win_id FROM bl JOIN pk ON bl.key = pk.key
        WHERE pk.nl > 1 AND bl.l IS NOT NULL AND bl.n = pk.top GROUP BY bl.key),
pick AS (SELECT CASE WHEN pk.nl <= 1 THEN pk.first_any WHEN win.ntop = 1 THEN win.win_id END AS id
         FROM pk LEFT JOIN win ON pk.key = win.key)
SELECT k.__row_index, k.key, k.event_type, k.value FROM k JOIN pick ON k.__row_index = pick.id""")
def b7(spark, sf_dir):
    """Same result as the native D3, with the decisions in ``applyInPandas``
    after a map-side (key, label) count.  A call takes a block of keys, about
    ``MAJ_ROWS`` counts at any size of the table, not one key."""
    import_in_workers(spark)
    rows = _keyed(spark, sf_dir)
    per = rows.groupBy(F.col("key").alias("__key"), F.col("event_type").alias("__l")).agg(
        F.count(F.lit(1)).alias("__n"), F.coalesce(F.min(ROW_INDEX), F.lit(NO_ID)).alias("__f"))
    per = written(per.select(F.col("__key").isNull().alias("__null"), F.coalesce("__key", F.lit(0)).alias("__k"), "__l", "__n", "__f"), "label-counts")
    blocks = max(per.count() // MAJ_ROWS + 1, spark.sparkContext.defaultParallelism)
    dec = per.groupBy(F.pmod(F.xxhash64("__k"), F.lit(blocks)).alias("__block")).applyInPandas(_decide, MAJ_SCHEMA)
    pick = dec.select(F.when(F.col("__nl") <= 1, F.col("__first")).when(F.col("__ntop") == 1, F.col("__win"))
                      .alias(ROW_INDEX)).filter(F.col(ROW_INDEX) != NO_ID)
    return rows.join(pick, ROW_INDEX).select(ROW_INDEX, "key", "event_type", "value")


def rmse_scorer(pred_df):
    """B8 example: a user metric ``fn(pred_df) -> DataFrame``."""
    return pred_df.agg(F.round(F.sqrt(F.avg((F.col("y") - F.col("y_hat")) ** 2)), 6).alias("rmse"),
                       F.count(F.lit(1)).alias("n"))


@register("b8_custom_scorer", """
SELECT round(sqrt(avg(power(value / 10.0 - (CAST(json_extract(props, '$.k') AS BIGINT) / 2.0), 2))), 6) AS rmse,
       count(*) AS n FROM events""")
def b8(spark, sf_dir):
    e = events_rows(spark, sf_dir)
    preds = e.select((F.col("value") / 10.0).alias("y"),
                     (F.get_json_object("props", "$.k").cast("long") / 2.0).alias("y_hat"))
    return rmse_scorer(preds)
