"""Source / sink queries (S1-S8, S16-S21): each writes data derived from a
test table to a fresh folder under the shared checkpoint folder with a sink,
reads it back with the matching source and summarises it."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tessera.plans import register
from tessera.sources import files as S
from tessera.sources.tables import table


@register("s1_s16_csv_roundtrip", """
SELECT nullif(o_orderpriority, '5-LOW') AS o_orderpriority, count(*) AS n_rows, round(sum(o_totalprice), 6) AS total
FROM orders GROUP BY 1""")
def s1(spark, sf_dir):
    """CSV sink (S16) of orders with the 5-LOW priority spelled 'NA', then the
    CSV scan (S1): text columns, NA spellings -> NULL, typed columns parsed."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", F.lit("NA")).otherwise(F.col("o_orderpriority"))
        .alias("o_orderpriority"), "o_totalprice")
    path = S.scratch_path(spark, "csv")
    S.write_csv(o, path)
    back = S.read_csv(spark, path, typed={"o_orderkey": "bigint", "o_totalprice": "double"})
    return back.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_rows"),
                                               F.round(F.sum("o_totalprice"), 6).alias("total"))


def _manifest(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    return e.select(
        F.when(F.col("event_type") == "signup", "parent").when(k % 4 == 0, F.lit(None)).otherwise("case").alias("record_type"),
        F.when(F.col("event_type") == "error", "skipped").otherwise("valid").alias("status"),
        F.format_string("case_%05d", "event_id").alias("case_id"),
        F.format_string("parent_%04d", "user_id").alias("parent_case_id"),
        F.when(k % 10 == 0, F.lit("")).otherwise(F.format_string("/cases/case_%05d.yaml", "event_id")).alias("config_path"),
        F.create_map(F.lit("model"), F.col("event_type")).alias("factors"),
        F.when(F.col("event_type") == "error", F.array(F.struct(F.lit("DOE_X").alias("code"), F.lit("p").alias("path"),
                                                                F.lit("m").alias("message"))))
        .otherwise(F.array().cast("array<struct<code:string,path:string,message:string>>")).alias("issues"),
        F.when(k % 3 == 0, "").when(k % 3 == 1, "execution_attempt").otherwise("other").alias("attempt_type"),
        F.col("event_type").alias("state"))


MANIFEST_SQL = """m AS (SELECT CASE WHEN event_type = 'signup' THEN 'parent'
                          WHEN CAST(json_extract(props, '$.k') AS BIGINT) % 4 = 0 THEN NULL ELSE 'case' END AS record_type,
                     CASE WHEN event_type = 'error' THEN 'skipped' ELSE 'valid' END AS status,
                     CASE WHEN CAST(json_extract(props, '$.k') AS BIGINT) % 10 = 0 THEN '' ELSE 'x' END AS config_path,
                     CAST(json_extract(props, '$.k') AS BIGINT) % 3 AS att, event_type FROM events)"""


@register("s2_s18_manifest_jsonl_scan", "WITH " + MANIFEST_SQL + """
SELECT coalesce(record_type, '') AS record_type, count(*) AS n_rows FROM m
WHERE status = 'valid' AND coalesce(record_type, '') <> 'parent' AND config_path <> '' GROUP BY 1""")
def s2(spark, sf_dir):
    path = S.scratch_path(spark, "manifest")
    S.write_jsonl(_manifest(spark, sf_dir).drop("attempt_type", "state"), path)
    m = S.read_manifest(spark, path)
    return m.groupBy(F.coalesce("record_type", F.lit("")).alias("record_type")).agg(F.count(F.lit(1)).alias("n_rows"))


@register("s3_execution_attempt_scan", "WITH " + MANIFEST_SQL + """
SELECT event_type AS state, count(*) AS n_rows FROM m WHERE att IN (0, 1) GROUP BY 1""")
def s3(spark, sf_dir):
    path = S.scratch_path(spark, "attempts")
    att = _manifest(spark, sf_dir).select(F.col("attempt_type").alias("record_type"), "case_id", "state")
    S.write_jsonl(att, path)
    return S.read_attempts(spark, path).groupBy("state").agg(F.count(F.lit(1)).alias("n_rows"))


@register("s4_per_run_json_documents", """
SELECT count(*) + 1 AS n_documents, CAST(1 AS BIGINT) AS n_corrupt, round(sum(avg_test), 6) AS sum_test FROM (
  SELECT user_id, avg(value / 500.0) AS avg_test FROM events GROUP BY user_id)""")
def s4(spark, sf_dir):
    """One multi-line JSON document per parent (split metrics), plus one
    corrupt document; PERMISSIVE scan keyed by file path."""
    e = table(spark, sf_dir, "events")
    docs = e.groupBy(F.format_string("parent_%04d", "user_id").alias("parent")).agg(
        F.create_map(F.lit("r2"), F.avg(F.col("value") / 500.0)).alias("test"),
        F.create_map(F.lit("r2"), F.avg(F.lit(0.9))).alias("train"))
    path = S.scratch_path(spark, "docs")
    docs.write.partitionBy("parent").mode("overwrite").json(path)
    spark.createDataFrame([("{broken",)], "value string").coalesce(1).write.text(os.path.join(path, "parent=corrupt"))
    back = S.read_json_documents(spark, os.path.join(path, "*", "*"), S.SPLIT_METRICS_SCHEMA)
    return back.agg(F.count(F.lit(1)).alias("n_documents"),
                    F.count_if(F.col("_corrupt_record").isNotNull()).alias("n_corrupt"),
                    F.round(F.sum(F.col("test")["r2"]), 6).alias("sum_test"))


@register("s5_report_rescan", """
SELECT coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END, '') AS o_orderstatus, count(*) AS n_rows
FROM orders GROUP BY 1""")
def s5(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    path = S.scratch_path(spark, "report")
    S.write_csv(o, path)
    return S.read_report_csv(spark, path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"))


@register("s6_multi_record_text_scan", """
SELECT count(*) AS n_records, CAST(sum(doc_id) AS BIGINT) AS sum_ids, count(DISTINCT lang) AS n_langs FROM documents""")
def s6(spark, sf_dir):
    """Delimiter-separated multi-line records (SDF style: fields, then a
    ``$$$$`` line); parsed with ``regexp_extract``."""
    d = table(spark, sf_dir, "documents")
    rec = d.select(F.concat(F.col("doc_id").cast("string"), F.lit("\n  lang\n> <lang>\n"), F.col("lang"),
                            F.lit("\n\n$$$$")).alias("value"))
    path = S.scratch_path(spark, "records")
    rec.write.mode("overwrite").text(path)
    r = S.read_multi_records(spark, path)
    parsed = r.select(F.regexp_extract("value", r"^\s*(\d+)", 1).try_cast("long").alias("id"),
                      F.regexp_extract("value", r"> <lang>\n([^\n]*)", 1).alias("lang")).filter(F.col("id").isNotNull())
    return parsed.agg(F.count(F.lit(1)).alias("n_records"), F.sum("id").cast("long").alias("sum_ids"),
                      F.count_distinct("lang").alias("n_langs"))


@register("s6_partitioned_record_source", """
SELECT doc_id AS id, lang, octet_length(encode(coalesce(text, ''))) AS n_bytes, md5(coalesce(text, '')) AS text_md5,
       CAST(1 AS BIGINT) AS n_plain, CAST(1 AS BIGINT) AS n_gzip, CAST(0 AS BIGINT) AS n_bad FROM documents""")
def s6_partitioned(spark, sf_dir):
    """Whole documents as multi-line records in plain and in gzip files, read
    back in splits of a megabyte."""
    d = table(spark, sf_dir, "documents")
    body = F.concat(F.col("doc_id").cast("string"), F.lit("\n  lang\n> <lang>\n"), F.coalesce("lang", F.lit("")),
                    F.lit("\n> <text>\n"), F.coalesce("text", F.lit("")), F.lit("\n"))
    read = []
    for packing in ("none", "gzip"):
        path = S.scratch_path(spark, f"records-{packing}")
        d.select(body.alias("value")).write.option("lineSep", "$$$$\n").option("compression", packing).text(path)
        read.append(S.get_data(spark, "sdf", path=path, split_bytes=1 << 20).withColumn("packing", F.lit(packing)))
    text = F.expr("substring(record, instr(record, '\\n> <text>\\n') + 10)")
    parsed = read[0].unionByName(read[1]).select(
        "packing", "bad", F.regexp_extract("record", r"^(-?\d+)\n", 1).try_cast("long").alias("id"),
        F.regexp_extract("record", r"> <lang>\n([^\n]*)", 1).alias("lang"), text.alias("text"))
    parsed = parsed.withColumn("text", F.expr("left(text, length(text) - 1)"))
    return parsed.groupBy("id", "lang", F.octet_length("text").cast("long").alias("n_bytes"), F.md5("text").alias("text_md5")).agg(
        F.count_if(F.col("packing") == "none").alias("n_plain"), F.count_if(F.col("packing") == "gzip").alias("n_gzip"),
        F.count("bad").alias("n_bad"))


@register("s7_line_record_scan", """
SELECT count(*) AS n_rows, CAST(sum(p_partkey) AS BIGINT) AS sum_keys, count(DISTINCT p_brand) AS n_names FROM part""")
def s7(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.concat_ws(" ", F.col("p_partkey").cast("string"), "p_brand").alias("v"))
    path = S.scratch_path(spark, "lines")
    p.write.mode("overwrite").text(path)
    r = S.read_line_records(spark, path)
    return r.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("key").cast("long")).cast("long").alias("sum_keys"),
                 F.count_distinct("name").alias("n_names"))


@register("s8_column_pruned_probe_scan", """
SELECT count(*) AS n_rows, count(DISTINCT l_returnflag) AS n_distinct FROM lineitem""")
def s8(spark, sf_dir):
    """One column of a wide table: the parquet scan reads only that column."""
    li = table(spark, sf_dir, "lineitem").select("l_returnflag")
    return li.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("l_returnflag").alias("n_distinct"))


@register("s17_append_sink", """
SELECT o_orderstatus, 2 * count(*) AS n_rows FROM orders GROUP BY 1""")
def s17(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    path = S.scratch_path(spark, "append")
    o.write.mode("append").parquet(path)
    o.write.mode("append").parquet(path)
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"))


@register("s19_line_list_sink", """
SELECT count(*) AS n_lines, min(p) AS first_line, max(p) AS last_line FROM (
  SELECT DISTINCT '/cases/' || o_orderpriority || '/' || o_orderstatus || '.yaml' AS p FROM orders)""")
def s19(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("/cases/"), "o_orderpriority", F.lit("/"), "o_orderstatus", F.lit(".yaml")).alias("p"))
    path = S.scratch_path(spark, "list")
    S.write_line_list(o, "p", path)
    back = spark.read.text(path)
    return back.agg(F.count(F.lit(1)).alias("n_lines"), F.min("value").alias("first_line"),
                    F.max("value").alias("last_line"))


@register("s20_fitted_artifact_roundtrip")
def s20(spark, sf_dir):
    """Fitted preprocessing statistics persisted as a small parquet table and
    reloaded (the reference pickles the scaler)."""
    from tessera.operators import preprocess as X
    li = table(spark, sf_dir, "lineitem")
    fitted = X.fit(li, ["l_quantity", "l_discount", "l_tax"], scaler="standard")
    path = S.scratch_path(spark, "artifact")
    fitted.table(spark).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@register("s21_source_registry", """
SELECT count(*) AS n_rows FROM region""")
def s21(spark, sf_dir):
    df = S.get_data(spark, "parquet", path=os.path.join(sf_dir, "region.parquet"))
    return df.agg(F.count(F.lit(1)).alias("n_rows"))
