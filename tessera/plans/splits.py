"""Split queries (T1-T19).  orders rows (id = o_orderkey) are the samples;
``o_custkey`` is the group key (scaffold), ``o_orderstatus`` the class."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import checks
from tessera.operators import split as S
from tessera.operators.align import nth_occurrence_join
from tessera.plans import register
from tessera.plans.flagship import greedy_group_split_sql
from tessera.sources.tables import ROW_INDEX, table


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn(ROW_INDEX, F.col("o_orderkey"))


def _holdout_sql(src: str, id_expr: str, seed: int, test: float, val: float, part: str = "") -> str:
    """DuckDB twin of T1 (``part`` = optional PARTITION BY for strata-free use)."""
    return f"""
r AS (SELECT *, row_number() OVER ({part} ORDER BY md5('{seed}:' || CAST({id_expr} AS VARCHAR)), {id_expr}) AS rn,
             count(*) OVER ({part}) AS n FROM {src}),
h AS (SELECT *, CASE WHEN rn <= ceil({test}::DOUBLE * n) THEN 'test'
        WHEN rn <= ceil({test}::DOUBLE * n) + (CASE WHEN {val} > 0 THEN
             ceil(({val}::DOUBLE / (1 - {test}::DOUBLE)) * (n - ceil({test}::DOUBLE * n))) ELSE 0 END)
        THEN 'val' ELSE 'train' END AS split FROM r)"""


@register("t1_random_holdout", "WITH " + _holdout_sql("orders", "o_orderkey", 42, 0.2, 0.1)
          + "\nSELECT o_orderkey AS __row_index, split FROM h")
def t1(spark, sf_dir):
    return S.random_holdout(_orders(spark, sf_dir).select(ROW_INDEX), test_size=0.2, val_size=0.1, seed=42)


def _largest_remainder_sql(counts: str, pick: str, total: str, out: str) -> str:
    return f"""
{out}_x AS (SELECT lbl, n_c, {pick} * n_c / {total} AS ex, floor({pick} * n_c / {total}) AS base FROM {counts}),
{out} AS (SELECT lbl, n_c, CAST(base + CASE WHEN row_number() OVER (ORDER BY ex - base DESC, lbl)
              <= {pick} - (SELECT sum(base) FROM {out}_x) THEN 1 ELSE 0 END AS BIGINT) AS q FROM {out}_x)"""


T2_SQL = f"""WITH
cc AS (SELECT CAST(o_orderstatus AS VARCHAR) AS lbl, count(*) AS n_c FROM orders GROUP BY 1),
par AS (SELECT sum(n_c) AS n, ceil(0.2::DOUBLE * sum(n_c)) AS nt,
               ceil((0.1::DOUBLE / (1 - 0.2::DOUBLE)) * (sum(n_c) - ceil(0.2::DOUBLE * sum(n_c)))) AS nv FROM cc),
{_largest_remainder_sql("cc", "(SELECT nt FROM par)", "(SELECT n FROM par)", "tq")},
rest AS (SELECT lbl, n_c - q AS n_c FROM tq),
{_largest_remainder_sql("rest", "(SELECT nv FROM par)", "(SELECT n - nt FROM par)", "vq")},
r AS (SELECT o_orderkey, CAST(o_orderstatus AS VARCHAR) AS lbl,
             row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)),
                                o_orderkey) AS rn FROM orders)
SELECT r.o_orderkey AS __row_index, CASE WHEN rn <= tq.q THEN 'test' WHEN rn <= tq.q + vq.q THEN 'val'
       ELSE 'train' END AS split
FROM r JOIN tq ON r.lbl = tq.lbl JOIN vq ON r.lbl = vq.lbl"""


@register("t2_stratified_holdout", T2_SQL)
def t2(spark, sf_dir):
    return S.stratified_holdout(_orders(spark, sf_dir), "o_orderstatus", test_size=0.2, val_size=0.1, seed=42)


@register("t3_stratify_guard", """
SELECT 'o_orderpriority' AS column_name, count(DISTINCT o_orderpriority) AS n_distinct,
       count(DISTINCT o_orderpriority) <= 20 AS usable FROM orders""")
def t3(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    counts = S.stratify_guard(o, "o_orderpriority")
    return o.agg(F.count_distinct("o_orderpriority").alias("n_distinct")).select(
        F.lit("o_orderpriority").alias("column_name"), "n_distinct",
        (F.col("n_distinct") <= F.lit(len(counts) if len(counts) <= S.MAX_STRATA else -1)).alias("usable"))


@register("t4_val_carve_out", "WITH " + _holdout_sql("orders", "o_orderkey", 42, 0.2, 0.0) + ",\n"
          + "pool AS (SELECT o_orderkey FROM h WHERE split = 'train'),"
          + _holdout_sql("pool", "o_orderkey", 43, 0.125, 0.0).replace("r AS", "r2 AS", 1).replace(
              "FROM r)", "FROM r2)").replace("h AS", "h2 AS", 1)
          + """
SELECT split, count(*) AS n_rows FROM (
  SELECT CASE WHEN split = 'test' THEN 'val' ELSE 'train' END AS split FROM h2
  UNION ALL SELECT 'test' FROM h WHERE split = 'test') GROUP BY 1""")
def t4(spark, sf_dir):
    o = _orders(spark, sf_dir).select(ROW_INDEX)
    outer = S.random_holdout(o, test_size=0.2, val_size=0.0, seed=42)
    pool = outer.filter(F.col("split") == "train").select(ROW_INDEX)
    if pool.limit(2).count() < 2:
        raise ValueError("train pool must have at least 2 rows")
    inner = S.random_holdout(pool, test_size=0.125, val_size=0.0, seed=43).select(
        ROW_INDEX, F.when(F.col("split") == "test", F.lit("val")).otherwise(F.lit("train")).alias("split"))
    allsp = inner.unionByName(outer.filter(F.col("split") == "test"))
    return allsp.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


@register("t5_repeated_kfold", """
WITH reps AS (SELECT o_orderkey, unnest(range(0, 2)) AS repeat FROM orders),
r AS (SELECT o_orderkey, repeat, row_number() OVER (PARTITION BY repeat
        ORDER BY md5(CAST(42 + repeat AS VARCHAR) || ':' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS rn FROM reps)
SELECT o_orderkey AS __row_index, CAST(repeat AS INTEGER) AS repeat, CAST((rn - 1) % 5 AS INTEGER) AS fold FROM r""")
def t5(spark, sf_dir):
    return S.repeated_kfold(_orders(spark, sf_dir).select(ROW_INDEX), k=5, repeats=2, seed=42).select(
        ROW_INDEX, F.col("repeat").cast("int").alias("repeat"), "fold")


@register("t6_stratified_kfold", """
WITH cc AS (SELECT CAST(o_orderstatus AS VARCHAR) AS lbl, count(*) AS n_c FROM orders GROUP BY 1),
off AS (SELECT lbl, (coalesce(sum(n_c) OVER (ORDER BY lbl ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) % 5
        AS o FROM cc),
reps AS (SELECT o_orderkey, CAST(o_orderstatus AS VARCHAR) AS lbl, unnest(range(0, 2)) AS repeat FROM orders),
r AS (SELECT o_orderkey, lbl, repeat, row_number() OVER (PARTITION BY repeat, lbl
        ORDER BY md5(CAST(42 + repeat AS VARCHAR) || ':' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS rn FROM reps)
SELECT r.o_orderkey AS __row_index, CAST(repeat AS INTEGER) AS repeat, CAST((rn - 1 + off.o) % 5 AS INTEGER) AS fold
FROM r JOIN off ON r.lbl = off.lbl""")
def t6(spark, sf_dir):
    return S.repeated_kfold(_orders(spark, sf_dir), k=5, repeats=2, seed=42, label="o_orderstatus").select(
        ROW_INDEX, F.col("repeat").cast("int").alias("repeat"), "fold")


@register("t7_group_greedy_holdout", "WITH RECURSIVE "
          + "src AS (SELECT o_orderkey, o_custkey FROM orders)," + greedy_group_split_sql("src", "o_custkey", 0.2, 0.1, 42)
          + "\nSELECT o_orderkey AS __row_index, split FROM assigned")
def t7(spark, sf_dir):
    o = _orders(spark, sf_dir).select(ROW_INDEX, "o_custkey")
    return S.group_holdout(o, "o_custkey", test_size=0.2, val_size=0.1, seed=42).select(ROW_INDEX, "split")


def _group_kfold_sql(src: str, gexpr: str, k: int, repeats: int, seed: int) -> str:
    zeros = ", ".join(["0"] * k)
    return f"""WITH RECURSIVE
gk AS (SELECT *, coalesce(CAST({gexpr} AS VARCHAR), '') AS g FROM {src}),
sizes AS (SELECT g, count(*) AS s FROM gk GROUP BY g),
reps AS (SELECT g, s, unnest(range(0, {repeats})) AS repeat FROM sizes),
ord AS (SELECT g, s, repeat, row_number() OVER (PARTITION BY repeat ORDER BY s DESC,
          md5(CAST({seed} + repeat AS VARCHAR) || ':' || g), g) AS i FROM reps),
rec AS (
  SELECT repeat, CAST(0 AS BIGINT) AS i, NULL::VARCHAR AS g, -1 AS fold, [{zeros}]::BIGINT[] AS loads
  FROM (SELECT DISTINCT repeat FROM reps)
  UNION ALL
  SELECT o.repeat, o.i, o.g, list_position(r.loads, list_min(r.loads)) - 1,
         [CASE WHEN j = list_position(r.loads, list_min(r.loads)) - 1 THEN r.loads[j + 1] + o.s
               ELSE r.loads[j + 1] END for j in range({k})]
  FROM rec r JOIN ord o ON o.repeat = r.repeat AND o.i = r.i + 1
)"""


@register("t8_group_kfold", _group_kfold_sql("orders", "o_custkey", 5, 2, 42) + """
SELECT gk.o_orderkey AS __row_index, CAST(rec.repeat AS INTEGER) AS repeat, CAST(rec.fold AS INTEGER) AS fold
FROM gk JOIN rec ON gk.g = rec.g""")
def t8(spark, sf_dir):
    o = _orders(spark, sf_dir).select(ROW_INDEX, "o_custkey")
    return S.group_kfold(o, "o_custkey", k=5, repeats=2, seed=42).select(
        ROW_INDEX, F.col("repeat").cast("int").alias("repeat"), "fold")


@register("t9_null_group_key", "WITH RECURSIVE "
          + "src AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END AS grp "
            "FROM orders)," + greedy_group_split_sql("src", "grp", 0.3, 0.1, 42)
          + "\nSELECT split, grp IS NULL AS null_group, count(*) AS n_rows FROM assigned GROUP BY ALL")
def t9(spark, sf_dir):
    """NULL keys share the group '' -- here a fifth of all rows, one hot group."""
    o = _orders(spark, sf_dir).select(
        ROW_INDEX, F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_custkey")).alias("grp"))
    sp = S.group_holdout(o, "grp", test_size=0.3, val_size=0.1, seed=42)
    return sp.groupBy("split", F.col("grp").isNull().alias("null_group")).agg(F.count(F.lit(1)).alias("n_rows"))


@register("t10_fold_selection", """
WITH reps AS (SELECT o_orderkey, unnest(range(0, 2)) AS repeat FROM orders),
r AS (SELECT o_orderkey, repeat, row_number() OVER (PARTITION BY repeat
        ORDER BY md5(CAST(42 + repeat AS VARCHAR) || ':' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS rn FROM reps)
SELECT o_orderkey AS __row_index, CASE WHEN (rn - 1) % 5 = 2 THEN 'test' ELSE 'train' END AS split
FROM r WHERE repeat = 1""")
def t10(spark, sf_dir):
    folds = S.repeated_kfold(_orders(spark, sf_dir).select(ROW_INDEX), k=5, repeats=2, seed=42)
    return checks.checked_fold(folds, repeat=1, fold=2)


@register("t11_nested_holdout_cv", "WITH RECURSIVE "
          + "src AS (SELECT o_orderkey, o_custkey FROM orders)," + greedy_group_split_sql("src", "o_custkey", 0.2, 0.0, 42)
          + """,
dev AS (SELECT o_orderkey FROM assigned WHERE split <> 'test'),
reps AS (SELECT o_orderkey, unnest(range(0, 1)) AS repeat FROM dev),
r AS (SELECT o_orderkey, repeat, row_number() OVER (PARTITION BY repeat
        ORDER BY md5(CAST(42 + repeat AS VARCHAR) || ':' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS rn FROM reps)
SELECT 'inner' AS stage, CAST((rn - 1) % 3 AS INTEGER) AS fold, count(*) AS n_rows FROM r GROUP BY ALL
UNION ALL SELECT 'outer_test', -1, count(*) FROM assigned WHERE split = 'test'""")
def t11(spark, sf_dir):
    """Outer group holdout (test never touched), inner 3-fold CV on the rest."""
    o = _orders(spark, sf_dir).select(ROW_INDEX, "o_custkey")
    outer = S.group_holdout(o, "o_custkey", test_size=0.2, val_size=0.0, seed=42)
    test = outer.filter(F.col("split") == "test")
    dev = o.join(test.select(ROW_INDEX), on=ROW_INDEX, how="left_anti")
    inner = S.repeated_kfold(dev.select(ROW_INDEX), k=3, repeats=1, seed=42)
    a = inner.groupBy(F.lit("inner").alias("stage"), "fold").agg(F.count(F.lit(1)).alias("n_rows"))
    b = test.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("outer_test").alias("stage"),
                                                           F.lit(-1).alias("fold"), "n_rows")
    return a.unionByName(b)


@register("t12_predefined_split_import", """
WITH payload AS (SELECT o_custkey AS k, CASE o_orderpriority WHEN '1-URGENT' THEN 'test'
                    WHEN '2-HIGH' THEN 'valid' WHEN '3-MEDIUM' THEN 'validation' ELSE 'train' END AS raw_split,
                    o_totalprice AS p FROM orders),
pl AS (SELECT k, CASE WHEN lower(raw_split) IN ('valid', 'validation') THEN 'val' ELSE lower(raw_split) END AS split,
              row_number() OVER (PARTITION BY k ORDER BY p, raw_split) AS occ FROM payload),
cur AS (SELECT o_custkey AS k, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS occ
        FROM orders)
SELECT cur.o_orderkey AS __row_index, pl.split FROM pl JOIN cur ON pl.k = cur.k AND pl.occ = cur.occ""")
def t12(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    raw = F.when(F.col("o_orderpriority") == "1-URGENT", "test").when(F.col("o_orderpriority") == "2-HIGH", "valid") \
        .when(F.col("o_orderpriority") == "3-MEDIUM", "validation").otherwise("train")
    payload = o.select(F.col("o_custkey").alias("k"), raw.alias("raw_split"), F.col("o_totalprice").alias("p"))
    payload = payload.withColumn("split", F.when(F.lower("raw_split").isin("valid", "validation"), "val")
                                 .otherwise(F.lower("raw_split")))
    cur = o.select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias(ROW_INDEX))
    j = nth_occurrence_join(payload.select("k", "split", "p", "raw_split"), cur, "k", ["p", "raw_split"], ROW_INDEX, how="inner")
    return j.select(F.col(f"r_{ROW_INDEX}").alias(ROW_INDEX), "split")


@register("t12_nested_payload_import", """
WITH pl AS (SELECT o_custkey AS k, CASE o_orderpriority WHEN '1-URGENT' THEN 'test' WHEN '2-HIGH' THEN 'val'
                     WHEN '3-MEDIUM' THEN 'val' ELSE 'train' END AS split,
                   row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS occ FROM orders),
cur AS (SELECT o_custkey AS k, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS occ FROM orders)
SELECT cur.o_orderkey AS __row_index, pl.split FROM pl JOIN cur ON pl.k = cur.k AND pl.occ = cur.occ""")
def t12_nested(spark, sf_dir):
    """A payload of two strategies, of which the scaffold one is imported."""
    o = table(spark, sf_dir, "orders")
    part = F.when(F.col("o_orderpriority") == "1-URGENT", "TEST").when(F.col("o_orderpriority") == "2-HIGH", "valid") \
        .when(F.col("o_orderpriority") == "3-MEDIUM", "Validation").otherwise("train")
    paths = F.array(F.concat(F.lit("by_Scaffold."), part), F.concat(F.lit("at_random."), F.reverse(part)))
    payload = o.select(F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("p"), F.col("o_orderkey").alias("id"), F.explode(paths).alias("path"))
    cur = o.select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias(ROW_INDEX))
    chosen = S.chosen_parts(payload, "scaffold").select("k", "split", "p", "id")
    j = nth_occurrence_join(chosen, cur, "k", ["p", "id"], ROW_INDEX, how="inner")
    return j.select(F.col(f"r_{ROW_INDEX}").alias(ROW_INDEX), "split")


@register("t14_split_coverage", "WITH " + _holdout_sql("(SELECT * FROM orders WHERE o_totalprice > 20000)", "o_orderkey", 42, 0.2, 0.1) + """
, n AS (SELECT (SELECT count(*) FROM orders) AS s, count(*) AS c FROM orders WHERE o_totalprice > 20000)
SELECT s AS source_rows, c AS curated_rows, s - c AS dropped_before_split, a AS assigned_rows, round(a / greatest(c, 1), 6) AS assigned_fraction
FROM n, (SELECT count(DISTINCT o_orderkey) AS a FROM h WHERE split <> 'val')""")
def t14_coverage(spark, sf_dir):
    """Orders over a price are curated; the validation part is left out."""
    o = _orders(spark, sf_dir)
    curated = o.filter(F.col("o_totalprice") > 20000)
    sp = S.random_holdout(curated.select(ROW_INDEX), test_size=0.2, val_size=0.1, seed=42).where("split <> 'val'")
    return S.split_coverage(sp, curated, o)


@register("t13_split_validation", "WITH " + _holdout_sql("orders", "o_orderkey", 42, 0.2, 0.1) + """
, sp AS (SELECT o_orderkey AS id, split FROM h WHERE o_totalprice > 5000 UNION ALL SELECT -1, 'test'),
per AS (SELECT id, count(DISTINCT split) AS k FROM sp GROUP BY id),
uni AS (SELECT o_orderkey AS id FROM orders)
SELECT count(*) FILTER (WHERE per.id IS NOT NULL AND uni.id IS NULL) AS unknown_ids,
       count(*) FILTER (WHERE per.k > 1) AS overlapping_ids,
       count(*) FILTER (WHERE uni.id IS NOT NULL AND per.id IS NOT NULL) AS covered_ids,
       count(*) FILTER (WHERE uni.id IS NOT NULL) AS universe_ids,
       round(count(*) FILTER (WHERE uni.id IS NOT NULL AND per.id IS NOT NULL)
             / count(*) FILTER (WHERE uni.id IS NOT NULL), 6) AS coverage
FROM per FULL JOIN uni ON per.id = uni.id""")
def t13(spark, sf_dir):
    o = _orders(spark, sf_dir)
    sp = S.random_holdout(o.select(ROW_INDEX), test_size=0.2, val_size=0.1, seed=42)
    sp = sp.join(o.filter(F.col("o_totalprice") > 5000).select(ROW_INDEX), on=ROW_INDEX, how="left_semi")
    bogus = spark.createDataFrame([(-1, "test")], f"{ROW_INDEX} long, split string")
    return S.split_validation(sp.unionByName(bogus), o.select(ROW_INDEX))


@register("t14_split_summary", "WITH " + _holdout_sql("orders", "o_orderkey", 42, 0.2, 0.1) + """
SELECT split, count(*) AS n_rows, round(count(*) / sum(count(*)) OVER (), 6) AS fraction FROM h GROUP BY 1""")
def t14(spark, sf_dir):
    sp = S.random_holdout(_orders(spark, sf_dir).select(ROW_INDEX), test_size=0.2, val_size=0.1, seed=42)
    return S.split_summary(sp)


@register("t15_partition_resolution", "WITH " + _holdout_sql("orders", "o_orderkey", 42, 0.2, 0.1) + """
, feat AS (SELECT o_orderkey FROM orders WHERE o_totalprice > 20000)
SELECT split, count(*) AS n_ids, count(feat.o_orderkey) AS n_present,
       round(count(feat.o_orderkey) / count(*), 6) AS coverage
FROM h LEFT JOIN feat ON h.o_orderkey = feat.o_orderkey GROUP BY 1""")
def t15(spark, sf_dir):
    o = _orders(spark, sf_dir)
    sp = S.random_holdout(o.select(ROW_INDEX), test_size=0.2, val_size=0.1, seed=42)
    feat = o.filter(F.col("o_totalprice") > 20000).select(ROW_INDEX, F.lit(1).alias("__present"))
    j = sp.join(feat, on=ROW_INDEX, how="left")
    return j.groupBy("split").agg(F.count(F.lit(1)).alias("n_ids"), F.count("__present").alias("n_present"),
                                  F.round(F.count("__present") / F.count(F.lit(1)), 6).alias("coverage"))


@register("t15_resolved_partitions", "WITH " + _holdout_sql("orders", "o_orderkey", 42, 0.2, 0.1) + """
SELECT h.o_orderkey AS __row_index, CASE split WHEN 'test' THEN 'train' WHEN 'val' THEN 'test' ELSE split END AS split
FROM h JOIN (SELECT o_orderkey FROM orders WHERE o_totalprice > 20000) USING (o_orderkey)""")
def t15_rows(spark, sf_dir):
    """A split without a test part (its rows train): validation serves as test."""
    o = _orders(spark, sf_dir)
    sp = S.random_holdout(o.select(ROW_INDEX), test_size=0.2, val_size=0.1, seed=42)
    sp = sp.withColumn("split", F.when(F.col("split") == "test", "train").otherwise(F.col("split")))
    return checks.resolved_partitions(sp, o.filter(F.col("o_totalprice") > 20000), min_coverage={"test": 0.5})


@register("j7_split_positions", "WITH " + _holdout_sql("orders", "o_orderkey", 42, 0.2, 0.1) + """
SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS position, split FROM h""")
def j7_positions(spark, sf_dir):
    o = _orders(spark, sf_dir).select(ROW_INDEX)
    sp = S.random_holdout(o, test_size=0.2, val_size=0.1, seed=42)
    return checks.split_positions(checks.checked_split(sp, o, min_coverage=1.0), o)


@register("t16_dataset_fingerprint", """
SELECT count(*) AS n_rows, CAST(sum(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|'
       || CAST(o_orderstatus AS VARCHAR)), 1, 15))::BIGINT) AS VARCHAR) AS fingerprint FROM orders""")
def t16(spark, sf_dir):
    return S.dataset_fingerprint(table(spark, sf_dir, "orders"), "o_orderkey", "o_orderstatus")


@register("t17_plan_id", """
SELECT o_orderstatus, substr(sha256('{"n_rows": ' || CAST(count(*) AS VARCHAR) || ', "status": "'
       || o_orderstatus || '"}'), 1, 12) AS plan_id FROM orders GROUP BY 1""")
def t17(spark, sf_dir):
    g = table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    payload = F.concat(F.lit('{"n_rows": '), F.col("n").cast("string"), F.lit(', "status": "'),
                       F.col("o_orderstatus"), F.lit('"}'))
    return g.select("o_orderstatus", S.plan_id(payload).alias("plan_id"))


@register("t18_plan_reuse_guard", """
WITH a AS (SELECT count(*) AS n, sum(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|' || o_orderstatus), 1, 15))::BIGINT) AS f
           FROM orders),
b AS (SELECT count(*) AS n, sum(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|' || o_orderstatus), 1, 15))::BIGINT) AS f
      FROM orders WHERE o_orderstatus <> 'P')
SELECT a.n = a.n AND a.f = a.f AS reuse_same_data, a.n = b.n AND a.f = b.f AS reuse_changed_data FROM a, b""")
def t18(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    stored = S.dataset_fingerprint(o, "o_orderkey", "o_orderstatus")
    changed = S.dataset_fingerprint(o.filter(F.col("o_orderstatus") != "P"), "o_orderkey", "o_orderstatus")
    s = stored.select(F.col("n_rows").alias("sn"), F.col("fingerprint").alias("sf"))
    c = changed.select(F.col("n_rows").alias("cn"), F.col("fingerprint").alias("cf"))
    same = stored.join(s, how="inner").select(((F.col("n_rows") == F.col("sn")) & (F.col("fingerprint") == F.col("sf")))
                                              .alias("reuse_same_data"), "n_rows", "fingerprint")
    return same.join(c, how="inner").select(
        "reuse_same_data", ((F.col("n_rows") == F.col("cn")) & (F.col("fingerprint") == F.col("cf"))).alias("reuse_changed_data"))


@register("t19_auto_stratified_split", """
WITH cc AS (SELECT CAST(quality AS VARCHAR) AS lbl, count(*) AS n_c FROM labels GROUP BY 1),
par AS (SELECT sum(n_c) AS n, ceil(0.25::DOUBLE * sum(n_c)) AS nt, 0 AS nv FROM cc),
""" + _largest_remainder_sql("cc", "(SELECT nt FROM par)", "(SELECT n FROM par)", "tq") + """,
r AS (SELECT doc_id, CAST(quality AS VARCHAR) AS lbl, row_number() OVER (PARTITION BY quality
        ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) AS rn FROM labels)
SELECT CASE WHEN rn <= tq.q THEN 'test' ELSE 'train' END AS split, r.lbl AS quality, count(*) AS n_rows
FROM r JOIN tq ON r.lbl = tq.lbl GROUP BY ALL""")
def t19(spark, sf_dir):
    lab = table(spark, sf_dir, "labels").withColumn(ROW_INDEX, F.col("doc_id"))
    counts = S.stratify_guard(lab, "quality")
    stratify = len(counts) > 1  # classification task with more than one class
    sp = (S.stratified_holdout(lab, "quality", test_size=0.25, val_size=0.0, seed=42) if stratify
          else S.random_holdout(lab.select(ROW_INDEX), test_size=0.25, val_size=0.0, seed=42))
    j = sp.join(lab.select(ROW_INDEX, F.col("quality").cast("string").alias("quality")), on=ROW_INDEX)
    return j.groupBy("split", "quality").agg(F.count(F.lit(1)).alias("n_rows"))
