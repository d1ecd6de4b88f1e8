"""Flagship: curate -> majority dedupe -> class label -> group split -> summary.

lineitem stands in for raw activity rows: key ``l_partkey`` (the molecule),
label ``l_returnflag``, measured value ``l_extendedprice``, row order the
natural lineitem key; the group key (scaffold) is the part's ``p_brand``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.curate import label_classes, require_non_null, row_filters
from tessera.operators.dedupe import majority
from tessera.operators.split import group_holdout
from tessera.plans import register
from tessera.sources.tables import LINEITEM_KEY_SQL, ROW_INDEX, lineitem_rows, table

ACTIVE, INACTIVE = 20000.0, 60000.0


def curated_parts(spark, sf_dir):
    li = lineitem_rows(spark, sf_dir).select(ROW_INDEX, "l_partkey", "l_returnflag", "l_extendedprice",
                                             "l_linestatus")
    cur = require_non_null(li, ["l_partkey", "l_extendedprice"])
    cur = row_filters(cur, {"l_linestatus": ["O", "F"]})
    ded = majority(cur.drop("l_linestatus"), key="l_partkey", label="l_returnflag")
    return label_classes(ded, "l_extendedprice", ACTIVE, INACTIVE)


CURATED_SQL = """
li AS (
  SELECT """ + LINEITEM_KEY_SQL + """ AS rid, l_partkey, l_returnflag, l_extendedprice
  FROM lineitem
  WHERE l_partkey IS NOT NULL AND l_extendedprice IS NOT NULL AND NOT isnan(l_extendedprice)
    AND l_linestatus IN ('O', 'F')),
bl AS (SELECT l_partkey AS k, l_returnflag AS l, count(*) AS n, min(rid) AS first_rid FROM li GROUP BY 1, 2),
pk AS (SELECT k, count(l) AS nl, max(CASE WHEN l IS NOT NULL THEN n END) AS top, min(first_rid) AS first_any
       FROM bl GROUP BY k),
win AS (SELECT bl.k, count(*) AS ntop, min(bl.first_rid) AS win_rid FROM bl JOIN pk ON bl.k = pk.k
        WHERE pk.nl > 1 AND bl.l IS NOT NULL AND bl.n = pk.top GROUP BY bl.k),
pick AS (SELECT CASE WHEN pk.nl <= 1 THEN pk.first_any WHEN win.ntop = 1 THEN win.win_rid END AS rid
         FROM pk LEFT JOIN win ON pk.k = win.k),
ded AS (SELECT li.* FROM li JOIN pick ON li.rid = pick.rid),
lab AS (SELECT ded.*, CASE WHEN l_extendedprice <= 20000.0 THEN 'active'
                         WHEN l_extendedprice > 60000.0 THEN 'inactive' ELSE 'intermediate' END AS cls
        FROM ded)
"""


def greedy_group_split_sql(src: str, gexpr: str, test: float, val: float, seed: int) -> str:
    """DuckDB CTEs assigning ``split`` to rows of ``src`` by the T7 greedy
    (recursive over distinct group sizes).  Produces CTE ``assigned``."""
    return f"""
gk AS (SELECT *, coalesce(CAST({gexpr} AS VARCHAR), '') AS g FROM {src}),
sizes AS (SELECT g, count(*) AS s FROM gk GROUP BY g),
hist AS (SELECT s, count(*) AS c, row_number() OVER (ORDER BY s DESC) AS i FROM sizes GROUP BY s),
tot AS (SELECT CAST(sum(s*c) AS BIGINT) AS n FROM hist),
par AS (SELECT greatest(CAST(round_even({test}::DOUBLE * n::DOUBLE, 0) AS BIGINT), 1) AS nt,
               greatest(CAST(round_even({val}::DOUBLE * n::DOUBLE, 0) AS BIGINT), 1) AS nv FROM tot),
rec AS (
  SELECT h.i, h.s, least(h.c, p.nt // h.s) AS kt,
         least(h.c - least(h.c, p.nt // h.s), p.nv // h.s) AS kv,
         least(h.c, p.nt // h.s) * h.s AS ut,
         least(h.c - least(h.c, p.nt // h.s), p.nv // h.s) * h.s AS uv
  FROM hist h, par p WHERE h.i = 1
  UNION ALL
  SELECT h.i, h.s, least(h.c, (p.nt - r.ut) // h.s),
         least(h.c - least(h.c, (p.nt - r.ut) // h.s), (p.nv - r.uv) // h.s),
         r.ut + least(h.c, (p.nt - r.ut) // h.s) * h.s,
         r.uv + least(h.c - least(h.c, (p.nt - r.ut) // h.s), (p.nv - r.uv) // h.s) * h.s
  FROM rec r JOIN hist h ON h.i = r.i + 1, par p
),
granked AS (SELECT g, s, row_number() OVER (PARTITION BY s ORDER BY md5('{seed}:' || g), g) AS rn FROM sizes),
gsplit AS (SELECT g.g, CASE WHEN g.rn <= r.kt THEN 'test' WHEN g.rn <= r.kt + r.kv THEN 'val' ELSE 'train' END
                  AS split FROM granked g JOIN rec r ON g.s = r.s),
assigned AS (SELECT gk.*, gsplit.split FROM gk JOIN gsplit ON gk.g = gsplit.g)
"""


def flagship(spark, sf_dir):
    lab = curated_parts(spark, sf_dir)
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    grouped = lab.join(part, lab["l_partkey"] == part["p_partkey"], "left")
    split = group_holdout(grouped, "p_brand", test_size=0.2, val_size=0.1, seed=42)
    per = split.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("class") == "active").cast("long").alias("n_active"),
        F.count_if(F.col("class") == "intermediate").cast("long").alias("n_intermediate"),
        F.count_if(F.col("class") == "inactive").cast("long").alias("n_inactive"),
        F.count_distinct("p_brand").alias("n_groups"),
        F.round(F.avg("l_extendedprice"), 6).alias("mean_value"),
    )
    return per


FLAGSHIP_SQL = (
    "WITH RECURSIVE " + CURATED_SQL + ",\n"
    "lg AS (SELECT lab.*, p.p_brand FROM lab LEFT JOIN part p ON lab.l_partkey = p.p_partkey),"
    + greedy_group_split_sql("lg", "p_brand", 0.2, 0.1, 42)
    + """
SELECT split, count(*) AS n_rows,
       count(*) FILTER (WHERE cls = 'active') AS n_active,
       count(*) FILTER (WHERE cls = 'intermediate') AS n_intermediate,
       count(*) FILTER (WHERE cls = 'inactive') AS n_inactive,
       count(DISTINCT p_brand) AS n_groups,
       round(avg(l_extendedprice), 6) AS mean_value
FROM assigned GROUP BY split
"""
)

register("flagship_curate_split_summary", FLAGSHIP_SQL)(flagship)
