"""Featurisation / similarity queries (V1-V16) over documents, benchmark,
pages and embeddings (whole texts)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import features as V
from tessera.operators.ranks import rank_within_key
from tessera.operators.similarity import overlap_counts, similarity_join
from tessera.operators.split import group_holdout
from tessera.plans import register
from tessera.plans.flagship import greedy_group_split_sql
from tessera.sources.tables import spread, table

TOKS_SQL = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')"


def _bits_sql(src: str, id_col: str, n_bits: int = 2048, radius: int = 2) -> str:
    lens = ", ".join(str(i) for i in range(1, radius + 2))
    return f"""
tk AS (SELECT {id_col} AS id, {TOKS_SQL} AS toks FROM {src}),
fb AS (SELECT id, list_sort(list_distinct(flatten([[
          CAST((('0x' || substr(md5(array_to_string(toks[i:i+L-1], ' ')), 1, 8))::BIGINT % {n_bits}) AS INTEGER)
          for i in range(1, len(toks) - L + 2)] for L in [{lens}]]))) AS bits FROM tk)"""


# ------------------------------------------------------------ V1-V3 (Python)

FEATURE_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()),
                               T.StructField("n_lines", T.LongType())])


def _describe(row: dict) -> dict:
    """Example user featuriser: fails (raises) on texts whose length is a
    multiple of 13, standing in for an unparsable record."""
    text = row["text"]
    if len(text) % 13 == 0:
        raise ValueError("unparsable record")
    return {"n_chars": len(text), "n_lines": text.count("\n") + 1}


def _describe_batch(pdf: pd.DataFrame) -> pd.DataFrame:
    if (pdf["text"].str.len() % 101 == 0).any():
        raise ValueError("batch failed")
    return pd.DataFrame({"n_chars": pdf["text"].str.len(), "n_lines": pdf["text"].str.count("\n") + 1})


@register("v1_row_featuriser_null_on_failure", r"""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE length(text) % 13 = 0) AS n_failed,
       CAST(sum(length(text)) FILTER (WHERE length(text) % 13 <> 0) AS BIGINT) AS sum_chars FROM documents""")
def v1(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    f = V.map_features(d, _describe, FEATURE_SCHEMA, keep=["doc_id"], on_error="null", per_row=True)
    return f.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("n_chars").isNull()).alias("n_failed"),
                 F.sum("n_chars").cast("long").alias("sum_chars"))


@register("v2_row_featuriser_drop_on_failure", r"""
SELECT count(*) AS n_rows, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS sum_lines
FROM documents WHERE length(text) % 13 <> 0""")
def v2(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    f = V.map_features(d, _describe, FEATURE_SCHEMA, keep=["doc_id"], on_error="drop", per_row=True)
    return f.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n_lines").cast("long").alias("sum_lines"))


@register("v3_batch_featuriser_null_block")
def v3(spark, sf_dir):
    """Batch composition depends on partitioning: rows-only check."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return V.map_feature_batches(d, _describe_batch, FEATURE_SCHEMA, keep=["doc_id"])


# ------------------------------------------------------------ V4-V9 (native)


def doc_bits(spark, sf_dir, name="documents", id_col="doc_id", n_bits=2048):
    return V.hashed_bits(spread(table(spark, sf_dir, name).select(id_col, "text")), id_col, "text", radius=2, n_bits=n_bits)


@register("v4_hashed_text_fingerprint", "WITH " + _bits_sql("documents", "doc_id") + """
SELECT id AS doc_id, len(bits) AS n_on_bits, CAST(coalesce(list_sum(bits), 0) AS BIGINT) AS bit_sum FROM fb""")
def v4(spark, sf_dir):
    b = doc_bits(spark, sf_dir)
    return b.select("doc_id", F.size("bits").cast("long").alias("n_on_bits"),
                    F.aggregate("bits", F.lit(0).cast("long"), lambda a, x: a + x).alias("bit_sum"))


@register("v5_fingerprint_expansion", "WITH " + _bits_sql("benchmark", "item_id", n_bits=16) + ",\n"
          + "x AS (SELECT " + ", ".join(f"CAST(list_contains(bits, {i}) AS INTEGER) AS fp_{i}" for i in range(16))
          + " FROM fb)\nSELECT " + ", ".join(f"CAST(sum(fp_{i}) AS BIGINT) AS fp_{i}" for i in range(16)) + " FROM x")
def v5(spark, sf_dir):
    b = doc_bits(spark, sf_dir, "benchmark", "item_id", n_bits=16)
    wide = V.expand_bits(b, "bits", 16)
    return wide.agg(*[F.sum(f"fp_{i}").cast("long").alias(f"fp_{i}") for i in range(16)])


@register("v5_fingerprint_expansion_documents", "WITH " + _bits_sql("documents", "doc_id") + """
, on_bits AS (SELECT unnest(bits) AS bit, count(*) AS n FROM fb GROUP BY 1)
SELECT r.bit, coalesce(n, 0) AS n FROM (SELECT CAST(unnest(range(2048)) AS INTEGER) AS bit) r LEFT JOIN on_bits USING (bit)""")
def v5_documents(spark, sf_dir):
    """All 2,048 columns over all documents, summed up per column."""
    wide = V.expand_bits(doc_bits(spark, sf_dir), "bits", 2048)
    columns = F.array(*[F.coalesce(f"fp_{i}", F.lit(0)) for i in range(2048)]).alias("wide")
    return wide.select(F.posexplode(columns).alias("bit", "on")).groupBy("bit").agg(F.sum("on").cast("long").alias("n"))


@register("v6_descriptor_profile", r"""
SELECT lang, count(*) AS n, round(avg(length(text)), 6) AS n_chars,
       round(avg(len(""" + TOKS_SQL + r""")), 6) AS n_tokens,
       round(avg(len(regexp_extract_all(text, '\p{Lu}'))), 6) AS n_upper,
       round(avg(len(regexp_extract_all(text, '\p{N}'))), 6) AS n_digits,
       round(avg(len(regexp_extract_all(text, '\n'))), 6) AS n_lines
FROM documents GROUP BY lang""")
def v6(spark, sf_dir):
    d = spread(table(spark, sf_dir, "documents").select("lang", "text"))
    cols = V.text_descriptors(F.col("text"))
    prof = d.select("lang", *cols)
    return prof.groupBy("lang").agg(F.count(F.lit(1)).alias("n"),
                                    *[F.round(F.avg(c), 6).alias(c) for c in
                                      ["n_chars", "n_tokens", "n_upper", "n_digits", "n_lines"]])


@register("v7_canonical_key", r"""
WITH f AS (SELECT doc_id, unnest(fr) AS frag, generate_subscripts(fr, 1) AS pos FROM (
   SELECT doc_id, list_filter(list_transform(string_split_regex(regexp_replace(lower(trim(text)), '\s+', ' ', 'g'), '\.'),
                                             lambda x: trim(x)), lambda x: x <> '') AS fr FROM documents))
SELECT doc_id, length(k) AS key_length, md5(k) AS key_md5 FROM (
  SELECT doc_id, arg_max(frag, {'a': length(frag), 'b': -pos}) AS k FROM f GROUP BY doc_id)""")
def v7(spark, sf_dir):
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    k = V.canonical_key(F.col("text"))
    return d.select("doc_id", k.alias("k")).filter(F.col("k").isNotNull()).select(
        "doc_id", F.length("k").cast("long").alias("key_length"), F.md5("k").alias("key_md5"))


FIRST_TOKEN_SQL = "(" + TOKS_SQL + ")[1]"


@register("v8_group_key_split", "WITH RECURSIVE src AS (SELECT doc_id, " + FIRST_TOKEN_SQL + " AS grp FROM documents),"
          + greedy_group_split_sql("src", "grp", 0.2, 0.1, 42) + """
SELECT split, count(*) AS n_rows, count(DISTINCT g) AS n_groups FROM assigned GROUP BY 1""")
def v8(spark, sf_dir):
    """Any key expression is a group key for the group split (T7): here the
    first token of the text."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.element_at(V.tokens(F.col("text")), 1).alias("grp"))
    sp = group_holdout(d, "grp", test_size=0.2, val_size=0.1, seed=42)
    return sp.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                   F.count_distinct(F.coalesce(F.col("grp"), F.lit(""))).alias("n_groups"))


@register("v9_key_to_ids_multimap", """
SELECT lang || '/' || source AS key, doc_id, row_number() OVER (PARTITION BY lang || '/' || source ORDER BY doc_id) AS occurrence
FROM documents""")
def v9(spark, sf_dir):
    """Key -> ids in order, as a long (key, id, occurrence) table: a hot key
    never becomes one array."""
    d = table(spark, sf_dir, "documents").select(F.concat_ws("/", "lang", "source").alias("key"), "doc_id")
    return rank_within_key(d, "key", "doc_id", out="occurrence")


# ------------------------------------------------------------ V10-V12

SIM_SQL = (_bits_sql("benchmark", "item_id").replace("tk AS", "tkq AS").replace("fb AS", "fq AS")
           .replace("FROM tk)", "FROM tkq)") + ","
           + _bits_sql("documents", "doc_id") + """,
qb AS (SELECT id AS item_id, len(bits) AS a, unnest(bits) AS bit FROM fq),
cbits AS (SELECT id AS doc_id, len(bits) AS b, unnest(bits) AS bit FROM fb),
pairs AS (SELECT item_id, doc_id, count(*) AS c, first(a) AS a, first(b) AS b FROM qb JOIN cbits USING (bit) GROUP BY 1, 2),
sims AS (SELECT *, c / (a + b - c) AS tanimoto, 2.0 * c / (a + b) AS dice, c / sqrt(a * b) AS cosine,
               c / (2 * a + 2 * b - 3 * c) AS sokal, c / 2048.0 AS russel, (c / a + c / b) / 2 AS kulczynski,
               (c * c - (a - c) * (b - c)) / (a * b) AS mcconnaughey,
               c / (0.5 * (a - c) + 0.5 * (b - c) + c) AS tversky FROM pairs)""")


def similarity_pairs(spark, sf_dir, top_k=None):
    q = doc_bits(spark, sf_dir, "benchmark", "item_id")
    c = doc_bits(spark, sf_dir)
    pairs = overlap_counts(q, c, "item_id", "doc_id", top_k=top_k)
    metrics = ["tanimoto", "dice", "cosine", "sokal", "russel", "kulczynski", "mcconnaughey", "tversky"]
    return pairs.select("*", *[V.set_similarity(F.col("c"), F.col("a"), F.col("b"), F.lit(2048), m).alias(m)
                               for m in metrics])


@register("v10_v11_set_similarities", "WITH " + SIM_SQL + """
SELECT item_id, count(*) AS n_pairs, round(max(tanimoto), 6) AS max_tanimoto, round(max(dice), 6) AS max_dice,
       round(max(cosine), 6) AS max_cosine, round(max(sokal), 6) AS max_sokal, round(max(russel), 6) AS max_russel,
       round(max(kulczynski), 6) AS max_kulczynski, round(max(mcconnaughey), 6) AS max_mcconnaughey,
       round(max(tversky), 6) AS max_tversky FROM sims GROUP BY 1""")
def v10(spark, sf_dir):
    s = similarity_pairs(spark, sf_dir)
    ms = ["tanimoto", "dice", "cosine", "sokal", "russel", "kulczynski", "mcconnaughey", "tversky"]
    return s.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_pairs"),
                                    *[F.round(F.max(m), 6).alias(f"max_{m}") for m in ms])


@register("v12_similarity_neighbours_top5", "WITH " + SIM_SQL + """
SELECT item_id, doc_id, rank, round(tanimoto, 6) AS tanimoto FROM (
  SELECT item_id, doc_id, tanimoto, row_number() OVER (PARTITION BY item_id ORDER BY tanimoto DESC, doc_id) AS rank
  FROM sims) WHERE rank <= 5""")
def v12(spark, sf_dir):
    s = similarity_pairs(spark, sf_dir, top_k=5)
    top = V.top_k_neighbours(s, "item_id", "doc_id", "tanimoto", k=5)
    return top.select("item_id", "doc_id", F.col("rank").cast("long").alias("rank"),
                      F.round("tanimoto", 6).alias("tanimoto"))


SELF_THRESHOLD = 0.9
SELF_SQL = "WITH " + _bits_sql("documents", "doc_id") + f""",
sets AS (SELECT bits, min(id) AS id, len(bits) AS n FROM fb WHERE len(bits) > 0 GROUP BY bits),
strings AS (SELECT any_value(id) AS id, any_value(n) AS n, bitstring_agg(bit, 0, 2047) AS s FROM (SELECT id, n, unnest(bits) AS bit FROM sets) GROUP BY id),
found AS (SELECT x.id AS a_id, y.id AS b_id, x.n AS a, y.n AS b, CAST(bit_count(x.s & y.s) AS BIGINT) AS c FROM strings x JOIN strings y
          ON x.id < y.id AND least(x.n, y.n) >= {SELF_THRESHOLD} * greatest(x.n, y.n))"""


@register("v10_similarity_join_documents", SELF_SQL + f"""
SELECT a_id, b_id, a, b, c, round(c / (a + b - c), 6) AS similarity FROM found WHERE c / (a + b - c) >= {SELF_THRESHOLD}""")
def v10_self(spark, sf_dir):
    """All documents against all: pairs of different fingerprints that are
    similar, by the smallest doc_id that has each."""
    pairs, _, _ = similarity_join(doc_bits(spark, sf_dir), "doc_id", threshold=SELF_THRESHOLD)
    return pairs.withColumn("similarity", F.round("similarity", 6))


# ------------------------------------------------------------ V13-V14

# The pattern catalogue used by the catalogue-flag query.
PATTERNS = [
    ("PII", "email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
    ("PII", "phone", r"\+?[0-9][0-9 ()-]{8,}[0-9]"),
    ("PII", "id_number", r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
    ("SECRETS", "api_key", r"(?i)api[_-]?key"),
    ("SECRETS", "password", r"(?i)password"),
    ("SECRETS", "token", r"(?i)(secret|token)[=:]"),
    ("LICENSE", "license", r"(?i)licen[cs]e"),
    ("LICENSE", "copyright", r"(?i)copyright"),
    ("WEB", "url", r"https?://"),
    ("WEB", "markup", r"<[a-z]+[ >]"),
]


@register("v13_pattern_filter", r"""
SELECT lang, count(*) AS n_matching FROM documents
WHERE regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}') GROUP BY 1""")
def v13(spark, sf_dir):
    d = table(spark, sf_dir, "documents").filter(F.col("text").rlike(PATTERNS[0][2]))
    return d.groupBy("lang").agg(F.count(F.lit(1)).alias("n_matching"))


@register("v14_pattern_catalogue_flags", "WITH pats AS (SELECT * FROM (VALUES "
          + ", ".join("('{}', '{}', '{}')".format(c, n, p.replace("'", "''")) for c, n, p in PATTERNS)
          + """) t(catalog, name, pattern)),
hits AS (SELECT d.doc_id, p.catalog FROM documents d JOIN pats p ON regexp_matches(d.text, p.pattern))
SELECT doc_id, array_to_string(list_sort(list_distinct(list(catalog))), ',') AS catalogs, count(*) AS n_matches
FROM hits GROUP BY doc_id""")
def v14(spark, sf_dir):
    pats = spark.createDataFrame(PATTERNS, "catalog string, name string, pattern string")
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    flags = V.catalogue_flags(d, "doc_id", "text", pats)
    return flags.select("doc_id", F.array_join("catalogs", ",").alias("catalogs"), "n_matches")


# ------------------------------------------------------------ V15-V16 (pyspark.ml)


@register("v15_pca_projection")
def v15(spark, sf_dir):
    """Two-component PCA of the (centred) embedding matrix; signs are
    arbitrary, so rows-only."""
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", array_to_vector("embedding").alias("v"))
    centred = StandardScaler(inputCol="v", outputCol="c", withMean=True, withStd=False).fit(e).transform(e)
    pca = PCA(k=2, inputCol="c", outputCol="pc").fit(centred)
    out = pca.transform(centred).select("vec_id", "label", vector_to_array("pc").alias("pc"))
    return out.select("vec_id", "label", F.col("pc")[0].alias("component_1"), F.col("pc")[1].alias("component_2"))


@register("v16_kmeans_clusters")
def v16(spark, sf_dir):
    """k = clamp(n // 180, 4, 8); labels 1..k; rows-only."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    e = table(spark, sf_dir, "embeddings").select("vec_id", array_to_vector("embedding").alias("features"))
    k = V.kmeans_k(e.count())
    model = KMeans(k=k, seed=42, featuresCol="features").fit(e)
    return model.transform(e).select("vec_id", (F.col("prediction") + 1).alias("cluster_label"))
