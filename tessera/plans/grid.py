"""Experiment-grid queries.

Axes come from data: ``train.model.type`` = distinct order priorities,
``split.mode`` = order statuses mapped F/O/P -> cv/holdout/nested_holdout_cv,
``featurize.region`` = region names, ``preprocess.scaler_choice`` = market
segments (rendered as scaler robust/standard/minmax/none/none, so two segments
render the same scientific config and the later parent is dropped).
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import grid as G
from tessera.operators import grid_rules as R
from tessera.operators.runs import factor_counts
from tessera.plans import register
from tessera.sources.tables import table

DEFAULTS = {
    "global.base_dir": "/data",
    "global.run_dir": "/runs/study",
    "split.cv.n_splits": "5",
    "split.cv.repeats": "2",
    "split.inner.n_splits": "3",
    "split.inner.repeats": "1",
    "split.stage": "inner",
    "split.strategy": "random",
}
AXES = ["featurize.region", "preprocess.scaler_choice", "split.mode", "train.model.type"]
SCALER_OF = {"AUTOMOBILE": "robust", "BUILDING": "standard", "FURNITURE": "minmax", "HOUSEHOLD": "none",
             "MACHINERY": "none"}
PROFILE = "reg_local_csv"


def _scaler(c):
    expr = None
    for k, v in SCALER_OF.items():
        expr = F.when(c == k, v) if expr is None else expr.when(c == k, v)
    return expr.otherwise(F.lower(c))


def grid_combos(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    axes = {
        "train.model.type": o.select("o_orderpriority"),
        "split.mode": o.select(F.when(F.col("o_orderstatus") == "F", "cv").when(F.col("o_orderstatus") == "O", "holdout")
                               .otherwise("nested_holdout_cv").alias("m")),
        "featurize.region": table(spark, sf_dir, "region").select("r_name"),
        "preprocess.scaler_choice": table(spark, sf_dir, "customer").select("c_mktsegment"),
    }
    row = G.axes_row(axes)
    G.size_guard(row, AXES)
    return G.expand(row, AXES)


def grid_parents(spark, sf_dir):
    c = grid_combos(spark, sf_dir)
    factors = F.create_map(*[x for n in AXES for x in (F.lit(n), F.col(f"`{n}`"))])
    rendered = F.create_map(F.lit("featurize.region"), F.col("`featurize.region`"),
                            F.lit("preprocess.scaler"), _scaler(F.col("`preprocess.scaler_choice`")),
                            F.lit("split.mode"), F.col("`split.mode`"),
                            F.lit("train.model.type"), F.col("`train.model.type`"))
    c = c.withColumn("factors", factors).withColumn("config", G.overlay(DEFAULTS, rendered))
    c = c.withColumn("scientific_config_id", G.scientific_id(F.col("config")))
    # Parent dedupe: the first combination (product order) per scientific id.
    first = F.min("combo_index").over(Window.partitionBy("scientific_config_id"))
    kept = c.withColumn("__first", first).filter(F.col("combo_index") == F.col("__first")).drop("__first")
    return G.numbered(kept, "combo_index", "parent_%04d", "parent_case_id")


def grid_cases(spark, sf_dir):
    p = grid_parents(spark, sf_dir)
    # cases are numbered in parent order: a parent's first number is the slices of those before it
    w = Window.orderBy("combo_index").rowsBetween(Window.unboundedPreceding, -1)
    p = p.withColumn("__off", F.coalesce(F.sum(G.execution_count(F.col("config"))).over(w), F.lit(0)))
    s = G.execution_slices(p, "config")
    s = s.withColumn("case_index", F.col("__off") + F.col("slice_index") + 1).drop("__off")
    s = s.withColumn("case_id", F.format_string("case_%04d", F.col("case_index")))
    m = F.col("config")
    name = F.concat_ws("__", F.col("case_id"), G.sanitize(F.lit(PROFILE)),
                       G.sanitize(G.get_dotted(m, "train.model.type", "model")),
                       G.sanitize(G.get_dotted(m, "split.mode", "nosplit")),
                       G.sanitize(G.get_dotted(m, "split.strategy", "na")),
                       F.array_join(F.transform("execution_tokens", lambda t: G.sanitize(t)), "__"))
    s = s.withColumn("case_name", F.regexp_replace(name, "__$", ""))
    s = s.withColumn("config_fingerprint", G.config_fingerprint(m))
    rules = [
        ("DOE_MODEL_UNSUPPORTED", "train.model.type", "model type not available for this profile",
         G.get_dotted(m, "train.model.type") == "5-LOW"),
        ("DOE_NESTED_REGION", "featurize.region", "nested CV is not allowed for this region",
         (G.get_dotted(m, "split.mode") == "nested_holdout_cv") & (G.get_dotted(m, "featurize.region") == "MIDDLE EAST")),
        ("DOE_SCALER_FOLD", "preprocess.scaler", "minmax scaling is not allowed on the last fold",
         (G.get_dotted(m, "preprocess.scaler") == "minmax") & (G.get_dotted(m, "split.cv.fold_index") == "4")),
    ]
    s = s.withColumn("issues", G.rule_issues(rules))
    # D7 on the runtime config: a later case rendering an already seen config is skipped.
    s = s.withColumn("__ff", F.min("case_index").over(Window.partitionBy("config_fingerprint")))
    dup = F.col("case_index") != F.col("__ff")
    dup_issue = F.array(F.struct(F.lit("DOE_DUPLICATE_CONFIG").alias("code"), F.lit("search_space").alias("path"),
                                 F.lit("Different factor combinations rendered the same runtime config.").alias("message")))
    s = s.withColumn("issues", F.when(dup, dup_issue).otherwise(F.col("issues"))).drop("__ff")
    return s.withColumn("status", F.when(F.size("issues") > 0, "skipped").otherwise("valid"))


GRID_SQL = r"""
ax AS (
  SELECT 'featurize.region' AS axis, r_name AS v FROM region
  UNION SELECT 'preprocess.scaler_choice', c_mktsegment FROM customer
  UNION SELECT 'split.mode', CASE o_orderstatus WHEN 'F' THEN 'cv' WHEN 'O' THEN 'holdout' ELSE 'nested_holdout_cv' END FROM orders
  UNION SELECT 'train.model.type', o_orderpriority FROM orders),
axp AS (SELECT axis, v, row_number() OVER (PARTITION BY axis ORDER BY v) - 1 AS p, count(*) OVER (PARTITION BY axis) AS n FROM ax),
combos AS (
  SELECT a.v AS region, b.v AS seg, c.v AS mode, d.v AS model,
         ((a.p * b.n + b.p) * c.n + c.p) * d.n + d.p AS combo_index
  FROM (SELECT * FROM axp WHERE axis = 'featurize.region') a, (SELECT * FROM axp WHERE axis = 'preprocess.scaler_choice') b,
       (SELECT * FROM axp WHERE axis = 'split.mode') c, (SELECT * FROM axp WHERE axis = 'train.model.type') d),
cfg AS (
  SELECT *, CASE seg WHEN 'AUTOMOBILE' THEN 'robust' WHEN 'BUILDING' THEN 'standard' WHEN 'FURNITURE' THEN 'minmax'
                     WHEN 'HOUSEHOLD' THEN 'none' WHEN 'MACHINERY' THEN 'none' ELSE lower(seg) END AS scaler FROM combos),
cfg2 AS (
  SELECT *, ['featurize.region=' || region, 'preprocess.scaler=' || scaler, 'split.cv.n_splits=5', 'split.cv.repeats=2',
             'split.inner.n_splits=3', 'split.inner.repeats=1', 'split.mode=' || mode, 'split.stage=inner',
             'split.strategy=random', 'train.model.type=' || model] AS entries FROM cfg),
sci AS (SELECT *, sha256(array_to_string(list_sort(entries), ',')) AS scientific_config_id FROM cfg2),
par AS (
  SELECT *, printf('parent_%04d', row_number() OVER (ORDER BY combo_index)) AS parent_case_id,
         CASE mode WHEN 'cv' THEN 10 WHEN 'nested_holdout_cv' THEN 3 ELSE 1 END AS execution_count,
         CASE mode WHEN 'cv' THEN 5 WHEN 'nested_holdout_cv' THEN 3 ELSE 1 END AS n_f
  FROM sci WHERE combo_index = (SELECT min(combo_index) FROM sci s2 WHERE s2.scientific_config_id = sci.scientific_config_id)),
paro AS (SELECT *, coalesce(sum(execution_count) OVER (ORDER BY combo_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                   AS off FROM par),
sl AS (SELECT *, unnest(range(0, execution_count)) AS slice_index FROM paro),
cases AS (
  SELECT *, off + slice_index + 1 AS case_index, printf('case_%04d', off + slice_index + 1) AS case_id,
         slice_index // n_f AS r, slice_index % n_f AS f,
         CASE mode WHEN 'cv' THEN printf('rep%d_fold%d', slice_index // n_f, slice_index % n_f)
                   WHEN 'nested_holdout_cv' THEN printf('inner_rep%d_fold%d', slice_index // n_f, slice_index % n_f)
                   ELSE mode END AS execution_label,
         CASE mode WHEN 'cv' THEN '__' || printf('rep%d__fold%d', slice_index // n_f, slice_index % n_f)
                   WHEN 'nested_holdout_cv' THEN '__' || printf('inner__rep%d__fold%d', slice_index // n_f, slice_index % n_f)
                   ELSE '' END AS token_suffix
  FROM sl),
named AS (
  SELECT *, case_id || '__reg_local_csv__' ||
            coalesce(nullif(regexp_replace(regexp_replace(model, '[^\p{L}\p{N}_-]', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'x')
            || '__' || mode || '__random' || token_suffix AS case_name,
         sha256(array_to_string(list_sort(entries || CASE mode
             WHEN 'cv' THEN ['split.cv.fold_index=' || CAST(f AS VARCHAR), 'split.cv.repeat_index=' || CAST(r AS VARCHAR)]
             WHEN 'nested_holdout_cv' THEN ['split.inner.fold_index=' || CAST(f AS VARCHAR), 'split.inner.repeat_index=' || CAST(r AS VARCHAR)]
             ELSE []::VARCHAR[] END), ',')) AS config_fingerprint
  FROM cases),
iss AS (
  SELECT *, list_filter([CASE WHEN model = '5-LOW' THEN 'DOE_MODEL_UNSUPPORTED' END,
                         CASE WHEN mode = 'nested_holdout_cv' AND region = 'MIDDLE EAST' THEN 'DOE_NESTED_REGION' END,
                         CASE WHEN scaler = 'minmax' AND mode = 'cv' AND f = 4 THEN 'DOE_SCALER_FOLD' END], lambda x: x IS NOT NULL) AS codes
  FROM named),
fin AS (SELECT *, CASE WHEN len(codes) > 0 THEN 'skipped' ELSE 'valid' END AS status FROM iss)
"""


@register("j12_g11_grid_expansion", "WITH " + GRID_SQL + """
SELECT count(*) AS n_combinations, count(DISTINCT region) AS n_region, count(DISTINCT seg) AS n_scaler_choice,
       count(DISTINCT mode) AS n_mode, count(DISTINCT model) AS n_model, CAST(max(combo_index) AS BIGINT) AS max_combo_index
FROM combos""")
def j12(spark, sf_dir):
    c = grid_combos(spark, sf_dir)
    return c.agg(F.count(F.lit(1)).alias("n_combinations"), F.count_distinct("`featurize.region`").alias("n_region"),
                 F.count_distinct("`preprocess.scaler_choice`").alias("n_scaler_choice"),
                 F.count_distinct("`split.mode`").alias("n_mode"), F.count_distinct("`train.model.type`").alias("n_model"),
                 F.max("combo_index").alias("max_combo_index"))


@register("g1_g2_g6_parents_overlay", "WITH " + GRID_SQL + """
SELECT parent_case_id, scientific_config_id, model AS model_type, scaler, mode AS split_mode, '/runs/study' AS run_dir
FROM par""")
def g1_g2_g6(spark, sf_dir):
    p = grid_parents(spark, sf_dir)
    m = F.col("config")
    return p.select("parent_case_id", "scientific_config_id", G.get_dotted(m, "train.model.type").alias("model_type"),
                    G.get_dotted(m, "preprocess.scaler").alias("scaler"), G.get_dotted(m, "split.mode").alias("split_mode"),
                    G.get_dotted(m, "global.run_dir").alias("run_dir"))


@register("g3_g4_g12_case_table", "WITH " + GRID_SQL + """
SELECT case_id, case_name, parent_case_id, execution_label FROM fin""")
def g3_g4_g12(spark, sf_dir):
    return grid_cases(spark, sf_dir).select("case_id", "case_name", "parent_case_id", "execution_label")


@register("g5_config_fingerprints", "WITH " + GRID_SQL + """
SELECT case_id, config_fingerprint, scientific_config_id FROM fin""")
def g5(spark, sf_dir):
    return grid_cases(spark, sf_dir).select("case_id", "config_fingerprint", "scientific_config_id")


@register("g7_rule_violations", "WITH " + GRID_SQL + """
SELECT case_id, status, array_to_string(codes, ',') AS issue_codes FROM fin""")
def g7(spark, sf_dir):
    c = grid_cases(spark, sf_dir)
    return c.select("case_id", "status", F.array_join(F.transform("issues", lambda i: i["code"]), ",").alias("issue_codes"))


@register("g8_parent_rollup", "WITH " + GRID_SQL + """,
pc AS (SELECT parent_case_id, count(*) AS execution_count, count(*) FILTER (WHERE status = 'valid') AS valid_cases,
              count(*) FILTER (WHERE status = 'skipped') AS skipped_cases,
              list_sort(list_distinct(flatten(list(codes)))) AS codes FROM fin GROUP BY 1)
SELECT parent_case_id, execution_count, valid_cases, skipped_cases,
       CASE WHEN valid_cases = execution_count AND execution_count > 0 THEN 'valid' WHEN valid_cases > 0 THEN 'partial'
            ELSE 'skipped' END AS status, array_to_string(codes, ',') AS issue_codes FROM pc""")
def g8(spark, sf_dir):
    c = grid_cases(spark, sf_dir).withColumn("codes", F.transform("issues", lambda i: i["code"]))
    # issues are folded to distinct codes per parent; a parent has at most
    # execution_count (<= repeats x folds) slices, so the list is bounded.
    pc = c.groupBy("parent_case_id").agg(
        F.count(F.lit(1)).alias("execution_count"), F.count_if(F.col("status") == "valid").alias("valid_cases"),
        F.count_if(F.col("status") == "skipped").alias("skipped_cases"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("codes")))).alias("codes"))
    st = F.when((F.col("valid_cases") == F.col("execution_count")) & (F.col("execution_count") > 0), "valid") \
        .when(F.col("valid_cases") > 0, "partial").otherwise("skipped")
    return pc.select("parent_case_id", "execution_count", "valid_cases", "skipped_cases", st.alias("status"),
                     F.array_join("codes", ",").alias("issue_codes"))


@register("g9_issue_histogram", "WITH " + GRID_SQL + """
SELECT code, count(*) AS n FROM (SELECT unnest(codes) AS code FROM fin) GROUP BY 1""")
def g9(spark, sf_dir):
    c = grid_cases(spark, sf_dir)
    return c.select(F.explode("issues").alias("i")).groupBy(F.col("i.code").alias("code")).agg(F.count(F.lit(1)).alias("n"))


@register("g10_grid_summary", "WITH " + GRID_SQL + """,
pc AS (SELECT parent_case_id, count(*) AS ec, count(*) FILTER (WHERE status = 'valid') AS vc FROM fin GROUP BY 1)
SELECT (SELECT count(*) FROM fin) AS total_cases, (SELECT count(*) FILTER (WHERE status = 'valid') FROM fin) AS valid_cases,
       (SELECT count(*) FILTER (WHERE status = 'skipped') FROM fin) AS skipped_cases,
       count(*) AS total_parent_cases, count(*) FILTER (WHERE vc = ec) AS valid_parent_cases,
       count(*) FILTER (WHERE vc > 0 AND vc < ec) AS partial_parent_cases,
       count(*) FILTER (WHERE vc = 0) AS skipped_parent_cases FROM pc""")
def g10(spark, sf_dir):
    c = grid_cases(spark, sf_dir)
    pc = c.groupBy("parent_case_id").agg(F.count(F.lit(1)).alias("ec"), F.count_if(F.col("status") == "valid").alias("vc"))
    a = c.agg(F.count(F.lit(1)).alias("total_cases"), F.count_if(F.col("status") == "valid").alias("valid_cases"),
              F.count_if(F.col("status") == "skipped").alias("skipped_cases"))
    b = pc.agg(F.count(F.lit(1)).alias("total_parent_cases"),
               F.count_if(F.col("vc") == F.col("ec")).alias("valid_parent_cases"),
               F.count_if((F.col("vc") > 0) & (F.col("vc") < F.col("ec"))).alias("partial_parent_cases"),
               F.count_if(F.col("vc") == 0).alias("skipped_parent_cases"))
    # both sides are one-row aggregates
    return a.join(b, how="inner")


@register("g1_flatten_nested_config", """
SELECT event_type AS model_type, CASE WHEN user_id % 2 = 0 THEN 'holdout' ELSE 'cv' END AS split_mode,
       count(*) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k
FROM events GROUP BY ALL""")
def g1_flatten(spark, sf_dir):
    """Nested config documents (struct) -> dotted-key maps -> read back by
    dotted path."""
    e = table(spark, sf_dir, "events")
    cfg = e.select(F.struct(
        F.struct(F.struct(F.col("event_type").alias("type")).alias("model")).alias("train"),
        F.struct(F.when(F.col("user_id") % 2 == 0, "holdout").otherwise("cv").alias("mode")).alias("split"),
        F.from_json("props", "k long").alias("extra")).alias("cfg"))
    m = cfg.select(G.dotted_map(cfg, "cfg").alias("m"))
    return m.groupBy(G.get_dotted(F.col("m"), "train.model.type").alias("model_type"),
                     G.get_dotted(F.col("m"), "split.mode").alias("split_mode")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(G.get_dotted(F.col("m"), "extra.k").cast("long")).cast("long").alias("sum_k"))


# One run config per order: a table of any size against the whole rule catalogue.
RULE_NODES = {
    0: "get_data,curate,featurize.none,split,preprocess.features,select.features,train,explain",
    1: "get_data,curate,split,train",
    2: "get_data,curate,featurize.rdkit,split,select.features,train",
    3: "curate,featurize.morgan,split,preprocess.features,train,train.tdc",
    4: "get_data,curate,split,explain",
    5: "curate,featurize.none,train",
    6: "curate,label.normalize,featurize.none,split,train",
}
RULE_MODELS = {"1-URGENT": "random_forest", "2-HIGH": "chemprop", "3-MEDIUM": "dl_simple",
               "4-NOT SPECIFIED": "catboost_classifier", "5-LOW": ""}
RULE_PROBE = R.Probe(columns=("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"), key=None, binary_target=False)


def order_configs(spark, sf_dir):
    """``config`` of every order: nodes by its key, model by its priority, split
    by its status and sizes by its price (cents of the price move them)."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")

    def pick(of, values):
        out = F.lit(None).cast("string")
        for key, value in values.items():
            out = F.when(of == key, value).otherwise(out)
        return out

    tenths = F.format_string("0.%d", (F.floor("o_totalprice") % 10).cast("int"))
    config = {
        "pipeline.nodes": pick(k % 7, RULE_NODES),
        "pipeline.feature_input": F.when(k % 3 == 0, "smiles_native").otherwise("none"),
        "preprocess.scaler": F.when(c % 2 == 0, "none").otherwise("robust"),
        "train.model.type": pick(F.col("o_orderpriority"), RULE_MODELS),
        "train_tdc.model.type": F.when(c % 2 == 0, "catboost_classifier").otherwise("other"),
        "train.model.foundation": F.when(c % 11 == 0, "chemeleon").otherwise("none"),
        "get_data.data_source": F.when(c % 5 == 0, "chembl").otherwise("local_csv"),
        "get_data.source.path": F.when(c % 3 == 0, " ").otherwise("/data/x.csv"),
        "global.task_type": F.when(c % 4 == 0, "classification").otherwise("regression"),
        "global.target_column": F.when(k % 4 == 0, "price").otherwise("o_totalprice"),
        "curate.dedupe_strategy": F.when(c % 7 == 0, "best").otherwise("keep_first"),
        "curate.properties": F.when(k % 2 == 0, "o_totalprice, o_custkey").otherwise("o_custkey"),
        "curate.smiles_column": F.when(k % 5 == 0, "o_clerk").when(k % 5 == 1, "").otherwise("o_orderkey"),
        "curate.required_non_null_columns": F.when(c % 6 == 0, "o_custkey,canonical_smiles, o_comment").otherwise("o_custkey"),
        "split.mode": pick(F.col("o_orderstatus"), {"F": "cv", "O": "holdout", "P": "nested_holdout_cv"}),
        "split.strategy": F.when(c % 9 == 0, "tdc_scaffold").otherwise("random"),
        "split.test_size": tenths,
        "split.val_size": F.when(c % 8 == 0, "0.5").otherwise("0"),
        "split.cv.n_splits": (k % 6).cast("string"),
        "split.cv.fold_index": (c % 5).cast("string"),
        "split.stage": F.when(c % 10 == 0, "middle").otherwise("outer"),
        "label.source_column": F.when(k % 2 == 0, "o_orderstatus").otherwise("status"),
        "label.positive": F.lit("F"),
        "label.negative": F.when(c % 3 == 0, "").otherwise("O,P"),
    }
    pairs = F.create_map(*[x for key, value in config.items() for x in (F.lit(key), value.cast("string"))])
    return table(spark, sf_dir, "orders").select("o_orderkey", pairs.alias("config"))


RULES_SQL = """
WITH a AS (
  SELECT o_orderkey, o_orderkey % 7 AS n, o_orderkey AS k, o_custkey AS c,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'rf' WHEN '2-HIGH' THEN 'text' WHEN '3-MEDIUM' THEN 'deep'
                         WHEN '4-NOT SPECIFIED' THEN 'cat' ELSE '' END AS configured,
    o_orderkey % 3 = 0 AS raw, CASE o_orderstatus WHEN 'F' THEN 'cv' WHEN 'O' THEN 'holdout' ELSE 'nested' END AS mode,
    floor(o_totalprice) % 10 AS tenths, CASE WHEN o_custkey % 8 = 0 THEN 5 ELSE 0 END AS val FROM orders),
b AS (
  SELECT *, n <> 4 AS trains, n IN (0, 2, 3, 5, 6) AS features, n IN (0, 2, 3) AS prepares, n <> 5 AS splits, n IN (0, 1, 2, 4) AS gets,
    CASE WHEN n = 4 THEN '' ELSE configured END AS model,
    n IN (1, 4) AND raw AS text_input, c % 4 = 0 AS clf, k % 5 = 1 AS no_key, c % 5 = 0 AS chembl FROM a),
r AS (
  SELECT o_orderkey, n, unnest([
    CASE WHEN n = 3 THEN 'DOE_TRAIN_NODE_CONFLICT' END,
    CASE WHEN n = 4 THEN 'DOE_EXPLAIN_REQUIRES_TRAIN' END,
    CASE WHEN gets AND chembl THEN 'DOE_SOURCE_NOT_SUPPORTED_FOR_PROFILE' END,
    CASE WHEN gets AND NOT chembl AND c % 3 = 0 THEN 'DOE_DATA_SOURCE_CONFIG_INVALID' END,
    CASE WHEN gets AND chembl THEN 'DOE_DATA_SOURCE_CONFIG_INVALID' END,
    CASE WHEN c % 7 = 0 THEN 'DOE_CURATE_DEDUPE_INVALID' END,
    CASE WHEN model = '' THEN 'DOE_MISSING_MODEL_TYPE' END,
    CASE WHEN model = 'cat' THEN 'DOE_MODEL_NOT_SUPPORTED_FOR_PROFILE' END,
    CASE WHEN model = 'cat' AND NOT clf THEN 'DOE_MODEL_TASK_MISMATCH' END,
    CASE WHEN model IN ('rf', 'deep', 'cat') AND text_input THEN 'DOE_SMILES_NATIVE_MODEL_UNSUPPORTED' END,
    CASE WHEN model IN ('rf', 'deep', 'cat') AND NOT text_input AND NOT features THEN 'DOE_FEATURE_INPUT_REQUIRED' END,
    CASE WHEN model = 'text' AND NOT text_input THEN 'DOE_CHEMPROP_FEATURE_INPUT_UNSUPPORTED' END,
    CASE WHEN model = 'text' AND prepares THEN 'DOE_CHEMPROP_PREPROCESS_UNSUPPORTED' END,
    CASE WHEN model <> '' AND c % 11 = 0 THEN 'DOE_CHEMELEON_CHECKPOINT_REQUIRED' END,
    CASE WHEN model <> '' AND n = 2 THEN 'DOE_SELECT_REQUIRES_PREPROCESS' END,
    CASE WHEN model <> '' AND splits AND c % 9 = 0 THEN 'DOE_SPLIT_STRATEGY_MODE_INVALID' END,
    CASE WHEN model <> '' AND splits AND mode = 'holdout' AND tenths = 0 THEN 'DOE_SPLIT_PARAM_INVALID' END,
    CASE WHEN model <> '' AND splits AND mode = 'holdout' AND tenths + val >= 10 THEN 'DOE_SPLIT_PARAM_INVALID' END,
    CASE WHEN model <> '' AND splits AND mode = 'cv' AND k % 6 < 2 THEN 'DOE_SPLIT_PARAM_INVALID' END,
    CASE WHEN model <> '' AND splits AND mode = 'cv' AND c % 5 >= k % 6 THEN 'DOE_SPLIT_PARAM_INVALID' END,
    CASE WHEN model <> '' AND splits AND mode = 'nested' AND c % 10 = 0 THEN 'DOE_SPLIT_PARAM_INVALID' END,
    CASE WHEN model IN ('text', 'deep') AND splits AND (mode <> 'holdout' OR val = 0) THEN 'DOE_VALIDATION_SPLIT_REQUIRED' END,
    CASE WHEN model <> '' AND NOT clf AND k % 4 = 0 THEN 'DOE_TARGET_COLUMN_MISSING' END,
    CASE WHEN model <> '' AND NOT clf AND k % 2 = 1 AND n NOT IN (0, 5, 6) THEN 'DOE_CURATE_TARGET_DROPPED' END,
    CASE WHEN model <> '' AND k % 5 = 0 THEN 'DOE_DATASET_COLUMN_MISSING' END,
    CASE WHEN model <> '' AND no_key AND NOT chembl THEN 'DOE_SMILES_COLUMN_MISSING' END,
    CASE WHEN model <> '' AND c % 6 = 0 THEN 'DOE_CURATE_REQUIRED_COLUMNS_MISSING' END,
    CASE WHEN model <> '' AND clf AND n = 6 AND k % 2 = 1 THEN 'DOE_DATASET_COLUMN_MISSING' END,
    CASE WHEN model <> '' AND clf AND (n <> 6 OR c % 3 = 0) THEN 'DOE_LABEL_MAPPING_REQUIRED' END,
    CASE WHEN model <> '' AND n = 3 AND c % 2 = 1 THEN 'DOE_TDC_MODEL_UNSUPPORTED' END]) AS code FROM b),
o AS (SELECT o_orderkey, n, array_agg(code ORDER BY code) FILTER (WHERE code IS NOT NULL) AS codes FROM r GROUP BY 1, 2)
SELECT o_orderkey, CASE WHEN codes IS NULL AND n <> 5 THEN 'valid' ELSE 'skipped' END AS status,
       coalesce(array_to_string(codes, ','), CASE WHEN n = 5 THEN 'DOE_RUNTIME_SCHEMA_INVALID' ELSE '' END) AS issue_codes FROM o"""


@register("g7_rule_catalogue", RULES_SQL)
def g7_catalogue(spark, sf_dir):
    """Every rule of the catalogue on one config per order."""
    found = R.with_issues(order_configs(spark, sf_dir), R.PROFILES[PROFILE], RULE_PROBE)
    codes = found.select("o_orderkey", F.array_sort(F.transform("issues", lambda i: i["code"])).alias("codes"))
    return codes.select("o_orderkey", F.when(F.size("codes") == 0, "valid").otherwise("skipped").alias("status"),
                        F.array_join("codes", ",").alias("issue_codes"))


@register("r30_factor_counts_of_cases", "WITH cases AS (" + RULES_SQL + """),
f AS (SELECT status, o_orderpriority, o_orderstatus, o_orderkey % 3 = 0 AS raw, o_custkey % 2 = 0 AS even, o_custkey % 9 = 0 AS imported
      FROM cases JOIN orders USING (o_orderkey)),
v AS (SELECT status, unnest([
  {'factor': 'model', 'value': CASE o_orderpriority WHEN '1-URGENT' THEN 'random_forest' WHEN '2-HIGH' THEN 'chemprop'
     WHEN '3-MEDIUM' THEN 'dl_simple' WHEN '4-NOT SPECIFIED' THEN 'catboost_classifier' ELSE '' END},
  {'factor': 'feature', 'value': CASE WHEN raw THEN 'smiles_native' ELSE 'none' END},
  {'factor': 'scaler', 'value': CASE WHEN even THEN 'none' ELSE 'robust' END},
  {'factor': 'split', 'value': CASE WHEN imported THEN 'tdc_scaffold' ELSE 'random' END}]) AS s FROM f)
SELECT status, s.factor AS factor, s.value AS value, count(*) AS n FROM v GROUP BY ALL""")
def r30_cases(spark, sf_dir):
    """Cases per model, feature input, scaler and split strategy, valid and skipped."""
    cases = R.with_issues(order_configs(spark, sf_dir), R.PROFILES[PROFILE], RULE_PROBE)
    m = F.col("config")
    cases = cases.select(F.when(F.size("issues") == 0, "valid").otherwise("skipped").alias("status"), "config")
    return factor_counts(cases, {
        "model": G.get_dotted(m, "train.model.type"), "feature": G.get_dotted(m, "pipeline.feature_input"),
        "scaler": G.get_dotted(m, "preprocess.scaler"), "split": G.get_dotted(m, "split.strategy")}, by=["status"])


@register("g1_set_remove_extract", """
SELECT user_id % 3 AS kind, CASE WHEN user_id % 2 = 0 THEN 'fold=1,n_splits=5,stage=inner' ELSE 'fold=1,n_splits=5' END AS split_part,
       CAST(2 AS INTEGER) + CASE WHEN user_id % 2 = 0 THEN 1 ELSE 0 END + 1 AS n_keys, count(*) AS n FROM events GROUP BY ALL""")
def g1_paths(spark, sf_dir):
    """A model branch becomes a value, a value becomes a branch, a branch goes."""
    e = table(spark, sf_dir, "events")
    m = F.create_map(*[F.lit(x) for x in ("train.model.type", "rf", "train.model.depth", "3", "split.fold", "0", "split.n_splits", "5", "io.a.b", "x")])
    m = G.set_dotted(G.set_dotted(m, "train.model", F.col("event_type")), "split.fold", "1")
    m = F.when(F.col("user_id") % 2 == 0, G.set_dotted(m, ".split..stage", "inner")).otherwise(m)
    m = G.remove_dotted(m, "io.a")
    return e.select((F.col("user_id") % 3).alias("kind"), G.canonical(G.extract_prefixed(m, "split."), []).alias("split_part"),
                    F.size(m).alias("n_keys")).groupBy("kind", "split_part", "n_keys").agg(F.count(F.lit(1)).alias("n"))
