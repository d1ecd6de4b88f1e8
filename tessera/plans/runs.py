"""Run-history queries.

A study's run history is derived from ``events`` (one execution slice per
event; the work grows with the table):

* case ``case_<event_id>__p<user%3>__<model>__<mode>__<strategy>``; model from
  ``props.k % 3``, mode from ``user_id % 2``, strategy from ``k % 2``,
  scaler from ``user_id % 4``; parent ``parent_<user_id>``; scientific id
  ``sid_<user_id>_<model>`` (the slices of one config);
* attempt state from ``event_type`` (purchase/view COMPLETED, click RUNNING,
  error FAILED, signup SKIPPED), run status likewise (signup: absent unless
  value > 25); start = ts, end = ts + floor(value) s;
* metrics for successful runs unless ``k % 7 = 0``: train = 0.5 + (k%50)/100,
  test = value / 500, val = mean of both unless event_id % 3 = 0; svm runs
  report auc/accuracy, the others r2/mae; ``k % 5 = 0`` also has a top-level r2.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import runs as R
from tessera.operators.radix_select import exact_quantiles
from tessera.operators.ranks import rank_within_key
from tessera.functions.scalar import elapsed_seconds
from tessera.plans import register
from tessera.sources.tables import table

MODELS = ["random_forest", "svm", "xgboost"]
SCALERS = ["robust", "standard", "minmax", "none"]


def run_table(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    et = F.col("event_type")
    model = F.when(k % 3 == 0, "random_forest").when(k % 3 == 1, "svm").otherwise("xgboost")
    mode = F.when(F.col("user_id") % 2 == 0, "holdout").otherwise("cv")
    strategy = F.when(k % 2 == 0, "random").otherwise("scaffold")
    scaler = F.element_at(F.array(*[F.lit(s) for s in SCALERS]), (F.col("user_id") % 4 + 1).cast("int"))
    case_name = F.concat(F.lit("case_"), F.format_string("%05d", F.col("event_id").cast("long")), F.lit("__p"),
                         (F.col("user_id") % 3).cast("string"), F.lit("__"), model, F.lit("__"), mode, F.lit("__"),
                         strategy)
    start = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    end_ts = F.timestamp_seconds(F.unix_seconds(F.col("ts").cast("timestamp")) + F.floor("value").cast("long"))
    base = e.select(
        F.col("event_id").alias("case_index"), "user_id", k.alias("k"), "value", et.alias("event_type"),
        case_name.alias("case_name"), model.alias("model_type"), mode.alias("split_mode"),
        strategy.alias("split_strategy"), scaler.alias("scaler"),
        F.format_string("parent_%04d", F.col("user_id")).alias("parent_case_id"),
        F.concat(F.lit("sid_"), F.col("user_id").cast("string"), F.lit("_"), model).alias("scientific_config_id"),
        F.concat(F.lit("rep"), ((F.col("event_id") / 5).cast("long") % 2).cast("string"), F.lit("_fold"),
                 (F.col("event_id") % 5).cast("string")).alias("execution_label"),
        F.when(et.isin("purchase", "view"), "COMPLETED").when(et == "click", "RUNNING").when(et == "error", "FAILED")
        .otherwise("SKIPPED").alias("attempt_state"),
        F.when(et == "error", F.lit(1)).when(et == "click", F.lit(None)).otherwise(F.lit(0)).alias("return_code"),
        start.alias("start_time"),
        F.when(et != "click", F.date_format(end_ts, "yyyy-MM-dd'T'HH:mm:ss")).alias("end_time"),
        F.when(et.isin("purchase", "view"), "success").when(et == "error", "failed").when(et == "click", "running")
        .when(F.col("value") > 25, "success").alias("status"),
        F.when((et == "error") & (k % 2 == 0), "train").otherwise("").alias("failed_node"),
        F.when((et == "error") & (k % 3 == 0), "ValueError").otherwise("").alias("exception_type"),
    )
    base = base.withColumn("config_path", F.concat(F.lit("/study/cases/"), "case_name", F.lit(".yaml"))) \
        .withColumn("run_dir", F.concat(F.lit("/study/runs/"), "case_name"))
    has_m = (F.col("status") == "success") & (F.col("k") % 7 != 0)
    tr = 0.5 + (F.col("k") % 50) / 100.0
    te = F.col("value") / 500.0
    va = F.when(F.col("case_index") % 3 != 0, (tr + te) / 2)
    cls = F.col("model_type") == "svm"

    def mp(v):
        lits = lambda d: F.create_map(*[x for k, c in d.items() for x in (F.lit(k), c)])
        return F.when(has_m, F.when(cls, lits({"auc": v, "auprc": v - 0.02, "accuracy": v - 0.05, "f1": v - 0.03}))
                      .otherwise(lits({"r2": v, "mae": 1 - v, "rmse": 1.5 - v, "mse": 2 - v})))

    return base.withColumn("has_metrics", has_m).withColumn("train", mp(tr)).withColumn("test", mp(te)) \
        .withColumn("val", F.when(va.isNotNull(), mp(va))) \
        .withColumn("top_r2", F.when(has_m & (F.col("k") % 5 == 0) & ~cls, te))


RUNS_SQL = """
rb AS (
  SELECT event_id AS case_index, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, value, event_type, ts
  FROM events),
rc AS (
  SELECT *, CASE k % 3 WHEN 0 THEN 'random_forest' WHEN 1 THEN 'svm' ELSE 'xgboost' END AS model_type,
         CASE WHEN user_id % 2 = 0 THEN 'holdout' ELSE 'cv' END AS split_mode,
         CASE WHEN k % 2 = 0 THEN 'random' ELSE 'scaffold' END AS split_strategy,
         ['robust', 'standard', 'minmax', 'none'][user_id % 4 + 1] AS scaler FROM rb),
runs AS (
  SELECT case_index, user_id, k, value, event_type, model_type, split_mode, split_strategy, scaler,
         'case_' || printf('%05d', case_index) || '__p' || CAST(user_id % 3 AS VARCHAR) || '__'
           || model_type || '__' || split_mode || '__' || split_strategy AS case_name,
         printf('parent_%04d', user_id) AS parent_case_id,
         'sid_' || CAST(user_id AS VARCHAR) || '_' || model_type AS scientific_config_id,
         'rep' || CAST((case_index // 5) % 2 AS VARCHAR) || '_fold' || CAST(case_index % 5 AS VARCHAR) AS execution_label,
         CASE WHEN event_type IN ('purchase', 'view') THEN 'COMPLETED' WHEN event_type = 'click' THEN 'RUNNING'
              WHEN event_type = 'error' THEN 'FAILED' ELSE 'SKIPPED' END AS attempt_state,
         CASE WHEN event_type = 'error' THEN 1 WHEN event_type = 'click' THEN NULL ELSE 0 END AS return_code,
         strftime(ts, '%Y-%m-%dT%H:%M:%S') AS start_time,
         CASE WHEN event_type <> 'click' THEN strftime(make_timestamp((floor(epoch(ts))::BIGINT
              + floor(value)::BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%S') END AS end_time,
         CASE WHEN event_type IN ('purchase', 'view') THEN 'success' WHEN event_type = 'error' THEN 'failed'
              WHEN event_type = 'click' THEN 'running' WHEN value > 25 THEN 'success' END AS status,
         CASE WHEN event_type = 'error' AND k % 2 = 0 THEN 'train' ELSE '' END AS failed_node,
         CASE WHEN event_type = 'error' AND k % 3 = 0 THEN 'ValueError' ELSE '' END AS exception_type
  FROM rc),
runs2 AS (
  SELECT *, '/study/cases/' || case_name || '.yaml' AS config_path, '/study/runs/' || case_name AS run_dir,
         coalesce(status = 'success' AND k % 7 <> 0, false) AS has_metrics,
         0.5 + (k % 50) / 100.0 AS tr, value / 500.0 AS te FROM runs),
rm AS (
  SELECT *, CASE WHEN case_index % 3 <> 0 THEN (tr + te) / 2 END AS va,
         CASE WHEN has_metrics THEN CASE WHEN model_type = 'svm' THEN 'auc' ELSE 'r2' END END AS metric_name,
         CASE WHEN has_metrics AND k % 5 = 0 AND model_type <> 'svm' THEN te END AS top_r2 FROM runs2),
st AS (
  SELECT *,
    CASE WHEN status IS NULL THEN 'UNKNOWN' WHEN status = 'success' THEN 'COMPLETED' WHEN status = 'failed' THEN 'FAILED'
         WHEN status = 'running' THEN 'RUNNING' ELSE 'UNKNOWN' END AS status_state,
    CASE WHEN status = 'success' THEN '0' WHEN status = 'failed' THEN '1' ELSE '' END AS status_code,
    CASE WHEN status IS NULL THEN 'missing_run_status' WHEN status = 'success' THEN NULL WHEN status = 'running' THEN 'running'
         WHEN status = 'failed' THEN CASE WHEN failed_node <> '' AND exception_type <> '' THEN failed_node || ':' || exception_type
              WHEN exception_type <> '' THEN exception_type WHEN failed_node <> '' THEN failed_node ELSE 'failed' END
         ELSE 'run_status_' || status END AS status_reason FROM rm),
merged AS (
  SELECT *,
    CASE WHEN attempt_state IN ('FAILED', 'CANCELLED', 'TIMEOUT') OR coalesce(return_code, 0) <> 0 THEN 'FAILED'
         WHEN attempt_state = 'SKIPPED' AND status_state = 'COMPLETED' THEN 'COMPLETED'
         WHEN attempt_state = 'SKIPPED' THEN 'SKIPPED'
         WHEN attempt_state = 'COMPLETED' AND status_state IN ('COMPLETED', 'UNKNOWN') THEN 'COMPLETED'
         ELSE status_state END AS state,
    CASE WHEN attempt_state IN ('FAILED', 'CANCELLED', 'TIMEOUT') OR coalesce(return_code, 0) <> 0
              THEN coalesce(CASE WHEN coalesce(return_code, 0) <> 0 THEN 'nonzero_return_code'
                                 WHEN attempt_state IN ('FAILED', 'CANCELLED', 'TIMEOUT') THEN lower(attempt_state) END,
                            status_reason)
         WHEN attempt_state = 'SKIPPED' AND status_state = 'COMPLETED' THEN NULL
         WHEN attempt_state = 'SKIPPED' THEN status_reason
         WHEN attempt_state = 'COMPLETED' AND status_state IN ('COMPLETED', 'UNKNOWN') THEN NULL
         ELSE status_reason END AS failure_reason
  FROM st),
jobs AS (
  SELECT *, CASE WHEN state = 'COMPLETED' AND NOT has_metrics THEN 'PARTIAL' ELSE state END AS job_state,
         CASE WHEN state = 'COMPLETED' AND NOT has_metrics THEN
              CASE WHEN failure_reason IS NULL OR trim(failure_reason) = '' THEN 'missing_metrics'
                   ELSE failure_reason || '; missing_metrics' END ELSE failure_reason END AS job_reason
  FROM merged),
gen AS (
  SELECT *, CASE WHEN metric_name = 'r2' THEN tr ELSE tr END AS train_value, te AS test_value, va AS val_value,
         tr - te AS gap, tr - te >= 0.15 AS overfit_flag,
         tr < CASE WHEN metric_name = 'r2' THEN 0.20 ELSE 0.65 END
           AND te < CASE WHEN metric_name = 'r2' THEN 0.20 ELSE 0.65 END AS underfit_flag
  FROM merged WHERE state = 'COMPLETED' AND metric_name IS NOT NULL)
"""


def merged_jobs(spark, sf_dir):
    """R1-R3 on the run table: state from the status document, merged with
    the attempt record."""
    r = run_table(spark, sf_dir)
    s_state, s_code, s_reason = R.state_from_status(F.col("status"), F.col("status").isNotNull(), F.col("failed_node"),
                                                    F.col("exception_type"))
    r = r.withColumn("status_state", s_state).withColumn("status_code", s_code).withColumn("status_reason", s_reason)
    state, code, reason = R.merge_state(F.col("status_state"), F.col("status_code"), F.col("status_reason"),
                                        F.lit(True), F.col("attempt_state"), F.col("return_code"), F.lit(None))
    return r.withColumn("state", state).withColumn("exit_code", code).withColumn("failure_reason", reason)


@register("r1_r2_state_from_run_status", "WITH " + RUNS_SQL + """
SELECT status_state AS state, status_code AS exit_code, status_reason AS failure_reason, count(*) AS n FROM st GROUP BY ALL""")
def r1(spark, sf_dir):
    r = run_table(spark, sf_dir)
    s, c, reason = R.state_from_status(F.col("status"), F.col("status").isNotNull(), F.col("failed_node"),
                                       F.col("exception_type"))
    return r.groupBy(s.alias("state"), c.alias("exit_code"), reason.alias("failure_reason")).agg(
        F.count(F.lit(1)).alias("n"))


@register("r3_state_merge", "WITH " + RUNS_SQL + """
SELECT state, failure_reason, count(*) AS n FROM merged GROUP BY ALL""")
def r3(spark, sf_dir):
    return merged_jobs(spark, sf_dir).groupBy("state", "failure_reason").agg(F.count(F.lit(1)).alias("n"))


@register("r4_j13_scheduler_failure_class", """
WITH steps AS (
  SELECT CAST(event_id AS VARCHAR) || '.batch' AS id,
         CASE WHEN CAST(json_extract(props, '$.k') AS BIGINT) >= 95 THEN 'OUT_OF_MEMORY' ELSE 'COMPLETED' END AS st FROM events
  UNION ALL SELECT CAST(event_id AS VARCHAR), CASE event_type WHEN 'purchase' THEN 'COMPLETED' WHEN 'view' THEN 'CANCELLED by 0'
         WHEN 'click' THEN 'RUNNING' WHEN 'error' THEN 'FAILED' ELSE 'PENDING' END FROM events
  UNION ALL SELECT CAST(event_id AS VARCHAR) || '.0', CASE WHEN value > 480 THEN 'TIMEOUT' ELSE 'COMPLETED' END FROM events),
roots AS (SELECT id, st AS job_state FROM steps WHERE NOT contains(id, '.')),
kids AS (SELECT split_part(id, '.', 1) AS root, bool_or(contains(upper(st), 'OUT_OF_MEMORY')) AS oom FROM steps
         WHERE contains(id, '.') GROUP BY 1)
SELECT CASE WHEN upper(job_state) = 'COMPLETED' THEN NULL
            WHEN contains(upper(job_state), 'OUT_OF_MEMORY') OR coalesce(oom, false) THEN 'out_of_memory'
            WHEN contains(upper(job_state), 'TIMEOUT') THEN 'timeout' WHEN contains(upper(job_state), 'CANCELLED') THEN 'cancelled'
            WHEN contains(upper(job_state), 'FAILED') THEN 'failed_other' WHEN contains(upper(job_state), 'PENDING') THEN 'pending'
            WHEN contains(upper(job_state), 'RUNNING') THEN 'running' ELSE 'other' END AS failure_class, count(*) AS n
FROM roots LEFT JOIN kids ON roots.id = kids.root GROUP BY 1""")
def r4(spark, sf_dir):
    """Scheduler accounting rows (job + '.batch' / '.0' steps) are rolled up by
    root id (J13); the job's class looks at the job and all its steps (R4)."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    job = F.when(F.col("event_type") == "purchase", "COMPLETED").when(F.col("event_type") == "view", "CANCELLED by 0") \
        .when(F.col("event_type") == "click", "RUNNING").when(F.col("event_type") == "error", "FAILED").otherwise("PENDING")
    steps = e.select(F.concat(F.col("event_id").cast("string"), F.lit(".batch")).alias("id"),
                     F.when(k >= 95, "OUT_OF_MEMORY").otherwise("COMPLETED").alias("st")) \
        .unionByName(e.select(F.col("event_id").cast("string").alias("id"), job.alias("st"))) \
        .unionByName(e.select(F.concat(F.col("event_id").cast("string"), F.lit(".0")).alias("id"),
                              F.when(F.col("value") > 480, "TIMEOUT").otherwise("COMPLETED").alias("st")))
    is_step = F.col("id").contains(".")
    roots = steps.filter(~is_step).select("id", F.col("st").alias("job_state"))
    # Step states per root: a job has a fixed, small number of steps.
    kids = steps.filter(is_step).groupBy(F.split("id", r"\.")[0].alias("root")).agg(
        F.collect_list("st").alias("step_states"))
    j = roots.join(kids, roots["id"] == kids["root"], "left")
    return j.groupBy(R.scheduler_failure_class(F.col("job_state"), F.col("step_states")).alias("failure_class")).agg(
        F.count(F.lit(1)).alias("n"))


@register("r5_elapsed_seconds", "WITH " + RUNS_SQL + """
SELECT attempt_state, count(el) AS n_timed, CAST(sum(el) AS BIGINT) AS total_seconds, count(*) AS n FROM (
  SELECT attempt_state, CASE WHEN end_time IS NOT NULL THEN greatest(0, CAST(epoch(CAST(end_time AS TIMESTAMP))
         - epoch(CAST(start_time AS TIMESTAMP)) AS BIGINT)) END AS el FROM runs) GROUP BY 1""")
def r5(spark, sf_dir):
    r = run_table(spark, sf_dir).withColumn("el", elapsed_seconds("start_time", "end_time"))
    return r.groupBy("attempt_state").agg(F.count("el").alias("n_timed"), F.sum("el").cast("long").alias("total_seconds"),
                                          F.count(F.lit(1)).alias("n"))


@register("r6_job_table", "WITH " + RUNS_SQL + """
SELECT printf('local_%05d', row_number() OVER (ORDER BY case_index)) AS job_id, case_name, job_state AS state,
       job_reason AS failure_reason FROM jobs""")
def r6(spark, sf_dir):
    """Job ids by manifest position: a skew-safe rank (quantile buckets), not a
    single-partition window."""
    j = merged_jobs(spark, sf_dir)
    j = R.mark_missing_metrics(j, F.col("has_metrics"), F.col("has_metrics"))
    ranked = rank_within_key(j.withColumn("__all", F.lit(0)), "__all", "case_index", out="pos")
    return ranked.select(F.format_string("local_%05d", F.col("pos")).alias("job_id"), "case_name", "state",
                         "failure_reason")


@register("r7_case_name_parse", "WITH " + RUNS_SQL + """
SELECT split_part(case_name, '__', 2) AS profile, split_part(case_name, '__', 3) AS model_type,
       split_part(case_name, '__', 4) AS split_mode, split_part(case_name, '__', 5) AS split_strategy,
       count(*) AS n, CAST(sum(CAST(regexp_extract(case_name, '^case_(\\d+)', 1) AS BIGINT)) AS BIGINT) AS sum_index
FROM runs GROUP BY ALL""")
def r7(spark, sf_dir):
    r = run_table(spark, sf_dir).select(*R.case_fields(F.col("case_name")))
    return r.groupBy("profile", "model_type", "split_mode", "split_strategy").agg(
        F.count(F.lit(1)).alias("n"), F.sum("case_index").cast("long").alias("sum_index"))


@register("r8_log_id_extraction", r"""
WITH logs AS (SELECT user_id, event_id, 'Submitted batch job ' || CAST(event_id AS VARCHAR) || ' ok; retry: Submitted batch job '
                     || CAST(user_id * 100000 + dayofmonth(ts) AS VARCHAR) AS text FROM events),
ids AS (SELECT user_id, event_id, unnest(regexp_extract_all(text, 'Submitted batch job (\d+)', 1)) AS job_id,
               generate_subscripts(regexp_extract_all(text, 'Submitted batch job (\d+)', 1), 1) AS pos FROM logs),
f AS (SELECT user_id, job_id, min(event_id * 100 + pos) AS o FROM ids GROUP BY 1, 2)
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY o) AS position, job_id FROM f""")
def r8(spark, sf_dir):
    """Orchestrator log lines (one per event) -> all job ids, unique, in
    first-seen order per user, as (user, position, job id) rows: per-line
    extraction, then the D8 fold (no per-user array)."""
    from tessera.operators.dedupe import first_occurrence_distinct
    e = table(spark, sf_dir, "events")
    text = F.concat(F.lit("Submitted batch job "), F.col("event_id").cast("string"),
                    F.lit(" ok; retry: Submitted batch job "),
                    (F.col("user_id") * 100000 + F.dayofmonth("ts")).cast("string"))
    ids = e.select("user_id", "event_id", F.posexplode(F.regexp_extract_all(text, F.lit(r"Submitted batch job (\d+)"), 1))
                   .alias("pos", "job_id"))
    ids = ids.withColumn("o", F.col("event_id") * 100 + F.col("pos") + 1)
    return first_occurrence_distinct(ids, "user_id", "job_id", "o")


@register("r9_delimited_line_parse", """
WITH lines AS (SELECT CASE WHEN event_type = 'signup' THEN concat_ws('|', event_id, user_id, event_type, value, 'x')
                           ELSE concat_ws('|', event_id, user_id, event_type, value, 'x', 'y') END AS line FROM events)
SELECT split_part(line, '|', 3) AS field_3, count(*) AS n_valid FROM lines WHERE len(string_split(line, '|')) = 6 GROUP BY 1""")
def r9(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    line = F.when(F.col("event_type") == "signup",
                  F.concat_ws("|", "event_id", "user_id", "event_type", "value", F.lit("x"))) \
        .otherwise(F.concat_ws("|", "event_id", "user_id", "event_type", "value", F.lit("x"), F.lit("y")))
    parts = F.split(line, r"\|")
    return e.select(parts.alias("p")).filter(F.size("p") == 6).groupBy(F.col("p")[2].alias("field_3")).agg(
        F.count(F.lit(1)).alias("n_valid"))


@register("r10_feature_input_scaler_inference", """
WITH n AS (SELECT CASE WHEN CAST(json_extract(props, '$.k') AS BIGINT) % 3 = 0 THEN ['get_data', 'curate', 'featurize.morgan', 'train']
                       WHEN CAST(json_extract(props, '$.k') AS BIGINT) % 3 = 1 THEN ['get_data', 'featurize.rdkit', 'preprocess.features', 'train']
                       ELSE ['get_data', 'curate', 'train'] END AS nodes, user_id FROM events)
SELECT CASE WHEN list_contains(nodes, 'featurize.morgan') THEN 'featurize.morgan'
            WHEN list_contains(nodes, 'featurize.rdkit') THEN 'featurize.rdkit'
            WHEN user_id % 5 = 0 THEN 'featurize.none' WHEN user_id % 5 = 1 THEN 'custom_input'
            WHEN user_id % 5 = 2 THEN 'smiles_native' ELSE 'none' END AS feature_input,
       ['robust', 'standard', 'minmax', 'none'][user_id % 4 + 1] AS scaler, count(*) AS n FROM n GROUP BY ALL""")
def r10(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    nodes = F.when(k % 3 == 0, F.array(*[F.lit(x) for x in ["get_data", "curate", "featurize.morgan", "train"]])) \
        .when(k % 3 == 1, F.array(*[F.lit(x) for x in ["get_data", "featurize.rdkit", "preprocess.features", "train"]])) \
        .otherwise(F.array(*[F.lit(x) for x in ["get_data", "curate", "train"]]))
    configured = F.element_at(F.array(*[F.lit(s) for s in SCALERS]), (F.col("user_id") % 4 + 1).cast("int"))
    u = F.col("user_id") % 5
    declared = F.when(u == 0, "use.curated_features").when(u == 1, " custom_input ").otherwise("")
    model = F.when(u == 2, "Chemprop").otherwise("svm")
    x = e.select(nodes.alias("nodes"), configured.alias("configured"), declared.alias("declared"), model.alias("model"))
    return x.groupBy(R.feature_input("nodes", "declared", "model").alias("feature_input"), F.col("configured").alias("scaler")) \
        .agg(F.count(F.lit(1)).alias("n"))


@register("r12_primary_metric_choice", "WITH " + RUNS_SQL + """
SELECT metric_name, count(*) AS n FROM merged WHERE has_metrics GROUP BY 1""")
def r12(spark, sf_dir):
    r = run_table(spark, sf_dir).filter("has_metrics")
    return r.groupBy(R.primary_metric(F.col("train"), F.col("test")).alias("metric_name")).agg(
        F.count(F.lit(1)).alias("n"))


@register("r13_generalization_gap_flags", "WITH " + RUNS_SQL + """
SELECT case_name, metric_name, round(train_value, 6) AS train_value, round(test_value, 6) AS test_value,
       round(gap, 6) AS gap_train_minus_test, overfit_flag, underfit_flag FROM gen""")
def r13(spark, sf_dir):
    g = R.generalization(merged_jobs(spark, sf_dir))
    return g.select("case_name", "metric_name", F.round("train_value", 6).alias("train_value"),
                    F.round("test_value", 6).alias("test_value"),
                    F.round("gap_train_minus_test", 6).alias("gap_train_minus_test"), "overfit_flag", "underfit_flag")


AGG_SQL = """,
summ AS (SELECT coalesce(parent_case_id, scientific_config_id, case_name) AS aggregate_key, count(*) AS slice_count,
                count(*) FILTER (WHERE state = 'COMPLETED') AS completed_slices FROM merged GROUP BY 1),
ag AS (SELECT coalesce(parent_case_id, scientific_config_id, case_name) AS aggregate_key, metric_name,
              avg(train_value) AS train_value, avg(test_value) AS test_value, avg(val_value) AS val_value,
              avg(gap) AS gap, coalesce(stddev_pop(gap), 0.0) AS gap_std, count(*) AS used,
              arg_min(case_name, case_index) AS case_name FROM gen GROUP BY 1, 2),
agg AS (SELECT ag.*, greatest(coalesce(s.slice_count, used), used) AS slice_count,
               greatest(greatest(coalesce(s.completed_slices, used), used) - used, 0) AS missing
        FROM ag LEFT JOIN summ s USING (aggregate_key)),
aggr AS (SELECT *, gap >= 0.15 AS overfit_flag,
                train_value < CASE WHEN metric_name = 'r2' THEN 0.20 ELSE 0.65 END
                  AND test_value < CASE WHEN metric_name = 'r2' THEN 0.20 ELSE 0.65 END AS underfit_flag,
                CASE WHEN missing > 0 THEN 'PARTIAL' WHEN used = slice_count THEN 'COMPLETED' ELSE 'PARTIAL' END AS state,
                CASE WHEN missing > 0 THEN 'missing_generalization_metrics=' || CAST(missing AS VARCHAR) END AS failure_reason
         FROM agg)"""


def aggregated(spark, sf_dir):
    j = merged_jobs(spark, sf_dir)
    return R.aggregate_generalization(R.generalization(j), group_completion(j))


def group_completion(j):
    key = F.coalesce("parent_case_id", "scientific_config_id", "case_name")
    return j.groupBy(key.alias("aggregate_key")).agg(
        F.count(F.lit(1)).alias("slice_count"), F.count_if(F.col("state") == "COMPLETED").alias("completed_slices"))


@register("r14_j17_aggregated_gap", "WITH " + RUNS_SQL + AGG_SQL + """
SELECT aggregate_key, metric_name, case_name, round(train_value, 6) AS train_value, round(test_value, 6) AS test_value,
       round(gap, 6) AS gap_train_minus_test, round(gap_std, 6) AS gap_train_minus_test_std, overfit_flag, underfit_flag,
       state, failure_reason, CAST(slice_count AS BIGINT) AS slice_count, CAST(used AS BIGINT) AS metric_slices_used
FROM aggr""")
def r14(spark, sf_dir):
    a = aggregated(spark, sf_dir)
    return a.select("aggregate_key", "metric_name", "case_name", F.round("train_value", 6).alias("train_value"),
                    F.round("test_value", 6).alias("test_value"),
                    F.round("gap_train_minus_test", 6).alias("gap_train_minus_test"),
                    F.round("gap_train_minus_test_std", 6).alias("gap_train_minus_test_std"), "overfit_flag",
                    "underfit_flag", "state", "failure_reason", "slice_count", "metric_slices_used")


@register("r15_complete_only_filter", "WITH " + RUNS_SQL + """,
g AS (SELECT scientific_config_id, count(*) AS slice_count, count(*) FILTER (WHERE state = 'COMPLETED') AS completed
      FROM merged GROUP BY 1)
SELECT count(*) FILTER (WHERE slice_count > 0 AND completed = slice_count) AS n_complete_groups, count(*) AS n_groups FROM g""")
def r15(spark, sf_dir):
    g = merged_jobs(spark, sf_dir).groupBy("scientific_config_id").agg(
        F.count(F.lit(1)).alias("slice_count"), F.count_if(F.col("state") == "COMPLETED").alias("completed"))
    return g.agg(F.count_if((F.col("slice_count") > 0) & (F.col("completed") == F.col("slice_count")))
                 .alias("n_complete_groups"), F.count(F.lit(1)).alias("n_groups"))


# Complete aggregated records: groups of which every slice completed, with the
# model and scaler of the case that names the group and all its config paths.
# For these the study's groups are pairs of neighbouring cases, of which some are complete.
COMPLETE_SQL = """,
merged_p AS (SELECT * REPLACE ('pair_' || CAST(case_index // 2 AS VARCHAR) AS parent_case_id) FROM merged),
gen_p AS (SELECT * REPLACE ('pair_' || CAST(case_index // 2 AS VARCHAR) AS parent_case_id) FROM gen)""" \
    + AGG_SQL.replace("FROM merged ", "FROM merged_p ").replace("FROM gen ", "FROM gen_p ") + """,
done AS (SELECT aggregate_key FROM summ WHERE slice_count > 0 AND completed_slices = slice_count),
complete AS (SELECT aggr.*, m.model_type, m.scaler FROM aggr JOIN done USING (aggregate_key) JOIN merged m USING (case_name)),
paths AS (SELECT DISTINCT coalesce(parent_case_id, scientific_config_id, case_name) AS aggregate_key, metric_name,
                 '/study/cases/' || case_name || '.yaml' AS config_path FROM gen_p)"""


def paired_jobs(spark, sf_dir):
    pair = F.concat(F.lit("pair_"), F.floor(F.col("case_index") / 2).cast("string"))
    return merged_jobs(spark, sf_dir).withColumn("parent_case_id", pair)


def complete_records(spark, sf_dir):
    j = paired_jobs(spark, sf_dir)
    a = R.aggregate_generalization(R.generalization(j), group_completion(j))
    named = j.select("case_name", "model_type", "scaler")
    return R.complete_only(a, group_completion(j)).join(named, "case_name")


@register("r16_gap_by_model_scaler", "WITH " + RUNS_SQL + COMPLETE_SQL + """
SELECT model_type, scaler, count(*) AS n, round(avg(gap), 6) AS mean_gap, round(median(gap), 6) AS median_gap,
       round(max(gap), 6) AS max_gap, count(*) FILTER (WHERE overfit_flag) AS n_overfit,
       count(*) FILTER (WHERE underfit_flag) AS n_underfit FROM complete GROUP BY 1, 2""")
def r16(spark, sf_dir):
    """Over complete aggregated records (every slice of the group completed)."""
    g = complete_records(spark, sf_dir)
    med = exact_quantiles(g, "gap_train_minus_test", [0.5], ["model_type", "scaler"], max_groups=64)
    agg = g.groupBy("model_type", "scaler").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("gap_train_minus_test"), 6).alias("mean_gap"),
        F.round(F.max("gap_train_minus_test"), 6).alias("max_gap"),
        F.count_if("overfit_flag").alias("n_overfit"), F.count_if("underfit_flag").alias("n_underfit"))
    return agg.join(med.select("model_type", "scaler", F.round("q0", 6).alias("median_gap")), ["model_type", "scaler"])


@register("r17_ranked_gap_list", "WITH " + RUNS_SQL + AGG_SQL + """
SELECT row_number() OVER (ORDER BY gap DESC, aggregate_key, metric_name) AS rank, aggregate_key, metric_name,
       round(gap, 6) AS gap_train_minus_test FROM aggr""")
def r17(spark, sf_dir):
    a = aggregated(spark, sf_dir)
    # greatest gap first, unknown gaps last, ranked by ranges
    keyed = a.withColumn("__all", F.lit(0)).withColumn("__null", F.col("gap_train_minus_test").isNull()).withColumn("__neg", -F.col("gap_train_minus_test"))
    ordered = rank_within_key(keyed, "__all", ["__null", "__neg", "aggregate_key", "metric_name"], out="rank")
    return ordered.select(F.col("rank").cast("long").alias("rank"), "aggregate_key", "metric_name",
                          F.round("gap_train_minus_test", 6).alias("gap_train_minus_test"))


# (metric, model side, value of a split's level v)
_METRIC_SQL = {"r2": ("r2", "{v}"), "mae": ("r2", "1 - {v}"), "rmse": ("r2", "1.5 - {v}"), "mse": ("r2", "2 - {v}"),
               "auc": ("auc", "{v}"), "auprc": ("auc", "{v} - 0.02"), "accuracy": ("auc", "{v} - 0.05"), "f1": ("auc", "{v} - 0.03")}


def _metric_fields_sql() -> dict[str, str]:
    split = {s: {m: f"CASE WHEN metric_name = '{side}' THEN {value.format(v=v)} END" for m, (side, value) in _METRIC_SQL.items()}
             for s, v in (("train", "tr"), ("test", "te"), ("val", "va"))}
    top = {m: f"coalesce({'top_r2, ' if m == 'r2' else ''}{split['test'][m]}, {split['val'][m]}, {split['train'][m]})" for m in R.METRICS}
    return top | {f"{s}_{m}": split[s][m] for m in R.METRICS for s in R.SPLITS}


FIELDS_SQL = _metric_fields_sql()
ROWS_SQL = """,
mrow AS (SELECT *, coalesce(parent_case_id, scientific_config_id, config_path, case_name) AS aggregate_key, """ + ", ".join(
    f"{v} AS f_{k}" for k, v in FIELDS_SQL.items()) + """ FROM merged)"""


def metric_rows(spark, sf_dir):
    j = merged_jobs(spark, sf_dir).withColumn("top", F.when(F.col("top_r2").isNotNull(), F.create_map(F.lit("r2"), F.col("top_r2"))))
    key = F.coalesce("parent_case_id", "scientific_config_id", "config_path", "case_name")
    return R.metric_rows(j.withColumn("aggregate_key", key))


@register("r18_metric_row_build", "WITH " + RUNS_SQL + ROWS_SQL + """
SELECT case_name, """ + ", ".join(f"round(f_{k}, 6) AS {k}" for k in FIELDS_SQL) + """ FROM mrow""")
def r18(spark, sf_dir):
    rows = metric_rows(spark, sf_dir)
    return rows.select("case_name", *[F.round(m, 6).alias(m) for m in R.METRIC_FIELDS])


GROUP_ROWS_SQL = ROWS_SQL + """,
per AS (SELECT aggregate_key, state, count(*) AS n, min(case_index) AS f FROM mrow GROUP BY 1, 2),
gstate AS (SELECT aggregate_key, CASE WHEN sum(n) FILTER (WHERE state = 'COMPLETED') = sum(n) THEN 'COMPLETED'
             WHEN sum(n) FILTER (WHERE state = 'COMPLETED') > 0 THEN 'PARTIAL' ELSE arg_max(state, (n, -f)) END AS state FROM per GROUP BY 1),
grow AS (SELECT aggregate_key, count(*) AS slice_count, count(*) FILTER (WHERE state = 'COMPLETED') AS completed_slices,
           count(*) FILTER (WHERE state IS DISTINCT FROM 'COMPLETED') AS failed_slices, """ + ", ".join(
    f"avg(f_{k}) FILTER (WHERE state = 'COMPLETED') AS {k}, stddev_pop(f_{k}) FILTER (WHERE state = 'COMPLETED') AS {k}_std" for k in FIELDS_SQL) + """
         FROM mrow GROUP BY 1)"""


@register("r19_group_aggregate_of_runs", "WITH " + RUNS_SQL + GROUP_ROWS_SQL + """
SELECT aggregate_key, slice_count, completed_slices, failed_slices, state AS group_state, """ + ", ".join(
    f"round({k} + 1e-9, 6) AS {k}, round({k}_std + 1e-9, 6) AS {k}_std" for k in FIELDS_SQL) + """ FROM grow JOIN gstate USING (aggregate_key)""")
def r19(spark, sf_dir):
    g = R.aggregate_metric_rows(metric_rows(spark, sf_dir), "aggregate_key")
    return g.select("aggregate_key", "slice_count", "completed_slices", "failed_slices", "group_state",
                    # means of two-decimal values often end in a 5: keep both engines off the tie
                    *[F.round(F.col(f"{m}{x}") + 1e-9, 6).alias(f"{m}{x}") for m in R.METRIC_FIELDS for x in ("", "_std")])


@register("r20_group_state", "WITH " + RUNS_SQL + """,
per AS (SELECT scientific_config_id, state, count(*) AS n, min(case_index) AS f FROM merged GROUP BY 1, 2),
agg AS (SELECT scientific_config_id, sum(n) AS total, sum(CASE WHEN state = 'COMPLETED' THEN n ELSE 0 END) AS done,
               arg_max(state, n * 1000000000 - f) AS mode_state FROM per GROUP BY 1)
SELECT scientific_config_id, CASE WHEN done = total THEN 'COMPLETED' WHEN done > 0 THEN 'PARTIAL' ELSE mode_state END
       AS group_state FROM agg""")
def r20(spark, sf_dir):
    return R.group_state(merged_jobs(spark, sf_dir), "scientific_config_id")


@register("r21_failure_summary", "WITH " + RUNS_SQL + """,
per AS (SELECT parent_case_id, failure_reason, count(*) AS n FROM merged WHERE failure_reason IS NOT NULL GROUP BY 1, 2)
SELECT parent_case_id, string_agg(failure_reason || '=' || CAST(n AS VARCHAR), ',' ORDER BY failure_reason || '=' || CAST(n AS VARCHAR))
       AS failure_summary FROM per GROUP BY 1""")
def r21(spark, sf_dir):
    return R.failure_summary(merged_jobs(spark, sf_dir), "parent_case_id")


@register("r22_representative_row", "WITH " + RUNS_SQL + """
SELECT scientific_config_id, arg_min(case_name, case_index) AS case_name FROM merged GROUP BY 1""")
def r22(spark, sf_dir):
    j = merged_jobs(spark, sf_dir)
    return j.groupBy("scientific_config_id").agg(
        F.min_by("case_name", F.struct(F.col("case_index").isNull().alias("none"), F.col("case_index"), F.col("case_name"))).alias("case_name"))


@register("r23_group_order_index", "WITH " + RUNS_SQL + """,
g AS (SELECT scientific_config_id, min(case_index) AS mi FROM merged GROUP BY 1)
SELECT row_number() OVER (ORDER BY mi NULLS LAST, scientific_config_id) AS group_index, scientific_config_id FROM g""")
def r23(spark, sf_dir):
    """Groups numbered by (min case index, key).  The group table is one row
    per config; the rank uses the skew-safe bucketed rank on min index."""
    g = merged_jobs(spark, sf_dir).groupBy("scientific_config_id").agg(
        F.min("case_index").alias("mi")).withColumns({"__all": F.lit(0), "none": F.col("mi").isNull()})
    # groups without an index come last, by key
    r = rank_within_key(g, "__all", ["none", "mi", "scientific_config_id"], out="group_index")
    return r.select(F.col("group_index").cast("long").alias("group_index"), "scientific_config_id")


@register("r24_state_reason_counts", "WITH " + RUNS_SQL + """
SELECT 'state' AS kind, state AS value, count(*) AS n FROM merged GROUP BY 2
UNION ALL SELECT 'reason', failure_reason, count(*) FROM merged WHERE failure_reason IS NOT NULL GROUP BY 2""")
def r24(spark, sf_dir):
    j = merged_jobs(spark, sf_dir)
    a = j.groupBy(F.lit("state").alias("kind"), F.col("state").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    b = j.filter(F.col("failure_reason").isNotNull()).groupBy(F.lit("reason").alias("kind"),
                                                              F.col("failure_reason").alias("value")).agg(
        F.count(F.lit(1)).alias("n"))
    return a.unionByName(b)


@register("r25_flagged_config_list", "WITH " + RUNS_SQL + COMPLETE_SQL + """
SELECT DISTINCT 'overfit' AS flag, config_path FROM complete JOIN paths USING (aggregate_key, metric_name) WHERE overfit_flag
UNION ALL
SELECT DISTINCT 'underfit', config_path FROM complete JOIN paths USING (aggregate_key, metric_name) WHERE underfit_flag""")
def r25(spark, sf_dir):
    """Config paths of flagged complete records, both flags."""
    j = paired_jobs(spark, sf_dir)
    key = F.coalesce("parent_case_id", "scientific_config_id", "case_name").alias("aggregate_key")
    paths = R.generalization(j).select(key, "metric_name", "config_path").distinct()
    records = R.aggregate_generalization(R.generalization(j), group_completion(j))
    flagged = R.complete_only(records, group_completion(j)).join(paths, ["aggregate_key", "metric_name"])
    flags = F.explode(F.array(*[F.when(F.col(f"{f}_flag"), F.lit(f)) for f in ("overfit", "underfit")])).alias("flag")
    return flagged.select(flags, "config_path").where("flag is not null").distinct()


@register("r26_metric_by_case_index", "WITH " + RUNS_SQL + """
SELECT case_index, round(te, 6) AS test_metric, split_strategy FROM merged WHERE state = 'COMPLETED' AND has_metrics
ORDER BY case_index""")
def r26(spark, sf_dir):
    j = merged_jobs(spark, sf_dir).filter((F.col("state") == "COMPLETED") & F.col("has_metrics"))
    m = F.coalesce(F.col("test")["r2"], F.col("test")["auc"])
    return j.select("case_index", F.round(m, 6).alias("test_metric"), "split_strategy").orderBy("case_index")


@register("r27_model_strategy_means", "WITH " + RUNS_SQL + """
SELECT model_type, round(avg(te) FILTER (WHERE split_strategy = 'random'), 6) AS random,
       round(avg(te) FILTER (WHERE split_strategy = 'scaffold'), 6) AS scaffold
FROM merged WHERE state = 'COMPLETED' AND has_metrics GROUP BY 1""")
def r27(spark, sf_dir):
    j = merged_jobs(spark, sf_dir).filter((F.col("state") == "COMPLETED") & F.col("has_metrics"))
    m = F.coalesce(F.col("test")["r2"], F.col("test")["auc"])
    p = j.withColumn("m", m).groupBy("model_type").pivot("split_strategy", ["random", "scaffold"]).agg(F.avg("m"))
    return p.select("model_type", F.round("random", 6).alias("random"), F.round("scaffold", 6).alias("scaffold"))


@register("r28_integrity_audit", "WITH " + RUNS_SQL + AGG_SQL + GROUP_ROWS_SQL.replace("\nper AS", "\nper_state AS").replace("FROM per GROUP", "FROM per_state GROUP") + """,
gr AS (SELECT grow.*, state FROM grow JOIN gstate USING (aggregate_key)),
modal AS (SELECT arg_max(slice_count, (c, -slice_count)) AS m FROM (SELECT slice_count, count(*) AS c FROM gr GROUP BY 1)),
a AS (SELECT count(*) AS raw_rows, count(*) FILTER (WHERE state IS DISTINCT FROM 'COMPLETED') AS bad,
             count(*) FILTER (WHERE trim(coalesce(failure_reason, '')) <> '') AS reasons FROM merged),
b AS (SELECT count(*) FILTER (WHERE state <> 'COMPLETED') AS bad, count(*) FILTER (WHERE slice_count <> completed_slices OR failed_slices <> 0
             OR slice_count <> m OR completed_slices <> m) AS uneven,
             count(*) FILTER (WHERE auc IS NULL OR NOT isfinite(auc)) AS nonfinite FROM gr, modal),
sent AS (SELECT count(*) AS n FROM runs2 WHERE event_type <> 'signup')
SELECT i.issue, CAST(i.n AS BIGINT) AS n FROM (
  SELECT unnest([
    {'issue': 'mapping_mismatch', 'n': CAST(sent.n <> raw_rows AS BIGINT)},
    {'issue': 'submitted_differ_from_planned', 'n': CAST(sent.n <> raw_rows AS BIGINT)},
    {'issue': 'expected_not_divisible_by_folds', 'n': 0},
    {'issue': 'planned_differ_from_expected', 'n': 0},
    {'issue': 'submitted_differ_from_expected', 'n': CAST(sent.n <> raw_rows AS BIGINT)},
    {'issue': 'execution_rows_differ_from_expected', 'n': 0},
    {'issue': 'group_rows_differ_from_expected', 'n': 0},
    {'issue': 'failure_reasons_present', 'n': a.reasons},
    {'issue': 'non_completed_executions', 'n': a.bad},
    {'issue': 'non_completed_groups', 'n': b.bad},
    {'issue': 'groups_without_scaler_column', 'n': 1},
    {'issue': 'executions_without_scaler_column', 'n': 0},
    {'issue': 'groups_with_missing_or_failed_slices', 'n': b.uneven},
    {'issue': 'partial_generalization_records', 'n': (SELECT count(*) FROM aggr WHERE state <> 'COMPLETED')},
    {'issue': 'non_finite_primary_metric', 'n': b.nonfinite},
    {'issue': 'failed_config_paths', 'n': a.bad},
    {'issue': 'failed_job_ids', 'n': a.bad}]) AS i FROM a, b, sent)""")
def r28(spark, sf_dir):
    """Audit of the study: jobs are the events that ran (signup never submits)."""
    rows = metric_rows(spark, sf_dir).withColumn("job_id", F.col("case_index"))
    runs = run_table(spark, sf_dir)
    groups = R.aggregate_metric_rows(rows, "aggregate_key").withColumnRenamed("group_state", "state")
    return R.integrity_audit(rows, groups, aggregated(spark, sf_dir), runs, runs.where("event_type <> 'signup'"))


@register("r29_modal_slice_count", "WITH " + RUNS_SQL + """,
g AS (SELECT scientific_config_id, count(*) AS slice_count FROM merged GROUP BY 1),
c AS (SELECT slice_count, count(*) AS n FROM g GROUP BY 1)
SELECT arg_max(slice_count, n * 100000 - slice_count) AS modal_slice_count FROM c""")
def r29(spark, sf_dir):
    g = merged_jobs(spark, sf_dir).groupBy("scientific_config_id").agg(F.count(F.lit(1)).alias("slice_count"))
    c = g.groupBy("slice_count").agg(F.count(F.lit(1)).alias("n"))
    return c.agg(F.max_by("slice_count", F.struct("n", -F.col("slice_count"))).alias("modal_slice_count"))


@register("r30_factor_counts", "WITH " + RUNS_SQL + """
SELECT model_type, scaler, split_mode, split_strategy, count(*) AS n FROM merged WHERE state = 'COMPLETED'
GROUP BY GROUPING SETS ((model_type), (scaler), (split_mode), (split_strategy))""")
def r30(spark, sf_dir):
    j = merged_jobs(spark, sf_dir).filter(F.col("state") == "COMPLETED")
    return j.sparkSession.sql("""
        SELECT model_type, scaler, split_mode, split_strategy, count(*) AS n FROM {runs}
        GROUP BY GROUPING SETS ((model_type), (scaler), (split_mode), (split_strategy))""", runs=j)


@register("j8_two_key_fallback_lookup", "WITH " + RUNS_SQL + """,
att AS (SELECT CASE WHEN case_index % 4 = 0 THEN NULL ELSE case_name END AS a_case, config_path AS a_path,
               (0, case_index) AS a_order, attempt_state AS a_state FROM runs2
        UNION ALL SELECT case_name, config_path, (1, case_index), 'COMPLETED' FROM runs2 WHERE event_type = 'error'),
by_case AS (SELECT a_case, arg_max(a_state, a_order) AS s FROM att WHERE a_case IS NOT NULL GROUP BY 1),
by_path AS (SELECT a_path, arg_max(a_state, a_order) AS s FROM att GROUP BY 1)
SELECT coalesce(c.s, p.s) AS attempt_state, count(*) AS n
FROM runs2 r LEFT JOIN by_case c ON r.case_name = c.a_case LEFT JOIN by_path p ON r.config_path = p.a_path GROUP BY 1""")
def j8(spark, sf_dir):
    """Attempts are found by case id, else by config path; the last attempt
    (retries appended later) wins -- ``max_by`` per key, two left joins."""
    r = run_table(spark, sf_dir)
    att = r.select(F.when(F.col("case_index") % 4 == 0, F.lit(None)).otherwise(F.col("case_name")).alias("a_case"),
                   F.col("config_path").alias("a_path"), F.struct(F.lit(0), F.col("case_index")).alias("a_order"),
                   F.col("attempt_state").alias("a_state")).unionByName(
        r.filter(F.col("event_type") == "error").select(F.col("case_name").alias("a_case"), F.col("config_path").alias("a_path"),
                                                         F.struct(F.lit(1), F.col("case_index")).alias("a_order"),
                                                         F.lit("COMPLETED").alias("a_state")))
    by_case = att.filter(F.col("a_case").isNotNull()).groupBy("a_case").agg(F.max_by("a_state", "a_order").alias("sc"))
    by_path = att.groupBy("a_path").agg(F.max_by("a_state", "a_order").alias("sp"))
    j = r.join(by_case, r["case_name"] == by_case["a_case"], "left").join(by_path, r["config_path"] == by_path["a_path"], "left")
    return j.groupBy(F.coalesce("sc", "sp").alias("attempt_state")).agg(F.count(F.lit(1)).alias("n"))


@register("j9_positional_zip", "WITH " + RUNS_SQL + """,
ids AS (SELECT 'job_' || CAST(case_index * 7 AS VARCHAR) AS job_id, row_number() OVER (ORDER BY case_index) AS pos
        FROM runs WHERE event_type <> 'signup'),
man AS (SELECT case_name, row_number() OVER (ORDER BY case_index) AS pos FROM runs WHERE status IS NOT NULL)
SELECT count(ids.job_id) AS n_zipped, count(*) - count(ids.job_id) AS n_manifest_without_job,
       (SELECT count(*) FROM ids) <> (SELECT count(*) FROM man) AS count_mismatch
FROM man LEFT JOIN ids ON man.pos = ids.pos""")
def j9(spark, sf_dir):
    """i-th job id <-> i-th valid manifest row: skew-safe positions on both
    sides, equi-join on position."""
    r = run_table(spark, sf_dir).withColumn("__all", F.lit(0))
    ids = rank_within_key(r.filter(F.col("event_type") != "signup"), "__all", "case_index", out="pos").select(
        F.concat(F.lit("job_"), (F.col("case_index") * 7).cast("string")).alias("job_id"), "pos")
    man = rank_within_key(r.filter(F.col("status").isNotNull()), "__all", "case_index", out="pos").select("case_name", "pos")
    z = man.join(ids, "pos", "left")
    n_ids = ids.agg(F.count(F.lit(1)).alias("a"))
    n_man = man.agg(F.count(F.lit(1)).alias("b"))
    res = z.agg(F.count("job_id").alias("n_zipped"), (F.count(F.lit(1)) - F.count("job_id")).alias("n_manifest_without_job"))
    return res.join(n_ids, how="inner").join(n_man, how="inner").select(
        "n_zipped", "n_manifest_without_job", (F.col("a") != F.col("b")).alias("count_mismatch"))


@register("j10_j11_run_metrics_lookup", "WITH " + RUNS_SQL + """
SELECT job_state AS state, job_reason AS failure_reason, count(*) AS n FROM jobs GROUP BY ALL""")
def j10(spark, sf_dir):
    """Runs left-joined to their metric documents by (run_dir, model type)
    (J10); COMPLETED runs without one become PARTIAL ``missing_metrics`` (J11)."""
    j = merged_jobs(spark, sf_dir)
    docs = j.filter("has_metrics").select("run_dir", "model_type", F.lit(True).alias("__doc"))
    looked = j.join(docs, ["run_dir", "model_type"], "left")
    marked = R.mark_missing_metrics(looked, F.col("__doc").isNotNull(), F.col("__doc").isNotNull())
    return marked.groupBy("state", "failure_reason").agg(F.count(F.lit(1)).alias("n"))


@register("j16_success_skip_resume", "WITH " + RUNS_SQL + """
SELECT CASE WHEN status = 'success' THEN 'SKIPPED' ELSE 'RUN' END AS action,
       CASE WHEN status = 'success' THEN 'already_successful' END AS reason, count(*) AS n FROM runs GROUP BY ALL""")
def j16(spark, sf_dir):
    r = run_table(spark, sf_dir)
    status = r.select("case_name", "status")
    j = r.select("case_name").join(status, "case_name", "left")
    ok = F.col("status") == "success"
    return j.groupBy(F.when(ok, "SKIPPED").otherwise("RUN").alias("action"),
                     F.when(ok, "already_successful").alias("reason")).agg(F.count(F.lit(1)).alias("n"))
