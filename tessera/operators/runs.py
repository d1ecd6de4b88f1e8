"""Run-history analytics.

Manifests, attempts, run statuses and metric documents are tables joined on
case id / run dir; every per-run rule is a column expression and every study
summary a grouped aggregate.  Lists that the reference builds per group
(failure summaries, config paths) are built from *distinct* values only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import append_reason

# Fixed values that must equal the reference's behaviour.
FAILED_STATES = ["FAILED", "CANCELLED", "TIMEOUT"]
PRIMARY_METRICS = ["r2", "auc", "auprc", "accuracy", "f1"]
OVERFIT_T = 0.15
UNDERFIT_R2 = 0.20
UNDERFIT_CLS = 0.65


def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c.cast("string")) == "")


def state_from_status(status: Column, has_status: Column, failed_node: Column, exception_type: Column):
    """R1 + R2: (state, exit_code, failure_reason) from a run-status document."""
    s = F.lower(F.trim(F.coalesce(status, F.lit(""))))
    node = F.trim(F.coalesce(failed_node, F.lit("")))
    exc = F.trim(F.coalesce(exception_type, F.lit("")))
    failed_reason = (F.when((node != "") & (exc != ""), F.concat_ws(":", node, exc))
                     .when(exc != "", exc).when(node != "", node).otherwise(F.lit("failed")))
    state = (F.when(~has_status, "UNKNOWN").when(s == "success", "COMPLETED").when(s == "failed", "FAILED")
             .when(s == "running", "RUNNING").otherwise("UNKNOWN"))
    code = F.when(has_status & (s == "success"), "0").when(has_status & (s == "failed"), "1").otherwise("")
    reason = (F.when(~has_status, "missing_run_status").when(s == "success", F.lit(None))
              .when(s == "running", "running").when(s == "failed", failed_reason)
              .otherwise(F.concat(F.lit("run_status_"), F.when(s == "", "unknown").otherwise(s))))
    return state, code, reason


def attempt_failure_reason(reason: Column, return_code: Column, state: Column) -> Column:
    """R2 (attempt side)."""
    st = F.upper(F.trim(F.coalesce(state, F.lit(""))))
    rc_nonzero = ~_blank(return_code) & (return_code.cast("string") != "0")
    return (F.when(~_blank(reason), F.trim(reason)).when(rc_nonzero, "nonzero_return_code")
            .when(st.isin(*FAILED_STATES), F.lower(st)).when(st == "DRY_RUN", "dry_run"))


def merge_state(status_state: Column, status_code: Column, status_reason: Column, has_attempt: Column,
                attempt_state: Column, attempt_rc: Column, attempt_reason: Column):
    """Failed / non-zero attempt beats the status; DRY_RUN; SKIPPED and a
    completed status -> COMPLETED; ...  Returns (state, exit_code, reason)."""
    a = F.upper(F.trim(F.coalesce(attempt_state, F.lit(""))))
    a_code = F.when(_blank(attempt_rc), F.lit("")).otherwise(attempt_rc.cast("string"))
    a_fail = attempt_failure_reason(attempt_reason, attempt_rc, attempt_state)
    rc_nonzero = ~_blank(attempt_rc) & (attempt_rc.cast("string") != "0")
    code_or = lambda x, y: F.when(x != "", x).otherwise(y)
    failed = a.isin(*FAILED_STATES) | rc_nonzero
    state = (F.when(~has_attempt, status_state).when(failed, "FAILED").when(a == "DRY_RUN", "DRY_RUN")
             .when((a == "SKIPPED") & (status_state == "COMPLETED"), "COMPLETED").when(a == "SKIPPED", "SKIPPED")
             .when((a == "COMPLETED") & status_state.isin("COMPLETED", "UNKNOWN"), "COMPLETED")
             .otherwise(status_state))
    code = (F.when(~has_attempt, status_code).when(failed, code_or(a_code, status_code)).when(a == "DRY_RUN", "")
            .when((a == "SKIPPED") & (status_state == "COMPLETED"), "0").when(a == "SKIPPED", a_code)
            .when((a == "COMPLETED") & status_state.isin("COMPLETED", "UNKNOWN"), code_or(a_code, F.lit("0")))
            .otherwise(code_or(a_code, status_code)))
    reason = (F.when(~has_attempt, status_reason).when(failed, F.coalesce(a_fail, status_reason))
              .when(a == "DRY_RUN", a_fail).when((a == "SKIPPED") & (status_state == "COMPLETED"), F.lit(None))
              .when(a == "SKIPPED", F.coalesce(a_fail, status_reason))
              .when((a == "COMPLETED") & status_state.isin("COMPLETED", "UNKNOWN"), F.lit(None))
              .when(a == "COMPLETED", status_reason).otherwise(F.coalesce(status_reason, a_fail)))
    return state, code, reason


def scheduler_failure_class(job_state: Column, step_states: Column) -> Column:
    """OOM in the job or any step, timeout, cancelled, failed_other, pending, running, other."""
    s = F.upper(F.coalesce(job_state, F.lit("")))
    oom_step = F.exists(F.coalesce(step_states, F.array().cast("array<string>")),
                        lambda x: F.upper(x).contains("OUT_OF_MEMORY"))
    return (F.when(s == "COMPLETED", F.lit(None)).when(s.contains("OUT_OF_MEMORY") | oom_step, "out_of_memory")
            .when(s.contains("TIMEOUT"), "timeout").when(s.contains("CANCELLED"), "cancelled")
            .when(s.contains("FAILED"), "failed_other").when(s.contains("PENDING"), "pending")
            .when(s.contains("RUNNING"), "running").otherwise("other"))


def case_fields(case_name: Column) -> list[Column]:
    """Profile, model, mode, strategy from ``a__b__c__d__e`` (>= 5 parts)
    and the ``case_(\\d+)`` index."""
    parts = F.split(case_name, "__")
    ok = F.size(parts) >= 5
    out = [F.when(ok, F.element_at(parts, i)).alias(n) for i, n in
           ((2, "profile"), (3, "model_type"), (4, "split_mode"), (5, "split_strategy"))]
    idx = F.regexp_extract(case_name, r"^case_(\d+)", 1)
    out.append(F.when(idx != "", idx.try_cast("long")).alias("case_index"))
    return out


def primary_metric(train: Column, test: Column) -> Column:
    """First of r2, auc, auprc, accuracy, f1 present in both maps."""
    expr = None
    for m in PRIMARY_METRICS:
        both = train.getItem(m).isNotNull() & test.getItem(m).isNotNull()
        expr = F.when(both, F.lit(m)) if expr is None else expr.when(both, F.lit(m))
    return expr


# The metrics of a run and the order in which one is primary for an audit.
METRICS = ["r2", "mae", "rmse", "mse", "auc", "auprc", "accuracy", "f1"]
AUDIT_METRICS = ["auc", "r2", "mae", "rmse", "accuracy", "f1", "auprc"]
SPLITS = ["train", "test", "val"]
METRIC_FIELDS = METRICS + [f"{split}_{m}" for m in METRICS for split in SPLITS]


def metric_rows(runs: DataFrame, top: str = "top", train: str = "train", test: str = "test", val: str = "val") -> DataFrame:
    """The 32 metric columns of every run from its metric maps.  A
    metric without a split is the top-level value, else that of test, val or
    train, whichever is the first to have it."""
    whole = [F.coalesce(*[F.col(c)[m] for c in (top, test, val, train)]).alias(m) for m in METRICS]
    parts = dict(zip(SPLITS, (train, test, val)))
    split = [F.col(parts[s])[m].alias(f"{s}_{m}") for m in METRICS for s in SPLITS]
    return runs.select(*[c for c in runs.columns if c not in METRIC_FIELDS], *whole, *split)


def aggregate_metric_rows(rows: DataFrame, key: str, state: str = "state", order: str = "case_index") -> DataFrame:
    """Per group the slice counts, the group state, and mean and
    population standard deviation of all 32 metrics over completed runs."""
    done = F.col(state) == "COMPLETED"
    used = {m: F.when(done, F.col(m)) for m in METRIC_FIELDS}
    sums = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("slice_count"),
        F.count_if(done).alias("completed_slices"),
        F.count_if(F.coalesce(~done, F.lit(True))).alias("failed_slices"),
        *[F.avg(c).alias(m) for m, c in used.items()],
        *[F.stddev_pop(c).alias(f"{m}_std") for m, c in used.items()],
    )
    return sums.join(group_state(rows, key, state, order), key)


def integrity_audit(raw: DataFrame, groups: DataFrame, records: DataFrame, manifest: DataFrame, children: DataFrame,
                    primary: str | None = None, expected_children: int | None = None,
                    expected_folds: int | None = None) -> DataFrame:
    """One row per rule, (issue, n); a study may be claimed final when
    every n is 0.

    raw: one row per execution (state, failure_reason, config_path, job_id);
    groups: ``aggregate_metric_rows``; records: aggregated generalisation
    records with their state; manifest, children: the planned cases and the
    submitted jobs.  Left unset, the expected number of executions is that of
    the manifest, the folds are the most frequent slice count (the smaller on
    ties), and the primary metric is the first that any group has."""
    bad = lambda c: F.count_if(F.coalesce(F.col(c), F.lit("")) != "COMPLETED")
    text = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != ""
    failed = F.coalesce(F.col("state"), F.lit("")) != "COMPLETED"
    has_scaler = {name: int("scaler" not in df.columns) for name, df in (("raw", raw), ("groups", groups))}
    r = raw.agg(F.count(F.lit(1)).alias("raw_rows"), bad("state").alias("raw_bad"), F.count_if(text("failure_reason")).alias("reasons"),
                F.count_if(failed & text("config_path")).alias("failed_configs"), F.count_if(failed & text("job_id")).alias("failed_jobs"))
    sizes = groups.groupBy("slice_count").agg(F.count(F.lit(1)).alias("c"))
    modal = sizes.agg(F.max_by("slice_count", F.struct(F.col("c"), -F.col("slice_count"))).alias("modal"))
    folds = F.lit(expected_folds).cast("long") if expected_folds else F.col("modal")
    present = [m for m in ([primary] if primary else AUDIT_METRICS)]
    finite = lambda m: F.col(m).isNotNull() & ~F.isnan(m) & (F.abs(m) != float("inf"))
    uneven = (F.col("slice_count") != F.col("completed_slices")) | (F.col("failed_slices") != 0)
    uneven = uneven | (folds.isNotNull() & ((F.col("slice_count") != folds) | (F.col("completed_slices") != folds)))
    # one-row tables are joined without a condition
    g = groups.join(F.broadcast(modal)).agg(
        F.count(F.lit(1)).alias("group_rows"), bad("state").alias("group_bad"), F.count_if(uneven).alias("uneven"), F.first("modal").alias("modal"),
        *[F.count(m).alias(f"has_{m}") for m in present], *[F.count_if(~finite(m)).alias(f"bad_{m}") for m in present])
    one = r.join(g).join(records.agg(bad("state").alias("partial"))).join(manifest.agg(F.count(F.lit(1)).alias("planned"))) \
        .join(children.agg(F.count(F.lit(1)).alias("submitted")))
    want = F.lit(expected_children).cast("long") if expected_children is not None else F.col("planned")
    parents = F.when(want % folds == 0, (want / folds).cast("long"))
    differs = lambda a, b: F.coalesce((a != b).cast("long"), F.lit(0).cast("long"))
    nonfinite = F.coalesce(*[F.when(F.col(f"has_{m}") > 0, F.col(f"bad_{m}")) for m in present], F.lit(0))
    issues = [
        ("mapping_mismatch", differs(F.col("submitted"), F.col("raw_rows"))),
        ("submitted_differ_from_planned", differs(F.col("submitted"), F.col("planned"))),
        ("expected_not_divisible_by_folds", differs(want % folds, F.lit(0)) if expected_folds else F.lit(0)),
        ("planned_differ_from_expected", differs(F.col("planned"), want)),
        ("submitted_differ_from_expected", differs(F.col("submitted"), want)),
        ("execution_rows_differ_from_expected", differs(F.col("raw_rows"), want)),
        ("group_rows_differ_from_expected", differs(F.col("group_rows"), parents) if expected_folds else F.lit(0)),
        ("failure_reasons_present", F.col("reasons")),
        ("non_completed_executions", F.col("raw_bad")),
        ("non_completed_groups", F.col("group_bad")),
        ("groups_without_scaler_column", F.lit(has_scaler["groups"])),
        ("executions_without_scaler_column", F.lit(has_scaler["raw"])),
        ("groups_with_missing_or_failed_slices", F.col("uneven")),
        ("partial_generalization_records", F.col("partial")),
        ("non_finite_primary_metric", nonfinite),
        ("failed_config_paths", F.col("failed_configs")),
        ("failed_job_ids", F.col("failed_jobs")),
    ]
    rows = F.array(*[F.struct(F.lit(k).alias("issue"), v.cast("long").alias("n")) for k, v in issues])
    return one.select(F.explode(rows).alias("r")).select("r.issue", "r.n")


def final_claim_ready(audit: DataFrame) -> DataFrame:
    """One row: no rule of the audit found anything."""
    return audit.agg((F.sum("n") == 0).alias("final_claim_ready"))


# Step names, in the order in which they decide.
FEATURE_STEPS = ["featurize.morgan", "featurize.rdkit_labeled", "featurize.rdkit", "featurize.none"]


def feature_input(nodes: str, declared: str, model: str):
    """The first feature step of the pipeline, else the declared input,
    else what the model type implies, else ``none`` for a pipeline that
    trains.  Curated features count as no featurisation."""
    curated = F.lit("use.curated_features")
    has = lambda step: F.array_contains(nodes, step)
    steps = [F.when(has(s), F.lit(s)) for s in FEATURE_STEPS]
    input_ = F.trim(F.coalesce(F.col(declared), F.lit("")))
    return F.coalesce(
        *steps,
        F.when(has(curated), F.lit("featurize.none")),
        F.when(input_ == curated, F.lit("featurize.none")).when(input_ != "", input_),
        F.when(F.lower(F.trim(F.col(model))).isin("chemprop", "chemeleon"), F.lit("smiles_native")),
        F.when(has("train"), F.lit("none")),
    )


def factor_counts(df: DataFrame, factors: dict[str, Column], by: list[str] | None = None) -> DataFrame:
    """Rows per value of every factor (factor, value, n), in one pass; an
    absent value is ''.  ``by``: columns kept apart."""
    by = by or []
    pairs = [F.struct(F.lit(name).alias("factor"), F.coalesce(c.cast("string"), F.lit("")).alias("value")) for name, c in factors.items()]
    rows = df.select(*by, F.explode(F.array(*pairs)).alias("f")).select(*by, "f.factor", "f.value")
    return rows.groupBy(*by, "factor", "value").agg(F.count(F.lit(1)).alias("n"))


def complete_only(records: DataFrame, completion: DataFrame) -> DataFrame:
    """Aggregated records of groups of which every slice completed.
    ``completion``: (aggregate_key, slice_count, completed_slices)."""
    done = completion.where("slice_count > 0 and completed_slices = slice_count").select("aggregate_key")
    return records.join(done, "aggregate_key", "left_semi")


def generalization(df: DataFrame, train: str = "train", test: str = "test", val: str = "val") -> DataFrame:
    """Per COMPLETED run with metrics: primary metric, gap = train - test,
    overfit (gap >= 0.15) and underfit (both < 0.20 for r2, < 0.65 otherwise)."""
    m = primary_metric(F.col(train), F.col(test))
    out = df.filter(F.col("state") == "COMPLETED").withColumn("metric_name", m).filter(F.col("metric_name").isNotNull())
    tv = F.col(train)[F.col("metric_name")]
    sv = F.col(test)[F.col("metric_name")]
    vv = F.col(val)[F.col("metric_name")]
    out = out.withColumn("train_value", tv).withColumn("test_value", sv).withColumn("val_value", vv)
    out = out.withColumn("gap_train_minus_test", F.col("train_value") - F.col("test_value"))
    thr = F.when(F.col("metric_name") == "r2", F.lit(UNDERFIT_R2)).otherwise(F.lit(UNDERFIT_CLS))
    return out.withColumn("overfit_flag", F.col("gap_train_minus_test") >= OVERFIT_T).withColumn(
        "underfit_flag", (F.col("train_value") < thr) & (F.col("test_value") < thr))


def aggregate_generalization(gen: DataFrame, summary: DataFrame | None = None) -> DataFrame:
    """R14 + J17: group key = parent or scientific id or case, and metric;
    means, population std (0 for one slice), flags on the means; slices that
    completed without metrics make the group PARTIAL with
    ``missing_generalization_metrics=n``."""
    key = F.coalesce(F.col("parent_case_id"), F.col("scientific_config_id"), F.col("case_name"))
    g = gen.groupBy(key.alias("aggregate_key"), "metric_name").agg(
        F.avg("train_value").alias("train_value"), F.avg("test_value").alias("test_value"),
        F.avg("val_value").alias("val_value"), F.avg("gap_train_minus_test").alias("gap_train_minus_test"),
        F.coalesce(F.stddev_pop("gap_train_minus_test"), F.lit(0.0)).alias("gap_train_minus_test_std"),
        F.count(F.lit(1)).alias("metric_slices_used"),
        F.min_by(F.col("case_name"), F.struct(F.col("case_index").isNull().alias("none"), F.col("case_index"), F.col("case_name")))
        .alias("case_name"))
    if summary is not None:
        g = g.join(summary, "aggregate_key", "left")
    else:
        g = g.withColumn("slice_count", F.lit(None).cast("long")).withColumn("completed_slices", F.lit(None).cast("long"))
    slice_count = F.greatest(F.coalesce("slice_count", "metric_slices_used"), F.col("metric_slices_used"))
    completed_jobs = F.greatest(F.coalesce("completed_slices", "metric_slices_used"), F.col("metric_slices_used"))
    missing = F.greatest(completed_jobs - F.col("metric_slices_used"), F.lit(0))
    thr = F.when(F.col("metric_name") == "r2", F.lit(UNDERFIT_R2)).otherwise(F.lit(UNDERFIT_CLS))
    out = g.withColumn("slice_count", slice_count).withColumn("missing_metric_slices", missing)
    base_state = F.when(F.col("metric_slices_used") == F.col("slice_count"), "COMPLETED").otherwise("PARTIAL")
    reason = F.when(F.col("missing_metric_slices") > 0,
                    F.concat(F.lit("missing_generalization_metrics="), F.col("missing_metric_slices").cast("string")))
    return out.select(
        "aggregate_key", "metric_name", "case_name", "train_value", "test_value", "val_value", "gap_train_minus_test",
        "gap_train_minus_test_std", (F.col("gap_train_minus_test") >= OVERFIT_T).alias("overfit_flag"),
        ((F.col("train_value") < thr) & (F.col("test_value") < thr)).alias("underfit_flag"),
        F.when(F.col("missing_metric_slices") > 0, "PARTIAL").otherwise(base_state).alias("state"),
        reason.alias("failure_reason"), F.col("slice_count").cast("long").alias("slice_count"),
        F.col("metric_slices_used").cast("long").alias("metric_slices_used"),
        F.greatest(F.col("slice_count") - F.col("metric_slices_used"), F.lit(0)).cast("long").alias("failed_slices"))


def mark_missing_metrics(jobs: DataFrame, has_metrics: Column, has_split_metrics: Column) -> DataFrame:
    """COMPLETED without a metrics document -> PARTIAL ``missing_metrics``;
    without split metrics -> PARTIAL ``missing_split_metrics``."""
    done = F.col("state") == "COMPLETED"
    out = jobs.withColumn("__mm", done & ~has_metrics).withColumn("__ms", done & has_metrics & ~has_split_metrics)
    out = out.withColumn("failure_reason", F.when(F.col("__mm"), append_reason("failure_reason", "missing_metrics"))
                         .when(F.col("__ms"), append_reason("failure_reason", "missing_split_metrics"))
                         .otherwise(F.col("failure_reason")))
    return out.withColumn("state", F.when(F.col("__mm") | F.col("__ms"), "PARTIAL").otherwise(F.col("state"))) \
        .drop("__mm", "__ms")


def group_state(states: DataFrame, key: str, state: str = "state", order: str = "case_index") -> DataFrame:
    """All COMPLETED -> COMPLETED; some -> PARTIAL; none -> the most
    frequent state, first seen (lowest order) on ties.  Two aggregates, no
    window over a group."""
    per = states.groupBy(key, state).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    agg = per.groupBy(key).agg(
        F.sum("n").alias("total"), F.sum(F.when(F.col(state) == "COMPLETED", F.col("n")).otherwise(0)).alias("done"),
        F.max_by(F.col(state), F.struct(F.col("n"), -F.col("first"))).alias("mode_state"))
    return agg.select(key, F.when(F.col("done") == F.col("total"), "COMPLETED").when(F.col("done") > 0, "PARTIAL")
                      .otherwise(F.col("mode_state")).alias("group_state"))


def failure_summary(df: DataFrame, key: str, reason: str = "failure_reason") -> DataFrame:
    """``reason=count`` sorted by reason, comma-joined (distinct reasons
    are folded first, so the list is bounded by the distinct reasons)."""
    per = df.filter(F.col(reason).isNotNull()).groupBy(key, reason).agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(key).agg(F.concat_ws(",", F.array_sort(F.collect_list(
        F.concat(F.col(reason), F.lit("="), F.col("n").cast("string"))))).alias("failure_summary"))
