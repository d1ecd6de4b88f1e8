"""Benchmark: headline queries, one per operator family, at $BENCH_SF_DIR
(default /root/testdata/sf0.1) on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (no collect to the
driver) after one warm-up query.  The same queries' DuckDB oracle SQL is
timed on the same parquet files as the single-node reference point

Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "flagship_curate_split_summary",
    "d1_keep_first",
    "d2_drop_conflicts",
    "d3_majority",
    "t1_random_holdout",
    "t5_repeated_kfold",
    "t7_group_greedy_holdout",
    "t8_group_kfold",
    "x1_robust_scale_fit",
    "x7_x8_train_only_fit_transform",
    "h1_mann_whitney_u",
    "h2_student_t_test",
    "h11_histograms",
    "h12_correlation_matrix",
    "k1_k2_auroc_average_precision",
    "k4_r2_mae",
    "v4_hashed_text_fingerprint",
    "v12_similarity_neighbours_top5",
    "r14_j17_aggregated_gap",
    "r19_group_aggregate_of_runs",
    "g3_g4_g12_case_table",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from tessera.plans import ORACLES, QUERIES, load_all
    from tessera.session import local_session

    load_all()
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="tessera-bench")
    # Warm-up (untimed): JVM JIT and codegen on the smallest scale factor.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in ("flagship_curate_split_summary", "k1_k2_auroc_average_precision"):
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    spark.read.parquet(os.path.join(sf_dir, "region.parquet")).write.format("noop").mode("overwrite").save()
    names = only or HEADLINE
    timings: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        t0 = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # report, keep going
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    duck: dict[str, float] = {}
    try:
        import duckdb

        from tessera.sources.tables import TABLES
        con = duckdb.connect()
        con.execute(f"SET threads TO {int(cpus)}")
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        import threading
        limit = float(os.environ.get("BENCH_DUCKDB_TIMEOUT", "30"))
        for name in names:
            if name in ORACLES:
                timer = threading.Timer(limit, con.interrupt)
                t0 = time.perf_counter()
                timer.start()
                try:
                    con.execute(ORACLES[name]).fetchall()
                    duck[name] = round(time.perf_counter() - t0, 3)
                except Exception:  # interrupted: record as "> limit"
                    duck[name] = f">{limit:g}"
                finally:
                    timer.cancel()
    except Exception as exc:  # the baseline is informative only
        errors["duckdb"] = str(exc)[:200]
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "duckdb_oracle_sec": duck,
        "duckdb_total_sec": round(sum(v for k, v in duck.items() if k in timings and isinstance(v, float)), 3),
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
