"""RBF support vectors for classification and regression (M4).

The kernel is replaced by random Fourier features: with frequencies drawn from
N(0, 2 * gamma), the products of cos(w.x + b) approximate exp(-gamma |x - y|^2),
and the model is linear in them.  The losses are squared (squared hinge; squared
distance outside the epsilon tube), so Newton steps apply: one pass over the
stored rows gives loss, gradient and Hessian over the rows with a loss, summed
per task in Arrow batches and then in two rounds (by salt, then in one row); the
driver receives one vector of ``components`` squared and solves.  Ten or so
passes settle; a step that raises the loss is halved.

Features are standardised by the training rows; gamma defaults to one over the
number of features.  Rows with a null, NaN or infinite feature or label are left
out of the fit and get a null prediction.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import import_in_workers, written


@dataclass
class KernelSvm:
    task: str
    feature_cols: list[str]
    center: np.ndarray
    scale: np.ndarray
    frequency: np.ndarray
    phase: np.ndarray
    weight: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.cos((x - self.center) / self.scale @ self.frequency + self.phase) * np.sqrt(2 / len(self.phase))
        return np.column_stack([z, np.ones(len(z))])

    def score(self, df: DataFrame) -> DataFrame:
        """``pred_0``, or ``pred_proba`` (sigmoid of the margin), ``pred_score`` and ``pred_label``."""
        import_in_workers(df.sparkSession)
        model, cols = self, self.feature_cols
        kept = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(cols)])

        def run(batches):
            for b in batches:
                x = _matrix(b.columns[1:])
                known = np.isfinite(x).all(axis=1)
                out = np.zeros(len(x))
                out[known] = model.features(x[known]) @ model.weight
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, mask=~known)], ["row", "margin"])

        scored = kept.mapInArrow(run, T.StructType([kept.schema["row"], T.StructField("margin", T.DoubleType())]))
        m = F.col("margin")
        if self.task == "regression":
            return scored.select("row.*", m.alias("pred_0"))
        p = 1 / (1 + F.exp(-m))
        return scored.select("row.*", p.alias("pred_proba"), p.alias("pred_score"), (m >= 0).cast("int").alias("pred_label"))


def _matrix(columns) -> np.ndarray:
    return np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in columns])


def _total(parts: DataFrame) -> np.ndarray:
    """The sum of the arrays ``v`` of all rows, in two rounds."""

    def add(batches):
        total = None
        for b in batches:
            for r in range(len(b)):
                v = b.column(0)[r].values.to_numpy(zero_copy_only=False)
                total = v.copy() if total is None else total + v
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["v"])

    some = parts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(64))).repartition(64, "salt").select("v").mapInArrow(add, "v array<double>")
    return np.array(some.coalesce(1).mapInArrow(add, "v array<double>").first()["v"])


def fit_kernel_svm(train: DataFrame, feature_cols: list[str], label: str, task: str, components: int = 256, gamma: float | None = None, c: float = 1.0,
                   epsilon: float = 0.1, seed: int = 42, passes: int = 20, tolerance: float = 1e-6) -> KernelSvm:
    """SVC (labels 0 and 1) or SVR on ``train``."""
    if task not in ("classification", "regression"):
        raise ValueError(f"unknown task {task!r}")
    import_in_workers(train.sparkSession)
    d = len(feature_cols)
    rows = train.select(F.col(f"`{label}`").cast("double").alias("y"), *[F.col(f"`{x}`").cast("double").alias(f"x{i}") for i, x in enumerate(feature_cols)])
    finite = [F.col(x).isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")) for x in rows.columns]
    for held in finite:
        rows = rows.where(held)
    rows = written(rows, "svm-rows")
    stats = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"x{i}").alias(f"m{i}") for i in range(d)], *[F.stddev_pop(f"x{i}").alias(f"s{i}") for i in range(d)]).first()
    if not stats["n"]:
        raise ValueError("no complete row to fit on")
    rng = np.random.default_rng(seed)
    frequency = rng.normal(0, np.sqrt(2 * (gamma if gamma is not None else 1 / d)), (d, components))
    model = KernelSvm(task, list(feature_cols), np.array([stats[f"m{i}"] for i in range(d)]), np.array([stats[f"s{i}"] or 1.0 for i in range(d)]),
                      frequency, rng.uniform(0, 2 * np.pi, components), np.zeros(components + 1))
    k = components + 1
    ridge = np.ones(k)
    ridge[-1] = 1e-8  # the intercept

    def sums(w: np.ndarray) -> np.ndarray:
        def run(batches):
            loss, grad, hess = 0.0, np.zeros(k), np.zeros((k, k))
            for b in batches:
                for s in range(0, len(b), 4096):
                    part = b.slice(s, 4096)
                    y, z = _matrix(part.columns[:1])[:, 0], model.features(_matrix(part.columns[1:]))
                    out = z @ w
                    if task == "regression":
                        over = np.sign(out - y) * np.maximum(np.abs(out - y) - epsilon, 0)
                    else:
                        sign = np.where(y > 0.5, 1.0, -1.0)
                        over = -sign * np.maximum(1 - sign * out, 0)
                    act = over != 0
                    loss += float(over @ over)
                    grad += 2 * z[act].T @ over[act]
                    hess += 2 * z[act].T @ z[act]
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([[loss], grad, hess.ravel()])], pa.list_(pa.float64()))], ["v"])

        return _total(rows.mapInArrow(run, "v array<double>"))

    w, best, step = np.zeros(k), np.inf, None
    for _ in range(passes):
        found = sums(w)
        loss = c * found[0] + 0.5 * float(ridge * w @ w)
        if loss > best + abs(best) * 1e-12:  # too far: half of the last step
            step = step / 2
            w = w - step
            continue
        settled = best - loss < tolerance * max(abs(loss), 1.0)
        best = loss
        model.weight = w
        if settled:
            break
        grad = c * found[1 : k + 1] + ridge * w
        step = -np.linalg.solve(c * found[k + 1 :].reshape(k, k) + np.diag(ridge), grad)
        w = w + step
    return model
