"""Pairwise-complete Pearson correlations of many columns in one scan.

Each task multiplies its Arrow batches block by block: for the columns X of a
block pair with missing cells as zero and M their presence, X'X, X'M, (X*X)'M
and M'M hold every sum that r needs over the rows where both columns are
present.  Where a batch has no missing cell in the two blocks, the last three
are one number and four vectors.  The blocks are summed in two rounds (by block
and salt, then by block), a partition at a time, and r is taken per block, so
neither a plan nor a task grows with the number of pairs.

Values are shifted before they are squared, by ``shift`` or else by the medians
of up to 1,000 rows; r does not depend on it but for rounding.  Pairs with fewer
than two common rows or a constant side have a null r, as has a pair whose
spread is under 1e-13 of its squares; NaN counts as missing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import import_in_workers

BLOCK = 256
CELLS = 1 << 21  # of a batch, multiplied at once
SUMS = "bi int, bj int, n long, lines array<double>, products array<double>, partial array<double>"


class _Sums:
    """Sums of one block pair: rows and columns present, their products."""

    def __init__(self, a: int, b: int):
        self.n, self.lines = 0, np.zeros(2 * (a + b))  # sums and squares of complete batches, per side
        self.products = np.zeros((a, b))
        self.partial: np.ndarray | None = None  # counts, sums and squares by side, of the other batches

    def add(self, x: np.ndarray, y: np.ndarray, mx: np.ndarray, my: np.ndarray, complete: bool) -> None:
        self.products += x.T @ y
        if complete:
            self.n += len(x)
            self.lines += np.concatenate([x.sum(0), y.sum(0), (x * x).sum(0), (y * y).sum(0)])
            return
        if self.partial is None:
            self.partial = np.zeros((5, *self.products.shape))
        mx, my = mx.astype(float), my.astype(float)
        for i, (left, right) in enumerate(((mx, my), (x, my), (mx, y), (x * x, my), (mx, y * y))):
            self.partial[i] += left.T @ right

    def merge(self, n: int, lines: np.ndarray, products: np.ndarray, partial: np.ndarray) -> None:
        self.n += n
        self.lines += lines
        self.products += products.reshape(self.products.shape)
        if len(partial):
            if self.partial is None:
                self.partial = np.zeros((5, *self.products.shape))
            self.partial += partial.reshape(self.partial.shape)

    def pearson(self) -> np.ndarray:
        a, b = self.products.shape
        n, sx, sy, qx, qy = (self.partial if self.partial is not None else np.zeros((5, a, b))).copy()
        lx, ly, l2x, l2y = np.split(self.lines, [a, a + b, 2 * a + b])
        n += self.n
        sx, sy, qx, qy = sx + lx[:, None], sy + ly, qx + l2x[:, None], qy + l2y
        vx, vy = n * qx - sx * sx, n * qy - sy * sy
        known = (n > 1) & (vx > 1e-13 * n * qx) & (vy > 1e-13 * n * qy)
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where(known, (n * self.products - sx * sy) / (np.sqrt(vx) * np.sqrt(vy)), np.nan)


def _emit(sums: dict[tuple[int, int], _Sums]):
    doubles = lambda x: pa.array([x.ravel() if x is not None else []], pa.list_(pa.float64()))
    for (bi, bj), s in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([bi], pa.int32()), pa.array([bj], pa.int32()), pa.array([s.n], pa.int64()), doubles(s.lines), doubles(s.products), doubles(s.partial)],
            ["bi", "bj", "n", "lines", "products", "partial"],
        )


def correlations(df: DataFrame, cols: list[str], shift: list[float] | None = None, block: int = BLOCK) -> DataFrame:
    """(i, j, r) for all i < j, positions in ``cols``; r is null where undefined."""
    spark, d = df.sparkSession, len(cols)
    import_in_workers(spark)
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
    if d < 2:
        return spark.createDataFrame([], "i int, j int, r double")
    if shift is None:
        head = np.array([[np.nan if x is None else x for x in r] for r in values.limit(1000).collect()], float).reshape(-1, d)
        with np.errstate(all="ignore"):
            shift = [float(np.median(x)) if len(x) else 0.0 for x in (c[np.isfinite(c)] for c in head.T)]
    centre = np.array([x if x is not None and np.isfinite(x) else 0.0 for x in shift])
    edges = [(i, min(i + block, d)) for i in range(0, d, block)]
    pairs = [(i, j) for j in range(len(edges)) for i in range(j + 1)]
    width = [hi - lo for lo, hi in edges]

    def multiply(batches):
        sums: dict[tuple[int, int], _Sums] = {}
        for whole in batches:
            step = max(1, CELLS // d)
            for start in range(0, len(whole), step):
                b = whole.slice(start, step)
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in b.columns])
                m = ~np.isnan(x)
                x = np.where(m, x - centre, 0.0)
                full = [bool(m[:, lo:hi].all()) for lo, hi in edges]
                for i, j in pairs:
                    if (i, j) not in sums:
                        sums[i, j] = _Sums(width[i], width[j])
                    (a, b_), (c, e) = edges[i], edges[j]
                    sums[i, j].add(x[:, a:b_], x[:, c:e], m[:, a:b_], m[:, c:e], full[i] and full[j])
        yield from _emit(sums)

    def total(batches, last):
        sums: dict[tuple[int, int], _Sums] = {}
        for b in batches:
            for r in range(len(b)):
                key = (b.column(0)[r].as_py(), b.column(1)[r].as_py())
                lists = [b.column(c)[r].values.to_numpy(zero_copy_only=False) for c in (3, 4, 5)]
                if key not in sums:
                    sums[key] = _Sums(width[key[0]], width[key[1]])
                sums[key].merge(b.column(2)[r].as_py(), *lists)
        if not last:
            yield from _emit(sums)
            return
        for (bi, bj), s in sums.items():
            r = s.pearson()
            at = np.triu_indices(len(r), 1) if bi == bj else tuple(x.ravel() for x in np.indices(r.shape))
            i, j, r = (at[0] + edges[bi][0]).astype(np.int32), (at[1] + edges[bj][0]).astype(np.int32), r[at]
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(r, mask=np.isnan(r))], ["i", "j", "r"])

    parts = values.mapInArrow(multiply, SUMS)
    salted = parts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(64)))
    parts = salted.repartition(min(8 * len(pairs), 4096), "bi", "bj", "salt").drop("salt").mapInArrow(lambda x: total(x, False), SUMS)
    return parts.repartition(min(len(pairs), 4096), "bi", "bj").mapInArrow(lambda x: total(x, True), "i int, j int, r double")
