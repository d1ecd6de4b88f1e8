"""Centroid clustering by scalar lookup tables (operator 12).

Components become integers, ``floor(scale * x)``, and are stored once.  In
every round each task tabulates, per dimension, the squared difference between
each integer that occurs and each centroid; the distances of its vectors are
then gathers from these tables, summed over the dimensions.  A table covers the
integers that occur in one Arrow batch, so its size is bounded by the batch
whatever the range of the values, and every (integer, centroid) pair is squared
once a batch, however many vectors share the integer.

A task sends one row per cluster and dimension (count, sum), so a round
shuffles ``tasks * k * width`` numbers; the driver receives ``k * width`` of
them and divides exactly.  All arithmetic is in integers, so neither the order
of tasks nor a repeated task changes a result.

Defined cases: a vector that is null, of another width, or holds a null, NaN
or infinite component is left out; components beyond +-2^27 after scaling
count as +-2^27, so a distance of 64 components fits 64 bits (an inertia that
does not fit is null); a null vec_id hashes as an empty id; equal start hashes
(repeated ids) go by the vectors themselves, and with fewer than k vectors
there are fewer clusters; rows that repeat come back each; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import register
from .common import documents, prepare, store

LIMIT = 1 << 27


def quantised(vectors: DataFrame, id_col: str, vec_col: str, width: int, scale: int) -> DataFrame:
    """(vec_id, q array<int>) of the vectors that count."""
    raw = F.col(f"`{vec_col}`").cast("array<double>")
    finite = F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    held = lambda x: F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), x * float(scale)))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), raw.alias("raw")).where((F.size("raw") == width) & F.coalesce(finite, F.lit(False)))
    return rows.select("vec_id", F.transform("raw", lambda x: F.floor(held(x)).cast("int")).alias("q"))


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def nearest(q: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster (ties: smallest number) and squared distance of each row of ``q``."""
    distance = np.zeros((len(q), len(centroids)), np.int64)
    for j in range(q.shape[1]):
        values, at = np.unique(q[:, j], return_inverse=True)
        table = (values.astype(np.int64)[:, None] - centroids[None, :, j]) ** 2
        distance += table[at]
    cluster = distance.argmin(axis=1)
    return cluster, distance[np.arange(len(q)), cluster]


def first_centroids(rows: DataFrame, k: int) -> np.ndarray:
    """The k vectors with the smallest hashes, in that order."""
    name = F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    top = rows.orderBy(F.sha2(name.cast("binary"), 256), "q").select("q").limit(k).collect()  # k rows
    return np.array([r.q for r in top], np.int64)


def next_centroids(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: assign every vector, then replace each centroid that has
    vectors by their componentwise floor of the mean."""
    k, width = centroids.shape

    def run(batches):
        count, total = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for b in batches:
            q = matrix(b.column("q"), width)
            cluster, _ = nearest(q, centroids)
            count += np.bincount(cluster, minlength=k)
            order = np.argsort(cluster, kind="stable")
            used, first = np.unique(cluster[order], return_index=True)
            if len(used):
                total[used] += np.add.reduceat(q[order].astype(np.int64), first, axis=0)
        for c in np.flatnonzero(count):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(width, c, np.int32)), pa.array(np.arange(width, dtype=np.int32)), pa.array(np.full(width, count[c])), pa.array(total[c])],
                ["cluster", "dim", "n", "total"],
            )

    parts = rows.select("q").mapInArrow(run, "cluster int, dim int, n long, total long")
    sums = parts.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    out = centroids.copy()
    for r in sums.collect():  # k * width rows
        out[r.cluster, r.dim] = int(r.total) // r.n
    return out


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    width = centroids.shape[1]

    def run(batches):
        for b in batches:
            cluster, distance = nearest(matrix(b.column("q"), width), centroids)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return rows.select("vec_id", "q").mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", width: int = 64, scale: int = 64, k: int = 16, rounds: int = 3) -> tuple[DataFrame, np.ndarray]:
    """Per vector: vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256; and the final centroids."""
    spark = vectors.sparkSession
    prepare(spark)
    rows, _ = store(quantised(vectors, id_col, vec_col, width, scale), "quantised")
    centroids = first_centroids(rows, k)
    if not len(centroids):
        none = spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
        return none, centroids.reshape(0, width)
    for _ in range(rounds):
        centroids = next_centroids(rows, centroids)
    out, _ = store(assigned(rows, centroids), "assigned")
    inertia = {r.cluster: r.n for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()}  # k rows
    fits = lambda n: int(n) if n < 1 << 63 else None
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = spark.createDataFrame(
        [(c, fits(n), fits(sum(inertia.values())), digest[c]) for c, n in inertia.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return out.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"), centroids


def _oracle(rounds: int = 3) -> str:
    parts = [
        r"""kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        "q AS MATERIALIZED (SELECT r, vec_id, unnest(range(64)) AS dim, CAST(floor(64 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS v FROM kept)",
        "c0 AS MATERIALIZED (SELECT cid, dim, v FROM q JOIN (SELECT r, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cid FROM kept QUALIFY cid < 16) USING (r))",
    ]
    for i in range(rounds + 1):
        parts.append(f"d{i} AS (SELECT r, cid, CAST(sum((q.v - c.v) * (q.v - c.v)) AS BIGINT) AS distance FROM q JOIN c{i} c USING (dim) GROUP BY r, cid)")
        parts.append(f"a{i} AS MATERIALIZED (SELECT r, cid, distance FROM d{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, cid) = 1)")
        if i < rounds:
            parts.append(f"m{i} AS (SELECT cid, dim, CAST(sum(v) AS BIGINT) AS s, count(*) AS n FROM q JOIN a{i} USING (r) GROUP BY cid, dim)")
            parts.append(f"c{i + 1} AS MATERIALIZED (SELECT c.cid, c.dim, coalesce((s - ((s % n) + n) % n) // n, c.v) AS v FROM c{i} c LEFT JOIN m{i} USING (cid, dim))")
    n = rounds
    return f"""WITH {", ".join(parts)},
h AS (SELECT cid, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY dim)) AS centroid_sha256 FROM c{n} GROUP BY cid)
SELECT vec_id, CAST(cid AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cid) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{n} JOIN kept USING (r) JOIN h USING (cid)"""


@register("op12_centroids", _oracle())
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(documents(spark, sf_dir, "embeddings"))[0]
