"""Similarity of sets (V10-V12): a stated query set against all rows, and a
table with itself.

``overlap_counts`` reads the queries in blocks of at most ``block_bits`` (query,
bit) pairs; a block's inverted index (bit -> queries) goes to the tasks, and each
Arrow batch of rows counts its hits there, in slices of at most ``BLOCK_PAIRS``
pairs.  Neither side is exploded or
shuffled, and a query set of any size takes the same way, in more passes.

``similarity_join`` is exact and has no all-pairs way:

1. Sets are written as short byte strings (a bitmap or a list of their bits,
   whichever is shorter), and equal sets are folded into classes; only one row
   of a class is compared.
2. Sizes are cut into bands in which the larger is at most 1/threshold times
   the smaller, so similar sets lie in one band or in neighbours.
3. Sets of one band with similarity t or more differ in at most
   ``d = size * (1 - t) / t`` bits.  The bits are cut into d + m parts, so at
   least m parts are equal: sets meet by the hash of a part, and pairs that met
   m times are candidates (m is 1 for small sets and at most ``MOST_SHARED``).
4. Candidates are compared in full, once a pair, on the byte strings.

A part holds about t / (1 - t) bits, so parts tell sets apart well for high
thresholds and less for low ones; the candidates are returned.  Hot parts (the
empty one of small sets) are left to the adaptive skew join; no list of a part
is gathered in one row or task.

Parts do not tell sets apart that hold most of the bits there are, and near
copies meet once per part.  Few sets are compared sooner than their parts are
dealt out.  So a band is compared in blocks where that costs less: each pair of
blocks is one group, a product of two 0/1 matrices.  That is all pairs of the
band, in bounded memory.  For bands too large to decide by their number of sets,
every eighth part is counted first.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import import_in_workers, written

BLOCK_PAIRS = 500_000  # (query, row) pairs that a task holds at once

# costs, in pairs of a block
SIGNATURE_COST = 250  # of a part's hash: made, dealt out and sorted, about 100 by time; the rest is for its disk
MEETING_COST = 50  # of two sets that meet in a part
COUNTED_PARTS = 8  # one part in so many is counted to choose
MOST_SHARED = 4  # parts that candidates share at least, in large sets
WIDEST = 1 << 14  # bits of a set that is compared in blocks
BLOCK_VALUES = 1 << 21  # of a tile's matrix
BLOCK_TILES = 32  # of a block


def _query_blocks(queries: DataFrame, q_id: str, bits: str, block_bits: int) -> Iterator[list[tuple[int, list[int]]]]:
    block, size = [], 0
    for r in queries.select(F.col(q_id).alias("q"), F.col(bits).alias("b")).toLocalIterator():
        if r.b and block and size + len(r.b) > block_bits:
            yield block
            block, size = [], 0
        if r.b:
            block.append((r.q, r.b))
            size += len(r.b)
    if block:
        yield block


def _count_block(block: list[tuple[int, list[int]]], corpus: DataFrame, q_id: str, c_id: str, bits: str, top_k: int | None) -> DataFrame:
    q_ids = np.array([q for q, _ in block], np.int64)
    q_sizes = np.array([len(b) for _, b in block], np.int64)
    members = np.repeat(np.arange(len(block)), q_sizes)
    flat = np.concatenate([np.array(b, np.int64) for _, b in block])
    order = np.argsort(flat, kind="stable")
    members, used = members[order], flat[order]
    offsets = np.searchsorted(used, np.arange(int(used[-1]) + 2))  # bits are numbered from 0
    n_q, n_bits = len(block), len(offsets) - 1
    rows = max(1, BLOCK_PAIRS // n_q)

    def count(batches):
        best = np.zeros((n_q, top_k or 0))  # the k best of the task so far, per query, worst first
        for pdf in (whole.iloc[s : s + rows] for whole in batches for s in range(0, len(whole), rows)):
            sizes = pdf[bits].map(lambda b: 0 if b is None else len(b)).to_numpy(np.int64)
            if not sizes.sum():
                continue
            row = np.repeat(np.arange(len(pdf)), sizes)
            bit = np.concatenate([np.asarray(b, np.int64) for b in pdf[bits] if b is not None])
            row, bit = row[bit < n_bits], bit[bit < n_bits]
            out_q, out_r, out_n = [], [], []
            for r in np.unique(row):  # one dense count of the queries a row
                b = bit[np.searchsorted(row, r) : np.searchsorted(row, r, side="right")]
                lo, n = offsets[b], offsets[b + 1] - offsets[b]
                if n.sum():
                    at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
                    hits = np.bincount(members[at], minlength=n_q)
                    held = np.flatnonzero(hits)
                    out_q.append(held)
                    out_r.append(np.full(len(held), r))
                    out_n.append(hits[held])
            if not out_q:
                continue
            q, r, n = (np.concatenate(x) for x in (out_q, out_r, out_n))
            size = sizes[r]
            if top_k is not None:
                score = n / (q_sizes[q] + size - n)
                held = score >= best[q, 0]
                q, r, n, size, score = q[held], r[held], n[held], size[held], score[held]
                for i in np.unique(q):
                    best[i] = np.sort(np.concatenate([best[i], score[q == i]]))[-top_k:]
                held = score >= best[q, 0]  # ties included
                q, r, n, size = q[held], r[held], n[held], size[held]
            yield pd.DataFrame({q_id: q_ids[q], c_id: pdf[c_id].to_numpy()[r], "c": n, "a": q_sizes[q], "b": size})

    schema = f"{q_id} long, {c_id} long, c long, a long, b long"
    return corpus.select(F.col(c_id).cast("long").alias(c_id), bits).where(F.col(c_id).isNotNull()).mapInPandas(count, schema)


def overlap_counts(queries: DataFrame, corpus: DataFrame, q_id: str, c_id: str, bits: str = "bits", top_k: int | None = None, block_bits: int = 2_000_000) -> DataFrame:
    """(q_id, c_id, c, a, b): common bits and sizes of every (query, row) that
    share a bit.  With ``top_k`` a task leaves out pairs whose Tanimoto
    similarity is under its k-th best for the query so far (ties stay), so the
    k best of all rows are among those returned.  Null and empty sets share
    nothing; rows without an id are left out."""
    out = None
    for block in _query_blocks(queries.where(F.col(q_id).isNotNull()), q_id, bits, block_bits):
        found = _count_block(block, corpus, q_id, c_id, bits, top_k)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else queries.sparkSession.createDataFrame([], f"{q_id} long, {c_id} long, c long, a long, b long")


# ---------------------------------------------------------------- self-join


def size_bands(threshold: float, largest: int) -> list[tuple[int, int]]:
    """[lo, hi] bands from 1; hi is the largest size similar to lo."""
    bands, lo = [], 1
    while lo <= largest:
        hi = max(lo, math.floor(lo / threshold + 1e-9))
        bands.append((lo, hi))
        lo = hi + 1
    return bands


def _differing(threshold: float, hi: int) -> int:
    """Bits in which similar sets differ at most, the smaller of at most ``hi`` bits."""
    return math.floor(hi * (1 - threshold) / threshold + 1e-9)


def _shared(threshold: float, hi: int) -> int:
    """Parts that similar sets share at least."""
    return min(MOST_SHARED, 1 + _differing(threshold, hi) // 16)


def _parts(threshold: float, hi: int) -> int:
    return _differing(threshold, hi) + _shared(threshold, hi)


# A set as bytes, the same for equal sets: the kind, then its bits as 32-bit or
# 16-bit numbers in order, or as a bitmap up to the last bit.
NUMBERS, SHORTS, BITMAP = 0, 1, 2


def encode_set(bits: np.ndarray) -> tuple[int, bytes]:
    """(size, code) of a set that is not empty; repeated bits count once."""
    if bits.min() < 0 or bits.max() > 0xFFFF:
        bits = np.unique(bits)
        return len(bits), b"\0" + bits.astype("<i4").tobytes()
    on = np.zeros(int(bits.max()) + 1, np.uint8)
    on[bits] = 1
    size = int(np.count_nonzero(on))
    if 2 * size <= -(-len(on) // 8):
        return size, b"\1" + np.flatnonzero(on).astype("<u2").tobytes()
    return size, b"\2" + np.packbits(on, bitorder="little").tobytes()


def decode_set(code: bytes) -> np.ndarray:
    if code[0] == BITMAP:
        return np.flatnonzero(np.unpackbits(np.frombuffer(code, np.uint8, offset=1), bitorder="little"))
    return np.frombuffer(code, "<i4" if code[0] == NUMBERS else "<u2", offset=1).astype(np.int64)


def common_bits(x: bytes, y: bytes) -> int:
    if x[0] == y[0] == BITMAP:
        return (int.from_bytes(x[1:], "little") & int.from_bytes(y[1:], "little")).bit_count()
    return len(np.intersect1d(decode_set(x), decode_set(y), assume_unique=True))


def _encoded(rows: DataFrame, id_col: str, bits: str) -> DataFrame:
    """(id, size, code, first, last) of the rows that have an id and a set."""

    def run(batches):
        for b in batches:
            sets, ids = b.column("bits"), b.column("id").to_numpy()
            held = np.flatnonzero(pc.fill_null(pc.list_value_length(sets), 0).to_numpy(zero_copy_only=False))
            if not len(held):
                continue
            values, at = sets.values.to_numpy(zero_copy_only=False), sets.offsets.to_numpy()
            made = [encode_set(values[at[k] : at[k + 1]]) for k in held]
            first, last = ([int(f(values[at[k] : at[k + 1]])) for k in held] for f in (np.min, np.max))
            columns = [pa.array(ids[held]), pa.array([n for n, _ in made], pa.int32()), pa.array([c for _, c in made], pa.binary()), pa.array(first, pa.int32()), pa.array(last, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "size", "code", "first", "last"])

    sets = rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(bits).cast("array<int>").alias("bits"))
    return sets.where(F.col("id").isNotNull()).mapInArrow(run, "id long, size int, code binary, first int, last int")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def part_hashes(sizes: np.ndarray, bits: np.ndarray, n_parts: np.ndarray) -> np.ndarray:
    """One hash per (set, part), sets one after the other: the sum of its bits' hashes."""
    first = np.cumsum(n_parts) - n_parts
    out = np.zeros(int(n_parts.sum()), np.uint64)
    of = np.repeat(np.arange(len(sizes)), sizes)
    mixed = _mix(bits.astype(np.uint64))
    np.add.at(out, first[of] + (mixed >> np.uint64(8)).astype(np.int64) % n_parts[of], mixed)
    return out.view(np.int64)


def _signatures(reps: DataFrame, threshold: float, bands: list[tuple[int, int]], chosen: list[int], every: int = 1) -> DataFrame:
    """(key, id, size, band, upper) of the chosen bands: a set is in its own band
    and, as the larger side, in the one below.  A key for each part, of one part
    in ``every``; it mixes the band, the part and the hash of its bits."""
    tops = np.array([hi for _, hi in bands])
    parts = np.array([_parts(threshold, hi) for _, hi in bands])
    use = np.isin(np.arange(len(bands)), chosen)

    def run(batches):
        for whole in batches:
            for start in range(0, len(whole), 1_000):
                b = whole.slice(start, 1_000)
                sizes, ids = b.column("size").to_numpy().astype(np.int64), b.column("id").to_numpy()
                bits = np.concatenate([decode_set(c) for c in b.column("code").to_pylist()])
                own = np.searchsorted(tops, sizes)
                for upper in (False, True):
                    band = own - upper
                    held = (band >= 0) & use[np.maximum(band, 0)]
                    n = np.where(held, parts[np.maximum(band, 0)], 0)
                    hashes = part_hashes(np.where(held, sizes, 0), bits[np.repeat(held, sizes)], n)
                    of = np.repeat(np.arange(len(sizes)), n)
                    part = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                    if every > 1:
                        kept = part % every == 0
                        hashes, of, part = hashes[kept], of[kept], part[kept]
                    key = _mix(hashes.view(np.uint64) ^ _mix((band[of].astype(np.uint64) << np.uint64(32)) | part.astype(np.uint64))).view(np.int64)
                    for s in range(0, len(of), 100_000):
                        o = of[s : s + 100_000]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(key[s : s + 100_000]), pa.array(ids[o]), pa.array(sizes[o].astype(np.int32)), pa.array(band[o].astype(np.int32)), pa.array(np.full(len(o), upper))],
                            ["key", "id", "size", "band", "upper"],
                        )

    rows = reps.where(_band(bands, F.col("size")).isin(sorted({*chosen, *(k + 1 for k in chosen)})))
    return rows.select("id", "size", "code").mapInArrow(run, "key long, id long, size int, band int, upper boolean")


def _band(bands: list[tuple[int, int]], size: Column) -> Column:
    return F.size(F.filter(F.lit([hi for _, hi in bands]), lambda hi: hi < size))


def _block_bands(reps: DataFrame, threshold: float, bands: list[tuple[int, int]], sets_in: list[int]) -> set[int]:
    """The bands to compare in blocks: by their number of sets, or else by how often
    their sets would meet in parts."""
    sides = list(zip(sets_in, [*sets_in[1:], 0]))
    pairs = [n * (n - 1) // 2 + n * above for n, above in sides]
    dealt = [(n + above) * _parts(threshold, hi) * SIGNATURE_COST for (n, above), (_, hi) in zip(sides, bands)]
    blocks = {k for k in range(len(bands)) if pairs[k] <= dealt[k]}
    large = [k for k in range(len(bands)) if k not in blocks]
    if not large:
        return blocks
    counted = _signatures(reps, threshold, bands, large, COUNTED_PARTS).groupBy("band", "key")
    counted = counted.agg(F.count_if(~F.col("upper")).cast("double").alias("low"), F.count_if("upper").alias("high"))
    met = counted.groupBy("band").agg(F.sum(F.col("low") * ((F.col("low") - 1) / 2 + F.col("high"))).alias("n")).collect()  # a row per band
    for r in met:
        n_parts = _parts(threshold, bands[r.band][1])
        if dealt[r.band] + r.n * n_parts / math.ceil(n_parts / COUNTED_PARTS) * MEETING_COST > pairs[r.band]:
            blocks.add(r.band)
    return blocks


def _block_pairs(reps: DataFrame, threshold: float, bands: list[tuple[int, int]], sets_in: list[int], chosen: set[int], width: int) -> DataFrame:
    """(a_id, b_id, a, b, c) of the chosen bands: all pairs similar up to rounding.

    A band's sets are cut into blocks by hash.  Group (band, i, j) holds blocks i
    and j of the band, or, numbered on, block j of the band above.  A group is
    compared in tiles in order of size; tiles too far apart are left out."""
    wanted = sorted({k for k in chosen if sets_in[k]})
    tile = max(1, BLOCK_VALUES // width)
    blocks = [math.ceil(n / (BLOCK_TILES * tile)) for n in [*sets_in, 0]]
    share = threshold / (1 + threshold)
    rows = reps.select("id", "size", "code", _band(bands, F.col("size")).alias("band"))
    rows = rows.select("*", F.pmod(F.xxhash64("id", "code"), F.greatest(F.get(F.lit(blocks), F.col("band")), F.lit(1))).cast("int").alias("own"))
    n_of = lambda band: F.get(F.lit(blocks), band)
    low = rows.where(F.col("band").isin(wanted)).select("band", "own", "id", "size", "code", F.explode(F.sequence(F.lit(0), n_of(F.col("band")) + n_of(F.col("band") + 1) - 1)).alias("other"))
    high = rows.where((F.col("band") - 1).isin(wanted)).withColumn("band", F.col("band") - 1).select("band", (n_of(F.col("band")) + F.col("own")).alias("own"), "id", "size", "code", F.explode(F.sequence(F.lit(0), n_of(F.col("band")) - 1)).alias("other"))
    grouped = low.unionByName(high).select("band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "size", "code")

    def compare(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i, j = key[1].as_py(), key[2].as_py()
        b = pa.Table.from_batches(batches)
        own, ids, sizes = (b.column(c).to_numpy() for c in ("own", "id", "size"))
        sizes = sizes.astype(np.int64)
        bitmaps = np.zeros((len(own), width // 8), np.uint8)
        for row, code in enumerate(b.column("code").to_pylist()):
            if code[0] != BITMAP:
                code = b"\2" + np.packbits(np.bincount(decode_set(code)).astype(np.uint8), bitorder="little").tobytes()
            bitmaps[row, : len(code) - 1] = np.frombuffer(code, np.uint8, offset=1)

        def side(n):
            at = np.flatnonzero(own == n)
            at = at[np.argsort(sizes[at], kind="stable")]
            return ids[at], sizes[at], bitmaps[at]

        def ones(maps):
            return np.unpackbits(maps, axis=1).astype(np.float32)

        x_id, x_size, x_maps = side(i)
        y_id, y_size, y_maps = (x_id, x_size, x_maps) if i == j else side(j)
        for s in range(0, len(x_id), tile):
            x, nx = ones(x_maps[s : s + tile]), x_size[s : s + tile]
            for e in range(s if i == j else 0, len(y_id), tile):
                ny = y_size[e : e + tile]
                if min(nx[-1], ny[-1]) < threshold * max(nx[0], ny[0]) - 1e-9:
                    continue
                product = x @ ones(y_maps[e : e + tile]).T
                x_need, y_need = (share * nx).astype(np.float32), (share * ny).astype(np.float32) - np.float32(0.01)
                for r in range(0, len(x), 256):
                    common = product[r : r + 256]
                    p, q = np.nonzero(common >= x_need[r : r + 256, None] + y_need)
                    c, p, q = common[p, q].astype(np.int64), p + s + r, q + e
                    if i == j:
                        above = q > p
                        c, p, q = c[above], p[above], q[above]
                    if len(p):
                        swap = x_id[p] > y_id[q]
                        columns = [np.where(swap, v, u) for u, v in ((x_id[p], y_id[q]), (y_id[q], x_id[p]), (x_size[p], y_size[q]), (y_size[q], x_size[p]))]
                        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (*columns, c)], ["a_id", "b_id", "a", "b", "c"])

    return grouped.groupBy("band", "i", "j").applyInArrow(compare, "a_id long, b_id long, a long, b long, c long").where("a_id < b_id")


def _candidates(reps: DataFrame, threshold: float, bands: list[tuple[int, int]], chosen: list[int]) -> DataFrame:
    """(a_id, b_id): pairs that share as many parts as similar ones do at least."""
    sides = _signatures(reps, threshold, bands, chosen)
    low, high = (sides.select("key", *[F.col(c).alias(c + n) for c in ("id", "size", "band", "upper")]) for n in ("_x", "_y"))
    # each condition is on both sides, so that both read the same exchange
    meet = F.when(F.col("upper_y"), ~F.col("upper_x")).otherwise(~F.col("upper_x") & (F.col("id_x") < F.col("id_y")))
    met = low.join(high, "key").where(meet & (F.least("size_x", "size_y") >= threshold * F.greatest("size_x", "size_y") - 1e-9))
    needed = F.get(F.lit([_shared(threshold, hi) for _, hi in bands]), F.least("band_x", "band_y"))
    met = met.groupBy(F.least("id_x", "id_y").alias("a_id"), F.greatest("id_x", "id_y").alias("b_id"), needed.alias("needed")).agg(F.count(F.lit(1)).alias("n"))
    return met.where("n >= needed").select("a_id", "b_id").distinct()


def _compared(candidates: DataFrame, reps: DataFrame) -> DataFrame:
    """(a_id, b_id, a, b, c) of the candidates."""

    def run(batches):
        for b in batches:
            common = [common_bits(x, y) for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist())]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in ("a_id", "b_id", "a", "b")), pa.array(common, pa.int64())], ["a_id", "b_id", "a", "b", "c"])

    left, right = (reps.select(F.col("id").alias(f"{n}_id"), F.col("size").cast("long").alias(n), F.col("code").alias(v)) for n, v in (("a", "x"), ("b", "y")))
    found = candidates.join(left, "a_id").join(right, "b_id").select("a_id", "b_id", "a", "b", "x", "y")
    return found.mapInArrow(run, "a_id long, b_id long, a long, b long, c long")


def similarity_join(rows: DataFrame, id_col: str, bits: str = "bits", threshold: float = 0.9) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs, members, candidates).

    ``pairs`` (a_id, b_id, a, b, c, similarity): all pairs of different sets with
    Tanimoto similarity of at least ``threshold``, by the smallest ids of their
    classes, a_id < b_id; ``members`` (id, class_id): every row with a set;
    ``candidates`` (a_id, b_id): the pairs that met in enough parts (bands compared
    in blocks are compared whole and not listed).  Null and empty
    sets are similar to nothing; repeated bits count once; rows without an id
    are left out."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be over 0 and at most 1")
    spark: SparkSession = rows.sparkSession
    import_in_workers(spark)
    sets = written(_encoded(rows, id_col, bits), "sets")  # their bits may be costly to make
    reps = written(sets.groupBy("code").agg(F.min("id").alias("id"), F.first("size").alias("size")), "set-classes")
    members = sets.join(reps.select("code", F.col("id").alias("class_id")), "code").select("id", "class_id")
    span = sets.agg(F.max("size").alias("largest"), F.min("first").alias("first"), F.max("last").alias("last")).first()
    bands = size_bands(threshold, span.largest or 0)
    blocks: set[int] = set()
    if bands and span.first >= 0 and span.last < WIDEST:
        sets_in = [0] * len(bands)
        tops = [hi for _, hi in bands]
        for r in reps.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect():  # a row per size, at most WIDEST
            sets_in[bisect.bisect_left(tops, r["size"])] += r["n"]
        blocks = _block_bands(reps, threshold, bands, sets_in)
    candidates = spark.createDataFrame([], "a_id long, b_id long")
    found = spark.createDataFrame([], "a_id long, b_id long, a long, b long, c long")
    if len(blocks) < len(bands):
        candidates = written(_candidates(reps, threshold, bands, [k for k in range(len(bands)) if k not in blocks]), "set-candidates")
        found = _compared(candidates, reps)
        if blocks:  # ids can have several sets, compared in blocks
            found = found.where(~_band(bands, F.least("a", "b")).isin(sorted(blocks)))
    if blocks:
        width = -(-(span.last + 1) // 8) * 8
        found = found.unionByName(_block_pairs(reps, threshold, bands, sets_in, blocks, width))
    similarity = F.col("c") / (F.col("a") + F.col("b") - F.col("c"))
    pairs = found.withColumn("similarity", similarity).where(F.col("similarity") >= threshold)
    return pairs, members, candidates
