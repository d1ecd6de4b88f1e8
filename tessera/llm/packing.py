"""Best-fit packing by the linear grouping scheme (operator 10).

Documents longer than a sequence are cut into pieces of the capacity, the
first of which may be shorter.  The plan needs only the histogram of piece
lengths (at most ``capacity`` rows, whatever the corpus size):

1. large lengths (over ``capacity / large``) are sorted and split into groups
   of equal cardinality; each length is rounded up to the largest of its group;
2. with so few sizes, configurations (multisets that fit a sequence) are
   enumerated and chosen, fullest first, until the rounded pieces are used up;
3. real pieces take the places of rounded ones, which leaves some room more;
4. small pieces, longest first, go to the open sequence with the least room
   that still holds them.

The number of groups and what counts as large are chosen by the histogram:
the scheme that needs the fewest sequences wins (``best_plan``).  Every scheme has
configurations of two large pieces at least.  Groups of one rounded size are one
class, so there are at most as many classes as lengths, however fine the groups.

All steps work on runs: ranges of pieces of one length and of sequences with
equal room.  The number of runs depends on the number of distinct lengths, not
on the number of pieces.  Pieces find their run by length and rank; ranks come
from counts per (length, bucket), so a length that a third of all pieces has
is spread over the buckets.

Defined cases: a null text is empty and still has its end id; null doc_ids are
packed like others; rows that repeat a doc_id are packed once each; an empty
table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import register
from .common import documents, prepare, store, texts

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_documents(docs: DataFrame, path: str, end_id: int, capacity: int) -> DataFrame:
    """One row per piece of at most ``capacity`` ids."""

    def run(batches):
        from .encode import encoder

        enc = encoder(path)
        end = np.array([end_id], enc.dtype).tobytes()
        for b in batches:
            rows = []
            for d, x in zip(b.column(0).to_pylist(), enc.encode(b.column(1).to_pylist())):
                ids = np.frombuffer(x + end, enc.dtype).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                bounds = [0, *range(first, len(ids) + 1, capacity)]
                raw = memoryview(ids.tobytes())
                for k, (s, e) in enumerate(zip(bounds, bounds[1:])):
                    rows.append((d, k, s, e - s, zlib.crc32(raw[4 * s : 4 * e])))
            cols = list(zip(*rows)) or [()] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [f.split()[0] for f in PIECES.split(", ")])

    return docs.mapInArrow(run, PIECES)


def _configurations(sizes: list[int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """(filled, class indexes) of every multiset of ``sizes`` that fits."""
    out: list[tuple[int, tuple[int, ...]]] = []
    todo: list[tuple[int, int, tuple[int, ...]]] = [(0, 0, ())]
    while todo:
        first, filled, had = todo.pop()
        for c in range(first, len(sizes)):
            if filled + sizes[c] <= capacity:
                got = (filled + sizes[c], (*had, c))
                out.append(got)
                todo.append((c, got[0], got[1]))
    return out


def plan_runs(histogram: dict[int, int], capacity: int = 2048, groups: int = 24, large: float = 6) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, count, first sequence, offset) runs that place
    every piece: rank r of the run goes to sequence first + (r - first rank)."""
    runs: list[tuple[int, int, int, int, int]] = []
    lengths = sorted(n for n, c in histogram.items() if c)
    sequence = 0
    opened: list[tuple[int, int, int]] = []  # (room, first sequence, count) with equal room

    # 1. linear grouping: classes of equal cardinality, as runs of real lengths, longest first
    big = [n for n in reversed(lengths) if n * large > capacity]
    total = sum(histogram[n] for n in big)
    share = max(1, -(-total // groups))
    classes: list[list[list[int]]] = []
    room = 0
    for n in big:
        rank, left = 0, histogram[n]
        while left:
            if not room:
                if not classes or classes[-1][0][0] != n:
                    classes.append([])
                room = share
            take = min(left, room)
            classes[-1].append([n, rank, take])
            rank, left, room = rank + take, left - take, room - take
    sizes = [c[0][0] for c in classes]
    counts = [sum(x[2] for x in c) for c in classes]

    # 2. fullest configurations first; among equally full ones that with the longest pieces
    def use(configuration: tuple[int, ...], times: int) -> None:
        """3. real pieces replace the rounded ones, run by run."""
        nonlocal sequence
        borders = {0, times}
        slots = []
        for c in configuration:
            got, need = [], times
            while need:
                n, rank, have = classes[c][0]
                take = min(have, need)
                got.append((times - need, n, rank, take))
                need -= take
                borders.add(times - need)
                if take == have:
                    classes[c].pop(0)
                else:
                    classes[c][0] = [n, rank + take, have - take]
            slots.append(got)
        edge = sorted(borders)
        at = [0] * len(slots)
        for a, b in zip(edge, edge[1:]):
            offset = 0
            for s, got in enumerate(slots):
                while got[at[s]][0] + got[at[s]][3] <= a:
                    at[s] += 1
                first, n, rank, _ = got[at[s]]
                runs.append((n, rank + a - first, b - a, sequence + a, offset))
                offset += n
            opened.append((capacity - offset, sequence + a, b - a))
        sequence += times

    ranked = sorted(_configurations(sizes, capacity), key=lambda x: (-x[0], x[1])) if sizes else []
    for _, configuration in ranked:
        need: dict[int, int] = {}
        for c in configuration:
            need[c] = need.get(c, 0) + 1
        times = min(counts[c] // k for c, k in need.items())
        if times:
            for c, k in need.items():
                counts[c] -= k * times
            use(configuration, times)

    # 4. best fit of the small pieces, longest first
    rooms: dict[int, list[tuple[int, int]]] = {}
    for r, first, count in opened:
        rooms.setdefault(r, []).append((first, count))
    order = sorted(r for r in rooms if r)
    for n in (x for x in reversed(lengths) if x * large <= capacity):
        rank, left = 0, histogram[n]
        while left:
            i = bisect_left(order, n)
            if i == len(order):
                fresh = -(-left // (capacity // n))
                rooms.setdefault(capacity, []).append((sequence, fresh))
                sequence += fresh
                insort(order, capacity)
                continue
            r = order[i]
            first, count = rooms[r].pop()
            take = min(left, count)
            if take < count:
                rooms[r].append((first + take, count - take))
            if not rooms[r]:
                order.pop(i)
                del rooms[r]
            runs.append((n, rank, take, first, capacity - r))
            if r > n:
                if r - n not in rooms:
                    insort(order, r - n)
                    rooms[r - n] = []
                rooms[r - n].append((first, take))
            rank, left = rank + take, left - take
    return runs


# (groups, large) tried: from few pieces in a configuration to many.  Fine groups go with
# few large lengths, which bounds the configurations.
SCHEMES = ((4096, 2.2), (8, 3), (24, 3), (12, 4), (16, 6))


def best_plan(histogram: dict[int, int], capacity: int = 2048) -> list[tuple[int, int, int, int, int]]:
    """The runs of the scheme that needs the fewest sequences.  Rounding loses
    more the more pieces share a configuration, plain best fit loses more the
    fewer small pieces there are; the histogram alone decides, at no pass over
    the data."""
    plans = [plan_runs(histogram, capacity, groups, large) for groups, large in SCHEMES]
    return min(plans, key=lambda runs: max((first + count for _, _, count, first, _ in runs), default=0))


def pack(pieces: DataFrame, capacity: int = 2048, rows_a_bucket: int = 50_000) -> DataFrame:
    """Adds sequence_id and offset to (doc_id, piece, start, length, ids_crc32)."""
    spark = pieces.sparkSession
    buckets = max(1, -(-pieces.count() // rows_a_bucket))
    spread = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(buckets)).cast("int"))
    counts = spread.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    # at most ``capacity`` rows a bucket; ranks before each bucket of a length
    w = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts, _ = store(counts.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0))), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).toLocalIterator()}
    runs = best_plan(histogram, capacity)
    by_length: dict[int, list[tuple[int, int, int, int]]] = {}
    for n, rank, _, first, offset in runs:
        by_length.setdefault(n, []).append((rank, first, offset))
    arrays = {n: tuple(np.array(x, np.int64) for x in zip(*sorted(v))) for n, v in by_length.items()}
    shared = spark.sparkContext.broadcast(arrays)  # grows with the distinct lengths, at most ``capacity``

    ranked = (
        spread.join(counts.select("length", "bucket", "before"), ["length", "bucket"])
        .withColumn("rank", F.col("before") + F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")) - 1)
        .select(*[f.split()[0] for f in PIECES.split(", ")], "rank")
    )

    def place(batches):
        for b in batches:
            length, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                first_rank, first, place_at = shared.value[int(n)]
                run = np.searchsorted(first_rank, rank[at], side="right") - 1
                sequence[at] = first[run] + rank[at] - first_rank[run]
                offset[at] = place_at[run]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset)], [*b.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, f"{PIECES}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    prepare(docs.sparkSession)
    pieces, _ = store(cut_documents(texts(docs), path, end_id, capacity), "pieces")
    return pack(pieces, capacity)


@register("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
