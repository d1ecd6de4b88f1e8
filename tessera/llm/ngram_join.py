"""N-gram Jaccard join by prefixes of partitions (operator 8): PartEnum's
partitions signed one by one, without its enumeration of their subsets.

A document's set holds its distinct word shingles; equal sets are one node.
Two nodes link when |a & b| / |a | b| >= ``limit_pct`` / 100.

Signatures.  Sizes fall into bands [2^b, 2^(b+1)); a set near the top of its
band also signs for the next one, so a linkable pair always shares a band.
A band divides the shingle domain into partitions.  Sets of size n that link
differ in at most k(n) = n (100 - limit) / limit shingles, hence in at most k
partitions.  Each set signs, in the common order, its first k + t partitions
that are not empty (the content of the partition is the signature), with
t = 1 + k / 4.  Of the set whose prefix ends first, at most k signed
partitions differ, so the pair shares at least t signatures: none is missed,
and nodes that share fewer with anybody leave early.  (Small bands take every
shingle for a partition of its own.)  If hashing leaves a set too few
partitions for this proof, everything is signed again under another seed.

Candidates.  Signature lists are packed by range and shuffled once; a
signature held by many documents of a batch sends one representative, and its
other holders go spread over all tasks, so a hot signature is never in one
task.  All holders of a signature join the group of its smallest holder.  A
group larger than ``block`` is split into blocks, and pairs of blocks are
compared; what leaves a task is at most one edge per node (a spanning forest
of the links found), never the pairs.  Every pair of different texts that
shares a signature is compared exactly.

Components come from minimum labels with pointer jumping over stored tables.

Defined cases: null or empty texts and texts without words have an empty set
and link with nothing; a null doc_id counts as larger than any other; rows
that repeat a doc_id are separate rows; an empty table gives no rows; other
columns are ignored.  Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import register
from .common import SPACE, documents, prepare, remove, store, texts
from .substring_dedup import LAST, _Hashes, _mix

SMALL = 64  # bands below: one partition per shingle
HOT = 8  # holders of a signature in one batch that make it hot
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def differences(n: int, limit_pct: int) -> int:
    """The most shingles in which a linked partner of a set of n differs."""
    return n * (100 - limit_pct) // limit_pct


def spare(n: int, limit_pct: int) -> int:
    return 1 + differences(n, limit_pct) // 4


def partitions(tag: int, limit_pct: int) -> int:
    """Partitions of the domain for a band: about a third more than the
    largest set of the band signs, so that enough of them are filled."""
    return max(1, (1 << tag) * 34 * (100 - limit_pct) // (10 * limit_pct))


def _sets(batch: pa.RecordBatch, column: int, size: int, empty: int):
    """Distinct shingle hashes of each document of a batch."""
    h = _Hashes(batch.column(column), empty)
    bounds = h.bounds.tolist()
    at = np.arange(max(h.n - size + 1, 0))
    grams = h.ranges(at, at + size)
    for s, e in zip(bounds, bounds[1:]):
        if e - s >= size:
            yield np.unique(grams[s : e - size + 1])
        elif e > s:  # fewer words than a shingle: the whole sequence
            yield h.ranges(np.array([s]), np.array([e])) ^ np.uint64(e - s)
        else:
            yield np.zeros(0, np.uint64)


def _identity(s: np.ndarray, seed: int) -> tuple[int, int]:
    sums = np.array([_mix(s ^ np.uint64(seed)).sum(dtype=np.uint64), _mix(s + np.uint64(0x51ED270B)).sum(dtype=np.uint64)])
    a, b = _mix(sums + np.uint64(len(s))).tolist()
    return a - (1 << 64) if a >> 63 else a, b - (1 << 64) if b >> 63 else b


def signatures(s: np.ndarray, limit_pct: int, seed: int) -> tuple[np.ndarray, int]:
    """Signatures of a set in its band and, near its top, the next, and how
    many of them a linked partner with no shorter prefix shares at least (less
    than 1: hashing filled too few partitions)."""
    n = len(s)
    differ = differences(n, limit_pct)
    need = differ + spare(n, limit_pct)
    sure = need - differ
    g = _mix(s ^ np.uint64(seed))
    band = n.bit_length() - 1
    out = []
    for tag in (band, band + 1):
        if tag > band and 100 * n < limit_pct << tag:
            break
        mark = np.uint64((tag * 0x9E3779B97F4A7C15 + seed) % (1 << 64))
        if 1 << tag < SMALL:
            out.append(_mix(np.sort(g)[:need] + mark))
            continue
        part = g % np.uint64(partitions(tag, limit_pct))
        order = np.argsort(part, kind="stable")
        part = part[order]
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        sure = min(sure, len(first) - differ)
        content = np.add.reduceat(_mix(g + np.uint64(1))[order], first)[:need]
        out.append(_mix(content ^ _mix(part[first][:need] + mark)))
    return np.concatenate(out), sure


def _set_rows(hashed: DataFrame, size: int, limit_pct: int, empty: int, seed: int) -> DataFrame:
    """(ord, text_key, n, node, check, sure) per document."""
    names = ["ord", "text_key", "n", "node", "check", "sure"]
    types = [pa.int64()] * 6

    def run(batches):
        for b in batches:
            rows = []
            for o, key, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), _sets(b, 2, size, empty)):
                rows.append((o, key, len(s), *_identity(s, seed), signatures(s, limit_pct, seed)[1] if len(s) else 0))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return hashed.mapInArrow(run, "ord long, text_key long, n long, node long, check long, sure long")


def _signature_rows(hashed: DataFrame, size: int, limit_pct: int, empty: int, seed: int, ranges: int) -> DataFrame:
    """Packed (signature, node) lists by range; ranges from ``ranges`` on hold
    the further holders of signatures that are hot in a batch."""

    def run(batches):
        for b in batches:
            sigs, nodes = [], []
            for s in _sets(b, 2, size, empty):
                if len(s):
                    own, _ = signatures(s, limit_pct, seed)
                    sigs.append(own)
                    nodes.append(np.full(len(own), _identity(s, seed)[0], np.int64))
            if not sigs:
                continue
            sig, node = np.concatenate(sigs), np.concatenate(nodes)
            order = np.lexsort((node, sig))
            sig, node = sig[order], node[order]
            keep = np.concatenate([[True], (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])])  # equal sets sign once
            sig, node = sig[keep], node[keep]
            first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            count = np.diff(np.append(first, len(sig)))
            hot = np.repeat(count >= HOT, count)
            sent = ~hot
            sent[first] = True
            flag = hot & sent
            place = ((sig >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
            place[~sent] = ranges + (_mix(sig[~sent] ^ node[~sent].view(np.uint64)) % np.uint64(ranges)).astype(np.int64)
            order = np.argsort(place, kind="stable")
            place, sig, node, flag = place[order], sig[order], node[order], flag[order]
            cut = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])).tolist() + [len(place)]
            pieces = list(zip(cut, cut[1:]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(place[a]) for a, _ in pieces], pa.int32()),
                    pa.array([sig[a:e].tobytes() for a, e in pieces], pa.binary()),
                    pa.array([node[a:e].tobytes() for a, e in pieces], pa.binary()),
                    pa.array([np.packbits(flag[a:e]).tobytes() for a, e in pieces], pa.binary()),
                ],
                ["place", "sigs", "nodes", "hot"],
            )

    return hashed.mapInArrow(run, "place int, sigs binary, nodes binary, hot binary")


def _meet(ranges: int):
    """Holders of each signature of a range: (leader, node, n) for cold ones,
    (sig, node) for hot ones; signatures of one node vanish."""
    names = ["sig", "leader", "node", "n"]

    def batch(sig, leader, node, n):
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (sig, leader, node, n)], names)

    def run(batches):
        held: dict[str, list[np.ndarray]] = {"sig": [], "node": [], "hot": []}
        for b in batches:
            for place, sigs, nodes, hot in zip(*(c.to_pylist() for c in b.columns)):
                sig, node = np.frombuffer(sigs, np.uint64), np.frombuffer(nodes, np.int64)
                if place >= ranges:
                    none = pa.nulls(len(sig), pa.int64())
                    yield batch(sig.view(np.int64), none, node, none)
                else:
                    held["sig"].append(sig)
                    held["node"].append(node)
                    held["hot"].append(np.unpackbits(np.frombuffer(hot, np.uint8), count=len(sig)).astype(bool))
        if not held["sig"]:
            return
        sig, node, hot = (np.concatenate(held[k]) for k in ("sig", "node", "hot"))
        order = np.lexsort((node, sig))
        sig, node, hot = sig[order], node[order], hot[order]
        first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        count = np.diff(np.append(first, len(sig)))
        hot = np.repeat(np.logical_or.reduceat(hot, first), count)
        none = pa.nulls(int(hot.sum()), pa.int64())
        yield batch(sig[hot].view(np.int64), none, node[hot], none)
        several = np.repeat(node[first] != node[first + count - 1], count) & ~hot
        leader = np.repeat(node[first], count)[several]  # the smallest holder
        node = node[several]
        order = np.lexsort((node, leader))
        leader, node = leader[order], node[order]
        if len(node):
            first = np.flatnonzero(np.concatenate([[True], (leader[1:] != leader[:-1]) | (node[1:] != node[:-1])]))
            none = pa.nulls(len(first), pa.int64())
            yield batch(none, leader[first], node[first], np.diff(np.append(first, len(node))))

    return run


def _shingle_sets(hashed: DataFrame, size: int, empty: int) -> DataFrame:
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(3), pa.array([s.tobytes() for s in _sets(b, 2, size, empty)], pa.binary())], ["node", "shingles"])

    return hashed.mapInArrow(run, "node long, shingles binary")


def forest(nodes: np.ndarray, sets: list[np.ndarray], limit_pct: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) over all pairs that link."""
    n = len(sets)
    if n < 2:
        return nodes[:0], nodes[:0]
    if n <= 4:
        return _few(nodes, sets, limit_pct)
    size = np.array([len(s) for s in sets], np.float64)
    row = np.repeat(np.arange(n), size.astype(np.int64))
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    alone = np.bincount(row[~shared], minlength=n)
    if (size - alone).max(initial=0) == 0:
        return nodes[:0], nodes[:0]
    kept = np.cumsum(count > 1) - 1
    row, column = row[shared], kept[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((n, n), np.float32)
    width = max(256, (1 << 22) // n)  # columns at once: 16 MB
    for a in range(0, int(column[-1]) + 1, width):
        s, e = np.searchsorted(column, [a, a + width])
        part = np.zeros((n, width), np.float32)
        part[row[s:e], column[s:e] - a] = 1
        both += part @ part.T
    linked = 100 * both.astype(np.float64) >= limit_pct * (size[:, None] + size[None, :] - both)
    np.fill_diagonal(linked, True)
    label = np.arange(n)
    while True:
        low = np.where(linked, label[None, :], n).min(axis=1)
        low = low[low]
        if (low == label).all():
            break
        label = low
    rank = np.argsort(nodes, kind="stable")  # the smallest node of each component
    smallest = np.full(n, -1)
    for i in rank[::-1].tolist():
        smallest[label[i]] = i
    root = nodes[smallest[label]]
    other = root != nodes
    return nodes[other], root[other]


def _few(nodes: np.ndarray, sets: list[np.ndarray], limit_pct: int) -> tuple[np.ndarray, np.ndarray]:
    """``forest`` pair by pair, without pairs that are connected already."""
    root = nodes.copy()
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a], sets[b]
            small, large = sorted((len(x), len(y)))
            if root[a] == root[b] or 100 * small < limit_pct * large:
                continue
            at = np.minimum(np.searchsorted(x, y), len(x) - 1)  # both sorted
            both = int((x[at] == y).sum())
            if 100 * both >= limit_pct * (small + large - both):
                root[(root == root[a]) | (root == root[b])] = min(root[a], root[b])
    other = root != nodes
    return nodes[other], root[other]


def _compare(limit_pct: int):
    """Edges of blocks whose rows (leader, i, j, node, shingles) come together."""

    def run(batches):
        key, nodes, sets = None, [], []
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for b in batches:
            keys = zip(*(b.column(k).to_pylist() for k in range(3)))
            for k, node, raw in zip(keys, b.column(3).to_pylist(), b.column(4).to_pylist()):
                if k != key:
                    found.append(forest(np.array(nodes, np.int64), sets, limit_pct))
                    key, nodes, sets = k, [], []
                nodes.append(node)
                sets.append(np.frombuffer(raw, np.uint64))
            yield _edges(found)
            found = []
        yield _edges([forest(np.array(nodes, np.int64), sets, limit_pct)])

    return run


def _edges(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    none = np.zeros(0, np.int64)
    columns = [np.concatenate([none, *(x[k] for x in found)]) for k in (0, 1)]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "root"])


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for every node with an edge."""
    both, _ = store(edges.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(edges.select(F.col("root").alias("u"), F.col("node").alias("v"))).distinct(), "edges")
    labels, held = store(both.groupBy("u").agg(F.least("u", F.min("v")).alias("label")).withColumnRenamed("u", "node"), "labels")
    while True:
        near = both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(F.min("label").alias("near"))
        low = labels.join(near, F.col("node") == F.col("u"), "left").select("node", F.least("label", F.coalesce("near", "label")).alias("low"), F.col("label").alias("old"))
        low, low_path = store(low, "low")
        jump = low.select(F.col("node").alias("at"), F.col("low").alias("further"))
        moved = low.join(jump, F.col("low") == F.col("at"), "left").select("node", F.least("low", F.coalesce("further", "low")).alias("label"), "old")
        moved, path = store(moved, "labels")
        remove(low.sparkSession, held, low_path)
        labels, held = moved.select("node", "label"), path
        if moved.where("label <> old").isEmpty():
            return labels


def ngram_join(
    docs: DataFrame, size: int = 5, limit_pct: int = 80, id_col: str = "doc_id", text_col: str = "text", block: int = 512, seed: int = 1
) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id."""
    shown = lambda c: F.when(F.col(c) != LAST, F.col(c))
    out = _components_of(docs, size, limit_pct, id_col, text_col, block, seed)
    return out.select(shown("ord").alias("doc_id"), F.col("n").alias("n_shingles"), shown("first").alias("component_id"))


def keep_unlinked(docs: DataFrame, size: int = 5, limit_pct: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns: of each component
    one with the smallest id, and rows without words."""
    found, _ = store(_components_of(docs, size, limit_pct, id_col, text_col), "components")
    best = found.where("n > 0").groupBy("component").agg(F.min(F.struct("ord", "text_key")).alias("r")).select("r.ord", "r.text_key")
    stays, _ = store(best.unionByName(found.where("n = 0").select("ord", "text_key")).distinct(), "stays")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *_keys(id_col, text_col))
    return keyed.join(stays, ["ord", "text_key"], "left_semi").dropDuplicates(["ord", "text_key"]).select("row.*")


def _keys(id_col: str, text_col: str) -> list:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return [F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)).alias("ord"), F.xxhash64(text).alias("text_key")]


def _components_of(docs: DataFrame, size: int, limit_pct: int, id_col: str, text_col: str, block: int = 512, seed: int = 1) -> DataFrame:
    """(ord, text_key, n, component, first) per document."""
    spark = docs.sparkSession
    prepare(spark)
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    empty = spark.range(1).select(F.xxhash64(F.lit("")).alias("h")).first()["h"]
    rows = texts(docs, id_col, text_col).select(F.coalesce("doc_id", F.lit(LAST)).alias("ord"), F.xxhash64("text").alias("text_key"), F.translate("text", UPPER, LOWER).alias("text"))
    hashes = F.transform(F.split("text", SPACE), lambda x: F.xxhash64(x)).alias("hashes")
    hashed = rows.select("ord", "text_key", hashes)

    while True:
        sets, path = store(_set_rows(hashed, size, limit_pct, empty, seed), "sets")
        nodes = sets.where("n > 0").groupBy("node").agg(
            F.first("n").alias("n"), F.min(F.struct("ord", "text_key")).alias("r"), (F.min("check") != F.max("check")).alias("clash"), F.min("sure").alias("sure")
        )
        nodes, nodes_path = store(nodes, "nodes")
        if nodes.where("clash or sure < 1").isEmpty():
            break
        remove(spark, path, nodes_path)
        seed += 1

    packed = _signature_rows(hashed, size, limit_pct, empty, seed, ranges)
    met, _ = store(packed.repartition(ranges, "place").mapInArrow(_meet(ranges), "sig long, leader long, node long, n long"), "met")
    hot = met.where("sig is not null").select("sig", "node").distinct()
    leaders, _ = store(hot.groupBy("sig").agg(F.min("node").alias("leader"), F.count("*").alias("c")).where("c > 1").select("sig", "leader"), "leaders")
    hot = met.where("sig is not null").select("sig", "node").distinct().join(leaders, "sig").select("leader", "node", F.lit(1).cast("long").alias("n"))
    groups = met.where("sig is null").select("leader", "node", "n").unionByName(hot).groupBy("leader", "node").agg(F.sum("n").alias("shared"))
    groups, _ = store(groups, "groups")

    # a node that links shares at least as many signatures as its smallest partner must
    smallest = F.floor(F.col("n") * limit_pct / 100)
    need = 1 + F.floor(F.floor(smallest * (100 - limit_pct) / limit_pct) / 4)
    # one number: sets whose partitions were filled too thinly to share as many
    thin = nodes.where(F.col("sure") < 1 + F.floor(F.floor(F.col("n") * (100 - limit_pct) / limit_pct) / 4)).agg(F.min("sure")).first()[0]
    need = need if thin is None else F.least(need, F.lit(thin))
    able = groups.groupBy("node").agg(F.sum("shared").alias("shared")).join(nodes, "node").where(F.col("shared") >= need)
    able, _ = store(able.select("node", "r", need.alias("need")), "able")
    # Two nodes that link share ``need`` signatures or more.  If each leaves
    # groups with fewer than half of that in all, one shared group remains.
    rising = Window.partitionBy("node").orderBy("shared", "leader").rowsBetween(Window.unboundedPreceding, 0)
    members = groups.join(able.select("node", "need"), "node").withColumn("least", F.sum("shared").over(rising))
    members, _ = store(members.where(F.col("least") > F.floor((F.col("need") - 1) / 2)).select("leader", "node"), "members")
    sizes = members.groupBy("leader").agg(F.count("*").alias("members")).where("members > 1")
    sizes, _ = store(sizes.withColumn("blocks", F.ceil(F.col("members") / block).cast("int")).select("leader", "blocks"), "sizes")

    wanted = able.select(F.col("r.ord").alias("ord"), F.col("r.text_key").alias("text_key"), "node")
    # ``wanted`` grows with the corpus, so it is never broadcast, however small
    wanted = rows.join(wanted.hint("merge"), ["ord", "text_key"]).dropDuplicates(["node"])
    shingles = _shingle_sets(wanted.select("ord", "text_key", hashes, "node"), size, empty)
    shingles, _ = store(shingles, "shingles")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = members.join(sizes, "leader").withColumn("mine", mine).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    placed = placed.select("leader", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "node")
    placed = placed.join(shingles, "node").repartition("leader", "i", "j").sortWithinPartitions("leader", "i", "j")
    compared = placed.select("leader", "i", "j", "node", "shingles").mapInArrow(_compare(limit_pct), "node long, root long")
    labels = components(compared.distinct())

    named = sets.join(labels, "node", "left").withColumn("component", F.coalesce("label", "node"))
    named, _ = store(named.select("ord", "text_key", "n", F.when(F.col("n") > 0, F.col("component")).alias("component")), "named")
    firsts, _ = store(named.where("component is not null").groupBy("component").agg(F.min("ord").alias("first")), "firsts")
    return named.join(firsts, "component", "left").select("ord", "text_key", "n", "component", F.coalesce("first", "ord").alias("first"))


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS k FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS i FROM w WHERE len(words) > 0)),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s AS a JOIN s AS b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN c AS x ON x.doc_id = a JOIN c AS y ON y.doc_id = b WHERE 100 * m >= 85 * (x.n + y.n - m)),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reached)
SELECT w.doc_id, coalesce(any_value(c.n), 0) AS n_shingles, min(reached) AS component_id
FROM w LEFT JOIN c USING (doc_id) JOIN r USING (doc_id) GROUP BY w.doc_id
"""


@register("op8_ngram_join", ORACLE)
def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(documents(spark, sf_dir), size=4, limit_pct=85)
