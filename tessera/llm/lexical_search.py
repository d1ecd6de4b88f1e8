"""Ranked lexical search by branch and bound over document FP-trees (operator 13).

1. Items are read in blocks of at most ``block_terms`` (item, term) pairs; each
   block is searched against all documents.
2. One pass over the texts keeps, per document, its number of terms and the
   counts of the block's terms (its restricted vector).  N, L and the document
   frequencies come from these rows; they give every term its weight.
3. Each task cuts its documents into blocks of at most ``block_pairs`` (document,
   term) pairs and builds an FP-tree of each: the terms of a vector are ordered
   by document frequency, rarest first, and vectors share the path of a common
   prefix.  Rarest first, because what is left below a node is then only the
   more frequent, lighter terms, and the bound falls early.
4. A node holds its term, the largest count of the term and the smallest m
   among the documents below, and the largest count of any later term below.
   The score of a document below is at most what the path can give with these
   counts and m, plus the least of three sums: over the item's later terms with
   each term's own largest impact in the block, over the same with the subtree's
   largest count and smallest m, and over the item's nodes in the subtree.  The
   last comes from running totals over these nodes (found by the tree's lists of
   nodes per term) in depth-first order, and is exact where a path has no branch.
5. Per item the tree is searched depth first, most promising nodes first, with
   nodes under the item's k-th best score left out.  Documents that end at a
   node that is visited, or that are ``few`` under it, are scored exactly, from
   their vectors.  The k-th best score is carried from block to block within a
   task.
6. A task returns k rows an item; two rounds of ranks (by item and salt, then
   by item) merge them.

Trees are arrays, numbered level by level, so children are ranges and a step
of the search handles up to ``width`` nodes at once.  Memory is bounded by
``block_pairs`` and ``block_terms``; a document has no more pairs than the
block of items has terms.  All scores are exact 64-bit integers.

Defined cases: a null or empty text or item has no terms and no rows; rows
that repeat a doc_id are documents of their own, ranked one after the other;
rows that repeat an item_id are searched one by one and each returns its rows;
a null doc_id sorts last among equal scores (as 2^63 - 1, and such an id comes
back as null); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import register
from .common import documents, prepare, store, texts

NO_ID = (1 << 63) - 1
# ASCII letters and digits and all bytes of other characters make terms; A-Z are lowered.
FOLD = bytes(b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
FOUND = "item int, item_id long, doc_id long, score long"


def terms(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def restricted_vectors(docs: DataFrame, vocabulary) -> DataFrame:
    """(doc_id, n, ids, counts) of the documents with a term; ``vocabulary``
    is a broadcast dict of terms to ids."""

    def run(batches):
        known = vocabulary.value
        for b in batches:
            n, found = [], []
            for text in b.column(1).to_pylist():
                words = terms(text)
                n.append(len(words))
                found.append(np.array(list(map(known.get, words, repeat(-1))), np.int64))
            n = np.array(n, np.int64)
            flat = np.concatenate(found) if found else np.zeros(0, np.int64)
            key = (np.repeat(np.arange(len(n)), n) * len(known) + flat)[flat >= 0]
            key, counts = np.unique(key, return_counts=True)
            offsets = np.searchsorted(key, np.arange(len(n) + 1) * len(known)).astype(np.int32)
            ids = pa.ListArray.from_arrays(offsets, pa.array((key % len(known)).astype(np.int32)))
            counts = pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int32)))
            out = pa.RecordBatch.from_arrays([b.column(0), pa.array(n), ids, counts], ["doc_id", "n", "ids", "counts"])
            yield out.filter(pa.array(n > 0))

    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, "doc_id long, n long, ids array<int>, counts array<int>")


class DocumentTree:
    """FP-tree over documents given as sorted ranks and counts (CSR)."""

    def __init__(self, doc_id: np.ndarray, m: np.ndarray, offsets: np.ndarray, ranks: np.ndarray, counts: np.ndarray, n_terms: int):
        self.doc_id, self.m, self.offsets, self.ranks = doc_id, m, offsets, ranks
        length = np.diff(offsets)
        self.impact = impact(counts, np.repeat(m, length))
        self.best = np.zeros(n_terms, np.int64)  # per term, over the whole tree
        np.maximum.at(self.best, ranks, self.impact)
        levels: list[tuple[np.ndarray, ...]] = []
        last = np.zeros(len(doc_id), np.int64)
        at, parent, base, level = np.flatnonzero(length), np.zeros(int((length > 0).sum()), np.int64), 1, 0
        while len(at):
            pair = offsets[at] + level
            key = parent * n_terms + ranks[pair]
            order = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.diff(key[order], prepend=-1))
            node = np.empty(len(at), np.int64)
            node[order] = base + np.repeat(np.arange(len(first)), np.diff(first, append=len(at)))
            key = key[order[first]]
            levels.append((key // n_terms, key % n_terms, np.maximum.reduceat(counts[pair][order], first), np.minimum.reduceat(m[at][order], first)))
            level, base = level + 1, base + len(first)
            ends = length[at] == level
            last[at[ends]] = node[ends]
            at, parent = at[~ends], node[~ends]
        root = (np.zeros(1, np.int64), np.full(1, -1), np.zeros(1, np.int64), np.ones(1, np.int64))
        self.parent, self.term, most, least_m = (np.concatenate(x).astype(np.int64) for x in zip(root, *levels))
        self.children = np.bincount(self.parent[1:], minlength=base)
        self.child = np.cumsum(self.children) - self.children + 1  # children are numbered in the order of their parents
        below, self.size, end = np.zeros(base, np.int64), np.ones(base, np.int64), base
        for parents, *_ in reversed(levels):  # largest count of any later term and number of nodes, from the leaves up
            here = slice(end - len(parents), end)
            np.maximum.at(below, parents, np.maximum(below[here], most[here]))
            np.add.at(self.size, parents, self.size[here])
            end = here.start
        self.place, end = np.zeros(base, np.int64), 1  # in depth-first order
        for parents, *_ in levels:
            here = slice(end, end + len(parents))
            before = np.cumsum(self.size[here]) - self.size[here]
            self.place[here] = self.place[parents] + 1 + before - before[self.child[parents] - end]
            end = here.stop
        self.listed = np.lexsort((self.place, self.term))[1:]  # nodes of each term, without the root
        self.list_at = np.searchsorted(self.term[self.listed], np.arange(n_terms + 1))
        self.path = impact(most, least_m)
        self.rest = impact(below, least_m)
        held = np.flatnonzero(length)
        self.ordered = held[np.argsort(self.place[last[held]], kind="stable")]  # by the node they end at: those below a node are a range
        ends = self.place[last[self.ordered]]
        self.first_doc = np.searchsorted(ends, self.place)
        self.ending = np.searchsorted(ends, self.place, side="right") - self.first_doc
        self.docs_below = np.searchsorted(ends, self.place + self.size) - self.first_doc

    def exact(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        start, n = self.offsets[docs], self.offsets[docs + 1] - self.offsets[docs]
        pair = ranges(start, n)
        return np.add.reduceat(weight[self.ranks[pair]] * self.impact[pair], np.cumsum(n) - n)

    def search(self, wanted: np.ndarray, weights: np.ndarray, k: int, top: tuple[np.ndarray, np.ndarray], width: int = 1024, few: int = 4) -> tuple[tuple[np.ndarray, np.ndarray], int]:
        """The k best (score, doc_id) of ``top`` and this tree for the term
        ranks ``wanted``, and the number of nodes visited."""
        score, doc_id = top
        weight = np.zeros(len(self.best), np.int64)
        weight[wanted] = weights
        hits = self.listed[ranges(self.list_at[wanted], self.list_at[wanted + 1] - self.list_at[wanted])]
        hits = hits[np.argsort(self.place[hits], kind="stable")]
        places, totals = self.place[hits], np.concatenate([[0], np.cumsum(weight[self.term[hits]] * self.path[hits])])
        floor = int(score[-1]) if len(score) == k else 1
        later = weight[::-1].cumsum()[::-1] - weight  # weights of the terms after each
        best = (weight * self.best)[::-1].cumsum()[::-1] - weight * self.best
        stack = [(np.zeros(1, np.int64), np.zeros(1, np.int64), np.full(1, NO_ID))]
        visited = 0
        while stack:
            node, partial, bound = stack.pop()
            held = bound >= floor
            node, partial = node[held], partial[held]
            visited += len(node)
            straight = self.docs_below[node] <= few
            n = np.where(straight, self.docs_below[node], np.where(partial >= floor, self.ending[node], 0))
            docs = self.ordered[ranges(self.first_doc[node], n)]
            if len(docs):
                new = self.exact(docs, weight)
                good = new >= floor
                score, doc_id = np.concatenate([score, new[good]]), np.concatenate([doc_id, self.doc_id[docs[good]]])
                order = np.lexsort((doc_id, -score))[:k]
                score, doc_id = score[order], doc_id[order]
                floor = int(score[-1]) if len(score) == k else 1
            node, partial = node[~straight], partial[~straight]
            n = self.children[node]
            child = ranges(self.child[node], n)
            if not len(child):
                continue
            term = self.term[child]
            partial = np.repeat(partial, n) + weight[term] * self.path[child]
            rest = np.minimum(best[term], later[term] * self.rest[child])
            held = partial + rest >= floor
            child, partial, rest = child[held], partial[held], rest[held]
            after = self.place[child] + 1
            inside = totals[np.searchsorted(places, after + self.size[child] - 1)] - totals[np.searchsorted(places, after)]
            bound = partial + np.minimum(rest, inside)
            held = np.flatnonzero(bound >= floor)
            held = held[np.argsort(bound[held], kind="stable")]
            for i in range(0, len(held), width):  # the most promising nodes end on top
                part = held[i : i + width]
                stack.append((child[part], partial[part], bound[part]))
        return (score, doc_id), visited


def ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The ranges [start, start + n), one after the other."""
    return np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())


def lengths_to_m(n: np.ndarray, documents_n: int, total: int) -> np.ndarray:
    return np.array([75 + 25 * int(x) * documents_n // total for x in n], np.int64)


def trees(batches: Iterator[pa.RecordBatch], rank: np.ndarray, documents_n: int, total: int, block_pairs: int) -> Iterator[DocumentTree]:
    """FP-trees of at most ``block_pairs`` pairs (one document at least)."""
    held, size = [], 0
    for b in batches:
        ids = b.column("ids")
        lists = np.diff(ids.offsets.to_numpy())
        start = 0
        while start < len(lists):  # the rows that still fit
            room = np.searchsorted(np.cumsum(lists[start:]), block_pairs - size, side="right")
            if room:
                held.append(b.slice(start, room))
                size += int(lists[start : start + room].sum())
                start += room
            elif held:
                yield one_tree(held, rank, documents_n, total)
                held, size = [], 0
            else:
                yield one_tree([b.slice(start, 1)], rank, documents_n, total)
                start += 1
    if held:
        yield one_tree(held, rank, documents_n, total)


def one_tree(batches: list[pa.RecordBatch], rank: np.ndarray, documents_n: int, total: int) -> DocumentTree:
    rows = pa.Table.from_batches(batches).combine_chunks()
    doc_id = rows["doc_id"].combine_chunks().fill_null(NO_ID).to_numpy()
    m = lengths_to_m(rows["n"].to_numpy(), documents_n, total)
    length = np.array([len(x) for x in rows["ids"].to_numpy()], np.int64)
    ids, counts = (rows[c].combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("ids", "counts"))
    ranks = rank[ids]
    order = np.lexsort((ranks, np.repeat(np.arange(len(length)), length)))
    return DocumentTree(doc_id, m, np.concatenate([[0], np.cumsum(length)]), ranks[order], counts[order], len(rank))


def item_blocks(items: DataFrame, block_terms: int) -> Iterator[list[tuple[int, Counter]]]:
    """Blocks of (item_id, terms); an item is read at a time."""
    block, size = [], 0
    for r in items.select("doc_id", F.col("text").cast("binary").alias("text")).toLocalIterator():
        found = Counter(terms(bytes(r.text)))
        if not found:
            continue
        if block and size + len(found) > block_terms:
            yield block
            block, size = [], 0
        block.append((r.doc_id, found))
        size += len(found)
    if block:
        yield block


def search_block(docs: DataFrame, block: list[tuple[int, Counter]], k: int, block_pairs: int) -> DataFrame:
    """(item, item_id, doc_id, score): the k best documents of each task, per item."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, found in block for t in found}))}
    vectors, _ = store(restricted_vectors(docs, spark.sparkContext.broadcast(vocabulary)), "term-vectors")
    documents_n, total = vectors.agg(F.count("*"), F.sum("n")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in vectors.select(F.explode("ids").alias("id")).groupBy("id").count().collect():  # the terms of the block
        df[r["id"]] = r["count"]
    weight = np.array([math.floor(1000 * math.log((2 * documents_n + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    rank = np.empty(len(df), np.int64)
    rank[np.argsort(df, kind="stable")] = np.arange(len(df))
    wanted = []
    for item_id, found in block:
        ids = np.array([vocabulary[t] for t in found], np.int64)
        wanted.append((item_id, rank[ids], weight[ids] * np.array(list(found.values()), np.int64)))
    shared = spark.sparkContext.broadcast((rank, wanted))

    def run(batches):
        rank, wanted = shared.value
        top = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(wanted)
        for tree in trees(batches, rank, documents_n, total, block_pairs):
            for i, (_, at, w) in enumerate(wanted):
                top[i], _ = tree.search(at, w, k, top[i])
        for i, (score, doc_id) in enumerate(top):
            if len(score):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(score), i, np.int32)),
                        pa.array([wanted[i][0]] * len(score), pa.int64()),
                        pa.array(doc_id, mask=doc_id == NO_ID),
                        pa.array(score),
                    ],
                    ["item", "item_id", "doc_id", "score"],
                )

    return vectors.mapInArrow(run, FOUND)


def lexical_search(
    docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    block_pairs: int = 1_000_000, block_terms: int = 200_000,
) -> DataFrame:
    """Each item's k best documents: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    prepare(spark)
    docs, out = texts(docs, id_col, text_col), None
    best = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for block in item_blocks(texts(items, item_col, item_text_col), block_terms):
        found = search_block(docs, block, k, block_pairs).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(256)))
        found = found.withColumn("at", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*best))).where(F.col("at") <= k)
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best))).where(F.col("rank") <= k)
        found, _ = store(found.select("item_id", "rank", "doc_id", "score"), "found")
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
s AS (SELECT count(*) AS N, sum(len(t))::BIGINT AS L FROM d WHERE len(t) > 0),
q AS (SELECT item_id, term, count(*) AS c FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY 1, 2),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY 1, 2),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(N) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term),
m AS (SELECT r, doc_id, 100 - 25 + ((25 * len(t) * N) // L) AS m FROM d, s WHERE len(t) > 0),
p AS (SELECT item_id, r, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY 1, 2)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM p JOIN m USING (r) WHERE score > 0 QUALIFY rank <= 20
"""


@register("op13_lexical_search", ORACLE)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
