"""Substring dedup by content-cut blocks and window hashes (operator 6).

A window is ``WINDOW`` consecutive words.  A word goes if a window that covers
it also starts in a document with a smaller doc_id.

1. Every document is cut into reference blocks: runs of windows that share
   their smallest 16-word fingerprint (the anchor).  The cut depends on the
   window's own words only, so equal windows of any two documents have the
   same anchor, wherever they stand.
2. The index over all blocks keeps per anchor the smallest and largest
   document, and whether all its blocks are equal.  Anchors of one document
   only hold no shared window and leave.
3. If all blocks of an anchor are equal, all windows of the block are duplicates
   in every document but the first.  No longest match is searched and no
   Lempel-Ziv factor is formed.
4. In blocks whose anchor is shared while their contents differ, single windows
   decide.  One representative of each
   distinct block content is looked up (copies are not), its windows' smallest
   documents are found, and every occurrence is judged by them.
5. The words of duplicate windows are removed.

All aggregates combine before their shuffle, so an anchor in a third of all
documents is a few rows a task there; joins on anchors read stored tables, so
the adaptive join splits hot ones.  Nothing is compared pairwise.  Words and
windows are compared by 64-bit hashes, windows always together with their
64-bit anchor.

Defined cases: a null or empty text has no words and the digest of the empty
string; a null doc_id counts as larger than any other; rows that repeat a
doc_id are judged each on its own text against smaller ids only; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import register
from .common import SPACE, documents, prepare, remove, store

WINDOW = 50
GRAM = 16
PART = 64  # windows of a block at most: one bit each in a mask
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
LAST = (1 << 63) - 1

_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 20)
        inverse = pow(BASE, -1, 1 << 64)
        _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, b, np.uint64)])) for b in (BASE, inverse)]
    return _POWERS[0], _POWERS[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _Hashes:
    """Fingerprints of any word range of a batch of documents."""

    def __init__(self, lists: pa.ListArray, empty: int):
        values = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        real = values != np.uint64(empty % (1 << 64))  # split() leaves "" at the ends
        ends = np.concatenate([[0], np.cumsum(real)])
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        self.bounds = ends[offsets]
        values = values[real]
        self.n = len(values)
        power, self.inverse = _powers(self.n + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * power[: self.n], dtype=np.uint64)])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(first word, document) of every window of the batch."""
        count = np.maximum(np.diff(self.bounds) - WINDOW + 1, 0)
        doc = np.repeat(np.arange(len(count)), count)
        within = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        return self.bounds[:-1][doc] + within, doc

    def anchors(self, windows: np.ndarray) -> np.ndarray:
        """The smallest fingerprint of GRAM words in each window."""
        if not len(windows):
            return np.zeros(0, np.uint64)
        at = np.arange(self.n - GRAM + 1)
        low = self.ranges(at, at + GRAM)
        span, width = WINDOW - GRAM + 1, 1
        while 2 * width <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        return np.minimum(low[windows], low[windows + span - width])


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def word_hashes(rows: DataFrame) -> DataFrame:
    """(ord, text_key, hashes): 64-bit hashes of the words."""
    return rows.select("ord", "text_key", F.transform(F.split("text", SPACE), lambda x: F.xxhash64(x)).alias("hashes"))


def reference_blocks(hashed: DataFrame, empty: int) -> DataFrame:
    names = ["anchor", "content", "ord", "text_key", "at", "n"]

    def run(batches):
        for b in batches:
            h = _Hashes(b.column(2), empty)
            windows, doc = h.windows()
            anchors = h.anchors(windows)
            if not len(windows):
                continue
            new = np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (doc[1:] != doc[:-1])])
            first = np.flatnonzero(new)
            run_start = np.repeat(first, np.diff(np.append(first, len(new))))
            new |= (np.arange(len(new)) - run_start) % PART == 0
            first = np.flatnonzero(new)
            n = np.diff(np.append(first, len(new)))
            start = windows[first]
            content = h.ranges(start, start + n + WINDOW - 1) ^ n.astype(np.uint64)
            owner = doc[first]
            own = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [_signed(anchors[first]), _signed(content), b.column(0).take(own), b.column(1).take(own), pa.array(start - h.bounds[owner], pa.int64()), pa.array(n, pa.int64())], names
            )

    return hashed.mapInArrow(run, "anchor long, content long, ord long, text_key long, at long, n long")


def block_windows(hashed_with_blocks: DataFrame, empty: int) -> DataFrame:
    """(anchor, content, first, windows) of listed blocks: hashes of their windows."""

    def run(batches):
        for b in batches:
            h = _Hashes(b.column(2), empty)
            listed = b.column(3)
            blocks = listed.flatten()
            counts = np.diff(listed.offsets.to_numpy())
            if not len(blocks):
                continue
            field = lambda k: blocks.field(k).to_numpy(zero_copy_only=False)  # noqa: E731, B023
            n = field("n")
            start = np.repeat(h.bounds[:-1], counts) + field("at")
            at = np.repeat(start, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            values = _signed(h.ranges(at, at + WINDOW))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), values)
            yield pa.RecordBatch.from_arrays([blocks.field("anchor"), blocks.field("content"), blocks.field("first"), lists], ["anchor", "content", "first", "windows"])

    return hashed_with_blocks.mapInArrow(run, "anchor long, content long, first long, windows array<long>")


def _kept(batches):
    """Words left when the windows of every listed block's mask are removed;
    further columns go through."""
    for b in batches:
        out = []
        for ord_, text, blocks in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            words = text.encode().split()  # exactly space and U+0009..U+000D
            removed = 0
            n_words = len(words)
            if blocks:
                starts = np.concatenate([x["at"] + np.flatnonzero((np.uint64(x["mask"] % (1 << 64)) >> np.arange(x["n"], dtype=np.uint64)) & np.uint64(1)) for x in blocks])
                depth = np.zeros(n_words + 1, np.int64)
                np.add.at(depth, starts, 1)
                np.add.at(depth, starts + WINDOW, -1)
                keep = np.cumsum(depth)[:-1] == 0
                removed = int(n_words - keep.sum())
                words = [w for w, k in zip(words, keep.tolist()) if k]
            kept = b" ".join(words)
            out.append((None if ord_ == LAST else ord_, n_words, removed, hashlib.sha256(kept).hexdigest(), kept.decode()))
        cols = list(zip(*out)) or [()] * 5
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)] + b.columns[3:], names + b.schema.names[3:])


def duplicate_windows(rows: DataFrame) -> DataFrame:
    """(ord, text_key, blocks): masks of duplicate windows per document that has any."""
    spark = rows.sparkSession
    empty = spark.range(1).select(F.xxhash64(F.lit("")).alias("h")).first()["h"]
    hashed = word_hashes(rows)
    blocks, blocks_path = store(reference_blocks(hashed, empty), "blocks")
    index = blocks.groupBy("anchor").agg(
        F.min("ord").alias("first"), F.max("ord").alias("last"), (F.min("content") == F.max("content")).alias("alike")
    )
    index, index_path = store(index.where("first < last").select("anchor", "first", "alike"), "anchors")
    shared, _ = store(blocks.join(index, "anchor"), "shared-blocks")
    remove(spark, blocks_path, index_path)

    contents = shared.where("not alike").groupBy("anchor", "content").agg(
        F.min("ord").alias("first"), F.min_by(F.struct("ord", "text_key", "at", "n"), F.struct("ord", "text_key", "at")).alias("r")
    )
    listed = contents.groupBy(F.col("r.ord").alias("ord"), F.col("r.text_key").alias("text_key")).agg(
        F.collect_list(F.struct("anchor", "content", "first", "r.at", "r.n")).alias("blocks")  # at most the document's own blocks
    )
    listed, listed_path = store(listed, "listed")
    windows = block_windows(hashed.join(listed, ["ord", "text_key"]), empty)
    windows = windows.select("anchor", "content", "first", F.posexplode("windows").alias("k", "window"))
    windows, windows_path = store(windows, "windows")
    earliest = windows.groupBy("anchor", "window").agg(F.min("first").alias("earliest"))
    earliest, earliest_path = store(earliest, "earliest")
    judged = windows.join(earliest, ["anchor", "window"]).groupBy("anchor", "content").agg(F.collect_set(F.struct("k", "earliest")).alias("windows"))
    judged, _ = store(judged, "judged")
    remove(spark, listed_path, windows_path, earliest_path)

    mask = F.expr("aggregate(filter(windows, x -> x.earliest < ord), 0L, (a, x) -> a | shiftleft(1L, x.k))")
    alike = shared.where("alike and ord > first").select("ord", "text_key", "at", "n", F.lit(-1).cast("long").alias("mask"))
    other = shared.where("not alike").join(judged, ["anchor", "content"]).select("ord", "text_key", "at", "n", mask.alias("mask"))
    masks = alike.unionByName(other.where("mask <> 0"))
    return masks.groupBy("ord", "text_key").agg(F.collect_set(F.struct("at", "n", "mask")).alias("blocks"))


KEPT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: bool = False) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256, kept_text; with
    ``rows`` also the whole input row (``row``)."""
    prepare(docs.sparkSession)
    carried = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if rows else []
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    whole = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)).alias("ord"), text.alias("text"), F.xxhash64(text).alias("text_key"), *carried)
    found, _ = store(duplicate_windows(whole.select("ord", "text_key", "text")), "duplicate-windows")
    own = ["row"] if rows else []
    whole = whole.join(found, ["ord", "text_key"], "left").select("ord", "text", "blocks", *own)
    return whole.mapInArrow(_kept, KEPT + (f", row {whole.schema['row'].dataType.simpleString()}" if rows else ""))


def remove_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The rows of ``docs`` without their duplicate spans, with their columns:
    a text that loses words becomes the kept words joined by one space, a row
    that loses all of them goes, any other stays as it is."""
    found = substring_dedup(docs, id_col, text_col, rows=True).where("n_removed = 0 or n_removed < n_words")
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("row").getField(text_col))
    size = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("row").getField(length_col)) if length_col in docs.columns else None
    new = {text_col: text} | ({length_col: size.cast(docs.schema[length_col].dataType)} if size is not None else {})
    return found.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS k FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS first FROM win) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM dup, range(50) AS r(j)),
word AS (SELECT doc_id, p, words[p] AS word FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS p FROM w)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(words) AS n_words, len(words) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


@register("op6_substring_dedup", ORACLE)
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir)).drop("kept_text")
