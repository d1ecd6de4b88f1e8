"""Line dedup: lines found in several documents go (operator 11, native).

1. Lines are exploded with their position and normalised (white space cut at
   both ends, A-Z lowered); keys shorter than ``min_chars`` are left alone.
2. Keys are hashed to 128 bits and counted by distinct document, combined
   before the shuffle.  For the usual threshold of two documents the smallest
   and the largest doc_id of a key tell whether there are two, so that one
   shuffle does; other thresholds count distinct (key, document) pairs.
3. Lines of keys over the threshold are dropped, except in the smallest doc_id
   that holds the key.  Only hashes and positions are shuffled for this.  A key
   with more than a ten-thousandth of these lines (so there are fewer than ten
   thousand such keys) is dealt over as many salts as its size asks for.
4. A document meets its dropped positions once; the stretches between them are
   sliced from its lines in order, in time linear in the lines.

A task holds one document's lines at a time, and per key a few numbers.

Defined cases: a null or empty text is one empty line; a null doc_id is one
document, larger than all others (as if 2^63 - 1); rows that repeat a doc_id
are one document when documents are counted, and each comes back; a line that
repeats within the smallest document stays every time; an empty table gives no
rows; other columns are ignored, and ``remove_lines`` returns them as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import register
from .common import documents, prepare, store

STRIPPED = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_ID = (1 << 63) - 1
HOT_SHARE = 10_000


def lower_ascii(text: Column) -> Column:
    """A-Z only.  In a text of single bytes ``lower`` changes nothing else."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def exploded(rows: DataFrame, min_chars: int) -> DataFrame:
    """``rows`` (doc, t, text) to one row per line with a key that counts: (doc, t, pos, h1, h2)."""
    lines = rows.select("doc", "t", F.posexplode(F.split(lower_ascii(F.col("text")), "\n", -1)).alias("pos", "line"))
    keyed = lines.select("doc", "t", "pos", F.btrim("line", F.lit(STRIPPED)).alias("key")).where(F.char_length("key") >= min_chars)
    return keyed.select("doc", "t", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def repeated_keys(lines: DataFrame, min_docs: int) -> DataFrame:
    """(h1, h2, first, n): keys in ``min_docs`` documents or more, n lines."""
    if min_docs == 2:
        keys = lines.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count("*").alias("n"))
        return keys.where("first < last").drop("last")
    pairs = lines.groupBy("h1", "h2", "doc").agg(F.count("*").alias("n"))
    keys = pairs.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.sum("n").alias("n"), F.count("*").alias("docs"))
    return keys.where(F.col("docs") >= min_docs).drop("docs")


def dropped_positions(lines: DataFrame, keys: DataFrame) -> DataFrame:
    """(doc, t, gone): the sorted 0-based positions that each text loses."""
    total = keys.agg(F.sum("n")).first()[0] or 0  # one number
    hot_rows = max(1000, -(-total // HOT_SHARE))
    keys = keys.withColumn("salts", F.ceil(F.col("n") / hot_rows).cast("int"))
    hot = F.broadcast(keys.where("salts > 1").select("h1", "h2", "salts"))  # under HOT_SHARE rows
    salted = lines.join(hot, ["h1", "h2"], "left").withColumn(
        "salt", F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc", "t", "pos"), F.col("salts")).cast("int"))
    )
    keys = keys.select("h1", "h2", "first", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    gone = salted.join(keys.hint("merge"), ["h1", "h2", "salt"]).where("doc > first")
    return gone.groupBy("doc", "t").agg(F.sort_array(F.collect_set("pos")).alias("gone"))


def kept_lines(lines: Column, gone: Column) -> Column:
    """``lines`` without the positions in ``gone``: the stretches between, in order."""
    ends = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(lines)))
    between = F.transform(
        F.sequence(F.lit(0), F.size(gone)),
        lambda i: F.slice(lines, F.get(ends, i) + 2, F.get(ends, i + 1) - F.get(ends, i) - 1),
    )
    return F.flatten(between)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 2, min_chars: int = 10, keep: list[str] | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_lines, n_dropped, kept_text (null where
    no line goes, as the text stays as it is), text, and ``row``, a struct of
    the columns in ``keep``."""
    if min_docs < 2:
        raise ValueError("a line that goes is in two documents at least")
    prepare(docs.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    doc = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID))
    row = F.struct(*[F.col(f"`{c}`") for c in keep or [id_col]])
    # equal texts lose equal positions in one document, so this pair is enough to find the row again
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), doc.alias("doc"), F.xxhash64(text).alias("t"), text.alias("text"), row.alias("row"))
    lines = exploded(rows, min_chars)
    keys, _ = store(repeated_keys(lines, min_docs), "repeated-lines")
    gone = dropped_positions(lines, keys).toDF("g_doc", "g_t", "gone")
    found = rows.join(gone, (F.col("doc") == F.col("g_doc")) & (F.col("t") == F.col("g_t")), "left")
    split = F.split("text", "\n", -1)
    return found.select(
        "doc_id",
        F.size(split).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNotNull(), F.array_join(kept_lines(split, F.col("gone")), "\n")).alias("kept_text"),
        "text",
        "row",
    )


def remove_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits: int) -> DataFrame:
    """``docs`` with its columns; texts that lose lines are replaced."""
    out = line_dedup(docs, id_col, text_col, keep=docs.columns, **limits)
    new = F.coalesce("kept_text", F.col("row").getField(text_col))
    return out.select(*[(new if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns])


ORACLE = r"""
WITH rows AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM rows),
k AS (SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
f AS (SELECT k.*, r.first IS NOT NULL AND k.doc_id <> r.first AS gone FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""


@register("op11_line_dedup", ORACLE)
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("kept_text", "text"), 256).alias("kept_sha256"))
