"""Exact dedup by distributed MSD radix partitioning (operator 4).

Texts are compared after deletion of space and U+0009..U+000D.  Every document
starts in one group.  Each round takes the next bytes of each text as its
digit (64 bytes, then four times as many each round, so even the longest text
needs few rounds) and splits the groups by digit and by whether the text ends
within it.  A group of one document, or whose texts have ended, is finished;
only the others go on, with the bytes not yet read.  Group sizes come from a
count that is combined before its shuffle, and groups larger than
``hot_rows`` take the documents to as many tasks as their size asks for, so a
group of copies of a third of all rows is never in one task.

Texts of a finished group agree in every byte; no digest decides.  Of equal
texts the row with the most code points in the original stays, then the
smallest doc_id.

Defined cases: a null text is empty, and empty texts are equal; a null doc_id
is larger than any other; of rows that repeat a doc_id and a text exactly one
is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import register
from .common import documents, prepare, remove, store, texts

STRIPPED = " \t\n\x0b\x0c\r"


def radix_groups(rows: DataFrame, first_digit: int = 64, growth: int = 4, hot_rows: int = 20_000) -> DataFrame:
    """``rows`` (doc_id, n_points, text_sha256, rest binary) to (doc_id,
    n_points, text_sha256, group): group is null for a text without equal."""
    spark = rows.sparkSession
    done: list[DataFrame] = []
    active = rows.withColumn("group", F.lit(0).cast("long"))
    width, held = first_digit, None
    while True:
        digit = F.substring("rest", 1, width)
        keyed = active.select(
            "doc_id",
            "n_points",
            "text_sha256",
            "group",
            digit.alias("digit"),
            (F.octet_length("rest") <= width).alias("ended"),
            F.expr(f"substring(rest, {width + 1})").alias("rest"),
        )
        counts = keyed.groupBy("group", "digit", "ended").agg(F.count("*").alias("n")).where("n > 1")
        split = counts.withColumn("next", F.monotonically_increasing_id()).withColumn(
            "salts", F.ceil(F.col("n") / hot_rows).cast("int")
        )
        # the new group ids are stored, so a lost executor cannot change them
        split, _ = store(split, "radix-groups")
        most = split.agg(F.max("salts")).first()[0]  # one number
        if most is None:
            done.append(active.select("doc_id", "n_points", "text_sha256", F.lit(None).cast("long").alias("group"), F.lit(0).alias("round")))
            break
        salted = split.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        hot = split.where("salts > 1").select("group", "digit", "ended", "salts")
        keyed = keyed.withColumn("salt", F.lit(0))
        if most > 1:  # at most rows / hot_rows groups
            keyed = keyed.drop("salt").join(F.broadcast(hot), ["group", "digit", "ended"], "left")
            keyed = keyed.withColumn("salt", F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int"))).drop("salts")
        # the groups grow with the corpus, so they are never broadcast, however few
        groups = salted.select("group", "digit", "ended", "salt", "next").hint("merge")
        moved = keyed.join(groups, ["group", "digit", "ended", "salt"], "left")
        moved = moved.select("doc_id", "n_points", "text_sha256", "ended", F.col("next").alias("group"), F.when(F.col("next").isNotNull() & ~F.col("ended"), F.col("rest")).alias("rest"))
        before = held
        moved, held = store(moved, "radix-rows")
        if before:
            remove(spark, before)
        over = F.col("group").isNull() | F.col("ended")
        finished, kept_path = store(moved.where(over).select("doc_id", "n_points", "text_sha256", "group", F.lit(width).alias("round")), "radix-done")
        done.append(finished)
        active = moved.where(~over).drop("ended")
        if active.isEmpty():
            break
        width *= growth
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept, text_sha256, n_points."""
    prepare(docs.sparkSession)
    rows = texts(docs, id_col, text_col).select("doc_id", F.length("text").alias("n_points"), F.translate("text", STRIPPED, "").cast("binary").alias("rest"))
    rows = rows.select("doc_id", "n_points", F.sha2("rest", 256).alias("text_sha256"), "rest")
    # ids of a round are unique within it only
    grouped = radix_groups(rows).withColumn("row", F.monotonically_increasing_id())
    grouped, _ = store(grouped, "radix-grouped")
    best = F.min(F.struct((-F.col("n_points")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("c"), F.col("row").alias("d")))
    classes = grouped.where("group is not null").groupBy("round", "group").agg(best.alias("best"), F.count("*").alias("group_size"))
    classes, _ = store(classes.select("round", "group", "best.c", "best.d", "group_size"), "radix-classes")
    return grouped.join(classes, ["round", "group"], "left").select(
        "doc_id",
        F.when(F.col("d").isNull(), F.col("doc_id")).otherwise(F.col("c")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("d").isNull() | (F.col("d") == F.col("row"))).alias("kept"),
        "text_sha256",
        "n_points",
    )


def keep_distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns.  The digest only
    finds the row that was decided on again."""
    stays = exact_dedup(docs, id_col, text_col).where("kept").select("doc_id", "text_sha256", "n_points").distinct()
    stays, _ = store(stays.toDF("k_id", "k_text", "k_points"), "stays")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.sha2(F.translate(text, STRIPPED, "").cast("binary"), 256).alias("t"),
        F.length(text).alias("n"),
    )
    same = F.col("id").eqNullSafe(F.col("k_id")) & (F.col("t") == F.col("k_text")) & (F.col("n") == F.col("k_points"))
    return keyed.join(stays, same, "left_semi").dropDuplicates(["id", "t", "n"]).select("row.*")


ORACLE = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS k FROM documents),
g AS (SELECT doc_id, first_value(doc_id) OVER (PARTITION BY k ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY k) AS group_size, sha256(k) AS text_sha256 FROM t)
SELECT doc_id, keep_id, group_size, keep_id = doc_id AS kept, text_sha256 FROM g
"""


@register("op4_radix_dedup", ORACLE)
def op4_radix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir)).drop("n_points")
