"""Host-level quality rules (operator 5), DataFrame functions only.

1. Per document: word, symbol and repetition counts, the base verdict, and the
   soft rules it fails.
2. Per domain: the share of documents that fail the base or a soft rule,
   shrunk towards the corpus by a beta prior fitted to all domains' rates by
   the method of moments.
3. Domain verdicts are joined back.  A document goes if it fails the base
   rules, two soft rules, or one soft rule on a domain whose shrunk rate is
   over ``host_limit``; a document that fails no rule is kept on any domain.
   Without a limit (None) the domain is judged against the fitted prior: its
   shrunk rate is over the prior's mean by more than ``MARGIN`` of the prior's
   standard deviation.  A limit that no domain reaches would decide nothing.
   There, symbols in every third word or more are a soft rule of their own
   (``FITTED_RULES``), so texts of bare symbols go on any domain.

Counts are stored once, so texts are scanned once; the domain join carries
counts only, and a domain of a third of all rows is split by the adaptive join
(the domain table is stored, so both sides come straight from a shuffle).

Defined cases: a null text has no words and fails the base; a null domain is a
domain of its own; null and repeated doc_ids give a row each; with one domain
or equal rates the shrunk rate is the corpus rate; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import register
from .common import SPACE, documents, prepare, store

SYMBOLS = "#*$%&|<>"
STRIPPED = " \t\n\x0b\x0c\r"


def repeated_words(words: str) -> F.Column:
    """Words in 3-word windows found twice or more: sort the windows, keep
    those equal to a neighbour, and add up the words they cover."""
    return F.expr(
        f"""aggregate(
              array_sort(filter(transform({words}, (x, j) -> if(
                  x.w = get({words}, j - 1).w or x.w = get({words}, j + 1).w, x.i, null)), p -> p is not null)),
              named_struct('covered', 0L, 'until', 0),
              (a, p) -> named_struct('covered', a.covered + 3 - greatest(a.until - p, 0), 'until', p + 3)
           ).covered"""
    )


def base_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "source", rows: bool = False) -> DataFrame:
    """Counts per document; with ``rows`` also the whole input row (``row``)."""
    carried = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if rows else []
    own = ["row"] if rows else []
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    counted = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{domain_col}`").cast("string").alias("domain"), text.alias("text"), *carried)
    bare = F.translate("text", STRIPPED, "")
    ends = F.regexp_replace("text", rf"\A{SPACE}|{SPACE}\z", "")
    counted = counted.select(
        *own,
        "doc_id",
        "domain",
        F.when(F.length(bare) > 0, F.split(ends, SPACE)).otherwise(F.array().cast("array<string>")).alias("words"),
        F.length(bare).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, STRIPPED, "")) > 0).alias("lines"),
    )
    counted = counted.select(
        *own,
        "doc_id",
        "domain",
        F.size("words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            """sort_array(transform(slice(words, 1, greatest(size(words) - 2, 0)),
                 (x, i) -> named_struct('w', concat_ws(' ', x, get(words, i + 1), get(words, i + 2)), 'i', i)))"""
        ).alias("windows"),
    )
    return counted.withColumn("n_repeat_words", repeated_words("windows")).drop("windows")


BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"
SOFT_RULES = (
    "10 * n_symbols > n_words",
    "n_symbols > n_words",
    "word_chars < 3 * n_words OR word_chars > 10 * n_words",
    "10 * n_dup_lines > 3 * n_lines",
    "100 * n_repeat_words > 30 * n_words",
)
SOFT = " + ".join(f"CASE WHEN {rule} THEN 1 ELSE 0 END" for rule in SOFT_RULES)
#: Implies the first soft rule: it adds no failed document, only a second failure.
FITTED_RULES = (*SOFT_RULES, "10 * n_symbols > 3 * n_words")
FITTED_SOFT = " + ".join(f"CASE WHEN {rule} THEN 1 ELSE 0 END" for rule in FITTED_RULES)
#: Standard deviations of the prior by which a bad domain's shrunk rate is over its mean.
MARGIN = 0.5


def shrunk_rates(counts: DataFrame) -> DataFrame:
    """(domain, rate, bar): failure rates shrunk by a beta prior over all
    domains, and the rate over which the prior calls a domain bad."""
    by = counts.groupBy("domain").agg(F.count("*").alias("n"), F.sum((F.col("base_failed") | (F.col("soft_failed") > 0)).cast("long")).alias("k"))
    by, _ = store(by, "domains")
    share = F.col("k") / F.col("n")
    prior = by.agg(F.avg(share).alias("m"), F.var_pop(share).alias("v"), (F.sum("k") / F.sum("n")).alias("corpus"))
    strength = F.greatest(F.col("m") * (1 - F.col("m")) / F.col("v") - 1, F.lit(0.0))
    shrunk = (F.col("k") + F.col("m") * F.col("strength")) / (F.col("n") + F.col("strength"))
    # ``prior`` is one row
    joined = by.crossJoin(F.broadcast(prior)).withColumn("strength", F.when(F.col("v") > 1e-12, strength))
    bar = F.col("m") + MARGIN * F.sqrt(F.col("m") * (1 - F.col("m")) / (F.col("strength") + 1))
    unfitted = F.col("strength").isNull()
    return joined.select("domain", F.when(unfitted, F.col("corpus")).otherwise(shrunk).alias("rate"), F.when(unfitted, F.col("corpus")).otherwise(bar).alias("bar"))


def host_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "source", host_limit: float | None = 0.5) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept."""
    judged = _judged(base_counts(docs, id_col, text_col, domain_col), host_limit)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def keep_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "source", host_limit: float | None = 0.5) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns."""
    judged = _judged(base_counts(docs, id_col, text_col, domain_col, rows=True), host_limit)
    return judged.where("kept").select("row.*")


def _judged(counts: DataFrame, host_limit: float | None) -> DataFrame:
    prepare(counts.sparkSession)
    soft = FITTED_SOFT if host_limit is None else SOFT
    counts, _ = store(counts.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("soft_failed", F.expr(soft)), "quality")
    rates, _ = store(shrunk_rates(counts), "rates")
    rates = rates.withColumnRenamed("domain", "host")
    judged = counts.join(rates, counts["domain"].eqNullSafe(rates["host"]), "left")
    bar = F.col("bar") if host_limit is None else F.lit(host_limit)
    verdict = ~F.col("base_failed") & (F.col("soft_failed") < 2) & ~((F.col("soft_failed") > 0) & (F.col("rate") > bar))
    return judged.withColumn("kept", verdict)


ORACLE = rf"""
WITH t AS (SELECT doc_id, source AS domain, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, domain, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
wins AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS k
         FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM wins) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, i + unnest([0, 1, 2]) AS p FROM twice) GROUP BY doc_id),
c AS (SELECT w.doc_id, domain, len(words) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
      FROM w LEFT JOIN covered USING (doc_id)),
f AS (SELECT *, {BASE_FAILED} AS base_failed, {SOFT} AS soft_failed FROM c),
d AS (SELECT domain, count(*) AS n, count(*) FILTER (WHERE base_failed OR soft_failed > 0) AS k FROM f GROUP BY domain),
p AS (SELECT avg(k / n) AS m, var_pop(k / n) AS v, sum(k) / sum(n) AS corpus FROM d),
s AS (SELECT *, CASE WHEN v > 1e-12 THEN greatest(m * (1 - m) / v - 1, 0) END AS strength FROM p),
r AS (SELECT domain, CASE WHEN strength IS NULL THEN corpus ELSE (k + m * strength) / (n + strength) END AS rate FROM d, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND soft_failed < 2 AND NOT (soft_failed > 0 AND rate > 0.5) AS kept
FROM f JOIN r ON f.domain IS NOT DISTINCT FROM r.domain
"""


@register("op5_host_quality", ORACLE)
def op5_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_quality(documents(spark, sf_dir))
