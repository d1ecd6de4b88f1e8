"""Scalar column functions.

Every helper returns a ``Column`` built only from ``pyspark.sql.functions`` so
that it stays inside whole-stage codegen.  ANSI mode is on in Spark 4, so
parsing always goes through ``try_cast`` / ``try_divide``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
TRUE_TOKENS = ["1", "true", "yes", "on"]
# Missing-value spellings pandas' read_csv treats as NA (the default list).
PANDAS_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def token(c) -> Column:
    """lower(trim(x)) for strings."""
    return F.lower(F.trim(_c(c).cast("string")))


def safe_float(c) -> Column:
    """Blank / bad text -> NULL, else the parsed double."""
    s = F.nullif(F.trim(_c(c).cast("string")), F.lit(""))
    return s.try_cast("double")


def binary01(c) -> Column:
    """F2: value that is numerically 0 or 1 (number, '0', ' 1.0 ') -> int, else NULL."""
    d = F.trim(_c(c).cast("string")).try_cast("double")
    return F.when(d.isin(0.0, 1.0), d.cast("int"))


def as_bool(c) -> Column:
    """'1', 'true', 'yes', 'on' (any case, trimmed) -> true; else false."""
    return F.coalesce(token(c).isin(*TRUE_TOKENS), F.lit(False))


def csv_list(c) -> Column:
    """comma list -> array of trimmed, non-empty items."""
    return F.filter(F.transform(F.split(_c(c), ","), lambda x: F.trim(x)), lambda x: x != "")


def int_list(c) -> Column:
    """comma list -> array<int> (ANSI: bad item raises, like int())."""
    return F.transform(csv_list(c), lambda x: x.cast("int"))


def safe_token(c) -> Column:
    """every char that is not alphanumeric, '_' or '-' becomes '_'."""
    return F.regexp_replace(_c(c).cast("string"), r"[^\p{L}\p{N}_-]", "_")


def float_token(c) -> Column:
    """number for a file name, '.' -> 'p'."""
    return F.replace(_c(c).cast("double").cast("string"), F.lit("."), F.lit("p"))


def strip_prefix(c, prefix: str) -> Column:
    """remove ``prefix`` when present."""
    col = _c(c)
    return F.when(col.startswith(prefix), F.substring(col, len(prefix) + 1, 1 << 30)).otherwise(col)


def sigmoid(c) -> Column:
    """F8."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(c)))


def is_finite(c) -> Column:
    """not NULL, not NaN, not +-inf."""
    col = _c(c).cast("double")
    return col.isNotNull() & ~F.isnan(col) & (F.abs(col) < F.lit(float("inf")))


def finite_or_null(c) -> Column:
    col = _c(c).cast("double")
    return F.when(is_finite(col), col)


def elapsed_seconds(start, end) -> Column:
    """Whole seconds between two ISO strings, >= 0, NULL if one is missing."""
    s = F.try_to_timestamp(_c(start).cast("string"))
    e = F.try_to_timestamp(_c(end).cast("string"))
    diff = (F.unix_timestamp(e) - F.unix_timestamp(s)).cast("long")
    # greatest() skips NULLs, so guard explicitly: a missing end stays NULL.
    return F.when(diff.isNotNull(), F.greatest(F.lit(0).cast("long"), diff))


def append_reason(reasons, reason: str) -> Column:
    """append ``reason`` to a '; ' list unless already present."""
    r = _c(reasons)
    present = F.array_contains(F.split(r, "; ?"), F.lit(reason))
    return (
        F.when(r.isNull() | (F.trim(r) == ""), F.lit(reason))
        .when(present, r)
        .otherwise(F.concat_ws("; ", r, F.lit(reason)))
    )


def first_non_blank(*cols) -> Column:
    """F16."""
    return F.coalesce(*[F.nullif(F.trim(_c(c).cast("string")), F.lit("")) for c in cols])


def na_to_null(c) -> Column:
    """Pandas NA spellings -> NULL."""
    col = _c(c)
    return F.when(F.trim(col).isin(*PANDAS_NA_TOKENS) | col.isNull(), F.lit(None)).otherwise(col)


def pearson(x: Column, y: Column) -> Column:
    """Aggregate: pairwise-complete Pearson r; null when a side is constant
    (``corr`` divides by zero there under ANSI)."""
    a, b = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def whole_number(c: Column) -> Column:
    """Long of an integer in any notation (``7``, ``7.0``, ``1E3``), exact over
    the whole range of longs; null for anything else."""
    text = F.trim(c.cast("string"))
    number = text.try_cast("decimal(38,10)")
    return F.coalesce(text.try_cast("long"), F.when(number == F.floor(number), number).try_cast("long"))
