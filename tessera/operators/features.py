"""Featurisation and similarity.

Per-row library calls of the reference (descriptor calculators, fingerprint
generators) become either native column expressions over the whole text
(V4-V8, all inside one row, no shuffle; V4 hashes the n-grams of Spark's tokens
in Arrow batches, many at once) or a user-supplied Python function applied per Arrow batch with
``mapInPandas`` (V1-V3).  Similarity search (V10-V12) is an inverted-index
join against a size-checked broadcast query side, never a cross join.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, ByteType, IntegerType, StructField, StructType

from tessera.session import import_in_workers

EXPAND_ROWS = 1_000  # fingerprints expanded at once
SLICE_BYTES, SLICE_BITS = 1 << 20, 1 << 20  # of texts whose bits are made at once, and of their bitmaps
GRAMS = 1 << 14  # n-grams hashed at once

TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    """Lower-cased word tokens of the whole text (empty pieces dropped)."""
    return F.filter(F.split(F.lower(text), TOKEN_SPLIT), lambda t: t != "")


_MD5_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_MD5_TURNS = [7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4
_MD5_LONGEST = 55  # bytes of a message that is one block


def _md5_of_blocks(words: np.ndarray) -> np.ndarray:
    """First 32 bits of the md5 of one-block messages; ``words`` (16, n) holds the padded blocks."""
    n = words.shape[1]
    a, b, c, d = (np.full(n, x, np.uint32) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476))
    f, turned = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i in range(61):  # the first word is set in step 60 for the last time
        if i < 16:
            k = i
            np.bitwise_xor(c, d, out=f)
            np.bitwise_and(f, b, out=f)
            np.bitwise_xor(f, d, out=f)
        elif i < 32:
            k = (5 * i + 1) % 16
            np.bitwise_xor(b, c, out=f)
            np.bitwise_and(f, d, out=f)
            np.bitwise_xor(f, c, out=f)
        elif i < 48:
            k = (3 * i + 5) % 16
            np.bitwise_xor(b, c, out=f)
            np.bitwise_xor(f, d, out=f)
        else:
            k = 7 * i % 16
            np.invert(d, out=f)
            np.bitwise_or(f, b, out=f)
            np.bitwise_xor(f, c, out=f)
        np.add(f, a, out=f)
        np.add(f, np.uint32(_MD5_SINES[i]), out=f)
        np.add(f, words[k], out=f)
        np.left_shift(f, np.uint32(_MD5_TURNS[i]), out=turned)
        np.right_shift(f, np.uint32(32 - _MD5_TURNS[i]), out=f)
        np.bitwise_or(f, turned, out=f)
        np.add(f, b, out=a)
        a, b, c, d = d, a, b, c
    return (b + np.uint32(0x67452301)).byteswap()


def md5_numbers(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """First 32 bits of the md5 of each ``data[first:last]`` (bytes), as in its hex digits."""
    low = int(first.min(initial=0))
    data = np.concatenate([data[low : int(last.max(initial=0))], np.zeros(4 * 16, np.uint8)]).astype(np.uint32)
    at = data[:-3] | data[1:-2] << np.uint32(8) | data[2:-1] << np.uint32(16) | data[3:] << np.uint32(24)  # the word from each byte on
    size = last - first
    one = np.flatnonzero(size <= _MD5_LONGEST)
    words = np.zeros((16, len(one)), np.uint32)
    start, left, held = first[one] - low, size[one], np.arange(len(one))
    words[14] = left * 8
    kept = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)
    ending = np.array([0x80, 0x8000, 0x800000, 0x80000000, 0], np.uint32)
    for k in range(14):
        of = np.minimum(left, 4)
        words[k, held] = at[start] & kept[of] | ending[of]
        more = left >= 4
        start, left, held = start[more] + 4, left[more] - 4, held[more]
        if not len(held):
            break
    out = np.empty(len(size), np.uint32)
    out[one] = _md5_of_blocks(words)
    for k in np.flatnonzero(size > _MD5_LONGEST):
        message = data[first[k] - low : last[k] - low].astype(np.uint8).tobytes()
        out[k] = int.from_bytes(hashlib.md5(message, usedforsecurity=False).digest()[:4], "big")
    return out


def hashed_bits(df: DataFrame, id_col: str, text_col: str, radius: int = 2, n_bits: int = 2048, out: str = "bits") -> DataFrame:
    """V4: (id_col, out), the sorted distinct on-bits of the token n-grams of
    length 1..radius+1, bit = first 32 md5 bits mod n_bits.  Null for a null text.

    Spark lower-cases the whole text and puts a space between its tokens, so an
    n-gram is a piece of the text; Arrow batches hash them all at once, in slices
    of ``SLICE_BYTES`` (a longer text alone) and ``GRAMS`` n-grams."""
    import_in_workers(df.sparkSession)
    most = max(1, SLICE_BITS // n_bits)
    words = F.regexp_replace(F.lower(F.col(text_col)), TOKEN_SPLIT, " ")

    def bits_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes of the texts' sets, and their bits; ``ends``: of the texts in ``data``, from 0."""
        inner = data != 32
        edge = np.diff(np.concatenate([[False], inner, [False]]).astype(np.int8))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # tokens of two texts can touch
        cut = ends[1:-1][(ends[1:-1] > 0) & (ends[1:-1] < len(data))]
        cut = np.unique(cut[inner[cut] & inner[cut - 1]])
        begin, end = np.sort(np.concatenate([begin, cut])), np.sort(np.concatenate([end, cut]))
        text = np.searchsorted(ends[1:], begin, side="right")
        on = np.zeros((len(ends) - 1, n_bits), np.bool_)
        for length in range(1, radius + 2):
            n = len(begin) - length + 1
            for s in range(0, n, GRAMS):
                f, of = np.arange(s, min(n, s + GRAMS)), text[s : min(n, s + GRAMS)]
                f, of = (x[of == text[f + length - 1]] for x in (f, of))
                if len(f):
                    on[of, (md5_numbers(data, begin[f], end[f + length - 1]) % np.uint32(n_bits)).astype(np.int64)] = True
        return np.count_nonzero(on, axis=1), np.nonzero(on)[1].astype(np.int32)

    def run(batches):
        for b in batches:
            texts = b.column("words").cast(pa.string())
            null = texts.is_null().to_numpy(zero_copy_only=False)
            at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            s = 0
            while s < len(texts):
                e = min(max(s + 1, int(np.searchsorted(at, at[s] + SLICE_BYTES, side="right")) - 1), s + most, len(texts))
                sizes, bits = bits_of(data[at[s] : at[e]], at[s : e + 1] - at[s])
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), mask=np.append(null[s:e], False))
                yield pa.RecordBatch.from_arrays([b.column(id_col).slice(s, e - s), pa.ListArray.from_arrays(offsets, pa.array(bits))], [id_col, out])
                s = e

    schema = StructType([df.schema[id_col], StructField(out, ArrayType(IntegerType()))])
    return df.select(id_col, words.alias("words")).mapInArrow(run, schema)


def expand_bits(df: DataFrame, bits_col: str, n_bits: int, prefix: str = "fp_") -> DataFrame:
    """V5: on-bit array -> ``fp_0 .. fp_{n-1}`` 0/1 columns (small n only;
    large n stays sparse).  Every set is read once, not once per column; as with
    ``array_contains``, all columns of a null set are null, and those not found
    in a set with a null bit."""
    if n_bits > 4096:
        raise ValueError("expand only small fingerprints; keep large ones as on-bit arrays")
    at = df.columns.index(bits_col)

    def expand(batches):
        for whole in batches:
            for start in range(0, len(whole), EXPAND_ROWS):
                b = whole.slice(start, EXPAND_ROWS)
                sets = b.column(at)
                bits = sets.flatten()  # without those of null sets
                sizes = pc.fill_null(pc.list_value_length(sets), 0).to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(len(b)), sizes)
                unknown = np.zeros(len(b), bool)
                unknown[row[bits.is_null().to_numpy(zero_copy_only=False)]] = True
                bit = pc.fill_null(bits, -1).to_numpy(zero_copy_only=False)
                held = (bit >= 0) & (bit < n_bits)
                wide = np.zeros((len(b), n_bits), np.int8)
                wide[row[held], bit[held]] = 1
                mask = (unknown[:, None] & (wide == 0)).ravel() if unknown.any() else None
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(b) + 1, dtype=np.int32) * n_bits), pa.array(wide.ravel(), mask=mask), mask=sets.is_null())
                yield pa.RecordBatch.from_arrays([*b.columns, lists], names=[*b.schema.names, "__wide"])

    wide = df.mapInArrow(expand, StructType([*df.schema.fields, StructField("__wide", ArrayType(ByteType()))]))
    return wide.select(*[F.col(f"`{c}`") for c in df.columns], *[F.get("__wide", F.lit(i)).cast("int").alias(f"{prefix}{i}") for i in range(n_bits)])


def text_descriptors(text: Column) -> list[Column]:
    """V6: native descriptor profile of a text key."""
    return [
        F.length(text).alias("n_chars"),
        F.size(tokens(text)).alias("n_tokens"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).alias("n_upper"),
        F.regexp_count(text, F.lit(r"\p{N}")).alias("n_digits"),
        F.regexp_count(text, F.lit(r"\n")).alias("n_lines"),
    ]


def canonical_key(text: Column, separator: str = r"\.", prefer_largest: bool = True) -> Column:
    """V7 (native default canonicaliser): lower, trim, collapse blanks; split
    into fragments and keep the largest (first wins ties) or the first."""
    norm = F.regexp_replace(F.lower(F.trim(text)), r"\s+", " ")
    frags = F.filter(F.transform(F.split(norm, separator), lambda f: F.trim(f)), lambda f: f != "")
    if not prefer_largest:
        return F.element_at(frags, 1)
    best = F.aggregate(frags, F.lit("").cast("string"),
                       lambda acc, f: F.when(F.length(f) > F.length(acc), f).otherwise(acc))
    return F.nullif(best, F.lit(""))


def map_features(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType,
                 keep: list[str], on_error: str = "null", per_row: bool = False) -> DataFrame:
    """V1 / V2: user featuriser over Arrow batches.

    ``fn`` maps a pandas frame to one row of feature columns per input row,
    each from its own row.  A batch that raises is halved until only the rows
    that raise are left; those get NULL features (``on_error='null'``) or are
    dropped (``'drop'``).  Ids in ``keep`` are carried through.

    With ``per_row``, ``fn`` maps one row (a dict) to a dict of its features and
    is called once a row: the way for featurisers that often fail, which would
    have most batches halved down to rows.  A batch leaves as one batch.
    """
    feat_names = [f.name for f in schema.fields if f.name not in keep]

    def features(part: pd.DataFrame) -> list[pd.DataFrame]:
        try:
            out = fn(part).reset_index(drop=True)[feat_names]
            if len(out) != len(part):
                raise ValueError(f"{len(out)} rows of features for {len(part)} rows")
            return [pd.concat([part[keep].reset_index(drop=True), out], axis=1)]
        except Exception:  # noqa: BLE001 - failure of a row is the contract
            if len(part) > 1:
                half = len(part) // 2
                return features(part.iloc[:half]) + features(part.iloc[half:])
        if on_error == "drop":
            return []
        return [part[keep].reset_index(drop=True).assign(**dict.fromkeys(feat_names))]

    def one_by_one(pdf: pd.DataFrame) -> pd.DataFrame:
        names, found, held = list(pdf.columns), [], []
        for row in zip(*(pdf[c] for c in names)):
            try:
                out = fn(dict(zip(names, row)))
                found.append([out[f] for f in feat_names])
                held.append(True)
            except Exception:  # noqa: BLE001 - failure of a row is the contract
                found.append([None] * len(feat_names))
                held.append(on_error != "drop")
        columns = {f: pd.Series([x[i] for x in found], dtype=object) for i, f in enumerate(feat_names)}
        return pd.concat([pdf[keep].reset_index(drop=True), pd.DataFrame(columns)], axis=1)[held]

    def run(batches):
        for pdf in batches:
            if per_row:
                yield one_by_one(pdf)
            elif len(pdf):
                found = features(pdf)
                if found:  # a batch of its own for every piece would cost more than the features
                    yield pd.concat([x.astype(object) for x in found], ignore_index=True)

    return df.mapInPandas(run, schema)


def map_feature_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType,
                        keep: list[str]) -> DataFrame:
    """V3: batch featuriser; an exception nulls the whole batch (the Arrow
    batch size ``spark.sql.execution.arrow.maxRecordsPerBatch`` is the chunk)."""
    feat_names = [f.name for f in schema.fields if f.name not in keep]

    def run(batches):
        for pdf in batches:
            try:
                out = fn(pdf).reset_index(drop=True)[feat_names]
            except Exception:  # noqa: BLE001
                out = pd.DataFrame({c: [None] * len(pdf) for c in feat_names})
            yield pd.concat([pdf[keep].reset_index(drop=True), out], axis=1)

    return df.mapInPandas(run, schema)


# ---------------------------------------------------------------- similarity


def set_similarity(c: Column, a: Column, b: Column, n: Column | None = None, metric: str = "tanimoto",
                   alpha: float = 0.5, beta: float = 0.5) -> Column:
    """V10 / V11 from the counts: c = |A&B|, a = |A|, b = |B|, n = bit width."""
    c, a, b = c.cast("double"), a.cast("double"), b.cast("double")
    if metric == "tanimoto":
        return c / (a + b - c)
    if metric == "dice":
        return 2 * c / (a + b)
    if metric == "cosine":
        return c / F.sqrt(a * b)
    if metric == "sokal":
        return c / (2 * a + 2 * b - 3 * c)
    if metric == "russel":
        return c / n.cast("double")
    if metric == "kulczynski":
        return (c / a + c / b) / 2
    if metric == "mcconnaughey":
        return (c * c - (a - c) * (b - c)) / (a * b)
    if metric == "tversky":
        return c / (alpha * (a - c) + beta * (b - c) + c)
    raise ValueError(metric)


def top_k_neighbours(pairs: DataFrame, q_id: str, c_id: str, score: str, k: int = 5) -> DataFrame:
    """Top-k per query by score (ties by id).  ``row_number <= k`` lets
    Catalyst insert a per-partition WindowGroupLimit before the shuffle, so
    each map task forwards at most k rows per query."""
    w = Window.partitionBy(q_id).orderBy(F.desc(score), F.col(c_id))
    return pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def catalogue_flags(texts: DataFrame, id_col: str, text_col: str, patterns: DataFrame) -> DataFrame:
    """Rows matching any pattern of named catalogues; the matching
    catalogue names per row and the number of matching patterns.  The
    catalogue is a stated list: each pattern becomes one literal ``rlike``
    (compiled once) in a scan of the texts, without a join."""
    listed = [(r["catalog"], r["pattern"]) for r in patterns.select("catalog", "pattern").collect()]
    hit = [F.when(F.col(text_col).rlike(p), F.lit(c)) for c, p in listed]
    matched = F.filter(F.array(*hit) if hit else F.array().cast("array<string>"), lambda c: c.isNotNull())
    rows = texts.select(id_col, F.explode(matched).alias("catalog"))
    return rows.groupBy(id_col).agg(F.array_sort(F.collect_set("catalog")).alias("catalogs"), F.count(F.lit(1)).alias("n_matches"))


def kmeans_k(n: int) -> int:
    """k = clamp(n / 180, 4, 8)."""
    return int(min(8, max(4, math.floor(n / 180))))
