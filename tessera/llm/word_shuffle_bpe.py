"""Byte-level BPE by a global distinct-word shuffle (operator 3).

1. Texts are cut into pre-tokens.  A block (whole documents, ``block_chars``
   characters or one longer document) lists its distinct words once; its
   documents become sequences of places in that list.
2. The word lists, split into buckets by a hash of the word, are shuffled;
   each bucket encodes every distinct word once and sends the ids back to the
   blocks that hold the word.
3. Blocks, stored bucketed by block so that they are not shuffled, meet their
   ids; documents are reassembled by position and decoded again through the
   token-byte table (one entry per id of the vocabulary).

A word is listed once per block, so even the most frequent one is a small part
of the rows; buckets grow with ``spark.sql.shuffle.partitions``.

Defined cases: a null text is empty (no ids); null and repeated doc_ids give a
row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import register
from .common import documents, prepare, scratch, texts

BLOCKS = "block long, doc_ids array<long>, n_words array<int>, places binary, words array<struct<bucket: int, places: binary, words: binary>>"
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _pack(values: np.ndarray) -> bytes:
    """Unsigned 32-bit values by byte planes, compressed."""
    import zstandard

    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpack(raw: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _pack_strings(words: list[bytes]) -> bytes:
    import zstandard

    sizes = np.array([len(w) for w in words], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(len(words).to_bytes(4, "little") + sizes + b"".join(words))


def _unpack_strings(raw: bytes) -> list[bytes]:
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(raw)
    n = int.from_bytes(data[:4], "little")
    ends = (np.cumsum(np.frombuffer(data, "<u4", n, 4)) + 4 + 4 * n).tolist()
    return [data[a:b] for a, b in zip([4 + 4 * n, *ends], ends)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _blocks(rows: DataFrame, pattern: str, buckets: int, block_chars: int) -> DataFrame:
    def run(batches):
        import regex
        from pyspark import TaskContext

        # white space as the encoder's own pattern library defines it
        find = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        task = TaskContext.get().partitionId() << 32
        block, doc_ids, sequences, known, size = 0, [], [], {}, 0

        def emit():
            n_words = [len(s) for s in sequences]
            places = np.concatenate([*sequences, np.zeros(0, np.int64)])
            # frequent words first, for short places
            order = np.argsort(-np.bincount(places, minlength=len(known)), kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            words = [w.encode() for w in known]
            bucket = np.array([zlib.crc32(w) % buckets for w in words], np.int64)
            by_bucket = np.argsort(bucket, kind="stable")
            bounds = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1))
            lists = []
            for k in range(buckets):
                own = by_bucket[bounds[k] : bounds[k + 1]]
                if len(own):
                    lists.append({"bucket": k, "places": _pack(rank[own]), "words": _pack_strings([words[i] for i in own])})
            row = {"block": task | block, "doc_ids": doc_ids, "n_words": n_words, "places": _pack(rank[places]), "words": lists}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for b in batches:
            for d, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = find(text)
                fresh = set(found).difference(known)
                known.update(zip(fresh, range(len(known), len(known) + len(fresh))))
                sequences.append(np.fromiter(map(known.__getitem__, found), np.int64, len(found)))
                doc_ids.append(d)
                size += len(text)
                if size >= block_chars:
                    yield emit()
                    block, doc_ids, sequences, known, size = block + 1, [], [], {}, 0
        if doc_ids:
            yield emit()

    lists = pa.list_(pa.struct([("bucket", pa.int32()), ("places", pa.binary()), ("words", pa.binary())]))
    schema = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int32())), ("places", pa.binary()), ("words", lists)])
    return rows.mapInArrow(run, BLOCKS)


def _encode_bucket(path: str):
    """Every distinct word of a bucket once; ids back to each block."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        import tiktoken

        one_piece = tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=read_ranks(path), special_tokens={})
        ids: dict[bytes, bytes] = {}
        out = []
        for block, places, packed in zip(pdf["block"], pdf["places"], pdf["words"]):
            words = _unpack_strings(packed)
            for w in words:
                if w not in ids:
                    ids[w] = np.array(one_piece.encode_ordinary(w.decode()), "<u4").tobytes()
            own = [ids[w] for w in words]
            sizes = np.array([len(x) // 4 for x in own], "<u4")
            out.append((block, places, _pack(sizes), _pack(np.frombuffer(b"".join(own), "<u4"))))
        return pd.DataFrame(out, columns=["block", "places", "sizes", "ids"])

    return run


def _reassemble(path: str):
    def run(batches):
        shown: dict[int, bytes] = {i: w for w, i in read_ranks(path).items()}
        for b in batches:
            for row in b.to_pylist():
                lists = [(_unpack(x["places"]), _unpack(x["sizes"]).astype(np.int64), _unpack(x["ids"])) for x in row["lists"]]
                places = np.concatenate([np.zeros(0, np.int64), *(x[0] for x in lists)]).astype(np.int64)
                sizes = np.concatenate([np.zeros(0, np.int64), *(x[1] for x in lists)])
                ids = np.concatenate([np.zeros(0, np.uint32), *(x[2] for x in lists)])
                starts = np.cumsum(sizes) - sizes
                size_of, start_of = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
                size_of[places], start_of[places] = sizes, starts
                at = _unpack(row["places"]).astype(np.int64)
                out, done = [], 0
                for d, n in zip(row["doc_ids"], row["n_words"]):
                    own = at[done : done + n]
                    done += n
                    size = size_of[own]
                    total = int(size.sum())
                    within = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
                    doc = ids[np.repeat(start_of[own], size) + within].astype("<u4")
                    shown_bytes = b"".join(map(shown.__getitem__, doc.tolist()))
                    out.append((d, total, hashlib.sha256(doc.tobytes()).hexdigest(), hashlib.sha256(shown_bytes).hexdigest()))
                cols = list(zip(*out))
                types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [f.split()[0] for f in RESULT.split(", ")])

    return run


def encode_and_decode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", block_chars: int = 12 << 20) -> DataFrame:
    """Per document: doc_id, n_tokens, and SHA-256 of its ids and of its decoded bytes."""
    spark = docs.sparkSession
    prepare(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"word_blocks_{uuid.uuid4().hex}"
    blocks = _blocks(texts(docs, id_col, text_col), pattern, 2 * partitions, block_chars)
    blocks.write.option("compression", "none").option("path", scratch(spark, "word-blocks")).bucketBy(partitions, "block").saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the entry in the catalog; the files stay until the session ends
    lists = stored.select("block", F.explode("words").alias("w")).select("w.bucket", "block", "w.places", "w.words")
    encoded = lists.groupBy("bucket").applyInPandas(_encode_bucket(path), "block long, places binary, sizes binary, ids binary")
    per_block = encoded.groupBy("block").agg(F.collect_list(F.struct("places", "sizes", "ids")).alias("lists"))
    whole = stored.select("block", "doc_ids", "n_words", "places").join(per_block.hint("shuffle_hash"), "block", "left")
    whole = whole.select("doc_ids", "n_words", "places", F.coalesce("lists", F.array()).alias("lists"))
    return whole.mapInArrow(_reassemble(path), RESULT)


@register("op3_word_shuffle_bpe")
def op3_word_shuffle_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_and_decode(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
