"""Token-id output: canonical length-limited Huffman files (operator 9).

``encode_documents`` encodes whole texts, ``write_store`` codes the ids of all
documents by one canonical code built from global counts and writes them in
ascending doc_id order, ``read_store`` decodes the files.

File format: Parquet as the container, one row per independent block of whole
documents.  A block holds its documents' ids, lengths and byte offsets, the
bit offset of every ``STEP``-th id of each document (the checkpoints, from
which decoding starts), and the code bits, each document beginning at a byte.
The code lengths are in the ``code`` table beside the blocks.

Defined cases: a null text is empty (its only id is the end id); rows with a
null doc_id come first; rows that repeat a doc_id are each written; an empty
table gives empty files; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import register
from .common import documents, prepare, remove, scratch, store, texts

STEP = 256
BLOCK_IDS = 1 << 18
ENCODED = "doc_id long, n_tokens long, ids binary, counts binary"
BLOCK = "part int, block int, doc_ids binary, n_ids binary, doc_bytes binary, marks binary, bits binary"
READ = "part int, doc_id long, local_start long, n_tokens long, ids_crc32 long, block_tokens long, block int"


def encode_documents(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(doc_id, n_tokens, ids, counts): ids packed little-endian, 2 or 4 bytes
    each; counts, in the first row of each batch, how often the batch has each
    id (32-bit ids, then 64-bit numbers)."""

    def run(batches):
        from .encode import encoder

        enc = encoder(path)
        end = np.array([end_id], enc.dtype).tobytes()
        for b in batches:
            if not b.num_rows:
                continue
            ids = [x + end for x in enc.encode(b.column(1).to_pylist())]
            n = pa.array([len(x) // enc.dtype.itemsize for x in ids], pa.int64())
            total = np.bincount(np.frombuffer(b"".join(ids), enc.dtype))
            seen = np.flatnonzero(total)
            counts = seen.astype("<u4").tobytes() + total[seen].astype("<u8").tobytes()
            columns = [b.column(0), n, pa.array(ids, pa.binary()), pa.array([counts] + [None] * (len(ids) - 1), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids", "counts"])

    return docs.mapInArrow(run, ENCODED)


def code_lengths(counts: np.ndarray, limit: int = 16) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); 0 for
    ids that do not occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(np.ceil(np.log2(len(used)))))
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.float64)
    n = len(order)
    levels, packs = [], np.zeros(0)
    for _ in range(limit):
        merged = np.concatenate([weight, packs])
        rank = np.argsort(merged, kind="stable")
        levels.append(rank < n)
        merged = merged[rank]
        packs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take = 2 * n - 2
    for leaf in reversed(levels):  # the cheapest nodes of a level: leaves and packages of the level below
        leaves = int(leaf[:take].sum())
        lengths[order[:leaves]] += 1
        take = 2 * (take - leaves)
    return lengths


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code of every id, ids in canonical order)."""
    ids = np.flatnonzero(lengths)
    ids = ids[np.argsort(lengths[ids], kind="stable")]
    codes = np.zeros(len(lengths), np.uint32)
    code, last = 0, 0
    by_length = np.bincount(lengths[ids], minlength=2)
    at = 0
    for n in range(1, len(by_length)):
        code <<= n - last
        last = n
        codes[ids[at : at + by_length[n]]] = np.arange(code, code + by_length[n], dtype=np.uint32)
        code += int(by_length[n])
        at += int(by_length[n])
    return codes, ids


def _encode_bits(ids: np.ndarray, n_ids: np.ndarray, lengths, codes):
    """Bits of several documents, each from a byte border: (bits, bytes of
    each document, bit offset within its document of every STEP-th id)."""
    size = lengths[ids]
    end = np.cumsum(size, dtype=np.int64)
    first = np.cumsum(n_ids) - n_ids
    doc_start = end[first] - size[first]
    doc_bits = end[first + n_ids - 1] - doc_start
    doc_bytes = (doc_bits + 7) // 8
    doc_at = np.cumsum(doc_bytes) - doc_bytes
    start = end - size
    marks = [np.arange(s, s + n, STEP) for s, n in zip(first.tolist(), n_ids.tolist())]
    lanes = [len(m) for m in marks]
    marks = (start[np.concatenate(marks)] - np.repeat(doc_start, lanes)).astype("<u4")
    start += np.repeat(doc_at * 8 - doc_start, n_ids)
    at, within = start >> 3, (start & 7).astype(np.uint8)
    wide = int(lengths.max()) > 17
    room, parts, kind = (48, 6, np.uint64) if wide else (24, 3, np.uint32)
    word = codes[ids].astype(kind) << (room - within - size).astype(kind)
    # codes that begin in one byte never overlap: their sum is their union, and exact in a double
    begun = np.bincount(at, weights=word, minlength=int(doc_bytes.sum())).astype(kind)
    bits = np.zeros(len(begun) + parts, np.uint8)
    for k in range(parts):
        bits[k : k + len(begun)] += (begun >> kind(room - 8 - 8 * k)).astype(np.uint8)
    return bits[: int(doc_bytes.sum())].tobytes(), doc_bytes, marks


def write_store(encoded: DataFrame, path: str, vocab: int) -> None:
    """Code and write documents in ascending doc_id order: each range of ids
    is one task's rows and one file, and the files' order is the ids' order."""
    spark = encoded.sparkSession
    wide = 2 if vocab <= 1 << 16 else 4

    def counted(batches):
        total = np.zeros(vocab, np.int64)
        for b in batches:
            for raw in b.column(0).to_pylist():
                n = len(raw) // 12
                total[np.frombuffer(raw, "<u4", n)] += np.frombuffer(raw, "<u8", n, 4 * n).astype(np.int64)
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(total[ids], pa.int64())], ["id", "n"])

    counts = np.zeros(vocab, np.int64)
    per_id = encoded.select("counts").where("counts is not null").mapInArrow(counted, "id int, n long")
    for r in per_id.groupBy("id").agg(F.sum("n").alias("n")).toLocalIterator():  # one row per id of the vocabulary at most
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts)
    codes, _ = canonical(lengths)
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(1).write.parquet(f"{path}/code")
    shared = spark.sparkContext.broadcast((lengths, codes))  # one entry per id of the vocabulary

    def coded(batches):
        from pyspark import TaskContext

        part, block = TaskContext.get().partitionId(), 0
        lengths, codes = shared.value
        doc_ids, raws, held = [], [], 0

        def emit():
            n_ids = np.array([len(x) // wide for x in raws], np.int64)
            bits, doc_bytes, marks = _encode_bits(np.frombuffer(b"".join(raws), f"<u{wide}"), n_ids, lengths, codes)
            known = np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes() + np.array([d is None for d in doc_ids], np.uint8).tobytes()
            row = [part, block, known, n_ids.astype("<u4").tobytes(), doc_bytes.astype("<u4").tobytes(), marks.tobytes(), bits]
            types = [pa.int32(), pa.int32()] + [pa.binary()] * 5
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], [f.split()[0] for f in BLOCK.split(", ")])

        for b in batches:
            for d, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                doc_ids.append(d)
                raws.append(x)
                held += len(x) // wide
                if held >= BLOCK_IDS:
                    yield emit()
                    doc_ids, raws, held, block = [], [], 0, block + 1
        if doc_ids:
            yield emit()

    ordered = encoded.select("doc_id", "ids").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(coded, BLOCK).write.option("compression", "none").parquet(f"{path}/blocks")
    shared.destroy()


def decode_block(row: dict, lengths: np.ndarray, table: tuple[np.ndarray, np.ndarray], width: int):
    """(doc_ids, n_ids, ids) of one block, all checkpoints side by side."""
    n_ids = np.frombuffer(row["n_ids"], "<u4").astype(np.int64)
    docs = len(n_ids)
    doc_ids = np.frombuffer(row["doc_ids"][: 8 * docs], "<i8").tolist()
    null = np.frombuffer(row["doc_ids"][8 * docs :], np.uint8)
    doc_ids = [None if z else d for d, z in zip(doc_ids, null)]
    doc_bytes = np.frombuffer(row["doc_bytes"], "<u4").astype(np.int64)
    marks = np.frombuffer(row["marks"], "<u4").astype(np.int64)
    lanes_of = (n_ids + STEP - 1) // STEP
    at = marks + np.repeat((np.cumsum(doc_bytes) - doc_bytes) * 8, lanes_of)
    first_lane = np.cumsum(lanes_of) - lanes_of
    lane = np.arange(len(at)) - np.repeat(first_lane, lanes_of)
    left = np.minimum(np.repeat(n_ids, lanes_of) - lane * STEP, STEP)
    out_at = np.repeat(np.cumsum(n_ids) - n_ids, lanes_of) + lane * STEP
    raw = np.concatenate([np.frombuffer(row["bits"], np.uint8), np.zeros(8, np.uint8)]).astype(np.uint32)
    windows = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    symbol, size = table
    ids = np.zeros(int(n_ids.sum()), np.uint32)
    order = np.argsort(-left, kind="stable")  # lanes end from the back
    at, left, out_at = at[order], left[order], out_at[order]
    shift = np.uint32(32 - width)
    for k in range(int(left[0]) if len(left) else 0):
        live = int(np.searchsorted(-left, -k, side="left"))
        a = at[:live]
        key = (windows[a >> 3] << (a & 7).astype(np.uint32)) >> shift
        ids[out_at[:live] + k] = symbol[key]
        a += size[key]
    return doc_ids, n_ids, ids


def decode_table(lengths: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], int]:
    """A table over the next ``width`` bits: (id, code length)."""
    width = int(lengths.max()) if len(lengths) else 1
    codes, ids = canonical(lengths)
    n = 1 << (width - lengths[ids].astype(np.int64))
    symbol = np.repeat(ids, n)
    size = np.repeat(lengths[ids], n).astype(np.int64)
    pad = (1 << width) - len(symbol)  # an incomplete code: one id only
    return (np.pad(symbol, (0, pad)), np.pad(size, (0, pad), constant_values=1)), width


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32, decoded from the files."""
    code = spark.read.schema("lengths binary").parquet(f"{path}/code").collect()  # one row, a byte per id
    lengths = np.frombuffer(bytes(code[0]["lengths"]), np.uint8)

    def decoded(batches):
        table, width = decode_table(lengths)
        for b in batches:
            for row in b.to_pylist():
                doc_ids, n_ids, ids = decode_block(row, lengths, table, width)
                raw = memoryview(ids.astype("<u4").tobytes())
                ends = np.cumsum(n_ids)
                starts = ends - n_ids
                crc = [zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip(starts.tolist(), ends.tolist())]
                k, total = len(doc_ids), int(ends[-1])
                cols = [[row["part"]] * k, doc_ids, starts, n_ids, crc, [total] * k, [row["block"]] * k]
                types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [f.split()[0] for f in READ.split(", ")])

    blocks = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    rows, _ = store(blocks.mapInArrow(decoded, READ), "decoded")
    # ids before each block and, a row per file, before each file
    per_block = rows.groupBy("part", "block").agg(F.max("block_tokens").alias("tokens"))
    w = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    per_block = per_block.select("part", "block", F.coalesce(F.sum("tokens").over(w), F.lit(0)).alias("block_start"), "tokens")
    before, total = {}, 0
    for r in per_block.groupBy("part").agg(F.sum("tokens").alias("n")).orderBy("part").toLocalIterator():
        before[r["part"]] = total
        total += r["n"]
    part_start = spark.createDataFrame([(k, v) for k, v in before.items()], "part int, part_start long")
    return (
        rows.join(per_block.select("part", "block", "block_start"), ["part", "block"])
        .join(part_start, "part")
        .select("doc_id", (F.col("part_start") + F.col("block_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
    )


@register("op9_token_store")
def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    prepare(spark)
    path = scratch(spark, "token-store")
    encoded, kept = store(encode_documents(texts(documents(spark, sf_dir)), public_tokenizers.path("byte_bpe_50k.json"), end_id=2), "encoded")
    write_store(encoded, path, vocab=50257)
    remove(spark, kept)
    return read_store(spark, path)
