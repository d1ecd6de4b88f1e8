"""Token counts of whole texts by overlap resynchronisation (operator 1).

Texts of at most ``chunk`` characters are encoded in place.  A longer text is
cut into chunks that overlap their successor; the chunks are spread over the
cluster and encoded with offsets.  A character position is a proven border
when the left chunk starts a pre-token there, far enough from its own end for
no special string to be cut, the right chunk starts a pre-token there too, and
the character is ASCII: scanning looks only ahead, so from a border on, both
encodings equal that of the whole text, and normalisation joins nothing to an
ASCII character.  Counts are spliced at the first common border of each seam.
Texts with a seam that has none are encoded again with wider overlaps (and,
when those reach the chunk, longer chunks) until all align.

Equal long texts are encoded once.  Defined cases: a null text is empty and
has no tokens; a null or repeated doc_id gives its row as any other; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import register
from .common import documents, prepare, store, texts

BORDERS = "array<struct<at: long, before: long>>"
CHUNK = f"key string, chunk long, n long, head {BORDERS}, tail {BORDERS}"


def _short_counts(docs: DataFrame, path: str) -> DataFrame:
    def run(batches):
        from .encode import encoder

        enc = encoder(path)
        for b in batches:
            n = [len(x) // enc.dtype.itemsize for x in enc.encode(b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return docs.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


def _chunk_counts(long_texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """Tokens of every chunk, and its possible borders in the overlap with its
    predecessor (head) and its successor (tail)."""

    def cut(batches):
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for k, s in enumerate(range(0, len(text), chunk)):
                    last = s + chunk >= len(text)
                    part = pa.array([text[s : s + chunk + overlap]], pa.string())
                    row = [pa.array([key]), pa.array([k], pa.int64()), pa.array([last]), part]
                    yield pa.RecordBatch.from_arrays(row, ["key", "chunk", "last", "part"])

    def borders(got, part, order, near):
        """(position, token) of ASCII characters that start a pre-token, as
        far as ``order`` goes before it leaves the overlap."""
        found = []
        for t in order:
            at = got.token_to_chars(t)[0]
            if not near(at):
                break
            if at < len(part) and part[at].isascii() and (t == 0 or got.token_to_word(t) != got.token_to_word(t - 1)):
                found.append((at, t))
        return found

    def encode(batches):
        from .encode import encoder

        enc = encoder(path)
        margin = max([0, *map(len, enc.specials)])
        for b in batches:
            out = []
            for key, k, last, part in zip(*(c.to_pylist() for c in b.columns)):
                got = enc.lib.encode(part, add_special_tokens=False)
                head = borders(got, part, range(len(got)), lambda at: at <= overlap)
                tail = [] if last else borders(got, part, range(len(got) - 1, -1, -1), lambda at: at >= chunk)
                row = {"key": key, "chunk": k, "n": len(got)}
                for name, found in (("head", head), ("tail", [x for x in tail if x[0] < len(part) - margin])):
                    row[name] = [{"at": k * chunk + at, "before": t} for at, t in found]
                out.append(row)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    pairs = pa.list_(pa.struct([("at", pa.int64()), ("before", pa.int64())]))
    schema = pa.schema([("key", pa.string()), ("chunk", pa.int64()), ("n", pa.int64()), ("head", pairs), ("tail", pairs)])
    parts = long_texts.mapInArrow(cut, "key string, chunk long, last boolean, part string")
    return parts.repartition("key", "chunk").mapInArrow(encode, CHUNK)


def _splice(chunks: DataFrame) -> DataFrame:
    """(key, n_tokens): null where a seam has no proven common border."""
    left = chunks.select("key", "chunk", "n", "tail")
    right = chunks.where("chunk > 0").select("key", (F.col("chunk") - 1).alias("chunk"), "head")
    border = F.array_min(F.array_intersect(F.col("tail.at"), F.col("head.at")))
    before = lambda side: F.get(F.filter(side, lambda x: x["at"] == F.col("border")), F.lit(0))["before"]
    seams = (
        right.join(left, ["key", "chunk"])
        .withColumn("border", border)
        .select("key", ((F.col("n") - before("tail")) + before("head")).alias("twice"))
    )
    lost = seams.groupBy("key").agg(F.sum("twice").alias("twice"), F.count("twice").alias("aligned"))
    sums = chunks.groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("chunks"))
    aligned = F.when(F.coalesce("aligned", F.lit(0)) == F.col("chunks") - 1, F.col("n") - F.coalesce("twice", F.lit(0)))
    return sums.join(lost, "key", "left").select("key", aligned.alias("n_tokens"))


def token_counts(
    docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text", chunk: int = 16_384, overlap: int = 128
) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit)."""
    prepare(docs.sparkSession)
    rows = texts(docs, id_col, text_col)
    short = rows.where(F.length("text") <= chunk).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    long_rows = rows.where(F.length("text") > chunk).withColumn("key", F.sha2("text", 256))
    pending = long_rows.select("key", "text").dropDuplicates(["key"])
    found = []
    while True:
        chunks, _ = store(_chunk_counts(pending, path, chunk, overlap), "chunks")
        spliced, _ = store(_splice(chunks), "spliced")
        found.append(spliced.where("n_tokens is not null"))
        unaligned = spliced.where("n_tokens is null").select("key")
        if unaligned.isEmpty():
            break
        pending = pending.join(unaligned, "key", "left_semi")
        overlap *= 4
        chunk = max(chunk, overlap)
    counts = found[0]
    for more in found[1:]:
        counts = counts.unionByName(more)
    counted = long_rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "key").join(counts, "key").drop("key")
    return _short_counts(short, path).unionByName(counted).withColumn("over_limit", F.col("n_tokens") > limit)


@register("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
