"""WARC archives with a salvage reader (operator 7).

Writing: one record per page, composed by Spark SQL and written by Spark's
text sink with the record end (CR LF CR LF) as line separator, so the files
are plain WARC/1.1 wherever Spark can write.  Of equal payloads of at least
``revisit_bytes`` the smallest page_id is a response, the others revisit it;
the smallest id per digest comes from a combined aggregate, so a payload that
a third of all pages share meets no single task.

Reading: files are read as binary rows and parsed by ``salvage``, which takes
plain and gzip-member archives.  A file is bounded by ``archive_records`` and, to
a factor of two, by ``archive_bytes``: pages larger than their quotient go by
powers of two to files of fewer records, so a file of long pages is no larger
than one of short ones (but for a single page over the bound).
After a failed check (version line, headers, length, record end, digest,
damaged gzip member) it searches for the next valid member or version line,
goes on there, and reports the bytes between as a quarantined gap, with their
length and digest; ``log_gaps`` writes these as JSON lines.

Defined cases: null html is an empty payload; a null page_id is written
without a page id and comes back as null; rows that repeat the smallest
page_id of their payload are all responses; an empty table gives no archive
and no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import warnings
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import register
from .common import documents, prepare, scratch, store

END = b"\r\n\r\n"
MAGIC = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/\d+\.\d+\r\n")
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORDS = (
    "file string, at long, length long, gap string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
)


# --- writing ---------------------------------------------------------------


def revisits(pages: DataFrame, id_col: str, payload_col: str, revisit_bytes: int) -> DataFrame:
    """(page_id, payload, digest, n_bytes, first): first is the response's id."""
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "n_bytes": F.octet_length("payload").cast("long")})
    first = rows.where(F.col("n_bytes") >= revisit_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
    # only payloads that occur again; stored, so that the join below reads shuffled sides it can split
    first, _ = store(first.where("copies > 1").select("digest", "first"), "copies")
    again = rows.select("digest", "page_id").join(first, "digest").where("page_id > first or page_id is null")
    again, _ = store(again.select("digest", "page_id", "first").distinct(), "revisits")
    return rows.join(again.withColumnsRenamed({"page_id": "id", "digest": "d"}), F.col("page_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("d")), "left").drop("id", "d")


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", payload_col: str = "html", revisit_bytes: int = 100, archive_records: int = 2000, archive_bytes: int = 128 << 20) -> None:
    bound = max(1, archive_bytes // archive_records)
    doublings = lambda n: F.greatest(F.ceil(F.log2(n / bound)), F.lit(0)).cast("int")
    found = pages.select(doublings(F.octet_length(F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("x")))).alias("k"))
    sizes = sorted(r["k"] for r in found.distinct().collect()) or [0]  # at most 31 of them: a payload is under 2 GB
    rows = revisits(pages, id_col, payload_col, revisit_bytes)
    revisit = F.col("first").isNotNull()
    line = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts], F.lit("\r\n"))
    name = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type: ", F.when(revisit, "revisit").otherwise("response")),
        F.when(F.col("page_id").isNull(), F.lit("")).otherwise(line("WARC-Record-ID: ", name(F.col("page_id")))),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z\r\n"),
        line("WARC-Payload-Digest: sha256:", F.col("digest")),
        line("WARC-Payload-Length: ", F.col("n_bytes").cast("string")),
        F.when(revisit, F.concat(F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"), line("WARC-Refers-To: ", name(F.col("first"))))).otherwise(F.lit("")),
        F.lit("Content-Type: application/http;msgtype=response\r\n"),
        line("Content-Length: ", (F.lit(len(HTTP)) + F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes"))).cast("string")),
        F.lit("\r\n"),
        F.lit(HTTP),
        F.when(revisit, F.lit("")).otherwise(F.col("payload")),
    )
    for k in sizes:
        part = rows if len(sizes) == 1 else rows.where(doublings(F.greatest(F.col("n_bytes"), F.lit(1))) == k)
        writer = part.select(record.alias("value")).write.mode("append").option("lineSep", END.decode()).option("compression", "none")
        writer.option("maxRecordsPerFile", max(1, archive_records >> k)).text(path)


def member(record: bytes) -> bytes:
    """A record as one gzip member, as .warc.gz archives hold them."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


# --- reading ---------------------------------------------------------------


def _parse(data: bytes, at: int) -> tuple[dict, bytes, int]:
    """(headers, block, end) of the record at ``at``; ValueError if a check fails."""
    version = VERSION.match(data, at)
    if not version:
        raise ValueError("no version line")
    stop = data.find(END, at)
    if stop < 0:
        raise ValueError("headers do not end")
    headers = {}
    for line in data[version.end() : stop].split(b"\r\n"):
        key, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("bad header line")
        key = key.strip().lower().decode("latin-1")
        if key in headers and key != "warc-concurrent-to":  # a cut record runs into the next one
            raise ValueError("a header is repeated")
        headers[key] = value.strip().decode("latin-1")
    size = headers.get("content-length", "")
    if not (size.isascii() and size.isdigit()):
        raise ValueError("no content length")
    start, end = stop + 4, stop + 4 + int(size)
    if data[end : end + 4] != END:
        raise ValueError("the record does not end where its length says")
    block = data[start:end]
    digest = headers.get("warc-payload-digest", "")
    if headers.get("warc-type") == "response" and digest.startswith("sha256:"):
        if hashlib.sha256(block[block.find(END) + 4 :]).hexdigest() != digest[7:]:
            raise ValueError("payload digest differs")
    return headers, block, end + 4


def _inflate(data: bytes, at: int) -> tuple[bytes, int]:
    z, out, end, view = zlib.decompressobj(31), [], at, memoryview(data)
    try:
        while not z.eof and end < len(data):
            part = view[end : end + 65536]
            out.append(z.decompress(part))
            end += len(part)
    except zlib.error as exc:
        raise ValueError(f"gzip member: {exc}") from None
    if not z.eof:
        raise ValueError("gzip member is cut")
    return b"".join(out), end - len(z.unused_data)


def salvage(data: bytes) -> Iterator[tuple[int, int, str | None, dict, bytes]]:
    """(offset, length, gap, headers, block): a record, or with a reason in
    ``gap`` bytes that hold no valid record (then the block is those bytes)."""
    at, bad, why = 0, -1, ""
    while at < len(data):
        try:
            if data.startswith(MAGIC, at):
                inner, end = _inflate(data, at)
                headers, block, stop = _parse(inner, 0)
                if stop != len(inner):
                    raise ValueError("gzip member holds more than its record")
            else:
                headers, block, end = _parse(data, at)
        except ValueError as exc:
            if bad < 0:
                bad, why = at, str(exc)
            nexts = [x for x in (data.find(MAGIC, at + 1), (VERSION.search(data, at + 1) or _NONE).start()) if x >= 0]
            at = min(nexts, default=len(data))
            continue
        if bad >= 0:
            yield bad, at - bad, why, {}, data[bad:at]
            bad = -1
        yield at, end - at, None, headers, block
        at = end
    if bad >= 0:
        yield bad, len(data) - bad, why, {}, data[bad:]


class _Nowhere:
    @staticmethod
    def start() -> int:
        return -1


_NONE = _Nowhere()


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record and per quarantined gap (``gap`` tells why; payload and
    its length and digest are those of the gap's bytes)."""

    def run(batches):
        names = [f.split()[0] for f in RECORDS.split(", ")]
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for b in batches:
            for file, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows = []
                for at, length, gap, h, block in salvage(content):
                    if gap is not None:
                        h = {"warc-payload-digest": hashlib.sha256(block).hexdigest(), "warc-payload-length": str(length)}
                    body = block[block.find(END) + 4 :] if gap is None else block
                    n = h.get("warc-payload-length", "") or str(len(body))
                    digest = h.get("warc-payload-digest", "").removeprefix("sha256:") or None
                    own = (_page(h.get("warc-record-id")), int(n) if n.isdigit() else None, digest, h.get("warc-type"), _page(h.get("warc-refers-to")))
                    rows.append((file, at, length, gap, *own, body if payloads else None))
                    if len(rows) == 512:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(run, RECORDS)


def log_gaps(records: DataFrame, path: str) -> DataFrame:
    """Writes the quarantined gaps of read archives as JSON lines and returns them
    (file, at, length, gap, payload_digest)."""
    gaps = records.where("gap is not null").select("file", "at", "length", "gap", "payload_digest")
    gaps.write.json(path)
    return records.sparkSession.read.schema(gaps.schema).json(path)


ORACLE = """
WITH t AS (SELECT page_id, coalesce(html, '') AS p FROM pages),
f AS (SELECT page_id, octet_length(encode(p)) AS payload_bytes, sha256(p) AS payload_digest, min(page_id) OVER (PARTITION BY p) AS first FROM t),
r AS (SELECT *, payload_bytes >= 100 AND first < page_id AS again FROM f)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to FROM r
"""


@register("op7_warc", ORACLE)
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    path = scratch(spark, "warc")
    write_archives(documents(spark, sf_dir, "pages"), path)
    records, _ = store(read_archives(spark, path, payloads=False).drop("payload"), "warc-records")
    lost = log_gaps(records, scratch(spark, "warc-gaps")).agg(F.count("*"), F.sum("length")).first()
    if lost[0]:
        warnings.warn(f"{path}: {lost[0]} gaps of {lost[1]} bytes are quarantined", stacklevel=2)
    return records.where("gap is null").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
