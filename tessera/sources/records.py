"""Delimiter-separated records as a partitioned source.

``delimited_records`` is a Spark data source.  Its splits are byte ranges of the
files (``splitBytes`` each), of plain files and of gzip files alike; the driver
lists names and sizes only.  A record belongs to the split in which the delimiter
before it starts (the first of a file to its first split), so a split looks for
its first delimiter, and reads past its end until the last record it owns ends.
Splits therefore need no common knowledge, and any cut gives the same records.

A gzip file is cut where its members start: a split owns the members that start
in it, found by their magic bytes and proven by inflating them to their check
sum.  A file of one member is one task's, whatever its splits.

Columns: ``file``, ``split_start``, ``position`` (in the split), ``record`` and
``bad``.  ``bad`` is null for a good record; a record that is not UTF-8 comes
with replacement characters and its reason, a damaged gzip member as one row
without a record that tells the bytes lost, after the record it cuts.  Blank
records are left out; an empty file or folder gives no rows.  A record is one
row, so it must fit in memory; nothing else does.

Paths are those that pyarrow's file systems open on every node (a shared folder
or a URI).  Files whose names start with "_" or "." are passed over.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tessera.session import import_in_workers

SCHEMA = "file string, split_start long, position long, record string, bad string"
DELIMITER = "$$$$\n"
MAGIC = b"\x1f\x8b\x08"
CHUNK = 1 << 20
ARROW = pa.schema([("file", pa.string()), ("split_start", pa.int64()), ("position", pa.int64()), ("record", pa.string()), ("bad", pa.string())])


@dataclass
class ByteRange(InputPartition):
    file: str
    start: int
    end: int
    size: int


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def checked_delimiter(text: str) -> bytes:
    """A delimiter that cannot overlap itself, so that its places do not depend
    on where a search for it begins."""
    d = text.encode()
    if not d or any(d.startswith(d[-n:]) for n in range(1, len(d))):
        raise ValueError(f"delimiter {text!r} is empty or begins with its own end")
    return d


class Records(DataSource):
    @classmethod
    def name(cls) -> str:
        return "delimited_records"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return RecordReader(self.options)


class RecordReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.delimiter = checked_delimiter(options.get("delimiter", DELIMITER))
        self.split_bytes = max(1, int(options.get("splitBytes", 128 << 20)))

    def partitions(self) -> list[InputPartition]:
        system, path = file_system(self.path)
        found = system.get_file_info(path)
        if found.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        files = [found] if found.type == fs.FileType.File else system.get_file_info(fs.FileSelector(path, recursive=True))
        files = sorted((f.path, f.size) for f in files if f.type == fs.FileType.File and f.base_name[0] not in "_.")
        step = self.split_bytes
        return [ByteRange(p, at, min(at + step, size), size) for p, size in files for at in range(0, size, step)] or [ByteRange("", 0, 0, 0)]

    def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        if not part.size:
            return
        system, _ = file_system(self.path)
        with system.open_input_file(part.file) as f:
            packed = f.read(len(MAGIC)) == MAGIC
            pieces = inflated(f, part) if packed else plain(f, part)
            rows, held = [], 0
            for position, (record, bad) in enumerate(owned_records(pieces, part.start == 0, self.delimiter)):
                rows.append((part.file, part.start, position, record, bad))
                held += len(record or "")
                if held >= CHUNK or len(rows) == 4096:
                    yield batch(rows)
                    rows, held = [], 0
            if rows:
                yield batch(rows)


def batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), ARROW.types)], schema=ARROW)


# A piece is (bytes, whether they are the split's own, reason); with a reason, bytes
# are missing at this place.
Pieces = Iterator[tuple[bytes, bool, str | None]]


def plain(f, part: ByteRange) -> Pieces:
    f.seek(part.start)
    at = part.start
    while data := f.read(min(CHUNK, part.end - at) if at < part.end else CHUNK):
        yield data, at < part.end, None
        at += len(data)


def inflate(f, at: int) -> Iterator[bytes | int]:
    """Contents of the member at ``at`` in chunks, last the offset of its end;
    zlib.error if it is damaged or cut."""
    f.seek(at)
    z = zlib.decompressobj(31)
    while not z.eof:
        raw = z.unconsumed_tail
        if not raw:
            raw = f.read(1 << 16)
            at += len(raw)
            if not raw:
                raise zlib.error("the member is cut")
        yield z.decompress(raw, CHUNK)
    yield at - len(z.unused_data)


def next_member(f, start: int, end: int) -> int | None:
    """First place in [start, end) where a whole member starts."""
    at = start
    while at < end:
        f.seek(at)
        data = f.read(min(CHUNK, end - at) + len(MAGIC) - 1)
        found = data.find(MAGIC)
        if found < 0:
            at += CHUNK
            continue
        at += found
        if at >= end:
            return None
        try:
            for _ in inflate(f, at):
                pass
            return at
        except zlib.error:
            at += 1
    return None


def inflated(f, part: ByteRange) -> Pieces:
    """Members from the split's first; what is lost after a member is reported by
    the split that owns it (at the head of a file by its first split)."""
    at, own = (0 if part.start == 0 else next_member(f, part.start, part.end)), part.start == 0
    while at is not None and at < part.size:
        before, own = own, at < part.end
        try:
            if before and not own:  # proven before its bytes end the split, or its loss would go unreported
                for _ in inflate(f, at):
                    pass
            for out in inflate(f, at):
                if isinstance(out, int):
                    at = past_padding(f, out)
                else:
                    yield out, own, None
        except zlib.error as exc:
            lost = at
            at = next_member(f, at + 1, part.size)
            yield b"", before, f"{(part.size if at is None else at) - lost} bytes lost at {lost}: {exc}"


def past_padding(f, at: int) -> int:
    f.seek(at)
    while data := f.read(1 << 16):
        rest = data.lstrip(b"\0")
        if rest:
            return at + len(data) - len(rest)
        at += len(data)
    return at


def owned_records(pieces: Pieces, first: bool, delimiter: bytes) -> Iterator[tuple[str | None, str | None]]:
    """(record, reason) of the records whose preceding delimiter starts in the
    split's own bytes; ``first``: also the record before any delimiter."""
    held = bytearray()       # bytes from the last delimiter, or from where the search stands
    edge = None              # where in them the split's own bytes end
    inside, seen = first, 0  # within an owned record; no delimiter starts before ``seen``
    for data, own, lost in pieces:
        if lost:
            if inside and held.strip():
                yield readable(held, "cut by a damaged member")
            if own:
                yield None, lost
            inside, seen, edge = False, 0, None
            held.clear()
        if not own and edge is None:
            edge = len(held)
        held += data
        while (at := held.find(delimiter, seen)) >= 0:
            if inside and held[:at].strip():
                yield readable(held[:at])
            inside = edge is None or at < edge
            if not inside:
                return
            at += len(delimiter)
            del held[:at]
            edge = edge if edge is None else max(0, edge - at)
            seen = 0
        seen = max(0, len(held) - len(delimiter) + 1)
        if not inside:
            if edge is not None and seen >= edge:
                return
            del held[:seen]
            edge = edge if edge is None else edge - seen
            seen = 0
    if inside and held.strip():
        yield readable(held)


def readable(data: bytes | bytearray, bad: str | None = None) -> tuple[str, str | None]:
    try:
        return data.decode(), bad
    except UnicodeDecodeError:
        return data.decode(errors="replace"), bad or "not UTF-8"


def read_records(spark: SparkSession, path: str, delimiter: str = DELIMITER, split_bytes: int | None = None) -> DataFrame:
    """The records of a file or folder; splits are as large as Spark's own
    (``spark.sql.files.maxPartitionBytes``) unless ``split_bytes`` says otherwise."""
    checked_delimiter(delimiter)
    import_in_workers(spark)
    spark.dataSource.register(Records)
    if split_bytes is None:
        split_bytes = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return spark.read.format("delimited_records").option("delimiter", delimiter).option("splitBytes", str(split_bytes)).load(path)


def bad_records(records: DataFrame) -> DataFrame:
    """Records and bad ones per file."""
    return records.groupBy("file").agg(F.count("record").alias("n_records"), F.count("bad").alias("n_bad"))
