import gzip
import os
import random

import pytest

from tessera.sources import files as S
from tessera.sources import records as P

RECORDS = [f"{i}\n" + "x$$$y\n" * (i % 7) + "é" * (i * 37 % 211) + "\n" for i in range(120)]


def folder(tmp_path, **files):
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    return str(tmp_path)


def rows(spark, path, split_bytes, delimiter=P.DELIMITER):
    got = P.read_records(spark, path, delimiter, split_bytes).collect()
    return [(r.record, r.bad) for r in sorted(got, key=lambda r: (r.file, r.split_start, r.position))]


def direct(data, split_bytes, tmp_path, delimiter=P.DELIMITER):
    """The reader without Spark: all splits of one file, in order."""
    path = folder(tmp_path, one=data)
    reader = P.RecordReader({"path": path, "delimiter": delimiter, "splitBytes": str(split_bytes)})
    return [(r["record"], r["bad"]) for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]


def joined(texts):
    return "".join(t + P.DELIMITER for t in texts).encode()


def test_splits_of_one_file_give_its_records_once(spark, tmp_path):
    data = joined(RECORDS)
    assert rows(spark, folder(tmp_path, a=data, _b=b"hidden"), len(data) // 2 + 1) == [(r, None) for r in RECORDS]
    assert S.get_data(spark, "sdf", path=str(tmp_path / "a"), split_bytes=1000).rdd.getNumPartitions() == -(-len(data) // 1000)
    assert S.get_data(spark, "sdf", path="file:" + str(tmp_path)).count() == 120


@pytest.mark.parametrize("step", [1, 2, 3, 7, 64, 1000, 1 << 20])
def test_every_cut_gives_the_same_records(tmp_path, step):
    texts = RECORDS[:20]
    want = [(r, None) for r in texts]
    assert direct(joined(texts), step, tmp_path) == want
    assert direct(joined(texts)[: -len(P.DELIMITER)], step, tmp_path) == want
    assert direct(b"\n\n" + P.DELIMITER.encode() + joined(texts) + b"\n", step, tmp_path) == want


@pytest.mark.parametrize("step", [5, 100, 1 << 20])
def test_gzip_members_are_splits_and_records_may_span_them(tmp_path, step):
    data, rng = joined(RECORDS), random.Random(1)
    cuts = [0, *sorted(rng.sample(range(1, len(data)), 9)), len(data)]
    packed = b"".join(gzip.compress(data[a:b]) for a, b in zip(cuts, cuts[1:]))
    want = [(r, None) for r in RECORDS]
    assert direct(packed, step, tmp_path) == want
    assert direct(packed + bytes(100), step, tmp_path) == want
    assert direct(gzip.compress(data), step, tmp_path) == want
    # stored blocks keep a member inside a record in plain sight: it is data of the outer one
    texts = ["a\n", "b\n"]
    outer = gzip.compress(joined(texts) + b"tail\n", compresslevel=0)
    assert direct(outer, step, tmp_path) == [("a\n", None), ("b\n", None), ("tail\n", None)]


@pytest.mark.parametrize("step", [50, 400, 1 << 20])
def test_damaged_members_are_reported_once_and_the_rest_read(tmp_path, step):
    parts = [gzip.compress(joined(RECORDS[i : i + 10])) for i in range(0, 60, 10)]
    hurt = bytearray(parts[2])
    hurt[12:40] = bytes(28)
    got = direct(b"".join([*parts[:2], bytes(hurt), *parts[3:]]), step, tmp_path)
    good = [r for r, bad in got if not bad]
    assert set(good) <= set(RECORDS) and good[:20] == RECORDS[:20] and good[-29:] == RECORDS[31:60]
    lost = [bad for r, bad in got if r is None]
    assert len(lost) == 1 and lost[0].startswith(f"{len(hurt)} bytes lost at {len(parts[0] + parts[1])}")


@pytest.mark.parametrize("step", [50, 400, 1 << 20])
def test_damage_late_in_a_member_is_reported_once(tmp_path, monkeypatch, step):
    monkeypatch.setattr(P, "CHUNK", 64)
    parts = [gzip.compress(joined(RECORDS[i : i + 10])) for i in range(0, 60, 10)]
    hurt = parts[2][:-8] + bytes(8)  # the check sum and length
    got = direct(b"".join([*parts[:2], hurt, *parts[3:]]), step, tmp_path)
    assert [bad.split(":")[0] for r, bad in got if r is None] == [f"{len(hurt)} bytes lost at {len(parts[0] + parts[1])}"]
    good = [r for r, bad in got if not bad]
    assert good[:20] == RECORDS[:20] and good[-29:] == RECORDS[31:60] and len(set(good)) == len(good)


def test_cut_gzip_file_and_bytes_that_are_no_text(spark, tmp_path):
    whole = gzip.compress(os.urandom(50_000).hex().encode() + b"\n" + P.DELIMITER.encode() + b"last\n")
    got = direct(whole[:-20], 1 << 20, tmp_path)
    assert got[-1][0] is None and "the member is cut" in got[-1][1]
    path = folder(tmp_path, one=b"\xff\n$$$$\nok\n$$$$\n", two=b"")
    assert rows(spark, path, 4) == [("\ufffd\n", "not UTF-8"), ("ok\n", None)]
    assert [(r.n_records, r.n_bad) for r in P.bad_records(P.read_records(spark, path)).collect()] == [(2, 1)]


def test_empty_folder_missing_path_and_delimiters(spark, tmp_path):
    empty = tmp_path / "empty"
    empty.mkdir()
    assert P.read_records(spark, str(empty)).count() == 0
    with pytest.raises(Exception, match="nowhere"):
        P.read_records(spark, str(tmp_path / "nowhere")).count()
    for bad in ("", "abca", "\n\n"):
        with pytest.raises(ValueError, match="delimiter"):
            P.read_records(spark, str(empty), bad)
    assert direct("a,b,,c".encode(), 1, tmp_path, ",") == [("a", None), ("b", None), ("c", None)]
