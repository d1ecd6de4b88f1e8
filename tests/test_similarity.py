"""Set similarity against brute force."""

import os
import random

import pytest

from tessera.operators import similarity as Y


def table(spark, rows):
    return spark.createDataFrame([(i, b, "x", 1) for i, b in rows], "doc long, bits array<int>, class_id string, size int").repartition(4)


def sets(seed=3, n=250):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        base = rnd.sample(range(2048), rnd.choice([1, 2, 3, 5, 9, 20, 60, 150]))
        rows.append((i, base))
        for k in range(rnd.randrange(3)):  # near copies
            near = set(base)
            for _ in range(rnd.randrange(1 + len(base) // 6)):
                near.discard(rnd.choice(base))
                near.add(rnd.randrange(2048))
            rows.append((1000 + 10 * i + k, list(near)))
    rows += [(5000 + i, rows[7][1][::-1]) for i in range(50)]  # equal sets
    rows += [(6000, None), (6001, []), (None, [1, 2]), (6002, rows[9][1] * 2), (6002, rows[9][1])]
    return rows


def brute(rows, t):
    first = {}
    for i, b in rows:
        if b and i is not None:
            first[frozenset(b)] = min(first.get(frozenset(b), i), i)
    reps = sorted((i, s) for s, i in first.items())
    pairs = [(i, j, len(a & b)) for k, (i, a) in enumerate(reps) for j, b in reps[k + 1 :] if len(a & b) >= t * len(a | b) - 1e-12]
    return sorted(pairs), sorted((i, first[frozenset(b)]) for i, b in rows if b and i is not None)


@pytest.mark.parametrize("threshold", [0.5, 0.9, 1.0])
def test_similarity_join(spark, threshold):
    rows = sets()
    pairs, members, candidates = Y.similarity_join(table(spark, rows), "doc", threshold=threshold)
    want, classes = brute(rows, threshold)
    assert sorted((r.a_id, r.b_id, r.c) for r in pairs.collect()) == want
    assert sorted((r.id, r.class_id) for r in members.collect()) == classes
    assert threshold == 1.0 or len(want) > 10
    if threshold == 0.9:  # far fewer than all pairs are compared
        n = len({c for _, c in classes})
        assert candidates.count() < n * (n - 1) / 2 / 20


def test_similar_sets_share_a_part():
    rnd = random.Random(7)
    import numpy as np

    for t in (0.6, 0.8, 0.95):
        bands = Y.size_bands(t, 400)
        assert bands[0][0] == 1 and all(a[1] + 1 == b[0] for a, b in zip(bands, bands[1:]))
        for _ in range(200):
            a = set(rnd.sample(range(2048), rnd.randrange(1, 300)))
            b = set(a)
            while True:  # as far as the threshold lets it
                c = set(b)
                c.symmetric_difference_update(rnd.sample(range(2048), 1))
                if not c or len(a & c) < t * len(a | c):
                    break
                b = c
            small, large = sorted((a, b), key=len)
            band = next(k for k, (lo, hi) in enumerate(bands) if lo <= len(small) <= hi)
            other = next(k for k, (lo, hi) in enumerate(bands) if lo <= len(large) <= hi)
            assert other in (band, band + 1)
            n = np.array([Y._parts(t, bands[band][1])] * 2)
            h = Y.part_hashes(np.array([len(a), len(b)]), np.array([*a, *b]), n)
            assert (h[: n[0]] == h[n[0] :]).any()


def test_overlap_counts_in_blocks(spark):
    rows = sets(5, 60)
    queries = [(i, b) for i, b in rows if i is not None and i % 7 == 0]
    want = sorted((i, j, len(set(a) & set(b))) for i, a in queries if a for j, b in rows if j not in (None, 6002) and b and set(a) & set(b))
    small = [(i, b) for i, b in rows if i != 6002]
    for block in (2_000_000, 40):
        got = Y.overlap_counts(table(spark, queries).withColumnRenamed("doc", "q"), table(spark, small), "q", "doc", block_bits=block)
        assert sorted((r.q, r.doc, r.c) for r in got.collect()) == want
    top = Y.overlap_counts(table(spark, queries).withColumnRenamed("doc", "q"), table(spark, small).coalesce(1), "q", "doc", top_k=3).collect()
    sizes = {i: len(set(b)) for i, b in small if b}
    score = lambda i, j, c: c / (sizes[i] + sizes[j] - c)
    for i in {q for q, _, _ in want}:
        best = sorted((score(q, j, c) for q, j, c in want if q == i), reverse=True)[:3]
        assert sorted((score(r.q, r.doc, r.c) for r in top if r.q == i), reverse=True)[:3] == pytest.approx(best)
    assert Y.overlap_counts(table(spark, []).withColumnRenamed("doc", "q"), table(spark, rows), "q", "doc").collect() == []
    assert Y.similarity_join(table(spark, []), "doc")[0].collect() == []


def brute_pairs(spark, rows, t, **limits):
    with pytest.MonkeyPatch.context() as m:
        for name, value in limits.items():
            m.setattr(Y, name, value, raising=False)
        pairs, members, candidates = Y.similarity_join(table(spark, rows), "doc", threshold=t)
        want, classes = brute(rows, t)
        size = {i: len(set(b)) for i, b in rows if b}
        assert sorted((r.a_id, r.b_id, r.c) for r in pairs.collect()) == want
        assert all((r.a, r.b) == (size[r.a_id], size[r.b_id]) for r in pairs.collect())
        assert sorted((r.id, r.class_id) for r in members.collect()) == classes
        return want, candidates.count()


def test_dense_sets_do_not_meet_in_parts(spark):
    rnd = random.Random(11)
    rows = [(i, rnd.sample(range(2048), rnd.randrange(1500, 2000))) for i in range(150)]
    want, met = brute_pairs(spark, rows, 0.9, FEW_PAIRS=100)
    assert len(want) > 200 and met < len(want) / 10


@pytest.mark.parametrize("threshold", [0.5, 0.9, 1.0])
def test_blocks_find_the_same_pairs(spark, threshold):
    want, met = brute_pairs(spark, sets(), threshold, FEW_PAIRS=-1, MEETING_COST=10**9, BLOCK_VALUES=2048 * 16)
    assert met < len(want) + 100


def test_sets_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def make(batches):
        for b in batches:
            made.add(len(b))
            yield b

    rows = spark.createDataFrame([(i, [i % 5, 7, 9]) for i in range(30)], "doc long, bits array<int>")
    pairs, members, _ = Y.similarity_join(rows.mapInPandas(make, rows.schema), "doc", threshold=0.5)
    assert (pairs.count(), members.count(), made.value) == (10, 30, 30)


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.9, 1.0])
def test_parts_find_the_same_pairs(spark, threshold):
    want, met = brute_pairs(spark, sets(), threshold, SIGNATURE_COST=0, MEETING_COST=0)
    assert met >= len(want)
    wide = [(i, [b * 40_009 - 30_000_000 for b in bits or []]) for i, bits in sets(4, 120)]  # negative, over 16 bits
    assert brute_pairs(spark, wide, threshold)[1] >= len(brute(wide, threshold)[0])


def test_blocks_of_many_tiles(spark):
    rnd = random.Random(12)
    rows = [(i, rnd.sample(range(256), rnd.randrange(190, 256))) for i in range(400)] + [(500 + i, [i, i + 1]) for i in range(40)]
    want, met = brute_pairs(spark, rows, 0.75, SIGNATURE_COST=10**6, BLOCK_VALUES=256 * 4, BLOCK_TILES=8)  # 32 sets a block, 4 a tile
    assert len(want) > 5000 and met == 0


def test_similar_sets_share_enough_parts():
    import numpy as np

    rnd = random.Random(8)
    for _ in range(300):
        n = rnd.choice([30, 150, 600])
        a = set(rnd.sample(range(2048), n))
        d = Y._differing(0.9, n)  # the worst case: as many differing bits as there can be
        b = a | set(rnd.sample(sorted(set(range(2048)) - a), d))
        parts = np.array([Y._parts(0.9, n)] * 2)
        h = Y.part_hashes(np.array([len(a), len(b)]), np.array([*a, *b]), parts)
        assert (h[: parts[0]] == h[parts[0] :]).sum() >= Y._shared(0.9, n)
    assert [Y._shared(0.9, n) for n in (5, 150, 300, 2000)] == [1, 2, 3, 4]


def test_codes_of_sets():
    import numpy as np

    for bits in ([0], [7, 3, 3], [2047], list(range(2048)), [1, 5000], [70_000, 2, 2], [-4, 9, 0], [65_535], [2**31 - 1, -(2**31)]):
        size, code = Y.encode_set(np.array(bits, np.int32))
        assert size == len(set(bits)) and Y.decode_set(code).tolist() == sorted(set(bits))
        assert code == Y.encode_set(np.array(sorted(set(bits)), np.int32))[1]
        other = [3, 9, 2047, 70_000, -4]
        assert Y.common_bits(code, Y.encode_set(np.array(other, np.int32))[1]) == len(set(bits) & set(other))
    assert len(Y.encode_set(np.arange(2048, dtype=np.int32))[1]) == 257 and len(Y.encode_set(np.array([5, 2000], np.int32))[1]) == 5


def test_a_set_is_moved_as_a_few_hundred_bytes(spark):
    """Tables and candidates carried the numbers of a set, some thousand bytes each."""
    from urllib.parse import unquote, urlparse

    rnd = random.Random(13)
    rows = [(i, rnd.sample(range(2048), rnd.randrange(1500, 1700))) for i in range(120)]
    stored = []
    with pytest.MonkeyPatch.context() as m:
        for name in ("FEW_PAIRS", "SIGNATURE_COST", "MEETING_COST"):  # all by parts
            m.setattr(Y, name, 0, raising=False)
        m.setattr(Y, "written", lambda df, tag, f=Y.written: stored.append((tag, f(df, tag))) or stored[-1][1])
        pairs, _, candidates = Y.similarity_join(table(spark, rows), "doc", threshold=0.6)
        assert pairs.count() > 1000 and candidates.count() > 1000
    for tag, df in stored:
        if tag in ("sets", "set-classes"):
            assert sum(os.path.getsize(unquote(urlparse(f).path)) for f in df.inputFiles()) < 500 * len(rows)
    assert not any("array<int>" in str(kind) for _, df in stored for _, kind in df.dtypes)


def test_few_dense_sets_do_not_meet_in_parts(spark):
    """Bands of up to a million pairs were left to their parts, in which each pair of dense sets met."""
    rnd = random.Random(14)
    rows = [(i, rnd.sample(range(2048), rnd.randrange(1900, 2000))) for i in range(60)]
    want, met = brute_pairs(spark, rows, 0.9)
    assert len(want) > 1000 and met == 0
