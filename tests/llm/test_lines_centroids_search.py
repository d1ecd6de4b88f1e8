"""Operators 11, 12 and 13 against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import centroids, lexical_search, line_dedup

from .conftest import got, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- line dedup --------------------------------------------------------------


def brute_lines(rows, min_docs=2, min_chars=10):
    no_id = (1 << 63) - 1
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    held = {}
    for d, t, _ in rows:
        for line in (t or "").split("\n"):
            held.setdefault(key(line), set()).add(no_id if d is None else d)
    out = []
    for d, t, _ in rows:
        lines = (t or "").split("\n")
        own = no_id if d is None else d
        kept = [x for x in lines if len(key(x)) < min_chars or len(held[key(x)]) < min_docs or min(held[key(x)]) == own]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def line_rows(rows):
    rnd = random.Random(31)
    common = [words(rnd, 6) for _ in range(8)] + ["İstanbul ÀÉ line", "short", "exactly 10", "nine char", " \t "]
    out = list(rows)
    for i in range(60):
        lines = [rnd.choice(common) if rnd.random() < 0.6 else words(rnd, 5) for _ in range(rnd.randrange(12))]
        lines = [rnd.choice([x, x.upper(), f" \t{x}\r", f"{x}\x0b"]) for x in lines]
        out.append((rnd.choice([None, 500 + i, 500 + i // 2]), "\n".join(lines) + rnd.choice(["", "\n", "\n\n"]), "s"))
    out.append((900, "\n".join([common[0]] * 3000 + ["own line of nine hundred"]), "s"))
    return out


def test_line_dedup(make, rows):
    table = line_rows(rows)
    for limits in ({}, {"min_docs": 3}, {"min_chars": 0}):
        out = line_dedup.line_dedup(make(table), **limits).withColumn("sha", F.sha2(F.coalesce("kept_text", "text"), 256))
        want = brute_lines(table, **limits)
        assert got(out, "doc_id", "n_lines", "n_dropped", "sha") == want
        assert sum(r[2] for r in want) > 100
    with pytest.raises(ValueError):
        line_dedup.line_dedup(make(table), min_docs=1)


def test_hot_lines_are_salted(make):
    """2,500 copies of a line are dealt over three salts."""
    rows = [(i, "a line that everyone has\n" + f"own line number {i}", "s") for i in range(2500)]
    out = line_dedup.line_dedup(make(rows)).collect()
    assert [r.doc_id for r in out if not r.n_dropped] == [0]
    assert {r.kept_text for r in out if r.n_dropped} == {f"own line number {i}" for i in range(1, 2500)}


def test_remove_lines_keeps_columns(make, rows):
    table = line_rows(rows)
    docs = make(table)
    out = line_dedup.remove_lines(docs)
    assert out.columns == docs.columns
    digests = sorted(((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in out.collect()), key=repr)
    assert digests == sorted(((r[0], r[3]) for r in brute_lines(table)), key=repr)
    assert out.where("text is null").count() == sum(t is None for _, t, _ in table)


# --- centroids ---------------------------------------------------------------


def brute_clusters(rows, width, scale, k, rounds):
    kept = [(i, [max(-centroids.LIMIT, min(centroids.LIMIT, math.floor(scale * x))) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    cents = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def near(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in cents]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        member = [near(v)[0] for _, v in kept]
        new = []
        for c, old in enumerate(cents):
            own = [v for (_, v), m in zip(kept, member) if m == c]
            new.append([sum(x) // len(own) for x in zip(*own)] if own else old)
        cents = new
    out = [(i, *near(v)) for i, v in kept]
    inertia = Counter()
    for _, c, d in out:
        inertia[c] += d
    fits = lambda n: n if n < 1 << 63 else None
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, c, d, fits(inertia[c]), fits(sum(inertia.values())), digest[c]) for i, c, d in out), key=repr)


def vectors(spark, rows):
    table = [(i, v, 1, "x", 7) for i, v in rows]
    return spark.createDataFrame(table, "vec_id long, embedding array<double>, cluster int, q string, distance int").repartition(3)


COLUMNS = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def test_centroids(spark):
    rnd = random.Random(37)
    rows = [(i, [rnd.gauss(i % 5, 0.4) for _ in range(6)]) for i in range(150)]
    rows += [(7, rows[7][1]), (None, [0.5] * 6), (None, [0.5] * 6), (200, None), (201, [1.0] * 5), (202, [1.0, None, 1.0, 1.0, 1.0, 1.0])]
    rows += [(203, [math.nan] * 6), (204, [math.inf] + [0.0] * 5), (205, [1e300, -1e300, 0.0, 0.0, 0.0, 0.0]), (206, [])]
    out, cents = centroids.cluster_vectors(vectors(spark, rows), width=6, scale=64, k=9, rounds=3)
    want = brute_clusters(rows, 6, 64, 9, 3)
    assert len(want) == 154 and got(out, *COLUMNS) == want and cents.shape == (9, 6)
    few, cents = centroids.cluster_vectors(vectors(spark, rows[:4]), width=6, k=9)
    assert got(few, *COLUMNS) == brute_clusters(rows[:4], 6, 64, 9, 3) and len(cents) == 4


def test_nearest_ties_go_to_the_smaller_number():
    q = np.array([[0, 0], [2, 2], [1, 1]], np.int32)
    cluster, distance = centroids.nearest(q, np.array([[2, 0], [0, 2], [2, 2], [2, 2]]))
    assert cluster.tolist() == [0, 2, 0] and distance.tolist() == [4, 0, 2]


# --- ranked search -----------------------------------------------------------


def brute_search(rows, items, k=20):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    docs = [(d, Counter(w), len(w)) for d, w in ((d, split(t)) for d, t, _ in rows) if w]
    n_docs, total = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for t, x in df.items()}
    out = []
    for item, text in items:
        scored = []
        for d, c, n in docs:
            m = 75 + 25 * n * n_docs // total
            s = sum(weight[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in split(text) if t in c)
            if s > 0:
                scored.append((-s, (1 << 63) - 1 if d is None else d))
        out += [(item, i + 1, None if d == (1 << 63) - 1 else d, -s) for i, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def search_tables(rows):
    rnd = random.Random(41)
    table = rows + [(700 + i, " ".join(words(rnd, rnd.randrange(1, 80)).split() + [f"rare{rnd.randrange(30)}"] * rnd.randrange(3)), "s") for i in range(300)]
    table += [(2000 + i, table[-1][1], "s") for i in range(40)]  # copies: ties by doc_id
    items = [(i, words(rnd, rnd.randrange(1, 25)) + f" RARE{i} rare{i}, rare{i + 1}!") for i in range(25)]
    items += [(30, None), (31, " !? "), (32, "İ ß 中文 123"), (None, table[-1][1]), (5, items[5][1]), (33, "nowhere at all")]
    return table, items


def item_table(spark, items):
    return spark.createDataFrame([(i, t, 9, "r") for i, t in items], "item_id long, text string, rank int, score string")


@pytest.mark.parametrize("blocks", [{}, {"block_pairs": 150, "block_terms": 40}])
def test_lexical_search(spark, make, rows, blocks):
    table, items = search_tables(rows)
    out = lexical_search.lexical_search(make(table), item_table(spark, items), **blocks)
    assert got(out, "item_id", "rank", "doc_id", "score") == brute_search(table, items)


def test_tree_leaves_nodes_out():
    """Much fewer nodes are visited than the tree has, and the best are exact."""
    rnd = np.random.default_rng(43)
    n_terms, n_docs = 400, 4000
    df = np.minimum(0.5, 2 / np.arange(1, n_terms + 1)[::-1])  # rarest first
    held = rnd.random((n_docs, n_terms)) < df
    doc, rank = np.nonzero(held)
    counts = rnd.integers(1, 6, len(doc))
    m = rnd.integers(80, 300, n_docs)
    offsets = np.searchsorted(doc, np.arange(n_docs + 1))
    tree = lexical_search.DocumentTree(np.arange(n_docs), m, offsets, rank, counts, n_terms)
    assert tree.size[0] == len(tree.term) < len(doc) + 1
    for _ in range(20):
        wanted = rnd.choice(n_terms, 20, replace=False)
        weights = (1000 * np.log(1 / df[wanted])).astype(np.int64)
        weight = np.zeros(n_terms, np.int64)
        weight[wanted] = weights
        score = np.zeros(n_docs, np.int64)
        np.add.at(score, doc, weight[rank] * lexical_search.impact(counts, m[doc]))
        want = sorted((-s, d) for d, s in enumerate(score.tolist()) if s > 0)[:10]
        (best, ids), visited = tree.search(wanted, weights, 10, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
        assert list(zip((-best).tolist(), ids.tolist())) == want
        assert visited * 4 < len(tree.term)


def test_empty_tables(spark, make, rows):
    none = make([])
    assert line_dedup.line_dedup(none).collect() == [] and line_dedup.remove_lines(none).collect() == []
    assert centroids.cluster_vectors(vectors(spark, []))[0].collect() == []
    assert lexical_search.lexical_search(none, item_table(spark, [(1, "word")])).collect() == []
    assert lexical_search.lexical_search(make(rows), item_table(spark, [])).collect() == []
