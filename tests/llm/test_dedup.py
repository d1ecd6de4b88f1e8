"""Operators 4, 6 and 8 against brute force."""

import hashlib
import random
import re

import numpy as np

from tessera.llm import ngram_join, radix_dedup, substring_dedup

from .conftest import got, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def last(d):
    return (d is None, d or 0)


# --- exact dedup -----------------------------------------------------------


def brute_exact(rows):
    classes = {}
    for d, t, _ in rows:
        classes.setdefault("".join(WORD.findall(t or "")), []).append((d, t or ""))
    out = []
    for k, members in classes.items():
        keep = min(members, key=lambda m: (-len(m[1]), last(m[0])))[0]
        out += [(d, keep, len(members), hashlib.sha256(k.encode()).hexdigest()) for d, _ in members]
    return out


def test_exact_dedup(make, rows):
    out = radix_dedup.exact_dedup(make(rows))
    assert got(out, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(brute_exact(rows), key=repr)
    kept = [r.text_sha256 for r in out.where("kept").collect()]
    assert len(kept) == len(set(kept)) == len({r[3] for r in brute_exact(rows)})


def test_exact_dedup_splits_deep_and_salts(make):
    """Texts that differ only in late bytes, prefixes of each other, a hot group."""
    rnd = random.Random(7)
    long = "".join(rnd.choice("abc") for _ in range(3000))
    table = [(i, long[:n], "s") for i, n in enumerate([0, 1, 63, 64, 65, 319, 320, 321, 3000])]
    table += [(100 + i, long[:2000] + rnd.choice("xy") + long[2001:], "s") for i in range(12)]
    table += [(1000 + i, "hot " * 30 + " " * (i % 3), "s") for i in range(60)]
    rows = make(table)
    old = radix_dedup.radix_groups.__defaults__
    try:
        radix_dedup.radix_groups.__defaults__ = (64, 4, 7)  # groups of more than 7 rows count as hot
        out = radix_dedup.exact_dedup(rows)
        result = got(out, "doc_id", "keep_id", "group_size", "text_sha256")
    finally:
        radix_dedup.radix_groups.__defaults__ = old
    assert result == sorted(brute_exact(table), key=repr)


def test_keep_distinct_keeps_columns(make, rows):
    docs = make(rows)
    out = radix_dedup.keep_distinct(docs)
    assert out.columns == docs.columns
    keep = {(k, h) for _, k, _, h in brute_exact(rows)}
    assert sorted((r.doc_id for r in out.collect()), key=last) == sorted((k for k, _ in keep), key=last)


# --- substring dedup -------------------------------------------------------


def brute_substring(rows, window=50):
    first = {}
    split = [(d, (t or "").encode().split()) for d, t, _ in rows]
    for d, w in split:
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, d), d, key=last)
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if last(first[tuple(w[i : i + window])]) < last(d):
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def test_substring_dedup(make, rows):
    out = substring_dedup.substring_dedup(make(rows))
    assert got(out, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute_substring(rows), key=repr)


def test_substring_dedup_boundaries(make):
    """Passages of 49 to 120 words cut, repeated, nested and chained at random."""
    rnd = random.Random(11)
    pool = [words(rnd, n).split() for n in (49, 50, 51, 55, 80, 120)] + [["again"] * 130]
    table = []
    for i in range(80):
        text = []
        for _ in range(rnd.randint(1, 4)):
            p = rnd.choice(pool)
            a, b = sorted(rnd.sample(range(len(p) + 1), 2)) if rnd.random() < 0.4 else (0, len(p))
            text += p[a:b] + words(rnd, rnd.choice([0, 0, 1, 7])).split()
        table.append((rnd.randint(0, 70), rnd.choice([" ", "\n", "  "]).join(text), "s"))
    want = brute_substring(table)
    assert sum(r[2] for r in want) > 1000
    assert got(substring_dedup.substring_dedup(make(table)), "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(want, key=repr)


def test_remove_substrings(make, rows):
    docs = make(rows)
    out = substring_dedup.remove_substrings(docs)
    assert out.columns == docs.columns
    want = sorted(
        (
            (d, (t if not n else None), h)
            for (d, t, _), (_, total, n, h) in zip(rows, brute_substring(rows))
            if not n or n < total
        ),
        key=repr,
    )
    have = [(r.doc_id, r.text, r.n_chars) for r in out.collect()]
    assert sorted((d for d, _, _ in have), key=last) == sorted((d for d, _, _ in want), key=last)
    for d, t, n in have:
        assert n == len(t or "")
        assert any(d == wd and (t == wt or (wt is None and hashlib.sha256((t or "").encode()).hexdigest() == h)) for wd, wt, h in want)


# --- n-gram join -----------------------------------------------------------


def brute_join(rows, size, limit):
    sets = []
    for _, t, _ in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append(frozenset(tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))) if w else frozenset())
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    links = 0
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= limit * (len(sets[i]) + len(sets[j]) - both):
                links += 1
                label[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return [(rows[i][0], len(sets[i]), min(groups[find(i)], key=last) if sets[i] else rows[i][0]) for i in range(len(rows))], links


def edited(rnd, base, edits):
    w = base.split()
    for _ in range(edits):
        w[rnd.randrange(len(w))] = f"edit{rnd.randrange(10**6)}"
    return " ".join(w)


def test_ngram_join(make, rows):
    want, _ = brute_join(rows, 4, 85)
    out = ngram_join.ngram_join(make(rows), size=4, limit_pct=85)
    assert got(out, "doc_id", "n_shingles", "component_id") == sorted(want, key=repr)


def test_ngram_join_near_the_limit(make):
    """Families around the limit, chains, short texts, a line in most texts, blocks of 16."""
    rnd = random.Random(13)
    line = words(rnd, 9)
    table = []
    for n in (3, 4, 5, 8, 20, 62, 64, 66, 130, 150, 400):
        base = words(rnd, n)
        for k in range(14):
            text = edited(rnd, base, rnd.randrange(0, max(1, n // 18) + 1))
            table.append((rnd.randrange(100_000), text + (" " + line if rnd.random() < 0.5 and n > 8 else ""), "s"))
    chain = words(rnd, 150).split()
    for k in range(20):
        table.append((200_000 + k, " ".join(chain[k * 3 :] + words(rnd, 3 * k).split()), "s"))
    for size, limit in ((4, 85), (5, 80)):
        want, links = brute_join(table, size, limit)
        assert links > 100
        out = ngram_join.ngram_join(make(table), size=size, limit_pct=limit, block=16)
        assert got(out, "doc_id", "n_shingles", "component_id") == sorted(want, key=repr)


def test_signatures_meet():
    """Every pair that may link shares the number of signatures it must."""
    rnd = np.random.default_rng(1)
    for limit in (80, 85, 90):
        for _ in range(300):
            n = int(rnd.integers(1, 700))
            a = np.unique(rnd.integers(0, 1 << 63, n, dtype=np.uint64))
            worst = ngram_join.differences(len(a), limit)
            out = int(rnd.integers(0, worst + 1))
            b = np.unique(np.concatenate([a[: len(a) - out], rnd.integers(0, 1 << 63, int(rnd.integers(0, worst - out + 1)), dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            if not len(b) or 100 * both < limit * (len(a) + len(b) - both):
                continue
            (sa, na), (sb, nb) = ngram_join.signatures(a, limit, 1), ngram_join.signatures(b, limit, 1)
            assert len(np.intersect1d(sa, sb)) >= min(na, nb) >= 1


def test_keep_unlinked(make, rows):
    docs = make(rows)
    out = ngram_join.keep_unlinked(docs, size=4, limit_pct=85)
    assert out.columns == docs.columns
    want, _ = brute_join(rows, 4, 85)
    kept = sorted({(d, c) for d, n, c in want if d == c}, key=repr)
    assert sorted((r.doc_id for r in out.collect()), key=last) == sorted((d for d, _ in kept), key=last)


def test_empty_tables(make):
    none = make([])
    for out in (radix_dedup.exact_dedup(none), radix_dedup.keep_distinct(none), substring_dedup.substring_dedup(none), substring_dedup.remove_substrings(none), ngram_join.ngram_join(none)):
        assert out.collect() == []
