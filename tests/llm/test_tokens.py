"""Operators 1, 3, 9 and 10 against the libraries themselves."""

import base64
import hashlib
import math
import random
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from tessera.llm import packing, token_counts, token_store, word_shuffle_bpe  # noqa: E402
from tessera.llm.common import prepare, scratch, texts  # noqa: E402
from tessera.llm.encode import PieceEncoder  # noqa: E402

from .conftest import got, words  # noqa: E402

BPE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def encode(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def packed(ids):
    return np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize("path", [BPE, WORD])
def test_pieces_equal_whole_texts(path):
    rnd = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "\t", "'s", "é", "é", "<|endoftext|>", "!", "1", "\0", "　", "中", "😀", " \n", "İ", "\x85", "A", "..."]
    sample = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(4000)]
    enc = PieceEncoder(path, max_pieces=500)
    want = enc.lib.encode_batch(sample, add_special_tokens=False)
    assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(sample)] == [w.ids for w in want]


@pytest.mark.parametrize("path", [BPE, WORD])
def test_full_table_keeps_pieces_met_often(path):
    """Emptied, it would hand the common words to the library again and again."""
    rnd = random.Random(2)
    parts = ["a", "b ", " ", "\n", "'s", "é", "<|endoftext|>", "\0", "中", " \n", "..."]
    enc = PieceEncoder(path, max_pieces=60)
    learnt, learn = [], enc._learn
    enc._learn = lambda new: (learnt.extend(new), learn(new))
    for k in range(40):
        sample = ["words met often " + " ".join(f"{rnd.random()}" for _ in range(20)), *("".join(rnd.choices(parts, k=rnd.randint(0, 9))) for _ in range(20))]
        want = enc.lib.encode_batch(sample, add_special_tokens=False)
        assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(sample)] == [w.ids for w in want]
    assert learnt.count("met") == learnt.count("often") == 1
    assert len(enc.table) < 200


def test_pieces_are_looked_up_once_a_group():
    class Table(dict):
        asked = 0

        def get(self, *args):
            Table.asked += 1
            return super().get(*args)

    enc = PieceEncoder(BPE, max_pieces=1000)
    enc.table = Table()
    sample = ["the same few words again", "the few"] * 500
    assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(sample)] == [encode(BPE, t) for t in sample[:2]] * 500
    assert Table.asked <= 5


def test_token_counts(make, rows):
    out = token_counts.token_counts(make(rows), WORD, limit=100)
    want = [(d, len((t or "").encode()), n := len(encode(WORD, t)), n > 100) for d, t, _ in rows]
    assert got(out, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)


def test_token_counts_widen_until_aligned(make):
    """Overlaps without a border (one long word, special strings, marks) are widened."""
    rnd = random.Random(5)
    texts_ = ["w" * 3000, "ab<|endoftext|>" * 200, "é" * 900 + " z" * 400, words(rnd, 700), "1 2 3\n" * 300, "x" * 700 + " " + words(rnd, 200), "中" * 1500]
    table = [(i, t, "s") for i, t in enumerate(texts_)]
    out = token_counts.token_counts(make(table), WORD, chunk=256, overlap=8)
    assert got(out, "doc_id", "n_tokens") == sorted([(i, len(encode(WORD, t))) for i, t, _ in table], key=repr)


def test_word_shuffle_bpe(make, rows):
    import tiktoken

    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=word_shuffle_bpe.read_ranks(MULTI), special_tokens={})
    odd = [(100, "\x1c a\x85b   c​ 　x\n \n", "z")]
    want = []
    for d, t, _ in rows + odd:
        ids = enc.encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    out = word_shuffle_bpe.encode_and_decode(make(rows + odd), MULTI, public_tokenizers.PATTERN, block_chars=2000)
    assert got(out, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)


def test_huffman_lengths_are_optimal_and_limited():
    counts = np.array([0, 50, 20, 10, 10, 5, 5, 0, 1])
    lengths = token_store.code_lengths(counts)
    assert math.isclose(sum(2.0 ** -int(n) for n in lengths if n), 1)
    heap = sorted(counts[counts > 0].tolist())
    cost = 0
    while len(heap) > 1:  # plain Huffman
        a, b, *heap = heap
        cost += a + b
        heap = sorted([*heap, a + b])
    assert int((lengths * counts).sum()) == cost
    skewed = np.array([1 << i for i in range(30)])
    limited = token_store.code_lengths(skewed, limit=8)
    assert limited.max() <= 8 and math.isclose(sum(2.0 ** -int(n) for n in limited), 1)
    assert token_store.code_lengths(np.array([0, 7, 0])).tolist() == [0, 1, 0]


def test_token_store(spark, make, rows):
    prepare(spark)
    path = scratch(spark, "test")
    token_store.write_store(token_store.encode_documents(texts(make(rows)), BPE, 2), path, 50257)
    out = token_store.read_store(spark, path).collect()
    by_id = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    start, want = 0, []
    for d, t, _ in by_id:
        ids = [*encode(BPE, t), 2]
        want.append((d, start, len(ids), zlib.crc32(packed(ids))))
        start += len(ids)
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in out), key=repr) == sorted(want, key=repr)


def check_packing(out, table, capacity):
    rows = [tuple(r) for r in out.collect()]
    left = [[d, [*encode(BPE, t), 0]] for d, t, _ in table]
    want = []
    for d, ids in left:
        first = (len(ids) - 1) % capacity + 1
        bounds = [0, *range(first, len(ids) + 1, capacity)]
        want += [(d, k, s, e - s, zlib.crc32(packed(ids[s:e]))) for k, (s, e) in enumerate(zip(bounds, bounds[1:]))]
    assert sorted((r[:5] for r in rows), key=repr) == sorted(want, key=repr)
    sequences = {}
    for r in rows:
        sequences.setdefault(r[5], []).append((r[6], r[3]))
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= capacity
    return len(sequences), math.ceil(sum(r[3] for r in rows) / capacity)


def test_packing(make, rows):
    out = packing.pack_documents(make(rows), BPE, capacity=256)
    check_packing(out, rows, 256)


@pytest.mark.parametrize("plan, over", [(packing.plan_runs, 1.02), (packing.best_plan, 1.001)])
def test_plan_is_close_to_the_bound(plan, over):
    rnd = random.Random(2)
    histogram = {}
    for _ in range(50_000):
        n = min(2048, int(rnd.lognormvariate(6, 1)) + 1)
        histogram[n] = histogram.get(n, 0) + 1
    runs = plan(histogram)
    room, placed = {}, {}
    for n, rank, count, first, offset in runs:
        placed.setdefault(n, []).append((rank, count))
        for s in range(first, first + count):
            room.setdefault(s, []).append((offset, n))
    for n, c in histogram.items():
        at = 0
        for rank, count in sorted(placed[n]):
            assert rank == at
            at += count
        assert at == c
    for pieces in room.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 2048
    bound = math.ceil(sum(n * c for n, c in histogram.items()) / 2048)
    assert len(room) <= over * bound


def test_configurations_win_without_small_pieces():
    """Pieces of a third and of two thirds and a little: pairs must not be broken."""
    histogram = {700: 900, 1300: 300, 690: 300, 660: 600}
    used = lambda runs: max(first + count for _, _, count, first, _ in runs)
    plain = packing.plan_runs(histogram, large=1)  # best fit alone
    assert used(packing.best_plan(histogram)) < used(plain)


def test_empty_tables(spark, make):
    none = make([])
    assert token_counts.token_counts(none, WORD).collect() == []
    assert word_shuffle_bpe.encode_and_decode(none, MULTI, public_tokenizers.PATTERN).collect() == []
    assert packing.pack_documents(none, BPE).collect() == []
    path = scratch(spark, "test")
    token_store.write_store(token_store.encode_documents(texts(none), BPE, 2), path, 50257)
    assert token_store.read_store(spark, path).collect() == []


def test_ranks_file():
    ranks = word_shuffle_bpe.read_ranks(MULTI)
    with open(MULTI, "rb") as f:
        token, rank = f.readline().split()
    assert ranks[base64.b64decode(token)] == int(rank)
