"""Featurisers, majority decisions and set counts that cost the same at any size."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tessera.operators import features as V
from tessera.operators import similarity
from tessera.plans import scalars
from tessera.plans.features import FEATURE_SCHEMA


def test_row_featuriser_is_called_once_a_row(spark):
    calls = spark.sparkContext.accumulator(0)

    def fn(row):
        calls.add(1)
        if row["text"] is None or len(row["text"]) % 3 == 0:
            raise ValueError
        return {"n_chars": len(row["text"]), "n_lines": 2**60 + 1}

    df = spark.createDataFrame([(i, "x" * (i % 10) if i else None) for i in range(50)], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.n_chars, r.n_lines) for r in V.map_features(df, fn, FEATURE_SCHEMA, ["doc_id"], per_row=True).collect()}
    assert calls.value == 50
    assert got == {i: (None, None) if i % 10 % 3 == 0 else (i % 10, 2**60 + 1) for i in range(50)}
    assert V.map_features(df, fn, FEATURE_SCHEMA, ["doc_id"], on_error="drop", per_row=True).count() == sum(i % 10 % 3 > 0 for i in range(50))


def test_a_halved_batch_leaves_as_one_batch(spark):
    def fn(pdf):
        if (pdf["doc_id"] % 5 == 0).any():
            raise ValueError
        return pd.DataFrame({"n_chars": pdf["doc_id"] + 2**60, "n_lines": pdf["doc_id"]})

    def count(batches):
        yield pd.DataFrame({"n": [sum(1 for _ in batches)]})

    df = spark.range(64).withColumnRenamed("id", "doc_id").coalesce(1)
    out = V.map_features(df, fn, FEATURE_SCHEMA, ["doc_id"])
    assert {r.doc_id: r.n_chars for r in out.collect()} == {i: None if i % 5 == 0 else i + 2**60 for i in range(64)}
    assert out.mapInPandas(count, "n long").first().n == 1


def test_expanded_bits_are_those_of_array_contains(spark):
    df = spark.createDataFrame([(1, [0, 3]), (2, []), (3, None), (4, [1, None]), (5, [2, 9, 2])], "id int, bits array<int>")
    wide = V.expand_bits(df, "bits", 4)
    plain = df.select("*", *[F.array_contains("bits", i).cast("int").alias(f"fp_{i}") for i in range(4)])
    assert sorted(wide.collect()) == sorted(plain.collect()) and wide.schema == plain.schema
    assert "array_contains" not in wide._jdf.queryExecution().toString()


def test_set_counts_hold_few_pairs_at_once(spark, monkeypatch):
    sets = spark.createDataFrame([(i, sorted({i % 7, i % 5, 9})) for i in range(40)], "doc_id long, bits array<int>").coalesce(1)
    queries = sets.where("doc_id < 3").withColumnRenamed("doc_id", "item_id")
    whole = sorted(similarity.overlap_counts(queries, sets, "item_id", "doc_id").collect())
    monkeypatch.setattr(similarity, "BLOCK_PAIRS", 6)
    found = similarity.overlap_counts(queries, sets, "item_id", "doc_id")
    assert sorted(found.collect()) == whole and len(whole) == 120

    def largest(batches):
        yield pd.DataFrame({"n": [max(len(b) for b in batches)]})

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    assert found.mapInPandas(largest, "n int").first().n <= 120


def test_a_block_of_keys_is_decided_at_once():
    no = scalars.NO_ID
    counts = pd.DataFrame(
        [(False, 1, "a", 2, 10), (False, 1, "b", 1, 5), (False, 2, "a", 1, 7), (False, 2, "b", 1, 6), (False, 3, None, 4, 8), (True, 0, "a", 1, 9), (False, 0, "b", 1, no)],
        columns=["__null", "__k", "__l", "__n", "__f"])
    got = scalars._decide(counts)[["__first", "__win", "__nl", "__ntop"]].to_numpy().tolist()
    assert sorted(got) == sorted([[5, 10, 2, 1], [6, 6, 2, 2], [8, no, 0, 0], [9, 9, 1, 1], [no, no, 1, 1]])


def test_hashed_bits_against_brute_force(spark, monkeypatch):
    import hashlib
    import re

    texts = [None, "", " ,. ", "one", "Two words", "the cat, the cat the CAT", "a b", "c", "d-e", "é ü 漢字 ΑΣ", "x" * 300 + " y", ("w" * 18 + " ") * 4, "12 34.56\n7\t8 9", " lead and trail "]
    texts += [" ".join(f"t{i * k % 97}" for i in range(k * 7)) for k in range(1, 25)]

    def brute(text, n_bits):
        t = re.findall(r"[^\W_]+", text.lower())
        grams = {" ".join(t[i : i + n]) for n in (1, 2, 3) for i in range(len(t) - n + 1)}
        return sorted({int(hashlib.md5(g.encode()).hexdigest()[:8], 16) % n_bits for g in grams})

    df = spark.createDataFrame(list(enumerate(texts)), "doc long, text string").coalesce(1)
    for limits, n_bits in (({}, 2048), ({"SLICE_BYTES": 40, "SLICE_BITS": 3000, "GRAMS": 5}, 1000)):
        for name, value in limits.items():
            monkeypatch.setattr(V, name, value)
        got = {r.doc: r.bits for r in V.hashed_bits(df, "doc", "text", n_bits=n_bits).collect()}
        assert got == {i: None if t is None else brute(t, n_bits) for i, t in enumerate(texts)}


def test_md5_numbers():
    import hashlib

    data = np.random.default_rng(3).integers(0, 256, 5_000).astype(np.uint8)
    first = np.arange(0, 4_800)
    last = first + np.arange(4_800) % 130  # up to two blocks, and none
    want = [int(hashlib.md5(data[a:b].tobytes()).hexdigest()[:8], 16) for a, b in zip(first, last)]
    assert V.md5_numbers(data, first, last).tolist() == want
