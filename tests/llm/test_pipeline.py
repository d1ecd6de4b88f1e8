"""The pipeline's stages, one after the other, against brute force."""

import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402

from .conftest import words  # noqa: E402
from .test_dedup import WORD, brute_exact, brute_join, brute_substring, edited  # noqa: E402
from .test_rules import brute_quality  # noqa: E402
from .test_tokens import check_packing  # noqa: E402


def table():
    rnd = random.Random(31)
    passage = words(rnd, 60)
    out = []
    for i in range(60):
        text = words(rnd, rnd.randrange(30, 400))
        if i % 6 == 0 and out:
            text = out[rnd.randrange(len(out))][1]
        elif i % 7 == 0 and out:
            text = edited(rnd, out[rnd.randrange(len(out))][1] or words(rnd, 90), 1)
        elif i % 5 == 0:
            text += "\n" + passage
        elif i % 11 == 0:
            text += " ####" * 200
        out.append((i, text if i != 17 else None, f"s{i % 3}"))
    return out


def test_stages_against_brute_force(make, spark):
    docs, rows = make(table()), table()
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, "")
        if k == 0:
            keep = {r[0] for r in brute_quality(rows) if r[-1]}
        elif k == 1:
            keep = {r[1] for r in brute_exact(rows)}
        elif k == 2:
            keep = {r[2] for r in brute_join(rows, 5, 80)[0]}
        elif k == 3:
            removed = {d: (n, total) for d, total, n, _ in brute_substring(rows)}
            keep = {d for d, (n, total) in removed.items() if not n or n < total}
        else:
            check_packing(docs, rows, 2048)
            break
        assert docs.columns == columns
        got = {r.doc_id: r for r in docs.collect()}
        assert set(got) == keep and len(keep) < len(rows) + (k == 3), name
        if k == 3:
            assert any(n for n, _ in removed.values())
            for d, t, _ in rows:
                if d in keep:
                    n = removed[d][0]
                    assert (got[d].text == t) if not n else len(WORD.findall(got[d].text)) == removed[d][1] - n
        rows = [(d, got[d].text, s) for d, _, s in rows if d in keep]


def test_run_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
