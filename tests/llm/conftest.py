import random

import pytest

EXTRA = "lang string, source string, n_chars long, n_tokens int, kept string, text_key string, ord string, row string, label string"
VOCABULARY = [a + b for a in "ka te mi so lu né ßo ra".split() for b in "ba dor fen gil hum jet".split()]


def words(rnd, n):
    return " ".join(rnd.choice(VOCABULARY) for _ in range(n))


def corpus(seed=3):
    """Ids with nulls and repeats; null, blank, repeated, near-equal and very long texts."""
    rnd = random.Random(seed)
    base = words(rnd, 120)
    near = base.split()
    near[60] = "changed"
    passage = words(rnd, 70)
    return [
        (1, None, "a"),
        (2, "", "a"),
        (3, " \n\t ", None),
        (None, words(rnd, 60), "a"),
        (4, "short text", "b"),
        (5, base, "b"),
        (5, base, "b"),
        (6, base.replace(" ", "  ", 3), "b"),
        (7, " ".join(near), "b"),
        (8, words(rnd, 40) + "\n" + passage + "\n" + words(rnd, 40), "c"),
        (9, passage + " " + words(rnd, 30), "c"),
        (10, words(rnd, 9000), "c"),
        (11, "x" * 50_000, "c"),
        (12, "a\x00b <|endoftext|>  'll  don't\n\n é İ 中文 123!!! ", "d"),
        (13, "line one here\n" * 40, "d"),
        (14, "*** $$$ word " * 60, "d"),
        (15, base.upper(), "d"),
        (16, words(rnd, 55) + " Released under the MIT License.", "a"),
    ]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def make(spark):
    """Documents with further columns whose names clash with those used inside."""

    def run(rows):
        extra = [(r[0], r[1], "en", r[2], len(r[1] or ""), 7, "x", "y", "z", "w", "v") for r in rows]
        return spark.createDataFrame(extra, f"doc_id long, text string, {EXTRA}").repartition(3)

    return run


def got(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
