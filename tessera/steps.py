"""Composable steps (B1, B2).

A step is a plain ``DataFrame -> DataFrame`` function registered under a
name; a run is ``df.transform(step1).transform(step2) ...`` -- one lazy plan.
The order rules of the reference are checked before anything runs: at most
one split, the split after curation / labelling / featurisation and before
preprocessing / selection / training / explanation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

STEPS: dict[str, Callable[[DataFrame], DataFrame]] = {}

# Fixed values that must equal the reference's behaviour: step families.
BEFORE_SPLIT = ("get_data", "curate", "label.", "featurize.")
AFTER_SPLIT = ("preprocess.", "select.", "train", "explain")


def step(name: str):
    def deco(fn):
        STEPS[name] = fn
        return fn
    return deco


def _family(name: str, prefixes) -> bool:
    return any(name == p or (p.endswith(".") and name.startswith(p)) for p in prefixes)


def validate_order(names: list[str]) -> None:
    """B2: step order rules."""
    unknown = [n for n in names if n not in STEPS]
    if unknown:
        raise ValueError(f"unknown steps: {unknown}")
    splits = [i for i, n in enumerate(names) if n == "split"]
    if len(splits) > 1:
        raise ValueError("at most one split step is allowed")
    if splits:
        s = splits[0]
        late = [n for n in names[s + 1:] if _family(n, BEFORE_SPLIT)]
        early = [n for n in names[:s] if _family(n, AFTER_SPLIT)]
        if late:
            raise ValueError(f"steps must run before split: {late}")
        if early:
            raise ValueError(f"steps must run after split: {early}")


def run_steps(df: DataFrame, names: list[str]) -> DataFrame:
    """B1: compose registered steps into one plan."""
    validate_order(names)
    out = df
    for n in names:
        out = out.transform(STEPS[n])
    return out
