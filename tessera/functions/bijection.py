"""Keyed bijections and mixed-radix numbers: permutations and draws without
replacement that are computed per number, with no table and no sort."""

from __future__ import annotations

import numpy as np

ROUNDS = 6


def permute(x: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A bijection of [0, n), different for each seed: a Feistel network over
    the least even number of bits that holds n, walked on until it is back
    under n (four steps on average at most)."""
    if n < 1:
        return np.asarray(x, np.int64)
    half = np.uint64(max(1, (int(n - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = np.random.SeedSequence(seed & (2**64 - 1)).generate_state(ROUNDS, np.uint64)

    def once(v: np.ndarray) -> np.ndarray:
        left, right = v >> half, v & mask
        for key in keys:
            f = (right ^ key) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ (f >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            left, right = right, left ^ ((f >> np.uint64(29)) & mask)
        return left << half | right

    out = once(np.asarray(x, np.uint64))
    out_of_range = np.flatnonzero(out >= n)
    while len(out_of_range):
        out[out_of_range] = once(out[out_of_range])
        out_of_range = out_of_range[out[out_of_range] >= n]
    return out.astype(np.int64)


def digits(number: int, sizes: list[int]) -> list[int]:
    """Mixed-radix digits of ``number``, the first the slowest."""
    out = []
    for size in reversed(sizes):
        number, digit = divmod(int(number), size)
        out.append(digit)
    return out[::-1]


def draw(sizes: list[int], k: int, seed: int) -> list[list[int]]:
    """min(k, product) different combinations of positions, in drawn order;
    the product space is never expanded."""
    total = 1
    for size in sizes:
        total *= size
    if total >= 1 << 62:
        raise ValueError(f"a space of {total} combinations is too large to number")
    return [digits(i, sizes) for i in permute(np.arange(min(k, total)), total, seed)]
