"""Static binary-fuse filters (three hashes, 8-bit fingerprints) built and asked with numpy."""

from __future__ import annotations

import math

import numpy as np

HEADER = 3


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    x = keys.view(np.uint64) + np.uint64(seed)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53), (33, None)):
        x = x ^ (x >> np.uint64(shift))
        x = x * np.uint64(factor) if factor else x
    return x


def _slots(h: np.ndarray, length: int, segments: int) -> np.ndarray:
    """The three slots of each hash, in three neighbouring segments."""
    mask, span = np.uint64(length - 1), np.uint64(length * segments)
    first = ((h >> np.uint64(32)) * span) >> np.uint64(32)
    second = (first + np.uint64(length)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * length)) ^ (h & mask)
    return np.stack([first, second, third]).astype(np.int64)


def build(keys: np.ndarray) -> bytes:
    """A filter of distinct 64-bit keys: header (seed, segment length, segments), then one byte a slot.

    Keys that are alone in a slot are peeled off in rounds; their slots are then filled in the
    opposite order. A seed that leaves keys over is replaced by the next.
    """
    keys = np.unique(keys.astype(np.int64, copy=False))
    n = max(len(keys), 2)
    length = 1 << max(2, int(math.log(n) / math.log(3.33) + 2.25))
    wanted = n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
    segments = max(1, math.ceil(wanted / length) - 2)
    for seed in range(1, 1000):
        h = _mixed(keys, seed * 0x9E3779B97F4A7C15 % 2**64)
        at = _slots(h, length, segments)
        size = length * (segments + 2)
        count = np.bincount(at.ravel(), minlength=size)
        owner = np.zeros(size, dtype=np.int64)
        for row in at:
            np.add.at(owner, row, np.arange(len(keys)))
        rounds, left = [], len(keys)
        while left:
            alone = np.flatnonzero(count == 1)
            if not len(alone):
                break
            who, first = np.unique(owner[alone], return_index=True)
            rounds.append((who, alone[first]))
            for row in at:
                np.subtract.at(count, row[who], 1)
                np.subtract.at(owner, row[who], who)
            left -= len(who)
        if left:
            continue
        prints = np.zeros(size, dtype=np.uint8)
        mark = (h ^ (h >> np.uint64(32))).astype(np.uint8)
        for who, slot in reversed(rounds):
            others = prints[at[0, who]] ^ prints[at[1, who]] ^ prints[at[2, who]] ^ prints[slot]
            prints[slot] = mark[who] ^ others
        return np.array([seed, length, segments], dtype=np.int64).tobytes() + prints.tobytes()
    raise RuntimeError("no seed gives a filter")


def ask(filter_: bytes, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be in the filter: always for its keys, for others one time in 256."""
    seed, length, segments = np.frombuffer(filter_, dtype=np.int64, count=HEADER).tolist()
    prints = np.frombuffer(filter_, dtype=np.uint8, offset=8 * HEADER)
    h = _mixed(keys.astype(np.int64, copy=False), seed * 0x9E3779B97F4A7C15 % 2**64)
    at = _slots(h, length, segments)
    mark = (h ^ (h >> np.uint64(32))).astype(np.uint8)
    return (prints[at[0]] ^ prints[at[1]] ^ prints[at[2]]) == mark
