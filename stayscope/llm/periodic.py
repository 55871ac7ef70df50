"""Periodic runs of words: squares caught online by blocks of two to the power k words, merged into runs.

A block of b words that is complete gets a catcher: for the next words it compares the last b words
with the block, at distances 2b-1 to 4b-2. A square whose period lies there holds a whole block in
its first half, so some catcher of size b meets it. Two catchers of each size are awake at a time.
Words are compared by fingerprints of the suffix, one size made of two of the size below, and each
catch is then proved and stretched on the words themselves, so fingerprints can't change a result.
Catches of one period in neighbouring blocks, and later ones inside a run, are one run; a run that
reaches the end of the stream grows with it. Words come in pieces of any size, with equal results.

Within a run of four periods, a smaller period of all of it divides the larger, and both stretch
equally far. So of several periods of one stretch the smallest is the run's.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayscope.llm.common import WORD, map_texts, or_empty, table

POWER, LEAST = 4, 6
STREAM_WORDS = 200_000
PIECE_WORDS = 1 << 16
KEPT_BLOCKS = 10
WORDS = re.compile(WORD)
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Fingerprints of pairs of fingerprints."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


class Catchers:
    """Runs of a growing stream of word numbers, of at least `power` periods and `least` words.

    A negative number occurs once and parts the stream.
    """

    def __init__(self, power: int = POWER, least: int = LEAST):
        self.power, self.least = power, least
        self.words, self.size = np.empty(1024, dtype=np.int64), 0
        self.levels: list[tuple[int, np.ndarray]] = []  # first start kept, fingerprints by start
        self.by_period: dict[int, list[list[int]]] = {}  # [start, end, period]
        self.open: list[list[int]] = []
        self.longest = self.stretch = 0

    def append(self, words: np.ndarray) -> list[tuple[int, int]]:
        """Add words; returns start and period of squares that are complete now and lie in no run known before."""
        old, n = self.size, self.size + len(words)
        if n > len(self.words):
            self.words = np.concatenate([self.words[:old], np.empty(max(n, old), dtype=np.int64)])
        self.words[old:n], self.size = words, n
        self._note_stretches(words)
        caught, level, block = self._advance(), 0, 1
        while 4 * block - 2 <= self.longest:
            first, names, fresh = self._suffixes(level, block, old)
            for p, j0, j1 in self._chains(block, first, names, fresh):
                caught += self._merge(p, j0 * block, (j1 + 1) * block + p)
            level, block = level + 1, 2 * block
        return caught

    def runs(self) -> list[tuple[int, int, int]]:
        """Start, length and period of all runs of the stream so far, by start and period."""
        smallest: dict[tuple[int, int], int] = {}
        for p in sorted(self.by_period):
            for s, e, _ in self.by_period[p]:
                if e - s >= max(self.least, self.power * p):
                    smallest.setdefault((s, e), p)
        return sorted((s, e - s, p) for (s, e), p in smallest.items())

    def _note_stretches(self, words: np.ndarray) -> None:
        ends = np.flatnonzero(words < 0)
        if len(ends):
            parts = np.diff(ends, prepend=-1 - self.stretch) - 1
            self.stretch = len(words) - 1 - int(ends[-1])
            self.longest = max(self.longest, int(parts.max()))
        else:
            self.stretch += len(words)
        self.longest = max(self.longest, self.stretch)

    def _suffixes(self, level: int, block: int, old: int) -> tuple[int, np.ndarray, int]:
        """First start kept, fingerprints of all windows of `block` words from there, first start that is new."""
        below_first, below = self.levels[level - 1] if level else (0, None)
        is_new = level == len(self.levels)
        first, kept = (below_first, np.empty(0, dtype=np.uint64)) if is_new else self.levels[level]
        at = first + len(kept)
        if level:
            half = block // 2
            left, right = below[at - below_first : len(below) - half], below[at - below_first + half :]
            made = _mixed(left, right) if len(right) else np.empty(0, dtype=np.uint64)
        else:
            words = self.words[at : self.size].astype(np.uint64)
            made = _mixed(words, np.uint64(block))
        names = np.concatenate([kept, made])
        spare = max(0, len(names) - (KEPT_BLOCKS * block + self.size - old))
        stored = (first + spare, names[spare:])
        self.levels[level:level + 1] = [stored]
        fresh = first if is_new else max(first, old - block + 1)
        return first, names, fresh

    def _chains(self, block: int, first: int, names: np.ndarray, fresh: int) -> list[tuple[int, int, int]]:
        """Period, first and last block of stretches of neighbouring blocks met again at that distance."""
        end = first + len(names)  # starts beyond the last
        keys, width = [], self.size // block + 2
        for d in (1, 2, 3):
            start = max(fresh, d * block, -(-first // block) * block + d * block)
            if d == 1:  # only the distance 2 * block - 1
                start += (-1 - start) % block
            starts = np.arange(start, end, block if d == 1 else 1)
            if not len(starts):
                continue
            number = starts // block
            held = names[(number - d) * block - first] == names[starts - first]
            if d == 3:
                held &= starts - number * block <= block - 2
            met = np.flatnonzero(held)
            if len(met):
                starts, number = starts[met], number[met] - d
                period = starts - number * block
                free = self._cover(block, number * block) < starts + block
                keys.append(period[free] * width + number[free])
        key = np.sort(np.concatenate([np.empty(0, dtype=np.int64), *keys]))
        if not len(key):
            return []
        cuts = np.flatnonzero(np.diff(key) != 1) + 1
        lo, hi = key[np.append(0, cuts)], key[np.append(cuts, len(key)) - 1]
        period, j0, j1 = lo // width, lo % width, hi % width
        most = (j1 - j0 + 1) * block + period + 2 * (block - 1)
        told = (j1 * block + period + 2 * block <= self.size) & ((j0 - 1) * block + period >= fresh)
        far = ~told | (most >= np.maximum(self.least, self.power * period))
        return list(zip(period[far].tolist(), j0[far].tolist(), j1[far].tolist(), strict=True))

    def _cover(self, block: int, at: np.ndarray) -> np.ndarray:
        """Farthest end of a run of at most `block` words a period that holds each place."""
        known = sorted((s, e) for p, runs in self.by_period.items() if p <= block for s, e, _ in runs)
        if not known:
            return np.zeros(len(at), dtype=np.int64)
        starts, ends = np.array(known).T
        reach = np.concatenate([[0], np.maximum.accumulate(ends)])
        return reach[np.searchsorted(starts, at, "right")]

    def _merge(self, period: int, start: int, end: int) -> list[tuple[int, int]]:
        """Stretch a proved repetition as far as it goes, unless it lies in a run of its period."""
        known = self.by_period.setdefault(period, [])
        if any(s <= start and end <= e for s, e, _ in known[-64:]):
            return []
        if not np.array_equal(self.words[start : end - period], self.words[start + period : end]):
            middle = self._backward(end - period, period, start)
            return [] if middle == end - period else self._merge(period, middle, end)
        start, end = self._backward(start, period, 0), self._forward(end, period)
        at_end = end == self.size
        run = [start, end, period]
        if run in known or not at_end and end - start < max(self.least, self.power * period):
            return []
        known.append(run)
        if at_end:
            self.open.append(run)
        return [(start, period)] if end - start >= 2 * period else []

    def _backward(self, at: int, period: int, stop: int) -> int:
        """Least place from which all words up to `at` equal those one period later."""
        step = 64
        while at > stop:
            lo = max(stop, at - step)
            differ = np.flatnonzero(self.words[lo:at] != self.words[lo + period : at + period])
            if len(differ):
                return lo + int(differ[-1]) + 1
            at, step = lo, 2 * step
        return at

    def _forward(self, at: int, period: int) -> int:
        """First place from `at` on whose word differs from the one a period before."""
        step = 64
        while at < self.size:
            hi = min(self.size, at + step)
            differ = np.flatnonzero(self.words[at:hi] != self.words[at - period : hi - period])
            if len(differ):
                return at + int(differ[0])
            at, step = hi, 2 * step
        return at

    def _advance(self) -> list[tuple[int, int]]:
        """Let runs that reached the end grow by the new words; short ones that end now go. Returns new squares."""
        still, squares = [], []
        for run in self.open:
            before, run[1] = run[1], self._forward(run[1], run[2])
            if before - run[0] < 2 * run[2] <= run[1] - run[0]:
                squares.append((run[0], run[2]))
            if run[1] == self.size:
                still.append(run)
            elif run[1] - run[0] < max(self.least, self.power * run[2]):
                self.by_period[run[2]] = [r for r in self.by_period[run[2]] if r is not run]
        self.open = still
        return squares


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        self[word] = len(self)
        return self[word]


def runs_of(documents: list[list[str]], power: int = POWER, least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each list of words, all lists in one parted stream."""
    numbers, ends, at = _Numbers(), [], 0
    stream = Catchers(power, least)
    for i, words in enumerate(documents):
        codes = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))
        ends.append(codes)
        ends.append(np.array([-1 - i], dtype=np.int64))
    joined = np.concatenate(ends) if ends else np.empty(0, dtype=np.int64)
    for at in range(0, len(joined), PIECE_WORDS):
        stream.append(joined[at : at + PIECE_WORDS])
    first = np.cumsum([0, *[len(w) + 1 for w in documents]])
    found: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    for start, length, period in stream.runs():
        i = int(np.searchsorted(first, start, "right")) - 1
        found[i].append((start - int(first[i]), length, period))
    return found


def _kept(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """Words joined by one space, without those that any run repeats."""
    if not runs:
        return " ".join(words)
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return " ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def _made(texts: list[str], power: int, least: int) -> list:
    split = [WORDS.findall(t) for t in texts]
    runs, batch, size = [], [], 0
    for words in split:
        batch.append(words)
        size += len(words)
        if size >= STREAM_WORDS:
            runs += runs_of(batch, power, least)
            batch, size = [], 0
    runs += runs_of(batch, power, least)
    named = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in found] for found in runs]
    return [[len(w) for w in split], named, [_kept(w, r) for w, r in zip(split, runs, strict=True)]]


def periodic_runs(docs: DataFrame, power: int = POWER, least: int = LEAST, text: str = "text", keep=("doc_id",)) -> DataFrame:
    """Columns `keep`, n_words, runs (array of start, length, period) and collapsed, of every row.

    A run is a stretch of words with smallest period q, of at least max(`least`, `power` * q) words
    and not to be prolonged; `power` is at least 4. `collapsed` is the text without the repeats of any run. NULL and
    empty texts have no words, no runs and an empty text; equal rows give equal rows; an empty table gives none;
    columns other than those named are not looked at, whatever their names. A text is one task's work, in
    memory that grows with its own words only.
    """
    if power < 4:
        raise ValueError("runs of fewer than four periods may share a stretch with others")
    fields = [("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())]
    return map_texts(docs, text, list(keep), lambda texts: _made(texts, power, least), fields)


def best_run(runs: str = "runs") -> Column:
    """The run with the greatest length by period, exactly; of equal ones the smallest start, then period."""

    def order(a: Column, b: Column) -> Column:
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        by_place = F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"])).otherwise(F.signum(a["period"] - b["period"]))
        return F.when(x > y, -1).when(x < y, 1).otherwise(by_place).cast("int")

    return F.get(F.array_sort(runs, order), 0)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the words from place a on repeat in every tenth document, by a hash of its id.

    A NULL id changes nothing.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    chosen = h % 10 == 0

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = F.floor((n - a) / (3 + g % 8)) + 1
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        moved = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, place(i).cast("int")))
        return F.when(n > 0, F.array_join(moved, " ")).otherwise("")

    words = F.regexp_extract_all(or_empty("text"), F.lit(WORD), F.lit(0))
    again = F.get(F.transform(F.array(words), repeated), 0)  # the words are bound once
    return docs.select("doc_id", F.when(chosen, again).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period and exponent_milli of the best run, and digests of runs and kept words."""
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.when(F.size("runs") > 0, best_run()).alias("_best"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
    run = {c: F.col("_best")[c] for c in ("start", "length", "period")}
    return best.select(
        "doc_id",
        "n_runs",
        *[c.alias(name) for name, c in run.items()],
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


def op12_word_runs(spark, sf_dir) -> DataFrame:
    """Periodic runs of all documents, every tenth of which has a planted one."""
    return run_digests(periodic_runs(with_planted_runs(table(spark, sf_dir, "documents"))))
