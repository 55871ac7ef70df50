"""Sums of squared distances for several numbers of clusters, all from the same scans."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayscope.sources.checkpoints import cut_lineage

START_POINTS = 20_000
WEIGHT = "weight"


def counted_points(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct points as x0, x1, ... with their weight, stored; rows missing a number are left out."""
    numbers = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)]
    there = reduce(Column.__and__, [F.col(f"x{i}").isNotNull() & ~F.isnan(f"x{i}") for i in range(len(cols))])
    names = [f"x{i}" for i in range(len(cols))]
    return cut_lineage(df.select(*numbers).where(there).groupBy(*names).agg(F.count(F.lit(1)).alias(WEIGHT)))


def spread_starts(points: DataFrame, ks: Sequence[int], seed: int = 42, sample: int = START_POINTS) -> dict[int, np.ndarray]:
    """Centres to start from, per k the first k of one k-means++ sequence.

    The sequence is drawn from at most `sample` distinct points, those of smallest hash, by their
    weight; only the starts depend on it. Fewer distinct points than k give fewer centres.
    """
    names = [c for c in points.columns if c != WEIGHT]
    chosen = points.orderBy(F.xxhash64(F.lit(seed), *names), *names).limit(sample).toPandas()
    x, w = chosen[names].to_numpy(dtype=float), chosen[WEIGHT].to_numpy(dtype=float)
    rng = np.random.default_rng(seed)
    centres: list[np.ndarray] = []
    far = np.full(len(x), np.inf)
    while len(centres) < max(ks) and len(x) and (not centres or far.max() > 0):
        odds = w if not centres else w * far
        centres.append(x[rng.choice(len(x), p=odds / odds.sum())])
        far = np.minimum(far, ((x - centres[-1]) ** 2).sum(axis=1))
    return {k: np.array(centres[:k]) for k in ks}


def one_scan(points: DataFrame, centres: Mapping[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
    """Per k, the cost of its centres and the means of the points nearest to each, from one scan.

    A point goes to its nearest centre, the first of equal ones; a centre without points stays. Every task
    adds its Arrow batches up to one row per k and centre, so what moves depends on the centres alone. As
    expressions, dozens of centres would be planned and compiled anew in each scan, which took ten times as long.
    """
    names = [c for c in points.columns if c != WEIGHT]
    given = {k: np.array(cs) for k, cs in centres.items()}

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {k: np.zeros((len(cs), 2 + len(names))) for k, cs in given.items()}
        for batch in batches:
            x = np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names])
            w = batch.column("weight").to_numpy(zero_copy_only=False).astype(float)
            for k, cs in given.items():
                gaps = np.column_stack([((x - c) ** 2).sum(axis=1) for c in cs])
                place = gaps.argmin(axis=1)
                weighed = np.column_stack([w, w * gaps.min(axis=1), x * w[:, None]])
                totals[k] += np.column_stack([np.bincount(place, col, len(cs)) for col in weighed.T])
        rows = np.vstack(list(totals.values()))
        where = [(k, i) for k, cs in given.items() for i in range(len(cs))]
        numbers = [pa.array([int(v[j]) for v in where], pa.int32()) for j in (0, 1)]
        yield pa.RecordBatch.from_arrays([*numbers, *[pa.array(col) for col in rows.T]], ["k", "place", "w", "cost", *names])

    schema = "k int, place int, w double, cost double, " + ", ".join(f"{n} double" for n in names)
    parts = points.mapInArrow(sums, schema).groupBy("k", "place")
    costs, moved = dict.fromkeys(centres, 0.0), {k: cs.copy() for k, cs in centres.items()}
    for row in parts.agg(*[F.sum(c).alias(c) for c in ("w", "cost", *names)]).where("w > 0").collect():
        costs[row["k"]] += row["cost"]
        moved[row["k"]][row["place"]] = [row[n] / row["w"] for n in names]
    return {k: (costs[k], moved[k]) for k in centres}


def fit_at_once(
    points: DataFrame, starts: Mapping[int, np.ndarray], iterations: int = 20, tolerance: float = 1e-4
) -> dict[int, tuple[float, np.ndarray]]:
    """Per k, cost and centres of Lloyd's iterations, which all k share until each stands still.

    A k is done when none of its centres moves further than `tolerance`, or after `iterations` moves: the
    same cost as alone, for the scans of the slowest k instead of all.
    """
    open_, done = {k: cs for k, cs in starts.items() if len(cs)}, {}
    for i in range(iterations + 1):
        if not open_:
            break
        for k, (cost, moved) in one_scan(points, open_).items():
            still = np.sqrt(((moved - open_[k]) ** 2).sum(axis=1)).max() <= tolerance
            if still or i == iterations:
                done[k] = (cost, open_[k])
            open_[k] = moved
        open_ = {k: cs for k, cs in open_.items() if k not in done}
    return done


def elbow_at_once(
    df: DataFrame, cols: Sequence[str], ks: Sequence[int] = tuple(range(2, 9)), seed: int = 42,
    iterations: int = 20, tolerance: float = 1e-4,
) -> DataFrame:
    """Sum of squared distances to the nearest centre for each number of clusters: (k, wss); none for a table without points."""
    points = counted_points(df, cols)
    fitted = fit_at_once(points, spread_starts(points, ks, seed), iterations, tolerance)
    return df.sparkSession.createDataFrame([(k, float(cost)) for k, (cost, _) in sorted(fitted.items())], "k int, wss double")
