"""Approximate nearest neighbours by largest inner product, from balanced posting lists.

Centroids are fitted on a bounded sample, with a penalty on large clusters. Every vector is posted
to its nearest list and, near a boundary, to others whose distance is within a ratio of the
nearest. Queries search the centroids through an in-memory neighbour graph, best first, until the
lists met hold enough vectors, and take all lists within a ratio of the distance at which they do. Lists longer than a block are cut into blocks, so
the work of a task is bounded, and each block gives a query's best candidates by exact scores.

Inner products become distances by one more coordinate, which brings all vectors to the same norm.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stayscope.llm.common import first_by_hash, join_groups, small_batches, table
from stayscope.sources.checkpoints import cut_lineage

SAMPLE_ROWS = 20_000
FEW_LISTS, MOST_LISTS = 128, 4096
FIT_ROWS, LIST_ROWS = 80, 20_000
BLOCK_ROWS = 20_000
COPIES = 4
POST_RATIO = 1.06
TARGET_RECALL = 0.97
FIT_QUERIES = 300
FLOOR_SHARE = 0.05
GRAPH_DEGREE = 16


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and v (doubles) of vectors that take part, each pair once.

    Left out are NULL, empty and zero vectors, those that hold a NULL or a non-finite component,
    and those whose length is not the most frequent one (of equally frequent ones the largest).
    """
    v = F.col("embedding").cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select("vec_id", v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    rows = rows.where(fine)
    counts = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    top = counts.agg(F.max(F.struct("n", "d")).alias("top")).first()["top"]
    return rows.where(F.size("v") == (top["d"] if top else 0)).distinct()


def balanced_centroids(sample: np.ndarray, lists: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """K-means centroids; a list over the mean size costs more, so sizes even out."""
    pick = np.random.default_rng(seed)
    centroids = sample[pick.choice(len(sample), min(lists, len(sample)), replace=False)].copy()
    sizes = np.full(len(centroids), len(sample) / len(centroids))
    squares = (sample**2).sum(1)[:, None]
    for _ in range(rounds):
        d = squares + (centroids**2).sum(1) - 2 * sample @ centroids.T
        over = np.maximum(0.0, sizes * len(centroids) / len(sample) - 1)
        owner = np.argmin(d + 0.1 * d.mean() * over, axis=1)
        sizes = np.bincount(owner, minlength=len(centroids)).astype(float)
        sums = np.zeros_like(centroids)
        np.add.at(sums, owner, sample)
        filled = sizes > 0
        centroids[filled] = sums[filled] / sizes[filled, None]
        if (~filled).any():
            centroids[~filled] = sample[pick.choice(len(sample), int((~filled).sum()))]
    return centroids


class CentroidGraph:
    """Each centroid with its nearest ones; links go both ways, and the first links keep it in one piece."""

    def __init__(self, centroids: np.ndarray, degree: int = GRAPH_DEGREE):
        self.centroids = centroids
        n = len(centroids)
        squares = (centroids**2).sum(1)
        d = squares[:, None] + squares - 2 * centroids @ centroids.T
        near = np.argsort(d, axis=1, kind="stable")[:, 1 : degree + 1]
        links: list[set[int]] = [set(row.tolist()) for row in near]
        for i in range(n):
            for j in list(links[i]):
                links[j].add(i)
            if i:
                links[i].add(i - 1)
                links[i - 1].add(i)
        self.links = [np.array(sorted(x), dtype=np.int64) for x in links]

    def within(
        self, q: np.ndarray, ratio: float, floor: float, sizes: np.ndarray, need: int, entries: int = 4
    ) -> np.ndarray:
        """Lists whose distance is at most `ratio` times that of the base list (at least `floor`), found best first.

        The base list is the nearest one up to which lists hold `need` vectors by `sizes`; while those met
        hold fewer, none is left out, at last all are taken.
        """
        n = len(self.centroids)
        starts = np.unique(np.linspace(0, n - 1, min(entries, n)).astype(np.int64))
        seen = np.zeros(n, dtype=bool)
        seen[starts] = True
        dist = np.sqrt(((self.centroids[starts] - q) ** 2).sum(1))
        heap = list(zip(dist.tolist(), starts.tolist(), strict=True))
        heapq.heapify(heap)
        found, base, slack = [], np.inf, 0
        nearest: list[tuple[float, int]] = []  # the fewest lists met that hold enough, farthest first
        held = 0
        while heap:
            d, at = heapq.heappop(heap)
            if d < base:
                heapq.heappush(nearest, (-d, int(sizes[at])))
                held += int(sizes[at])
                while held - nearest[0][1] >= need:
                    held -= heapq.heappop(nearest)[1]
                base = -nearest[0][0] if held >= need else np.inf
            if d > max(base, floor) * ratio:
                slack += 1
                if slack > 2 * GRAPH_DEGREE:
                    break
            else:
                found.append((d, at))
            fresh = self.links[at][~seen[self.links[at]]]
            seen[fresh] = True
            if len(fresh):
                ds = np.sqrt(((self.centroids[fresh] - q) ** 2).sum(1))
                for pair in zip(ds.tolist(), fresh.tolist(), strict=True):
                    heapq.heappush(heap, pair)
        return np.array([at for d, at in found if d <= max(base, floor) * ratio], dtype=np.int64)


def lifted(v: np.ndarray, norm: float) -> np.ndarray:
    """Vectors with one more coordinate, which brings all to `norm`."""
    return np.column_stack([v, np.sqrt(np.maximum(0.0, norm**2 - (v**2).sum(1)))])


def postings(
    v: np.ndarray, centroids: np.ndarray, copies: int, ratio: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and list of every posting, the nearest list and near ones within `ratio` of its distance, and if it is the nearest."""
    d = np.sqrt(np.maximum(0.0, (v**2).sum(1)[:, None] + (centroids**2).sum(1) - 2 * v @ centroids.T))
    n = min(copies, len(centroids))
    near = np.argpartition(d, n - 1, axis=1)[:, :n]
    close = np.take_along_axis(d, near, axis=1)
    taken = close <= close.min(1)[:, None] * ratio
    nearest = np.arange(n) == close.argmin(1)[:, None]
    return np.nonzero(taken)[0], near[taken], nearest[taken]


def calibrated_ratio(
    sample: np.ndarray, centroids: np.ndarray, sizes: np.ndarray, k: int, copies: int, post_ratio: float, recall: float
) -> tuple[float, float]:
    """Ratio of distances at which searches of sampled vectors find that share of their `k` nearest in the sample.

    `sample` holds distinct vectors; `sizes` are the lists' of the whole table, so the ratio is one to the
    same base list as in a search. Nearest of the whole table are nearer than those of a sample, so they
    are found more often. A vector may lie on a centroid, so a base distance counts as the second value
    at least: one below most of those over 0.
    """
    asked = sample[:FIT_QUERIES]
    q = np.column_stack([asked[:, :-1], np.zeros(len(asked))])
    q *= np.linalg.norm(sample, axis=1).max() / np.maximum(np.linalg.norm(q, axis=1)[:, None], 1e-300)
    scores = asked[:, :-1] @ sample[:, :-1].T
    scores[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    n = min(k, len(sample) - 1)
    least = 1e-6 * float(np.linalg.norm(sample, axis=1).max())
    if n < 1:
        return 1.0, least
    near = np.argpartition(-scores, n - 1, axis=1)[:, :n]
    d = np.array([np.sqrt(((centroids - x) ** 2).sum(1)) for x in q])
    order = np.argsort(d, axis=1)
    enough = (np.cumsum(sizes[order], axis=1) <= k).sum(1).clip(max=len(centroids) - 1)
    base = np.take_along_axis(d, np.take_along_axis(order, enough[:, None], axis=1), axis=1)
    floor = float(np.quantile(base[base > least], FLOOR_SHARE)) if (base > least).any() else least
    d /= np.maximum(base, floor)
    row, at, _ = postings(sample, centroids, copies, post_ratio)
    ends = np.searchsorted(row, np.arange(len(sample) + 1))
    needed = [d[i, at[ends[j] : ends[j + 1]]].min() for i in range(len(asked)) for j in near[i]]
    return max(1.0, float(np.quantile(needed, recall))) + 1e-9, floor


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.array(column.tolist(), dtype=float).reshape(-1, width)


def search(
    vectors: DataFrame,
    is_query,
    k: int,
    sample_rows: int = SAMPLE_ROWS,
    list_rows: int = LIST_ROWS,
    block_rows: int = BLOCK_ROWS,
    copies: int = COPIES,
    post_ratio: float = POST_RATIO,
    target_recall: float = TARGET_RECALL,
) -> DataFrame:
    """The `k` nearest found of every query: query_id, rank (from 1), vec_id, score.

    `vectors` has vec_id and embedding (see `usable`); `is_query` is a condition on vec_id. The fit
    looks at `sample_rows` vectors, the index holds all. Of equal vectors only the k + 1 smallest
    vec_ids can be among the k nearest, so only they are posted; equal queries are searched once.
    A query has fewer than `k` rows only where the table has fewer other vectors.
    Rows with a query's own vec_id aren't its candidates. Ties go to the smaller vec_id.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows = cut_lineage(usable(vectors))
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("sq")).first()
    total, width, norm = facts["n"], facts["d"] or 1, float(np.sqrt(facts["sq"] or 1.0))
    sample = first_by_hash(rows, ["vec_id", "v"], sample_rows).select("v").toPandas()["v"]
    lists = min(MOST_LISTS, max(1, min(FEW_LISTS, total // FIT_ROWS), total // list_rows))
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    fitted = lifted(_matrix(sample, width), norm)
    fitted = fitted[np.sort(np.unique(fitted, axis=0, return_index=True)[1])]
    centroids = balanced_centroids(fitted, lists)
    shared = spark.sparkContext.broadcast(CentroidGraph(centroids))

    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            row, at, own = postings(lifted(_matrix(b["v"], width), norm), shared.value.centroids, copies, post_ratio)
            yield pd.DataFrame({"list": at, "vec_id": b["vec_id"].to_numpy()[row], "v": b["v"].to_numpy()[row], "own": own})

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            q = np.column_stack([_matrix(b["v"], width), np.zeros(len(b))])
            size = np.sqrt((q**2).sum(1))[:, None] / norm  # a query's length does not change its order
            found = [shared.value.within(x, search_ratio, floor, held, k + 1) for x in q / size]
            row = np.repeat(np.arange(len(b)), [len(f) for f in found])
            at = np.concatenate(found) if found else np.array([], dtype=np.int64)
            yield pd.DataFrame({"list": at, "q": b["q"].to_numpy()[row], "v": b["v"].to_numpy()[row]})

    first = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.withColumn("_n", first).where(F.col("_n") <= k + 1).select("vec_id", "v")
    posted = cut_lineage(few.mapInPandas(post, "list int, vec_id long, v array<double>, own boolean"))
    counts = posted.groupBy("list").agg(F.count_if("own").alias("n")).toPandas()  # one row per list
    held = np.zeros(len(centroids), dtype=np.int64)  # each vector counts in its nearest list only
    held[counts["list"]] = counts["n"]
    search_ratio, floor = calibrated_ratio(fitted, centroids, held, k, copies, post_ratio, target_recall)
    posted = posted.drop("own")
    asked = rows.where(is_query)
    distinct = asked.groupBy("v").agg(F.min("vec_id").alias("q"), F.count(F.lit(1)).alias("_size"))
    distinct = cut_lineage(distinct)
    probed = distinct.mapInPandas(probe, "list int, q long, v array<double>")
    sizes = posted.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    sizes = F.broadcast(sizes)  # one row per list
    dealt = posted.join(sizes, "list").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    asks = probed.join(sizes, "list").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

    def best(queries: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(some):
            return pd.DataFrame({"q": pd.Series([], dtype="int64"), "vec_id": pd.Series([], dtype="int64"), "score": pd.Series([], dtype=float)})
        some = some.sort_values("vec_id")
        ids, c = some["vec_id"].to_numpy(), _matrix(some["v"], width)
        parts, n = [], min(k + 1, len(c))
        for lo in range(0, len(queries), 256):
            q = _matrix(queries["v"].iloc[lo : lo + 256], width)
            rough = q @ c.T
            least = np.partition(rough, len(c) - n, axis=1)[:, len(c) - n]
            row, col = np.nonzero(rough >= (least - 1e-9 * (1 + np.abs(least)))[:, None])
            exact = (q[row] * c[col]).sum(1)
            order = np.lexsort((ids[col], -exact, row))
            row, col, exact = row[order], col[order], exact[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            keep = place < n
            parts.append(pd.DataFrame({"q": queries["q"].to_numpy()[lo + row[keep]], "vec_id": ids[col[keep]], "score": exact[keep]}))
        return pd.concat(parts)

    asks, dealt = asks.drop("blocks"), dealt.drop("blocks")
    found = asks.groupBy("list", "block").cogroup(dealt.groupBy("list", "block"))
    found = found.applyInPandas(best, "q long, vec_id long, score double").distinct()
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    found = found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1)
    nearest = found.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("_n", "vec_id", "score"))).alias("_best"))
    nearest = cut_lineage(nearest.join(distinct.select("q", "v", "_size"), "q").drop("q"))
    members = asked.select(F.col("vec_id").alias("query_id"), "v")
    each = join_groups(members, nearest, "v", "_size", total)
    others = F.slice(F.filter("_best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    each = each.select("query_id", F.posexplode(others).alias("_rank", "_b"))
    return each.select("query_id", (F.col("_rank") + 1).cast("int").alias("rank"), "_b.vec_id", "_b.score")


def op8_nearest_neighbours(spark, sf_dir) -> DataFrame:
    """The 20 nearest of every twentieth embedding among all others."""
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)
