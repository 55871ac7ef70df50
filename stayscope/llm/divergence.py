"""Source divergence audit: how the words of a language's sources differ, by a frequent-pattern tree.

Every term of a language is a row: the sources in which it occurs, the frequent ones first, each with
its smoothed share there. Equal rows become one with a multiplicity, and rows with a common beginning
share a path of a tree. The sum for a pair of sources starts from what it would be if no term occurred
in either. What changes for terms of one source comes from the histogram of its shares. What
changes for terms of both is added once per node and ancestor, times the terms below the node.

Rows are dealt in their order, so neighbours share paths; a path cut by the border of a task or batch is two
paths, whose sums are added up like all others. A task holds the paths of one batch and its sums, not its tree.
Integers are exact throughout: shares are long, sums decimal.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stayscope.llm.common import lower_az, small_batches, table
from stayscope.operators.joins import attach, fits_broadcast
from stayscope.sources.checkpoints import cut_lineage

NO_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
CELLS = 2_000_000
PAIRS = 1 << 20
SAFE = float(1 << 61)
PATH_BATCH = 4096


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (rows with the term); NULL lang, source and text are empty."""
    rows = docs.select(
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.split(lower_az("text"), NO_TERM).alias("_terms"),
    )
    twice = rows.select("lang", "source", F.posexplode(F.array("_terms", F.array_distinct("_terms"))).alias("_once", "_terms"))
    each = twice.select("lang", "source", "_once", F.explode("_terms").alias("term")).where("term != ''")
    return each.groupBy("lang", "source", "term").agg(
        F.sum(1 - F.col("_once")).alias("n"), F.sum(F.col("_once")).alias("docs")
    )


def share(n: str, total: str, scale: int = SCALE) -> Column:
    """1 + floor(scale * (n + 1) / total) as long, exactly, of two expressions; 1 where there is no total."""
    scaled = f"cast({scale} as decimal(18,0)) * cast({n} + 1 as decimal(19,0))"
    return F.expr(f"1 + coalesce({scaled} div cast(nullif({total}, 0) as decimal(19,0)), 0)")


def excess(p: str, q: str) -> Column:
    """floor((p - q)^2 / q), of shares that a long holds squared."""
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})")


def shares(docs: DataFrame, least_docs: int = LEAST_DOCS) -> tuple[DataFrame, DataFrame]:
    """Kept terms of every group, and the groups.

    Terms: lang, source, rank, term, n (over 0), p, q (the language's share), zero (the group's share of an absent
    term). Groups: lang, source, rank (from 1, most terms first), zero, kinds (kept terms of the language). A group is a
    (lang, source) that occurs, with or without terms.
    """
    counts = cut_lineage(term_counts(docs))
    of_term = Window.partitionBy("lang", "term")  # a row per source
    kept = counts.withColumns({"_docs": F.sum("docs").over(of_term), "_all": F.sum("n").over(of_term)})
    kept = cut_lineage(kept.where(F.col("_docs") >= least_docs).select("lang", "source", "term", "n", "_all"))
    languages = kept.groupBy("lang", "term").agg(F.first("_all").alias("_all"))
    languages = languages.groupBy("lang").agg(F.count(F.lit(1)).alias("kinds"), F.sum("_all").alias("_size"))
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("_n"))
    empty = F.lit("")
    groups = docs.select(F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source")).distinct()
    groups = groups.join(sums, ["lang", "source"], "left").join(languages, "lang", "left")
    groups = groups.fillna(0, ["_n", "kinds", "_size"])
    order = Window.partitionBy("lang").orderBy(F.desc("_n"), "source")  # a row per source
    groups = groups.withColumn("rank", F.row_number().over(order)).withColumn("zero", share("0", "_n + kinds"))
    groups = cut_lineage(groups)
    terms = attach(kept, groups, ["lang", "source"], "inner")
    terms = terms.withColumns({"p": share("n", "_n + kinds"), "q": share("_all", "_size + kinds")})
    terms = cut_lineage(terms.select("lang", "source", "rank", "term", "n", "p", "q", "zero"))
    return terms, groups.select("lang", "source", "rank", "zero", "kinds")


def pieces(lengths: np.ndarray, start: int, stop: int) -> Iterator[tuple[int, int]]:
    """Borders of a few rows at a time, which have no more than `PAIRS` pairs of items, or are one row."""
    step = max(1, PAIRS // max(int(lengths[start:stop].max(initial=0)), 1) ** 2)
    for i in range(start, stop, step):
        yield i, min(i + step, stop)


class PairTree:
    """The open paths of a frequent-pattern tree, and the sums of its closed nodes by pair of sources.

    Rows come in order, each a list of (rank, p, zero) with a multiplicity; rows that are closed together share the
    nodes of their common beginnings. `flush` gives (rank, other, sum) so far. Sums are 64-bit as long as a bound of
    their size allows it, then they are put away as Python integers.
    """

    def __init__(self):
        self.open: list[tuple[list[tuple[int, int, int]], int]] = []
        self.found: list[np.ndarray] = []  # columns: rank, other, sum there, sum back
        self.away: dict[tuple[int, int], int] = defaultdict(int)
        self.held, self.bound, self.nodes = 0, 0.0, 0

    @property
    def cells(self) -> int:
        """Size of what `flush` would give."""
        return 2 * self.held + len(self.away)

    def insert(self, items: list[tuple[int, int, int]], times: int) -> None:
        """Add a row that occurs `times`, to be closed with those before it."""
        self.open.append((items, times))

    def close(self) -> None:
        """Close the rows that were inserted."""
        rows, self.open = self.open, []
        lengths = np.array([len(items) for items, _ in rows], dtype=np.int64)
        flat = np.array([item for items, _ in rows for item in items], dtype=np.int64).reshape(-1, 3)
        times, ends = np.array([times for _, times in rows], dtype=np.int64), np.concatenate([[0], np.cumsum(lengths)])
        for i, j in pieces(lengths, 0, len(rows)):
            self.close_table(lengths[i:j], flat[ends[i] : ends[j]].T, times[i:j])

    def close_table(self, lengths: np.ndarray, items: np.ndarray, times: np.ndarray) -> None:
        """Close rows in order: their lengths, the ranks, p and zeros of all their items, and their multiplicities.

        Every node adds its correction with every ancestor once, times the terms at or under it. The rows are laid
        out as a table with a column per depth.
        """
        depths = int(lengths.max(initial=0))
        there = np.arange(depths) < lengths[:, None]
        table = np.zeros((3, *there.shape), dtype=np.int64)
        table[:, there] = items
        same = (table[:, 1:] == table[:, :-1]).all(axis=0) & there[1:] & there[:-1]
        shared = np.concatenate([[0], np.logical_and.accumulate(same, axis=1).sum(axis=1)])  # with the row before
        for depth in range(1, depths):
            first = np.flatnonzero(shared <= depth)  # rows that open a node here, or end before
            below = np.add.reduceat(times, first)
            here = lengths[first] > depth
            self._add(table[:, first[here], :depth], table[:, first[here], depth, None], below[here])
        self._merge()

    def _add(self, above: np.ndarray, node: np.ndarray, times: np.ndarray) -> None:
        """Add nodes of one depth (rank, p, zero) with their ancestors."""
        (ranks, p, p0), (mine, q, q0) = above, node
        self.nodes += ranks.size
        there, back = np.zeros_like(p), np.zeros_like(p)
        for a, b, sign in ((p, q, 1), (p, q0, -1), (p0, q, -1), (p0, q0, 1)):
            square = (a - b) * (a - b)
            there += sign * (square // b)
            back += sign * (square // a)
        most = np.maximum(np.abs(there), np.abs(back)).max(axis=1).astype(float) * times
        large = most * ranks.shape[1] > SAFE
        for i in np.flatnonzero(large).tolist():
            of, n = int(mine[i, 0]), int(times[i])
            for other, v, w in zip(ranks[i].tolist(), there[i].tolist(), back[i].tolist(), strict=True):
                self.away[other, of] += v * n
                self.away[of, other] += w * n
        most = float(most[~large].sum()) * ranks.shape[1]
        if most > SAFE:  # one after the other, each is small enough
            for i in np.flatnonzero(~large):
                self._hold(mine[[i]], ranks[[i]], there[[i]] * times[i], back[[i]] * times[i])
                self._put_away()
            return
        self.bound += most
        if self.bound > SAFE:
            self._put_away()
            self.bound = most
        if not large.all():
            n = times[~large, None]
            self._hold(mine[~large], ranks[~large], there[~large] * n, back[~large] * n)

    def _hold(self, mine: np.ndarray, ranks: np.ndarray, there: np.ndarray, back: np.ndarray) -> None:
        self.found.append(np.stack([np.broadcast_to(mine, ranks.shape).ravel(), *[x.ravel() for x in (ranks, there, back)]]))
        self.held += ranks.size

    def _merge(self) -> None:
        """One column per pair of sources."""
        if len(self.found) > 1:
            rank, other, *values = np.concatenate(self.found, axis=1)
            order = np.lexsort((other, rank))
            rank, other = rank[order], other[order]
            first = np.flatnonzero(np.concatenate([[True], (rank[1:] != rank[:-1]) | (other[1:] != other[:-1])]))
            self.found = [np.stack([rank[first], other[first], *[np.add.reduceat(v[order], first) for v in values]])]
            self.held = len(first)

    def _put_away(self) -> None:
        self._merge()
        for found in self.found:
            for rank, other, there, back in found.T.tolist():
                self.away[other, rank] += there
                self.away[rank, other] += back
        self.found.clear()
        self.held = 0

    def flush(self) -> list[tuple[int, int, int]]:
        """All sums of closed nodes, which are forgotten."""
        self._put_away()
        found = [(a, b, v) for (a, b), v in self.away.items()]
        self.away.clear()
        self.bound = 0.0
        return found


def tree_sums(terms: DataFrame) -> DataFrame:
    """lang, rank, other, value (decimal): what pairs of sources gain by the terms of both. A term has an item per source."""
    item = F.struct("rank", "p", "zero")
    rows = terms.groupBy("lang", "term").agg(F.sort_array(F.collect_list(item)).alias("path"))  # an item per source
    rows = rows.where(F.size("path") > 1).groupBy("lang", "path").agg(F.count(F.lit(1)).alias("times"))
    rows = cut_lineage(rows).repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    rows = rows.select("lang", "times", *[F.col(f"path.{c}").alias(c) for c in ("rank", "p", "zero")])
    small_batches(rows.sparkSession, PATH_BATCH)
    out = pa.schema([("lang", pa.string()), ("rank", pa.int64()), ("other", pa.int64()), ("sum", pa.string())])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, of = PairTree(), None

        def flushed(lang):
            found = tree.flush()
            columns = [[lang] * len(found), *[[f[i] for f in found] for i in range(2)], [str(f[2]) for f in found]]
            return pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(columns, out, strict=True)], schema=out)

        for batch in batches:
            langs = batch.column("lang").to_numpy(zero_copy_only=False)
            times = batch.column("times").to_numpy()
            lengths = batch.column("rank").value_lengths().to_numpy().astype(np.int64)
            items = np.stack([batch.column(c).flatten().to_numpy() for c in ("rank", "p", "zero")]).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(lengths)])
            starts = [0, *(np.flatnonzero(langs[1:] != langs[:-1]) + 1).tolist(), len(langs)]
            for i, j in pairwise(starts):
                if i < j and langs[i] != of:
                    yield flushed(of)
                    of = langs[i]
                for a, b in pieces(lengths, i, j):
                    tree.close_table(lengths[a:b], items[:, ends[a] : ends[b]], times[a:b])
                    if tree.cells > CELLS:
                        yield flushed(of)
        yield flushed(of)

    made = rows.mapInArrow(sums, "lang string, rank long, other long, sum string")
    return made.select("lang", "rank", "other", F.col("sum").cast("decimal(38,0)").alias("value"))


def pair_values(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (another source of the language) and value: the sum of their excess over all kept terms."""
    side = groups.select("lang", F.col("rank").alias("other"), F.col("zero").alias("zero_other"))
    side = F.broadcast(side) if fits_broadcast(side) else side
    each = groups.select("lang", "rank", "zero", "kinds").join(side, "lang").where("rank <> other")
    big = "decimal(38,0)"
    none = each.select("lang", "rank", "other", (F.col("kinds").cast(big) * excess("zero", "zero_other")).cast(big).alias("value"))
    histogram = cut_lineage(terms.groupBy("lang", "rank", "zero", "p").agg(F.count(F.lit(1)).alias("times")))
    one = histogram.join(side, "lang").where("rank <> other")
    there = excess("p", "zero_other") - excess("zero", "zero_other")
    back = excess("zero_other", "p") - excess("zero_other", "zero")
    one = one.select(
        "lang",
        F.inline(
            F.array(
                F.struct("rank", "other", (F.col("times").cast(big) * there).cast(big).alias("value")),
                F.struct(F.col("other").alias("rank"), F.col("rank").alias("other"), (F.col("times").cast(big) * back).cast(big).alias("value")),
            )
        ),
    )
    parts = none.unionByName(one).unionByName(tree_sums(terms))
    total = cut_lineage(parts.groupBy("lang", "rank", "other").agg(F.sum("value").cast("long").alias("value")))
    names = groups.select("lang", "rank", "source")
    found = attach(total, names, ["lang", "rank"], "inner")
    return attach(found, names.withColumnsRenamed({"rank": "other", "source": "item"}), ["lang", "other"], "inner").select(
        "lang", "source", "item", "value"
    )


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: per group the other sources (`pair`) and its telling terms (`term`).

    `docs` has lang, source and text, NULL as empty; other columns are not looked at, whatever their
    names. Every row is a document, so equal rows count each. A group without kept terms has pairs
    and no terms; a language without kept terms has pairs of value 0; a single source has none; an
    empty table gives no rows. Equal values stand by the item's UTF-8 bytes. Pairs are one row per two sources of a
    language, both ways, as asked for.
    """
    terms, groups = shares(docs, least_docs)
    pairs = pair_values(terms, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    more = terms.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), excess("p", "q").alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [d.withColumn("rank", F.row_number().over(order)) for d in (pairs, more)]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top_terms))


def op13_source_divergence(spark, sf_dir) -> DataFrame:
    """How the sources of every language differ, in all documents."""
    return divergence(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH t AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS row,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
e AS (SELECT lang, source, row, unnest(terms) AS term FROM t),
k AS (SELECT lang, term, count(*) AS total FROM e GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM e SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
l AS (SELECT lang, count(*) AS kinds, sum(total) AS size FROM k GROUP BY lang),
g AS (
  SELECT lang, source, coalesce(sum(n), 0) AS size
  FROM (SELECT DISTINCT lang, source FROM t) LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.size + l.kinds) AS p,
         1 + (1000000000::HUGEINT * (k.total + 1)) // (l.size + l.kinds) AS q
  FROM g JOIN l USING (lang) JOIN k USING (lang)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM f)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 200
"""
