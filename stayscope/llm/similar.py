"""N-gram Jaccard join: exact links at a similarity, by signature trees inside prefix blocks.

A document is its set of hashed word n-grams; equal sets are one node. Two sets as similar as asked
share at least one of their first n-grams in any fixed order, so nodes meet in blocks, one per
such n-gram; n-grams that many documents share come last in the order. In every block the nodes are
first compared with one of them, and what links is merged. Whatever is still apart is then joined by
signature trees: their nodes hold OR-combined bitmaps and size ranges, and pairs of tree nodes are
followed down only where the largest overlap they allow is enough and their components differ. The
pairs left at the leaves are compared exactly: in some rounds the most alike of every node, so
that groups of near copies merge without all their pairs, and at last every pair that is left. No
link between different sets is lost.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stayscope.llm.common import join_groups, small_batches, table, under_safe_names, without
from stayscope.llm.components import connected
from stayscope.operators.joins import fits_broadcast
from stayscope.sources.checkpoints import cut_lineage

WORDS = 5
SHARE = (80, 100)
SLOT_BITS = 18
OFTEN = 200
SEEN_NODES = 500_000
LEAF, FANOUT = 8, 8
PURE = 16
ROUNDS, BEST, FEW_BLOCKS, WORTHWHILE = 4, 3, 4, 10
CHUNK_NODES = 20_000
STAR_NODES = 256
LIST_ROWS = 20_000

FACTOR = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word n-grams, A-Z lower-cased; of fewer words, one of all."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    h = np.frombuffer(b"".join(map(xxhash.xxh64_digest, parts)), dtype=np.uint64)
    n = min(words, len(h))
    out = np.full(len(h) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        out = out * FACTOR + h[i : len(h) - n + 1 + i]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    return np.unique(out)


def node_of(s: np.ndarray) -> int:
    """Number of a set."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes()))))


def needed(n: int | np.ndarray, share: tuple[int, int] = SHARE):
    """Least overlap that a set of size `n` must have with one as similar as asked."""
    return -(-share[0] * n // share[1])


def alike(a: np.ndarray, b: np.ndarray, share: tuple[int, int] = SHARE) -> bool:
    """Whether intersection by union of two sets reaches the share."""
    if not share[0] * max(len(a), len(b)) <= share[1] * min(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return share[1] * common >= share[0] * (len(both) - common)


def bitmap(s: np.ndarray) -> tuple[int, int]:
    """A set as bits, and their number: a power of two not below twice its size (64 at least)."""
    width = max(64, 2 << (len(s) - 1).bit_length())
    bits = np.zeros(width, dtype=np.uint8)
    bits[(s & np.uint64(width - 1)).astype(np.int64)] = 1
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little"), width


def folded(bits: int, width: int, to: int) -> int:
    """Bits at a smaller width."""
    while width > to:
        width //= 2
        bits = (bits >> width) | (bits & ((1 << width) - 1))
    return bits


class TreeNode:
    """Documents from `lo` to `hi`: OR of their bitmaps, sizes, least number of bits, component if one."""

    __slots__ = ("children", "lo", "hi", "bits", "least", "most", "fewest", "label")

    def __init__(self, children, lo, hi, bits, least, most, fewest, label):
        self.children, self.lo, self.hi, self.bits = children, lo, hi, bits
        self.least, self.most, self.fewest, self.label = least, most, fewest, label


def tree(sizes: list[int], bits: list[int], labels: list[int]) -> TreeNode:
    """A signature tree over documents in the given order."""

    def merged(children, lo, hi, items):
        union, least, most, fewest, seen = 0, min(i[1] for i in items), max(i[2] for i in items), min(i[3] for i in items), {i[4] for i in items}
        for i in items:
            union |= i[0]
        return TreeNode(children, lo, hi, union, least, most, fewest, seen.pop() if len(seen) == 1 else None)

    level = []
    for lo in range(0, len(sizes), LEAF):
        hi = min(lo + LEAF, len(sizes))
        level.append(merged(None, lo, hi, [(bits[i], sizes[i], sizes[i], bits[i].bit_count(), labels[i]) for i in range(lo, hi)]))
    while len(level) > 1:
        groups = [level[i : i + FANOUT] for i in range(0, len(level), FANOUT)]
        level = [
            merged(g, g[0].lo, g[-1].hi, [(x.bits, x.least, x.most, x.fewest, x.label) for x in g]) for g in groups
        ]
    return level[0]


def tree_pairs(
    nodes: list[tuple[int, int, int, bytes]], share: tuple[int, int] = SHARE, best: int | None = None
) -> list[tuple[int, int]]:
    """Pairs of a block's nodes (node, size, label, bitmap bytes) that may be alike and are not yet in one component.

    With `best`, only that many pairs of every node, those with most common bits. Nodes of a component
    with many of the block's nodes stand together, so that its tree nodes are of one component.
    """
    p, q = share
    by_width: dict[int, list] = {}
    members = Counter(n[2] for n in nodes)
    for node, size, label, packed in nodes:
        home = label if members[label] >= PURE else 0
        by_width.setdefault(len(packed) * 8, []).append((home, size, int.from_bytes(packed, "little"), node, label))
    found: list[tuple[int, int]] = []
    tops: dict[int, list[tuple[float, int, int]]] = {}

    def offer(a: int, b: int, common: float) -> None:
        for node in (a, b):
            heap = tops.setdefault(node, [])
            if len(heap) < best:
                heapq.heappush(heap, (common, a, b))
            elif common > heap[0][0]:
                heapq.heapreplace(heap, (common, a, b))

    def may(least_a, most_a, few_a, bits_a, least_b, most_b, few_b, bits_b) -> bool:
        if p * least_a > q * most_b or p * least_b > q * most_a:
            return False
        common = (bits_a & bits_b).bit_count()
        most = min(most_a - max(0, few_a - common), most_b - max(0, few_b - common))
        return most * (p + q) >= p * (least_a + least_b)

    for width in sorted(by_width):
        group = [g[1:] for g in sorted(by_width[width])]
        wide = sorted(by_width.get(2 * width, []))
        other = [(size, folded(b, 2 * width, width), node, label) for _, size, b, node, label in wide]
        for right, same in ((group, True), (other, False)):
            if not right or len(group) + len(right) * (not same) < 2:
                continue
            a = tree([g[0] for g in group], [g[1] for g in group], [g[3] for g in group])
            b = a if same else tree([g[0] for g in right], [g[1] for g in right], [g[3] for g in right])
            todo = [(a, b)]
            while todo:
                x, y = todo.pop()
                if x.label is not None and x.label == y.label:
                    continue
                if not may(x.least, x.most, x.fewest, x.bits, y.least, y.most, y.fewest, y.bits):
                    continue
                if x.children is None and y.children is None:
                    for i in range(x.lo, x.hi):
                        si, bi, ni, li = group[i]
                        few = bi.bit_count()
                        for j in range(max(y.lo, i + 1) if same else y.lo, y.hi):
                            sj, bj, nj, lj = right[j]
                            if li != lj and may(si, si, few, bi, sj, sj, bj.bit_count(), bj):
                                if best:
                                    offer(ni, nj, (bi & bj).bit_count() / max(few, bj.bit_count()))
                                else:
                                    found.append((ni, nj))
                elif x is y and same:
                    todo += list(combinations(x.children, 2)) + [(c, c) for c in x.children]
                elif y.children is None or (x.children is not None and x.hi - x.lo >= y.hi - y.lo):
                    todo += [(c, y) for c in x.children]
                else:
                    todo += [(x, c) for c in y.children]
    return found + sorted({(a, b) for heap in tops.values() for _, a, b in heap})


def described(docs: DataFrame, words: int = WORDS) -> tuple[DataFrame, np.ndarray]:
    """Rows (doc_id, node, proof, n, bits) of all documents, stored, and how often each slot of n-grams occurs.

    Tasks report the slots that more than one in OFTEN of their documents has; that only sets an order.
    """
    small_batches(docs.sparkSession)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("node", pa.int64()), ("proof", pa.int64()), ("n", pa.int64()), ("bits", pa.binary()), ("slot", pa.int32()), ("hits", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits, seen = np.zeros(1 << SLOT_BITS, dtype=np.int64), 0
        for batch in batches:
            rows = [[], [], [], []]
            for t in batch.column("text").to_pylist():
                s = shingles(t, words)
                seen += 1
                if not len(s):
                    for r, v in zip(rows, (None, None, 0, None), strict=True):
                        r.append(v)
                    continue
                np.add.at(hits, (s >> np.uint64(64 - SLOT_BITS)).astype(np.int64), 1)
                b, width = bitmap(s)
                proof = int(np.int64(np.uint64(xxhash.xxh64_intdigest(s.tobytes(), 7))))
                for r, v in zip(rows, (node_of(s), proof, len(s), b.to_bytes(width // 8, "little")), strict=True):
                    r.append(v)
            n = len(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), *[pa.array(r, type=schema.field(i + 1).type) for i, r in enumerate(rows)], pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())],
                schema=schema,
            )
        slots = np.flatnonzero(hits > seen / OFTEN + 3)
        n = len(slots)
        yield pa.RecordBatch.from_arrays(
            [*[pa.nulls(n, f.type) for f in list(schema)[:5]], pa.array(slots.astype(np.int32)), pa.array(hits[slots])], schema=schema
        )

    kinds = "doc_id long, node long, proof long, n long, bits binary, slot int, hits long"
    made = cut_lineage(docs.select("doc_id", "text").mapInArrow(run, kinds))
    often = made.where(F.col("slot").isNotNull()).groupBy("slot").agg(F.sum("hits").alias("hits")).toPandas()
    order = np.zeros(1 << SLOT_BITS, dtype=np.int64)
    order[often["slot"].to_numpy(dtype=np.int64)] = often["hits"].to_numpy(dtype=np.int64)
    return made.where(F.col("slot").isNull()).drop("slot", "hits"), order


def prefix_keys(docs: DataFrame, order: np.ndarray, words: int = WORDS, share: tuple[int, int] = SHARE) -> DataFrame:
    """key and node: the first n-grams of every set, rare ones first; a set met again in a task is not repeated."""
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            keys, nodes, counts = [], [], []
            for t in batch.column(0).to_pylist():
                s = shingles(t, words)
                if not len(s) or (node := node_of(s)) in seen:
                    continue
                if len(seen) >= SEEN_NODES:
                    seen.clear()
                seen.add(node)
                take = len(s) - needed(len(s), share) + 1
                rank = shared.value[(s >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
                s = s[np.lexsort((s, rank))[:take]] if rank.any() else s[:take]
                keys.append(s)
                nodes.append(node)
                counts.append(take)
            if keys:
                flat = pa.array(np.concatenate(keys).view(np.int64))
                yield pa.RecordBatch.from_arrays([flat, pa.array(np.repeat(np.array(nodes, dtype=np.int64), counts))], ["key", "node"])

    return docs.select("text").mapInArrow(run, "key long, node long")


def blocks_of(keys: DataFrame) -> DataFrame:
    """block and node, for keys that at least two nodes have; keys with the same nodes are one block.

    Keys are dealt out and sorted, and read as a stream, so a key with very many nodes needs no memory.
    """

    def mixed(x: np.ndarray) -> np.ndarray:
        h = x.view(np.uint64) * FACTOR
        h ^= h >> np.uint64(32)
        return h * np.uint64(0xD6E8FEB86659FD93)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_k, rest_n = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

        def cut(k: np.ndarray, n: np.ndarray) -> pa.RecordBatch | None:
            fresh = np.ones(len(k), dtype=bool)
            fresh[1:] = (k[1:] != k[:-1]) | (n[1:] != n[:-1])
            k, n = k[fresh], n[fresh]
            if not len(k):
                return None
            starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            sizes = np.diff(np.append(starts, len(k)))
            name = np.add.reduceat(mixed(n), starts) ^ sizes.astype(np.uint64)
            keep = np.zeros(len(starts), dtype=bool)
            many = np.flatnonzero(sizes > 1)
            keep[many[np.unique(name[many], return_index=True)[1]]] = True
            rows = np.repeat(keep, sizes)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(name, sizes)[rows].view(np.int64)), pa.array(n[rows])], ["block", "node"]
            )

        streaming = None  # a key longer than a list, whose nodes are passed on as they come
        for batch in batches:
            k, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if streaming is not None:
                go = int(np.searchsorted(k, streaming, side="right"))
                if go:
                    yield pa.RecordBatch.from_arrays([pa.array(k[:go]), pa.array(n[:go])], ["block", "node"])
                k, n = k[go:], n[go:]
                if not len(k):
                    continue
                streaming = None
            k, n = np.concatenate([rest_k, k]), np.concatenate([rest_n, n])
            last = int(np.searchsorted(k, k[-1], side="left")) if len(k) else 0
            if len(k) - last > LIST_ROWS:
                streaming = k[-1]
                yield pa.RecordBatch.from_arrays([pa.array(k[last:]), pa.array(n[last:])], ["block", "node"])
                rest_k, rest_n = k[:0], n[:0]
            else:
                rest_k, rest_n = k[last:], n[last:]
            if last and (out := cut(k[:last], n[:last])) is not None:
                yield out
        if len(rest_k) and (out := cut(rest_k, rest_n)) is not None:
            yield out

    sorted_keys = keys.repartition("key").sortWithinPartitions("key", "node")
    return sorted_keys.mapInArrow(run, "block long, node long").distinct()


def compared(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, words: int, share: tuple[int, int]) -> DataFrame:
    """u and v of those `pairs` (hub, node) whose sets are alike, from the texts of one document per node.

    A hub's partners are dealt over groups of STAR_NODES, each with the hub's text; only texts of
    nodes in pairs move.
    """
    sizes = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / STAR_NODES).cast("int").alias("parts"))
    pairs = cut_lineage(pairs.join(sizes, "hub").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")))
    hubs = pairs.select("hub", "part").distinct().select("hub", "part", F.col("hub").alias("node"))
    places = pairs.select("hub", "part", "node").unionByName(hubs).join(nodes.select("node", F.col("doc_id").alias("_doc")), "node")
    places = cut_lineage(places)
    places = F.broadcast(places) if fits_broadcast(places) else places
    texts = docs.select("doc_id", "text").join(places, F.col("doc_id").eqNullSafe(F.col("_doc")))

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        hub = int(group["hub"].iloc[0])
        sets: dict[int, np.ndarray] = {}
        for node, text in zip(group["node"], group["text"], strict=True):
            if node not in sets:
                s = shingles(text, words)
                if node_of(s) == node:  # a doc_id may have other texts too
                    sets[int(node)] = s
        own = sets.pop(hub, None)
        found = [] if own is None else [n for n, s in sets.items() if alike(own, s, share)]
        return pd.DataFrame({"u": np.full(len(found), hub, dtype="int64"), "v": np.array(found, dtype="int64")})

    return texts.select("hub", "part", "node", "text").groupBy("hub", "part").applyInPandas(verify, "u long, v long")


def grown(links: DataFrame) -> DataFrame:
    """Components of links, stored."""
    return cut_lineage(connected(links))


def apart(
    blocks: DataFrame, labels: DataFrame, nodes: DataFrame, share: tuple[int, int], best: int | None = None
) -> DataFrame:
    """hub and node of pairs inside blocks that signature trees can't rule out, of different components.

    With `best`, only so many for each node of a block (see `tree_pairs`). Without, a pair that has one of
    the first few blocks of both its nodes in common is reported by the first of these alone.
    """
    first = blocks.withColumn("_n", F.row_number().over(Window.partitionBy("node").orderBy("block")))
    first = first.where(F.col("_n") <= FEW_BLOCKS).groupBy("node").agg(F.array_sort(F.collect_list("block")).alias("first"))
    known = blocks.join(labels, "node", "left").select("block", "node", F.coalesce("label", "node").alias("label"))
    open_ = known.groupBy("block").agg(F.min("label").alias("_a"), F.max("label").alias("_b"), F.count(F.lit(1)).alias("_n"))
    open_ = open_.where(F.col("_a") != F.col("_b")).select("block", F.ceil(F.col("_n") / CHUNK_NODES).cast("int").alias("chunks"))
    told = nodes.select("node", "n", "bits").join(first, "node")
    rows = known.join(open_, "block").join(told, "node")
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    rows = rows.select("block", "node", "label", "n", "bits", "first", own.alias("own"), other)
    rows = rows.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, key, told = [], None, set()

        def done() -> pa.RecordBatch:
            block, i, j = key
            place, firsts = {g[0]: g[4] for g in group}, {g[0]: set(g[5]) for g in group}
            pairs = tree_pairs([g[:4] for g in group], share, best)
            pairs = {(min(p), max(p)) for p in pairs if {place[p[0]], place[p[1]]} == {i, j}} - told
            if not best:
                pairs = {p for p in pairs if min(firsts[p[0]] & firsts[p[1]], default=block) == block}
            if len(told) + len(pairs) > SEEN_NODES:
                told.clear()
            told.update(pairs)
            return pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["hub", "node"]
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("block", "i", "j", "node", "n", "label", "bits", "own", "first")]
            for block, i, j, *row in zip(*columns, strict=True):
                if (block, i, j) != key:
                    if len(group) > 1:
                        yield done()
                    group, key = [], (block, i, j)
                group.append(row)
        if len(group) > 1:
            yield done()

    dealt = rows.repartition("block", "i", "j").sortWithinPartitions("block", "i", "j", "node")
    return dealt.mapInArrow(run, "hub long, node long").distinct()


def link_labels(docs: DataFrame, rows: DataFrame, order: np.ndarray, words: int, share: tuple[int, int]) -> DataFrame:
    """node and label of nodes with a link, exact."""
    proof = F.assert_true(F.min("proof") == F.max("proof"), F.lit("two sets have the same 64-bit hash"))
    nodes = rows.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bits").alias("bits"), proof.alias("_p")
    )
    nodes = cut_lineage(nodes.where(F.col("_p").isNull()).drop("_p"))
    blocks = cut_lineage(blocks_of(prefix_keys(docs, order, words, share)))
    hubs = blocks.groupBy("block").agg(F.min("node").alias("hub"))
    stars = blocks.join(hubs, "block").where(F.col("node") != F.col("hub")).select("hub", "node").distinct()
    size = nodes.select("node", "n")
    stars = stars.join(size, "node").join(size.select(F.col("node").alias("hub"), F.col("n").alias("m")), "hub")
    fits = (F.col("n") * share[1] >= F.col("m") * share[0]) & (F.col("m") * share[1] >= F.col("n") * share[0])
    first = cut_lineage(compared(docs, nodes, stars.where(fits).select("hub", "node"), words, share))
    links, labels = first, grown(first)
    place = F.row_number().over(Window.partitionBy("node").orderBy("block"))
    few = cut_lineage(blocks.withColumn("_n", place).where(F.col("_n") <= FEW_BLOCKS).drop("_n"))
    for _ in range(ROUNDS):  # what is most alike merges first, which leaves few pairs to the last step
        near = cut_lineage(apart(few, labels, nodes, share, BEST))
        more = cut_lineage(compared(docs, nodes, near, words, share))
        found = more.count()
        if found:
            links = links.unionByName(more)
            labels = grown(links)
        if found * WORTHWHILE < near.count():
            break
    rest = cut_lineage(apart(blocks, labels, nodes, share))
    return grown(links.unionByName(compared(docs, nodes, rest, words, share)))


def similar_documents(docs: DataFrame, words: int = WORDS, share: tuple[int, int] = SHARE) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_shingles, component_id, node (its set) and label (its component).

    component_id is the smallest doc_id that links reach; documents with equal sets are linked, those
    without words are linked with nothing, and have neither node nor label. NULL and empty texts have no
    words. Repeated rows and repeated doc_ids are fine: what is linked are sets.
    """
    rows, order = described(docs, words)
    labels = link_labels(docs, rows, order, words, share)
    counts = rows.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("size"))
    placed = cut_lineage(counts.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
    lows = placed.groupBy("label").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("members"))
    several = lows.where(F.col("members") > 1)
    total = placed.count()
    ids = join_groups(placed, several, "label", "members", total, "left").select(
        "node", "size", "label", F.coalesce("component_id", "low").alias("component_id")
    )
    ids = cut_lineage(ids)
    plain = rows.select("doc_id", "node", F.col("n").alias("n_shingles"))
    total = plain.count()
    with_words = join_groups(plain.where(F.col("node").isNotNull()), ids, "node", "size", total, "left")
    found = with_words.drop("size").unionByName(
        plain.where(F.col("node").isNull()).withColumn("component_id", F.col("doc_id")), allowMissingColumns=True
    )
    return found.select("doc_id", "n_shingles", "component_id", "node", "label")


def one_of_each(docs: DataFrame, words: int = WORDS, share: tuple[int, int] = SHARE) -> DataFrame:
    """One row of every component of similar documents, that with the smallest doc_id; all columns stay.

    Rows without words all stay. Rows that share a doc_id are told apart by their sets. Other
    columns may have any name; an empty table gives an empty one.
    """
    return under_safe_names(docs, lambda given: _one_of_each(given, words, share))


def _one_of_each(docs: DataFrame, words: int, share: tuple[int, int]) -> DataFrame:
    found = cut_lineage(similar_documents(docs, words, share).where(F.col("node").isNotNull()))
    shared = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    shared = cut_lineage(shared.select(F.col("doc_id").alias("_id")))
    key = F.col("doc_id").eqNullSafe(F.col("_id"))
    lost = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).join(shared, key, "left_anti")
    stay = without(docs, cut_lineage(lost.select("doc_id")), {"doc_id": F.col("doc_id")})
    if shared.isEmpty():
        return stay

    @F.pandas_udf("long")
    def node(texts: pd.Series) -> pd.Series:
        sets = [shingles(t, words) for t in texts]
        return pd.Series([node_of(s) if len(s) else None for s in sets], dtype="Int64")

    told = docs.join(shared, key, "left_semi").select(F.struct(*docs.columns).alias("_row"), node("text").alias("_node"))
    best = found.join(shared, key, "left_semi").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    best = best.select("node", "label").distinct()
    first = Window.partitionBy("label").orderBy("_node", F.to_json("_row"))
    chosen = told.join(best, F.col("_node") == F.col("node"))
    chosen = chosen.where(F.col("_row.doc_id").isNotNull()).withColumn("_n", F.row_number().over(first))
    chosen = chosen.where(F.col("_n") == 1).select("_row.*").unionByName(told.where(F.col("_node").isNull()).select("_row.*"))
    return stay.join(shared, key, "left_anti").unionByName(chosen)


def op9_similar_documents(spark, sf_dir) -> DataFrame:
    """All documents with the component of similar ones they belong to."""
    found = similar_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")
