"""Packing token ids into sequences: length combinations solved by non-negative least squares.

Whole windows are cut off a document first; what is left is shorter than a window. Its lengths,
rounded up to a unit, make a histogram of bounded size. All combinations of up to three lengths
that fill a window are columns of a system whose right side is the histogram; non-negative least
squares gives how often each combination is used. The counts are rounded down to what the histogram
holds, documents take their places by rank within their length, and those without a place are
packed greedily: laid end to end and cut at window borders.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stayscope.llm.common import map_texts, table
from stayscope.llm.tokens import id_bytes, widened, word_tokenizer
from stayscope.sources.checkpoints import cut_lineage

WINDOW = 4096
UNIT = 16
END_ID = 2
SPLITS = 1024
ID_BYTES = 4


def combinations(bins: int) -> np.ndarray:
    """All ways to fill `bins` units with one to three lengths: rows of three bins, 0 for none."""
    a = np.arange(1, bins + 1)
    one = np.array([[bins, 0, 0]])
    two = np.array([[x, bins - x, 0] for x in a if x >= bins - x > 0]).reshape(-1, 3)
    three = [[x, y, bins - x - y] for x in a for y in range(1, min(x, bins - x - 1) + 1) if y >= bins - x - y]
    return np.concatenate([one, two, np.array(three).reshape(-1, 3)])


def nnls(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """Non-negative least squares by an active set: columns enter by gradient, leave at zero."""
    n = a.shape[1]
    target = a.T @ b

    def solved(columns: np.ndarray) -> np.ndarray:
        some = a[:, columns]
        try:
            return np.linalg.solve(some.T @ some, target[columns])
        except np.linalg.LinAlgError:
            return np.linalg.lstsq(some, b, rcond=None)[0]

    x, inside = np.zeros(n), np.zeros(n, dtype=bool)
    scale = max(1.0, float(np.abs(b).max(initial=0.0)))
    for _ in range(3 * a.shape[0]):
        gradient = a.T @ (b - a[:, inside] @ x[inside])
        gradient[inside] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= tolerance * scale:
            break
        inside[best] = True
        while True:
            found = np.zeros(n)
            found[inside] = solved(inside)
            below = inside & (found <= 0)
            if not below.any():
                break
            steps = x[below] / np.maximum(x[below] - found[below], 1e-300)
            x = x + steps.min() * (found - x)
            inside &= x > tolerance * scale
            x[~inside] = 0.0
            if not inside.any():
                found = x
                break
        x = found
    return x


def plan(histogram: dict[int, int], bins: int) -> list[tuple[int, int, int, int, int]]:
    """Places for the lengths of a histogram (bin: documents), from how often each combination is used.

    Rows: bin, first rank, end of ranks, first sequence, place in the sequence. Every place has a document.
    """
    all_ways = combinations(bins)
    ways = all_ways[[all(b == 0 or histogram.get(int(b), 0) for b in w) for w in all_ways]]
    if not len(ways):
        return []
    columns = np.zeros((bins, len(ways)))
    for at in range(3):
        used = ways[:, at] > 0
        np.add.at(columns, (ways[used, at] - 1, np.flatnonzero(used)), 1.0)
    counts = np.array([histogram.get(b, 0) for b in range(1, bins + 1)], dtype=float)
    repeats = np.floor(nnls(columns, counts) + 1e-6).astype(int)
    free, places, sequence = counts.astype(int), [], 0
    next_rank = dict.fromkeys(range(1, bins + 1), 0)
    for i in np.argsort(-repeats, kind="stable"):
        need = columns[:, i].astype(int)
        n = min(int(repeats[i]), int((free[need > 0] // need[need > 0]).min()))
        if n <= 0:
            continue
        free -= n * need
        for place, b in enumerate(int(b) for b in ways[i] if b):
            places.append((b, next_rank[b], next_rank[b] + n, sequence, place))
            next_rank[b] += n
        sequence += n
    return places


def tokenised(docs: DataFrame, path: str, end_id: int = END_ID, width: int = ID_BYTES) -> DataFrame:
    """doc_id, ids (unsigned little-endian of `width` bytes, with the end id) and n, stored with a row number `rid`."""
    end = end_id.to_bytes(width, "little")

    def encode(texts: list[str]) -> list:
        words = word_tokenizer(path, width)
        ids = [words.ids(t) + end for t in texts]
        return [ids, [len(i) // width for i in ids]]

    made = map_texts(docs, "text", ["doc_id"], encode, [("ids", pa.binary()), ("n", pa.int64())])
    return cut_lineage(made.withColumn("rid", F.monotonically_increasing_id()), "zstd")


def pieces(lengths: DataFrame, window: int = WINDOW, unit: int = UNIT, splits: int = SPLITS) -> DataFrame:
    """Where each document's ids go: rid, start, length, sequence_id, offset, from rid and n.

    A length that a third of all documents share is dealt over `splits` groups by a hash of the row;
    ranks and totals of the groups are added up over groups, of which there is a bounded number.
    """
    bins = window // unit
    rest = lengths.select("rid", "n", (F.col("n") % window).alias("rest"))
    rest = rest.withColumn("_bin", F.ceil(F.col("rest") / unit).cast("int"))
    rest = rest.withColumn("_split", F.pmod(F.xxhash64("rid"), F.lit(splits)).cast("int"))
    groups = ["_bin", "_split"]
    upto = (Window.unboundedPreceding, -1)
    short = rest.where(F.col("rest") > 0)
    tally = cut_lineage(short.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n")))
    histogram = {r["_bin"]: r["_n"] for r in tally.groupBy("_bin").agg(F.sum("_n").alias("_n")).collect()}
    places = plan(histogram, bins)
    filled = max((p[3] + p[2] - p[1] for p in places), default=0)
    before = Window.partitionBy("_bin").orderBy("_split").rowsBetween(*upto)
    starts = tally.select(*groups, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*groups).orderBy("rid")
    ranked = short.withColumn("_k", F.row_number().over(within) - 1).join(starts, groups)
    ranked = ranked.select("rid", "n", "rest", *groups, (F.col("_start") + F.col("_k")).alias("_rank"))
    kinds = "_bin int, _from long, _to long, _sequence long, _place int"
    spark = lengths.sparkSession
    table_ = F.broadcast(spark.createDataFrame(places, kinds))
    fits = (ranked["_bin"] == table_["_bin"]) & F.col("_rank").between(F.col("_from"), F.col("_to") - 1)
    placed = cut_lineage(ranked.join(table_, fits, "left").drop(table_["_bin"]))
    sequence = F.col("_sequence") + F.col("_rank") - F.col("_from")
    neat = placed.where(F.col("_place").isNotNull()).select(
        "rid", (F.col("n") - F.col("rest")).alias("start"), F.col("rest").alias("length"), sequence.alias("sequence_id"), "_place"
    )
    earlier = Window.partitionBy("sequence_id").orderBy("_place").rowsBetween(*upto)
    neat = neat.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))).drop("_place")

    left = placed.where(F.col("_place").isNull())
    sums = cut_lineage(left.groupBy(*groups).agg(F.sum("rest").alias("_sum")))
    per_bin = sums.groupBy("_bin").agg(F.sum("_sum").alias("_sum"))
    over_bins = Window.orderBy("_bin").rowsBetween(*upto)  # one row per bin
    bin_starts = per_bin.select("_bin", F.coalesce(F.sum("_sum").over(over_bins), F.lit(0)).alias("_bin_start"))
    starts = sums.join(F.broadcast(bin_starts), "_bin").select(
        *groups, (F.col("_bin_start") + F.coalesce(F.sum("_sum").over(before), F.lit(0))).alias("_start")
    )
    ahead = F.coalesce(F.sum("rest").over(within.rowsBetween(*upto)), F.lit(0))
    laid = left.withColumn("_ahead", ahead).join(starts, groups)
    at = F.col("_start") + F.col("_ahead")
    first, last = F.floor(at / window), F.floor((at + F.col("rest") - 1) / window)
    laid = laid.select("rid", "n", "rest", at.alias("_at"), F.explode(F.sequence(first, last)).alias("_w"))
    lo, hi = F.greatest("_at", F.col("_w") * window), F.least(F.col("_at") + F.col("rest"), (F.col("_w") + 1) * window)
    greedy = laid.select(
        "rid",
        (F.col("n") - F.col("rest") + lo - F.col("_at")).alias("start"),
        (hi - lo).alias("length"),
        (F.col("_w") + filled).alias("sequence_id"),
        (lo - F.col("_w") * window).alias("offset"),
    )
    whole = lengths.where(F.col("n") >= window).select("rid", F.floor(F.col("n") / window).alias("_full"))
    tail = greedy.agg(F.max("sequence_id").alias("last")).first()["last"]
    base = filled if tail is None else tail + 1
    number = whole.groupBy(F.pmod(F.xxhash64("rid"), F.lit(splits)).alias("_split")).agg(F.sum("_full").alias("_sum"))
    overall = Window.orderBy("_split").rowsBetween(*upto)  # at most `splits` rows
    offsets = number.select("_split", F.coalesce(F.sum("_sum").over(overall), F.lit(0)).alias("_start"))
    split = whole.withColumn("_split", F.pmod(F.xxhash64("rid"), F.lit(splits)))
    mine = Window.partitionBy("_split").orderBy("rid").rowsBetween(*upto)
    full = split.withColumn("_ahead", F.coalesce(F.sum("_full").over(mine), F.lit(0))).join(F.broadcast(offsets), "_split")
    full = full.select(
        "rid",
        (F.col("_start") + F.col("_ahead") + base).alias("_first"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_full") - 1)).alias("_i"),
    ).select(
        "rid",
        (F.col("_i") * window).alias("start"),
        F.lit(window).cast("long").alias("length"),
        (F.col("_first") + F.col("_i")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return neat.unionByName(greedy).unionByName(full)


def packed_ids(docs: DataFrame, path: str, window: int = WINDOW, unit: int = UNIT) -> DataFrame:
    """All pieces with their ids: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    NULL and empty texts have the end id alone; repeated rows are packed each on their own; an
    empty table gives no pieces.
    """
    width = id_bytes(path)
    tokens = tokenised(docs, path, width=width)
    where = cut_lineage(pieces(tokens.select("rid", "n"), window, unit))
    by_row = where.groupBy("rid").agg(
        F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("_pieces")
    )  # a document has few pieces
    found = tokens.join(by_row, "rid").select("doc_id", "ids", F.col("n").alias("doc_tokens"), F.inline("_pieces"))
    cut = F.substring(F.col("ids"), (F.col("start") * width + 1).cast("int"), (F.col("length") * width).cast("int"))
    found = found.select("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", cut.alias("ids"))
    if width == ID_BYTES:
        return found

    def wide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            yield batch.set_column(at, "ids", widened(batch.column(at), width).cast(pa.binary()))

    return found.mapInArrow(wide, found.schema)


def sequences(docs: DataFrame, path: str, window: int = WINDOW, unit: int = UNIT) -> DataFrame:
    """The sequences themselves: sequence_id, ids (unsigned 32-bit), doc_ids and offsets of their pieces."""
    parts = packed_ids(docs, path, window, unit).groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("_parts")
    )  # at most `window` ids
    joined = F.aggregate("_parts", F.lit(b""), lambda out, p: F.concat(out, p["ids"]))
    return parts.select("sequence_id", joined.alias("ids"), F.col("_parts.doc_id").alias("doc_ids"), F.col("_parts.offset").alias("offsets"))


def piece_digests(docs: DataFrame, path: str) -> DataFrame:
    """The pieces with a CRC-32 of their ids in place of the ids."""
    found = packed_ids(docs, path)
    return found.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op3_nnls_packing(spark, sf_dir) -> DataFrame:
    """All documents packed into sequences of at most 4096 ids."""
    import public_tokenizers

    return piece_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
