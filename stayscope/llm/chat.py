"""Chat formatting: cumulative snapshots of a conversation collapse into its longest form.

A log that writes a conversation again after every turn holds all its prefixes. Each turn is hashed
with its position, the hashes are rolled up by XOR into one hash per prefix, and a conversation
whose whole hash is the prefix hash of a longer one is dropped by an anti-join of distinct
hashes. Of equal conversations the smallest conv_id stays. What is left is rendered.

Turns are numbered over ranges of all rows and rolled up in blocks of a thousand places, so no task
needs a whole conversation, whatever its turn numbers are. All of it is built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stayscope.llm.common import or_empty, table
from stayscope.operators.ordering import row_numbers
from stayscope.sources.checkpoints import cut_lineage

BLOCK_TURNS = 1000
PART_BYTES = 1 << 26
HASHES = ("_a", "_b")


def _with_offsets(turns: DataFrame, starts: DataFrame) -> DataFrame:
    named = starts.withColumnsRenamed({"conv_id": "_conv", "_block": "_of"})
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("_block").eqNullSafe(F.col("_of"))
    return turns.join(named, same).drop("_conv", "_of")


def ordered_turns(turns: DataFrame, block: int = BLOCK_TURNS) -> DataFrame:
    """conv_id, role, text, k (position from 1), _block (`block` positions) and part (number of the `block` turn numbers, from 0).

    Turns stand by turn (NULL first), role and text; NULL roles and texts are empty; identical rows
    count once. NULL is a conversation of its own.
    """
    rows = turns.select("conv_id", "turn", or_empty("role").alias("role"), or_empty("text").alias("text")).distinct()
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text")]
    rows = cut_lineage(row_numbers(rows, order, "_row", one_task_rows=block))
    rows = rows.withColumn("_block", F.floor(F.col("turn") / block))
    whole = Window.partitionBy("conv_id")
    before = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("conv_id", "_block").agg(F.min("_row").alias("_first"))
    starts = starts.select(
        "conv_id",
        "_block",
        F.min("_first").over(whole).alias("_start"),
        F.count(F.lit(1)).over(before).alias("part"),
    )
    place = F.col("_row") - F.col("_start")
    placed = _with_offsets(rows, starts).select("conv_id", "role", "text", "part", (place + 1).alias("k"))
    return placed.withColumn("_block", F.floor((F.col("k") - 1) / block))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, k and the two 64-bit hashes of the first k turns, from `ordered_turns`."""
    one = {h: F.xxhash64(F.lit(h), "k", "role", F.lit("\0"), "text") for h in HASHES}
    rows = turns.select("conv_id", "_block", "k", *[v.alias(h) for h, v in one.items()])
    before = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("conv_id", "_block").agg(*[F.bit_xor(h).alias(f"_to{h}") for h in HASHES])
    starts = starts.select(
        "conv_id", "_block", *[F.coalesce(F.bit_xor(f"_to{h}").over(before), F.lit(0)).alias(f"_to{h}") for h in HASHES]
    )
    within = Window.partitionBy("conv_id", "_block").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    rolled = rows.withColumns({h: F.bit_xor(h).over(within) for h in HASHES})
    placed = _with_offsets(rolled, starts)
    return placed.select("conv_id", "k", *[F.col(h).bitwiseXOR(F.col(f"_to{h}")).alias(h) for h in HASHES])


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """conv_id (smallest of equal conversations) and copies (their number) of what no longer one begins with."""
    hashes = cut_lineage(prefix_hashes(turns))
    sizes = hashes.groupBy("conv_id").agg(F.max("k").alias("_n"))
    ends = sizes.withColumnRenamed("conv_id", "_conv")
    whole = hashes.join(ends, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("k") == F.col("_n")))
    whole = whole.groupBy("k", *HASHES).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies")
    )
    longer = hashes.join(ends, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("k") < F.col("_n")))
    return whole.join(longer.select("k", *HASHES).distinct(), ["k", *HASHES], "left_anti").select("conv_id", "copies")


def rendered(role: Column, text: Column) -> Column:
    """One turn in the chat template."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """Maximal conversations rendered: conv_id, part, n_turns, copies, text.

    A conversation with at most `BLOCK_TURNS` turns numbered from 0 is one row; a longer one has a
    row per block of turn numbers, in the order of `part`, whose texts follow one another. Where many turns
    share their numbers, a text ends with the first thousand turns by which it has `PART_BYTES`, and parts
    count on. An empty table gives no rows.
    """
    turns = cut_lineage(ordered_turns(conversations))
    kept = maximal_conversations(turns).withColumnRenamed("conv_id", "_kept")
    rows = turns.join(kept, F.col("conv_id").eqNullSafe(F.col("_kept")))
    rows = rows.select("conv_id", "part", "copies", "_block", "k", rendered(F.col("role"), F.col("text")).alias("s"))

    def joined(at: str) -> Column:
        pieces = F.array_sort(F.collect_list(F.struct(at, "s")))
        return F.array_join(F.transform(pieces, lambda p: p["s"]), "")

    keys = ["conv_id", "part", "copies", "_block"]
    blocks = cut_lineage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), joined("k").alias("s")))
    upto = Window.partitionBy("conv_id", "part").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocks.select("conv_id", "part", "_block", F.octet_length("s").cast("long").alias("_bytes"))
    sizes = sizes.withColumn("_cut", F.floor(F.coalesce(F.sum("_bytes").over(upto), F.lit(0)) / PART_BYTES))
    number = (F.dense_rank().over(Window.partitionBy("conv_id").orderBy("part", "_cut")) - 1).cast("long")
    sizes = sizes.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_of"), F.col("_block").alias("_b"), number.alias("_part"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_of")) & (F.col("_block") == F.col("_b"))
    blocks = blocks.join(sizes, same).select("conv_id", F.col("_part").alias("part"), "copies", "_block", "_n", "s")
    grouped = blocks.groupBy("conv_id", "part", "copies").agg(F.sum("_n").alias("n_turns"), joined("_block").alias("text"))
    return grouped.select("conv_id", "part", "n_turns", "copies", "text")


def op6_chat_format(spark, sf_dir) -> DataFrame:
    """All conversations without those that others begin with, rendered."""
    return format_chats(table(spark, sf_dir, "conversations"))


OP6_SQL = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
         dense_rank() OVER (PARTITION BY conv_id ORDER BY floor(turn / 1000) NULLS FIRST) - 1 AS part
  FROM t),
c AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY k) AS turns FROM o GROUP BY conv_id),
w AS (SELECT turns, min(conv_id) AS conv_id, count(*) AS copies FROM c GROUP BY turns),
p AS (SELECT DISTINCT turns[1:n] AS turns FROM (SELECT turns, unnest(range(1, len(turns))) AS n FROM c)),
m AS (SELECT conv_id, copies FROM w ANTI JOIN p USING (turns))
SELECT o.conv_id, part, count(*) AS n_turns, copies,
       string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' ORDER BY k) AS text
FROM o JOIN m ON o.conv_id IS NOT DISTINCT FROM m.conv_id
GROUP BY o.conv_id, part, copies
"""
