"""Mixing sources to target weights: hash-random order within a source, cut at its exact budget.

A source's documents stand in the order of a hash. Its leading hash digits are known ranges of
that order, so the order needs no sampling: sums per range are made first, a window adds them up
within the source, and each range is then summed on its own. A source with a third of all rows is
spread over all its ranges. A budget beyond the source's size repeats whole epochs; the document
at the cut is taken in part, so every source meets its budget to the word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stayscope.llm.common import BLANK, or_empty, word_count
from stayscope.operators.joins import attach, fits_broadcast
from stayscope.operators.ordering import row_numbers, running_totals
from stayscope.sources.checkpoints import cut_lineage

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
RANGE_DIGITS = 3
RANGE_ROWS = 100_000


def random_key(doc_id: str, text: str, seed: str = "mix") -> Column:
    """Hash of id and text as hexadecimal digits: the same in every run, and unlike any order."""
    return F.md5(F.concat_ws(":", F.lit(seed), F.col(doc_id).cast("string"), F.md5(or_empty(text))))


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Target per source: source, source_size, target (double).

    `sizes` has source and source_size, one row per source. Sources by code point, NULL last, get
    `weights` in turn and share the sum of all sizes; none gets more than `max_epochs` times its
    size, and what is over goes to the others by weight. The share of a unit of weight is the
    largest one found when the sources that fill up first are taken out one after another.
    """
    turn = F.array(*[F.lit(w) for w in weights])
    order = [F.col("source").asc_nulls_last()]
    ranked = running_totals(sizes, order, {"_rank": F.lit(1).cast("long")})
    ranked = ranked.select(
        "source",
        "source_size",
        F.element_at(turn, ((F.col("_rank") - 1) % len(weights) + 1).cast("int")).cast("long").alias("_weight"),
    )
    ranked = ranked.withColumns(
        {"_most": F.col("source_size") * max_epochs, "_full": F.col("source_size") * max_epochs / F.col("_weight")}
    )
    ranked = cut_lineage(ranked)
    whole = ranked.agg(F.sum("source_size").alias("size"), F.sum("_weight").alias("weight")).first()
    steps = running_totals(
        ranked, ["_full", *order], {"_upto": F.col("_most"), "_weight_upto": F.col("_weight")}, stored=True
    )
    left = F.lit(whole["size"] or 0) - (F.col("_upto") - F.col("_most"))
    weight = F.lit(whole["weight"] or 1) - (F.col("_weight_upto") - F.col("_weight"))
    unit = steps.agg(F.max(left / weight).alias("unit")).first()["unit"] or 0.0
    target = F.least(F.col("_most").cast("double"), F.lit(float(unit)) * F.col("_weight"))
    return ranked.select("source", "source_size", target.alias("target"))


def mix(
    df: DataFrame,
    sizes: DataFrame | None = None,
    weights=WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    digits: int = RANGE_DIGITS,
) -> DataFrame:
    """Add source_size, target and taken (words the mix takes, repeats counted) to every row.

    `df` has source, size and key (see `random_key`); other columns pass through. `sizes`, where
    given, has the same three columns of the same rows and is cheaper to read. NULL is a source
    of its own, rows of size 0 take nothing, an empty table gives an empty one, and rows with
    equal keys are ordered by size: repeated rows are taken one after the other.
    """
    near = F.substring("key", 1, digits)
    ranges = (sizes or df).groupBy("source", near.alias("_range")).agg(F.sum("size").alias("_sum"))
    ranges = cut_lineage(ranges)
    per_source = ranges.groupBy("source").agg(F.sum("_sum").alias("source_size"))
    targets = source_targets(per_source, weights, max_epochs)
    before = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("_start", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    named = targets.withColumnRenamed("source", "_of")
    starts = starts.join(named, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")
    starts = cut_lineage(starts.withColumnsRenamed({"source": "_of", "_range": "_at"}))
    within = Window.partitionBy("source", "_range").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = df.withColumn("_range", near).withColumn("_before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(starts, F.col("source").eqNullSafe(F.col("_of")) & (F.col("_range") == F.col("_at")))
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - epochs * F.col("source_size") - F.col("_start") - F.col("_before")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(rest, F.col("size")))
    return placed.withColumn("taken", taken.cast("long")).drop("_range", "_before", "_of", "_at", "_start")


def keyed(docs: DataFrame, *carry: Column) -> DataFrame:
    """doc_id, source, size (words), key and `carry` of a table with doc_id, text and source."""
    return docs.select(
        "doc_id", "source", word_count("text").alias("size"), random_key("doc_id", "text").alias("key"), *carry
    )


def first_words(text: Column, n: Column) -> Column:
    """The first `n` (at least 1) words of a text with what stands between them."""
    words = F.split(text, f"(?<={BLANK})(?=[^{BLANK[1:]})")
    lead = F.substring(text, 1, 1).rlike(BLANK).cast("int")
    return F.regexp_replace(F.concat_ws("", F.slice(words, F.lit(1), n.cast("int") + lead)), f"{BLANK}+\\z", "")


def source_cuts(rows: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Where each source's last epoch ends: source, epochs (whole ones), cut (a key) and left (words to take at that key).

    `rows` has source, size and key, stored. Rows before the cut are taken once more than `epochs`, those
    after it are not. Only the hash range that holds a source's cut is put in order; ranges get
    finer with the number of rows. A source without words has no cut: epochs 0, NULL, 0.
    """
    digits, total = RANGE_DIGITS, rows.count()
    while total > range_rows * 16**digits:
        digits += 1
    near = F.substring("key", 1, digits)
    ranges = cut_lineage(rows.groupBy("source", near.alias("range")).agg(F.sum("size").alias("sum")))
    targets = source_targets(ranges.groupBy("source").agg(F.sum("sum").alias("source_size")), weights, max_epochs)
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    targets = targets.select(F.col("source").alias("of"), epochs.alias("epochs"), (budget - epochs * F.col("source_size")).alias("rest"))
    targets = cut_lineage(targets)
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("start", F.coalesce(F.sum("sum").over(before), F.lit(0)))
    starts = starts.join(targets, F.col("source").eqNullSafe(F.col("of")))
    starts = starts.where((F.col("start") <= F.col("rest")) & (F.col("rest") < F.col("start") + F.col("sum")))
    starts = starts.select("of", "range", (F.col("rest") - F.col("start")).alias("ahead"))
    starts = cut_lineage(starts)
    starts = F.broadcast(starts) if fits_broadcast(starts) else starts
    inside = rows.join(starts, F.col("source").eqNullSafe(F.col("of")) & (near == F.col("range")))
    alike = inside.groupBy("of", "key", "ahead").agg(F.sum("size").alias("sum"))
    upto = Window.partitionBy("of").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    alike = alike.withColumn("upto", F.sum("sum").over(upto)).withColumn("start", F.col("upto") - F.col("sum"))
    met = alike.where((F.col("start") <= F.col("ahead")) & (F.col("ahead") < F.col("upto")))
    met = met.select(F.col("of").alias("at"), F.col("key").alias("cut"), (F.col("ahead") - F.col("start")).alias("left"))
    found = targets.join(met, F.col("of").eqNullSafe(F.col("at")), "left")
    return found.select(F.col("of").alias("source"), "epochs", "cut", F.coalesce("left", F.lit(0)).cast("long").alias("left"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself, with the columns of `docs`: whole copies, and one cut text per source.

    A document is repeated once per epoch; the one at its source's cut ends after the last word
    taken, with n_chars (if there is such a column) counted anew. What the budget leaves is gone,
    NULL and empty texts too. Repeated rows at a cut are taken one after the other. Any other column
    may have any name. An empty table gives an empty one. Texts are not moved: a row is decided by
    its key and its source's cut, and only the rows at a cut are numbered.
    """
    cuts = source_cuts(cut_lineage(keyed(docs).select("source", "size", "key")))
    named = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))  # NULL is a source of its own
    cuts = cut_lineage(cuts.select(named.alias("source"), "epochs", "cut", "left"))
    rows = keyed(docs, F.struct(*docs.columns).alias("row")).select("row", "size", "key", named.alias("source"))
    rows = attach(rows, cuts, "source").where("size > 0")
    plain = rows.where("cut IS NULL OR key <> cut")
    times = (F.col("epochs") + F.when(F.col("key") < F.col("cut"), 1).otherwise(0)).cast("int")
    plain = plain.select("row", F.explode(F.array_repeat(F.lit(0).cast("long"), times)).alias("part"))
    met = cut_lineage(rows.where("key = cut").withColumn("id", F.monotonically_increasing_id()))
    met = cut_lineage(row_numbers(met, ["source", "id"], "n"))  # rows of one text per source
    met = attach(met, met.groupBy("source").agg(F.min("n").alias("first")), "source")
    take = F.greatest(F.lit(0), F.least(F.col("left") - (F.col("n") - F.col("first")) * F.col("size"), F.col("size")))
    times = (F.col("epochs") + F.when(take == F.col("size"), 1).otherwise(0)).cast("int")
    some = F.when((take > 0) & (take < F.col("size")), F.array(take)).otherwise(F.array().cast("array<bigint>"))
    met = met.select("row", F.explode(F.concat(F.array_repeat(F.lit(0).cast("long"), times), some)).alias("part"))
    short = F.when(F.col("part") > 0, first_words(F.col("row.text"), F.col("part")))
    changed = {"text": F.coalesce(short, F.col("row.text"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(short.isNotNull(), F.length(short)).otherwise(F.col("row.n_chars"))
    kinds = dict(docs.dtypes)
    return plain.unionByName(met).select(*[changed.get(c, F.col("row")[c]).cast(kinds[c]).alias(c) for c in docs.columns])


def op1_source_mix(spark, sf_dir) -> DataFrame:
    """All documents with what a mix of 1 : 2 : 3 by source takes of them."""
    from stayscope.llm.common import table

    rows = cut_lineage(keyed(table(spark, sf_dir, "documents")))
    return mix(rows).select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(concat_ws(':', 'mix', doc_id::VARCHAR, md5(coalesce(text, '')))) AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight FROM s),
f AS (SELECT *, source_size * 3 / weight AS filled FROM w),
u AS (
  SELECT max(((SELECT sum(source_size)::BIGINT FROM s) - caps + source_size * 3) / rest) AS unit
  FROM (SELECT *,
          (sum(source_size * 3) OVER (ORDER BY filled, source NULLS LAST ROWS UNBOUNDED PRECEDING))::BIGINT AS caps,
          (sum(weight) OVER (ORDER BY filled DESC, source DESC NULLS FIRST ROWS UNBOUNDED PRECEDING))::BIGINT AS rest
        FROM f)),
t AS (SELECT source, source_size, least((source_size * 3)::DOUBLE, unit * weight) AS target FROM f, u),
p AS (
  SELECT doc_id, size, source_size, target, floor(target + 0.5)::BIGINT AS budget,
         CASE WHEN source_size > 0 THEN floor(floor(target + 0.5) / source_size) ELSE 0 END::BIGINT AS epochs,
         (sum(size) OVER (PARTITION BY d.source ORDER BY key, size ROWS UNBOUNDED PRECEDING))::BIGINT - size AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(budget - epochs * source_size - before, size)))::BIGINT AS taken
FROM p
"""
