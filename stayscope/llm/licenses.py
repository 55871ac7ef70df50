"""License scans: an exact set-similarity join of text blocks with templates of notices.

Both sides are sets of words. Words are put in one order, those that are rare in all texts first.
A block that holds the least share of a template must hold one of the template's first words in
that order (prefix filter), enough words of any template (length filter), and enough words that come
later than the one it was found by (positional filter). What passes is compared in full.

A template of m words meets blocks of twice c words, one every c words, where c is the power
of two that holds m: a notice lies whole in one of them, however the lines are broken. Texts
are read twice, once to count the templates' words in all of them and once for the blocks, and
are never moved: only words of templates leave a row, in pieces of bounded size. All of it is
built-in expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayscope.llm.common import lower_az, table
from stayscope.operators.joins import attach
from stayscope.sources.checkpoints import cut_lineage

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LEAST_SHARE = 90  # per cent of a template's words
LEAST_BLOCK = 8
PLACES = "array<struct<at:int,label:string>>"
PIECE = "array<struct<from:int,hits:array<struct<at:int,word:string>>>>"
BLOCK = "_row long, template int, label string, from_word long, n_words long, share double"

# Phrases that the scan must report, with their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Labels and notices as authors write them.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-or-later", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)


def words(text: str | Column) -> Column:
    """Words of a text in which only A-Z are lower-cased: digits, a-z and all letters beyond ASCII; NULL has none."""
    return F.filter(F.split(lower_az(text), NO_WORD), lambda w: w != "")


def _template_rows(spark, templates: Sequence[tuple[str, str]]) -> DataFrame:
    """template (number), label, words (in order, with repeats), block (power of two), a row per template with words."""
    rows = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(name).alias("label"), F.lit(t).alias("_t")) for i, (name, t) in enumerate(templates)])
    found = spark.range(1, numPartitions=1).select(F.inline(rows))
    found = found.select("template", "label", words("_t").alias("words")).where(F.size("words") > 0)
    block = F.greatest(F.lit(LEAST_BLOCK), F.pow(2, F.ceil(F.log2(F.size("words"))))).cast("long")
    return found.withColumn("block", block)


def _counts(docs: DataFrame, text: str, vocabulary: list[str]) -> dict[str, int]:
    """How often each word of the templates occurs in all texts; one number per word of the templates comes back."""
    each = docs.select(F.explode(words(text)).alias("word")).where(F.col("word").isin(vocabulary))
    return {r["word"]: r["n"] for r in each.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}


def prefixes(templates: list, counts: dict[str, int], least: int = LEAST_SHARE) -> list[dict]:
    """Per template row: words, rarest first, how many a block must hold (need), and the first ones, of which it holds one."""
    found = []
    for t in templates:
        ranked = sorted(set(t["words"]), key=lambda w: (counts.get(w, 0), w))
        need = -(-least * len(ranked) // 100)
        found.append({**t.asDict(), "words": ranked, "need": need, "prefix": ranked[: len(ranked) - need + 1]})
    return found


def _index(spark, templates: list[dict], rank: dict[str, int]) -> DataFrame:
    """A row per template and word of its prefix: rank, template, label, block, need, place, ranks (all words)."""
    rows = [
        F.struct(
            F.lit(rank[w]).alias("rank"),
            F.lit(t["template"]).alias("template"),
            F.lit(t["label"]).alias("label"),
            F.lit(t["block"]).alias("block"),
            F.lit(t["need"]).alias("need"),
            F.lit(place).alias("place"),
            F.array(*[F.lit(rank[x]) for x in t["words"]]).alias("ranks"),
        )
        for t in templates
        for place, w in enumerate(t["prefix"])
    ]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*rows)))


def _pieces(found: Column, span: int, known: list[str], first: list[str], least: int) -> Column:
    """Words of templates with their places, in pieces of 2 * `span` words every `span`; only pieces that may hold a template."""

    def piece(at: Column) -> Column:
        near = F.transform(F.slice(found, at.cast("int") + 1, 2 * span), lambda w, i: F.struct((at + i).alias("at"), w.alias("word")))
        return F.struct(at.alias("from"), F.filter(near, lambda x: x["word"].isin(known)).alias("hits"))

    starts = F.sequence(F.lit(0), F.greatest(F.size(found) - 1, F.lit(0)), F.lit(span))
    may = lambda p: (F.size(p["hits"]) >= least) & F.exists(p["hits"], lambda x: x["word"].isin(first))
    return F.filter(F.transform(starts, piece), may)


def license_blocks(rows: DataFrame, index: DataFrame, rank: dict[str, int], span: int) -> DataFrame:
    """_row, template, label, from_word, n_words and share of every block that meets a template's least share.

    `rows` has _row and _pieces (see `_pieces`). A piece has all words of the blocks that start in its first half.
    """
    order = F.array(*[F.lit(w) for w in rank])
    ranked = F.transform("hits", lambda x: F.struct(x["at"].alias("at"), (F.array_position(order, x["word"]) - 1).cast("int").alias("rank")))
    near = rows.select("_row", F.inline("_pieces")).select("_row", "from", ranked.alias("hits"))
    probes = near.select("*", F.explode("hits").alias("hit"))
    met = probes.join(F.broadcast(index), F.col("hit.rank") == F.col("rank"))
    number = F.floor(F.col("hit.at") / F.col("block"))
    met = met.withColumn("from_word", F.explode(F.array(number * F.col("block"), (number - 1) * F.col("block"))))
    met = met.where((F.col("from_word") >= F.col("from")) & (F.col("from_word") < F.col("from") + span))
    end = F.col("from_word") + 2 * F.col("block")
    inside = F.filter("hits", lambda x: (x["at"] >= F.col("from_word")) & (x["at"] < end))
    met = met.withColumn("held", F.array_sort(F.array_distinct(F.transform(inside, lambda x: x["rank"]))))
    later = F.size("held") - F.array_position("held", F.col("rank")).cast("int")
    most = 1 + F.least(F.size("ranks") - 1 - F.col("place"), later)  # the first word in common decides
    met = met.where((F.size("held") >= F.col("need")) & (most >= F.col("need")))
    met = met.withColumn("both", F.size(F.array_intersect("held", "ranks"))).where(F.col("both") >= F.col("need"))
    share = F.col("both") / F.size("ranks")
    found = met.select("_row", "template", "label", "from_word", (2 * F.col("block")).alias("n_words"), share.alias("share"))
    return found.distinct()


def _places(found: Column, phrase: str, label: str) -> Column:
    """Numbers (`at`) of the words at which a phrase starts, each with the `label`."""
    parts = phrase.split()
    held = F.size(found) >= len(parts)
    for w in parts:
        held = held & F.array_contains(found, w)

    def here(i: Column) -> Column:
        same = F.lit(True)
        for k, w in enumerate(parts):
            same = same & (F.get(found, i + k) == w)
        return same

    starts = F.filter(F.sequence(F.lit(0), F.size(found) - len(parts)), here)
    named = F.transform(starts, lambda i: F.struct(i.alias("at"), F.lit(label).alias("label")))
    return F.when(held, named).otherwise(F.array().cast(PLACES))


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    least: int = LEAST_SHARE,
    text: str = "text",
    keep: str = "doc_id",
) -> tuple[DataFrame, DataFrame]:
    """What a scan finds in every row of `docs`: its rows, and the blocks that meet a template.

    Rows: _row (number), the column `keep`, n_words, places (struct of `at`, a word number, and `label`) of phrases. Blocks: see
    `license_blocks`. NULL and empty texts have no words, places or blocks; equal rows count each;
    an empty table gives empty ones; columns other than the two named are not looked at, whatever their names.
    Templates and phrases without words find nothing. `templates` and `phrases` are short lists, part of the plan.
    """
    spark = docs.sparkSession
    rows = _template_rows(spark, templates).collect() if templates else []
    known = sorted({w for t in rows for w in t["words"]})
    counts = _counts(docs, text, known) if known else {}
    ready = prefixes(rows, counts, least)
    rank = {w: i for i, w in enumerate(sorted(known, key=lambda w: (counts.get(w, 0), w)))}
    span = max((t["block"] for t in ready), default=LEAST_BLOCK)
    first = sorted({w for t in ready for w in t["prefix"]})
    found = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(keep).alias("_keep"), words(text).alias("_words"))
    each = [_places(F.col("_words"), phrase, label) for phrase, label in phrases if phrase.split()]
    pieces = _pieces(F.col("_words"), span, known, first, min(t["need"] for t in ready)) if ready else F.array().cast(PIECE)
    found = cut_lineage(
        found.select("_row", "_keep", F.size("_words").cast("long").alias("n_words"), F.concat(F.array().cast(PLACES), *each).alias("places"), pieces.alias("_pieces"))
    )
    with_pieces = found.where(F.size("_pieces") > 0)
    blocks = license_blocks(with_pieces, _index(spark, ready, rank), rank, span) if ready else spark.createDataFrame([], BLOCK)
    return found.drop("_pieces").withColumnRenamed("_keep", keep), blocks


def license_labels(docs: DataFrame, **choices) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row; see `scan`.

    The score is 1 where a phrase stands, else the largest share of a template in a block, 0 without any.
    """
    rows, blocks = scan(docs, **choices)
    per_row = blocks.groupBy("_row").agg(F.collect_set("label").alias("_more"), F.max("share").alias("_share"))
    found = attach(rows, cut_lineage(per_row), "_row")
    base = F.array_distinct(F.col("places.label"))
    every = F.array_union(base, F.coalesce("_more", F.array().cast("array<string>")))
    score = F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("_share", F.lit(0.0)))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.at").cast("long").alias("first_word"),
        F.array_max("places.at").cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        score.alias("score"),
    )


def op11_license_scan(spark, sf_dir) -> DataFrame:
    """License labels of all documents."""
    return license_labels(table(spark, sf_dir, "documents"))


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
t AS (
  SELECT label, list_distinct(w) AS s, greatest({LEAST_BLOCK}, pow(2, ceil(log2(len(w)))))::BIGINT AS c
  FROM (SELECT label, {_WORDS.format("notice")} AS w
        FROM (VALUES {", ".join(f"('{name}', '{notice}')" for name, notice in TEMPLATES)}) AS v(label, notice))),
c AS (SELECT DISTINCT c FROM t),
b AS (SELECT row, c, list_distinct(list_slice(w, pos + 1, pos + 2 * c)) AS s
      FROM (SELECT row, w, c, unnest(range(0, len(w), c)) AS pos FROM d, c)),
m AS (SELECT row, label, len(list_intersect(b.s, t.s)) / len(t.s) AS share FROM b JOIN t USING (c)
      WHERE 100 * len(list_intersect(b.s, t.s)) >= {LEAST_SHARE} * len(t.s)),
f AS (SELECT string_split(phrase, ' ') AS p, label
      FROM (VALUES {", ".join(f"('{p}', '{name}')" for p, name in PHRASES)}) AS v(phrase, label)),
h AS (SELECT row, label, pos
      FROM (SELECT row, w, unnest(range(len(w))) AS pos FROM d WHERE list_has_any(w, (SELECT list(p[1]) FROM f))) JOIN f
      ON w[pos + 1] = p[1] AND list_slice(w, pos + 1, pos + len(p)) = p),
g AS (SELECT row, count(*) AS n, min(pos) AS lo, max(pos) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS names
      FROM h GROUP BY row),
a AS (SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) AS names
      FROM (SELECT row, label FROM h UNION ALL SELECT row, label FROM m) GROUP BY row),
x AS (SELECT row, max(share) AS share FROM m GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
       coalesce(g.names, '') AS base_labels, coalesce(a.names, '') AS labels,
       (CASE WHEN n > 0 THEN 1 ELSE coalesce(share, 0) END)::DOUBLE AS score
FROM d LEFT JOIN g USING (row) LEFT JOIN a USING (row) LEFT JOIN x USING (row)
"""
