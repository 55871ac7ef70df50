"""Noun lemmas, worked out once per distinct token and mapped back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayscope.operators.joins import attach
from stayscope.sources.checkpoints import cut_lineage

# Noun endings and what they are replaced by.
NOUN_ENDINGS = [
    ("s", ""),
    ("ses", "s"),
    ("ves", "f"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
]


def _shorter_forms(form: Column) -> Column:
    """Every form that one ending rule makes of `form`."""
    forms = [
        F.when(
            form.endswith(old),
            F.concat(F.substring(form, F.lit(1), F.length(form) - len(old)), F.lit(new)),
        )
        for old, new in NOUN_ENDINGS
    ]
    return F.array_compact(F.array(*forms))


def _rounds(token: Column) -> Column:
    """Candidate forms of a token, one array per round; the token itself is in the first.

    Every rule that can be followed by another removes one "s", so their number bounds the rounds.
    """
    first = F.concat(F.array(token), _shorter_forms(token))
    more = F.sequence(F.lit(1), F.length(token) - F.length(F.translate(token, "s", "")) + 1)
    start = F.struct(F.array(first).alias("done"), _shorter_forms(token).alias("last"))

    def step(acc: Column, _: Column) -> Column:
        forms = F.flatten(F.transform(acc["last"], _shorter_forms))
        return F.struct(F.concat(acc["done"], F.array(forms)).alias("done"), forms.alias("last"))

    return F.aggregate(more, start, step, lambda acc: acc["done"])


def lemma_table(
    vocabulary: DataFrame,
    lexicon: DataFrame | None = None,
    exceptions: DataFrame | None = None,
) -> DataFrame:
    """Tokens of `vocabulary(token)` whose lemma differs: (token, lemma).

    `lexicon(word)` lists the accepted forms and is the vocabulary itself by default;
    `exceptions(token, lemma)` lists irregular forms, which replace the rules. The shortest
    accepted form of the first round that has one is the lemma, else the token stays.
    """
    words = vocabulary.select(F.col("token").alias("form")) if lexicon is None else (
        lexicon.select(F.col("word").alias("form")).distinct()
    )
    regular = vocabulary
    if exceptions is not None:
        regular = vocabulary.join(exceptions.select("token"), "token", "left_anti")
    open_ended = regular.where(F.col("token").endswith("s") | F.col("token").endswith("men"))
    forms = (
        open_ended.select("token", F.posexplode(_rounds(F.col("token"))).alias("round", "forms"))
        .select("token", "round", F.posexplode("forms").alias("pos", "form"))
    )
    if exceptions is not None:
        irregular = vocabulary.join(exceptions, "token").select(
            "token", F.lit(0).alias("round"), F.posexplode(F.array("token", "lemma")).alias("pos", "form")
        )
        forms = forms.unionByName(irregular)
    rank = F.struct("round", F.length("form").alias("size"), "pos", "form")
    lemmas = forms.join(words, "form", "left_semi").groupBy("token").agg(F.min(rank)["form"].alias("lemma"))
    return lemmas.where(F.col("lemma") != F.col("token"))


def lemmatize(
    df: DataFrame,
    id_col: str,
    tokens_col: str,
    out: str,
    lexicon: DataFrame | None = None,
    exceptions: DataFrame | None = None,
) -> DataFrame:
    """Add the noun lemmas of a token array; an empty or missing array gives an empty one.

    `id_col` identifies rows. The rows are written once, as three passes read their tokens. Only the
    tokens that change travel: they are looked up by an equality join, gathered per row as (token,
    lemma) pairs and applied in place.
    """
    df = cut_lineage(df)
    tokens = df.select(F.explode(tokens_col).alias("token")).distinct()
    lemmas = cut_lineage(lemma_table(tokens, lexicon, exceptions))
    used = df.select(id_col, F.explode(F.array_distinct(tokens_col)).alias("token"))
    changed = (
        attach(used, lemmas, "token", "inner")
        .groupBy(id_col)
        .agg(F.map_from_entries(F.collect_list(F.struct("token", "lemma"))).alias("_lemmas"))
    )
    mapped = F.transform(
        tokens_col, lambda t: F.coalesce(F.try_element_at(F.col("_lemmas"), t), t)
    )
    kept = F.when(F.col("_lemmas").isNull(), F.col(tokens_col)).otherwise(mapped)
    return df.join(changed, id_col, "left").select(
        *df.columns, F.coalesce(kept, F.array().cast("array<string>")).alias(out)
    )
