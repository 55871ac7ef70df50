"""Token arrays, the rules for empty remarks, term tables and labelled texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import NGram, StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stayscope.functions.text import contains_sequence, space_tokens, starts_with_tokens, word_tokens


def tokenize(df: DataFrame, col: str, out: str, mode: str = "word") -> DataFrame:
    """Add lower-case tokens: runs of word characters, or with ``mode="space"`` cut at blanks."""
    cutters = {"word": word_tokens, "space": space_tokens}
    return df.withColumn(out, cutters[mode](col))


def remove_stop_words(
    df: DataFrame, col: str, out: str, words: Sequence[str] | None = None
) -> DataFrame:
    """Add the tokens that are no stop words, whatever their case; English ones by default."""
    remover = StopWordsRemover(inputCol=col, outputCol=out)
    return (remover.setStopWords(list(words)) if words is not None else remover).transform(df)


def ngrams(df: DataFrame, col: str, out: str, n: int = 2) -> DataFrame:
    """Add runs of `n` neighbouring tokens, joined by a blank."""
    return NGram(n=n, inputCol=col, outputCol=out).transform(df)


def short_not_at_all(tokens: str) -> Column:
    """A remark of three or four tokens that starts with "not at all"."""
    return starts_with_tokens(tokens, ["not", "at", "all"], [3, 4])


def short_nothing(tokens: str) -> Column:
    """A remark of one or two tokens, one of which is "nothing"."""
    hit = F.array_contains(tokens, "nothing") & F.size(tokens).isin(1, 2)
    return F.coalesce(hit, F.lit(False))


def says_no(tokens: str, what: str) -> Column:
    """A remark in which "no" is followed by `what`."""
    return contains_sequence(tokens, ["no", what])


def term_weights(df: DataFrame, tokens_col: str, k: int = 200) -> DataFrame:
    """The `k` most frequent terms with their count and its share of the largest count."""
    terms = df.select(F.explode(tokens_col).alias("term")).groupBy("term")
    top = terms.agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "term").limit(k)
    # The window runs over the k rows that are left.
    largest = F.max("n").over(Window.partitionBy())
    return top.withColumn("weight", F.col("n") / largest)


def idf_table(df: DataFrame, tokens_col: str) -> DataFrame:
    """Per term: documents that hold it and ``ln((N + 1) / (df + 1))``; a row is a document.

    A term counts once per document inside its row, so counting needs no distinct shuffle.
    """
    documents = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    held = df.select(F.explode(F.array_distinct(tokens_col)).alias("term"))
    counts = held.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return counts.withColumn("idf", F.log((documents + 1.0) / (F.col("df") + 1.0)))


def labelled_texts(
    df: DataFrame,
    pos_col: str,
    neg_col: str,
    placeholders: Sequence[str] = ("no positive", "no negative"),
) -> DataFrame:
    """All positive texts with label 1 and all negative ones with 0, placeholders left out.

    Both come out of one scan. The placeholders are for the positive and the negative column.
    """
    pairs = [
        F.struct(F.col(c).alias("text"), F.lit(label).alias("label"), F.lit(skip).alias("skip"))
        for c, label, skip in ((pos_col, 1, placeholders[0]), (neg_col, 0, placeholders[1]))
    ]
    rows = df.select(F.inline(F.array(*pairs)))
    return rows.where(F.lower("text") != F.col("skip")).select("text", "label")
