"""Tokens, terms and lemmas of whole documents."""

from __future__ import annotations

from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalogue.base import RAW, Entries, raw_reviews, sql_no_stop_words, sql_tokens, table
from stayscope.functions import contains_sequence, normalise_text, word_count
from stayscope.operators import tokens as K
from stayscope.operators.lemma import lemmatize
from stayscope.sources import spread_rows

entries = Entries()


def _documents(spark, sf_dir):
    return spread_rows(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _tokens(spark, sf_dir):
    return K.tokenize(_documents(spark, sf_dir), "text", "tokens")


_CUT = f"cut AS (SELECT doc_id, {sql_tokens('text')} AS tokens FROM documents)"


@entries.add(f"WITH {_CUT} SELECT doc_id, len(tokens) AS n, array_to_string(tokens, ' ') AS tokens FROM cut")
def document_tokens(spark, sf_dir):
    """Word tokens of every document."""
    return _tokens(spark, sf_dir).select(
        "doc_id", F.size("tokens").cast("long").alias("n"), F.array_join("tokens", " ").alias("tokens")
    )


@entries.add(
    r"""SELECT doc_id, array_to_string(string_split_regex(regexp_replace(lower(text), '\s+$', ''), '\s'), '|') AS tokens
        FROM documents"""
)
def blank_separated_tokens(spark, sf_dir):
    """Tokens of every document cut at single blanks."""
    df = K.tokenize(_documents(spark, sf_dir), "text", "t", mode="space")
    return df.select("doc_id", F.array_join("t", "|").alias("tokens"))


@entries.add(
    f"WITH {_CUT} SELECT doc_id, array_to_string({sql_no_stop_words('tokens')}, ' ') AS kept FROM cut"
)
def content_words(spark, sf_dir):
    """Tokens without English stop words."""
    df = K.remove_stop_words(_tokens(spark, sf_dir), "tokens", "kept")
    return df.select("doc_id", F.array_join("kept", " ").alias("kept"))


@entries.add(
    f"""WITH {_CUT}, p AS (SELECT unnest(list_zip(tokens[1:len(tokens) - 1], tokens[2:])) AS b FROM cut WHERE len(tokens) > 1)
    SELECT b[1] || ' ' || b[2] AS bigram, count(*) AS n FROM p GROUP BY 1"""
)
def bigram_counts(spark, sf_dir):
    """How often each pair of neighbouring tokens occurs."""
    pairs = K.ngrams(_tokens(spark, sf_dir), "tokens", "bigrams", 2)
    return pairs.select(F.explode("bigrams").alias("bigram")).groupBy("bigram").agg(F.count(F.lit(1)).alias("n"))


@entries.add(
    f"""WITH {_CUT}, t AS (SELECT unnest(tokens) AS term FROM cut),
    c AS (SELECT term, count(*) AS n FROM t GROUP BY 1 ORDER BY n DESC, term LIMIT 200)
    SELECT term, n, round(n / (SELECT max(n) FROM c), 6) AS weight FROM c"""
)
def top_terms(spark, sf_dir):
    """The 200 most frequent terms, weighted by the largest count."""
    return K.term_weights(_tokens(spark, sf_dir), "tokens", 200).withColumn("weight", F.round("weight", 6))


@entries.add(
    f"""WITH {_CUT}, t AS (SELECT unnest(list_distinct(tokens)) AS term FROM cut)
    SELECT term, count(*) AS df, round(ln(((SELECT count(*) FROM documents) + 1.0::DOUBLE) / (count(*) + 1.0::DOUBLE)), 6) AS idf
    FROM t GROUP BY term"""
)
def inverse_frequencies(spark, sf_dir):
    """Documents per term and its inverse document frequency."""
    return K.idf_table(_tokens(spark, sf_dir), "tokens").withColumn("idf", F.round("idf", 6))


_RULES = [("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"),
          ("men", "man"), ("ies", "y")]
_FORMS = " UNION ALL ".join(
    ["SELECT token, token AS form, 0 AS pos FROM vocab"]
    + [
        f"SELECT token, left(token, length(token) - {len(old)}) || '{new}', {i} FROM vocab WHERE suffix(token, '{old}')"
        for i, (old, new) in enumerate(_RULES, 1)
    ]
)


@entries.add(
    f"""WITH {_CUT}, e AS (SELECT doc_id, generate_subscripts(tokens, 1) AS i, unnest(tokens) AS token FROM cut),
    vocab AS (SELECT DISTINCT token FROM e), forms AS ({_FORMS}),
    lemmas AS (SELECT token, arg_min(form, length(form) * 100 + pos) AS lemma FROM forms
      WHERE form IN (SELECT token FROM vocab) GROUP BY token)
    SELECT d.doc_id, coalesce(string_agg(lemma, ' ' ORDER BY i), '') AS lemmas
    FROM documents d LEFT JOIN (SELECT doc_id, i, lemma FROM e JOIN lemmas USING (token)) USING (doc_id) GROUP BY d.doc_id"""
)
def document_lemmas(spark, sf_dir):
    """Noun lemmas of every document, with the corpus as the lexicon."""
    df = lemmatize(_tokens(spark, sf_dir), "doc_id", "tokens", "lemmas")
    return df.select("doc_id", F.array_join("lemmas", " ").alias("lemmas"))


@entries.add(
    r"""SELECT doc_id, CAST(len(string_split_regex(trim(text), '\s+')) AS INTEGER) AS words,
        regexp_replace(replace(lower(text), ',', ' '), '[^a-zA-Z0-9\s]', '', 'g') AS plain FROM documents"""
)
def plain_documents(spark, sf_dir):
    """Word count and normalised text of every document."""
    return _documents(spark, sf_dir).select(
        "doc_id", word_count("text").alias("words"), normalise_text("text").alias("plain")
    )


@entries.add(f"WITH {_CUT} SELECT doc_id FROM cut WHERE contains(' ' || array_to_string(tokens, ' ') || ' ', ' the of ')")
def documents_with_phrase(spark, sf_dir):
    """Documents in which two tokens stand next to each other."""
    return _tokens(spark, sf_dir).where(contains_sequence("tokens", ["the", "of"])).select("doc_id")


@entries.add(
    f"""WITH {RAW} SELECT Positive_Review AS text, 1 AS label FROM raw WHERE lower(Positive_Review) <> 'no positive'
    UNION ALL SELECT Negative_Review, 0 FROM raw WHERE lower(Negative_Review) <> 'no negative'"""
)
def labelled_remarks(spark, sf_dir):
    """Positive and negative remarks as labelled texts, placeholders left out."""
    return K.labelled_texts(raw_reviews(spark, sf_dir), "Positive_Review", "Negative_Review")


@entries.add()
def hashed_weights(spark, sf_dir):
    """Hashed term frequencies weighted by inverse document frequency, as (document, slots, total)."""
    df = K.remove_stop_words(_tokens(spark, sf_dir), "tokens", "kept")
    df = HashingTF(inputCol="kept", outputCol="tf", numFeatures=10_000).transform(df)
    df = IDF(inputCol="tf", outputCol="weights").fit(df).transform(df).select("doc_id", vector_to_array("weights").alias("w"))
    total = F.aggregate("w", F.lit(0.0), lambda a, x: a + x)
    return df.select("doc_id", F.size(F.filter("w", lambda x: x != 0)).alias("slots"), F.round(total, 4).alias("total"))
