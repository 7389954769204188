"""All-terms text search ranked by term frequency."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiersmith.functions.text import query_terms, tokens


def search_text(df: DataFrame, cols: list[str]) -> Column:
    return F.concat_ws(" ", *[F.col(c) for c in cols if c in df.columns])


def search(df: DataFrame, query: str, cols: list[str]) -> DataFrame:
    """Rows that hold every term of the query, with their ``score``; an empty query matches nothing.

    A plain substring test runs first: only texts that contain every term anywhere are cut into
    words. The score is the share of words that are query terms. Sorting is left to the caller, so a
    top-k report does not need a total sort.
    """
    terms = query_terms(query)
    if not terms:
        return df.limit(0).selectExpr("*", "0 AS hits", "0 AS words", "0D AS score")
    lowered = F.lower(search_text(df, cols))
    # A stem stands at the beginning of its words, but for a y that was put in place of an ending.
    possible = reduce(lambda a, b: a & b, [lowered.contains(t.removesuffix("y")) for t in terms])
    wanted = F.array(*[F.lit(t) for t in terms])
    words = F.col("_words")
    return (
        df.filter(possible)
        .withColumn("_words", tokens(search_text(df, cols)))
        .filter(F.size(F.array_except(wanted, words)) == 0)
        .withColumns(
            {
                "hits": F.size(F.filter(words, lambda w: w.isin(terms))),
                "words": F.size(words),
            }
        )
        .withColumn("score", F.col("hits") / F.col("words"))
        .drop("_words")
    )


def inverted_index(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """(term, key, frequency, words of the text) for a corpus that is searched often, to be clustered by term."""
    cut = df.select(key, tokens(search_text(df, cols)).alias("_words"))
    return (
        cut.select(key, F.size("_words").alias("words"), F.explode("_words").alias("term"))
        .groupBy("term", key)
        .agg(F.count("*").alias("frequency"), F.max("words").alias("words"))
    )


def search_index(index: DataFrame, key: str, query: str) -> DataFrame:
    """Same matches and scores from an inverted index: only the postings of the query terms are read."""
    terms = query_terms(query)
    return (
        index.filter(F.col("term").isin(terms))
        .groupBy(key)
        .agg(F.sum("frequency").cast("int").alias("hits"), F.max("words").alias("words"), F.count("*").alias("_found"))
        .filter(F.col("_found") == len(terms))
        .select(key, "hits", "words", (F.col("hits") / F.col("words")).alias("score"))
    )
