"""Text scoring for news items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylake.dims import NEGATIVE_WORDS, POSITIVE_WORDS, TRAFFIC_WORDS, sql_literal
from citylake.functions.numeric import np_round


def strip_tags(text: Column) -> Column:
    bare = F.regexp_replace(text, "<[^>]+>", "")
    return F.regexp_replace(bare, r"^\s+|\s+$", "")


def word_hits(text: str, words: list[str]) -> Column:
    """How many of the listed words occur anywhere in a text column, inside words too."""
    found = [f"CAST(contains(lower(`{text}`), {sql_literal(w)}) AS INT)" for w in words]
    return F.expr(" + ".join(found))


def relevance(text: str) -> Column:
    """Three different traffic words make a fully relevant text.

    The coalesce declares the score non-null: a later `score IS NOT NULL` filter
    then folds away instead of scoring every text a second time.
    """
    score = np_round(F.least(word_hits(text, TRAFFIC_WORDS) / F.lit(3.0), F.lit(1.0)), 2)
    return F.coalesce(score, F.lit(0.0))


def sentiment(text: str) -> Column:
    negative, positive = word_hits(text, NEGATIVE_WORDS), word_hits(text, POSITIVE_WORDS)
    return F.when(negative > positive, "negativo").when(positive > negative, "positivo").otherwise("neutro")


def add_scores(df: DataFrame, text: str) -> DataFrame:
    """Relevance, sentiment and the traffic flag; the texts are scored once."""
    scored = df.withColumns({"relevance_score": relevance(text), "sentiment": sentiment(text)})
    return scored.withColumn("es_trafico", F.col("relevance_score") > 0)


def item_id(link: Column, title: Column) -> Column:
    known = F.coalesce(link, F.lit("")) != ""
    return F.substring(F.md5(F.when(known, link).otherwise(title).cast("binary")), 1, 12)
