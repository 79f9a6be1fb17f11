"""Corpus preparation in five stages, each written as a table before the next one reads it.

Language ID drops what has no recognisable language, line de-duplication cuts later copies
of three-line passages out of the texts, near-duplicate removal keeps one document of each
group, mixing repeats or leaves out documents by their fitted rates, and encoding turns the
rest into token ids. Nulls, empty texts, repeated rows, empty tables and extra columns are
treated as each operator's module says; extra columns stay until the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.llm import langid, linededup, mixing, neardup, simhash
from citylake.llm.bpe import encode_documents
from citylake.llm.common import discard, finished, table

#: Trained models and fitted rates have no SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; texts without a letter go.

    There is no bound on the score: a text of random letters scores like a short clean one."""
    model = langid.train(docs, "doc_id", "text", "lang")
    found = langid.identify(docs, model)
    return found.filter(F.col("lang_pred") != langid.UNKNOWN).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of three-line windows; n_chars follows the text."""
    cut = linededup.remove_repeated_lines(docs)
    changed = F.when(F.col("lines_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", changed).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: SimHash of 5-word shingles by covering masks, minima
    for the links beyond its radius, similarity at least 0.8."""
    return simhash.keep_one(docs, find=neardup.near_duplicates)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that the expected tokens of the domains meet the targets."""
    rates = mixing.mix(docs, mixing.quality_domains(table(spark, sf_dir, "labels")))
    return mixing.repeat_by_rate(docs, rates)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and the digests of ids and decoded text."""
    return encode_documents(docs)


STAGES = [
    ("language id", language),
    ("line dedup", lines),
    ("near-dedup", near_duplicates),
    ("mixing", mix),
    ("bpe encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage's result replaces that of the one before, whose files
    and whatever the stage itself had staged are then removed."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, finished(lambda s=stage, d=docs: s(spark, d, sf_dir), f"pipeline-{name.replace(' ', '-')}")
        if hasattr(before, "staged_path"):
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
