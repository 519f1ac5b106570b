"""The corpus pipeline: language ID, quality, exact and near duplicates, packing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs. All but the last return the columns of documents. A stage's model is
fitted to what its predecessor kept (and to labels of sf_dir); its decision applies to every row of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umitally.llm import exact_dedup, jaccard, language, packing, quality
from umitally.llm.common import table, unused, write_table
from umitally.llm.queries import vocabulary

#: Rows go if their language is unknown or less likely than this, and if their quality score is below that.
LEAST_LANGUAGE, LEAST_QUALITY = 0.4, 0.3


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is in a language that the classifier knows; text without letters goes.

    With no labelled row to learn from nothing is known, and rows with letters stay.
    """
    net = language.fit(docs)
    if net is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    lang, score = unused(docs, "_lang", "_score")
    scored = language.identify(docs, net, names=(lang, score))
    return scored.where((F.col(lang) != language.UNKNOWN) & (F.col(score) >= LEAST_LANGUAGE)).drop(lang, score)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose quality score is not low; the threshold is under that of a prediction, as clean rows must stay."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    (score,) = unused(docs, "_quality")
    return quality.score(docs, model, name=score).where(F.col(score) >= LEAST_QUALITY).drop(score)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return exact_dedup.dedup_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that similarity links connect: that with the smallest doc_id, null ids last; rows that link with
    none stay, also where they repeat the id of a row that goes."""
    return jaccard.dedup_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens."""
    return packing.pack_words(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("language ID", keep_known_languages),
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("packing", pack_sequences),
]

#: Trained classifiers and a tokenizer are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what each stage returns is written to the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = write_table(docs)
    return docs
