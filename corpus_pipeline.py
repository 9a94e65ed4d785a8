"""A training-data pipeline: documents are judged, freed of near copies and personal data, mixed and encoded.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns a DataFrame; the table is
written as parquet and read back as the next stage's ``docs``. All but the last return the columns of documents.
Columns beyond those of documents are ignored; an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.llm import jaccard, mixing, queries, rules, surrogates
from veritab.llm.staging import staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text that a stage has changed."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule, or whose host does, go."""
    return rules.apply_rules(docs.select(*COLUMNS))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar ones stays."""
    return jaccard.keep_one(docs.select(*COLUMNS))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by surrogates."""
    return _measured(surrogates.replace_entities(docs.select(*COLUMNS)))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come in the proportion of their weights: a row for each time a document is taken."""
    return _measured(mixing.apply_mix(docs.select(*COLUMNS)))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text (packed, four bytes each), their number, and digests of ids and decoded text."""
    return queries.bpe_digests(docs, ("doc_id", "lang", "source"))


STAGES = [("quality rules", quality_rules), ("near copies", near_copies), ("personal data", personal_data),
          ("source mix", source_mix), ("token ids", token_ids)]

#: SQL cannot express the encoding; tests/llm holds the pipeline against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
