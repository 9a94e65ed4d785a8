"""Registered queries of the subpackage and their DuckDB twins; each applies an operator to its whole table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.llm import bpe, collocations, infill, jaccard, langid, licences, mixing, resampling, rules, sharding, surrogates, topk, toxicity
from veritab.llm.oracles import SQL  # noqa: F401

SHARDS = 40


def vocabulary_path() -> str:
    """Place of the byte-level vocabulary used by the registered queries; the operators take any path's text."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; Python workers are told where this package lies, for a driver started elsewhere.

    On a cluster the package is shipped with ``--py-files`` as usual.
    """
    import veritab

    home = os.path.dirname(os.path.dirname(os.path.abspath(veritab.__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if home not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [home, known]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def bpe_digests(docs: DataFrame, keep: tuple = ("doc_id",)) -> DataFrame:
    """``keep``, ``ids`` and the digest columns of a round trip."""
    trip = bpe.round_trip(docs, bpe.read_vocabulary(vocabulary_path()), list(keep))
    return trip.select(*keep, "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(documents(spark, sf_dir)).drop("ids")


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace_entities(documents(spark, sf_dir)).select("doc_id", "text", "pii_count", "pii_kinds")


def op3_licence_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan_licences(documents(spark, sf_dir))
    return found.select("doc_id", "digest", "licence_id", F.col("licence_id").isNotNull().alias("is_licence"))


def op4_topk_inner_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op5_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = sharding.interleaved_shards(documents(spark, sf_dir), SHARDS)
    return cut.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_verdicts(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_components(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op8_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return resampling.resample(documents(spark, sf_dir), labels)


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = langid.predict(docs, langid.fit(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = infill.restore(infill.transform(documents(spark, sf_dir)))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.collocations(documents(spark, sf_dir))
    return found.withColumn("rank", F.col("rank").cast("long"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
