"""Proportional stratified interleaving: every shard gets the mixture of the whole table.

Rows of each source are shuffled by a keyed hash and ranked; a row of rank r in a source of n rows stands at the
fraction (r + 1/2) / n of its source. All rows sorted by that fraction form one sequence in which each stretch holds
the sources in proportion, and the sequence is cut into shards whose row counts differ by at most one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.llm.running import running
from veritab.llm.staging import staged, unit_interval


def source_key(source: Column) -> Column:
    """A non-null group key; a null source is a source of its own."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source.cast("string")))


def interleaved_shards(docs: DataFrame, shards: int, seed: str = "shards-1", id_col: str = "doc_id",
                       text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: its id, ``size``, ``text_crc32``, ``source_key``, ``fraction``, ``shard`` and ``slot``.

    A null text has no bytes (size 16, crc32 0); null ids and sources are values like any other; equal rows keep
    one place each; empty input gives no rows; other columns are ignored, whatever their names.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), source_key(F.col(source_col)).alias("source_key"),
                       (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = staged(rows.withColumn("_at", unit_interval(F.lit(seed), F.col("doc_id"), F.col("text_crc32"),
                                                       F.col("size"))), "shard-rows")
    ties = [F.asc_nulls_first("doc_id"), "text_crc32", "size"]
    ranked = running(rows, "source_key", "_at", ties)
    ranked = ranked.select("doc_id", "source_key", "size", "text_crc32", F.col("rank").alias("_place"),
                           ((F.col("rank") + 0.5) / F.col("n_group")).alias("fraction"), F.lit("all").alias("_all"))
    whole = running(staged(ranked, "shard-fractions"), "_all", "fraction", ["source_key", "_place"])
    shard = F.floor(F.col("rank") * shards / F.col("n_group"))
    return whole.select("doc_id", "source_key", "size", "text_crc32", "fraction", shard.cast("int").alias("shard"),
                        (F.col("rank") - F.ceil(shard * F.col("n_group") / shards)).cast("long").alias("slot"))
