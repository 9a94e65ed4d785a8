"""Quality selection by importance resampling with hashed n-gram models.

The hashed unigrams and bigrams of a text are counted into buckets. One bag-of-buckets model is estimated from the
texts labelled as good, one from all texts; a text's log importance weight is the sum over its n-grams of the log
ratio of the two. Adding Gumbel noise to the log weights and keeping the k largest draws k texts without replacement
in proportion to their weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.running import running
from veritab.llm.staging import staged, unit_interval
from veritab.llm.textvec import PUNCTUATED, mix, text_chunks, word_hashes

BUCKETS = 16_384
SMOOTHING = 1.0
#: quantiles that place the noisy weights for the distributed ranking
PLACES = 512


def _buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all unigrams and bigrams, and the text each belongs to."""
    words, counts = word_hashes(data, offsets, PUNCTUATED)
    text = np.repeat(np.arange(len(counts)), counts)
    inside = text[1:] == text[:-1]
    pairs = mix(words[:-1] * np.uint64(0x9FB21C651E98DF25) + words[1:])[inside]
    hashes = np.concatenate([words, pairs])
    return (hashes % np.uint64(BUCKETS)).astype(np.int64), np.concatenate([text, text[1:][inside]])


def log_ratios(texts: DataFrame) -> np.ndarray:
    """log p_target - log p_raw for each bucket, from rows (text, is_target).

    Every task adds up its own buckets; only sums of ``BUCKETS`` numbers leave it.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            target = batch.column(1).to_numpy(zero_copy_only=False)
            for first, last, data, offsets in text_chunks(batch.column(0)):
                buckets, text = _buckets(data, offsets)
                sums[0] += np.bincount(buckets, minlength=BUCKETS)
                sums[1] += np.bincount(buckets[target[first:last][text]], minlength=BUCKETS)
        at = np.flatnonzero(sums[0])
        yield pa.record_batch([pa.array(at), pa.array(sums[0][at]), pa.array(sums[1][at])], ["bucket", "raw", "target"])

    counted = texts.select("text", "is_target").mapInArrow(count, "bucket long, raw long, target long")
    rows = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    raw, target = np.full(BUCKETS, SMOOTHING), np.full(BUCKETS, SMOOTHING)
    for r in rows:
        raw[r["bucket"]] += r["raw"]
        target[r["bucket"]] += r["target"]
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weigh(docs: DataFrame, ratios: np.ndarray, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns, ``n_features`` and ``log_weight`` of each whole text."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import DoubleType, LongType, StructField, StructType

    slim = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).cast("string").alias("_text"))
    out_schema = StructType([*slim.schema.fields[:-1], StructField("n_features", LongType()),
                             StructField("log_weight", DoubleType())])
    arrow, n_kept = to_arrow_schema(out_schema), len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights, features = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for first, last, data, offsets in text_chunks(batch.column(n_kept)):
                buckets, text = _buckets(data, offsets)
                weights[first:last] = np.bincount(text, ratios[buckets], last - first)
                features[first:last] = np.bincount(text, minlength=last - first)
            columns = [batch.column(i) for i in range(n_kept)] + [pa.array(features), pa.array(weights)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return slim.mapInArrow(run, out_schema)


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: str = "resample-1",
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_features``, ``log_weight``, ``draw`` (weight plus Gumbel noise), ``rank``, ``kept``.

    ``labels`` has (doc_id, quality); a document is of the target when its highest label is 1. ``share`` is the part
    of all rows to keep, by default the part of the labelled documents that are good. A null or empty text has no
    features and weight 0; a null id has no label and draws by its text; equal rows draw equally and their order is
    free; without labels of 1 the smoothed target model is flat; an empty table gives no rows; other columns are
    ignored.
    """
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("string").alias("_id")).agg(
        (F.max("quality") == 1).alias("_good"))
    text = F.col(text_col).cast("string")
    # rows without an id are dealt by their text; they match no label
    own = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("~"), F.xxhash64(text).cast("string")))
    # always a shuffle join, whatever the number of labels: cost and disk then grow as the input does
    texts = docs.select(own.alias("_id"), text.alias("text")).join(marks.hint("merge"), "_id", "left").select(
        "text", F.coalesce("_good", F.lit(False)).alias("is_target"))
    if share is None:
        good = marks.agg(F.avg(F.col("_good").cast("double"))).first()[0]
        share = 1.0 if good is None else good
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("_body"), F.md5(text).alias("_digest"))
    scored = weigh(rows, log_ratios(texts), ["doc_id", "_digest"], "_body")
    uniform = unit_interval(F.lit(seed), F.col("doc_id"), F.col("_digest")) + F.lit(2.0 ** -53)
    scored = staged(scored.withColumn("draw", F.col("log_weight") - F.log(-F.log(uniform))), "resample-draws")
    places = scored.agg(F.percentile_approx("draw", [i / PLACES for i in range(PLACES + 1)], 100 * PLACES)).first()[0]
    if not places:
        return scored.select("doc_id", "n_features", "log_weight", "draw", F.lit(0).cast("long").alias("rank"),
                             F.lit(True).alias("kept"))
    bounds = sorted(set(places))
    cut = F.array(*[F.lit(b) for b in bounds])
    below = F.size(F.filter(cut, lambda b: b < F.col("draw")))
    low, high = F.get(cut, below - 1), F.get(cut, below)
    inside = F.coalesce((F.col("draw") - low) / (high - low), F.lit(0.0))
    position = F.greatest(F.lit(0.0), F.least(F.lit(1 - 2.0 ** -40), 1 - (below - 1 + inside + 1) / (len(bounds) + 1)))
    placed = scored.withColumns({"_at": position, "_all": F.lit("all")})
    ranked = running(placed, "_all", "_at", [F.desc("draw"), F.asc_nulls_first("doc_id"), "_digest"])
    kept = F.col("rank") < F.round(F.col("n_group") * share)
    return ranked.select("doc_id", "n_features", "log_weight", "draw", "rank", kept.alias("kept"))
