"""Structured Streaming versions of scoring, dedup and request answering.

The stream functions reuse the batch functions unchanged (record rules,
feature columns, the fitted preprocessing + model), so a micro-batch is
scored exactly as the same rows would be in batch. Sinks go through
``foreachBatch`` with a checkpoint under the shared checkpoint folder; each
batch overwrites its own ``batch_id=`` folder, so a batch that is replayed
after a failure replaces its rows instead of adding them again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.functions import features as ft
from veritab.operators import quality
from veritab.session import ensure_checkpoint_dir


def _work_dir(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/veritab/{spark.sparkContext.applicationId}/stream-{name}-{uuid.uuid4().hex[:10]}"


def read_parquet_stream(spark: SparkSession, path: str, schema, max_files: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def score_transactions(stream: DataFrame, fitted, threshold: float | None = None) -> DataFrame:
    """T1 transform: record rules (Q9) -> features (P7-P12) -> probability -> thresholded label.

    Invalid rows keep their ``failed_rules`` and get no score; valid rows carry
    ``probability``, ``fraud`` (probability >= threshold), ``threshold`` and ``model_version``.
    """
    thr = fitted.threshold if threshold is None else threshold
    checked = quality.validate_records(stream)
    feats = ft.fraud_features(checked, drop_cols=("transaction_time",))
    scored = fitted.score(feats.where("is_valid"), ["transaction_id", "user_id"])
    return scored.withColumn("fraud", F.col("probability") >= F.lit(thr)) \
        .withColumn("threshold", F.lit(float(thr))).withColumn("model_version", F.lit(fitted.version))


def run_scoring(stream: DataFrame, fitted, out_dir: str | None = None, threshold: float | None = None):
    """Run to completion (availableNow) writing ``valid`` and ``quarantine`` parquet outputs."""
    spark = stream.sparkSession
    out_dir = out_dir or _work_dir(spark, "scoring")
    thr = fitted.threshold if threshold is None else threshold

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            checked = quality.validate_records(kept)
            checked.where(~F.col("is_valid")).write.mode("overwrite").parquet(f"{out_dir}/quarantine/batch_id={batch_id}")
            score_transactions(kept, fitted, thr).write.mode("overwrite").parquet(f"{out_dir}/valid/batch_id={batch_id}")
        finally:
            kept.unpersist()

    q = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", f"{out_dir}/_checkpoint") \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    return out_dir


#: keyed state on local disk, its changes uploaded with every batch
KEYED_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def unique_rows(stream: DataFrame, id_col: str, time_col: str | None = None, within: str | None = None) -> DataFrame:
    """The first arrival of each id; with ``time_col`` and ``within`` ids are forgotten that long after their time."""
    if within:
        return stream.withWatermark(time_col, within).dropDuplicatesWithinWatermark([id_col])
    return stream.dropDuplicates([id_col])


def run_dedup(stream: DataFrame, id_col: str = "transaction_id", out_dir: str | None = None, time_col: str | None = None,
              within: str | None = None, progress: list | None = None) -> DataFrame:
    """Run to completion, keeping one row of each id whatever the order of the feed; a null id is an id.

    The ids seen are keyed state in RocksDB, so a micro-batch costs its own rows and looks its ids up, however long
    the stream has run; what was written is never read. Nothing is late unless ``within`` bounds the state. A
    replayed batch starts from the state before it and overwrites its own rows. ``progress`` gathers the batches'
    reports.
    """
    spark = stream.sparkSession
    out_dir = out_dir or _work_dir(spark, "dedup")
    schema = stream.schema

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/data/batch_id={batch_id}")

    before = {k: spark.conf.get(k, None) for k in KEYED_STATE}
    for k, v in KEYED_STATE.items():
        spark.conf.set(k, v)
    try:  # a query keeps the settings it was started with
        q = unique_rows(stream, id_col, time_col, within).writeStream.foreachBatch(write_batch) \
            .option("checkpointLocation", f"{out_dir}/_checkpoint").trigger(availableNow=True).start()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    q.awaitTermination()
    if progress is not None:
        progress.extend(q.recentProgress)
    return spark.read.schema(schema).parquet(f"{out_dir}/data/*")


def run_to_table(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream to completion (availableNow) into parquet and return the result as a batch DataFrame."""
    spark = stream.sparkSession
    out = _work_dir(spark, name)
    q = stream.writeStream.format("parquet").option("path", f"{out}/data") \
        .option("checkpointLocation", f"{out}/_checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/data")


def answer_requests(requests_stream: DataFrame, top_table: DataFrame, popular: DataFrame, max_top_n: int = 50) -> DataFrame:
    """Stream-static join of validated requests with precomputed lists.

    ``top_table`` holds (user, rank, item, score) of the known users, ``popular``
    (rank, item, score) the list that users without one of their own get. Both
    are joined as one array per user or for all, at most ``max_top_n`` long.
    """
    entry = F.struct("rank", "item_id", "score")
    own = top_table.where(F.col("rank") <= max_top_n).groupBy("user_id").agg(F.array_sort(F.collect_list(entry)).alias("_own"))
    everyone = popular.where(F.col("rank") <= max_top_n).agg(F.array_sort(F.collect_list(entry)).alias("_all"))
    req = quality.validate_requests(requests_stream, max_top_n).where("is_valid")
    lists = req.join(own, "user_id", "left").withColumn("_list", F.coalesce("_own", everyone.scalar()))
    return lists.select("user_id", F.explode(F.slice("_list", F.lit(1), F.col("effective_top_n"))).alias("e")) \
        .select("user_id", "e.rank", "e.item_id", "e.score")
