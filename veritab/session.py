"""Session construction and lineage cutting.

The defaults here are the ones a cluster job wants: adaptive execution with
skew-join splitting and partition coalescing, UTC session time, no web UI.
Settings of a running session (for example a cluster's ``spark.checkpoint.dir``
or its broadcast limit) win; they are only filled in where they are unset.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # statistics-checked broadcast only: Catalyst broadcasts a join side when
    # its estimated size is below this bound, never unconditionally
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_spark(app: str = "veritab", master: str | None = None, shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    active = SparkSession.getActiveSession()
    for k, v in _DEFAULTS.items():
        if active is None or active.conf.get(k, None) is None:
            builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a session without one uses its warehouse folder, never a temporary one."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged")
    return sc.getCheckpointDir()


def tell_workers(spark: SparkSession) -> None:
    """Let Python workers find this package where it lies, for a driver that was started elsewhere.

    On a cluster the package is shipped with ``--py-files`` as usual.
    """
    import os

    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if home not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [home, known]))


def own_partitions(spark: SparkSession, n: int) -> list[int]:
    """``n`` numbers, each of which a repartition by it to ``n`` partitions puts into one of its own."""
    number = F.col("id").cast("int")
    found = spark.range(64 * n + 64).groupBy(F.pmod(F.hash(number), F.lit(n))).agg(F.min(number).alias("number")).collect()
    return [r["number"] for r in found] if len(found) == n else list(range(n))


#: bytes of rows that go to a Python worker at a time, about; a batch lies in the executor and in the worker at once
ARROW_BATCH_BYTES = 4 << 20


def bound_arrow_batches(spark: SparkSession) -> None:
    """Batches of rows for Python workers end by bytes, not only by their number of rows, where the session sets nothing."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(ARROW_BATCH_BYTES))


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside are deleted as soon as it is written, not when the driver next collects
    its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def materialize_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as parquet under the shared checkpoint folder; the table read back and its folder.

    Used at fit boundaries: downstream plans start from a compact scan instead
    of re-planning (and re-running) the whole lineage, and the files survive
    the loss of any executor. They are deleted when the application ends.
    """
    import uuid

    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/veritab/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    with shuffles_freed(spark):
        df.write.mode("overwrite").parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``materialize_at`` without the folder."""
    return materialize_at(df, name)[0]
