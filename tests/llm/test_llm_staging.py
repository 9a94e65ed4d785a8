"""What an operator leaves on disk while its application goes on."""

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from veritab.llm import jaccard
from veritab.llm.staging import shared_folder, staged, unstage
from veritab.session import ARROW_BATCH_BYTES

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _shuffle_files(spark) -> int:
    return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").count("/shuffle_")


def _folders(spark) -> set[str]:
    home = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}".removeprefix("file:")
    return set(os.listdir(home)) if os.path.isdir(home) else set()


def test_a_staged_table_leaves_no_shuffle_files(spark):
    before, setting = _shuffle_files(spark), spark.conf.get(CLEANUP, None)
    out = staged(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert _shuffle_files(spark) <= before and spark.conf.get(CLEANUP, None) == setting
    assert {tuple(r) for r in out.collect()} == {(k, len(range(k, 1000, 7))) for k in range(7)}
    folders = _folders(spark)
    unstage(out)
    assert len(folders - _folders(spark)) == 1


def test_near_copies_leave_only_what_is_read_later(spark):
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words + ["x"])), (3, "a b c d e f"), (4, None)], "doc_id long, text string")
    before = _folders(spark)
    found = jaccard.similarity_components(docs)
    kinds = {f.rsplit("-", 1)[0] for f in _folders(spark) - before}
    assert kinds.isdisjoint({"jaccard-members", "jaccard-runs", "jaccard-told", "jaccard-many", "jaccard-pairs", "jaccard-fragments"})
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {1: 1, 2: 1, 3: 3, 4: 4}


def test_python_workers_get_batches_bounded_by_bytes(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.unset(name)

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "bytes"])

    try:
        docs = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("word "), 2000).alias("text"))
        found = staged(docs.mapInArrow(sizes, "n long, bytes long"), "batches").collect()
        assert sum(r["n"] for r in found) == 4000 and max(r["bytes"] for r in found) < 2 * ARROW_BATCH_BYTES
        spark.conf.set(name, "1m")  # what the session sets stays
        staged(spark.range(3), "numbers")
        assert spark.conf.get(name) == "1m"
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_parities_of_many_short_texts_take_little_memory():
    import tracemalloc

    sets = [np.array([i << 53, (i + 1) << 53, (i + 1) << 53 | 7], np.uint64) for i in range(2000)]
    tracemalloc.start()
    bits = np.unpackbits(jaccard.parities(sets).view(np.uint8), axis=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8_000_000  # all counts at once were 2,000 x 2,048 x 8 bytes, twice
    assert bits.shape == (2000, 2048) and [np.flatnonzero(b).tolist() for b in bits] == [[i] for i in range(2000)]
