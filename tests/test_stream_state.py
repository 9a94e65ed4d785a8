"""Deduplication of a stream by keyed state: twenty batches, repeats across and inside them, a restart, forgotten ids."""

from pyspark.sql import functions as F

from veritab.streaming import scoring as st


def _feed(spark, folder, n_files=20, rows=60):
    """File f holds ids f*30 to f*30+59, each twice: half of them were in the file before."""
    schema = "id string, v long, at timestamp"
    for f in range(n_files):
        made = spark.range(2 * rows).select(F.concat(F.lit("k"), (F.col("id") % rows + 30 * f).cast("string")).alias("id"), F.lit(f).cast("long").alias("v"),
                                            F.timestamp_seconds(F.lit(1_700_000_000 + f * 3600)).alias("at"))
        made.coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_a_batch_costs_its_own_rows(spark, tmp_path):
    stream = _feed(spark, f"file://{tmp_path}/feed")
    progress = []
    out = st.run_dedup(stream, "id", out_dir=f"file://{tmp_path}/out", progress=progress)
    ids = [r["id"] for r in out.select("id").collect()]
    assert len(ids) == len(set(ids)) == 60 + 19 * 30
    batches = [p for p in progress if p["numInputRows"]]
    assert len(batches) == 20 and {p["numInputRows"] for p in batches} == {120}
    state = [p["stateOperators"][0] for p in batches]
    assert [s["numRowsUpdated"] for s in state] == [60] + [30] * 19
    assert state[-1]["numRowsTotal"] == len(ids) and "rocksdbPutCount" in str(state[-1])
    # another run from the same checkpoint has nothing new to add
    again = st.run_dedup(spark.readStream.schema(stream.schema).parquet(f"file://{tmp_path}/feed"), "id", out_dir=f"file://{tmp_path}/out")
    assert again.count() == len(ids)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "").endswith("HDFSBackedStateStoreProvider") or \
        "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass", "")


def test_ids_are_forgotten_after_a_bound(spark, tmp_path):
    stream = _feed(spark, f"file://{tmp_path}/feed", n_files=6)
    progress = []
    out = st.run_dedup(stream, "id", out_dir=f"file://{tmp_path}/out", time_col="at", within="2 hours", progress=progress)
    assert out.count() == 60 + 5 * 30
    totals = [p["stateOperators"][0]["numRowsTotal"] for p in progress]
    assert max(totals) < 60 + 5 * 30


def test_null_ids_are_one_id(spark, tmp_path):
    spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "id string, v int").write.parquet(f"file://{tmp_path}/feed")
    stream = spark.readStream.schema("id string, v int").parquet(f"file://{tmp_path}/feed")
    assert sorted(str(r["id"]) for r in st.run_dedup(stream, "id", out_dir=f"file://{tmp_path}/out").collect()) == ["None", "a"]
