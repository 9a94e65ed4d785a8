"""IO1-IO4: CSV read with null tokens, table write/read round trip, metrics JSON, model save/load."""

import os
import tempfile

from pyspark.sql import functions as F

from veritab.sources import tables


def test_csv_null_tokens_and_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="veritab-io-")
    path = os.path.join(d, "t.csv")
    with open(path, "w") as fh:
        fh.write("id,name,amount\n1,a,1.5\n2,NA,\n3,n/a,2.0\n")
    df = tables.read_table(spark, path, schema="id int, name string, amount double")
    rows = {r["id"]: (r["name"], r["amount"]) for r in df.collect()}
    assert rows == {1: ("a", 1.5), 2: (None, None), 3: (None, 2.0)}
    out = os.path.join(d, "out")
    tables.write_table(df, out, partition_by=["id"])
    assert tables.read_table(spark, out).count() == 3


def test_metrics_and_model_roundtrip(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    d = tempfile.mkdtemp(prefix="veritab-io-")
    tables.write_metrics(spark, {"precision": 0.5, "threshold": 0.9877, "model": "lr"}, os.path.join(d, "m"))
    back = tables.read_metrics(spark, os.path.join(d, "m"))
    assert back["precision"] == 0.5 and back["model"] == "lr"
    df = spark.range(5).withColumn("x", F.col("id") * 2.0)
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="v")]).fit(df)
    tables.save_model(model, os.path.join(d, "model"))
    loaded = tables.load_pipeline_model(os.path.join(d, "model"))
    assert loaded.transform(df).count() == 5


def test_broken_lines_are_set_aside(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,name,amount\n1, a ,1.5\n2,NA,\nx,b,1.0\n3,c\n4,d,2.0,more\n5,e,6\n")
    rows, broken = tables.read_csv(spark, f"file://{tmp_path}/t.csv", "id int, name string, amount double")
    assert {tuple(r) for r in rows.collect()} == {(1, "a", 1.5), (2, None, None), (5, "e", 6.0)}
    assert {r["line"] for r in broken.collect()} == {"x,b,1.0", "3,c", "4,d,2.0,more"}
    assert rows.count() == 3 and broken.count() == 3


def test_column_errors_name_what_is_missing(spark):
    import pytest

    from veritab.functions.features import normalise_target
    from veritab.operators import quality

    df = spark.createDataFrame([("a", " maybe")], "x string, target string")
    with pytest.raises(ValueError, match=r"Missing required columns: \['b', 'z'\]"):
        quality.require_columns(df, ["z", "x", "b"])
    quality.require_columns(df, ["x"])
    with pytest.raises(ValueError, match=r"At least one of \['y', 'z'\] columns is required"):
        quality.require_any(df, ["z", "y"])
    quality.require_any(df, ["z", "x"])
    assert df.select(normalise_target("target")).first()[0] is None
    with pytest.raises(Exception, match="Target of no class:  maybe"):
        df.select(normalise_target("target", strict=True)).collect()
    assert [tuple(r) for r in quality.unmapped_targets(df, "target").collect()] == [(" maybe", 1)]
