"""Registered queries: tables written and read again (IO1, IO2); files lie in the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from veritab.plans.oracle_sql import r6
from veritab.plans.registry import register, rounded
from veritab.session import ensure_checkpoint_dir, materialize
from veritab.sources import fixtures as fx
from veritab.sources import tables


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/veritab/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


#: every seventh line has a text for a number, every eleventh too many fields, every thirteenth too few
SQL_LINES = """
SELECT c_custkey, c_mktsegment, c_nationkey,
       CASE WHEN c_custkey % 7 = 0 THEN c_custkey || ',' || c_mktsegment || ',many'
            WHEN c_custkey % 11 = 0 THEN c_custkey || ',' || c_mktsegment || ',' || c_nationkey || ',more'
            WHEN c_custkey % 13 = 0 THEN c_custkey || ',' || c_mktsegment
            WHEN c_custkey % 17 = 0 THEN c_custkey || ',N/A,' || c_nationkey
            ELSE c_custkey || ',' || c_mktsegment || ',' || c_nationkey END AS line,
       c_custkey % 7 = 0 OR c_custkey % 11 = 0 OR c_custkey % 13 = 0 AS broken
FROM customer"""


@register("io1_csv_broken_lines", f"""
SELECT CASE WHEN NOT broken THEN CAST(c_custkey AS BIGINT) END AS id,
       CASE WHEN NOT broken AND c_custkey % 17 <> 0 THEN c_mktsegment END AS segment,
       CASE WHEN NOT broken THEN CAST(c_nationkey AS INTEGER) END AS nation, CASE WHEN broken THEN line END AS line
FROM ({SQL_LINES})""")
def io1_csv_broken_lines(spark, sf_dir):
    """IO1: customers written as CSV lines, some of them broken; read by a schema, broken lines kept apart."""
    c = fx.table(spark, sf_dir, "customer")
    key, segment, nation = F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_nationkey")
    line = F.when(key % 7 == 0, F.concat_ws(",", key, segment, F.lit("many"))) \
        .when(key % 11 == 0, F.concat_ws(",", key, segment, nation, F.lit("more"))) \
        .when(key % 13 == 0, F.concat_ws(",", key, segment)) \
        .when(key % 17 == 0, F.concat_ws(",", key, F.lit("N/A"), nation)).otherwise(F.concat_ws(",", key, segment, nation))
    path = _folder(spark, "lines")
    c.select(line.alias("value")).write.text(path)
    rows, broken = tables.read_csv(spark, path, "id long, segment string, nation int", header=False)
    return rows.unionByName(broken, allowMissingColumns=True)


@register("io2_partition_overwrite", f"""
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, {r6("CASE WHEN c_nationkey IN (3, 5) THEN 2 * c_acctbal ELSE c_acctbal END")} AS c_acctbal,
       CAST(c_nationkey AS INTEGER) AS c_nationkey
FROM customer WHERE c_nationkey NOT IN (3, 5) OR c_acctbal > 0""")
def io2_partition_overwrite(spark, sf_dir):
    """IO2: customers by nation; the partitions of two nations are written anew, the others stay."""
    c = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long"), F.col("c_acctbal").cast("double"),
                                                   F.col("c_nationkey").cast("int"))
    path = _folder(spark, "customers")
    tables.write_table(c, path, partition_by=["c_nationkey"])
    anew = c.where("c_nationkey IN (3, 5) AND c_acctbal > 0").withColumn("c_acctbal", F.col("c_acctbal") * 2)
    tables.write_table(materialize(anew, "anew"), path, partition_by=["c_nationkey"], only_partitions=True)
    return rounded(tables.read_table(spark, path).select("c_custkey", "c_acctbal", F.col("c_nationkey").cast("int")))
