"""How the rental roles bind to the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks(spark: SparkSession) -> int:
    """How many tasks heavy work on few bytes should have: Spark would size its partitions by bytes alone."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def spread(df: DataFrame) -> DataFrame:
    """df in as many partitions as there are cores, if its files have fewer splits; for scans before heavy work on texts."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as properties: (id, name, city, state, status, balance). Nation and region are fixed, small tables."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    c = table(spark, sf_dir, "customer").join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("n_name").alias("city"), F.col("r_name").alias("state"), F.col("c_mktsegment").alias("status"), F.col("c_acctbal").alias("balance"))


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as units: (id, unit_id, asking, available, plan, day)."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("unit_id"), F.col("o_totalprice").alias("asking"), (F.col("o_orderstatus") == "O").alias("available"), F.col("o_orderpriority").alias("plan"), F.to_date("o_orderdate").alias("day"))


def snapshot(spark: SparkSession, sf_dir: str, year: int) -> DataFrame:
    """One run: (id, plan, asking, n) of a year's orders."""
    u = units(spark, sf_dir).where(F.year("day") == year)
    return u.groupBy("id", "plan").agg(F.round(F.sum("asking"), 2).alias("asking"), F.count(F.lit(1)).alias("n"))


PROPERTIES = """props AS (SELECT c_custkey AS id, c_name AS name, n_name AS city, r_name AS state, c_mktsegment AS status, c_acctbal AS balance
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
UNITS = """units AS (SELECT o_custkey AS id, o_orderkey AS unit_id, o_totalprice AS asking, o_orderstatus = 'O' AS available,
  o_orderpriority AS plan, o_orderdate::DATE AS day FROM orders)"""


def snapshot_sql(name: str, year: int) -> str:
    return f"""{name} AS (SELECT o_custkey AS id, o_orderpriority AS plan, round(sum(o_totalprice), 2) AS asking, count(*) AS n
  FROM orders WHERE year(o_orderdate) = {year} GROUP BY 1, 2)"""
