"""Stand-in inputs built from the shared TPC-H-like test tables.

These functions only reshape rows into the schemas the operators expect; they do
none of the operators' work:

* interactions = lineitem joined to orders: user_id = o_custkey,
  recording_msid = 's' || l_partkey, timestamp = o_orderdate
* tracks = part: recording_msid = 's' || p_partkey, recording_mbid =
  'b' || (p_partkey % 1000), or null when p_partkey % 5 = 0; artist_name =
  p_brand, track_name = p_name
* users = customer: user_id = c_custkey, user_name = c_name
* events (second event log): user_id, recording_mbid = props, timestamp = ts
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def load_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = lineitem.join(orders, lineitem["l_orderkey"] == orders["o_orderkey"], "inner")
    return joined.select(
        F.col("o_custkey").cast("bigint").alias("user_id"),
        F.concat(F.lit("s"), F.col("l_partkey").cast("string")).alias("recording_msid"),
        F.col("o_orderdate").alias("timestamp"),
    )


def load_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _read(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return part.select(
        F.concat(F.lit("s"), key.cast("string")).alias("recording_msid"),
        F.when(key % 5 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("b"), (key % 1000).cast("string")))
         .alias("recording_mbid"),
        F.col("p_brand").alias("artist_name"),
        F.col("p_name").alias("track_name"),
    )


def load_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("bigint").alias("user_id"),
        F.col("c_name").alias("user_name"),
    )


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events").select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("props").alias("recording_mbid"),
        F.col("ts").alias("timestamp"),
    )
