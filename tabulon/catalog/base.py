"""Registration and the derived base tables."""
from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabulon.functions.numeric import tidy
from tabulon.session import cut

ENTRIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        if name in ENTRIES:
            raise ValueError(f"query {name} exists")
        ENTRIES[name] = (fn, sql)
        return fn
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded so that the order of addition does not show."""
    return df.select([tidy(F.col(c), digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


def longs(df: DataFrame) -> DataFrame:
    """Integer columns as bigint."""
    return df.select([F.col(c).cast("bigint").alias(c) if t in ("int", "smallint", "tinyint") else F.col(c)
                      for c, t in df.dtypes])


def out(df: DataFrame, digits: int = 6) -> DataFrame:
    return longs(rounded(df, digits))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder next to the session's checkpoints, which every executor reaches."""
    if spark.sparkContext.getCheckpointDir() is None:
        cut(spark.range(1).toDF("x"))
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def homes(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their customer and its place: a labelled table with a three-level geography."""
    o, c = table(spark, folder, "orders"), table(spark, folder, "customer")
    n, r = table(spark, folder, "nation"), table(spark, folder, "region")
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("o_orderkey").alias("id"), F.col("r_regionkey").alias("geo1"),
                    F.col("n_nationkey").alias("geo2"), F.col("c_custkey").alias("geo3"),
                    F.col("o_totalprice").alias("price"), F.col("c_acctbal").alias("balance"),
                    F.col("o_orderpriority").alias("priority"), F.col("c_mktsegment").alias("segment"),
                    F.col("o_orderstatus").alias("status")))


HOMES = """homes AS (
  SELECT o_orderkey AS id, r_regionkey AS geo1, n_nationkey AS geo2, c_custkey AS geo3, o_totalprice AS price,
         c_acctbal AS balance, o_orderpriority AS priority, c_mktsegment AS segment, o_orderstatus AS status
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""


def parts(spark: SparkSession, folder: str) -> DataFrame:
    """Parts with a sentinel range of sizes turned into NULL."""
    p = table(spark, folder, "part")
    return p.select("p_partkey", F.when(~F.col("p_size").between(40, 45), F.col("p_size")).alias("p_size"),
                    "p_retailprice", "p_type", "p_brand")


PARTS = """parts AS (
  SELECT p_partkey, CASE WHEN p_size NOT BETWEEN 40 AND 45 THEN p_size END AS p_size, p_retailprice, p_type, p_brand
  FROM part)"""


def code(col: Column, values: list) -> Column:
    """0-based position of a value in a fixed list."""
    return (F.array_position(F.array(*[F.lit(v) for v in values]), col) - 1).cast("int")
