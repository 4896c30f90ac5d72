"""Shared role bindings of the driver tables used by several query modules."""

from __future__ import annotations

from pyspark.sql import functions as F


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _job_url(prefix_ok=None):
    base = F.concat(F.lit("job/"), F.col("o_custkey").cast("string"), F.lit("/"),
                    F.col("o_orderdate").cast("date").cast("string"))
    return base if prefix_ok is None else F.when(prefix_ok, base).otherwise(F.lit(""))


_URL_SQL = "'job/' || CAST(o_custkey AS VARCHAR) || '/' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR)"


def founders(spark, sf):
    p = table(spark, sf, "part")
    return p.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.when(F.col("p_size") <= 10, F.lit(None).cast("string")).when(F.col("p_size") <= 15, F.lit(""))
         .otherwise(F.concat(F.lit("linkedin.com/in/"), F.col("p_brand"), F.lit("-"), F.col("p_size").cast("string")))
         .alias("linkedin"),
        F.when(F.col("p_size") > 40, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("@"), F.col("p_type"), F.col("p_size").cast("string"))).alias("twitter"),
        F.when(F.col("p_retailprice") > 1500, F.concat(F.lit("bio "), F.col("p_partkey").cast("string"))).alias("bio"),
        F.when(F.col("p_size") <= 25, F.col("p_type")).otherwise(F.lit("")).alias("title"))


