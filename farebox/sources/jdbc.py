"""JDBC read and write.

Reads are split into ``num_partitions`` range queries on a numeric column so
executors fetch in parallel; writes go out per partition in ``batchsize``
row batches.  The JDBC driver jar must be on the cluster class path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str | None = None,
              query: str | None = None, props: dict | None = None,
              partition: dict | None = None) -> DataFrame:
    """A table or a query.  ``partition`` = {column, lower, upper, num}."""
    r = spark.read.format("jdbc").option("url", url).options(**(props or {}))
    if query is not None:
        r = r.option("query", query)
    else:
        r = r.option("dbtable", table)
    if partition:
        r = (r.option("partitionColumn", partition["column"])
             .option("lowerBound", partition["lower"])
             .option("upperBound", partition["upper"])
             .option("numPartitions", partition.get("num", 8)))
    return r.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               props: dict | None = None, batchsize: int = 100_000,
               num_partitions: int | None = None) -> None:
    """K2: ``replace`` (overwrite, then rows) or ``append``; no index column."""
    mode = "overwrite" if mode == "replace" else mode
    w = (df.write.format("jdbc").option("url", url).option("dbtable", table)
         .option("batchsize", batchsize).options(**(props or {})).mode(mode))
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    w.save()
