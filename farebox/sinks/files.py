"""Table builds and file layouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.operators.aggregates import rollup
from farebox.schemas import ddl
from farebox.session import scratch_path


def write_parquet(df: DataFrame, path: str, n: int, mode: str = "overwrite") -> None:
    """K1: write in exactly ``n`` partitions (round-robin, so evenly sized)."""
    df.repartition(n).write.mode(mode).parquet(path)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType,
                 partition_by: Sequence[str] = (), path: str | None = None) -> None:
    """K3: ``CREATE TABLE IF NOT EXISTS`` with the declared schema."""
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    loc = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(schema)}) USING parquet{part}{loc}")


def replace_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """K4: create or replace a table as the result of ``df``."""
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def stage(df: DataFrame, name: str) -> DataFrame:
    """K5: staging table = the batch written once to the shared folder and read
    back (the truncate-then-fill of a staging table, and a lineage cut)."""
    spark = df.sparkSession
    path = scratch_path(spark, f"stage-{name}")
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out.createOrReplaceTempView(name)
    return out


def build(df: DataFrame, name: str, as_: str = "view") -> DataFrame:
    """Materialise a model as a (temp) view or as a table."""
    if as_ == "view":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if as_ == "table":
        return replace_table(df, name)
    raise ValueError(f"unknown materialisation {as_!r}")


def write_partitioned(df: DataFrame, path: str, ts_col: str,
                      cluster_by: Sequence[str] = (), date_col: str = "pickup_date",
                      num_partitions: int | None = None,
                      max_records_per_file: int = 5_000_000, mode: str = "overwrite") -> None:
    """Partition by the day of ``ts_col``, cluster by up to 4 columns.

    Rows are range-partitioned on (day, cluster keys): the sampled bounds split
    a busy day over several tasks instead of sending it whole to one, and each
    task writes its slice sorted by the cluster keys, so Parquet row-group
    min/max statistics let a filter on them skip blocks.
    """
    if len(cluster_by) > 4:
        raise ValueError("at most 4 cluster columns")
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = df.withColumn(date_col, F.to_date(ts_col))
    keys = [date_col, *cluster_by]
    (out.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
     .write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(date_col).parquet(path))


#: Ranks a clustering key is cut into, as bits, and rows its bounds are taken from (both
#: shape the layout only, never what is read).
RANK_BITS, BOUND_ROWS = 6, 10_000


def rank_bounds(df: DataFrame, cols: Sequence[str]) -> dict[str, list]:
    """For each column, up to 2^RANK_BITS - 1 values that cut a random bounded number of its
    rows into equal parts."""
    rows = df.select(*cols).orderBy(F.rand(7)).limit(BOUND_ROWS).collect()
    out = {}
    for c in cols:
        values = sorted(r[c] for r in rows if r[c] is not None)
        n = 2 ** RANK_BITS
        out[c] = sorted({values[len(values) * i // n] for i in range(1, n)}) if values else []
    return out


def interleaved(bounds: dict[str, list]) -> Column:
    """The ranks of several keys with their bits in turns (a Z-order): rows close in this
    number are close in every key, so that any of the keys prunes."""
    z = F.lit(0).cast("bigint")
    for j, (c, cuts) in enumerate(bounds.items()):
        # the number of cuts below a value is its rank; NULL comes first
        rank = sum((F.when(F.col(c) > F.lit(x), 1).otherwise(0) for x in cuts), F.lit(0))
        for i in range(RANK_BITS):
            bit = F.shiftright(rank.cast("bigint"), i).bitwiseAND(F.lit(1).cast("bigint"))
            z = z + F.shiftleft(bit, i * len(bounds) + j)
    return z


def write_clustered(df: DataFrame, path: str, cluster_by: Sequence[str], files: int | None = None,
                    max_records_per_file: int = 5_000_000, mode: str = "overwrite") -> None:
    """K11 without a date: cluster by up to 4 columns so that a filter on any of them skips
    files and row groups by their min/max, not on the first alone as a plain sort does.

    The ranks' bounds come from a bounded number of rows on the driver; rows are
    range-partitioned on the interleaved ranks, and sorted by them within a file."""
    if not 1 <= len(cluster_by) <= 4:
        raise ValueError("1 to 4 cluster columns")
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    z = df.withColumn("__z", interleaved(rank_bounds(df, cluster_by)))
    (z.repartitionByRange(n, "__z").sortWithinPartitions("__z").drop("__z")
     .write.mode(mode).option("maxRecordsPerFile", max_records_per_file).parquet(path))


def refresh_rollup(df: DataFrame, keys: Sequence[str], measures: dict[str, Column],
                   name: str) -> DataFrame:
    """Precomputed aggregate, rebuilt on refresh."""
    return replace_table(rollup(df, keys, measures), name)
