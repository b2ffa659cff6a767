"""File sources (S1-S6, S10): Parquet, CSV (plain or gzip), external tables,
the zone lookup seed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox import schemas


def read_parquet(spark: SparkSession, path: str | Sequence[str],
                 schema: T.StructType | None = None) -> DataFrame:
    """Parquet file(s); a declared schema skips footer inference."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    paths = [path] if isinstance(path, str) else list(path)
    return r.parquet(*paths)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition a scan that yields fewer partitions than the
    cluster's default parallelism (a single-row-group Parquet file, a gzip
    CSV), so later operators run in parallel.  A scan that already has enough
    splits, as any large input does, is returned unchanged: no extra shuffle."""
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001  no RDD view (remote session): leave as is
        return df
    return df if have >= want else df.repartition(want)


def parsed(df: DataFrame, schema: T.StructType, timestamp_format: str | None = None) -> DataFrame:
    """Text columns cast to the types of ``schema``; a non-empty text that does not
    parse fails the read and is named, instead of becoming NULL."""
    out = []
    for f in schema.fields:
        text = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            out.append(text)
            continue
        if timestamp_format and isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            value = F.try_to_timestamp(text, F.lit(timestamp_format)).cast(f.dataType)
        else:
            value = F.trim(text).try_cast(f.dataType)
        message = F.concat(F.lit(f"column {f.name}: not a {f.dataType.simpleString()}: "), text)
        # coalesce: a value that parses is parsed once
        out.append(F.coalesce(value, F.when(text.isNotNull(), F.raise_error(message).cast(f.dataType)))
                   .alias(f.name, metadata=f.metadata))
    extra = [c for c in df.columns if c not in schema.names]
    return df.select(*out, *[F.col(f"`{c}`") for c in extra])


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None,
             columns: Sequence[str] | None = None, header: bool = True,
             ignore_extra: bool = True, repartition: int | None = None,
             timestamp_format: str | None = None, file_col: str | None = None) -> DataFrame:
    """CSV with a declared schema, or ``schema=None`` for the
    header names with every column a string (no inference pass).

    * header row skipped; schema applied by position (header names ignored);
    * ``ignore_extra``: extra trailing fields are dropped and short rows
      null-filled (``FAILFAST`` otherwise); in either case a value that does not
      parse as its declared type fails the read (``parsed``);
    * ``.gz`` input is decoded natively but not splittable, so pass
      ``repartition`` to spread the rows after the read where it has fewer splits
      than that: types are parsed, and whatever follows runs, after that;
    * ``columns`` keeps an explicit column list (the COPY column list);
    * ``file_col`` adds the path of each row's file.
    """
    r = (spark.read.option("header", header)
         .option("mode", "PERMISSIVE" if ignore_extra else "FAILFAST")
         .option("inferSchema", False))
    if schema is not None:
        text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
        r = r.schema(text).option("enforceSchema", True)
    paths = [path] if isinstance(path, str) else list(path)
    df = r.csv(paths)
    if file_col:
        df = df.select("*", F.input_file_name().alias(file_col))
    if columns is not None:
        df = df.select(*columns, *([file_col] if file_col else []))
    if repartition:
        df = spread(df, repartition)
    if schema is not None:
        kept = T.StructType([f for f in schema.fields if columns is None or f.name in columns])
        df = parsed(df, kept, timestamp_format)
    return df


def with_source_file(df: DataFrame, col: str = "source_file") -> DataFrame:
    """Attach the input file name of every row (from the hidden metadata column)."""
    return df.withColumn(col, F.col("_metadata.file_name"))


def external_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
                   schema: T.StructType | None = None, options: dict | None = None,
                   persistent: bool = False) -> DataFrame:
    """A table over files that stay where they are.

    Temp view by default; ``persistent=True`` registers an unmanaged catalog
    table (``CREATE TABLE .. USING fmt OPTIONS (path ..)``).
    """
    if persistent:
        spark.catalog.createTable(name, path=path, source=fmt, schema=schema,
                                  **(options or {}))
        return spark.table(name)
    r = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        r = r.schema(schema)
    df = r.load(path)
    df.createOrReplaceTempView(name)
    return df


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV (LocationID, Borough, Zone, service_zone), typed int
    id; header spelling does not matter as the schema is positional."""
    return read_csv(spark, path, schemas.ZONES)
