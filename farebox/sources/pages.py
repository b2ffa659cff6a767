"""Paged JSON load (S9): pages 1..n of a paginated API, stopping at the first
empty page, one row per record.

The HTTP fetch itself is outside Spark; pages land as JSON files holding
``page_no`` and a ``records`` array.  Spark reads every landed page, finds
the first empty page number (a scalar subquery) and explodes the records of
the pages before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox import schemas

NO_STOP = 2**62


BAD = "_malformed"


def checked_pages(spark: SparkSession, landing: str, schema: T.StructType) -> DataFrame:
    """Landed pages; one that does not parse, or lacks its number or its array of
    records, fails the load with its file and text rather than being skipped or
    taken for the empty page."""
    raw = (spark.read.schema(T.StructType([*schema.fields, T.StructField(BAD, T.StringType())]))
           .option("columnNameOfCorruptRecord", BAD).json(landing))
    bad = F.col(BAD).isNotNull() | F.col("page_no").isNull() | F.col("records").isNull()
    message = F.concat(F.lit("malformed page "), F.coalesce(F.col("page_no").cast("string"), F.lit("?")),
                       F.lit(" in "), F.col("_metadata.file_path"), F.lit(": "),
                       F.coalesce(F.substring(BAD, 1, 200), F.lit("no page number or no records")))
    checked = F.when(bad, F.raise_error(message).cast("bigint")).otherwise(F.col("page_no"))
    return raw.select(checked.cast(schema["page_no"].dataType).alias("page_no"),
                      *[f.name for f in schema.fields if f.name != "page_no"])


def load_pages(spark: SparkSession, landing: str,
               schema: T.StructType = schemas.PAGE, base_page: int = 1) -> DataFrame:
    pages = checked_pages(spark, landing, schema)
    empty = pages.filter(F.coalesce(F.size("records"), F.lit(0)) <= 0)
    stop = F.coalesce(empty.select(F.min("page_no")).scalar(), F.lit(NO_STOP))
    kept = pages.filter((F.col("page_no") >= base_page) & (F.col("page_no") < stop))
    return kept.select("page_no", F.explode("records").alias("r")).select("page_no", "r.*")


def land_pages(records: DataFrame, landing: str, page_col: str = "page_no",
               record_cols: list[str] | None = None, empty_pages: list[int] = ()) -> None:
    """Write records as one JSON document per page (test helper that lands what
    the paginated API returns).  Each page is gathered with ``collect_list``,
    which is bounded because an API page holds at most a fixed number of
    records (the caller's page column must respect that); ``empty_pages``
    become empty arrays."""
    cols = record_cols or [c for c in records.columns if c != page_col]
    spark = records.sparkSession
    empty = F.array().cast(T.ArrayType(records.select(F.struct(*cols).alias("s"))
                                       .schema["s"].dataType))
    pages = (records.filter(~F.col(page_col).isin(list(empty_pages)))
             .groupBy(page_col).agg(F.collect_list(F.struct(*cols)).alias("records")))
    if empty_pages:
        blanks = spark.createDataFrame([(int(p),) for p in empty_pages], f"{page_col} long")
        pages = pages.unionByName(blanks.withColumn("records", empty))
    pages.write.mode("overwrite").json(landing)
