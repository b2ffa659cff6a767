"""Idempotent monthly loads (K6-K9): stamp rows with a row key and the source
file name, then insert only keys the target does not hold yet.

The target is a Parquet directory; inserting is an anti join against its
keys followed by an append.  A single writer per target is assumed (loads
are serialised, as in the reference's flows); the anti join plus append is
not atomic against concurrent writers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox import schemas
from farebox.functions.columns import row_key, row_key_fields
from farebox.session import scratch_path
from farebox.sources.files import read_csv

# Tables a load writes: zstd at its fastest level (2 to 4 % larger than at the default one).
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}
# Fixed value: file name template of a monthly trip file.
FILE_TEMPLATE = "{service}_tripdata_{year:04d}-{month:02d}.csv"
# Picks the monthly file name out of a path (a file or a directory of parts).
_FILE_PATTERN = r"([A-Za-z]+_tripdata_[0-9]{4}-[0-9]{2}\.csv)"


def file_name(service: str, year: int, month: int) -> str:
    return FILE_TEMPLATE.format(service=service.lower(), year=year, month=month)


def source_file_name() -> "F.Column":
    """Monthly file name of each row, from the hidden ``_metadata`` column."""
    found = F.regexp_extract(F.col("_metadata.file_path"), _FILE_PATTERN, 1)
    return F.when(found != "", found).otherwise(F.col("_metadata.file_name"))


def stamp(df: DataFrame, key_cols: Sequence[str], filename: "str | F.Column | None" = None,
          binary: bool = False, sep: str = "", key: str = "unique_row_id") -> DataFrame:
    """K6: add the row key (md5 of the listed columns) and the file name."""
    fname = source_file_name() if filename is None else F.lit(filename) if isinstance(filename, str) else filename
    keyed = df.withColumns({key: row_key(key_cols, binary=binary, sep=sep),
                            "filename": fname})
    return keyed.select(key, "filename", *[c for c in df.columns])


# Target partition column: the pickup month of a trip ('unknown' without one).
PART_COL = "pickup_month"
NO_MONTH = "unknown"


def with_pickup_month(df: DataFrame, pickup: str) -> DataFrame:
    """Partition value of a trip.  The row key covers the pickup time, so
    rows with equal keys always share this value.

    The month is cut from the text that the row key is made of, where the year has four digits."""
    text = F.col(pickup).cast("string")
    month = F.when(F.substring(text, 5, 1) == "-", F.substring(text, 1, 7)).otherwise(
        F.date_format(F.col(pickup), "yyyy-MM"))
    return df.withColumn(PART_COL, F.coalesce(month, F.lit(NO_MONTH)))


def merge_insert(target: DataFrame, source: DataFrame, key: str = "unique_row_id",
                 part_col: str | None = None, parts: DataFrame | None = None) -> DataFrame:
    """Rows of ``source`` whose key is not in ``target``
    (``MERGE .. WHEN NOT MATCHED THEN INSERT``).  Equal keys inside the source
    are all inserted, as MERGE does.

    With ``part_col`` (a partition column of the target that equal keys
    share) only the target partitions present in the source are read: the
    distinct values of ``parts`` (a superset of the source's will do, such as the
    staged file's) go into a semi join, which the planner turns into dynamic
    partition pruning of the target scan.  A monthly load then reads a month or
    two of history, not all of it.
    """
    if part_col is None:
        return source.join(target.select(key), key, "left_anti")
    # months are few by construction: some twelve for each year of history
    parts = F.broadcast((source if parts is None else parts).select(part_col).distinct())
    touched = target.join(parts, part_col, "left_semi").select(part_col, key)
    return source.join(touched, [part_col, key], "left_anti")


def _narrow(df: DataFrame, name: str) -> DataFrame:
    """A few columns of a large table written once and read back: its size is then known, so
    that a join with it is a broadcast while it is small and a shuffled one otherwise."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**PACKED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def key_month() -> F.Column:
    """The month that the text of a row key tells, so that equal keys have equal months; NULL where
    the text may be read in two ways.  It begins with the vendor and the pickup time: the first
    '-' of both ends the year, if there is a pickup time of four digits' year and none in the vendor."""
    told = (F.substring(PART_COL, 5, 1) == "-") & ~F.contains(F.coalesce("VendorID", F.lit("")), F.lit("-"))
    return F.when(told, F.col(PART_COL))


def layout(staged: DataFrame, file_col: str = "filename") -> DataFrame:
    """Rows of a staging table by its own file, month and source file: a few for each file."""
    held = staged.groupBy(F.col("_metadata.file_name").alias("__part"), PART_COL, file_col)
    return _narrow(held.agg(F.count(F.lit(1)).alias("n")), "layout")


def main_files(held: DataFrame, file_col: str = "filename") -> DataFrame:
    """The source file with most rows of each month of a ``layout``."""
    files = held.groupBy(F.col(PART_COL).alias("__month"), file_col).agg(F.sum("n").alias("n"))
    return files.groupBy("__month").agg(F.max_by(file_col, "n").alias("__main"))


def earliest_file_rows(stamped: DataFrame, key: str = "unique_row_id",
                       file_col: str = "filename", main: DataFrame | None = None) -> DataFrame:
    """Rows that a sequence of monthly merges in file order would keep: per
    key, every row of the earliest file holding that key.

    Only keys that several files hold lose rows.  Hashes of keys met in two files are found
    from (hash, file) alone (partial per map task, so a hot key is cheap) and written; the
    rows with one of them are settled by the whole key, all others stay without a shuffle.

    With ``main`` (``main_files``) the keys of whole months are not compared at all: a key that
    two files hold has a row outside its month's main file, so only the keys of such rows and
    of those without a ``key_month`` are looked for in the others.
    """
    rows = stamped.filter(F.col(key).isNotNull() & F.col(file_col).isNotNull()).withColumn("__hash", F.xxhash64(key))
    held = rows.select("__hash", file_col)
    if main is not None:
        at_home = F.coalesce(F.col(file_col) == F.col("__main"), F.lit(False))
        strays = (rows.join(F.broadcast(main), key_month() == F.col("__month"), "left").filter(~at_home)
                  .select("__hash"))
        held = held.join(_narrow(strays, "keys-astray").distinct(), "__hash", "left_semi")
    files = held.groupBy("__hash").agg(F.min(file_col).alias("lo"), F.max(file_col).alias("hi"))
    again = _narrow(files.filter(F.col("lo") != F.col("hi")).select("__hash"), "keys-again")
    several = rows.join(again, "__hash", "left_semi").select(*stamped.columns)
    first = several.groupBy(key).agg(F.min(file_col).alias(file_col))
    return (rows.join(again, "__hash", "left_anti").select(*stamped.columns)
            .unionByName(several.join(first, [key, file_col], "left_semi").select(*stamped.columns)))


def _packed(df: DataFrame, key: str) -> F.Column:
    """The key in 16 bytes where it is the text of an md5; any other text is told apart by 17
    zero bytes before it, so that equal packed keys are equal keys."""
    c = F.col(key)
    if isinstance(df.schema[key].dataType, T.BinaryType):
        return c
    # unhex gives NULL for what is no hex number; upper case is no md5's
    md5 = F.when((F.octet_length(c) == 32) & (F.lower(c) == c), F.unhex(c))
    return F.coalesce(md5, F.concat(F.lit(bytes(17)), F.encode(c, "UTF-8")))


def file_counts(loaded: DataFrame, key: str = "unique_row_id", file_col: str = "filename") -> DataFrame:
    """Rows and distinct keys of each source file.

    A hash (of key and file) met once is one key; the rows of the others, written by their hash,
    are counted by the whole key."""
    held = loaded.select(file_col, key, F.xxhash64(key, file_col).alias("__hash"))
    keyed = held.filter(F.col(key).isNotNull() & F.col(file_col).isNotNull())
    more = _narrow(keyed.groupBy("__hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                   .select("__hash"), "keys-repeated")
    repeats = (keyed.join(more, "__hash", "left_semi").groupBy(file_col)
               .agg((F.count(key) - F.count_distinct(key)).alias("__repeats")))
    rows = held.groupBy(file_col).agg(F.count(F.lit(1)).alias("rows"), F.count(key).alias("distinct_keys"))
    return rows.join(repeats, file_col, "left").select(
        file_col, "rows", (F.col("distinct_keys") - F.coalesce("__repeats", F.lit(0))).alias("distinct_keys"))


def new_rows(target: DataFrame, rows: DataFrame, key: str = "unique_row_id", parts: DataFrame | None = None,
             part_col: str | None = None) -> DataFrame:
    """``merge_insert`` by way of the keys: those the target lacks are found from the keys of
    both alone and written, then the rows that have one are taken.  A load that brings little
    or nothing new shuffles no whole rows."""
    held = target
    if part_col is not None:
        months = F.broadcast((rows if parts is None else parts).select(part_col).distinct())
        held = target.join(months, part_col, "left_semi")
    keys = rows.select(_packed(rows, key).alias("__key"))
    fresh = _narrow(keys.join(held.select(_packed(held, key).alias("__key")), "__key", "left_anti"), "keys-new")
    # a key without a value is in no target: it has to meet itself here
    return (rows.withColumn("__row_key", _packed(rows, key))
            .join(fresh, F.col("__row_key").eqNullSafe(fresh["__key"]), "left_semi").select(*rows.columns))


def _read_target(spark: SparkSession, path: str) -> DataFrame | None:
    """The target table, or None when nothing has been loaded yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def append_new(spark: SparkSession, rows: DataFrame, target_path: str,
               key: str = "unique_row_id", earliest: bool = False, arranged: bool = False,
               main: DataFrame | None = None) -> int:
    """Insert ``rows`` whose key is absent from the target; returns how many.

    The target's files are listed when the job is planned; the appended files only become
    visible when the job commits.  Rows carrying the ``pickup_month`` column are written
    partitioned by it, and only the target months that the rows hold are read.  With
    ``earliest`` a key that several files of the load hold is inserted from the earliest
    (``main`` as in ``earliest_file_rows``).
    The inserted rows are counted as they are written.
    """
    target = _read_target(spark, target_path)
    part = PART_COL if PART_COL in rows.columns else None
    if target is not None:
        rows = new_rows(target, rows, key, part_col=part)
    if earliest:
        rows = earliest_file_rows(rows, key, main=main)
    inserted = Observation()
    if part:
        # Group the rows by month before the partitioned write (AQE splits a
        # big month into advisory-size files, stragglers share one file each)
        # instead of every task writing a small file for every month; ``arranged``
        # rows, whose files hold few months each, are grouped already.
        rows = rows if arranged else rows.hint("rebalance", part)
        (rows.observe(inserted, F.count(F.lit(1)).alias("rows")).write.mode("append").options(**PACKED)
         .partitionBy(part).parquet(target_path))
    else:
        rows.observe(inserted, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(target_path)
    return int(inserted.get["rows"])


#: Months a staged file may hold on average for its rows to count as grouped by month.
MONTHS_A_FILE = 4


def _rows_by_month(held: DataFrame) -> tuple[int, bool]:
    """Rows of a staging table by its ``layout``, and whether its files hold few months each."""
    files = held.groupBy("__part", PART_COL).agg(F.sum("n").alias("n")).groupBy("__part").agg(
        F.sum("n").alias("n"), F.count(PART_COL).alias("months"))
    rows, mean = files.agg(F.sum("n"), F.avg("months")).first()
    return int(rows or 0), mean is not None and mean <= MONTHS_A_FILE


def stage_rows(stamped: DataFrame, target_path: str) -> DataFrame:
    """K5: the staging table of a load: the stamped source written once as
    Parquet next to the target (overwritten by the next load) and read back,
    so the merge scans columnar data instead of parsing the text twice."""
    spark = stamped.sparkSession
    path = target_path.rstrip("/") + "_staging"
    stamped.write.mode("overwrite").options(**PACKED).parquet(path)
    return spark.read.schema(stamped.schema).parquet(path)


def ensure_bucketed(spark: SparkSession, table: str, path: str, like: DataFrame, buckets: int,
                    key: str = "unique_row_id") -> None:
    """K3: a target table partitioned by month and, within it, bucketed by the row key."""
    if not spark.catalog.tableExists(table):
        (like.limit(0).write.format("parquet").option("path", path).partitionBy(PART_COL).bucketBy(buckets, key)
         .saveAsTable(table))


def merge_insert_bucketed(target: DataFrame, source: DataFrame, key: str = "unique_row_id",
                          parts: DataFrame | None = None) -> DataFrame:
    """K7 into a bucketed target: only the source is shuffled, to the target's buckets.

    Equal keys share a month (the key covers the pickup time), so the key alone decides and
    the target's buckets are its partitioning; its months are pruned as in ``merge_insert``."""
    months = F.broadcast((source if parts is None else parts).select(PART_COL).distinct())
    touched = target.join(months, PART_COL, "left_semi").select(key)
    return source.join(touched, key, "left_anti").select(*source.columns)


def append_new_bucketed(spark: SparkSession, rows: DataFrame, table: str, path: str, buckets: int,
                        key: str = "unique_row_id", earliest: bool = False, main: DataFrame | None = None) -> int:
    """Insert ``rows`` whose key is absent from the bucketed ``table`` (made if missing);
    returns how many.  Rows are dealt by month and bucket before the write, so that a bucket
    of a month is one file and the write has as many tasks as the session's shuffles."""
    if spark.catalog.tableExists(table):
        rows = new_rows(spark.table(table), rows, key, part_col=PART_COL)
    else:
        ensure_bucketed(spark, table, path, rows, buckets, key)
    if earliest:
        rows = earliest_file_rows(rows, key, main=main)
    inserted = Observation()
    # the number of a row's bucket, as bucketBy takes it
    bucket = F.pmod(F.hash(key), F.lit(buckets))
    (rows.select(*spark.table(table).columns).repartition(_slots(spark), PART_COL, bucket)
     .observe(inserted, F.count(F.lit(1)).alias("rows"))
     .write.mode("append").format("parquet").option("path", path).option("compression", "zstd")
     .partitionBy(PART_COL).bucketBy(buckets, key).saveAsTable(table))
    return int(inserted.get["rows"])


@dataclass(frozen=True)
class LoadReport:
    """D6 of a load, counted while it ran: rows read from the files, rows of the staging
    table, rows inserted, and staged rows the target held already or an earlier file of the
    same load brought."""

    source: int
    staged: int
    inserted: int

    @property
    def rejected(self) -> int:
        return self.staged - self.inserted

    @property
    def status(self) -> str:
        return "match" if self.source == self.staged else "mismatch"


def _pickup_col(service: str) -> str:
    return ("lpep" if service.lower() == "green" else "tpep") + "_pickup_datetime"


def _schema_for(service: str):
    return {"green": schemas.GREEN_RAW, "yellow": schemas.YELLOW_RAW}[service.lower()]


_PATH, _LISTED, _NAME = "__source_path", "__listed_path", "__source_name"


def _name_in(path: F.Column) -> F.Column:
    """Monthly file name in a path, or its last part."""
    return F.coalesce(F.nullif(F.regexp_extract(path, _FILE_PATTERN, 1), F.lit("")), F.element_at(F.split(path, "/"), -1))


def _listed_names(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Path and monthly file name of each file, so that names are searched for once a file
    and not once a row; the files themselves are not read."""
    listed = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    # the path as read_csv gives it
    return (listed.select(F.input_file_name().alias(_LISTED)).distinct()
            .withColumn(_NAME, _name_in(F.col(_LISTED))))


def _stamped(spark: SparkSession, service: str, paths: str | Sequence[str], width: int, binary: bool,
             filename: str | None = None, seen: Observation | None = None) -> DataFrame:
    """Monthly CSVs, spread over the cluster if they are fewer than its slots (a .gz is one
    split, however large), then parsed, stamped with key and file name and given their month."""
    raw = read_csv(spark, paths, _schema_for(service), repartition=_parallelism(spark),
                   file_col=None if filename else _PATH)
    if seen is not None:
        raw = raw.observe(seen, F.count(F.lit(1)).alias("rows"))
    if filename:
        name = F.lit(filename)
    else:
        names = _listed_names(spark, paths)
        raw = raw.join(F.broadcast(names), raw[_PATH] == names[_LISTED], "left").drop(_LISTED)
        name = F.coalesce(F.col(_NAME), _name_in(F.col(_PATH)))
    stamped = stamp(raw, row_key_fields(service, width), name, binary=binary).drop(_PATH, _NAME)
    return with_pickup_month(stamped, _pickup_col(service))


def _parallelism(spark: SparkSession) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001  remote session: only the SQL conf is visible
        return _slots(spark)


def _slots(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _load(spark: SparkSession, service: str, paths: str | Sequence[str], target_path: str, width: int, binary: bool,
          filename: str | None, earliest: bool, table: str | None = None, buckets: int = 0) -> LoadReport:
    """Read, stage, merge; read and inserted rows are observed in the jobs that do so, staged
    rows counted where they were written."""
    source = Observation()
    staged = stage_rows(_stamped(spark, service, paths, width, binary, filename, source), target_path)
    held = layout(staged)
    rows, arranged = _rows_by_month(held)
    main = main_files(held) if earliest else None
    if table is None:
        inserted = append_new(spark, staged, target_path, earliest=earliest, arranged=arranged, main=main)
    else:
        inserted = append_new_bucketed(spark, staged, table, target_path, buckets, earliest=earliest, main=main)
    return LoadReport(int(source.get["rows"]), rows, inserted)


def load_month_report(spark: SparkSession, service: str, year: int, month: int, src: str,
                      target_path: str, width: int = 7, binary: bool = False) -> LoadReport:
    """K8: read one monthly CSV, stamp it, merge it into the target.
    ``binary`` keeps the row key as bytes (the warehouse form)."""
    return _load(spark, service, src, target_path, width, binary, file_name(service, year, month), False)


def load_month(spark: SparkSession, service: str, year: int, month: int, src: str,
               target_path: str, width: int = 7, binary: bool = False) -> int:
    """K8 as ``load_month_report``; the number of inserted rows (0 on a rerun)."""
    return load_month_report(spark, service, year, month, src, target_path, width, binary).inserted


def load_months_report(spark: SparkSession, service: str, paths: str | Sequence[str],
                       target_path: str, width: int = 7, binary: bool = False) -> LoadReport:
    """K9: backfill many monthly files in one job.

    Equivalent to merging the files one by one in file-name (= month) order: of the keys
    that the target lacks the rows of the earliest file are appended (in-file duplicates too).
    """
    return _load(spark, service, paths, target_path, width, binary, None, True)


def load_months_bucketed(spark: SparkSession, service: str, paths: str | Sequence[str], table: str, target_path: str,
                         buckets: int, width: int = 7, binary: bool = False) -> LoadReport:
    """K9 into the catalog table ``table`` at ``target_path``, bucketed by the row key, so that
    a load shuffles its staged rows and never the target's keys."""
    return _load(spark, service, paths, target_path, width, binary, None, True, table, buckets)


def load_months(spark: SparkSession, service: str, paths: str | Sequence[str],
                target_path: str, width: int = 7, binary: bool = False) -> int:
    """K9 as ``load_months_report``; the number of inserted rows."""
    return load_months_report(spark, service, paths, target_path, width, binary).inserted


def write_monthly_files(trips: DataFrame, root: str, service: str, arranged: bool = False) -> str:
    """Split raw trips into gzip CSVs per monthly file name, as the months land
    from the data provider (test helper for K8/K9).  Returns a glob.

    The ``rebalance`` hint lets AQE write about one file per month while
    splitting a month that is much larger than the rest over several tasks;
    ``arranged`` rows are dealt by month already.
    """
    dealt = trips if arranged else trips.hint("rebalance", "filename")
    (dealt.write.mode("overwrite").option("header", True)
     .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").partitionBy("filename").csv(root))
    return f"{root.rstrip('/')}/filename={service.lower()}_tripdata_*/*.csv*"
