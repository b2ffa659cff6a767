"""Precomputed tables that are brought up to date instead of rebuilt.

``Rollup`` keeps *partial states* (sums, counts, extremes) for every key and source file, in
a folder for each file.  A refresh lists the files, reads only those it has no state of and
writes their folders in one commit; reading merges the states of the files that are there
now.  A file that is replaced gets a new identity (path, size and time of change), so its old
state falls out of the merge; a run that is lost before its commit leaves nothing.

``DistinctTable`` keeps bitmaps of whole numbers for each day, so that exact distinct counts
over any range of days are an OR of bitmaps and never read the rows again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from farebox.session import scratch_path

KINDS = ("count", "sum", "min", "max", "avg")


@dataclass(frozen=True)
class Refresh:
    """What a refresh read: files that were new and the rows in them."""

    files: int
    rows: int


def _identity() -> Column:
    """A file's identity: a name for its folder that changes when the file does."""
    m = F.col("_metadata")
    return F.concat(F.lit("f"), F.md5(F.concat_ws("|", m["file_path"], m["file_size"], F.unix_millis(m["file_modification_time"]))))


def source_files(spark: SparkSession, files: str | Sequence[str]) -> DataFrame:
    """(path, source) of the files there are now; no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(files)
    return found.select("path", _identity().alias("source"))


class Rollup:
    """An aggregate by ``keys`` over a growing set of files.

    ``read(spark, paths)`` opens files as a scan; ``keys`` and ``measures`` are expressions
    over its columns, a measure being (kind, column) with a kind of ``KINDS``.  The state at
    ``path`` has one writer at a time.  Many small files make many small folders: let files
    be a day or a month.
    """

    def __init__(self, path: str, read: Callable[[SparkSession, list[str]], DataFrame], keys: dict[str, Column],
                 measures: dict[str, tuple[str, Column]]):
        for kind, _ in measures.values():
            if kind not in KINDS:
                raise ValueError(f"unknown kind of measure {kind!r}")
        self.path, self.read_files, self.keys, self.measures = path, read, keys, measures

    def _partial(self, rows: DataFrame) -> DataFrame:
        aggs = []
        for name, (kind, c) in self.measures.items():
            if kind in ("sum", "avg"):
                aggs.append(F.sum(c).alias(f"{name}__sum"))
            if kind in ("count", "avg"):
                aggs.append(F.count(c).alias(f"{name}__count"))
            if kind in ("min", "max"):
                aggs.append(getattr(F, kind)(c).alias(f"{name}__{kind}"))
        return rows.groupBy("source", *[c.alias(k) for k, c in self.keys.items()]).agg(*aggs)

    def _merged(self, states: DataFrame) -> DataFrame:
        aggs = []
        for name, (kind, _) in self.measures.items():
            if kind == "avg":
                aggs.append((F.sum(f"{name}__sum") / F.sum(f"{name}__count")).alias(name))
            elif kind in ("sum", "count"):
                aggs.append(F.sum(f"{name}__{kind}").alias(name))
            else:
                aggs.append(getattr(F, kind)(f"{name}__{kind}").alias(name))
        return states.groupBy(*self.keys).agg(*aggs)

    def _states(self, spark: SparkSession) -> DataFrame | None:
        try:
            return spark.read.parquet(self.path)
        except AnalysisException:
            return None  # nothing yet

    def delta(self, spark: SparkSession, files: str | Sequence[str]) -> DataFrame | None:
        """Rows of the files without a state, with their file's identity; None if there is
        no such file.  Names of new files are all that comes to the driver."""
        new, have = source_files(spark, files), self._states(spark)
        if have is not None:
            new = new.join(have.select("source").distinct(), "source", "left_anti")
        paths = [r.path for r in new.select("path").collect()]
        return self.read_files(spark, paths).withColumn("source", _identity()) if paths else None

    def refresh(self, spark: SparkSession, files: str | Sequence[str]) -> Refresh:
        """Bring the state up to date with ``files``; reads new and changed files only."""
        rows = self.delta(spark, files)
        if rows is None:
            return Refresh(0, 0)
        seen = Observation()
        n = len(rows.inputFiles())
        partial = self._partial(rows.observe(seen, F.count(F.lit(1)).alias("rows")))
        (partial.repartition("source").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("source").parquet(self.path))
        return Refresh(n, int(seen.get["rows"]))

    def read(self, spark: SparkSession, files: str | Sequence[str]) -> DataFrame:
        """The aggregate over those of ``files`` that have been refreshed."""
        states = self._states(spark)
        if states is None:
            raise ValueError(f"no state at {self.path}: refresh first")
        return self._merged(states.join(source_files(spark, files).select("source"), "source", "left_semi"))

    def rebuilt(self, spark: SparkSession, files: str | Sequence[str]) -> DataFrame:
        """The same aggregate straight from all rows."""
        paths = [r.path for r in source_files(spark, files).select("path").collect()]
        return self._merged(self._partial(self.read_files(spark, paths).withColumn("source", F.lit(""))))


class DistinctTable:
    """Exact distinct counts of whole-number columns by day, kept as bitmaps.

    A value's bucket and its bit follow from the value, so a bitmap of 4 KB holds 32,768
    neighbouring ids; bitmaps of days (and of appended states) combine by OR.  NULL values
    do not count; rows without a day count over all time only.
    """

    def __init__(self, path: str):
        self.path = path

    @staticmethod
    def states(df: DataFrame, day: Column, cols: dict[str, Column]) -> DataFrame:
        """(column, day, bucket, bitmap): one pass over the rows for all columns.  Equal values
        of a day are put together by hash first (on the map side too, so that a hot day or
        value sends one row a task) and dealt by bitmap: each bitmap is made once, and what
        its aggregate sorts is distinct values, never bitmaps of many tasks."""
        each = F.explode(F.array(*[F.struct(F.lit(n).alias("column"), c.cast("bigint").alias("value")) for n, c in cols.items()]))
        rows = df.select(day.cast("date").alias("day"), each.alias("x")).filter(F.col("x.value").isNotNull())
        once = rows.select(F.col("x.column").alias("column"), "day", F.col("x.value").alias("value")).distinct()
        value = F.col("value")
        dealt = once.withColumn("bucket", F.bitmap_bucket_number(value)).repartition("column", "day", "bucket")
        return (dealt.groupBy("column", "day", "bucket")
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bitmap")))

    def append(self, df: DataFrame, day: Column, cols: dict[str, Column]) -> None:
        """Add rows, such as a new file's; rows seen before change nothing."""
        self.states(df, day, cols).write.mode("append").partitionBy("column").parquet(self.path)

    def count(self, spark: SparkSession, column: str, lo: str | None = None, hi: str | None = None,
              alias: str = "n") -> DataFrame:
        """Distinct values of ``column`` over the days from ``lo`` to ``hi`` (both included)."""
        states = spark.read.parquet(self.path).filter(F.col("column") == column)
        if lo is not None:
            states = states.filter(F.col("day") >= F.lit(lo).cast("date"))
        if hi is not None:
            states = states.filter(F.col("day") <= F.lit(hi).cast("date"))
        merged = states.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        return merged.agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).cast("bigint").alias(alias))


def scratch_distinct(df: DataFrame, day: Column, cols: dict[str, Column]) -> DistinctTable:
    """A distinct table of ``df`` under the shared folder."""
    table = DistinctTable(scratch_path(df.sparkSession, "distinct"))
    table.append(df, day, cols)
    return table
