"""Structured Streaming jobs (T1-T11) and stream sinks.

Sources are JSON messages: a Kafka topic on a cluster (``read_json_stream``
with ``kafka`` options), a folder of JSON-line files in tests.  Both feed the
same decoder.  Event time gets a watermark (bounded lateness); windowed
counts run in append mode, so a window is emitted once, when the watermark
passes its end, and rows later than that are dropped (T10).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from farebox.functions.columns import epoch_ms_to_ts


def select_existing(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Keep the listed columns that exist, in list order."""
    have = set(df.columns)
    return df.select(*[c for c in cols if c in have])


# ------------------------------------------------------------------ sources

def read_json_stream(spark: SparkSession, source: dict, schema: T.StructType,
                     starting: str = "earliest") -> DataFrame:
    """A stream of JSON messages decoded with ``schema``.

    ``source`` is ``{"kafka": {...options}, "topic": name}`` on a cluster or
    ``{"path": folder}`` for JSON-line files.  ``starting`` is earliest or
    latest (Kafka only; a file source always starts from the files it finds).
    """
    if "kafka" in source:
        raw = (spark.readStream.format("kafka").options(**source["kafka"])
               .option("subscribe", source["topic"])
               .option("startingOffsets", starting).load()
               .select(F.col("value").cast("string").alias("value")))
    else:
        opts = {k: v for k, v in source.items() if k != "path"}
        raw = spark.readStream.options(**opts).text(source["path"])
    return decode_json(raw, schema)


def decode_json(raw: DataFrame, schema: T.StructType, col: str = "value") -> DataFrame:
    """JSON text -> typed columns (fields that do not parse become NULL)."""
    return raw.select(F.from_json(F.col(col), schema).alias("m")).select("m.*")


# ------------------------------------------------------------------ decoders

def decode_test_events(df: DataFrame, ms_col: str = "event_timestamp",
                       out: str = "event_watermark") -> DataFrame:
    """Event time from epoch milliseconds (sent as a float)."""
    return df.withColumn(out, epoch_ms_to_ts(ms_col))


def decode_green_trips(df: DataFrame, fmt: str = "yyyy-MM-dd HH:mm:ss",
                       cols: Sequence[str] = ("lpep_pickup_datetime",
                                              "lpep_dropoff_datetime")) -> DataFrame:
    """Text timestamps parsed with a pattern (TO_TIMESTAMP); bad text -> NULL."""
    return df.withColumns({c: F.try_to_timestamp(F.col(c), F.lit(fmt)) for c in cols})


def with_watermark(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Bounded lateness.  The column must be TIMESTAMP (not NTZ)."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, delay)


# ------------------------------------------------------------------ windows (T4 T5)

def tumbling_counts(events: DataFrame, ts: str, key: str, size: str = "1 minute",
                    delay: str = "1 second", start_col: str = "event_hour",
                    count_col: str = "num_hits") -> DataFrame:
    """T4: count per (tumbling window start, key); the window start is named
    ``event_hour`` as in the reference sink."""
    w = with_watermark(events, ts, delay)
    return (w.groupBy(F.window(ts, size), F.col(key))
            .agg(F.count(F.lit(1)).alias(count_col))
            .select(F.col("window.start").alias(start_col), key, count_col))


def session_counts(trips: DataFrame, ts: str, keys: Sequence[str], gap: str = "5 minutes",
                   delay: str = "5 seconds", count_col: str = "longest_streak") -> DataFrame:
    """T5: events per (keys, session) where a session closes after ``gap``
    without events.  Do not filter on ``session_window`` columns in the same
    query (the filter would be evaluated before sessions are merged); filter
    the sink or inside ``foreachBatch``."""
    w = with_watermark(trips, ts, delay)
    return (w.groupBy(*[F.col(k) for k in keys], F.session_window(ts, gap))
            .agg(F.count(F.lit(1)).alias(count_col))
            .select(*keys, F.col("session_window.start").alias("session_start"),
                    F.col("session_window.end").alias("session_end"), count_col))


# ------------------------------------------------------------------ pass-through

def passthrough_events(df: DataFrame) -> DataFrame:
    """Test events with the epoch converted to a timestamp."""
    return df.select("test_data", epoch_ms_to_ts("event_timestamp").alias("event_timestamp"))


GREEN_TRIP_COLUMNS = [
    "VendorID", "lpep_pickup_datetime", "lpep_dropoff_datetime", "store_and_fwd_flag",
    "RatecodeID", "PULocationID", "DOLocationID", "passenger_count", "trip_distance",
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
    "improvement_surcharge", "total_amount", "payment_type", "trip_type",
    "congestion_surcharge",
]


def passthrough_trips(df: DataFrame, cols: Sequence[str] = GREEN_TRIP_COLUMNS) -> DataFrame:
    """Explicit 20-column projection of the green-trip messages."""
    return df.select(*cols)


# ------------------------------------------------------------------ sinks

def publish_json(df: DataFrame, target: dict, key: str | None = None,
                 compression: str = "gzip") -> None:
    """Every row as one JSON message (``to_json(struct(*))``).

    ``target`` is ``{"kafka": {...}, "topic": name}`` or ``{"path": folder}``;
    message files are written compressed (``compression``), which the text
    and stream readers decode by extension.
    """
    cols = [c for c in df.columns]
    msg = df.select(*([F.col(key).cast("string").alias("key")] if key else []),
                    F.to_json(F.struct(*cols)).alias("value"))
    if "kafka" in target:
        (msg.write.format("kafka").options(**target["kafka"])
         .option("topic", target["topic"]).save())
    else:
        (msg.select("value").write.mode("append").option("compression", compression)
         .text(target["path"]))


def _ntz(df: DataFrame) -> DataFrame:
    """Store stream timestamps as wall-clock values (UTC session)."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
                       for f in df.schema])


class AppendSink:
    """Append each micro-batch to a Parquet folder, idempotently.

    Batch ``b`` is written to ``<path>/batch_id=<b>`` with overwrite, so a
    batch replayed after a failure replaces its own output instead of adding
    a second copy.  For JDBC pass ``jdbc`` options instead of a folder; a
    JDBC append is at-least-once (a replayed batch is inserted again), as
    with the reference's plain JDBC sink.
    """

    def __init__(self, path: str | None = None, jdbc: dict | None = None):
        self.path, self.jdbc = path, jdbc

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        out = _ntz(batch)
        if self.jdbc is not None:
            out.write.format("jdbc").options(**self.jdbc).mode("append").save()
            return
        # Rebalance: a stateful stream emits one partition per state partition;
        # AQE merges them into a few advisory-size files per batch.
        out.hint("rebalance").write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop("batch_id")


class UpsertSink:
    """Keep one row per primary key, written as table versions.

    Each micro-batch reads the current version, lets the batch rows win
    (``keep='last'``, latest ``order_col`` within the batch) or keeps the row
    with the largest ``value_col`` (``keep='max'``), and writes version
    ``v=<batch_id>``; readers take the highest complete version, listed in
    ``_versions``.  A replayed batch rewrites the same version.  The rewrite
    is a shuffle on the key; it suits sinks whose key space is bounded (zone
    pairs), not ever-growing keys, which belong in an AppendSink.

    ``buckets=N`` is the layout for large key spaces: the table lives in N
    hash buckets of the key (``_bucket=<b>`` folders), each batch reads and
    rewrites only the buckets its keys fall in (a broadcast bucket list prunes
    the read; dynamic partition overwrite replaces just those folders).  The
    merged rows are checkpointed first, so the job never reads what it
    replaces, and a replayed batch merges into its own result again, which
    changes nothing.
    """

    def __init__(self, path: str | None, keys: Sequence[str], keep: str = "last",
                 order_col: str | None = None, value_col: str | None = None,
                 jdbc: dict | None = None, buckets: int | None = None):
        if keep not in ("last", "max"):
            raise ValueError("keep is 'last' or 'max'")
        if path is None and jdbc is None:
            raise ValueError("give a folder or jdbc options")
        if buckets and jdbc is not None:
            raise ValueError("buckets apply to a folder table")
        self.path, self.keys, self.keep = (path or "").rstrip("/"), list(keys), keep
        self.order_col, self.value_col, self.jdbc = order_col, value_col, jdbc
        self.buckets = buckets

    def _best(self, rows: DataFrame) -> DataFrame:
        """One row per key among ``rows`` (which carry ``__prio``: 1 = batch)."""
        if self.keep == "max":
            rank = [F.col(self.value_col).desc_nulls_last(), F.col("__prio").desc()]
        else:
            rank = [F.col("__prio").desc()]
            if self.order_col:
                rank.append(F.col(self.order_col).desc_nulls_last())
        # ties are settled by all other columns, so a replay picks the same row
        rank += [F.col(c).desc_nulls_last() for c in sorted(rows.columns) if c not in (*self.keys, "__prio")]
        w = Window.partitionBy(*self.keys).orderBy(*rank)
        return (rows.withColumn("__rn", F.row_number().over(w))
                .filter(F.col("__rn") == 1).drop("__rn", "__prio"))

    def _merge_buckets(self, batch: DataFrame) -> None:
        from farebox.session import cut_lineage
        spark = batch.sparkSession
        new = _ntz(batch).withColumn("_bucket", self._bucket()).withColumn("__prio", F.lit(1))
        current = self._read_bucketed(spark)
        if current is not None:
            touched = F.broadcast(new.select("_bucket").distinct())  # at most ``buckets`` rows
            old = current.join(touched, "_bucket", "left_semi").withColumn("__prio", F.lit(0))
            new = new.unionByName(old)
        merged = cut_lineage(self._best(new))
        (merged.hint("rebalance", "_bucket").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy("_bucket").parquet(f"{self.path}/table"))

    def _log(self) -> str:
        return f"{self.path}/_versions"

    def _versions(self, spark: SparkSession) -> list[int]:
        """The committed versions still kept, ascending."""
        try:
            rows = spark.read.text(self._log()).select(F.col("value").cast("int").alias("v")).distinct()
        except AnalysisException:
            return []
        return sorted(r["v"] for r in rows.orderBy(F.desc("v")).limit(2 * self.KEEP_VERSIONS).collect())

    KEEP_VERSIONS = 3

    def _drop_old(self, spark: SparkSession, versions: list[int]) -> None:
        for v in versions[:-self.KEEP_VERSIONS]:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v={v}")
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets))

    def _read_bucketed(self, spark: SparkSession) -> DataFrame | None:
        try:
            return spark.read.parquet(f"{self.path}/table")
        except AnalysisException:
            return None

    def read(self, spark: SparkSession) -> DataFrame | None:
        if self.buckets:
            t = self._read_bucketed(spark)
            return None if t is None else t.drop("_bucket")
        if self.jdbc is not None:
            try:
                df = spark.read.format("jdbc").options(**self.jdbc).load()
                df.schema  # noqa: B018  (resolves: fails here if the table is missing)
                return df
            except Exception as e:  # noqa: BLE001  the driver's error; only "no such table" is expected
                if not _no_such_table(e):
                    raise
                return None
        v = self._versions(spark)
        return spark.read.parquet(f"{self.path}/v={v[-1]}") if v else None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        """Merge one micro-batch; its rows are computed once."""
        batch = batch.persist()
        try:
            if self.buckets:
                self._merge_buckets(batch)
            elif self.jdbc is not None:
                self._merge_jdbc(batch)
            else:
                self._merge_version(batch, batch_id)
        finally:
            batch.unpersist()

    def _merge_version(self, batch: DataFrame, batch_id: int) -> None:
        """Write version ``batch_id`` from the highest committed one below it: a
        replay never reads the version it rewrites."""
        spark = batch.sparkSession
        versions = self._versions(spark)
        below = [v for v in versions if v < batch_id]
        new = _ntz(batch).withColumn("__prio", F.lit(1))
        if below:
            current = spark.read.parquet(f"{self.path}/v={below[-1]}")
            new = new.unionByName(current.withColumn("__prio", F.lit(0)))
        # row_number() = 1 per key; planned with a partial group limit before
        # the shuffle, so a key repeated many times in a batch stays cheap.
        self._best(new).hint("rebalance").write.mode("overwrite").parquet(f"{self.path}/v={batch_id}")
        if batch_id not in versions:
            spark.createDataFrame([(str(batch_id),)], "value string").write.mode("append").text(self._log())
            self._drop_old(spark, sorted([*versions, batch_id]))

    def _merge_jdbc(self, batch: DataFrame) -> None:
        """Write the batch's best rows to a staging table and upsert them by key in
        the database, in one transaction: target rows are never truncated, a failure
        leaves the target as it was, and a replay merges the same rows again."""
        spark = batch.sparkSession
        best = self._best(_ntz(batch).withColumn("__prio", F.lit(1)))
        target = self.jdbc["dbtable"]
        stage = f"{target}_{uuid.uuid4().hex[:12]}"  # its own for each batch of each stream
        best.write.format("jdbc").options(**{**self.jdbc, "dbtable": stage}).mode("overwrite").save()
        if self.read(spark) is None:
            best.limit(0).write.format("jdbc").options(**self.jdbc).mode("append").save()
        cols = ", ".join(f'"{c}"' for c in best.columns)
        same = " AND ".join(f'(t."{k}" = s."{k}" OR (t."{k}" IS NULL AND s."{k}" IS NULL))' for k in self.keys)
        beats = ""
        if self.keep == "max":
            v = f'"{self.value_col}"'
            beats = f" AND (t.{v} IS NULL OR s.{v} >= t.{v})"
        _in_one_transaction(spark, self.jdbc, [
            f"DELETE FROM {target} AS t WHERE EXISTS (SELECT 1 FROM {stage} AS s WHERE {same}{beats})",
            f"INSERT INTO {target} ({cols}) SELECT {cols} FROM {stage} AS s "
            f"WHERE NOT EXISTS (SELECT 1 FROM {target} AS t WHERE {same})",
        ])
        _in_one_transaction(spark, self.jdbc, [f"DROP TABLE {stage}"])


# SQL states of "table does not exist" (standard, Derby, Postgres).
_NO_TABLE_STATES = ("42S02", "42X05", "42P01")


def _no_such_table(error: Exception) -> bool:
    java = getattr(error, "_origin", None) or getattr(error, "java_exception", None)
    while java is not None:
        state = java.getSQLState() if hasattr(java, "getSQLState") and "SQL" in java.getClass().getName() else None
        if state in _NO_TABLE_STATES:
            return True
        java = java.getCause()
    text = str(error)
    return "does not exist" in text and any(w in text for w in ("Table/View", "relation", "Table "))


def _in_one_transaction(spark: SparkSession, jdbc: dict, statements: Sequence[str]) -> None:
    """Run SQL statements in the database: all of them or none."""
    jvm = spark._jvm
    if jdbc.get("driver"):
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(jdbc["driver"])
    props = jvm.java.util.Properties()
    for k in ("user", "password"):
        if k in jdbc:
            props.setProperty(k, jdbc[k])
    connection = jvm.java.sql.DriverManager.getConnection(jdbc["url"], props)
    try:
        connection.setAutoCommit(False)
        for sql in statements:
            connection.createStatement().executeUpdate(sql)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


# Fixed value: the class of Spark's state store that keeps state on disk.
_DISK_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession, state_partitions: int | None = None, large_state: bool = False,
                   closing_state: bool = False) -> SparkSession:
    """A session of the same application for building streams, with the given session's
    settings and its own on top; the given session's stay as they are.

    ``state_partitions`` sizes the state of windowed aggregates (fixed in the checkpoint at
    the first start and kept on restarts).  ``large_state`` keeps state in RocksDB, off the
    JVM heap, and writes only its changes to each checkpoint.  ``closing_state`` is for large
    state of which a batch closes most: every batch compacts it and writes what is left, so a
    restart replays no windows that closed long ago and a key's lookup passes no marks of them.
    Its rows are not counted in the query's progress, which would look up each window once more
    when it is written and when it closes.
    """
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if own.conf.isModifiable(k):
            own.conf.set(k, v)
    if state_partitions:
        own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    if large_state or closing_state:
        own.conf.set("spark.sql.streaming.stateStore.providerClass", _DISK_STATE)
        changes = "false" if closing_state else "true"
        own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", changes)
    if closing_state:
        own.conf.set("spark.sql.streaming.stateStore.rocksdb.compactOnCommit", "true")
        own.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
    return own


def start(df: DataFrame, sink: Callable[[DataFrame, int], None] | str, checkpoint: str,
          trigger: dict | None = None, output_mode: str = "append",
          name: str | None = None, path: str | None = None) -> StreamingQuery:
    """Start a query with a checkpoint; default trigger every 10 seconds.

    ``sink`` is a ``foreachBatch`` function or a format name (with ``path``).
    Use ``trigger={"availableNow": True}`` to drain what is there and stop.  State is
    configured on the session that ``df`` was built in (``stream_session``).
    """
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"processingTime": "10 seconds"}))
    if name:
        w = w.queryName(name)
    if callable(sink):
        w = w.foreachBatch(sink)
    else:
        w = w.format(sink)
        if path:
            w = w.option("path", path)
    return w.start()


@dataclass(frozen=True)
class Batch:
    """What a micro-batch read, and the rows its windows dropped as late (after partial
    aggregation: one for each window and key of the batch)."""

    batch_id: int
    input_rows: int
    late_rows: int


def progress(query: StreamingQuery) -> dict[int, Batch]:
    """The latest batches of a query, by id."""
    return {p.batchId: Batch(p.batchId, p.numInputRows, sum(o.numRowsDroppedByWatermark for o in p.stateOperators))
            for p in query.recentProgress}


BATCHES_DDL = "query string, batch_id bigint, input_rows bigint, late_rows bigint"


def run_available(df: DataFrame, sink, checkpoint: str, output_mode: str = "append",
                  timeout_s: int | None = None, batches_path: str | None = None) -> list[Batch]:
    """Drain everything currently available (incl. the closing no-data batch
    that emits windows the final watermark has passed), then stop.  There is no time
    limit unless ``timeout_s`` gives one.  Returns the batches, and appends them to the
    table at ``batches_path``, so that what the watermark dropped is on record."""
    q = start(df, sink, checkpoint, trigger={"availableNow": True}, output_mode=output_mode)
    seen: dict[int, Batch] = {}
    until = None if timeout_s is None else time.monotonic() + timeout_s
    try:
        # the query remembers its latest batches only, so they are read while it runs
        while not q.awaitTermination(2):
            seen.update(progress(q))
            if until is not None and time.monotonic() > until:
                raise TimeoutError(f"stream did not finish within {timeout_s}s")
        seen.update(progress(q))
        if q.exception() is not None:
            raise q.exception()
    finally:
        if q.isActive:
            q.stop()
    out = [seen[k] for k in sorted(seen)]
    if batches_path:
        rows = [(str(q.id), b.batch_id, b.input_rows, b.late_rows) for b in out]
        df.sparkSession.createDataFrame(rows, BATCHES_DDL).write.mode("append").parquet(batches_path)
    return out


def late_rows(spark: SparkSession, batches_path: str) -> DataFrame:
    """(query, late_rows): dropped rows of each query on record; a batch that was reported
    twice counts once."""
    once = spark.read.schema(BATCHES_DDL).parquet(batches_path).groupBy("query", "batch_id").agg(F.max("late_rows").alias("n"))
    return once.groupBy("query").agg(F.sum("n").alias("late_rows"))
