import datetime as dt
import os

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox import schemas
from farebox.streaming import jobs as S
from conftest import write_json_lines

EPOCH = dt.datetime(2024, 1, 1)


def ms(minute, second=0.0):
    return (EPOCH + dt.timedelta(minutes=minute, seconds=second) - dt.datetime(1970, 1, 1)) \
        .total_seconds() * 1000 + 0.5


def run_tumbling(spark, topic, sink_path, ckpt):
    stream = S.read_json_stream(spark, {"path": topic}, schemas.TEST_EVENT)
    agg = S.tumbling_counts(S.decode_test_events(stream), "event_watermark", "test_data",
                            "1 minute", "1 second")
    sink = S.AppendSink(sink_path)
    S.run_available(agg, sink, ckpt)
    return sink


def test_tumbling_window_drops_late_rows_and_restarts(spark, tmp):
    topic = f"{tmp}/topic"
    write_json_lines([{"test_data": 1, "event_timestamp": ms(0, 10)},
                        {"test_data": 1, "event_timestamp": ms(0, 50)},
                        {"test_data": 2, "event_timestamp": ms(1, 5)},
                        {"test_data": 1, "event_timestamp": ms(3, 0)}], topic, "a.json")
    sink = run_tumbling(spark, topic, f"{tmp}/sink", f"{tmp}/ckpt")
    got = sorted((r.event_hour.minute, r.test_data, r.num_hits) for r in sink.read(spark).collect())
    # Window [3,4) is still open: watermark = 3:00 - 1 s.
    assert got == [(0, 1, 2), (1, 2, 1)]
    # Second batch after restart from the checkpoint: a late row for minute 0
    # (dropped) and rows that push the watermark past minute 3.
    write_json_lines([{"test_data": 1, "event_timestamp": ms(0, 20)},
                        {"test_data": 1, "event_timestamp": ms(3, 30)},
                        {"test_data": 1, "event_timestamp": ms(5, 0)}], topic, "b.json")
    sink = run_tumbling(spark, topic, f"{tmp}/sink", f"{tmp}/ckpt")
    got = sorted((r.event_hour.minute, r.test_data, r.num_hits) for r in sink.read(spark).collect())
    assert got == [(0, 1, 2), (1, 2, 1), (3, 1, 2)]


def green_msg(pu, do, dropoff):
    return {"lpep_pickup_datetime": "2019-10-01 00:00:00", "lpep_dropoff_datetime": dropoff,
            "PULocationID": pu, "DOLocationID": do, "passenger_count": "1",
            "trip_distance": 1.0, "tip_amount": 0.0}


def sessions(spark, topic, sink, ckpt):
    stream = S.read_json_stream(spark, {"path": topic}, schemas.GREEN_EVENT)
    agg = S.session_counts(S.decode_green_trips(stream), "lpep_dropoff_datetime",
                           ["PULocationID", "DOLocationID"], "5 minutes", "5 seconds")
    S.run_available(agg, sink, ckpt)
    return sink


def test_session_windows_and_upsert_sinks(spark, tmp):
    topic = f"{tmp}/topic"
    write_json_lines([
        green_msg(1, 2, "2019-10-01 10:00:00"), green_msg(1, 2, "2019-10-01 10:04:00"),
        green_msg(1, 2, "2019-10-01 10:09:00"),            # exactly 5 min later: same session
        green_msg(1, 2, "2019-10-01 11:00:00"),             # new session
        green_msg(3, 4, "2019-10-01 10:01:00"),
        green_msg(3, 4, "2019-10-01 12:00:00"),             # closes at 12:05, still open
    ], topic)
    app = sessions(spark, topic, S.AppendSink(f"{tmp}/all"), f"{tmp}/c1")
    got = sorted((r.PULocationID, r.DOLocationID, r.longest_streak)
                 for r in app.read(spark).collect())
    assert got == [(1, 2, 1), (1, 2, 3), (3, 4, 1)]
    last = sessions(spark, topic, S.UpsertSink(f"{tmp}/last", ["PULocationID", "DOLocationID"],
                                               keep="last", order_col="session_end"), f"{tmp}/c2")
    mx = sessions(spark, topic, S.UpsertSink(f"{tmp}/max", ["PULocationID", "DOLocationID"],
                                             keep="max", value_col="longest_streak"), f"{tmp}/c3")
    as_map = lambda df: {(r.PULocationID, r.DOLocationID): r.longest_streak for r in df.collect()}
    assert as_map(last.read(spark)) == {(1, 2): 1, (3, 4): 1}
    assert as_map(mx.read(spark)) == {(1, 2): 3, (3, 4): 1}


def test_upsert_sink_replays_batch_idempotently(spark, tmp):
    sink = S.UpsertSink(f"{tmp}/u", ["k"], keep="last")
    b0 = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    b1 = spark.createDataFrame([(1, 11)], "k int, v int")
    sink(b0, 0)
    sink(b1, 1)
    sink(b1, 1)  # replay after a failure
    assert sorted(tuple(r) for r in sink.read(spark).collect()) == [(1, 11), (2, 20)]


def test_passthrough_and_json_round_trip(spark, tmp):
    topic = f"{tmp}/topic"
    write_json_lines([{"test_data": 7, "event_timestamp": 1704067207179.575}], topic)
    stream = S.read_json_stream(spark, {"path": topic}, schemas.TEST_EVENT)
    sink = S.AppendSink(f"{tmp}/pass")
    S.run_available(S.passthrough_events(stream), sink, f"{tmp}/ckpt")
    r = sink.read(spark).first()
    assert (r.test_data, r.event_timestamp) == (7, dt.datetime(2024, 1, 1, 0, 0, 7, 179000))
    df = spark.createDataFrame([(1, "a", 2.5)], "id long, s string, x double")
    S.publish_json(df, {"path": f"{tmp}/msgs"})
    back = S.decode_json(spark.read.text(f"{tmp}/msgs"), df.schema)
    assert back.collect() == df.collect()


def test_decoder_text_int_is_null_and_select_existing(spark):
    raw = spark.createDataFrame([('{"PULocationID": "12", "passenger_count": "1"}',)], "value string")
    r = S.decode_json(raw, schemas.GREEN_EVENT).first()
    assert r.PULocationID is None and r.passenger_count == "1"
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert S.select_existing(df, ["b", "zz", "a"]).columns == ["b", "a"]


def test_start_uses_checkpoint(spark, tmp):
    topic = f"{tmp}/topic"
    write_json_lines([{"test_data": 1, "event_timestamp": ms(0)}], topic)
    stream = S.read_json_stream(spark, {"path": topic}, schemas.TEST_EVENT)
    q = S.start(S.passthrough_events(stream), "parquet", f"{tmp}/ckpt",
                trigger={"availableNow": True}, path=f"{tmp}/out")
    q.awaitTermination(120)
    assert os.path.isdir(f"{tmp}/ckpt/offsets")
    assert spark.read.parquet(f"{tmp}/out").count() == 1
    assert spark.read.parquet(f"{tmp}/out").select(F.col("test_data")).first()[0] == 1


def test_stream_sinks_to_embedded_derby(spark, tmp):
    # Embedded, in-process Derby: no server and no port.
    url = f"jdbc:derby:{tmp}/derby;create=true"
    drv = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    topic = f"{tmp}/topic"
    write_json_lines([green_msg(1, 2, "2019-10-01 10:00:00"),
                        green_msg(1, 2, "2019-10-01 10:03:00"),
                        green_msg(5, 6, "2019-10-01 11:00:00"),
                        green_msg(5, 6, "2019-10-01 12:00:00")], topic)
    up = S.UpsertSink(None, ["PULocationID", "DOLocationID"], keep="max",
                      value_col="longest_streak",
                      jdbc={"url": url, "dbtable": "STREAKS", "driver": drv})
    sessions(spark, topic, up, f"{tmp}/c1")
    got = {(r.PULocationID, r.DOLocationID): r.longest_streak for r in up.read(spark).collect()}
    assert got == {(1, 2): 2, (5, 6): 1}
    app = S.AppendSink(jdbc={"url": url, "dbtable": "EVENTS_OUT", "driver": drv})
    stream = S.read_json_stream(spark, {"path": topic}, schemas.GREEN_EVENT)
    S.run_available(S.decode_green_trips(stream), app, f"{tmp}/c2")
    back = spark.read.format("jdbc").options(url=url, dbtable="EVENTS_OUT", driver=drv).load()
    assert back.count() == 4


def test_session_late_row_is_dropped(spark, tmp):
    topic = f"{tmp}/topic"
    write_json_lines([green_msg(1, 2, "2019-10-01 10:00:00"),
                        green_msg(1, 2, "2019-10-01 10:02:00"),
                        green_msg(9, 9, "2019-10-01 12:00:00")], topic, "a.json")
    sink = S.AppendSink(f"{tmp}/s")
    sessions(spark, topic, sink, f"{tmp}/c")
    before = sorted(tuple(r)[:3] + (r.longest_streak,) for r in sink.read(spark).collect())
    # 10:03 belongs to the closed session [10:00, 10:07): the watermark
    # (11:59:55) has passed it, so it is dropped, not merged or re-emitted.
    write_json_lines([green_msg(1, 2, "2019-10-01 10:03:00"),
                        green_msg(9, 9, "2019-10-01 13:00:00")], topic, "b.json")
    sessions(spark, topic, sink, f"{tmp}/c")
    after = sorted(tuple(r)[:3] + (r.longest_streak,) for r in sink.read(spark).collect())
    assert [x for x in before if x[0] == 1] == [x for x in after if x[0] == 1]
    assert [x[-1] for x in after if x[0] == 1] == [2]
    assert sorted(x[-1] for x in after if x[0] == 9) == [1]  # 12:00 closed, 13:00 still open


def test_processing_time_trigger(spark, tmp):
    topic = f"{tmp}/topic"
    write_json_lines([{"test_data": i, "event_timestamp": ms(i)} for i in range(5)], topic)
    stream = S.read_json_stream(spark, {"path": topic}, schemas.TEST_EVENT)
    sink = S.AppendSink(f"{tmp}/out")
    q = S.start(S.passthrough_events(stream), sink, f"{tmp}/ckpt",
                trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
        write_json_lines([{"test_data": 9, "event_timestamp": ms(9)}], topic, "more.json")
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(r.test_data for r in sink.read(spark).collect()) == [0, 1, 2, 3, 4, 9]



def test_bucketed_upsert_rewrites_only_touched_buckets(spark, tmp):
    sink = S.UpsertSink(f"{tmp}/u", ["k"], keep="last", buckets=8)
    b0 = spark.createDataFrame([(k, 0) for k in range(40)], "k int, v int")
    sink(b0, 0)
    folders = lambda: sorted(n for n in os.listdir(f"{tmp}/u/table") if n.startswith("_bucket="))
    stamp = {n: sorted(os.listdir(f"{tmp}/u/table/{n}")) for n in folders()}
    b1 = spark.createDataFrame([(3, 1), (41, 1)], "k int, v int")
    sink(b1, 1)
    sink(b1, 1)  # replay
    got = {r.k: r.v for r in sink.read(spark).collect()}
    assert len(got) == 41 and got[3] == 1 and got[41] == 1 and got[4] == 0
    after = {n: sorted(os.listdir(f"{tmp}/u/table/{n}")) for n in folders()}
    changed = [n for n in after if after[n] != stamp.get(n)]
    assert 1 <= len(changed) <= 2  # only the buckets of keys 3 and 41


def test_upsert_version_replay_and_old_versions(spark, tmp_path):
    sink = S.UpsertSink(str(tmp_path / "t"), ["k"], keep="last")
    for b in range(6):
        sink(spark.createDataFrame([(b % 2, b), (9, b)], "k int, v int"), b)
    sink(spark.createDataFrame([(5 % 2, 5), (9, 5)], "k int, v int"), 5)  # replayed: reads version 4, not itself
    assert sorted(map(tuple, sink.read(spark).collect())) == [(0, 4), (1, 5), (9, 5)]
    assert sorted(p for p in os.listdir(tmp_path / "t") if p.startswith("v=")) == ["v=3", "v=4", "v=5"]


def test_upsert_computes_a_batch_once_and_settles_ties(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    sink = S.UpsertSink(str(tmp_path / "b"), ["k"], keep="max", value_col="v", buckets=4)
    for b in range(2):
        rows = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (2, b, "c")], "k int, v int, x string").coalesce(1)
        before = seen.value
        sink(rows.mapInArrow(count, rows.schema), b)
        assert seen.value - before == 3
    assert sorted(map(tuple, sink.read(spark).collect())) == [(1, 5, "b"), (2, 1, "c")]


def test_jdbc_upsert_keeps_the_target_and_raises_other_errors(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    sink = S.UpsertSink(None, ["k"], keep="max", value_col="v", jdbc={
        "url": url, "dbtable": "streaks", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    for b, rows in enumerate([[(1, 5), (2, 1)], [(1, 3), (3, 7)], [(2, 4)], [(2, 4)]]):
        sink(spark.createDataFrame(rows, "k int, v int"), b)
    assert sorted(map(tuple, sink.read(spark).collect())) == [(1, 5), (2, 4), (3, 7)]
    broken = S.UpsertSink(None, ["k"], jdbc={"url": "jdbc:nothing:here", "dbtable": "t"})
    with pytest.raises(Exception):
        broken.read(spark)


def _minute_counts(stream):
    return S.tumbling_counts(S.decode_test_events(stream), "event_watermark", "test_data", "1 minute", "1 second")


def test_large_state_restarts_from_its_changelog_and_leaves_the_session_alone(spark, tmp):
    import glob
    schema = T.StructType([T.StructField("test_data", T.LongType()), T.StructField("event_timestamp", T.DoubleType())])
    before = dict(spark.conf.getAll)
    own = S.stream_session(spark, state_partitions=2, large_state=True)
    sink = S.AppendSink(f"{tmp}/sink")
    minute = 60_000.0
    late = None
    for n, rows in enumerate(([(1, 0.0), (1, 1000.0), (2, 10_000.0)], [(1, 30_000.0), (2, 5 * minute)], [(1, 9 * minute), (7, 1.0), (7, 2.0)],
                              [(8, 5.0), (1, 20 * minute)])):
        write_json_lines([{"test_data": a, "event_timestamp": t} for a, t in rows], f"{tmp}/topic", f"p{n}.json")
        stream = S.read_json_stream(own, {"path": f"{tmp}/topic"}, schema)
        batches = S.run_available(_minute_counts(stream), sink, f"{tmp}/ckpt", batches_path=f"{tmp}/batches")
        late = S.late_rows(spark, f"{tmp}/batches").agg({"late_rows": "sum"}).first()[0]
        assert sum(b.input_rows for b in batches) == len(rows)
    assert glob.glob(f"{tmp}/ckpt/state/0/0/*.changelog")
    got = {(str(r.event_hour)[14:16], r.test_data): r.num_hits for r in sink.read(spark).collect()}
    # state of the first run was there after each restart: three hits of key 1 in minute 0
    assert got[("00", 1)] == 3 and got[("00", 2)] == 1 and ("00", 7) not in got and ("00", 8) not in got
    # 7 (two rows of one window) and 8 came behind the watermark: one dropped row for each window and key
    assert late == 2
    assert dict(spark.conf.getAll) == before


def test_sliced_stream_makes_its_messages_once(spark):
    from farebox import catalog
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(ms):
        made.add(1)
        return ms
    rows = [(k % 3, ms(k)) for k in range(30)]
    messages = spark.createDataFrame(rows, "test_data long, ms double").select("test_data", seen("ms").alias("event_timestamp"))
    schema = T.StructType([T.StructField("test_data", T.LongType()), T.StructField("event_timestamp", T.DoubleType())])
    sink = catalog._stream_through(spark, "once", messages, schema, _minute_counts, lambda p: S.AppendSink(p),
                                   time_col="event_timestamp", late=True)
    assert made.value == len(rows)
    assert sink.read(spark).count() == 28  # the last two minutes are still open


@pytest.mark.parametrize("query", ["longest_streak", "session_upsert_last"])
def test_sliced_sessions_restart_without_replaying_closed_ones(spark, query):
    import glob
    from farebox import catalog
    from farebox.session import shared_dir
    root = shared_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{root}/sessions-*"))
    rows = catalog.queries()[query](spark, "/root/testdata/sf0.001").collect()
    (run,) = set(glob.glob(f"{root}/sessions-*")) - before
    state = glob.glob(f"{run}/checkpoint/state/0/*/*")
    # every batch left a whole, compacted state: a restart has no changes to replay
    assert rows and not [f for f in state if f.endswith(".changelog")]
    batches = glob.glob(f"{run}/checkpoint/commits/[0-9]*")
    parts = {os.path.dirname(f) for f in state}
    assert all(len(glob.glob(f"{p}/[0-9]*.zip")) == len(batches) for p in parts if os.path.basename(p).isdigit())


def test_closing_state_writes_and_closes_sessions_without_looking_each_up(spark, tmp, monkeypatch):
    queries, begin = [], S.start
    monkeypatch.setattr(S, "start", lambda *a, **k: queries.append(begin(*a, **k)) or queries[-1])
    schema = T.StructType([T.StructField("test_data", T.LongType()), T.StructField("event_timestamp", T.DoubleType())])
    own = S.stream_session(spark, state_partitions=2, closing_state=True)
    sink = S.AppendSink(f"{tmp}/sink")
    minute = 60_000.0
    # the last session of key 1 goes on after the restart
    for n, rows in enumerate(([(1, 0.0), (2, minute), (1, 20 * minute)], [(1, 24 * minute), (3, 60 * minute)], [(3, 90 * minute)])):
        write_json_lines([{"test_data": a, "event_timestamp": t} for a, t in rows], f"{tmp}/topic", f"p{n}.json")
        stream = S.decode_test_events(S.read_json_stream(own, {"path": f"{tmp}/topic"}, schema))
        S.run_available(S.session_counts(stream, "event_watermark", ["test_data"]), sink, f"{tmp}/ckpt")
    got = sorted((r.test_data, r.session_start.minute, r.longest_streak) for r in sink.read(spark).collect())
    assert got == [(1, 0, 1), (1, 20, 2), (2, 1, 1), (3, 0, 1)]
    states = [p.stateOperators[0] for q in queries for p in q.recentProgress if p.stateOperators]
    assert sum(s.customMetrics["rocksdbPutCount"] for s in states) > 0
    assert sum(s.customMetrics["rocksdbGetCount"] for s in states) == 0
