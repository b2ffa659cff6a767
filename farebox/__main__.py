"""Command line: the reference's scripted jobs as Spark jobs.

  python -m farebox ingest     --src FILE --url JDBC_URL --table T [--mode replace|append]
  python -m farebox load-month --service yellow --year 2021 --month 3 --src CSV --target DIR
  python -m farebox backfill   --service green --src 'DIR/green_tripdata_2020-*.csv*' --target DIR
  python -m farebox build      --green G --yellow Y --fhv F --zones ZONES_CSV [--as table|view]
  python -m farebox stream     {tumbling,sessions,passthrough} --source DIR | --kafka HOST:PORT
                               --topic T --sink DIR --checkpoint DIR [--available-now]

Inputs may be Parquet or CSV (by extension); ``--master`` overrides the
session master (default: whatever spark-submit provides).
"""

from __future__ import annotations

import argparse
import sys

from farebox import schemas
from farebox.session import get_spark


def _read_any(spark, path: str, schema=None):
    from farebox.sources.files import read_csv, read_parquet
    p = path.lower()
    if ".csv" in p:
        return read_csv(spark, path, schema, repartition=None) if schema is not None else \
            spark.read.option("header", True).csv(path)
    return read_parquet(spark, path)


def cmd_ingest(spark, a):
    from farebox.sources.jdbc import write_jdbc
    df = _read_any(spark, a.src)
    props = {k: v for k, v in (("user", a.user), ("password", a.password),
                               ("driver", a.driver)) if v}
    write_jdbc(df, a.url, a.table, mode=a.mode, props=props, batchsize=a.batchsize)
    print(f"wrote {a.table}")


def cmd_load_month(spark, a):
    from farebox.plans.loads import load_month
    n = load_month(spark, a.service, a.year, a.month, a.src, a.target, width=a.key_fields,
                   binary=a.binary_key)
    print(f"inserted {n} rows")


def cmd_backfill(spark, a):
    from farebox.plans.loads import load_months
    n = load_months(spark, a.service, a.src, a.target, width=a.key_fields,
                   binary=a.binary_key)
    print(f"inserted {n} rows")


def cmd_build(spark, a):
    from farebox.plans.models import build_all
    from farebox.sources.files import read_zones
    out = build_all(_read_any(spark, a.green, schemas.GREEN_RAW),
                    _read_any(spark, a.yellow, schemas.YELLOW_RAW),
                    _read_any(spark, a.fhv, schemas.FHV_RAW),
                    read_zones(spark, a.zones), as_=a.as_, prefix=a.prefix)
    print("built " + ", ".join(out))


def cmd_stream(spark, a):
    from farebox.streaming import jobs as S
    source = ({"kafka": {"kafka.bootstrap.servers": a.kafka}, "topic": a.topic}
              if a.kafka else {"path": a.source})
    jdbc = None
    if a.url:
        jdbc = {"url": a.url, "dbtable": a.table} | {
            k: v for k, v in (("user", a.user), ("password", a.password), ("driver", a.driver)) if v}
    if (a.sink is None) == (jdbc is None) or (a.url and not a.table):
        raise SystemExit("give either --sink or --url with --table")
    if a.job == "tumbling":
        raw = S.read_json_stream(spark, source, schemas.TEST_EVENT, a.starting)
        df = S.tumbling_counts(S.decode_test_events(raw), "event_watermark", "test_data",
                               "1 minute", "1 second")
        sink = S.AppendSink(a.sink, jdbc)
    elif a.job == "sessions":
        raw = S.read_json_stream(spark, source, schemas.GREEN_EVENT, a.starting)
        df = S.session_counts(S.decode_green_trips(raw), "lpep_dropoff_datetime",
                              ["PULocationID", "DOLocationID"], "5 minutes", "5 seconds")
        sink = S.UpsertSink(a.sink, ["PULocationID", "DOLocationID"], keep=a.keep,
                            order_col="session_end", value_col="longest_streak", jdbc=jdbc)
    elif a.job == "trips":
        raw = S.read_json_stream(spark, source, schemas.text_times(schemas.GREEN_RAW), a.starting)
        df = S.passthrough_trips(S.decode_green_trips(raw))
        sink = S.AppendSink(a.sink, jdbc)
    else:
        raw = S.read_json_stream(spark, source, schemas.TEST_EVENT, a.starting)
        df = S.passthrough_events(raw)
        sink = S.AppendSink(a.sink, jdbc)
    if a.available_now:
        S.run_available(df, sink, a.checkpoint)
    else:
        S.start(df, sink, a.checkpoint).awaitTermination()


def main(argv=None):
    ap = argparse.ArgumentParser(prog="farebox", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)

    p = sub.add_parser("ingest")
    p.add_argument("--src", required=True)
    p.add_argument("--url", required=True)
    p.add_argument("--table", required=True)
    p.add_argument("--mode", default="replace", choices=["replace", "append"])
    p.add_argument("--batchsize", type=int, default=100_000)
    p.add_argument("--user")
    p.add_argument("--password")
    p.add_argument("--driver")
    p.set_defaults(fn=cmd_ingest)

    for name, fn in (("load-month", cmd_load_month), ("backfill", cmd_backfill)):
        p = sub.add_parser(name)
        p.add_argument("--service", required=True, choices=["green", "yellow"])
        p.add_argument("--src", required=True)
        p.add_argument("--target", required=True)
        p.add_argument("--key-fields", type=int, default=7, choices=[5, 7])
        p.add_argument("--binary-key", action="store_true")
        if name == "load-month":
            p.add_argument("--year", type=int, required=True)
            p.add_argument("--month", type=int, required=True)
        p.set_defaults(fn=fn)

    p = sub.add_parser("build")
    for k in ("green", "yellow", "fhv", "zones"):
        p.add_argument(f"--{k}", required=True)
    p.add_argument("--as", dest="as_", default="table", choices=["table", "view"])
    p.add_argument("--prefix", default="")
    p.set_defaults(fn=cmd_build)

    p = sub.add_parser("stream")
    p.add_argument("job", choices=["tumbling", "sessions", "passthrough", "trips"])
    p.add_argument("--source")
    p.add_argument("--kafka")
    p.add_argument("--topic")
    p.add_argument("--starting", default="earliest", choices=["earliest", "latest"])
    p.add_argument("--sink")
    for option in ("--url", "--table", "--user", "--password", "--driver"):
        p.add_argument(option)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--keep", default="last", choices=["last", "max"])
    p.add_argument("--available-now", action="store_true")
    p.set_defaults(fn=cmd_stream)

    a = ap.parse_args(argv)
    spark = get_spark(a.master)
    a.fn(spark, a)
    return 0


if __name__ == "__main__":
    sys.exit(main())
