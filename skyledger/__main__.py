"""Command line: ``python -m skyledger <job>`` or ``spark-submit skyledger/__main__.py <job>``.

Names and locations come from ``spark.skyledger.*`` session settings (see
``LakeConfig``) or from the options below, which win.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from skyledger.config import BATCH_LAYERS, STREAM_LAYERS, Horizon, LakeConfig
from skyledger.plans import batch
from skyledger.session import build_session, stream_session
from skyledger.sources import csv_files, generators, streams, tables
from skyledger.streaming import jobs


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def _source(spark: SparkSession, args: argparse.Namespace):
    return streams.read_events(
        spark, args.format, path=args.path, **_options(args.option)
    )


def _horizon(args: argparse.Namespace) -> Horizon | None:
    if args.keep_finished is None:
        return None
    silent = args.keep_silent
    return Horizon(
        dt.timedelta(hours=args.keep_finished), None if silent is None else dt.timedelta(hours=silent)
    )


def _follow_bronze(spark: SparkSession, cfg: LakeConfig, args: argparse.Namespace):
    bronze = cfg.table_name("bronze", stream=True)
    return streams.follow_table(stream_session(spark), bronze, **_options(args.follow))


def setup(spark, cfg, args):
    print("\n".join(tables.create_schemas(spark, cfg)))


def run_batch(spark, cfg, args):
    print("unreadable cells:", batch.run(spark, cfg, args.csv))


def run_bronze(spark, cfg, args):
    target = cfg.table_name("bronze", stream=True)
    checkpoint = cfg.checkpoint("bronze")
    jobs.start_bronze(
        _source(spark, args), target, checkpoint, fmt=cfg.table_format, every=args.every
    ).awaitTermination()


def run_silver(spark, cfg, args):
    target = cfg.table_name("silver", stream=True)
    checkpoint = cfg.checkpoint("silver")
    jobs.start_silver(
        _follow_bronze(spark, cfg, args), target, checkpoint, fmt=cfg.table_format, every=args.every
    ).awaitTermination()


def run_gold(spark, cfg, args):
    jobs.start_gold(
        _follow_bronze(spark, cfg, args),
        cfg.table_name("silver"),
        cfg.table_name("gold", stream=True),
        cfg.checkpoint("gold"),
        rules=cfg.rules,
        side=args.side,
        fmt=cfg.table_format,
        every=args.every,
    ).awaitTermination()


def run_current(spark, cfg, args):
    jobs.start_current(
        _follow_bronze(spark, cfg, args),
        cfg.table_name("gold", stream=True, table=jobs.CURRENT_TABLE),
        cfg.checkpoint("current"),
        stateful=args.stateful,
        fmt=cfg.table_format,
        every=args.every,
        horizon=_horizon(args),
    ).awaitTermination()


def run_rejects(spark, cfg, args):
    target = cfg.table_name("silver", stream=True, table=jobs.REJECTS_TABLE)
    checkpoint = cfg.checkpoint("rejects")
    jobs.start_rejects(
        _follow_bronze(spark, cfg, args), target, checkpoint, fmt=cfg.table_format, every=args.every
    ).awaitTermination()


def run_stream(spark, cfg, args):
    session = stream_session(spark)
    for query in jobs.start_all(
        session,
        cfg,
        _source(session, args),
        side=args.side,
        every=args.every,
        follow=_options(args.follow),
    ):
        query.awaitTermination()


def run_merge(spark, cfg, args):
    taken = jobs.merge_gold(
        spark,
        cfg.table_name("silver"),
        cfg.table_name("gold", stream=True),
        cfg.table_name("gold", stream=True, table=jobs.MERGED_TABLE),
        f"{cfg.checkpoint('merge')}_staging",
        side=args.side,
        fmt=cfg.table_format,
    )
    print("merged batches:", taken)


def run_summary(spark, cfg, args):
    gold = cfg.table_name("gold", stream=True)
    merged = cfg.table_name("gold", stream=True, table=jobs.MERGED_TABLE)
    summary = cfg.table_name("gold", stream=True, table=jobs.SUMMARY_TABLE)
    if spark.catalog.tableExists(merged):
        jobs.store_summary(spark, merged, summary, cfg.table_format, merged=True)
    else:
        jobs.store_summary(spark, gold, summary, cfg.table_format)


def run_sweep(spark, cfg, args):
    layers = [(name, False) for name in BATCH_LAYERS] + [(name, True) for name in STREAM_LAYERS]
    for schema in (cfg.schema(layer, stream=stream) for layer, stream in layers):
        for one in spark.catalog.listTables(schema):
            if not one.isTemporary:
                removed = tables.sweep(spark, f"{schema}.{one.name}", args.grace)
                print(f"{schema}.{one.name}: {len(removed)} folders removed")


def run_compact(spark, cfg, args):
    name = cfg.table_name("gold", stream=True, table=jobs.CURRENT_TABLE)
    print("merged into batch", jobs.compact_current(spark, name, cfg.table_format, _horizon(args)))


def run_flights(spark, cfg, args):
    csv_files.write_flights(generators.generate_flights(spark, args.rows, args.seed), args.csv)


def run_events(spark, cfg, args):
    flights = csv_files.read_flights(spark, args.csv)
    how = {"damaged_per_mille": args.damaged, "seed": args.seed}
    if args.events is None:
        events = generators.events_for(flights, mean=args.mean, **how)
    else:
        events = generators.generate_events(
            spark, args.events, flights, heavy_per_mille=args.heavy, **how
        )
    events.write.mode("append").parquet(args.path)


def run_teardown(spark, cfg, args):
    removed = batch.teardown(spark, cfg, tables_to_drop=args.table, paths=args.path)
    print("deleted:", removed)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="skyledger", description=__doc__)
    top.add_argument("--root", help="shared folder for schemas and checkpoints")
    top.add_argument("--catalog")
    top.add_argument("--stream-catalog")
    top.add_argument("--table-format")
    top.add_argument("--master")
    sub = top.add_subparsers(dest="job", required=True)

    def job(name, run, text):
        one = sub.add_parser(name, help=text)
        one.set_defaults(run=run)
        return one

    def stream(name, run, text):
        one = job(name, run, text)
        one.add_argument("--every", help="trigger interval; without it, take what is there and end")
        return one

    job("setup", setup, "create the schemas")
    job("batch", run_batch, "CSV to bronze, silver and gold").add_argument("csv")
    bronze = stream("bronze", run_bronze, "event source to streaming bronze")
    silver = stream("silver", run_silver, "streaming bronze to parsed events")
    rejects = stream("rejects", run_rejects, "streaming bronze to unreadable events")
    gold = stream("gold", run_gold, "streaming bronze to joined states")
    everything = stream("stream", run_stream, "all streaming jobs in one application")
    for one in (bronze, everything):
        one.add_argument("--format", default="parquet")
        one.add_argument("--path")
        one.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    for one in (gold, everything):
        one.add_argument("--side", choices=sorted(jobs.SIDES), default="active")
    current = stream("current", run_current, "streaming bronze to the current-state log")
    for one in (silver, rejects, gold, current, everything):
        one.add_argument(
            "--follow", action="append", default=[], metavar="KEY=VALUE",
            help="reading option of the jobs behind bronze, such as maxFilesPerTrigger=N",
        )
    current.add_argument("--stateful", action="store_true")
    merge = job("merge", run_merge, "merge the batches of joined states into a table of current rows")
    merge.add_argument("--side", choices=sorted(jobs.SIDES), default="active")
    sweep = job("sweep", run_sweep, "remove the rows that loads and batches left behind")
    sweep.add_argument("--grace", type=float, default=tables.GRACE_SECONDS, help="seconds they are kept for readers")
    job("summary", run_summary, "store the dashboard's summary of the joined states")
    compact = job("compact", run_compact, "merge the current-state log")
    for one in (current, compact):
        one.add_argument("--keep-finished", type=float, help="hours that finished flights stay in the state")
        one.add_argument("--keep-silent", type=float, help="hours that other flights stay without an event")
    flights = job("make-flights", run_flights, "write generated flights")
    flights.add_argument("csv")
    flights.add_argument("--rows", type=int, default=10_000)
    events = job("make-events", run_events, "write generated events of a CSV's flights")
    events.add_argument("csv")
    events.add_argument("path")
    events.add_argument("--damaged", type=int, default=0, help="events per thousand with a fault")
    events.add_argument("--mean", type=int, default=2, help="mean number of events of a flight")
    events.add_argument("--events", type=int, help="number of events, of random flights")
    events.add_argument("--heavy", type=int, default=0, help="events per thousand of one flight")
    for one in (flights, events):
        one.add_argument("--seed", type=int, default=42)
    gone = job("teardown", run_teardown, "drop tables and delete paths below the root")
    gone.add_argument("--table", action="append", default=[])
    gone.add_argument("--path", action="append", default=[])
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session("skyledger", master=args.master)
    given = {
        name: getattr(args, name)
        for name in ("root", "catalog", "stream_catalog", "table_format")
        if getattr(args, name) is not None
    }
    args.run(spark, LakeConfig.from_session(spark, **given), args)


if __name__ == "__main__":
    main()
