"""Command line for ``spark-submit`` or ``python -m stratalake.jobs``.

Each command is one stage of the pipeline. Paths may be on any file system that
Spark reads; database and broker settings are passed as ``--option key=value``.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake import schemas
from stratalake.operators.aggregates import row_counts
from stratalake.operators.grid import sample_grid
from stratalake.operators.ordering import first_rows
from stratalake.operators.packing import parts_for
from stratalake.operators.quality import append_absent
from stratalake.operators.sizing import measured_bytes, settled
from stratalake.plans import bronze, compaction, gold, serve, silver, summaries
from stratalake.plans.refresh import Periods, read_silver, refresh_gold
from stratalake.session import build_session
from stratalake.sinks import files, messages, tables
from stratalake.sinks.keyed import append_by_year
from stratalake.sources import dimensions
from stratalake.sources import files as file_sources
from stratalake.sources import streams
from stratalake.sources import tables as table_sources
from stratalake.streaming import (
    drop_replays_stream,
    into_batches,
    into_newest,
    split,
    start_append,
    start_merge,
    start_split,
)


@dataclass(frozen=True)
class SilverJob:
    record: T.StructType
    transform: Callable[..., DataFrame]
    key: tuple[str, ...]
    fields: dict[str, str]  # silver column to the record's field
    partition_by: tuple[str, ...] = ()
    merge_by: tuple[str, ...] = ("data",)  # partitions that follow from the key


@dataclass(frozen=True)
class GoldJob:
    build: Callable[..., DataFrame]
    key: tuple[str, ...]
    order: tuple[str, ...]
    periods: Periods
    partition_by: tuple[str, ...] = ()


SILVER = {
    "climate": SilverJob(
        schemas.CLIMATE_RECORD,
        silver.climate,
        schemas.CLIMATE_KEY,
        {"data": "date", "precipitacao_mm": "precipitation_mm"},
    ),
    "prices": SilverJob(
        schemas.PRICE_RECORD,
        partial(silver.prices, dated=True),
        schemas.PRICE_KEY,
        {"timestamp": "data", "preco": "último"},
        ("data",),
    ),
    "production": SilverJob(
        schemas.PRODUCTION_RECORD,
        silver.production_rows,
        schemas.PRODUCTION_KEY,
        {"data": "data", "producao": "producao"},
        ("data",),
    ),
}
_DAY_OF_RAIN = Periods("data", "day", ("data",))
_DAY_OF_PRICE = Periods("timestamp", "day", ("data",))
_DATE_PARTS = ("ano", "mes", "dia")
GOLD = {
    "monthly-production": GoldJob(
        gold.monthly_production,
        schemas.PRODUCTION_KEY,
        gold.MONTHLY_PRODUCTION_ORDER,
        Periods("data", "month", ("ano", "mes")),
        ("estado",),
    ),
    "daily-mean-rain": GoldJob(
        gold.daily_mean_rain, schemas.CLIMATE_KEY, gold.DAILY_MEAN_RAIN_ORDER, _DAY_OF_RAIN
    ),
    "daily-mean-price": GoldJob(
        gold.daily_mean_price, schemas.PRICE_KEY, gold.DAILY_MEAN_PRICE_ORDER, _DAY_OF_PRICE
    ),
    "daily-total-rain": GoldJob(
        gold.daily_total_rain, schemas.CLIMATE_KEY, gold.DAILY_TOTAL_RAIN_ORDER,
        Periods("data", "day", _DATE_PARTS),
    ),
    "price-rows": GoldJob(
        gold.price_rows, schemas.PRICE_KEY, ("data",), Periods("timestamp", "day", _DATE_PARTS)
    ),
    "rain-summaries": GoldJob(
        summaries.rain_summaries, schemas.CLIMATE_KEY, ("data", "estado"),
        Periods("data", "month", ("ano", "mes")),
    ),
    "price-summaries": GoldJob(
        summaries.price_summaries, schemas.PRICE_KEY, ("data",),
        Periods("timestamp", "month", ("ano", "mes")),
    ),
}
RELATION = {
    "rain-series": serve.RainPriceRelation.rain_series,
    "price-series": serve.RainPriceRelation.price_series,
    "mean-cards": serve.RainPriceRelation.mean_cards,
    "trend-line": serve.RainPriceRelation.trend_line,
    "states": serve.RainPriceRelation.states,
    "date-range": serve.RainPriceRelation.date_range,
}
SUMMARIES = {
    "summary-cards": summaries.RainPriceSummaries.mean_cards,
    "summary-trend": summaries.RainPriceSummaries.trend_line,
}


def load_production(spark: SparkSession, args: argparse.Namespace) -> None:
    """CSV to a table of the source database or of the catalog."""
    clean = silver.clean_production_csv(file_sources.read_production_csv(spark, args.csv))
    if args.option:
        tables.overwrite_jdbc(clean, {**args.option, "dbtable": args.table})
        return
    stored = tables.replace_table(clean, args.table, args.path)
    row_counts(stored).show()
    first_rows(stored).show()


def planned_parts(source: DataFrame, dated: str) -> int:
    """Messages per date that keep those of the largest date within a broker's limit."""
    found = source.groupBy(dated).count().agg(F.max("count"), F.sum("count")).first()
    if not found[1]:
        return 1
    return parts_for(found[0], -(-measured_bytes(source) // found[1]))


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    """A table or CSV as JSON messages, to a topic or to text files."""
    if args.feed == "prices":
        csv = file_sources.read_price_csv(spark, args.source)
        sent = bronze.price_messages(bronze.price_table(csv, not args.newest_first))
    else:
        if args.option:
            source = table_sources.read_jdbc(spark, {**args.option, "dbtable": args.source})
        else:
            source = table_sources.read_table(spark, args.source)
        pack = {"climate": bronze.climate_messages, "production": bronze.production_messages}
        dated = {"climate": "date", "production": "data"}[args.feed]
        args.parts = args.parts or planned_parts(source, dated)
        sent = pack[args.feed](source, parts=args.parts, ordered=True)
    if args.servers:
        messages.publish(sent, args.servers, args.target)
    elif (args.parts or 1) > 1:
        messages.write_table(sent, args.target)
    else:
        messages.write_lines(sent, args.target)


def land(spark: SparkSession, args: argparse.Namespace) -> None:
    """A topic to bronze, payloads unchanged. What text cannot hold goes to
    --quarantine as Parquet, which --as-text therefore needs."""
    if args.as_text and not args.quarantine:
        raise SystemExit("--as-text needs --quarantine")
    arriving = streams.kafka_stream(spark, args.servers, args.topic, **args.option)
    interval = None if args.once else args.interval
    # the source's partitions bound the files, so nothing is shuffled
    running = [
        start_append(
            bronze.landed(arriving, as_text=args.as_text),
            args.bronze,
            args.checkpoint,
            bronze.INGEST_PARTS,
            "text" if args.as_text else "parquet",
            interval,
            gather=False,
        )
    ]
    if args.as_text:
        refused = bronze.landed(bronze.not_text(arriving))
        running.append(
            start_append(
                refused, args.quarantine, f"{args.checkpoint}-quarantine",
                bronze.INGEST_PARTS, interval=interval, gather=False,
            )
        )
    for query in running:
        query.awaitTermination()


def to_silver(spark: SparkSession, args: argparse.Namespace) -> None:
    """Bronze to silver as a stream. With --quarantine, messages that cannot be
    read, and those of records with a bad value or without their key, go there once,
    as they were sent, with the numbers of the bad records, and these not to silver.
    --merge keeps the newest row of each key instead of all of them."""
    job = SILVER[args.table]
    path = f"{args.bronze.rstrip('/')}/{args.glob}" if args.glob else args.bronze
    if args.json:
        arriving = streams.json_stream(spark, path, job.record, args.max_files)
    elif args.landed:
        arriving = streams.parquet_stream(
            spark, path, T.StructType().add("value", T.BinaryType()), args.max_files
        )
    else:
        arriving = streams.text_stream(spark, path, args.max_files)
    extra = {"state_codes": True} if args.state_codes else {}
    interval = None if args.once else args.interval
    layout = job.partition_by if args.partition_by is None else args.partition_by
    if args.merge and args.drop_replays_within:
        raise SystemExit("--merge drops replays whenever they come")

    if args.quarantine and not args.drop_replays_within:
        also = [split.MESSAGE, split.NUMBER, split.SENT, split.TEXTS]

        def check(batch: DataFrame) -> DataFrame:
            raw = silver.numbered_json(batch) if args.json else silver.numbered_records(batch, job.record)
            checked = job.transform(raw, also=also, **extra)
            if args.merge or args.keep_ingest:
                checked = checked.withColumn(schemas.INGEST_TIME, F.current_timestamp())
            return checked

        if args.merge:
            take = into_newest(args.silver, args.checkpoint, job.key, job.merge_by)
        else:
            take = into_batches(args.silver, layout)
        start_split(
            arriving, check, split.rejection(job.fields, job.key), take, args.quarantine,
            args.checkpoint, f"{args.quarantine.rstrip('/')}-contagem", interval,
        ).awaitTermination()
        return
    if args.quarantine:
        # replays are told by a state, which has no place in the query that splits
        raw = silver.checked_records(arriving, job.record)
        checked = job.transform(raw, also=["value", "_texts"], **extra)
        bad = silver.rejected(job.fields, job.key)
        refused = start_append(
            checked.filter(bad).select("value"), args.quarantine,
            f"{args.checkpoint}-quarantine", interval=interval,
        )
        rows = checked.filter(~bad).drop("value", "_texts")
    else:
        refused = None
        raw = arriving.drop(schemas.CORRUPT) if args.json else silver.records(arriving, job.record)
        rows = job.transform(raw, **extra)
    if args.merge:
        query = start_merge(rows, args.silver, args.checkpoint, job.key, job.merge_by, interval=interval)
    else:
        if args.drop_replays_within:
            rows = drop_replays_stream(rows, args.drop_replays_within)
            rows = rows if args.keep_ingest else rows.drop(schemas.INGEST_TIME)
        elif args.keep_ingest:
            rows = rows.withColumn(schemas.INGEST_TIME, F.current_timestamp())
        query = start_append(
            rows, args.silver, args.checkpoint, layout, interval=interval, spread=args.spread
        )
    for running in (refused, query):
        if running is not None:
            running.awaitTermination()


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """Landed days before --before, of many small files, to an archive of few."""
    done = compaction.compact_days(
        spark, args.bronze, args.archive, args.before, args.file_bytes
    )
    print(f"{len(done)} days compacted")


def to_gold(spark: SparkSession, args: argparse.Namespace) -> None:
    """Silver to a gold table: files, and a database table fed from those files.
    With --changes, only the dates that came in since the last run are made anew;
    with --publish, a catalog name shows the former table until the new one is there."""
    job = GOLD[args.table]
    build = partial(job.build, unique_on=job.key, newest_by=args.newest_by)
    if args.changes:
        if args.format != "parquet" or args.publish:
            raise SystemExit("--changes replaces partitions of Parquet files")
        rebuilt = refresh_gold(spark, args.silver, args.gold, args.changes, build, job.periods)
        print(f"{rebuilt} periods rebuilt")
        stored = file_sources.read_parquet(spark, args.gold)
    elif args.publish:
        built = build(read_silver(spark, args.silver))
        stored = tables.publish_version(built, args.publish, args.gold, job.partition_by, args.format)
    else:
        built = build(read_silver(spark, args.silver))
        stored = files.overwrite(built, args.gold, args.format, job.partition_by)
    stored.orderBy(*job.order).show()
    if args.option:
        tables.overwrite_jdbc(stored, args.option)


def load_rain(spark: SparkSession, args: argparse.Namespace) -> None:
    """Yearly grids sampled at the hubs and appended under the key (date, hub). Hubs
    whose nearest cell has no row in a year are reported, not appended."""
    years = range(args.years[0], args.years[1] + 1)
    grid = file_sources.read_grid_years(
        spark, lambda year: args.grid.format(year=year), years
    )
    axes = file_sources.read_parquet(spark, args.axes) if args.axes else None
    if axes is not None:
        every = F.explode(F.array(*map(F.lit, years))).alias("ano")
        axes = axes.select("latitude", "longitude", every)
    found = settled(
        sample_grid(grid, dimensions.hubs(spark), years=years, axes=axes, keep_unmatched=True)
    )
    lost = found.filter(F.col("date").isNull())
    if not lost.isEmpty():
        lost.select("hub", "lat", "lon", "cell_lat", "cell_lon").distinct().orderBy("hub").show()
    rows = silver.station_rows(found.filter(F.col("date").isNotNull()))
    key = schemas.CLIMATE_TABLE_KEY
    if args.by_year:
        append_by_year(rows, args.table_path, key, "date")
        return
    if args.first_load:
        none = rows.limit(0)
        files.append(append_absent(rows, none, key), args.table_path)
        return
    stored = file_sources.read_parquet(spark, args.table_path)
    files.append(append_absent(rows, stored, key), args.table_path)


def answer(spark: SparkSession, args: argparse.Namespace) -> None:
    """A serving query over gold files, written whole to ``--to``. ``--preview``
    also shows its first rows."""

    def read(path: str) -> DataFrame:
        return spark.read.format(args.format).load(path)

    if args.query == "production-series":
        result = serve.production_series(read(args.gold[0]), args.state)
    elif args.query == "production-states":
        result = serve.production_states(read(args.gold[0]))
    elif args.query in SUMMARIES:
        figures = summaries.RainPriceSummaries(
            *map(read, args.gold), args.state, args.first, args.last
        )
        result = SUMMARIES[args.query](figures)
    elif args.query == "points":
        result = serve.rain_price_points(*map(read, args.gold), args.state)
    else:
        relation = serve.RainPriceRelation(
            *map(read, args.gold), args.state, args.first, args.last
        )
        result = RELATION[args.query](relation)
    result.write.mode("overwrite").format(args.format).save(args.to)
    if args.preview:
        read(args.to).show(args.preview, truncate=False)


def _pair(text: str) -> tuple[str, str]:
    key, sign, value = text.partition("=")
    if not sign:
        raise argparse.ArgumentTypeError(f"expected key=value, got {text!r}")
    return key, value


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="stratalake.jobs", description=__doc__)
    commands = root.add_subparsers(dest="command", required=True)

    def command(run: Callable, name: str) -> argparse.ArgumentParser:
        made = commands.add_parser(name, help=run.__doc__)
        made.set_defaults(run=run)
        made.add_argument("--option", type=_pair, action="append", default=[])
        return made

    def streaming(made: argparse.ArgumentParser) -> None:
        made.add_argument("--bronze", required=True)
        made.add_argument("--checkpoint", required=True)
        made.add_argument("--interval", default="2 minutes")
        made.add_argument("--once", action="store_true", help="take what is there and end")

    load = command(load_production, "load-production")
    load.add_argument("--csv", required=True)
    load.add_argument("--table", default="production_data")
    load.add_argument("--path", help="where a catalog table keeps its files")

    send = command(publish, "publish")
    send.add_argument("feed", choices=("climate", "prices", "production"))
    send.add_argument("--source", required=True, help="table, or CSV path for prices")
    send.add_argument("--target", required=True, help="topic, or path without --servers")
    send.add_argument("--servers")
    send.add_argument("--newest-first", action="store_true")
    send.add_argument(
        "--parts", type=int,
        help="messages per date, by default as many as the largest date needs to keep a"
        " message small; several go to files as Parquet, with their numbers",
    )

    capture = command(land, "land")
    streaming(capture)
    capture.add_argument("--servers", required=True)
    capture.add_argument("--topic", required=True)
    capture.add_argument("--as-text", action="store_true")
    capture.add_argument("--quarantine")

    refine = command(to_silver, "silver")
    refine.add_argument("table", choices=sorted(SILVER))
    streaming(refine)
    refine.add_argument("--silver", required=True)
    refine.add_argument("--quarantine")
    refine.add_argument("--json", action="store_true", help="read with the JSON source")
    refine.add_argument("--merge", action="store_true", help="keep the newest row of each key")
    refine.add_argument("--landed", action="store_true", help="bronze is landed Parquet")
    refine.add_argument("--glob", help="read only these files, such as '*/*/*/*.json'")
    refine.add_argument("--max-files", type=int, default=10_000, help="per batch")
    refine.add_argument("--partition-by", nargs="*", help="default: the table's own")
    refine.add_argument("--state-codes", action="store_true", help="production only")
    refine.add_argument("--drop-replays-within", help="such as '2 hours'")
    refine.add_argument("--keep-ingest", action="store_true", help="keep ingest_ts")
    refine.add_argument("--spread", type=int, help="tasks per partition value and batch")

    pack_days = command(compact, "compact")
    pack_days.add_argument("--bronze", required=True)
    pack_days.add_argument("--archive", required=True)
    pack_days.add_argument("--before", type=dt.date.fromisoformat, required=True)
    pack_days.add_argument("--file-bytes", type=int, default=compaction.FILE_BYTES)

    build = command(to_gold, "gold")
    build.add_argument("table", choices=sorted(GOLD))
    build.add_argument("--silver", required=True)
    build.add_argument("--gold", required=True)
    build.add_argument("--format", default="parquet", help="parquet, delta, ...")
    build.add_argument("--changes", help="checkpoint of the dates that are done")
    build.add_argument("--publish", help="name in the catalog")
    build.add_argument("--newest-by", help="column by which a key's last row replaces the others")

    rain = command(load_rain, "load-rain")
    rain.add_argument("--grid", required=True, help="path with {year} in it")
    rain.add_argument("--table-path", required=True)
    rain.add_argument("--first-load", action="store_true")
    rain.add_argument("--by-year", action="store_true", help="keep the table parted by year")
    rain.add_argument(
        "--years", type=int, nargs=2, metavar=("FIRST", "LAST"),
        default=(schemas.GRID_YEARS[0], schemas.GRID_YEARS[-1]),
    )
    rain.add_argument("--axes", help="Parquet with the grid's latitudes and longitudes")

    ask = command(answer, "serve")
    ask.add_argument(
        "query", choices=["production-series", "production-states", "points", *RELATION, *SUMMARIES]
    )
    ask.add_argument("--gold", nargs="+", required=True)
    ask.add_argument("--format", default="parquet")
    ask.add_argument("--state")
    ask.add_argument("--first", type=dt.date.fromisoformat)
    ask.add_argument("--last", type=dt.date.fromisoformat)
    ask.add_argument("--preview", type=int, default=0, help="rows to show")
    ask.add_argument("--to", required=True)
    return root


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.option = dict(args.option)
    args.run(spark or build_session(f"stratalake-{args.command}"), args)


if __name__ == "__main__":
    main()
