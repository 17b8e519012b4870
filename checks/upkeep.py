"""Tables kept up to date: changed dates, corrections, rejects, compaction, layouts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.gold_serve import _DAILY_JOIN, _RANGE, _line, _related, _rounded, FIRST, LAST, _daily_means
from checks.ingest import _DAILY_SUM, _event_stream
from checks.registry import query
from checks.tables import climate_silver, price_silver, shipment_silver, table
from stratalake.operators.quality import append_absent
from stratalake.plans import bronze, compaction, gold, serve, silver, summaries
from stratalake.plans.refresh import Periods, read_gold, refresh_gold
from stratalake.schemas import PRODUCTION_RECORD
from stratalake.session import work_path
from stratalake.sinks.files import append, overwrite, read_batches
from stratalake.sinks.keyed import append_by_year
from stratalake.sinks.tables import publish_version, write_bucketed
from stratalake.sources.files import read_parquet
from stratalake.sources.streams import parquet_stream
from stratalake.streaming import into_batches, run_to_end, split, start_merge, start_split

# --- gold of changed dates ------------------------------------------------------


@query(_DAILY_SUM)
def q_gold_changed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sums built, then brought up to date after the first day of each month
    came in late: the second run makes those days anew and no others."""
    source, target = work_path(spark, "late-silver"), work_path(spark, "late-gold")
    rain = climate_silver(spark, sf_dir)
    late = F.dayofmonth("data") == 1
    days = Periods("data", "day", ("ano", "mes", "dia"))

    def build(rows: DataFrame) -> DataFrame:
        return gold.daily_total_rain(rows, scale=2)

    for part in (rain.filter(~late), rain.filter(late)):
        append(part, source)
        refresh_gold(spark, source, target, f"{target}-checkpoint", build, days)
    return read_gold(spark, target, ["ano", "mes", "dia", "estado", "precipitacao_total_mm"])


@query("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1
                            ELSE o_totalprice END AS preco
    FROM orders""")
def q_merge_newest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by a stream; those of status F come again with a new price, which
    replaces the first one, and then all come once more as they were at first."""
    sent = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.trunc("o_orderdate", "year").alias("ano"),
        F.col("o_totalprice").alias("preco"),
        F.lit(1).alias("ordem"),
        "o_orderstatus",
    )
    fixed = sent.filter(F.col("o_orderstatus") == "F").withColumn("ordem", F.lit(2))
    fixed = fixed.withColumn("preco", F.col("preco") + 1)
    source, target = work_path(spark, "corrected"), work_path(spark, "corrected-silver")
    for delivery in (sent, fixed, sent):
        append(delivery, source)
        rows = parquet_stream(spark, source, sent.schema)
        start_merge(
            rows, target, f"{target}-checkpoint", ["o_orderkey", "ano"], ["ano"], "ordem", None
        ).awaitTermination()
    return read_parquet(spark, target).select("o_orderkey", "preco")


# --- silver and rejects from one read ---------------------------------------------


def _mixed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message per event: two records, of which some are bad, or no JSON at all."""
    number = F.col("event_id").cast("string")
    kind = F.col("event_id") % 5
    good = F.concat(
        F.lit('{"data":"2015-01-01","unidade_federativa":"'), number, F.lit('","producao":1.5}')
    )

    def two(second: str) -> Column:
        return F.concat(F.lit("["), good, F.lit(f",{second}]"))

    value = (
        F.when(kind == 0, F.concat(F.lit("{"), number))
        .when(kind == 1, two('{"data":"2015-01-01","unidade_federativa":"x","producao":"12,5"}'))
        .when(kind == 2, two('{"data":"2015-01-01","producao":2.5}'))
        .when(kind == 3, two('{"data":"2015-13-01","unidade_federativa":"x","producao":2.5}'))
        .otherwise(F.concat(F.lit("["), good, F.lit("]")))
    )
    return table(spark, sf_dir, "events").select(value.alias("value"), "event_id")


def _split_twice(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """Two deliveries, a batch each: silver, rejects and counts."""
    messages = _mixed_messages(spark, sf_dir)
    source, out = work_path(spark, "mixed"), work_path(spark, "mixed-silver")
    bad, counts = f"{out}-rejects", f"{out}-counts"

    def check(batch: DataFrame) -> DataFrame:
        raw = silver.numbered_records(batch, PRODUCTION_RECORD)
        also = [split.MESSAGE, split.NUMBER, split.SENT, split.TEXTS]
        return silver.production_rows(raw, also=also)

    reason = split.rejection({"data": "data", "producao": "producao"}, ["data", "estado"])
    for half in (0, 1):
        append(messages.filter(F.col("event_id") % 2 == half), source)
        arriving = parquet_stream(spark, source, messages.schema).select("value")
        start_split(
            arriving, check, reason, into_batches(out), bad, f"{out}-checkpoint", counts, None
        ).awaitTermination()
    return out, bad, counts


@query("""
    SELECT '2015-01-01'::DATE AS data, event_id::VARCHAR AS estado, 1.5::DOUBLE AS producao,
           1::BIGINT AS prata
    FROM events WHERE event_id % 5 <> 0
    UNION ALL
    SELECT NULL, (event_id % 5)::VARCHAR, NULL, 0 FROM events WHERE event_id % 5 < 4""")
def q_split_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good records to silver, and each message with a bad one to the rejects, once."""
    out, bad, _ = _split_twice(spark, sf_dir)
    value, motive = F.col("value"), F.col("motivos")[0]
    kind = (
        F.when(motive == split.UNREADABLE, "0").when(motive == split.NO_KEY, "2")
        .when(value.contains("12,5"), "1").when(value.contains("2015-13-01"), "3")
    )
    good = read_batches(spark, out).withColumn("prata", F.lit(1).cast("long"))
    refused = read_batches(spark, bad).select(
        F.lit(None).cast("date").alias("data"), kind.alias("estado"),
        F.lit(None).cast("double").alias("producao"), F.lit(0).cast("long").alias("prata"),
    )
    return good.unionByName(refused)


@query("""
    SELECT CAST(event_id % 2 AS INTEGER) AS lote,
           CAST(SUM(CASE WHEN event_id % 5 IN (0, 4) THEN 1 ELSE 2 END) AS BIGINT) AS entrada,
           COUNT(*) FILTER (WHERE event_id % 5 <> 0) AS prata,
           COUNT(*) FILTER (WHERE event_id % 5 = 0) AS ilegiveis,
           COUNT(*) FILTER (WHERE event_id % 5 = 2) AS sem_chave,
           COUNT(*) FILTER (WHERE event_id % 5 IN (1, 3)) AS valores
    FROM events GROUP BY ALL""")
def q_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per batch: records that came in, silver rows, and rejects by reason."""
    return read_parquet(spark, _split_twice(spark, sf_dir)[2])


# --- bronze in few files ------------------------------------------------------------


@query("""
    SELECT strftime(ts, '%Y-%m-%d') AS dia, COUNT(*) AS mensagens, SUM(event_id)::BIGINT AS soma,
           CAST(SUM(strlen(props)) AS BIGINT) AS bytes
    FROM events GROUP BY ALL""")
def q_compact_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze landed in many files a day, days but the last ones then archived in one
    each, and read from both places."""
    messages = _event_stream(spark, sf_dir).select(
        F.col("props").cast("binary").alias("value"), F.col("event_id").alias("offset"), "ts"
    )
    path = work_path(spark, "many-files")
    kept = bronze.landed(messages.repartition(4), arrived=F.col("ts"))
    run_to_end(kept, path, f"{path}-checkpoint", bronze.INGEST_PARTS, gather=False)
    last = table(spark, sf_dir, "events").agg(F.to_date(F.max("ts")).alias("d")).first()["d"]
    archive = f"{path}-archive"
    compaction.compact_days(spark, path, archive, last - dt.timedelta(days=2))
    rows = compaction.read_bronze(spark, path, archive)
    return rows.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("dia")).agg(
        F.count(F.lit(1)).alias("mensagens"), F.sum("offset").alias("soma"),
        F.sum(F.octet_length("value")).cast("long").alias("bytes"),
    )


# --- layouts and stored figures -------------------------------------------------------


@query(_DAILY_JOIN + """
    SELECT data, estado, precipitacao_media_diaria, preco_medio_dolar
    FROM rain JOIN price USING (data)""")
def q_join_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily gold in tables bucketed by date, which are joined where they lie."""
    path = work_path(spark, "bucketed")
    name = path.rpartition("/")[2].replace("-", "_")
    rain, price = _daily_means(spark, sf_dir)
    return serve.rain_and_price(
        write_bucketed(rain, f"{name}_rain", "data", 8, f"{path}/rain"),
        write_bucketed(price, f"{name}_price", "data", 8, f"{path}/price"),
    )


def _stored_figures(spark: SparkSession, sf_dir: str, state: str | None = None):
    """Rain and price figures kept by date; the prices of every tenth order come late,
    and months they are of are made anew."""
    path = work_path(spark, "figures")
    rain, price = f"{path}-rain", f"{path}-price"
    append(shipment_silver(spark, sf_dir), f"{rain}-silver")
    months = Periods("data", "month", ("ano", "mes"))
    refresh_gold(spark, f"{rain}-silver", rain, f"{rain}-cp", summaries.rain_summaries, months)
    orders = price_silver(spark, sf_dir).withColumn("_late", F.pmod(F.xxhash64("preco"), F.lit(10)) == 0)
    for late in (False, True):
        append(orders.filter(F.col("_late") == late).drop("_late"), f"{price}-silver")
        refresh_gold(
            spark, f"{price}-silver", price, f"{price}-cp", summaries.price_summaries,
            Periods("timestamp", "month", ("ano", "mes")),
        )
    return summaries.RainPriceSummaries(
        read_parquet(spark, rain), read_parquet(spark, price), state, FIRST, LAST
    )


@query(_related(_RANGE) + """
    SELECT ROUND(AVG(precipitacao_total_mm), 2) AS precipitacao_media,
           ROUND(AVG(preco), 2) AS preco_medio
    FROM related""")
def q_summary_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_figures(spark, sf_dir).mean_cards()


@query(_related(_RANGE + " AND estado = 'A'") + _line("preco", "precipitacao_total_mm") + " FROM related")
def q_summary_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_stored_figures(spark, sf_dir, "A").trend_line())


@query("SELECT event_type AS estado, COUNT(*) AS linhas FROM events GROUP BY ALL")
def q_publish_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published table replaced by a new version, after a version that failed."""
    path = work_path(spark, "published")
    name = path.rpartition("/")[2].replace("-", "_")
    counts = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("estado")).agg(
        F.count(F.lit(1)).alias("linhas")
    )
    publish_version(counts.withColumn("linhas", F.lit(0).cast("long")), name, path)
    broken = counts.withColumn("linhas", F.raise_error(F.lit("lost")).cast("long"))
    try:
        publish_version(broken, name, path)
    except Exception as error:  # the failure is the case at hand
        if "lost" not in str(error):
            raise
    if spark.table(name).filter("linhas <> 0").count():
        raise AssertionError("a failed version is shown")
    return publish_version(counts, name, path)


# --- keys ------------------------------------------------------------------------------


@query("""
    SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS chave,
           CAST(o_orderdate AS DATE) AS data, o_totalprice AS preco,
           CAST(year(o_orderdate) AS INTEGER) AS ano
    FROM orders
    UNION
    SELECT NULL, CAST(o_orderdate AS DATE), o_totalprice + 1, CAST(year(o_orderdate) AS INTEGER)
    FROM orders WHERE o_orderstatus = 'P'""")
def q_append_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by key and date, in a table parted by year; status P has no key. Stored
    are half of them; then all come twice, those without a key also at another price.
    Known keys are left out, and a row without one only where an equal one is there."""
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("chave"),
        F.to_date("o_orderdate").alias("data"),
        F.col("o_totalprice").alias("preco"),
    ).distinct()
    path = work_path(spark, "by-year")
    append_by_year(rows.filter(F.pmod(F.xxhash64("preco"), F.lit(2)) == 0), path, ["chave", "data"], "data")
    other = rows.filter(F.col("chave").isNull()).withColumn("preco", F.col("preco") + 1)
    append_by_year(rows.unionByName(rows).unionByName(other), path, ["chave", "data"], "data")
    return read_parquet(spark, path)


@query("""
    SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS chave,
           o_totalprice AS preco
    FROM orders
    UNION
    SELECT NULL, o_totalprice + 1 FROM orders WHERE o_orderstatus = 'P'""")
def q_upsert_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a key neither merge nor repeat; those with one follow it."""
    rows = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("chave"),
        F.col("o_totalprice").alias("preco"),
    ).distinct()
    path = work_path(spark, "null-keys")
    stored = overwrite(rows.filter(F.col("preco") > 150000), path)
    other = rows.filter(F.col("chave").isNull()).withColumn("preco", F.col("preco") + 1)
    append(append_absent(rows.unionByName(rows).unionByName(other), stored, ["chave"]), path)
    return read_parquet(spark, path)
