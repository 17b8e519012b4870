"""Parsing, packing, landing, streaming, de-duplication and sink queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query
from checks.tables import climate_silver, production_silver, table
from stratalake.functions import (
    date_text,
    day_first_date,
    decimal_comma,
    month_label,
    month_label_date,
    numeric,
    parse_records,
    records_json,
)
from stratalake.operators.grid import sample_grid
from stratalake.operators.packing import pack, unpack
from stratalake.operators.quality import append_absent, drop_incomplete, drop_replays
from stratalake.plans import bronze, gold, silver
from stratalake.schemas import CLIMATE_RECORD, HUBS, PRICE_RECORD, PRODUCTION_RECORD
from stratalake.session import work_path
from stratalake.sinks.files import append, overwrite
from stratalake.sinks.messages import send_in_order, write_lines
from stratalake.sinks.tables import replace_table
from stratalake.sources.files import (
    read_grid_years,
    read_parquet,
    read_price_csv,
    read_production_csv,
)
from stratalake.sources.streams import (
    BRONZE_GLOB,
    json_stream,
    parquet_stream,
    replay_feed,
    text_stream,
)
from stratalake.sources.tables import read_table
from stratalake.sources.dimensions import hubs as hub_table
from stratalake.streaming import drop_replays_stream, run_to_end, start_append

# --- parsing -----------------------------------------------------------------


@query("""
    SELECT o_orderkey, o_totalprice AS simples, o_totalprice AS agrupado FROM orders""")
def q_decimal_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice").cast("decimal(18,2)")
    plain = F.translate(price.cast("string"), ".", ",")
    grouped = F.translate(F.format_number(price, 2), ",.", ".,")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        decimal_comma(plain).alias("simples"),
        decimal_comma(grouped, grouped=True).alias("agrupado"),
    )


@query("""
    SELECT o_orderkey,
           make_date(CAST(2000 + year(o_orderdate) % 100 AS INTEGER),
                     CAST(month(o_orderdate) AS INTEGER), 1) AS data
    FROM orders WHERE o_orderstatus <> 'P'""")
def q_month_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels in lower and upper case; those of status P have a four-digit year."""
    date, status = F.col("o_orderdate"), F.col("o_orderstatus")
    label = (
        F.when(status == "P", F.concat(F.lit("jan/"), F.year(date)))
        .when(status == "F", F.upper(month_label(date)))
        .otherwise(month_label(date))
    )
    dated = table(spark, sf_dir, "orders").select(
        "o_orderkey", month_label_date(label).alias("data")
    )
    return drop_incomplete(dated, ["data"])


@query("""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS data,
           strftime(o_orderdate, '%Y-%m-%d') AS texto
    FROM orders""")
def q_dayfirst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-first dates in six shapes, with short years and times of day among them."""
    date, status = F.col("o_orderdate"), F.col("o_orderstatus")
    odd = F.col("o_orderkey") % 2 == 1
    text = (
        F.when((status == "F") & odd, F.date_format(date, "dd/MM/yy"))
        .when(status == "F", F.date_format(date, "dd/MM/yyyy"))
        .when((status == "O") & odd, F.date_format(date, "dd/MM/yyyy HH:mm"))
        .when(status == "O", F.date_format(date, "dd.MM.yyyy"))
        .when(odd, F.date_format(date, "d/M/yy H:mm:ss"))
        .otherwise(F.date_format(date, "d-M-yyyy"))
    )
    parsed = table(spark, sf_dir, "orders").select("o_orderkey", day_first_date(text).alias("data"))
    return parsed.withColumn("texto", date_text(F.col("data")))


def _amount_text() -> Column:
    """Quantities as text, some of them junk or blank."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return (
        F.when((flag == "N") & (status == "F"), F.lit("n/d"))
        .when((flag == "R") & (status == "O"), F.lit(None))
        .otherwise(F.col("l_quantity").cast("string"))
    )


_GOOD_AMOUNT = """
    NOT (l_returnflag = 'N' AND l_linestatus = 'F')
    AND NOT (l_returnflag = 'R' AND l_linestatus = 'O')"""


@query(f"""
    SELECT l_orderkey, l_linenumber, l_quantity AS producao FROM lineitem
    WHERE {_GOOD_AMOUNT}""")
def q_clean_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", numeric(_amount_text()).alias("producao")
    )
    return drop_incomplete(parsed, ["producao"])


@query(f"""
    SELECT make_date(CAST(2000 + year(l_shipdate) % 100 AS INTEGER),
                     CAST(month(l_shipdate) AS INTEGER), 1) AS data,
           CASE WHEN l_linenumber % 3 = 0
                THEN 'Ba "' || l_returnflag || '", ' || l_linestatus || ' y'
                WHEN l_linenumber % 3 = 1 THEN l_returnflag || chr(10) || l_linestatus
                ELSE l_returnflag END AS unidade_federativa,
           l_quantity AS producao
    FROM lineitem WHERE {_GOOD_AMOUNT}""")
def q_production_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV with a header, read as text, checked and cleaned. States hold doubled
    quotes, commas and line breaks."""
    path = work_path(spark, "production-csv")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    state = (
        F.when(
            F.col("l_linenumber") % 3 == 0,
            F.concat(F.lit('Ba "'), flag, F.lit('", '), status, F.lit(" y")),
        )
        .when(F.col("l_linenumber") % 3 == 1, F.concat(flag, F.lit("\n"), status))
        .otherwise(flag)
    )
    table(spark, sf_dir, "lineitem").select(
        month_label(F.col("l_shipdate")).alias("data"),
        state.alias("unidade_federativa"),
        _amount_text().alias("producao"),
    ).write.option("header", True).option("escape", '"').csv(path)
    return silver.clean_production_csv(read_production_csv(spark, path, multi_line=True))


# --- packing -----------------------------------------------------------------

# Messages of a date, so that one date with much of the table is not one message.
PARTS = 50


def _packed_events(spark: SparkSession, sf_dir: str, parts: int) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("data"), "event_id", "event_type", "value"
    )
    return pack(events, ["data"], unique_on=["event_id"], parts=parts)


@query("""
    SELECT CAST(ts AS DATE) AS data, event_id, event_type, value FROM events""")
def q_pack_unpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four parts a day and many, half of the events each."""
    back = []
    for parts in (PARTS, 4):
        packed = _packed_events(spark, sf_dir, parts)
        record = packed.schema["registros"].dataType.elementType
        text = packed.select(
            "data", "parte", "partes", "linhas", records_json("registros").alias("value")
        )
        again = text.withColumn("registros", parse_records("value", record))
        back.append(
            unpack(again, complete_by=["data"], checked=False).filter(F.col("event_id") % 2 == int(parts == PARTS))
        )
    return back[0].unionByName(back[1])


@query("""
    SELECT CAST(ts AS DATE) AS data, COUNT(*) AS linhas, 3::BIGINT AS partes,
           3::BIGINT AS mensagens
    FROM events GROUP BY ALL""")
def q_pack_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each packed day, and its messages: as many for every day."""
    return (
        _packed_events(spark, sf_dir, 3)
        .groupBy("data")
        .agg(
            F.sum("linhas").alias("linhas"),
            F.max("partes").alias("partes"),
            F.count(F.lit(1)).alias("mensagens"),
        )
    )


@query("""
    SELECT l_returnflag AS estado, l_linestatus AS situacao, l_quantity AS producao
    FROM lineitem""")
def q_pack_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a key, nearly all of them copies, dealt out in turn."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("estado"),
        F.col("l_linestatus").alias("situacao"),
        F.col("l_quantity").alias("producao"),
    )
    return unpack(pack(rows, ["estado"], parts=50), complete_by=["estado"], checked=False)


# --- bronze and streams ------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream; a glob, as the source takes no single file."""
    schema = table(spark, sf_dir, "events").schema
    return parquet_stream(spark, f"{sf_dir}/events*.parquet", schema)


def _run(df: DataFrame, label: str, partition_by=(), fmt="parquet", gather=True) -> str:
    path = work_path(df.sparkSession, label)
    run_to_end(df, path, f"{path}-checkpoint", partition_by, fmt, gather)
    return path


@query("""
    SELECT strftime(ts, '%Y') AS ano, strftime(ts, '%m') AS mes, strftime(ts, '%d') AS dia,
           COUNT(*) AS mensagens, CAST(SUM(strlen(props) + 1) AS BIGINT) AS bytes,
           MIN(event_id) AS primeira, MAX(event_id) AS ultima
    FROM events GROUP BY ALL""")
def q_land_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads captured as they are, line breaks too, by day of arrival."""
    messages = _event_stream(spark, sf_dir).select(
        F.concat(F.lit("\n"), "props").cast("binary").alias("value"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )
    kept = bronze.landed(messages, arrived=F.col("timestamp"))
    path = _run(kept, "bronze", bronze.INGEST_PARTS, gather=False)
    year, month, day = [F.date_format("timestamp", fmt) for fmt in ("yyyy", "MM", "dd")]
    return (
        read_parquet(spark, path)
        .groupBy(year.alias("ano"), month.alias("mes"), day.alias("dia"))
        .agg(
            F.count(F.lit(1)).alias("mensagens"),
            F.sum(F.octet_length("value")).alias("bytes"),
            F.min("offset").alias("primeira"),
            F.max("offset").alias("ultima"),
        )
    )


@query("""
    SELECT CASE WHEN event_type = 'error' THEN props || chr(10) ELSE props END AS value,
           event_type <> 'error' AS em_texto
    FROM events""")
def q_land_bronze_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text bronze, read back through the glob of its directory levels. Payloads
    that hold a line break are refused by it and land as Parquet."""
    broken = F.when(F.col("event_type") == "error", F.concat("props", F.lit("\n")))
    messages = _event_stream(spark, sf_dir).select(
        F.coalesce(broken, "props").alias("value"), "ts"
    )
    kept = bronze.landed(messages, arrived=F.col("ts"), as_text=True)
    path = _run(kept, "bronze-text", bronze.INGEST_PARTS, "text", gather=False)
    lines = _run(text_stream(spark, f"{path}/{BRONZE_GLOB}"), "lines")
    refused = bronze.landed(bronze.not_text(messages), arrived=F.col("ts"))
    other = _run(refused, "bronze-refused", bronze.INGEST_PARTS, gather=False)
    both = [
        read_parquet(spark, p).select("value", F.lit(as_text).alias("em_texto"))
        for p, as_text in ((lines, True), (other, False))
    ]
    return both[0].unionByName(both[1])


@query("""
    SELECT CAST(ts AS DATE) AS data, CAST(user_id AS VARCHAR) AS cidade,
           event_type AS estado, value AS precipitacao_mm
    FROM events""")
def q_stream_silver_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days packed as JSON arrays, streamed through the JSON source to silver."""
    station = table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.col("user_id").cast("string").alias("hub"),
        F.col("event_type").alias("state"),
        F.lit(0.0).alias("latitude"),
        F.lit(0.0).alias("longitude"),
        F.col("value").alias("precipitation_mm"),
    )
    source = work_path(spark, "climate-messages")
    write_lines(bronze.day_messages(station, "date", parts=PARTS), source)
    raw = json_stream(spark, source, CLIMATE_RECORD)
    return read_parquet(spark, _run(silver.climate(raw), "climate-silver"))


@query("""
    SELECT CAST(ts AS DATE) AS data, event_type AS estado, value AS producao FROM events""")
def q_stream_silver_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days packed as JSON arrays, streamed as text to silver partitioned by date."""
    monthly = table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("data"),
        F.col("event_type").alias("unidade_federativa"),
        F.col("value").alias("producao"),
    )
    source = work_path(spark, "production-messages")
    write_lines(bronze.production_messages(monthly, parts=PARTS), source)
    path = _run(silver.production(text_stream(spark, source)), "production-silver", ["data"])
    return read_parquet(spark, path)


@query("""
    SELECT o_orderdate AS "timestamp", o_totalprice AS preco FROM orders""")
def q_stream_silver_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price CSV with untidy headers, to JSON objects, streamed to silver."""
    price = F.translate(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), ".", ",")
    csv = work_path(spark, "price-csv")
    table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "dd/MM/yyyy").alias(" Data"),
        price.alias("Último "),
        price.alias("Abertura"),
        price.alias("Máxima"),
        price.alias("Mínima"),
        F.lit(None).cast("string").alias("Vol."),
        F.lit("0,10%").alias("Var%"),
    ).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(csv)
    source = work_path(spark, "price-messages")
    prices = bronze.price_table(read_price_csv(spark, csv))
    write_lines(bronze.price_messages(prices), source)
    raw = json_stream(spark, source, PRICE_RECORD)
    stored = read_parquet(spark, _run(silver.prices(raw), "price-silver"))
    return stored.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query("""
    SELECT CASE WHEN event_id % 5 = 0 THEN substr(props, 1, length(props) - 1)
                WHEN event_id % 5 = 1 THEN '{"data":"2015-01-01","producao":"12,5","n":' || event_id || '}'
                WHEN event_id % 5 = 2 THEN '{"data":"2015-13-01","producao":1.5,"n":' || event_id || '}'
           END AS value
    FROM events WHERE event_id % 5 < 3""")
def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages cut short, with a number or a date that does not parse: each goes to
    quarantine as it was sent. Good ones and a JSON null do not."""
    number = F.col("event_id").cast("string")
    kind = F.col("event_id") % 5

    def sent(start: str) -> Column:
        return F.concat(F.lit(start), number, F.lit("}"))

    value = (
        F.when(kind == 0, F.col("props").substr(F.lit(1), F.length("props") - 1))
        .when(kind == 1, sent('{"data":"2015-01-01","producao":"12,5","n":'))
        .when(kind == 2, sent('{"data":"2015-13-01","producao":1.5,"n":'))
        .when(kind == 3, sent('{"data":"2015-01-01","producao":null,"n":'))
        .otherwise(sent('{"data":"2015-01-01","producao":1.5,"n":'))
    )
    messages = _event_stream(spark, sf_dir).select(value.alias("value"))
    raw = silver.checked_records(messages, PRODUCTION_RECORD)
    rows = silver.production_rows(raw, also=["value", "_texts"])
    bad = silver.rejected({"data": "data", "producao": "producao"}, ["data"])
    return read_parquet(spark, _run(rows.filter(bad).select("value"), "quarantine"))


@query("""
    SELECT (dense_rank() OVER (ORDER BY date_trunc('year', o_orderdate)) - 1)::BIGINT AS lote,
           strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS data,
           o_orderkey::VARCHAR AS cidade, o_orderstatus AS estado,
           o_totalprice AS precipitacao_mm
    FROM orders""")
def q_replay_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders sent year by year in order of date, a year standing for a day: each
    arrives in a micro-batch of its own, whose number comes back with it."""
    records = table(spark, sf_dir, "orders").select(
        date_text(F.trunc("o_orderdate", "year")).alias("date"),
        F.col("o_orderkey").cast("string").alias("hub"),
        F.col("o_orderstatus").alias("state"),
        F.col("o_totalprice").alias("precipitation_mm"),
    )
    source, target = work_path(spark, "feed"), work_path(spark, "feed-silver")

    def take(batch: DataFrame, number: int) -> None:
        # a batch that is tried again writes the same folder again
        batch.write.mode("overwrite").parquet(f"{target}/lote={number}")

    def arrive(_: str) -> None:
        rows = silver.climate(replay_feed(spark, source, CLIMATE_RECORD), also=["date"])
        query = (
            rows.writeStream.foreachBatch(take)
            .option("checkpointLocation", f"{target}-checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    sent = bronze.day_messages(records, "date", unique_on=["hub"], parts=PARTS)
    send_in_order(sent, source, arrive)
    return read_parquet(spark, target).select(
        F.col("lote").cast("long").alias("lote"), F.col("date").alias("data"), "cidade",
        "estado", "precipitacao_mm",
    )


# --- replays and keys --------------------------------------------------------


@query("""
    SELECT CAST(year(ts) AS INTEGER) AS ano, CAST(month(ts) AS INTEGER) AS mes,
           event_type AS estado,
           CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS producao_mensal_total
    FROM events GROUP BY ALL""")
def q_replay_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events sent twice; the monthly sum is that of sending them once."""
    sent = table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("data"),
        F.col("event_type").alias("estado"),
        F.col("value").alias("producao"),
        "event_id",
    )
    twice = sent.unionByName(sent)
    return gold.monthly_production(twice, unique_on=["event_id"], scale=2)


@query("""
    SELECT DISTINCT o_orderdate AS "timestamp", o_totalprice + extra AS preco,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS chave
    FROM orders, (VALUES (0), (1)) AS v(extra)""")
def q_replay_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders sent twice, each with a second price at its instant, some without a
    key: equal rows go, every different one stays. When a row came in is not part of
    what it says."""
    sent = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_totalprice").alias("preco"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("chave"),
    )
    second = sent.withColumn("preco", F.col("preco") + 1)
    once = sent.unionByName(second).withColumn("ingest_ts", F.lit("2024-01-01").cast("timestamp"))
    again = once.withColumn("ingest_ts", F.lit("2024-01-02").cast("timestamp"))
    return drop_replays(once.unionByName(again), ["timestamp", "chave"]).drop("ingest_ts")


@query("SELECT event_id, event_type AS estado, value AS producao FROM events")
def q_replay_dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events in one run and again in the next; the second adds nothing."""
    sent = table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("estado"), F.col("value").alias("producao")
    )
    source, target = work_path(spark, "replayed"), work_path(spark, "replay-silver")
    for _ in range(2):
        append(sent, source)
        stream = parquet_stream(spark, source, sent.schema)
        once = drop_replays_stream(stream).drop("ingest_ts")
        run_to_end(once, target, f"{target}-checkpoint")
    return read_parquet(spark, target)


@query("""
    SELECT o_orderkey, o_totalprice + 1 AS preco FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT o_orderkey, o_totalprice AS preco FROM orders WHERE o_orderstatus <> 'F'""")
def q_replay_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of status F are sent again with a new price, which wins."""
    sent = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("preco"), F.lit(1).alias("seq")
    )
    fixed = (
        sent.filter(F.col("o_orderstatus") == "F")
        .withColumn("preco", F.col("preco") + 1)
        .withColumn("seq", F.lit(2))
    )
    newest = drop_replays(fixed.unionByName(sent), ["o_orderkey"], newest_by="seq")
    return newest.select("o_orderkey", "preco")


@query("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1
                            ELSE o_totalprice END AS preco
    FROM orders""")
def q_upsert_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored: status F and O. New: F and P, sent twice. Only P is appended."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("preco")
    )
    kept = orders.filter(F.col("o_orderstatus").isin("F", "O")).drop("o_orderstatus")
    path = work_path(spark, "keyed")
    stored = overwrite(kept, path)
    new = (
        orders.filter(F.col("o_orderstatus").isin("F", "P"))
        .drop("o_orderstatus")
        .withColumn("preco", F.col("preco") + 1)
    )
    append(append_absent(new.unionByName(new), stored, ["o_orderkey"]), path)
    return read_parquet(spark, path)


# --- sinks -------------------------------------------------------------------

_DAILY_SUM = """
    SELECT CAST(year(ts) AS INTEGER) AS ano, CAST(month(ts) AS INTEGER) AS mes,
           CAST(day(ts) AS INTEGER) AS dia, event_type AS estado,
           CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS precipitacao_total_mm
    FROM events GROUP BY ALL"""


@query(_DAILY_SUM)
def q_replace_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gold table partitioned by state, written over what was there."""
    path = work_path(spark, "gold-partitioned")
    daily = gold.daily_total_rain(climate_silver(spark, sf_dir), scale=2)
    overwrite(daily.withColumn("estado", F.lit("anterior")), path, partition_by=["estado"])
    return overwrite(daily, path, partition_by=["estado"])


@query("""
    SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, CAST(month(l_shipdate) AS INTEGER) AS mes,
           l_returnflag AS estado, SUM(l_quantity) AS producao_mensal_total
    FROM lineitem GROUP BY ALL ORDER BY ano, mes, estado""")
def q_replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gold table in the catalog, replaced and read back in order."""
    path = work_path(spark, "gold-table")
    monthly = gold.monthly_production(production_silver(spark, sf_dir))
    replace_table(monthly, "gold_producao_mensal", path)
    return read_table(spark, "gold_producao_mensal", gold.MONTHLY_PRODUCTION_ORDER)


# --- grid --------------------------------------------------------------------


@query("""
    WITH cells AS (
        SELECT CAST(p_size AS DOUBLE) AS latitude, floor(p_retailprice) AS longitude,
               COUNT(*) AS pecas, MAX(p_partkey) AS ultima
        FROM part GROUP BY ALL),
    hubs AS (
        SELECT s_suppkey, CAST(s_nationkey * 2 + 0.5 AS DOUBLE) AS lat, 900 + s_acctbal / 100 AS lon
        FROM supplier),
    near_lat AS (
        SELECT s_suppkey, latitude AS cell_lat
        FROM hubs, (SELECT DISTINCT latitude FROM cells)
        QUALIFY row_number() OVER (
            PARTITION BY s_suppkey ORDER BY abs(latitude - lat), latitude) = 1),
    near_lon AS (
        SELECT s_suppkey, longitude AS cell_lon
        FROM hubs, (SELECT DISTINCT longitude FROM cells)
        QUALIFY row_number() OVER (
            PARTITION BY s_suppkey ORDER BY abs(longitude - lon), longitude) = 1)
    SELECT s_suppkey, lat, lon, cell_lat, cell_lon, pecas, ultima
    FROM hubs JOIN near_lat USING (s_suppkey) JOIN near_lon USING (s_suppkey)
         LEFT JOIN cells ON latitude = cell_lat AND longitude = cell_lon""")
def q_nearest_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as grid cells, suppliers as points, halfway points among them. Every
    supplier comes out, with nulls where the grid has no row at its cell."""
    cells = (
        table(spark, sf_dir, "part")
        .groupBy(
            F.col("p_size").cast("double").alias("latitude"),
            F.floor("p_retailprice").cast("double").alias("longitude"),
        )
        .agg(F.count(F.lit(1)).alias("pecas"), F.max("p_partkey").alias("ultima"))
    )
    hubs = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        (F.col("s_nationkey") * 2 + 0.5).cast("double").alias("lat"),
        (900 + F.col("s_acctbal") / 100).alias("lon"),
    )
    found = sample_grid(cells, hubs, keep_unmatched=True)
    return found.select(
        "s_suppkey", "lat", "lon", "cell_lat", "cell_lon", "pecas", "ultima"
    )


@query("""
    WITH grid AS (
        SELECT CAST(year(l_shipdate) AS INTEGER) AS ano,
               CAST(date_trunc('month', l_shipdate) AS DATE) AS data,
               CAST(l_linenumber AS DOUBLE) AS latitude,
               CAST(round(l_discount * 100) AS DOUBLE) AS longitude,
               SUM(l_quantity) AS precip
        FROM lineitem GROUP BY ALL),
    hubs AS (
        SELECT s_suppkey, s_nationkey * 0.5 AS lat, s_acctbal / 1000 AS lon FROM supplier),
    near_lat AS (
        SELECT s_suppkey, ano, latitude
        FROM hubs, (SELECT DISTINCT ano, latitude FROM grid)
        QUALIFY row_number() OVER (
            PARTITION BY s_suppkey, ano ORDER BY abs(latitude - lat), latitude) = 1),
    near_lon AS (
        SELECT s_suppkey, ano, longitude
        FROM hubs, (SELECT DISTINCT ano, longitude FROM grid)
        QUALIFY row_number() OVER (
            PARTITION BY s_suppkey, ano ORDER BY abs(longitude - lon), longitude) = 1)
    SELECT strftime(data, '%Y-%m-%d') AS date, s_suppkey, precip AS precipitation_mm
    FROM near_lat JOIN near_lon USING (s_suppkey, ano)
         JOIN grid USING (ano, latitude, longitude)""")
def q_grid_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly grids, one year absent, sampled at each supplier's nearest cell."""
    day = F.col("l_shipdate")
    grid = (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.year(day).alias("ano"),
            F.trunc(day, "month").alias("date"),
            F.col("l_linenumber").cast("double").alias("latitude"),
            F.rint(F.col("l_discount") * 100).alias("longitude"),
        )
        .agg(F.sum("l_quantity").alias("precip"))
    )
    path = work_path(spark, "grid")
    overwrite(grid, path, partition_by=["ano"])
    years = range(1994, 2003)
    yearly = read_grid_years(spark, lambda year: f"{path}/ano={year}", years)
    hubs = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        (F.col("s_nationkey") * 0.5).alias("lat"),
        (F.col("s_acctbal") / 1000).alias("lon"),
    )
    return sample_grid(yearly, hubs, years=years).select(
        date_text(F.col("date")).alias("date"),
        "s_suppkey",
        F.col("precip").alias("precipitation_mm"),
    )


@query("""
    WITH grid AS (
        SELECT CAST(l_shipdate AS DATE) AS data, -l_linenumber::DOUBLE * 4 AS latitude,
               -40 - (l_suppkey % 20)::DOUBLE AS longitude, SUM(l_quantity) AS precip
        FROM lineitem GROUP BY ALL),
    hubs AS (
        SELECT hub, state, lat::DOUBLE AS lat, lon::DOUBLE AS lon
        FROM (VALUES HUBS) AS v(hub, state, cultura, lat, lon)),
    near_lat AS (
        SELECT hub, latitude FROM hubs, (SELECT DISTINCT latitude FROM grid)
        QUALIFY row_number() OVER (PARTITION BY hub ORDER BY abs(latitude - lat), latitude) = 1),
    near_lon AS (
        SELECT hub, longitude FROM hubs, (SELECT DISTINCT longitude FROM grid)
        QUALIFY row_number() OVER (PARTITION BY hub ORDER BY abs(longitude - lon), longitude) = 1)
    SELECT strftime(data, '%Y-%m-%d') AS date, hub, state, lat AS latitude, lon AS longitude,
           precip AS precipitation_mm
    FROM hubs JOIN near_lat USING (hub) JOIN near_lon USING (hub)
         JOIN grid USING (latitude, longitude)""".replace("HUBS", ", ".join(map(str, HUBS))))
def q_station_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hubs' rows of a daily grid, with its axes given."""
    grid = (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.to_date("l_shipdate").alias("date"),
            (-F.col("l_linenumber").cast("double") * 4).alias("latitude"),
            (-40 - (F.col("l_suppkey") % 20).cast("double")).alias("longitude"),
        )
        .agg(F.sum("l_quantity").alias("precip"))
    )
    axes = grid.select("latitude", "longitude").distinct()
    return silver.station_rows(sample_grid(grid, hub_table(spark), axes=axes))


# --- sources and runs ---------------------------------------------------------


@query("""
    SELECT strftime(ts, '%Y-%m-%d') AS date, event_id::VARCHAR AS hub,
           CASE WHEN event_id % 7 = 0 THEN 'nan'::DOUBLE ELSE value END AS precipitation_mm
    FROM events""")
def q_json_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines with NaN tokens through the JSON source."""
    amount = F.when(F.col("event_id") % 7 == 0, F.lit("NaN")).otherwise(F.to_json(F.struct("value")))
    number = F.regexp_replace(amount, '^\\{"value":|\\}$', "")
    line = F.format_string(
        '{"date":"%s","hub":"%s","precipitation_mm":%s}',
        F.date_format("ts", "yyyy-MM-dd"), F.col("event_id").cast("string"), number,
    )
    source = work_path(spark, "nan-messages")
    write_lines(table(spark, sf_dir, "events").select(line.alias("value")), source)
    raw = json_stream(spark, source, CLIMATE_RECORD).select("date", "hub", "precipitation_mm")
    return read_parquet(spark, _run(raw, "nan-silver"))


@query("""
    SELECT o_orderkey, o_totalprice FROM orders""")
def q_interval_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query that runs on an interval: two deliveries, each awaited, then a stop."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    source, target = work_path(spark, "interval"), work_path(spark, "interval-silver")
    halves = [orders.filter(F.col("o_orderkey") % 2 == half) for half in (0, 1)]
    append(halves[0], source)
    arriving = parquet_stream(spark, source, orders.schema)
    query = start_append(arriving, target, f"{target}-checkpoint", interval="1 second")
    try:
        query.processAllAvailable()
        append(halves[1], source)
        query.processAllAvailable()
    finally:
        query.stop()
    return read_parquet(spark, target)


@query("SELECT event_id, value FROM events")
def q_stray_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A streamed table with copies of its rows in files that no batch committed."""
    events = _event_stream(spark, sf_dir).select("event_id", "value")
    path = _run(events, "committed")
    append(read_parquet(spark, path), f"{path}-stray")
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    stray, home = hadoop.Path(f"{path}-stray"), hadoop.Path(path)
    system = stray.getFileSystem(conf)
    for status in system.listStatus(stray):
        if status.getPath().getName().endswith(".parquet"):
            spark._jvm.org.apache.hadoop.fs.FileUtil.copy(
                system, status.getPath(), system, home, False, conf
            )
    return read_parquet(spark, path)
