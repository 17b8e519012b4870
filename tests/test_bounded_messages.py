"""No date is one message whatever its size, and messages are made once."""

from pyspark.sql import functions as F

from checks import ingest
from stratalake.plans import bronze
from stratalake.sinks.messages import send_in_order


def test_messages_are_made_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def count(value):
        made.add(1)
        return value

    rows = [("2024-01-02", "b"), ("2024-01-01", "a"), (None, "n"), ("", "e"), ("2024-01-02", "c")]
    table = spark.createDataFrame(rows, "key string, value string")
    messages = table.withColumn("value", F.udf(count, "string")("value"))
    order = []
    assert send_in_order(messages, str(tmp_path / "feed"), order.append) == order
    assert order == [None, "", "2024-01-01", "2024-01-02"]
    assert made.value == len(rows)
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "feed")).collect()) == list("abcen")


def test_a_year_of_orders_is_several_messages(spark, tmp_path, monkeypatch):
    spark.range(3000).select(
        F.col("id").alias("o_orderkey"), F.lit("O").alias("o_orderstatus"),
        F.lit(1.5).alias("o_totalprice"), F.to_timestamp(F.lit("1995-03-04")).alias("o_orderdate"),
    ).write.parquet(str(tmp_path / "orders.parquet"))
    sent = []

    def kept(*args, **more):
        sent.append(make(*args, **more))
        return sent[-1]

    make = bronze.day_messages
    monkeypatch.setattr(ingest.bronze, "day_messages", kept)
    assert ingest.q_replay_feed(spark, str(tmp_path)).count() == 3000
    assert sent[0].agg(F.max("linhas")).first()[0] < 200
