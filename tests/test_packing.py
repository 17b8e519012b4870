from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratalake.functions import parse_records, records_json
from stratalake.operators.packing import pack, parts_for, unpack


def events(spark, count=900):
    """Ten days; a third of the rows on one of them, and some without a day."""
    return spark.range(0, count, 1, 4).select(
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-01"))
        .when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("2024-01-1"), F.col("id") % 10))
        .alias("data"),
        F.col("id").alias("event_id"),
        (F.col("id") / 7).alias("value"),
    )


@pytest.mark.parametrize("unique_on", [["event_id"], None])
@pytest.mark.parametrize("parts", [1, 7])
def test_pack_then_unpack_is_the_identity(spark, rows, unique_on, parts):
    df = events(spark)
    packed = pack(df, ["data"], unique_on=unique_on, parts=parts)
    record = packed.schema["registros"].dataType.elementType
    text = packed.withColumn("value", records_json("registros"))
    back = text.withColumn("registros", parse_records("value", record))
    assert rows(unpack(back, complete_by=["data"]).select(df.columns)) == rows(df)


def test_every_group_has_the_same_parts(spark):
    few = spark.createDataFrame([("a", i) for i in range(500)] + [("b", 1)], "k string, v int")
    got = pack(few, ["k"], unique_on=["v"], parts=5).collect()
    assert Counter(r.k for r in got) == {"a": 5, "b": 5}
    assert all(r.partes == 5 and r.linhas == len(r.registros) for r in got)
    assert {r.parte for r in got if r.k == "b"} == set(range(5))
    assert sum(r.linhas for r in got) == 501
    assert max(r.linhas for r in got if r.k == "a") < 150


def test_a_missing_part_fails_loudly(spark):
    packed = pack(events(spark), ["data"], unique_on=["event_id"], parts=3)
    lost = F.col("data").eqNullSafe("2024-01-01") & (F.col("parte") == 1)
    whole = packed.filter(~lost)
    with pytest.raises(ValueError, match="2024-01-01: 2 of 3"):
        unpack(whole, complete_by=["data"])
    cut = packed.withColumn("registros", F.slice("registros", 1, 2))
    with pytest.raises(ValueError, match="whole"):
        unpack(cut, complete_by=["data"])


def test_copies_are_dealt_out_in_turn(spark):
    df = spark.range(0, 2000, 1, 4).select(F.lit("d").alias("data"), F.lit(1.5).alias("v"))
    sizes = [r.linhas for r in pack(df, ["data"], parts=20).collect()]
    assert sum(sizes) == 2000 and len(sizes) == 20 and max(sizes) <= 120


def test_parts_keep_the_byte_budget():
    assert parts_for(10, 100) == 1
    assert parts_for(10_000, 120) == 2


def test_records_are_in_order_within_a_message(spark):
    packed = pack(events(spark), ["data"], record=["event_id", "value"], unique_on=["event_id"])
    for row in packed.collect():
        ids = [r.event_id for r in row.registros]
        assert ids == sorted(ids)


def test_unpack_of_null_and_empty(spark):
    df = spark.createDataFrame([(None,), ([],), ([(1,)],)], "registros array<struct<k: int>>")
    assert [r.k for r in unpack(df).collect()] == [1]


def test_counts_survive_copies(spark):
    df = spark.createDataFrame([("a", 1)] * 5 + [("a", 2)] * 3 + [("b", 1)], "k string, v int")
    got = Counter({r.k: r.linhas for r in pack(df, ["k"]).collect()})
    assert got == {"a": 8, "b": 1}
