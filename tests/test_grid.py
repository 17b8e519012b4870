import random

import pytest
from pyspark.sql import functions as F

from stratalake.operators import sizing
from stratalake.operators.grid import nearest_on_axis, place_on_grid, sample_grid
from stratalake.sources.dimensions import hubs


def brute(point, axis):
    return min(axis, key=lambda c: (abs(c - point), c))


@pytest.fixture(params=["one band", "many bands"])
def bands(request, spark):
    """Adaptive execution would put small data in one band."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", request.param == "one band")
    spark.conf.set("spark.sql.shuffle.partitions", 4 if request.param == "one band" else 40)
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
    spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_nearest_matches_brute_force(spark, bands):
    rng = random.Random(5)
    # clustered, with wide gaps, and halfway points
    axis = sorted({float(round(rng.gauss(0, 20))) for _ in range(40)} | {90.0, 91.0})
    points = [rng.uniform(-120, 120) for _ in range(150)] + [a + 0.5 for a in axis] + axis
    points_df = spark.createDataFrame([(p,) for p in points * 3], "lat double").repartition(3)
    axis_df = spark.createDataFrame([(a,) for a in axis * 2], "latitude double")
    got = nearest_on_axis(points_df, "lat", axis_df, "latitude").collect()
    assert {r.lat: r.latitude for r in got} == {p: brute(p, axis) for p in points}
    assert len(got) == len(set(points))


def test_axis_at_one_end_of_the_points(spark, bands):
    """Bands without any coordinate take their neighbour from far bands."""
    points = spark.createDataFrame([(float(i),) for i in range(300)], "lat double")
    axis = spark.createDataFrame([(0.0,), (299.0,)], "latitude double")
    got = nearest_on_axis(points, "lat", axis, "latitude").collect()
    assert {r.lat: r.latitude for r in got} == {float(i): 0.0 if i <= 149 else 299.0 for i in range(300)}


def test_nearest_within_groups(spark, bands):
    points = spark.createDataFrame([(2015, 1.4), (2016, 1.4)], "ano int, lat double")
    axis = spark.createDataFrame([(2015, 1.0), (2015, 2.0), (2016, 3.0)], "ano int, latitude double")
    got = nearest_on_axis(points, "lat", axis, "latitude", by=["ano"]).collect()
    assert {(r.ano, r.latitude) for r in got} == {(2015, 1.0), (2016, 3.0)}


def test_missing_positions_are_left_out(spark):
    points = spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "lat double")
    axis = spark.createDataFrame([(0.0,), (None,)], "latitude double")
    assert [tuple(r) for r in nearest_on_axis(points, "lat", axis, "latitude").collect()] == [(1.0, 0.0)]


def cell_grid(spark):
    """0.05-degree cells around the hubs for two days of two years."""
    around = hubs(spark).select("lat", "lon")
    steps = F.explode(F.sequence(F.lit(-4), F.lit(4)))
    cells = (
        around.withColumn("i", steps)
        .withColumn("j", steps)
        .select(
            (F.round(F.col("lat") / 0.05) * 0.05 + F.col("i") * 0.05 + 0.025).alias("latitude"),
            (F.round(F.col("lon") / 0.05) * 0.05 + F.col("j") * 0.05 + 0.025).alias("longitude"),
        )
        .distinct()
    )
    dates = F.explode(F.expr("array(date'2015-12-31', date'2016-01-01')"))
    return cells.withColumn("date", dates).select(
        "date", "latitude", "longitude", (F.col("latitude") + F.col("longitude")).alias("precip"),
        F.year("date").alias("ano"),
    )


@pytest.mark.parametrize("small", [True, False])
def test_every_hub_gets_its_cell_each_day(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(sizing, "BROADCAST_BYTES", 2)
    grid = cell_grid(spark)
    lats = sorted({r.latitude for r in grid.select("latitude").distinct().collect()})
    lons = sorted({r.longitude for r in grid.select("longitude").distinct().collect()})
    cells = {(r.latitude, r.longitude) for r in grid.collect()}
    found = sample_grid(grid, hubs(spark), years=[2015, 2016, 2017])
    everyone = sample_grid(grid, hubs(spark), years=[2015, 2016, 2017], keep_unmatched=True)
    hinted = "strategy=broadcast" in found._jdf.queryExecution().optimizedPlan().toString()
    assert hinted == small
    got = found.select("hub", "lat", "lon", "cell_lat", "cell_lon", "date").collect()
    want = [
        h for h in hubs(spark).collect() if (brute(h.lat, lats), brute(h.lon, lons)) in cells
    ]
    assert len(got) == 2 * len(want) > 0
    # all of them come out, those without a grid row once for each year
    all_rows = everyone.select("hub", "ano", "date", "precip").collect()
    assert {r.hub for r in all_rows} == {h.hub for h in hubs(spark).collect()}
    assert sum(r.date is not None for r in all_rows) == len(got)
    nowhere = spark.createDataFrame([("x", None, 1.0)], "hub string, lat double, lon double")
    left = sample_grid(grid.drop("ano"), nowhere, keep_unmatched=True).collect()
    assert [(r.hub, r.precip) for r in left] == [("x", None)]
    for r in got:
        assert (r.cell_lat, r.cell_lon) == (brute(r.lat, lats), brute(r.lon, lons))


def test_known_axes_spare_a_pass_over_the_grid(spark):
    grid = cell_grid(spark)
    axes = grid.select("latitude", "longitude").distinct()
    placed = place_on_grid(hubs(spark), axes)
    assert placed.count() == 10
    assert sample_grid(grid, hubs(spark), axes=axes).count() == sample_grid(grid, hubs(spark)).count()


def test_no_pairing_of_points_with_coordinates(spark):
    grid = cell_grid(spark)
    placed = place_on_grid(hubs(spark), grid)
    plan = placed._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
