"""Nearest grid cell of a point, axis by axis, and the grid's rows there."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratalake.operators.sizing import broadcast_within, measured_bytes, settled


def nearest_on_axis(
    points: DataFrame,
    point: str,
    axis: DataFrame,
    coord: str,
    by: Sequence[str] = (),
) -> DataFrame:
    """For each distinct ``point`` value the nearest ``coord`` of the axis.

    Of two equally near ones the smaller is taken. Points and coordinates are
    sorted together: the running maximum of the coordinates from below and the
    running minimum from above are a point's two neighbours, so no point is
    compared with more than two.

    The sort is cut into bands of about equal length, the partitions of a range
    shuffle. A neighbour beyond the edge of a band comes from the list of bands.
    The banded values are settled, as both must see the same bands. They are
    distinct values only: one that fills a third of the rows is one of them.
    """
    by = list(by)
    both = settled(
        _values(points, point, by, asked=True)
        .unionByName(_values(axis, coord, by, asked=False))
        .groupBy(*by, "at")
        .agg(F.max("asked").alias("asked"), F.max("on_axis").alias("on_axis"))
        .repartitionByRange(*by, "at")
        .select(
            *by,
            "at",
            "asked",
            F.when(F.col("on_axis"), F.col("at")).alias("coord"),
            F.spark_partition_id().alias("band"),
        )
    )
    before_or_here = (W.unboundedPreceding, W.currentRow)
    in_band = W.partitionBy(*by, "band")
    upward = in_band.orderBy(F.col("at")).rowsBetween(*before_or_here)
    downward = in_band.orderBy(F.col("at").desc()).rowsBetween(*before_or_here)
    asked = (
        both.withColumn("below", F.max("coord").over(upward))
        .withColumn("above", F.min("coord").over(downward))
        .filter("asked")
    )

    before = (W.unboundedPreceding, -1)
    across = W.partitionBy(*(by or [F.lit(0)]))
    earlier = across.orderBy(F.col("band")).rowsBetween(*before)
    later = across.orderBy(F.col("band").desc()).rowsBetween(*before)
    edges = (
        both.groupBy(*by, "band")
        .agg(F.min("coord").alias("least"), F.max("coord").alias("most"))
        .select(
            *by,
            "band",
            F.max("most").over(earlier).alias("before"),
            F.min("least").over(later).alias("after"),
        )
    )
    below, above = F.coalesce("below", "before"), F.coalesce("above", "after")
    nearer_below = above.isNull() | (F.col("at") - below <= above - F.col("at"))
    return asked.join(edges, [*by, "band"]).select(
        *by,
        F.col("at").alias(point),
        F.when(nearer_below, below).otherwise(above).alias(coord),
    )


def _values(df: DataFrame, name: str, by: list[str], asked: bool) -> DataFrame:
    at = F.col(name).cast("double").alias("at")
    flags = [F.lit(asked).alias("asked"), F.lit(not asked).alias("on_axis")]
    return df.select(*by, at, *flags).filter(F.col("at").isNotNull() & ~F.isnan("at"))


def _both_sides(df: DataFrame, by: list[str], lat: str, lon: str, name: str) -> DataFrame:
    """Latitude and longitude as rows of one column, so that one pass serves both."""
    sides = [
        F.struct(F.lit(side).alias("side"), F.col(column).cast("double").alias(name))
        for side, column in (("lat", lat), ("lon", lon))
    ]
    return df.select(*by, F.inline(F.array(*sides)))


def place_on_grid(
    points: DataFrame,
    axes: DataFrame,
    lat: str = "lat",
    lon: str = "lon",
    grid_lat: str = "latitude",
    grid_lon: str = "longitude",
    by: Sequence[str] = (),
) -> DataFrame:
    """``points`` with the cell of each in ``cell_lat`` and ``cell_lon``.

    ``axes`` is the grid or any table with the same coordinates; it is read
    once. Points without a position are left out.
    """
    by = list(by)
    near = nearest_on_axis(
        _both_sides(points, by, lat, lon, "at"),
        "at",
        _both_sides(axes, by, grid_lat, grid_lon, "cell"),
        "cell",
        [*by, "side"],
    )
    for side, column in (("lat", lat), ("lon", lon)):
        found = near.filter(F.col("side") == side).select(
            *by, F.col("at").alias(column), F.col("cell").alias(f"cell_{side}")
        )
        points = points.join(found, [*by, column])
    return points


def sample_grid(
    grid: DataFrame,
    points: DataFrame,
    lat: str = "lat",
    lon: str = "lon",
    grid_lat: str = "latitude",
    grid_lon: str = "longitude",
    by: Sequence[str] = (),
    years: Iterable[int] | None = None,
    axes: DataFrame | None = None,
    keep_unmatched: bool = False,
) -> DataFrame:
    """The rows of the grid at the cell nearest to each point.

    The nearest cell is found axis by axis, and the grid need not have a row
    there; such points, and those without a position, are left out, or with
    ``keep_unmatched`` come once with nulls for the grid's columns.

    The points are placed first and the grid is then joined on its cell, so the
    grid is never paired with all points. There is one placed row per point (and
    year); if the points measure little they are broadcast and the grid is not
    shuffled. Pass ``axes`` where the coordinates are known, to save a pass over
    the grid.
    """
    by = list(by)
    listed = list(years) if years is not None else []
    everyone = points
    if listed:
        points = everyone = points.withColumn(
            "ano", F.explode(F.array(*map(F.lit, listed)))
        )
        by = [*by, "ano"]
    placed = settled(
        place_on_grid(points, grid if axes is None else axes, lat, lon, grid_lat, grid_lon, by)
    )
    cells = broadcast_within(placed, measured_bytes(placed))
    cell = (grid[grid_lat] == cells["cell_lat"]) & (grid[grid_lon] == cells["cell_lon"])
    for name in by:
        cell = cell & (grid[name] == cells[name])
    taken = set(by) | set(cells.columns)
    found = grid.join(cells, cell).select(
        *[cells[name] for name in cells.columns],
        *[grid[name] for name in grid.columns if name not in taken],
    )
    if not keep_unmatched:
        return found
    at = [*by, "cell_lat", "cell_lon"]
    there = grid.select(*by, F.col(grid_lat).cast("double").alias("cell_lat"),
                        F.col(grid_lon).cast("double").alias("cell_lon")).distinct()
    missing = placed.join(there, at, "left_anti")
    nowhere = F.col(lat).isNull() | F.col(lon).isNull() | F.isnan(lat) | F.isnan(lon)
    return found.unionByName(missing, allowMissingColumns=True).unionByName(
        everyone.filter(nowhere), allowMissingColumns=True
    )
