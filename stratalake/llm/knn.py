"""Exact top-k by inner product with a Voronoi join (operator 4).

Pivots cut the space into cells, and rings by distance from the pivot cut each
cell into regions. A region's summary is a count and its largest distance
from the pivot. For a query q and a row x of a region around pivot p,
    q.p - |q| far  <=  q.x  <=  q.p + |q| far     with far >= |x - p|,
so the summaries alone give each query a score that k rows reach for certain, and
the regions that can hold a better one. Neighbouring regions are joined to blocks
of rows, large ones are dealt out to several blocks. A query goes once to each
block with a region that it needs, together with the near queries of its own
block. Each pair of blocks is solved by one matrix product, and the k best of all
its pairs are a query's answer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import settled

PIVOTS = 48  # at most; fitted on so many rows, drawn by a hash of the id
RINGS = 24  # at most, per cell
BLOCK_VALUES = 1 << 19  # numbers in a block of rows: 8,192 of 64 each
QUERY_BLOCK_VALUES = 1 << 17
EXACT = 2.0**53
LIMB = 20  # bits of a digit; a sum of 2**13 products of two stays below EXACT


def quantized(vector: Column, scale: float) -> Column:
    """floor(scale * x) of each component as double, which holds it exactly."""
    return F.transform(
        F.transform(vector, lambda x: F.lit(scale) * x.cast("double")),
        # floor() of a double is a long and would end at its range
        lambda y: F.when(F.abs(y) >= EXACT, y).otherwise(F.floor(y).cast("double")),
    )


def taking_part(vector: Column) -> Column:
    bad = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")),
    )
    return vector.isNotNull() & ~bad


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products; beyond the range of long, the end of that range."""
    if not q.size or not x.size:
        return np.zeros((len(q), len(x)), np.int64)
    bound = np.abs(q).max() * np.abs(x).max() * q.shape[1]
    if bound < EXACT:
        return np.rint(q @ x.T).astype(np.int64)
    top, low = 2**63 - 1, -(2**63)
    if max(np.abs(q).max(), np.abs(x).max()) < 2.0 ** (3 * LIMB) and q.shape[1] < 1 << 13:
        # products of limbs and their sums stay whole in double, the rest is whole anyway
        total = np.zeros((len(q), len(x)), object)
        for i, a in enumerate(_limbs(q)):
            for j, b in enumerate(_limbs(x)):
                total += np.rint(a @ b.T).astype(np.int64).astype(object) << (LIMB * (i + j))
        return np.clip(total, low, top).astype(np.int64)
    whole = [[int(v) for v in row] for row in x]
    return np.array(
        [
            [min(top, max(low, sum(a * b for a, b in zip(map(int, row), other, strict=True)))) for other in whole]
            for row in q
        ],
        dtype=np.int64,
    )


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    """Whole numbers as three digits of LIMB bits, lowest first, all of their sign."""
    sign, rest, digits = np.sign(x), np.abs(x).astype(np.int64), []
    for _ in range(3):
        digits.append(sign * (rest & ((1 << LIMB) - 1)))
        rest >>= LIMB
    return digits


class Pivots:
    """Cells and rings of one dimension."""

    def __init__(self, points: np.ndarray, width: float):
        self.points = points
        self.width = width  # of a ring
        self.norms = np.linalg.norm(points, axis=1)

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest pivot, ring and distance from the pivot of each row."""
        square = (x**2).sum(1)[:, None] - 2 * (x @ self.points.T) + self.norms**2
        cell = square.argmin(1)
        # from the difference itself: the sum of squares loses digits
        away = np.linalg.norm(x - self.points[cell], axis=1)
        ring = np.minimum(away / self.width, RINGS - 1).astype(np.int64)
        return cell, ring, away

    def needed(self, q: np.ndarray, regions: list[tuple], k: int) -> np.ndarray:
        """For each query, which regions (cell, ring, rows, far, parts) it needs."""
        cell, count, far = (np.array([r[i] for r in regions]) for i in (0, 2, 3))
        middle = (q @ self.points.T)[:, cell]
        norm = np.linalg.norm(q, axis=1)[:, None]
        # rounding of doubles is far below this margin
        slack = 1e-9 * (np.abs(middle) + norm * (far + self.norms[cell])) + 1e-6
        low, high = middle - norm * far - slack, middle + norm * far + slack
        if count.sum() < k:
            return np.ones(low.shape, bool)
        order = np.argsort(-low, axis=1)
        enough = (np.cumsum(count[order], axis=1) >= k).argmax(axis=1)
        certain = np.take_along_axis(low, order, 1)[np.arange(len(q)), enough]
        return high >= certain[:, None]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), dim)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = np.asarray(batch.column("dim"))
    for dim in np.unique(dims):
        yield int(dim), batch.filter(pa.array(dims == dim))


def _placed(rows: DataFrame, pivots: dict[int, Pivots]) -> DataFrame:
    """``rows`` (vec_id, dim, v) with cell, ring and distance from the pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, some in _by_dim(batch):
                cell, ring, away = pivots_of(pivots, dim).place(_matrix(some.column("v"), dim))
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(cell, pa.int32()), pa.array(ring, pa.int32()),
                     pa.array(away)],
                    [*some.schema.names, "cell", "ring", "away"],
                )

    return rows.mapInArrow(
        run, "vec_id long, dim int, v array<double>, cell int, ring int, away double"
    )


def pivots_of(pivots: dict[int, Pivots], dim: int) -> Pivots:
    """Those drawn, or the origin for a length that the draw missed."""
    return pivots.get(dim) or Pivots(np.zeros((1, dim)), 64.0)


def _best(scores: np.ndarray, ids: np.ndarray, known: np.ndarray, own: np.ndarray, k: int):
    """Places of the k best, ties to the smaller known id."""
    places = np.flatnonzero(~own)
    if len(places) > k:
        some = scores[places]
        kth = np.partition(some, len(some) - k)[len(some) - k]
        places = places[some >= kth]
    order = np.lexsort((ids[places], ~known[places], ~scores[places]))  # ~s is -s - 1
    return places[order[:k]]


def _solver(k: int):
    made = pa.schema([(c, pa.int64()) for c in ("query_id", "_q", "vec_id", "score")])

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return made.empty_table()
        dim = left.column("dim")[0].as_py()
        ids = right.column("vec_id").combine_chunks()
        known = np.asarray(ids.is_valid())
        ids = np.asarray(ids.fill_null(0))
        asks = np.asarray(left.column("query_id"))
        scores = exact_scores(
            _matrix(left.column("v").combine_chunks(), dim),
            _matrix(right.column("v").combine_chunks(), dim),
        )
        best = [
            _best(row, ids, known, known & (ids == query), k)
            for row, query in zip(scores, asks, strict=True)
        ]
        which = np.repeat(np.arange(len(asks)), [len(b) for b in best])
        at = np.concatenate(best)
        return pa.table(
            [
                pa.array(asks[which]),
                left.column("_q").combine_chunks().take(pa.array(which)),
                pa.array(ids[at], pa.int64(), mask=~known[at]),
                pa.array(scores[which, at]),
            ],
            schema=made,
        )

    return solve


def _data_blocks(
    pivots: Pivots, regions: list[tuple[int, int, int, float]], rows: int
) -> list[tuple[int, int, int, float, int, int]]:
    """Regions (cell, ring, rows, far) with their first block and number of blocks.

    Cells follow one another along the main direction of the pivots, so a block
    holds near cells. A region of more than ``rows`` rows has blocks of its own.
    """
    middle = pivots.points - pivots.points.mean(axis=0)
    if np.any(middle):
        middle /= np.abs(middle).max()
        along = middle @ np.linalg.svd(middle, full_matrices=False)[2][0]
    else:
        along = np.zeros(len(middle))
    out, block, room = [], -1, 0
    for r in sorted(regions, key=lambda r: (along[r[0]], r[0], r[1])):
        parts = max(1, math.ceil(r[2] / rows))
        if parts > 1 or r[2] > room:
            block, room = block + 1, rows
        out.append((*r, block, parts))
        room -= r[2]
        if parts > 1:
            block, room = block + parts - 1, 0
    return out


def _query_blocks(counts: list[tuple[int, int, int]], values: int) -> dict:
    """(dim, cell) to first block and blocks: large cells are split, small ones share."""
    out, block, room = {}, -1, 0
    last = None
    for dim, cell, n in sorted(counts):
        size = max(1, values // max(dim, 1))
        if dim != last or n > room:
            block, room, last = block + 1, size, dim
        pieces = max(1, math.ceil(n / size))
        out[dim, cell] = (block, pieces)
        if pieces > 1:
            block, room = block + pieces - 1, 0
        else:
            room -= n
    return out


def _draw(rows: DataFrame, pivots: int) -> dict[int, Pivots]:
    """Pivots from a draw by hash of the id, some times their number in expectation."""
    there = rows.count()
    chance = int(min(1.0, 4 * pivots / max(there, 1)) * (1 << 30))
    by = F.pmod(F.xxhash64(F.coalesce("vec_id", F.xxhash64("v")), F.lit("pivot")), F.lit(1 << 30))
    points: dict[int, list] = {}
    drawn = rows.filter(by < chance).select("dim", "v", F.xxhash64("v").alias("_h"))
    for row in drawn.distinct().orderBy("_h", "dim").limit(4 * pivots).collect():
        points.setdefault(row["dim"], []).append(row["v"])
    made = {}
    for dim, some in points.items():
        at = np.array(some[:pivots], np.float64).reshape(-1, dim)
        reach = max(float(np.linalg.norm(at - p, axis=1).max(initial=0.0)) for p in at)
        made[dim] = Pivots(at, max(reach, 1.0) / (RINGS - 1))
    return made


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: float = 64.0,
    pivots: int = PIVOTS,
    block_values: int = BLOCK_VALUES,
    query_block_values: int = QUERY_BLOCK_VALUES,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The k rows of highest integer inner product for each query row.

    Components become floor(scale * x). Returns query_id, rank (from 1), vec_id and
    score; ties go to the smaller id. A row is no candidate for a query of its own
    id. Vectors that are null or hold a null, NaN or infinite component take no
    part, nor do queries with a null id; a null candidate id comes last among ties.
    Vectors compare with those of their own length only. Rows that repeat id and
    vector count once; an id with several vectors is several queries. Scores beyond
    the range of long are the end of that range. Other columns are ignored.

    Pivots are the only thing fitted on a sample; every row is placed, and the
    bounds come from a summary of all rows. Per-task memory is that of two blocks.
    """
    rows = vectors.filter(taking_part(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.size(vector_col).alias("dim"),
        quantized(F.col(vector_col), scale).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("_asks"),
    )
    made = _draw(rows, pivots)
    distinct = rows.select("vec_id", "dim", "v").distinct()
    everything = settled(_placed(distinct, made))
    summary = (
        everything.groupBy("dim", "cell", "ring")
        .agg(F.count("*").alias("n"), F.max("away").alias("far"))
        .collect()  # at most PIVOTS * RINGS rows for each vector length
    )
    found: dict[int, list[tuple]] = {}
    for r in sorted(summary):
        found.setdefault(r["dim"], []).append((r["cell"], r["ring"], r["n"], r["far"]))
    regions = {
        dim: _data_blocks(pivots_of(made, dim), some, max(1, block_values // max(dim, 1)))
        for dim, some in found.items()
    }
    # rows of a query's own id are no candidates, so so many more must be certain
    own = everything.groupBy("vec_id").count().agg(F.max("count")).first()[0] or 0
    asking = _placed(
        rows.filter("_asks and vec_id is not null").select("vec_id", "dim", "v").distinct(), made
    )
    counts = [tuple(r) for r in asking.groupBy("dim", "cell").count().collect()]
    blocks = _query_blocks(counts, query_block_values)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Send each query to the parts of the regions that it needs."""
        for batch in batches:
            for dim, some in _by_dim(batch):
                q = _matrix(some.column("v"), dim)
                there = regions[dim]
                needs = pivots_of(made, dim).needed(q, there, k + own)
                cell = some.column("cell").to_pylist()
                mark = some.column("_m").to_pylist()
                place = [
                    blocks[dim, c][0] + m % blocks[dim, c][1]
                    for c, m in zip(cell, mark, strict=True)
                ]
                # a block is needed if one of its regions is
                wanted: dict[int, np.ndarray] = {}
                for i, (*_, first, parts) in enumerate(there):
                    for to in range(first, first + parts):
                        wanted[to] = wanted.get(to, False) | needs[:, i]
                for to, by in wanted.items():
                    at = np.flatnonzero(by)
                    if not len(at):
                        continue
                    sent = some.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays(
                        [
                            sent.column("vec_id"), sent.column("_q"), sent.column("v"),
                            sent.column("dim"), pa.array([to] * len(at), pa.int32()),
                            pa.array([place[j] for j in at], pa.int32()),
                        ],
                        ["query_id", "_q", "v", "dim", "to", "block"],
                    )

    spark = vectors.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the mark of id and vector deals out the queries of one very common vector, too
    marked = asking.select("*", F.xxhash64("v").alias("_q"), F.xxhash64("vec_id", "v").alias("_m"))
    sent = marked.repartition(tasks, "_m").mapInArrow(
        spread, "query_id long, _q long, v array<double>, dim int, to int, block int"
    )
    numbered = [(dim, r[0], r[1], *r[4:]) for dim, some in regions.items() for r in some]
    names = F.broadcast(  # as many rows as the summary
        spark.createDataFrame(numbered, "dim int, cell int, ring int, first int, parts int")
    )
    meet = ["dim", "to"]
    pairs = sent.select(*meet, F.col("block").alias("_by")).distinct()
    part = F.pmod(F.xxhash64("vec_id", "v"), "parts").cast("int")
    data = (
        everything.join(names, ["dim", "cell", "ring"])
        .withColumn("to", F.col("first") + part)
        .join(pairs, meet)
        .select(*[F.col(c).alias(f"_{c}") for c in meet], "_by", "vec_id", "v")
    )
    met = (
        sent.groupBy(*meet, "block")
        .cogroup(data.groupBy(*[f"_{c}" for c in meet], "_by"))
        .applyInArrow(_solver(k), "query_id long, _q long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id", "_q").orderBy(
        F.desc("score"), F.col("vec_id").asc_nulls_last()
    )
    return (
        met.withColumn("rank", F.row_number().over(best).cast("int"))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
