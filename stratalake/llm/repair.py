"""Conversation structure repair by weighted interval parsing (operator 12).

A conversation should read ``(s?(ua)+)?`` in role initials. The repair grammar is in
Chomsky normal form: a nonterminal (x, y) derives the spans of rows whose edits take
the reading from state x to state y, with (x, z) -> (x, y) (y, z) for two spans and
(x, y) -> one row, kept, re-roled or deleted, after the insertions that lead there
(the insertion closure, taken into the terminal rules). A cell of the chart holds the
least (cost, audit) of each nonterminal over a span; cells are combined bottom-up by
the length of the span over all places to split it.

Two audits of equal cost over the same rows are never one the other's beginning, as
the longer would cost more by its insertions. So the least pair of a whole is made of
the least pairs of its parts, and a chart over a few rows is itself one cell of a
chart over charts. Charts hold ``CHART`` cells at most: long conversations are parsed
level by level, each level spread over the cluster, and none is cubic in its rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import settled

CHART = 8
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

# --- fixed values: the grammar's states, in order: nothing read, s, u, a -----------
START, SYSTEM, USER, ASSISTANT = range(4)
# what reading an initial leads to, by the state before it
READS = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
# states from which nothing, one row or two rows must follow
OPEN = {START: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}
LEGAL = ("su", "ua", "au")

_STATES = range(4)
Cell = dict[tuple[int, int], tuple[int, str]]


def _closure() -> dict[tuple[int, int], int]:
    """Least insertions (user and assistant rows) that lead from one state to another."""
    least = {(x, x): 0 for x in _STATES}
    for _ in _STATES:
        for (x, y), n in list(least.items()):
            for initial in "ua":
                if y in READS[initial]:
                    z = READS[initial][y]
                    least[x, z] = min(least.get((x, z), n + 1), n + 1)
    return least


_INSERTIONS = _closure()


@lru_cache(maxsize=64)
def leaf(code: str) -> Cell:
    """The cell of one row: an initial, upper case if truncated, or ``D``, deleted."""
    edits: list[tuple[int, int, int, str]] = [(y, y, DELETE, "D") for y in _STATES]
    if code != "D":
        cut = TRUNCATED if code.isupper() else 0
        for y, z in READS.get(code.lower(), {}).items():
            edits.append((y, z, KEEP + cut, "K"))
        for initial in "ua":
            for y, z in READS[initial].items():
                edits.append((y, z, REROLE + cut, "R"))
    cell: Cell = {}
    for (x, y), n in _INSERTIONS.items():
        for before, z, cost, mark in edits:
            if before == y:
                made = (INSERT * n + cost, "I" * n + mark)
                cell[x, z] = min(cell.get((x, z), made), made)
    return cell


def join_cells(left: Cell, right: Cell, into: Cell) -> None:
    """The binary rule: ``into`` takes what a split into these two spans makes better."""
    for (x, y), (cost, audit) in left.items():
        for z in _STATES:
            other = right.get((y, z))
            if other is not None:
                best = into.get((x, z))
                total = cost + other[0]
                if best is None or total <= best[0]:
                    made = (total, audit + other[1])
                    if best is None or made < best:
                        into[x, z] = made


def parse(leaves: list[Cell]) -> Cell:
    """The cell of a whole chart, combined bottom-up by the length of the span."""
    n = len(leaves)
    chart = {(i, i + 1): cell for i, cell in enumerate(leaves)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cell: Cell = {}
            for split in range(i + 1, i + length):
                join_cells(chart[i, split], chart[split, i + length], cell)
            chart[i, i + length] = cell
    return chart[0, n]


@lru_cache(maxsize=100_000)
def parse_codes(codes: str) -> Cell:
    return parse([leaf(c) for c in codes])


def finish(cell: Cell) -> tuple[int, str]:
    """Least (cost, audit) of a whole conversation, insertions after its last row told."""
    ends = []
    for y, missing in OPEN.items():
        if (START, y) in cell:
            cost, audit = cell[START, y]
            ends.append((cost + INSERT * missing, audit + "I" * missing))
    return min(ends)


_CELL = "cell array<struct<x:int,z:int,cost:bigint,audit:string>>"
_CELL_TYPE = pa.list_(
    pa.struct([("x", pa.int32()), ("z", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
)


def _packed(cell: Cell) -> list[dict]:
    return [{"x": x, "z": z, "cost": c, "audit": a} for (x, z), (c, a) in cell.items()]


def _unpacked(rows: list[dict]) -> Cell:
    return {(r["x"], r["z"]): (r["cost"], r["audit"]) for r in rows}


def _with_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_c, chunk, codes) to (_c, chunk, cell)."""
    for batch in batches:
        cells = [_packed(parse_codes(codes)) for codes in batch.column("codes").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_c"), batch.column("chunk"), pa.array(cells, _CELL_TYPE)],
            ["_c", "chunk", "cell"],
        )


def _joined_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_c, chunk, cells in order) to (_c, chunk, cell)."""
    for batch in batches:
        cells = [
            _packed(parse([_unpacked(c) for c in row])) for row in batch.column("cells").to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_c"), batch.column("chunk"), pa.array(cells, _CELL_TYPE)],
            ["_c", "chunk", "cell"],
        )


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_c, cell) to (_c, cost, audit)."""
    for batch in batches:
        done = [finish(_unpacked(c)) for c in batch.column("cell").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_c"),
                pa.array([d[0] for d in done], pa.int64()),
                pa.array([d[1] for d in done], pa.string()),
            ],
            ["_c", "cost", "audit"],
        )


def cheapest_edits(codes: DataFrame, chart: int = CHART) -> DataFrame:
    """(_c, cost, audit) of each conversation from its rows (_c, n from 1, code).

    Charts of ``chart`` rows are parsed first, then charts of their cells, as often as
    the longest conversation needs. A group holds ``chart`` rows or cells at most.
    """
    longest = codes.agg(F.max("n")).first()[0] or 0
    own = F.array_sort(F.collect_list(F.struct("n", "code")))
    cells = (
        codes.groupBy("_c", F.floor((F.col("n") - 1) / chart).alias("chunk"))
        .agg(F.array_join(F.transform(own, lambda r: r["code"]), "").alias("codes"))
        .mapInArrow(_with_cells, f"_c string, chunk bigint, {_CELL}")
    )
    reach = chart
    while reach < longest:
        parts = F.array_sort(F.collect_list(F.struct("chunk", "cell")))
        cells = (
            settled(cells).groupBy("_c", F.floor(F.col("chunk") / chart).alias("chunk"))
            .agg(F.transform(parts, lambda r: r["cell"]).alias("cells"))
            .mapInArrow(_joined_cells, f"_c string, chunk bigint, {_CELL}")
        )
        reach *= chart
    return cells.select("_c", "cell").mapInArrow(_finished, "_c string, cost bigint, audit string")


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, each conversation's audit before its turns, to the repaired turns."""
    names = ["_c", "position", "edit", "role", "text"]
    conversation, audit, at, state, position = None, "", 0, START, 0
    out: list[list] = [[], [], [], [], []]

    def put(edit: str, role: str, text: str) -> None:
        nonlocal position
        position += 1
        for column, value in zip(out, (conversation, position, edit, role, text)):
            column.append(value)

    def said(initial: str | None = None) -> str:
        """The role that comes next, and the step to its state."""
        nonlocal state
        if initial is None:
            initial = "a" if state == USER else "u"
        state = READS[initial][state]
        return "assistant" if initial == "a" else "user"

    def insertions() -> None:
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            at += 1
            put("I", said(), "")

    def made() -> pa.RecordBatch:
        types = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)
        for column in out:
            column.clear()
        return batch

    for batch in batches:
        columns = [batch.column(n) for n in ("_c", "n", "role", "text", "audit")]
        for i in range(batch.num_rows):
            conv, n, role, text, plan = (c[i].as_py() for c in columns)
            if n == 0:
                insertions()  # after the last row of the conversation before
                conversation, audit, at, state, position = conv, plan or "", 0, START, 0
                continue
            insertions()
            edit = audit[at]
            at += 1
            if edit == "K":
                said(role[0])
                put("K", role, text)
            elif edit == "R":
                put("R", said(), text)
        if out[0]:
            yield made()
    insertions()
    if out[0]:
        yield made()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired turns in order to the hash of each conversation, a turn at a time."""
    now, digest = None, None
    done: list[tuple[str, str]] = []

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([d[k] for d in done], pa.string()) for k in (0, 1)], ["_c", "sha"]
        )

    for batch in batches:
        conversations, roles, texts = (
            batch.column(n).to_pylist() for n in ("_c", "role", "text")
        )
        done = []
        for conv, role, text in zip(conversations, roles, texts):
            if conv != now:
                if digest is not None:
                    done.append((now, digest.hexdigest()))
                now, digest = conv, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        if done:
            yield made()
    if digest is not None:
        done = [(now, digest.hexdigest())]
        yield made()


def _key(conv: Column) -> Column:
    """A conversation's id as text that keeps null apart."""
    return F.when(conv.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), conv.cast("string")))


def examined(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Place, faults and code of rows (_c, live, turn, role, text), and the rows sorted.

    A conversation's rows are sorted and numbered in one stream, which spills; the
    first of equal rows is found by an aggregate and met on its place, so a text that
    a conversation repeats without end is no hot key.
    """
    place = Window.partitionBy("_c").orderBy(
        F.desc("live"), F.asc_nulls_first("turn"), "role", "text"
    )
    initial = F.left(F.col("role"), F.lit(1))
    before = F.lag("turn").over(place)
    trimmed = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\f\r"))
    sorted_ = settled(
        rows.select(
            "_c", "live", "turn", "role", "text",
            F.row_number().over(place).alias("n"),
            (F.col("turn").isNotNull() & (before.isNull() | (before != F.col("turn")))).alias("new_turn"),
            (~F.coalesce(F.concat(F.lag(initial).over(place), initial).isin(*LEGAL), F.lit(True)))
            .alias("illegal"),
            (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
            (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut"),
            F.when(F.left("role", F.lit(1)).isin("s", "u", "a"), F.left("role", F.lit(1)))
            .otherwise("x").alias("initial"),
            F.unhex(F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text").cast("binary")))
            .alias("said"),
        )
    )
    firsts = (
        sorted_.filter("live and not blank").groupBy("_c", "said").agg(F.min("n").alias("n"))
        .select("_c", "n", F.lit(True).alias("_first"))
    )
    slim = sorted_.drop("text", "said").join(firsts, ["_c", "n"], "left")
    duplicate = ~F.col("blank") & F.col("_first").isNull()
    gone = F.col("blank") | F.col("duplicate")
    coded = (
        slim.withColumn("duplicate", duplicate)
        .withColumn("truncated", ~gone & F.col("cut"))
        .withColumn(
            "code",
            F.when(gone, "D").when(F.col("cut"), F.upper("initial")).otherwise(F.col("initial")),
        )
    )
    return coded, sorted_


def _faults(slim: DataFrame) -> DataFrame:
    """A row per conversation: gaps and counts of faults."""

    def count(name: str) -> Column:
        return F.count(F.when(F.col("live") & F.col(name), 1)).alias(name)

    turn = F.when(F.col("live"), F.col("turn"))
    gaps = F.max(turn) - F.min(turn) + 1 - F.count(F.when(F.col("live") & F.col("new_turn"), 1))
    return slim.groupBy("_c").agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"),
        *(count(n) for n in ("blank", "duplicate", "truncated", "illegal")),
    )


def repair_conversations(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    live: Column | None = None,
    chart: int = CHART,
) -> tuple[DataFrame, DataFrame]:
    """The repaired turns of every conversation, and a report per conversation.

    Turns: ``_c`` (the id as text after ``=``, empty for null), position (from 1),
    edit (K, R or I), role, text. Report: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit and repaired_sha256 of the turns as ``role:text`` lines.

    Rows are read by turn (null first), then role, then text; a null role or text is
    one space, and a null id is one conversation. A row's first fault counts: blank,
    a duplicate of role and text said before, truncated (no ``.``, ``!`` or ``?`` last).
    Edits: keep 0, re-role to user or assistant 3, delete 4, which blank and duplicate
    rows must, insert an empty turn 3; truncated rows that stay cost 3 more. The
    cheapest edits that give ``(s?(ua)+)?`` in initials win, ties to the least audit.
    A role without one of these initials, the empty role too, can't be kept.

    Rows where ``live`` is false take no part, but their conversation is reported, all
    zeros if it has no other row. Equal rows are duplicates of each other. Other
    columns are left out. An empty table gives empty results. One conversation's rows
    pass through one task in order, as its audit and its hash are single values, and
    are never held together; its parse is spread over the cluster.
    """
    one = F.lit(True) if live is None else live
    own = rows.select(
        _key(F.col(conv_col)).alias("_c"),
        one.alias("live"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.when(one, F.coalesce(F.col(text_col), F.lit(" "))).otherwise("").alias("text"),
    )
    slim, sorted_ = examined(own)
    slim = settled(slim)
    edits = settled(cheapest_edits(slim.filter("live").select("_c", "n", "code"), chart))
    turns = sorted_.filter("live").select(
        "_c", F.col("n").cast("long").alias("n"), "role", "text",
        F.lit(None).cast("string").alias("audit"),
    )
    plans = edits.select(
        "_c", F.lit(0).cast("long").alias("n"), F.lit("").alias("role"), F.lit("").alias("text"), "audit",
    )
    repaired = (
        turns.unionByName(plans).repartition("_c").sortWithinPartitions("_c", "n")
        .mapInArrow(_repaired, "_c string, position long, edit string, role string, text string")
    )
    # still sorted and unshuffled, so a task hashes its conversations one after another
    hashes = repaired.mapInArrow(_hashed, "_c string, sha string")
    report = (
        _faults(slim).join(edits, "_c", "left").join(hashes, "_c", "left")
        .select(
            F.when(F.col("_c") != "", F.expr("substr(_c, 2)"))
            .cast(rows.schema[conv_col].dataType).alias("conv_id"),
            "gaps", "blank", "duplicate", "truncated", "illegal",
            F.coalesce("cost", F.lit(0)).cast("long").alias("cost"),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
        )
    )
    return repaired, report


def damaged(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Rows with faults put in by a hash of id and turn, to try the repair on.

    Nulls are read as one space, in the hash too. Of twenty hashes, one drops the row
    (``live`` false), one empties its text, one takes its ``.!?`` away, one repeats it
    and one makes it the user's.
    """

    def read(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(read(conv_col), F.lit(":"), read(turn_col)).cast("binary")) % 20
    text, role = read(text_col), read(role_col)
    return (
        rows.select(
            F.col(conv_col).alias("conv_id"),
            F.col(turn_col).alias("turn"),
            F.when(fate == 4, "user").otherwise(role).alias("role"),
            F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text)
            .alias("text"),
            (fate != 0).alias("live"),
            F.explode(F.when(fate == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
            .alias("_copy"),
        ).drop("_copy")
    )
