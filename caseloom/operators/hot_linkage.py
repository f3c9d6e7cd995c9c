"""Matching within keys that hold too many rows to gather.

What notifications of a key can see of each other's choices is limited by the window:
where no notification reaches an admission across a moment, the key falls into two
pieces that do not influence each other. So

* keys of moderate size are matched in a task each, by numbers and times only;
* larger ones are cut at such moments, found by running extremes over ranges of
  time, and their pieces are matched side by side in the same way;
* a piece that is still too large has its notifications folded in chunks of bounded
  size, every chunk seeing only the next unused admissions it could possibly take;
  what has been used is carried as a count per admission cell.

The result is that of the row-by-row fold in every case.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from caseloom.operators.scaling import Staging, dense_index, join_checked, running

DAY_US = 86_400_000_000


@dataclass(frozen=True)
class HotSizes:
    """Rows a side that are matched in one task; notifications and admissions of a chunk."""

    group_rows: int = 20_000
    chunk_rows: int = 100_000
    chunk_cells: int = 4_000_000


# ---------------------------------------------------------------------------
# The fold
# ---------------------------------------------------------------------------
def _fold(
    at: np.ndarray,
    cells: np.ndarray,
    queues: Sequence[np.ndarray],
    free: np.ndarray,
    window_days: int,
) -> list[tuple[int, int, int, int, bool]]:
    """``(notification, cell, head, days, collided)`` of notifications ``at``, in order.

    ``cells`` are times, rising; the admissions of a cell, in order, are its queue, and
    ``free`` tells how many of them are left. All admissions of a cell look alike to
    every notification but for their order.
    """
    far = np.iinfo(np.int64).max
    heads = np.array([q[0] if len(q) else far for q in queues], dtype=np.int64)
    taken = [0] * len(queues)
    free = free.copy()
    low = np.searchsorted(cells, at - window_days * DAY_US)
    high = np.searchsorted(cells, at + (window_days + 1) * DAY_US)
    out = []
    for i in np.flatnonzero(low < high).tolist():
        reach = slice(low[i], high[i])
        left = free[reach]
        unused = int(left.sum())
        if not unused:
            continue
        days = np.where(left > 0, np.abs((cells[reach] - at[i]) // DAY_US), far)
        least = days.min()
        c = int(low[i]) + int(np.where(days == least, heads[reach], far).argmin())
        out.append((i, c, int(heads[c]), int(least), unused > 1))
        taken[c] += 1
        free[c] -= 1
        heads[c] = queues[c][taken[c]] if taken[c] < len(queues[c]) else far
    return out


def _clock_cells(notified: np.ndarray, admitted: np.ndarray) -> np.ndarray:
    """The moment each admission's cell begins.

    Days end at the times of day notifications have: between two of them, admissions
    are equally many days away from every notification.
    """
    clock = np.unique(notified % DAY_US)
    time = admitted % DAY_US
    place = np.searchsorted(clock, time, side="right") - 1
    begins = np.where(place >= 0, clock[place], clock[-1] - DAY_US)
    return admitted - time + begins


# ---------------------------------------------------------------------------
# Keys and pieces of moderate size: one group each
# ---------------------------------------------------------------------------
def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one key after the other, from batches sorted by key."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        keys = batch.column("_key").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for start, end in zip(cuts, cuts[1:]):
            if start == end:
                continue
            if held and keys[start] != current:
                yield pa.Table.from_batches(held)
                held = []
            current = keys[start]
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def _match_groups(events: DataFrame, window_days: int) -> DataFrame:
    """Matches of keys that one task can hold."""
    kind = events.schema["ord"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            side = group.column("notified").to_numpy()
            at = group.column("at").to_numpy()
            # rows come in order, admissions first
            split = int(np.searchsorted(side, True))
            admitted, notified = at[:split], at[split:]
            if not len(admitted) or not len(notified):
                continue
            begins = _clock_cells(notified, admitted)
            by_cell = np.argsort(begins, kind="stable")
            cells, first = np.unique(begins[by_cell], return_index=True)
            queues = np.split(by_cell, first[1:])
            free = np.array([len(q) for q in queues])
            found = _fold(notified, cells, queues, free, window_days)
            if not found:
                continue
            n, _, h, days, collided = zip(*found)
            ord_ = group.column("ord").combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [
                    ord_.take(pa.array(np.array(n) + split)),
                    ord_.take(pa.array(h)),
                    pa.array(days, pa.int32()),
                    pa.array(collided, pa.bool_()),
                ],
                names=["_n_ord", "_h_ord", "days", "collided"],
            )

    parts = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        events.repartition(parts, "_key")
        .sortWithinPartitions("_key", "notified", "ord")
        .mapInArrow(run, f"_n_ord {kind}, _h_ord {kind}, days int, collided boolean")
    )


# ---------------------------------------------------------------------------
# Pieces
# ---------------------------------------------------------------------------
def cut_at_gaps(events: DataFrame, window_days: int, staging: Staging) -> DataFrame:
    """``events`` with keys that name the piece as well.

    A key is cut before a moment if no notification earlier reaches an admission from
    there on, and none from there on reaches an earlier one. The nearest on both sides
    decide; they are running extremes over distinct moments.
    """
    times = events.groupBy("_key", "at").agg(
        F.max(F.when(F.col("notified"), F.col("at"))).alias("n"),
        F.max(F.when(~F.col("notified"), F.col("at"))).alias("h"),
    )
    near = running(
        times,
        ["_key"],
        ["at"],
        staging,
        {"last_n": ("max", F.col("n")), "last_h": ("max", F.col("h"))},
        {"next_n": ("min", F.col("n")), "next_h": ("min", F.col("h"))},
    )
    day = F.lit(DAY_US)
    apart = F.coalesce(F.col("next_h") - F.col("last_n") >= (window_days + 1) * day, F.lit(True))
    apart = apart & F.coalesce(F.col("next_n") - F.col("last_h") > window_days * day, F.lit(True))
    begins = near.select("_key", "at", F.when(apart, F.col("at")).alias("begins"))
    pieces = running(
        begins, ["_key"], ["at"], staging, {"begun": ("max", F.col("begins"))}
    ).select(
        "_key",
        "at",
        F.concat_ws("\u001e", "_key", F.coalesce("begins", "begun").cast("string")).alias("piece"),
    )
    return events.join(pieces, ["_key", "at"]).select(
        F.col("piece").alias("_key"), "notified", "ord", "at"
    )


def _sizes(events: DataFrame) -> DataFrame:
    return events.groupBy("_key").agg(
        F.count_if("notified").alias("n_rows"), F.count_if(~F.col("notified")).alias("h_rows")
    )


# ---------------------------------------------------------------------------
# Pieces that are still too large: chunks
# ---------------------------------------------------------------------------
def _span(at: Column, window_days: int) -> Column:
    """Number of the span of days a time lies in; spans are as long as the reach."""
    return F.floor(at / F.lit((window_days + 1) * DAY_US)).cast("int")


def _explode_spans(at: Column, window_days: int) -> Column:
    """The spans, three at most, that hold every time within the window."""
    back, ahead = window_days * DAY_US, (window_days + 1) * DAY_US
    return F.explode(F.sequence(_span(at - back, window_days), _span(at + ahead, window_days)))


def with_cells(events: DataFrame, staging: Staging) -> DataFrame:
    """Admissions ``(_key, ord, cell)``; what :func:`_clock_cells` does, for keys of any size."""
    clock = F.pmod(F.col("at"), F.lit(DAY_US))
    times = events.select("_key", clock.alias("clock"), F.col("notified").alias("mark")).distinct()
    marked = times.groupBy("_key", "clock").agg(F.bool_or("mark").alias("mark"))
    mark = F.when(F.col("mark"), F.col("clock"))
    last = running(marked, ["_key"], ["clock"], staging, {"earlier": ("max", mark)})
    latest = marked.groupBy("_key").agg((F.max(mark) - F.lit(DAY_US)).alias("overnight"))
    begins = last.join(latest, "_key").select(
        "_key", "clock", F.coalesce(mark, F.col("earlier"), F.col("overnight")).alias("begins")
    )
    admitted = events.filter(~F.col("notified")).withColumn("clock", clock)
    return admitted.join(begins, ["_key", "clock"]).select(
        "_key", "ord", (F.col("at") - F.col("clock") + F.col("begins")).alias("cell")
    )


def _fold_chunk(window_days: int):
    """Matches of one chunk of one key, as a function of two Arrow tables.

    ``runs`` has the next admissions of a cell in lists, one for each stored run of them.
    """

    def fold(chunk: pa.Table, runs: pa.Table) -> pa.Table:
        if not chunk.num_rows or not runs.num_rows:
            return _MATCH_ARROW.empty_table()
        runs = runs.sort_by([("cell", "ascending"), ("run", "ascending")])
        chunk = chunk.sort_by("n_seq")
        cells, first = np.unique(runs.column("cell").to_numpy(), return_index=True)
        lists = runs.column("heads").combine_chunks()
        heads = lists.flatten().to_numpy()
        ends = np.cumsum(lists.value_lengths().to_numpy())
        queues = np.split(heads, ends[first[1:] - 1])
        free = runs.column("free").to_numpy()[first]
        found = _fold(chunk.column("at").to_numpy(), cells, queues, free, window_days)
        if not found:
            return _MATCH_ARROW.empty_table()
        n, c, h, days, both = zip(*found)
        key = pa.repeat(chunk.column("_key")[0].as_py(), len(n))
        seq = chunk.column("n_seq").to_numpy()[list(n)]
        columns = [key, seq, h, cells[list(c)], days, both]
        return pa.table([pa.array(v, f.type) for v, f in zip(columns, _MATCH_ARROW)], schema=_MATCH_ARROW)

    return fold


_MATCH_SCHEMA = "_key string, n_seq bigint, h_seq bigint, cell bigint, days int, collided boolean"
_MATCH_ARROW = pa.schema(
    [
        ("_key", pa.string()),
        ("n_seq", pa.int64()),
        ("h_seq", pa.int64()),
        ("cell", pa.int64()),
        ("days", pa.int32()),
        ("collided", pa.bool_()),
    ]
)
# Admissions of a cell that are stored in one row
RUN_ROWS = 1024


def _match_chunks(
    events: DataFrame, window_days: int, sizes: HotSizes, staging: Staging
) -> DataFrame:
    admitted = dense_index(with_cells(events, staging), ["_key"], ["ord"], "h_seq", staging)
    admitted = dense_index(admitted, ["_key", "cell"], ["h_seq"], "idx", staging)
    admitted = staging.table(admitted, "hot-admissions")
    # a chunk asks many cells for their next admissions: it gets them in runs, not row by row
    stored = staging.table(
        admitted.groupBy("_key", "cell", F.floor(F.col("idx") / RUN_ROWS).cast("int").alias("run"))
        .agg(F.sort_array(F.collect_list("h_seq")).alias("h_seqs")),
        "hot-runs",
    )
    state = staging.table(
        admitted.groupBy("_key", "cell")
        .agg(F.count(F.lit(1)).alias("capacity"))
        .withColumn("span", _span(F.col("cell"), window_days))
        .withColumn("consumed", F.lit(0).cast("bigint")),
        "hot-cells",
    )

    # A chunk shrinks where its notifications can see many cells, so that it
    # never asks for more than ``chunk_cells`` admissions at once.
    around = W.partitionBy("_key").orderBy("span").rangeBetween(-2, 0)
    visible = (
        state.groupBy("_key", "span")
        .agg(F.count(F.lit(1)).alias("_cells"))
        .withColumn("_cells", F.sum("_cells").over(around))
        .groupBy("_key")
        .agg(F.max("_cells").alias("_cells"))
    )
    size = F.greatest(
        F.lit(1),
        F.least(F.lit(sizes.chunk_rows), F.floor(F.lit(sizes.chunk_cells) / F.col("_cells"))),
    )
    notified = events.filter("notified").select("_key", "ord", "at")
    numbered = join_checked(
        dense_index(notified, ["_key"], ["ord"], "n_seq", staging), visible, ["_key"]
    ).withColumn("chunk", F.floor(F.col("n_seq") / size).cast("int"))
    numbered = staging.table(
        numbered.drop("_cells").repartition(F.col("chunk"), F.pmod(F.xxhash64("n_seq"), F.lit(16))),
        "hot-notifications",
        ["chunk"],
    )
    last = numbered.agg(F.max("chunk")).first()[0]

    spark = events.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fold = _fold_chunk(window_days)
    found_path = staging.path("matches")
    for number in range(last + 1):
        chunk = numbered.filter(F.col("chunk") == number).select("_key", "n_seq", "at")
        seekers = (
            chunk.groupBy("_key", "at")
            .agg(F.count(F.lit(1)).alias("_seekers"))
            .withColumn("span", _explode_spans(F.col("at"), window_days))
        )
        # No more admissions of a cell can be asked for than there are seekers
        demand = (
            seekers.join(state, ["_key", "span"])
            .groupBy("_key", "cell", "capacity", "consumed")
            .agg(F.sum("_seekers").alias("_demand"))
        )
        # what a run has of the admissions from ``consumed`` on, up to the demand
        begins = F.col("run") * F.lit(RUN_ROWS).cast("bigint")
        low = F.greatest(F.col("consumed") - begins, F.lit(0))
        high = F.least(F.col("consumed") + F.col("_demand") - begins, F.size("h_seqs"))
        runs = (
            join_checked(stored, demand, ["_key", "cell"])
            .filter(high > low)
            .select(
                "_key",
                "cell",
                "run",
                F.slice("h_seqs", (low + 1).cast("int"), (high - low).cast("int")).alias("heads"),
                (F.col("capacity") - F.col("consumed")).alias("free"),
            )
        )
        # partitions counted here are not put together: keys are folded side by side
        found = (
            chunk.repartition(parts, "_key")
            .groupBy("_key")
            .cogroup(runs.repartition(parts, "_key").groupBy("_key"))
            .applyInArrow(fold, _MATCH_SCHEMA)
        )
        target = f"{found_path}/chunk={number}"
        found.write.parquet(target)
        if number == last:
            break
        used = (
            spark.read.schema(_MATCH_SCHEMA)
            .parquet(target)
            .groupBy("_key", "cell")
            .agg(F.count(F.lit(1)).alias("_used"))
        )
        state = staging.table(
            state.join(used, ["_key", "cell"], "left").select(
                "_key",
                "cell",
                "capacity",
                "span",
                (F.col("consumed") + F.coalesce("_used", F.lit(0))).alias("consumed"),
            ),
            f"consumed-{number}",
        )

    matches = spark.read.schema(_MATCH_SCHEMA).parquet(f"{found_path}/chunk=*")
    orders = numbered.select("_key", "n_seq", F.col("ord").alias("_n_ord"))
    return (
        matches.join(orders, ["_key", "n_seq"])
        .join(admitted.select("_key", "h_seq", F.col("ord").alias("_h_ord")), ["_key", "h_seq"])
        .select("_n_ord", "_h_ord", "days", "collided")
    )


# ---------------------------------------------------------------------------
# All hot keys
# ---------------------------------------------------------------------------
def match_hot(
    events: DataFrame, stats: DataFrame, window_days: int, sizes: HotSizes, staging: Staging
) -> DataFrame:
    """``(_n_ord, _h_ord, days, collided)``: matches of ``events (_key, notified, ord, at)``.

    ``stats`` has ``n_rows`` and ``h_rows`` of every key. ``ord``, of any type with an
    order, is unique among notifications and among admissions.
    """

    def of(part: DataFrame, condition: Column, rows: DataFrame) -> DataFrame:
        return join_checked(rows, part.filter(condition).select("_key"), ["_key"], "left_semi")

    two_sided = (F.col("n_rows") > 0) & (F.col("h_rows") > 0)
    fits = (F.col("n_rows") <= sizes.group_rows) & (F.col("h_rows") <= sizes.group_rows)
    matches = [_match_groups(of(stats, two_sided & fits, events), window_days)]
    if not stats.filter(two_sided & ~fits).isEmpty():
        cut = cut_at_gaps(of(stats, two_sided & ~fits, events), window_days, staging)
        pieces = staging.table(cut, "pieces")
        counts = staging.table(_sizes(pieces).filter(two_sided), "piece-sizes")
        matches.append(_match_groups(of(counts, fits, pieces), window_days))
        if not counts.filter(~fits).isEmpty():
            large = staging.table(of(counts, ~fits, pieces), "large-pieces")
            matches.append(_match_chunks(large, window_days, sizes, staging))
    return reduce(DataFrame.unionByName, matches)
