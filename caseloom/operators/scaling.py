"""Building blocks that keep jobs safe when one group holds much of the data."""

from __future__ import annotations

import itertools
import re
import tempfile
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from caseloom.errors import ConfigError
from caseloom.functions.text import normalize_text

BROADCAST_ROWS = 100_000


def together(tasks: Mapping[str, Callable[[], Any]]) -> dict[str, Any]:
    """Run independent jobs at the same time, so that small ones fill idle cores."""
    spark = SparkSession.active()
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        running = {
            name: pool.submit(inheritable_thread_target(spark)(task))
            for name, task in tasks.items()
        }
        return {name: future.result() for name, future in running.items()}


def shared_folder(spark: SparkSession) -> str:
    """The folder driver and executors share: the session's, else the context's.

    Without either, a temp folder serves a ``local[...]`` master, where driver and
    executors are one process; any other master is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if re.match(r"local(\[|$)", spark.sparkContext.master):
        return tempfile.mkdtemp(prefix="caseloom-")
    raise ConfigError(
        "no folder for intermediate tables: set spark.checkpoint.dir to one that all executors"
        " share, or name a folder"
    )


class Staging:
    """Intermediate tables in ``folder``, by default the cluster's shared checkpoint folder.

    A staged table cuts lineage, survives the loss of executors and, being
    Parquet, is read back with column pruning.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None) -> None:
        base = folder or shared_folder(spark)
        self.spark = spark
        self.root = f"{base.rstrip('/')}/caseloom-{uuid.uuid4().hex}"
        self._numbers = itertools.count(1)

    def path(self, name: str) -> str:
        return f"{self.root}/{next(self._numbers):03d}-{name}"

    def table(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write ``df`` and return it as a scan of what was written."""
        target = self.path(name)
        df.write.partitionBy(*partition_by).parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def clear(self) -> None:
        """Delete this run's tables; only once nothing reads from them any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def holds_at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has no more than ``rows`` rows, without counting further."""
    return df.limit(rows + 1).count() <= rows


def join_checked(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Broadcast ``small`` if its counted size allows, else join by shuffle.

    Past the limit the choice is Spark's; adaptive execution then splits the
    partitions a hot key fills.
    """
    side = F.broadcast(small) if holds_at_most(small, max_rows) else small
    return big.join(side, list(on), how)


def catalog_join(
    df: DataFrame, value: Column, catalog: DataFrame, output: str, default: str
) -> DataFrame:
    """Catalog lookup for catalogs kept as a table ``(synonym, canonical)``."""
    entries = catalog.select(
        normalize_text(F.col("synonym")).alias("_key"), F.col("canonical").alias("_canonical")
    ).dropDuplicates(["_key"])
    joined = join_checked(df.withColumn("_key", normalize_text(value)), entries, ["_key"], "left")
    return joined.withColumn(output, F.coalesce("_canonical", F.lit(default))).drop(
        "_key", "_canonical"
    )


def by_dictionary(
    df: DataFrame,
    column: str,
    change: Callable[[DataFrame], DataFrame],
    staging: Staging,
    max_share: float = 0.1,
) -> DataFrame:
    """``change`` of one text column, worked out once for every different value.

    ``change`` maps a table with ``column`` to one with it changed, row by row, and looks
    at no other column. One narrow scan estimates how many values there are; where they
    repeat - typed categories do - it is applied to the distinct ones, and rows look
    theirs up. Where values are mostly different, or too many to send to every task
    (counted), rows are changed as they stand. Either way the rows are the same.
    """
    guess = df.agg(
        F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(column).alias("values")
    ).first()
    if guess["values"] > max_share * guess["rows"] or guess["values"] > BROADCAST_ROWS:
        return change(df)
    key = f"_{column}_before"
    values = df.select(column).distinct()
    # names are the caller's: the changed column stands beside a copy of the old one
    known = staging.table(
        change(values.withColumn(key, F.col(column))).select(key, F.col(column).alias("_after")),
        "dictionary",
    )
    if not holds_at_most(known, BROADCAST_ROWS):
        return change(df)
    joined = df.join(F.broadcast(known), F.col(column).eqNullSafe(F.col(key)), "left")
    return joined.select(
        *[F.col("_after").alias(c) if c == column else F.col(f"`{c}`") for c in df.columns]
    )


def running(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    staging: Staging,
    earlier: Mapping[str, tuple[str, Column]] = {},
    onward: Mapping[str, tuple[str, Column]] = {},
) -> DataFrame:
    """Sums and extremes over a row's neighbours, for groups of any size.

    ``earlier`` maps an output to ``(sum | max | min | bit_xor, value)`` over the rows of the group
    before this one, ``onward`` over this one and those after it. A plain window would
    sort a whole group in one task. Here rows are spread by range of (group, order),
    taken together inside their range, and joined with what the group holds in earlier,
    or later, ranges. ``order`` must be unique in a group, ``groups`` not null.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = [
        (name, kind, value, ahead)
        for ahead, outputs in ((False, earlier), (True, onward))
        for name, (kind, value) in outputs.items()
    ]
    values = {f"_v{i}": value for i, (_, _, value, _) in enumerate(wanted)}
    spread = staging.table(
        df.withColumns(values)
        .repartitionByRange(ranges, *groups, *order)
        .withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    cell = ["_range", *groups]

    def frame(by: Sequence[str], within: Sequence[str], ahead: bool, here: int) -> W:
        # rows that follow come first in falling order: a frame that only grows is summed
        # up row by row, one that ends with the group is summed anew for every row
        ends = [F.col(c).desc() if ahead else F.col(c).asc() for c in within]
        return W.partitionBy(*by).orderBy(*ends).rowsBetween(W.unboundedPreceding, here)

    totals = spread.groupBy(*cell).agg(
        *[getattr(F, kind)(f"_v{i}").alias(f"_t{i}") for i, (_, kind, _, _) in enumerate(wanted)]
    )
    elsewhere = totals.select(
        *cell,
        *[
            getattr(F, kind)(f"_t{i}").over(frame(groups, ["_range"], ahead, -1)).alias(f"_o{i}")
            for i, (_, kind, _, ahead) in enumerate(wanted)
        ],
    )
    inside = spread.withColumns(
        {
            f"_w{i}": getattr(F, kind)(f"_v{i}").over(frame(cell, order, ahead, 0 if ahead else -1))
            for i, (_, kind, _, ahead) in enumerate(wanted)
        }
    )

    def both(i: int, kind: str) -> Column:
        if kind == "sum":
            none = F.lit(0)
            return F.coalesce(f"_w{i}", none) + F.coalesce(f"_o{i}", none)
        if kind == "bit_xor":
            none = F.lit(0).cast("bigint")
            return F.coalesce(f"_w{i}", none).bitwiseXOR(F.coalesce(f"_o{i}", none))
        return (F.greatest if kind == "max" else F.least)(f"_w{i}", f"_o{i}")

    made = {name: both(i, kind) for i, (name, kind, _, _) in enumerate(wanted)}
    helpers = [f"_{letter}{i}" for i in range(len(wanted)) for letter in "vwo"]
    return inside.join(elsewhere, cell).withColumns(made).drop("_range", *helpers)


def prefix_sum(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    weight: Column,
    output: str,
    staging: Staging,
) -> DataFrame:
    """Sum of ``weight`` over the earlier rows of each group, for groups of any size."""
    return running(df, groups, order, staging, {output: ("sum", weight.cast("bigint"))})


def dense_index(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], output: str, staging: Staging
) -> DataFrame:
    """Number the rows of each group from 0 in ``order``."""
    return prefix_sum(df, groups, order, F.lit(1), output, staging)


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float], staging: Staging
) -> DataFrame:
    """``(column, share, value)``: interpolated quantiles of numeric columns.

    Equal values are counted first; the counts are then summed up in value
    order by range, so no task holds the values of a column.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
            for c in columns
        ]
    )
    counted = (
        df.select(F.explode(pairs).alias("p"))
        .filter("p.value IS NOT NULL")
        .groupBy(F.col("p.column").alias("column"), F.col("p.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    ranked = staging.table(
        prefix_sum(counted, ["column"], ["value"], F.col("rows"), "before", staging), "ranked"
    )
    totals = ranked.groupBy("column").agg(F.sum("rows").alias("total"))
    ranks = totals.select(
        "column",
        F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share"),
        (F.col("share") * (F.col("total") - 1)).alias("rank"),
    )
    low, high = F.floor("rank"), F.ceil("rank")

    def value_at(rank: Column) -> Column:
        inside = (F.col("before") <= rank) & (rank < F.col("before") + F.col("rows"))
        return F.max(F.when(inside, F.col("value")))

    # one row per column and share: a bounded side
    return (
        ranked.join(F.broadcast(ranks), "column")
        .filter((F.col("before") <= high) & (F.col("before") + F.col("rows") > low))
        .groupBy("column", "share", "rank")
        .agg(value_at(low).alias("_low"), value_at(high).alias("_high"))
        .select(
            "column",
            "share",
            (F.col("_low") + (F.col("_high") - F.col("_low")) * (F.col("rank") - low)).alias(
                "value"
            ),
        )
    )
