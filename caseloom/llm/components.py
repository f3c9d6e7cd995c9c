"""Connected components of a table of links, without gathering a component anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.operators.scaling import Staging


def components(links: DataFrame, staging: Staging, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``links (a, b)``; the root is the smallest node reachable.

    Rounds of large and small stars: each node points its larger neighbours, then
    itself and its smaller ones, at its smallest neighbour, until every node points
    at its root. A round is a few aggregations and joins whose one side has a row per
    node, so a node with many links is pre-aggregated on one side and split on the
    other. Every round is stored in the shared folder. Links of a node to itself,
    repeated links and nulls add nothing; no links, no rows.
    """
    edges = staging.table(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    before = _fingerprint(edges)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        )
        large = staging.table(large, "large")
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(lowest, "a")
            .filter("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionAll(lowest.select("a", F.col("m").alias("b")))
            .distinct()
        )
        edges = staging.table(small, "small")
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components are not settled after {max_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _fingerprint(edges: DataFrame) -> tuple[int, int]:
    """Count of rows and an order-free checksum."""
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"] or 0
