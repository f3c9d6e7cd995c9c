"""Chat formatting after collapsing cumulative snapshots.

A conversation that was logged again and again while it grew is there many times,
each time as a prefix of the next. Rolling hashes over turns name every prefix; a
conversation whose whole hash is a proper prefix of another goes, of equal ones the
first stays, and what is left is rendered. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from caseloom.operators.scaling import Staging, dense_index, running

BLOCK_TURNS = 1024
"""So many turns at most are hashed, or rendered into one segment, as one group."""

# What stands around a turn.
TURN_OPEN, TURN_CLOSE = "<|im_start|>", "<|im_end|>"


def _turns(df: DataFrame) -> DataFrame:
    """Turns with ``conv``, the id in a struct, which is never null and so can be joined."""
    return df.select(
        F.struct("conv_id").alias("conv"),
        F.coalesce(F.col("turn"), F.lit(-1)).cast("bigint").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).withColumns({"a": F.xxhash64("role", "text"), "b": F.xxhash64("text", F.lit("|"), "role")})


def numbered(turns: DataFrame, staging: Staging) -> DataFrame:
    """``(conv, block, turn, a, b, n)`` for every different turn, ``n`` from 1.

    Turns are counted by range of (conversation, number, role, hashes), so one
    conversation may hold any share of them under any numbers. A ``block`` is
    ``BLOCK_TURNS`` places, so it has no more turns than that.
    """
    apart = turns.select("conv", "turn", "role", "a", "b").distinct()
    return staging.table(
        dense_index(apart, ["conv"], ["turn", "role", "a", "b"], "r", staging).select(
            "conv",
            F.floor(F.col("r") / BLOCK_TURNS).alias("block"),
            "turn",
            "a",
            "b",
            (F.col("r") + 1).alias("n"),
        ),
        "turns",
    )


def prefixes(turns: DataFrame, staging: Staging) -> DataFrame:
    """``(conv, n, h1, h2, last)`` for every numbered turn: hashes of the first ``n`` turns.

    A hash is the exclusive-or of its turns' hashes, each taken with its place, so
    blocks of a long conversation are hashed side by side: rolling hashes come from
    those of the blocks before, which are taken together by range. No task sorts more
    than a block.
    """
    placed = turns.select(
        "conv", "block", "n", F.xxhash64("a", "n").alias("a"), F.xxhash64("b", "n").alias("b")
    )
    blocks = placed.groupBy("conv", "block").agg(
        F.bit_xor("a").alias("a_own"), F.bit_xor("b").alias("b_own"), F.max("n").alias("end")
    )
    rolled = running(
        blocks,
        ["conv"],
        ["block"],
        staging,
        {"a0": ("bit_xor", F.col("a_own")), "b0": ("bit_xor", F.col("b_own"))},
        {"total": ("max", F.col("end"))},
    ).select("conv", "block", "a0", "b0", "total")
    so_far = W.partitionBy("conv", "block").orderBy("n").rowsBetween(W.unboundedPreceding, 0)
    inside = placed.select(
        "conv",
        "block",
        "n",
        F.bit_xor("a").over(so_far).alias("a"),
        F.bit_xor("b").over(so_far).alias("b"),
    )
    return inside.join(rolled, ["conv", "block"]).select(
        "conv",
        "n",
        F.col("a").bitwiseXOR(F.col("a0")).alias("h1"),
        F.col("b").bitwiseXOR(F.col("b0")).alias("h2"),
        (F.col("n") == F.col("total")).alias("last"),
    )


def maximal(turns: DataFrame, staging: Staging) -> DataFrame:
    """``(conv, n_turns, n_copies)`` of conversations no other one continues.

    ``n_copies`` counts the conversations with the same turns, of which the one with
    the smallest id stays. Prefixes are distinct before they are compared, so an
    opening that thousands of conversations share is one row.
    """
    known = staging.table(prefixes(turns, staging), "prefixes")
    key = ["n", "h1", "h2"]
    ends = (
        known.filter("last")
        .groupBy(*key)
        .agg(
            # a null id is taken only where there is no other
            F.struct(F.min("conv.conv_id").alias("conv_id")).alias("conv"),
            F.count(F.lit(1)).alias("n_copies"),
        )
    )
    inner = known.filter(~F.col("last")).select(*key).distinct()
    return ends.join(inner, key, "left_anti").select("conv", F.col("n").alias("n_turns"), "n_copies")


def rendered(turn: Column) -> Column:
    return F.concat(
        F.lit(TURN_OPEN), turn["role"], F.lit("\n"), turn["text"], F.lit(TURN_CLOSE + "\n")
    )


def format_chats(df: DataFrame, staging: Staging) -> DataFrame:
    """``(conv_id, n_turns, n_copies, segment, text)``: maximal conversations, rendered.

    ``df`` needs ``conv_id``, ``turn``, ``role`` and ``text``; other columns are left
    out. Turns go by number, then role, then a hash of role and text, so ties have an
    order; a null number comes first, null role and text count as empty. A row repeated
    as it stands is one turn. Rows without ``conv_id`` are one conversation. A
    conversation is a segment for each ``BLOCK_TURNS`` turns, counted by place, to be
    joined in order; hardly any has more than one. Texts may have any length. An empty
    table gives an empty one.
    """
    turns = _turns(df)
    places = numbered(turns, staging)
    kept = staging.table(maximal(places, staging), "maximal")
    key = ["conv", "turn", "a", "b"]
    where = places.join(kept, "conv").select(
        *key, "n", "n_turns", "n_copies", F.col("block").alias("segment")
    )
    # repeated rows are folded before the shuffle of texts, which the join then shares
    once = turns.groupBy(*key).agg(F.first(F.struct("role", "text")).alias("said"))
    return (
        once.join(where, key)
        .groupBy("conv", "n_turns", "n_copies", "segment")
        .agg(F.sort_array(F.collect_list(F.struct("n", "said.role", "said.text"))).alias("turns"))
        .select(
            "conv.conv_id",
            "n_turns",
            "n_copies",
            "segment",
            F.array_join(F.transform("turns", rendered), "").alias("text"),
        )
    )


def op10_chat_format(spark, sf: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return format_chats(turns, Staging(spark))


ORACLE = {
    "op10_chat_format": f"""
WITH t AS (
  SELECT DISTINCT conv_id, coalesce(turn, -1) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
), c AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(md5(role || chr(0) || text), '' ORDER BY turn, role, text) AS path
  FROM t GROUP BY conv_id
), u AS (SELECT min(conv_id) AS conv_id, n_turns, path, count(*) AS n_copies FROM c GROUP BY n_turns, path),
m AS (
  SELECT * FROM u a WHERE NOT EXISTS (
    SELECT 1 FROM u b WHERE b.n_turns > a.n_turns AND starts_with(b.path, a.path))
)
SELECT t.conv_id, n_turns, n_copies, place // {BLOCK_TURNS} AS segment,
  string_agg('{TURN_OPEN}' || role || chr(10) || text || '{TURN_CLOSE}' || chr(10), '' ORDER BY place) AS text
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS place FROM t) t JOIN m ON t.conv_id IS NOT DISTINCT FROM m.conv_id
GROUP BY t.conv_id, n_turns, n_copies, segment
"""
}
QUERIES = {"op10_chat_format": op10_chat_format}
