"""Mixing sources to target weights by Pareto order sampling.

What a source should give is a share of all words, limited to a number of times its
own size. A document is due so many copies as its source is due of its size: the
whole ones are certain, the fraction left is its inclusion probability. Of the
fractions a fixed number of documents is taken, those of smallest random odds divided
by inclusion odds. Documents are sampled in classes of nearly equal size, and what a
class takes too much or too little is made up by classes of smaller documents, so that
a source meets its target to some words. Built-in functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from caseloom.operators.scaling import Staging, dense_index, join_checked, prefix_sum

UNIT = 1 << 20
"""Inclusion probabilities are whole multiples of 1 / UNIT, so that their sums are exact."""

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """Weights dealt to sources in order, the most copies of a document, and a seed."""

    weights: tuple[int, ...] = (1, 2, 3)
    max_copies: int = 3
    seed: str = "mix"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def size_class(size: Column) -> Column:
    """Eight classes for every doubling of ``size``, rising with it; small sizes apart."""
    halvings = F.greatest(F.length(F.bin(size)) - 4, F.lit(0))
    return (halvings * 16 + F.floor(size / F.pow(F.lit(2.0), halvings))).cast("int")


def uniform(key: Column) -> Column:
    """A number between 0 and 1, neither included, from a hash of ``key``."""
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(
        float(1 << 52)
    )


def _unit(docs: DataFrame, text: str, weight: Column | None, mix: Mix, keep: list[str]) -> DataFrame:
    """A narrow row per document: what is sampled, with a number of its own for ties."""
    content = F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    named = F.coalesce(F.col("`doc_id`").cast("string"), F.lit("-"))
    weigh = F.greatest(weight.cast("bigint"), F.lit(1)) if weight is not None else F.lit(1)
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
        F.when(F.col("`source`").isNull(), "").otherwise(F.concat(F.lit("="), "`source`")).alias("src"),
        n_words(F.col(f"`{text}`")).alias("size"),
        F.coalesce(weigh, F.lit(1)).cast("bigint").alias("weight"),
        uniform(F.concat_ws("|", F.lit(mix.seed), named, content)).alias("u"),
        F.col("`doc_id`").alias("id"),
        content.alias("content"),
        F.monotonically_increasing_id().alias("tie"),
    ).withColumn("class", size_class(F.col("size")))


def water_level(
    cells: DataFrame, group: str, total: Column, staging: Staging
) -> DataFrame:
    """``(group, level)``: the least level at which ``min(cap, level * weight)`` add up to ``total``.

    ``cells`` has ``group``, ``cell``, ``weight`` and ``cap`` (both whole) and is stored;
    ``total`` is read from the cells' own columns, equal in a group. This is where
    resharing the excess of capped cells by weight ends. Cells are ordered by the level
    at which they are full; sums over earlier ones tell the level if those are the full
    ones. Null where every cell is full.
    """
    ratio = cells.withColumn("full_at", F.col("cap") / F.col("weight"))
    order = ["full_at", "cell"]
    summed = prefix_sum(ratio, [group], order, F.col("cap"), "capped", staging)
    summed = prefix_sum(summed, [group], order, F.col("weight"), "settled", staging)
    weights = cells.groupBy(group).agg(F.sum("weight").alias("all_weight"))
    level = (total - F.col("capped")) / (F.col("all_weight") - F.col("settled"))
    fits = summed.join(weights, group).withColumn("level", level).filter("level <= full_at")
    return fits.groupBy(group).agg(F.min_by("level", F.struct(*order)).alias("level"))


def source_targets(cells: DataFrame, mix: Mix, staging: Staging) -> DataFrame:
    """``(src, source_size, target)`` from cells with ``src`` and ``words``.

    Sources are weighed in order of their names by code point, null last.
    """
    sizes = staging.table(
        cells.groupBy("src").agg(F.sum("words").alias("source_size")), "sources"
    )
    # '' stands for null, every name has a sign before it
    numbered = dense_index(
        sizes.withColumn("all", F.lit(0)).withColumn("last", F.col("src") == ""),
        ["all"],
        ["last", "src"],
        "place",
        staging,
    )
    dealt = F.element_at(
        F.array(*[F.lit(w) for w in mix.weights]),
        (F.col("place") % len(mix.weights) + 1).cast("int"),
    )
    weighed = staging.table(
        numbered.select(
            "all",
            F.col("src").alias("cell"),
            dealt.cast("bigint").alias("weight"),
            (F.col("source_size") * mix.max_copies).alias("cap"),
            "source_size",
        ),
        "weights",
    )
    # one row each
    total = weighed.groupBy("all").agg(F.sum("source_size").alias("total"))
    with_total = weighed.join(F.broadcast(total), "all")
    level = water_level(with_total, "all", F.col("total"), staging)
    cap = F.col("cap").cast("double")
    return weighed.join(F.broadcast(level), "all", "left").select(
        F.col("cell").alias("src"),
        "source_size",
        F.least(cap, F.coalesce(F.col("level") * F.col("weight"), cap)).alias("target"),
    )


def _due(cells: DataFrame, targets: DataFrame, mix: Mix, staging: Staging) -> DataFrame:
    """``cells`` with the ``copies`` certain for each document, and ``part`` of UNIT beyond.

    In a source, what documents are due goes by their weight, with its own water level.
    """
    by_weight = cells.groupBy("src", "weight").agg(F.sum("words").alias("words"))
    levels = staging.table(
        by_weight.join(targets, "src").select(
            "src",
            F.col("weight").alias("cell"),
            (F.col("weight") * F.col("words")).alias("weight"),
            (F.col("words") * mix.max_copies).alias("cap"),
            "target",
        ),
        "due",
    ).filter("cap > 0")
    level = water_level(levels, "src", F.col("target"), staging)
    most = F.lit(float(mix.max_copies))
    due = F.least(most, F.coalesce(F.col("level") * F.col("weight"), most))
    whole = F.floor(F.col("due"))
    return (
        cells.join(level, "src", "left")
        .withColumn("due", due)
        .select(
            *cells.columns,
            whole.alias("copies"),
            F.floor((F.col("due") - whole) * UNIT).alias("part"),
        )
    )


def _numbers(due: DataFrame, mix: Mix) -> DataFrame:
    """``(src, class, parts, chosen)``: how many documents a class gives beyond the certain copies.

    A source's classes, eight for each doubling of a size, are few whatever it holds.
    They are gone through from the longest documents down; a number is rounded up or
    down at random, and the words over or short are carried to the next class. Where
    the smaller documents could not make up for that, the nearer number is taken.
    """
    exact = F.col("part").cast("decimal(38,0)")
    smaller = W.partitionBy("src").orderBy("class").rowsBetween(W.unboundedPreceding, -1)
    none = F.lit(0).cast("decimal(38,0)")
    classes = (
        due.filter("part > 0")
        .groupBy("src", "class")
        .agg(
            F.sum(exact * F.col("docs")).alias("parts"),
            F.sum(exact * F.col("words")).alias("part_words"),
            F.sum("words").alias("words"),
            F.sum("docs").alias("docs"),
        )
        .withColumn("below", F.coalesce(F.sum("part_words").over(smaller), none))
        .withColumn("words_below", F.coalesce(F.sum("words").over(smaller), F.lit(0)))
        .select(
            "src",
            F.struct(
                "class",
                F.col("parts").cast("double").alias("parts"),
                (F.col("part_words").cast("double") / UNIT).alias("due"),
                (F.col("part_words").cast("double") / F.col("parts").cast("double")).alias("mean"),
                "docs",
                uniform(F.concat_ws("|", F.lit(mix.seed), "src", "class")).alias("u"),
                (F.col("below").cast("double") / UNIT).alias("below"),
                "words_below",
            ).alias("c"),
        )
        .groupBy("src")
        .agg(F.sort_array(F.collect_list("c"), asc=False).alias("classes"))
    )
    start = F.struct(
        F.lit(0.0).alias("carry"),
        F.array().cast("array<struct<class:int,parts:double,chosen:bigint>>").alias("out"),
    )

    def step(state: Column, c: Column) -> Column:
        wanted = c["due"] + state["carry"]
        number = F.when(c["mean"] == 0, c["parts"] / UNIT).otherwise(wanted / c["mean"])

        def bounded(n: Column) -> Column:
            return F.least(F.greatest(F.floor(n), F.lit(0).cast("bigint")), c["docs"]).cast("bigint")

        drawn, nearest = bounded(number + c["u"]), bounded(number + 0.5)
        over = wanted - drawn * c["mean"]
        made_up = (over >= -c["below"]) & (over <= c["words_below"] - c["below"])
        chosen = F.when(made_up, drawn).otherwise(nearest)
        return F.struct(
            (wanted - chosen * c["mean"]).alias("carry"),
            F.concat(
                state["out"],
                F.array(F.struct(c["class"].alias("class"), c["parts"].alias("parts"), chosen.alias("chosen"))),
            ).alias("out"),
        )

    return classes.select(
        "src", F.explode(F.aggregate("classes", start, step, lambda s: s["out"])).alias("c")
    ).select("src", "c.*")


def mix_sources(
    docs: DataFrame,
    staging: Staging,
    mix: Mix = Mix(),
    text: str = "text",
    weight: Column | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` and ``(size, source_size, target, copies, taken)`` for every document.

    ``docs`` needs ``doc_id``, ``source`` and ``text``; ``size`` is the number of words,
    0 for null and empty texts, which may have copies but give no words. A null source
    is a source of its own, weighed last. Sources share all words by weight, none more
    than ``max_copies`` times its size. ``copies`` is how often the mix takes the
    document, ``taken`` the words that makes. ``weight`` (whole, 1 at least, null as 1)
    prefers documents inside their source; without it all are due alike. Random numbers
    are hashes of seed, id and text: reruns agree. Rows repeated as they stand count one
    by one, and so many of them are taken as are due, whichever. Columns of ``docs`` whose names
    are added here are replaced. An empty table gives an empty one. Sources and classes
    may hold any share of the rows: ranks come from a range-partitioned count.
    """
    added = ("size", "source_size", "target", "copies", "taken")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    rows = staging.table(_unit(docs, text, weight, mix, kept), "sizes")
    cells = staging.table(
        rows.groupBy("src", "weight", "class").agg(
            F.count(F.lit(1)).alias("docs"), F.sum("size").alias("words")
        ),
        "cells",
    )
    targets = staging.table(source_targets(cells, mix, staging), "targets")
    due = staging.table(_due(cells, targets, mix, staging), "due-cells")
    plan = staging.table(
        due.join(_numbers(due, mix), ["src", "class"], "left")
        .join(targets, "src")
        .select("src", "weight", "class", "copies", "part", "parts", "chosen", "source_size", "target"),
        "plan",
    )
    planned = join_checked(rows, plan, ["src", "weight", "class"])
    fraction = F.col("part") * F.col("chosen") / F.col("parts")
    inclusion = F.least(fraction, F.lit(1.0))
    odds = F.col("u") / (1 - F.col("u")) * ((1 - inclusion) / inclusion)
    drawn = dense_index(
        planned.filter("part > 0 AND chosen > 0").withColumn("odds", odds),
        ["src", "class"],
        ["odds", "u", "id", "content", "tie"],
        "rank",
        staging,
    ).withColumn("copies", F.col("copies") + (F.col("rank") < F.col("chosen")).cast("bigint"))
    certain = planned.filter("part = 0 OR chosen = 0")
    out = [F.col(f"row.`{c}`").alias(c) for c in kept]
    taken = (F.col("size") * F.col("copies")).alias("taken")
    facts = ["size", "source_size", "target", "copies"]
    return drawn.select(*out, *facts, taken).unionByName(certain.select(*out, *facts, taken))


def op13_pareto_mix(spark, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "text")
    mixed = mix_sources(docs, Staging(spark), keep=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def _sql(mix: Mix = Mix()) -> str:
    hashed = "(('0x' || substr(md5({}), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE"
    weights = ", ".join(str(w) for w in mix.weights)
    key = f"'{mix.seed}|' || coalesce(doc_id::VARCHAR, '-') || '|' || content"
    return rf"""
WITH RECURSIVE raw AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS src, md5(coalesce(text, '')) AS content,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), d AS (
  SELECT *, {hashed.format(key)} AS u, greatest(length(bin(size)) - 4, 0) AS halvings,
    (halvings * 16 + (size >> halvings::BIGINT))::INTEGER AS class
  FROM raw
), s AS (SELECT src, sum(size)::BIGINT AS source_size FROM d GROUP BY src),
w AS (
  SELECT src, source_size, 3 * source_size AS cap,
    [{weights}][((row_number() OVER (ORDER BY src = '', src) - 1) % {len(mix.weights)} + 1)::INTEGER] AS weight
  FROM s
), o AS (
  SELECT *, cap / weight AS full_at, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
    coalesce(sum(cap) OVER b, 0) AS capped, coalesce(sum(weight) OVER b, 0) AS settled
  FROM w WINDOW b AS (ORDER BY cap / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), lv AS (
  SELECT arg_min((total - capped)::DOUBLE / (weights - settled)::DOUBLE, (full_at, src)) AS level FROM o
  WHERE (total - capped)::DOUBLE / (weights - settled)::DOUBLE <= full_at
), t AS (
  SELECT src, source_size, least(cap::DOUBLE, coalesce(level * weight, cap::DOUBLE)) AS target FROM w LEFT JOIN lv ON true
), due AS (
  SELECT src, source_size, target, least({mix.max_copies}::DOUBLE, CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE {mix.max_copies} END) AS due,
    floor(due)::BIGINT AS copies, floor((due - floor(due)) * {UNIT})::BIGINT AS part
  FROM t
), c0 AS (
  SELECT src, class, count(*) AS docs, part::HUGEINT * count(*) AS parts, part::HUGEINT * sum(size) AS part_words, sum(size) AS words,
    {hashed.format(f"'{mix.seed}|' || src || '|' || class")} AS u,
  FROM d JOIN due USING (src) WHERE part > 0 GROUP BY src, class, part
), c AS (
  SELECT src, class, docs, u, parts::DOUBLE AS parts, part_words::DOUBLE / {UNIT} AS due, part_words::DOUBLE / parts::DOUBLE AS mean,
    row_number() OVER (PARTITION BY src ORDER BY class DESC) AS k,
    coalesce(sum(part_words) OVER b, 0)::DOUBLE / {UNIT} AS below, coalesce(sum(words) OVER b, 0)::DOUBLE AS words_below
  FROM c0 WINDOW b AS (PARTITION BY src ORDER BY class ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), walk AS (
  SELECT src, 0::BIGINT AS k, NULL::INTEGER AS class, 0::BIGINT AS chosen, 0::DOUBLE AS carry, 0::DOUBLE AS parts FROM due
  UNION ALL
  SELECT src, k, class, n, wanted - n * mean, parts
  FROM (
    SELECT *, CASE WHEN wanted - drawn * mean BETWEEN -below AND words_below - below THEN drawn ELSE nearest END AS n
    FROM (
      SELECT *, least(greatest(floor(number + u), 0), docs)::BIGINT AS drawn, least(greatest(floor(number + 0.5), 0), docs)::BIGINT AS nearest
      FROM (
        SELECT c.*, c.due + carry AS wanted, CASE WHEN mean = 0 THEN c.parts / {UNIT} ELSE (c.due + carry) / mean END AS number
        FROM walk JOIN c ON c.src = walk.src AND c.k = walk.k + 1
      )
    )
  )
), r AS (
  SELECT d.*, source_size, target, copies, part, coalesce(chosen, 0) AS chosen,
    least(part * chosen / walk.parts, 1.0::DOUBLE) AS inclusion
  FROM d JOIN due USING (src) LEFT JOIN walk ON walk.src = d.src AND walk.class = d.class
), q AS (
  SELECT *, row_number() OVER (PARTITION BY src, class ORDER BY
    u / (1 - u) * ((1 - inclusion) / inclusion) NULLS LAST, u, doc_id NULLS FIRST, content) AS place
  FROM r
)
SELECT doc_id, size, source_size, target, size * n AS taken, n AS copies
FROM (SELECT *, copies + CASE WHEN part > 0 AND place <= chosen THEN 1 ELSE 0 END AS n FROM q)
"""


QUERIES = {"op13_pareto_mix": op13_pareto_mix}
ORACLE = {"op13_pareto_mix": _sql()}
