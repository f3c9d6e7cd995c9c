"""A training corpus from raw documents, stage by stage.

Every stage takes the documents its predecessor kept and, but for the last, carries all
their columns whatever they are called. Null and empty texts, very long ones, ties,
repeated rows and empty tables have the results the stages state; an empty table goes
through all of them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm import decontaminate, language_id, line_rules, segment, simhash
from caseloom.operators.scaling import Staging


def _nested(docs: DataFrame, *beside: Column) -> DataFrame:
    """Documents as one column ``row``, out of the way of the columns operators add."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *beside)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; one without a letter goes.

    Where no row has a language to learn from, only those without a letter go. Null and
    empty texts have no letter; repeated rows stay or go together.
    """
    learned = language_id.learn_profiles(docs)
    if not any(np.any(v) for v in learned.values()):
        # any profile tells texts with a letter from those without
        learned = {"unnamed": np.ones(language_id.Space().dims)}
    found = language_id.identify(_nested(docs, F.col("text").alias("t")), learned, "t", keep=["row"])
    return found.filter(F.col("lang_pred") != language_id.UNDETERMINED).select("row.*")


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that keep enough of their lines, with those lines as their text.

    Null and empty texts and those of fewer than fifty words go. ``n_chars`` is that of
    the lines left. Each row is judged for itself, so repeated rows agree.
    """
    judged = line_rules.line_first(_nested(docs, F.col("text").alias("t")), "t")
    # a filter is not pushed below a generator, so the rules are evaluated once
    judged = judged.select("row", F.explode(F.array("line_rules")).alias("line_rules"))
    new = {
        "text": F.col("line_rules.cleaned"),
        "n_chars": F.length("line_rules.cleaned").cast("bigint"),
    }
    return judged.filter("line_rules.kept").select(
        *[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Rows with that id and fingerprint are one document; of several fingerprints under
    that id the smallest stays, and a group without any id keeps one row of its
    smallest fingerprint. Rows that agree in id and fingerprint but not in text are
    settled by a hash of the text, so a task that runs again keeps the same one. Groups
    are told apart by their texts, never by an id. Texts without words are one group.
    """
    staging = Staging(spark)
    rows = _nested(docs, F.col("doc_id"), F.col("text").alias("t"))
    prints = staging.table(simhash.fingerprints(rows, "t", keep=["doc_id"]), "prints")
    groups = simhash.near_duplicates(prints, staging)
    # what stands for a row: its id, null or not, and fingerprint, in 128 bits
    facts = F.col("doc_id").isNull(), F.col("doc_id"), F.col("fp")
    key = [F.xxhash64(F.lit(k), *facts).alias(f"k{k}") for k in (1, 2)]
    stays = (
        groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root", "doc_id")
        .agg(F.min("fp").alias("fp"))
        .select(*key)
    )
    # repeated rows are folded before the one shuffle of texts, which the join then shares
    once = (
        simhash.fingerprints(rows, "t", keep=["row", "doc_id"])
        .select("row", *key)
        .groupBy("k1", "k2")
        .agg(F.min_by("row", F.struct(F.xxhash64("row.text"), F.xxhash64("row"))).alias("row"))
    )
    return once.join(stays, ["k1", "k2"], "left_semi").select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Null and empty texts have none and stay; rows of one id and text stay or go together.
    """
    staging = Staging(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    keyed = _nested(docs, decontaminate.row_key().alias("key"))
    found = decontaminate.contaminated(
        keyed.select("key", F.col("row.text").alias("text")), items, staging
    )
    # stored, so that its size is known before the join is planned: mostly small enough to
    # send to the documents, which then need not move
    stored = staging.table(found.select("key"), "contaminated")
    return keyed.join(stored, "key", "left_anti").select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document, checked against their decoding.

    In place of the text; of the other columns those of ``documents`` stay. Null and
    empty texts have no segmentation, and repeated rows get equal ones.
    """
    return segment.segmentations(docs, keep=["doc_id", "lang", "source", "n_chars"])


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", clean_lines),
    ("simhash", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("segment", encode),
]
# Profiles, fingerprints and sampling are beyond SQL; the stages are tested against plain models.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    staging = Staging(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staging.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
