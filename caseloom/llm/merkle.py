"""A Merkle manifest of a dataset by time-forward processing.

Digests travel along the tree as messages between nodes. Nodes are processed in the
order of their labels (level, place), which puts children before parents: a queue
ordered by label holds what was sent to nodes not reached yet, and a parent finds the
digests of all its children at the head. The reversed sweep goes from the root down
and delivers to every node what its proof adds from there on, until it is at the leaves.

The queue is external twice over. Whole subtrees of ``LEVELS`` levels are dealt to tasks by
a shuffle sorted by label, which spills; inside one a heap of at most ``ARITY ** LEVELS``
messages is enough. Their roots are the leaves of the next sweep, so a source of any
length takes few sweeps and is spread over as many tasks as it has subtrees.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import sha256
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from caseloom.operators.scaling import Staging, dense_index, join_checked

ARITY = 3
LEVELS = 6
"""Levels of the tree that one task works off at a time: 729 leaves."""

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def record_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each ``-`` if null, else its length in bytes, ``:``, its value."""

    def part(c: Column) -> Column:
        value = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[part(c) for c in fields]), 256)


def digest_of(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def height(nodes: int, levels: int = LEVELS) -> int:
    """Levels above ``nodes`` nodes, ``levels`` at most."""
    h = 0
    while nodes > 1 and h < levels:
        nodes, h = -(-nodes // ARITY), h + 1
    return h


def forward(digests: list[str], levels: int) -> list[list[str]]:
    """Digests of a subtree's nodes by level, leaves first.

    Nodes are taken by label from a queue to which their children have sent.
    """
    tree: list[list[str]] = [[] for _ in range(levels + 1)]
    queue = [(0, place, 0, digest) for place, digest in enumerate(digests)]
    while queue:
        level, place = queue[0][:2]
        sent = []
        while queue and queue[0][:2] == (level, place):
            sent.append(heapq.heappop(queue)[3])
        digest = sent[0] if level == 0 else digest_of(sent)
        tree[level].append(digest)
        if level < levels:
            heapq.heappush(queue, (level + 1, place // ARITY, place % ARITY, digest))
    return tree


def backward(tree: list[list[str]], above: tuple | None) -> list[tuple | None]:
    """What the proof of each leaf is from there on: ``(left, right, rest)``, or None at the root.

    Nodes are taken from the root down; what they send is shared by their children.
    """
    top = len(tree) - 1
    proofs: list[tuple | None] = [None] * len(tree[0])
    queue: list[tuple[int, int, tuple | None]] = [(-top, 0, above)]
    while queue:
        down, place, rest = heapq.heappop(queue)
        level = -down
        if level == 0:
            proofs[place] = rest
            continue
        first = place * ARITY
        run = tree[level - 1][first : first + ARITY]
        for k in range(len(run)):
            heapq.heappush(queue, (1 - level, first + k, ("".join(run[:k]), "".join(run[k + 1 :]), rest)))
    return proofs


# ---------------------------------------------------------------------------
# Sweeps in tasks
# ---------------------------------------------------------------------------
_HOPS = "array<struct<left:string,right:string>>"
_NODE = "g string, pos bigint, n bigint, digest string"
_PROOF = f"g string, pos bigint, digest string, hops {_HOPS}, subroot string, root string"
_HOPS_ARROW = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[dict]]]:
    for label, members in groupby(_rows(batches), lambda r: (r["g"], r["block"])):
        yield label, list(members)


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 5000) -> Iterator[pa.RecordBatch]:
    while held := list(islice(rows, size)):
        yield pa.RecordBatch.from_pylist(held, schema)


def _climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Roots of subtrees, as nodes of the next sweep."""
    schema = pa.schema(
        [("g", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.string())]
    )

    def roots() -> Iterator[dict]:
        for (g, block), nodes in _subtrees(batches):
            n = nodes[0]["n"]
            levels = height(n)
            top = forward([r["digest"] for r in nodes], levels)[-1][0]
            yield {"g": g, "pos": block, "n": -(-n // ARITY**levels), "digest": top}

    yield from _batches(roots(), schema)


def _proved(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, dict, list[tuple[str, str]]]]:
    """Every node, the row of its subtree's root, and the hops from it to the root of all."""
    for _, (own, *nodes) in _subtrees(batches):
        above = None
        for hop in reversed(own["hops"]):
            above = (hop["left"], hop["right"], above)
        tree = forward([r["digest"] for r in nodes], height(nodes[0]["n"]))
        for node, proof in zip(nodes, backward(tree, above)):
            hops = []
            while proof is not None:
                hops.append(proof[:2])
                proof = proof[2]
            yield node, own, hops


def _as_structs(hops: list[tuple[str, str]]) -> list[dict]:
    return [{"left": left, "right": right} for left, right in hops]


def _descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("g", pa.string()),
            ("pos", pa.int64()),
            ("digest", pa.string()),
            ("hops", _HOPS_ARROW),
            ("subroot", pa.string()),
            ("root", pa.string()),
        ]
    )
    rows = (
        {**node, "hops": _as_structs(hops), "subroot": own["subroot"], "root": own["root"]}
        for node, own, hops in _proved(batches)
    )
    yield from _batches(rows, schema)


def _verify(key: pa.DataType, with_proofs: bool):
    """At the leaves: what the proof amounts to, and the root that the found digest leads to."""
    names = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
    schema = pa.schema([("doc_id", key), *((n, pa.string()) for n in names)])
    if with_proofs:
        schema = schema.append(pa.field("proof", _HOPS_ARROW))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def leaves() -> Iterator[dict]:
            for node, own, hops in _proved(batches):
                folded = node["found"]
                for left, right in hops:
                    folded = digest_of([left, folded, right])
                yield {
                    "doc_id": node["key"],
                    "leaf": node["digest"],
                    "subroot": own["subroot"],
                    "root": own["root"],
                    "proof_sha256": digest_of([s for hop in hops for s in hop]),
                    "folded_root": folded,
                    "proof": _as_structs(hops) if with_proofs else None,
                }

        yield from _batches(leaves(), schema)

    return run


# ---------------------------------------------------------------------------
# Sweeps over the cluster
# ---------------------------------------------------------------------------
def _dealt(nodes: DataFrame) -> DataFrame:
    """Rows by subtree, in label order; what is above a subtree has ``pos`` -1."""
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return nodes.repartition(parts, "g", "block").sortWithinPartitions("g", "block", "pos")


def _block() -> Column:
    return F.floor(F.col("pos") / F.lit(ARITY**LEVELS)).alias("block")


def _sweeps_up(leaves: DataFrame, staging: Staging) -> list[DataFrame]:
    """Nodes at the foot of each sweep, ``leaves`` first; the last has one for a group."""
    sweeps = [leaves]
    while len(sweeps) == 1 or (sweeps[-1].agg(F.max("n")).first()[0] or 0) > 1:
        nodes = _dealt(sweeps[-1].select("g", _block(), "pos", "n", "digest"))
        sweeps.append(staging.table(nodes.mapInArrow(_climb, _NODE), "nodes"))
    return sweeps


def _with_tops(nodes: DataFrame, proofs: DataFrame) -> DataFrame:
    """``nodes`` and, before those of a subtree, the proof of its root."""
    tops = proofs.select(
        "g",
        F.col("pos").alias("block"),
        F.lit(-1).cast("bigint").alias("pos"),
        "hops",
        "subroot",
        "root",
    )
    return _dealt(nodes.select("*", _block()).unionByName(tops, allowMissingColumns=True))


def _sweeps_down(sweeps: list[DataFrame], proofs: DataFrame, staging: Staging) -> DataFrame:
    """Proofs of the nodes at the foot of the second sweep, or of the only one's top."""
    for nodes in sweeps[-2:0:-1]:
        proofs = staging.table(_with_tops(nodes, proofs).mapInArrow(_descend, _PROOF), "proofs")
    return proofs


def manifest(
    docs: DataFrame,
    staging: Staging,
    fields: tuple[str, ...] = FIELDS,
    found: Column | None = None,
    with_proofs: bool = False,
) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` for every row.

    ``docs`` needs ``doc_id``, ``source`` and ``fields``; other columns are left out.
    Every source is a tree over its rows by ``doc_id``, a null one first, then by digest;
    rows repeated as they stand are leaves of their own. Sources, a null one first, are
    the leaves of the tree above. A run has three nodes, a last one may have fewer; a
    tree of one node is that node. ``found`` is the digest of what was found in place of
    a row, by default the row's own: it is folded with the row's proof, and verified if
    that gives the root. ``proof`` lists, from the leaf up, what stands left and right of
    a node in its run. Nulls and empty texts have digests of their own, texts may have
    any length. An empty table gives an empty one.
    """
    digest = record_digest([F.col(f"`{c}`") for c in fields])
    rows = docs.select(
        F.when(F.col("`source`").isNull(), "").otherwise(F.concat(F.lit("="), "`source`")).alias("g"),
        F.col("`doc_id`").alias("key"),
        digest.alias("digest"),
        (digest if found is None else found).alias("found"),
        F.monotonically_increasing_id().alias("tie"),
    )
    rows = staging.table(rows, "digests")
    placed = dense_index(rows, ["g"], ["key", "digest", "found", "tie"], "pos", staging)
    sizes = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    leaves = staging.table(
        join_checked(placed, sizes, ["g"]).select("g", "pos", "n", "key", "digest", "found"), "leaves"
    )
    sweeps = _sweeps_up(leaves, staging)

    # '' stands for a null source and every name has a sign before it: the order asked for
    named = sweeps[-1].select(F.lit("").alias("g"), F.col("g").alias("src"), "digest")
    number = F.lit(sweeps[-1].count()).cast("bigint").alias("n")
    sources = staging.table(
        dense_index(named, ["g"], ["src"], "pos", staging).select("*", number), "sources"
    )
    above = _sweeps_up(sources.select("g", "pos", "n", "digest"), staging)
    top = above[-1].select(
        "g",
        "pos",
        "digest",
        F.array().cast(_HOPS).alias("hops"),
        F.lit(None).cast("string").alias("subroot"),
        F.col("digest").alias("root"),
    )
    top = _sweeps_down(above, top, staging)
    proofs = staging.table(_with_tops(above[0], top).mapInArrow(_descend, _PROOF), "proofs")
    subroots = proofs.join(sources.select("pos", "src"), "pos").select(
        F.col("src").alias("g"),
        F.lit(0).cast("bigint").alias("pos"),
        "digest",
        "hops",
        F.col("digest").alias("subroot"),
        "root",
    )
    proofs = _sweeps_down(sweeps, subroots, staging)
    key = to_arrow_type(rows.schema["key"].dataType)
    schema = (
        f"doc_id {rows.schema['key'].dataType.simpleString()}, leaf string, subroot string, root string,"
        f" proof_sha256 string, folded_root string{f', proof {_HOPS}' if with_proofs else ''}"
    )
    return (
        _with_tops(leaves, proofs)
        .mapInArrow(_verify(key, with_proofs), schema)
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )


def without_newlines(docs: DataFrame) -> Column:
    """Digest of a row; where 2 divides the CRC of its id, of the row without line feeds."""
    text = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    tampered = [text if c == "text" else F.col(c) for c in FIELDS]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(even, record_digest(tampered)).otherwise(record_digest([F.col(c) for c in FIELDS]))


def op11_merkle_manifest(spark, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(*FIELDS)
    return manifest(docs, Staging(spark), found=without_newlines(docs))


_FIELD = "coalesce(octet_length(encode({0}::VARCHAR))::VARCHAR || ':' || {0}::VARCHAR, '-')"


def _record_sql(text: str) -> str:
    return f"sha256({' || '.join(_FIELD.format(text if c == 'text' else c) for c in FIELDS)})"


ORACLE = {
    "op11_merkle_manifest": f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || source, '') AS g, {_record_sql("text")} AS leaf, {_record_sql("replace(text, chr(10), '')")} AS altered,
    list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ord(s)::BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 1, 1, 1, 1, 1, 1, 1, 1],
        lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc
  FROM documents
), p AS (
  SELECT doc_id, g, leaf, CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN altered ELSE leaf END AS found,
    row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n
  FROM d
), tree AS (
  SELECT g, 0 AS level, pos, leaf AS digest, n FROM p
  UNION ALL
  SELECT g, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3 FROM tree WHERE n > 1
  GROUP BY g, level, pos // 3, n
), sub AS (SELECT g, digest, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1),
over_all AS (
  SELECT 0 AS level, pos, digest, n FROM sub
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3 FROM over_all WHERE n > 1
  GROUP BY level, pos // 3, n
), fold AS (
  SELECT doc_id, p.g, leaf, found AS folded, p.pos, 0 AS level, '' AS proof, p.n, false AS above FROM p
  UNION ALL
  SELECT * FROM (
    SELECT f.doc_id, f.g, f.leaf,
      CASE WHEN f.n > 1 THEN sha256(string_agg(CASE WHEN s.pos = f.pos THEN f.folded ELSE s.digest END, '' ORDER BY s.pos)) ELSE f.folded END,
      CASE WHEN f.n > 1 THEN f.pos // 3 ELSE any_value(sub.pos) END, CASE WHEN f.n > 1 THEN f.level + 1 ELSE 0 END,
      f.proof || CASE WHEN f.n > 1 THEN coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos <> f.pos), '') ELSE '' END,
      CASE WHEN f.n > 1 THEN (f.n + 2) // 3 ELSE any_value(sub.n) END, f.above OR f.n = 1
    FROM fold f
    LEFT JOIN (
      SELECT g, false AS above, level, pos, digest FROM tree UNION ALL SELECT '', true, level, pos, digest FROM over_all
    ) s ON s.above = f.above AND s.g = CASE WHEN f.above THEN '' ELSE f.g END AND s.level = f.level AND s.pos // 3 = f.pos // 3
    JOIN sub ON sub.g = f.g
    WHERE NOT (f.above AND f.n = 1)
    GROUP BY f.doc_id, f.g, f.leaf, f.folded, f.pos, f.level, f.proof, f.n, f.above
  )
)
SELECT doc_id, leaf, sub.digest AS subroot, o.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = o.digest AS verified
FROM fold f JOIN sub ON sub.g = f.g JOIN over_all o ON o.n = 1
WHERE f.above AND f.n = 1
"""
}
QUERIES = {"op11_merkle_manifest": op11_merkle_manifest}
