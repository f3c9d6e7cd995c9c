"""SimHash fingerprints, and all links between them by anchor-point covering.

The 64 bits are cut into blocks with thresholds that add up so that a pair within
the distance is within the threshold of some block. In a block the anchors are a
covering code: every value has an anchor within the covering radius. A fingerprint is
copied to every anchor within radius plus threshold, so both ends of a link meet at
the anchor nearest to either, and fingerprints are compared per anchor in full.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.llm.arrow import with_columns
from caseloom.llm.components import components
from caseloom.operators.scaling import Staging

HASH_SEED = 42
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


# ---------------------------------------------------------------------------
# Fingerprints
# ---------------------------------------------------------------------------
def shingle_hashes(text: str | None, size: int) -> list[int]:
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(joined, HASH_SEED)]
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[: len(words) - size].tolist()]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[s:e], HASH_SEED) for s, e in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)]


def majority(hashes: Sequence[list[int]]) -> np.ndarray:
    """One 64-bit value per list: the bits set in over half of its hashes."""
    out = np.zeros(len(hashes), np.uint64)
    sizes = np.fromiter(map(len, hashes), np.int64, len(hashes))
    filled = np.flatnonzero(sizes)
    if len(filled):
        flat = np.fromiter((h for x in hashes for h in x), np.uint64, int(sizes.sum()))
        starts = np.concatenate([[0], np.cumsum(sizes[filled])[:-1]])
        places = np.arange(64, dtype=np.uint64)
        for k, start in enumerate(starts):
            part = flat[start : start + sizes[filled[k]]]
            ones = np.zeros(64, np.int64)
            for i in range(0, len(part), 65536):
                bits = np.unpackbits(part[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones += np.add.reduce(bits, axis=0, dtype=np.int64)
            out[filled[k]] = np.bitwise_or.reduce((2 * ones > len(part)).astype(np.uint64) << places)
    return out


def fingerprints(
    df: DataFrame, text: str = "text", size: int = 4, output: str = "fp", keep: list[str] | None = None
) -> DataFrame:
    """``df`` and the fingerprint of each text as a signed 64-bit number.

    A-Z are lower-cased, words are runs without ASCII white space, shingles of
    ``size`` words keep their repetitions; fewer words are one shingle. Null, empty
    and blank texts have fingerprint zero. Rows are treated one by one.
    """

    def start():
        return lambda texts: [
            pa.array(majority([shingle_hashes(t, size) for t in texts]).view(np.int64))
        ]

    return with_columns(df, text, [(output, T.LongType())], start, keep)


def as_hex(value) -> F.col:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


# ---------------------------------------------------------------------------
# Anchors
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Block:
    """``width`` bits from ``shift``, the first ``2**checks - 1`` of them under a
    Hamming code (radius 1), the others under the code of all words (radius 0).

    Anchors within radius plus ``threshold`` are counted part by part: a part may
    exceed its radius, and all parts together by no more than the threshold.
    """

    shift: int
    width: int
    checks: int
    threshold: int

    def __post_init__(self) -> None:
        if self.threshold not in (0, 1) or (1 << self.checks) - 1 > self.width:
            raise ValueError("a block has threshold 0 or 1 and room for its code")

    def anchors(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(row, anchor, home)``: home marks the nearest anchor, others are visits."""
        one = np.uint64(1)
        part = (values >> np.uint64(self.shift)) & np.uint64((1 << self.width) - 1)
        coded = (1 << self.checks) - 1
        syndrome = np.zeros(len(part), np.uint64)
        for i in range(coded):
            syndrome ^= ((part >> np.uint64(i)) & one) * np.uint64(i + 1)
        flip = np.where(syndrome > 0, one << (np.maximum(syndrome, one) - one), np.uint64(0))
        nearest = part ^ flip
        rows, found, home = [np.arange(len(part))], [nearest], [np.ones(len(part), bool)]
        if self.threshold:
            for i in range(self.width - coded):
                rows.append(rows[0])
                found.append(nearest ^ (one << np.uint64(coded + i)))
                home.append(np.zeros(len(part), bool))
            for i in range(1, coded + 1):
                # codewords two flips away: bits i < j with i xor j equal to the syndrome
                j = syndrome ^ np.uint64(i)
                pick = np.flatnonzero(j > i)
                pick = pick[syndrome[pick] > 0]
                rows.append(pick)
                found.append(part[pick] ^ (one << np.uint64(i - 1)) ^ (one << (j[pick] - one)))
                home.append(np.zeros(len(pick), bool))
        return np.concatenate(rows), np.concatenate(found), np.concatenate(home)


# Thresholds plus one add up to the distance plus one: 2 + 2 + 1 = 5.
BLOCKS_WITHIN_4 = (Block(0, 22, 4, 1), Block(22, 22, 4, 1), Block(44, 20, 4, 0))


def _copies(values: np.ndarray, blocks: Sequence[Block]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows, keys, homes = [], [], []
    for k, block in enumerate(blocks):
        row, anchor, home = block.anchors(values)
        rows.append(row)
        keys.append(anchor * np.uint64(len(blocks)) + np.uint64(k))
        homes.append(home)
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(homes)


def at_anchors(distinct: DataFrame, blocks: Sequence[Block]) -> DataFrame:
    """``(anchor, visit, fp)``: every fingerprint at every anchor near enough."""
    schema = T.StructType(
        [
            T.StructField("anchor", T.LongType()),
            T.StructField("visit", T.BooleanType()),
            T.StructField("fp", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
            row, key, home = _copies(values.view(np.uint64), blocks)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(~home), pa.array(values[row])],
                names=["anchor", "visit", "fp"],
            )

    return distinct.select("fp").mapInArrow(run, schema)


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A tree's links for each component of the links a-b among rows 0..n-1."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    other = np.flatnonzero(label != np.arange(n))
    return other, label[other]


def linked(anchor: np.ndarray, visit: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links within whole anchors; rows are sorted by anchor, homes first."""
    n = len(anchor)
    starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]]) if n else np.zeros(0, np.int64)
    ends = np.r_[starts[1:], n]
    end_of = np.repeat(ends, ends - starts)
    small = np.repeat(ends - starts <= 256, ends - starts)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    active = np.flatnonzero(~visit & small)
    step = 1
    while len(active):
        active = active[active + step < end_of[active]]
        near = np.bitwise_count(fp[active] ^ fp[active + step]) <= distance
        if near.any():
            found.append((active[near], active[near] + step))
        step += 1
    for s, e in zip(starts[ends - starts > 256], ends[ends - starts > 256], strict=True):
        homes = s + int(np.count_nonzero(~visit[s:e]))
        for i in range(s, homes, 128):
            rows = fp[i : min(i + 128, homes)]
            near = np.bitwise_count(rows[:, None] ^ fp[None, s:e]) <= distance
            x, y = np.nonzero(near)
            x, y = x + i, y + s
            if len(x):
                base, top = s, e
                t, r = _forest(x[x != y] - base, y[x != y] - base, top - base)
                found.append((t + base, r + base))
    a = np.concatenate([x for x, _ in found])
    b = np.concatenate([y for _, y in found])
    other, root = _forest(a, b, n) if len(a) else (a, b)
    return fp[other], fp[root]


def links(
    distinct: DataFrame,
    staging: Staging,
    distance: int = 4,
    blocks: Sequence[Block] = BLOCKS_WITHIN_4,
    tile_rows: int = 16384,
) -> DataFrame:
    """``(a, b)``: links that connect all fingerprints ``fp`` within ``distance`` bits.

    Per anchor a forest is returned instead of all pairs, so components are those of
    all links. An anchor with more than ``tile_rows`` fingerprints is dealt into parts,
    and every pair of parts is compared by a task of its own.
    """
    if sum(b.threshold + 1 for b in blocks) < distance + 1:
        raise ValueError("the blocks' thresholds do not cover the distance")
    copies = at_anchors(distinct, blocks)
    sizes = copies.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tile_rows)
    hot = staging.table(
        sizes.select("anchor", F.ceil(F.col("n") / tile_rows).cast("int").alias("parts")), "hot-anchors"
    )
    if hot.isEmpty():
        dealt = copies.withColumn("tile", F.lit(0).cast("bigint"))
    else:
        part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
        tile = F.transform(
            F.sequence(F.lit(0), F.col("parts") - 1),
            lambda q: F.least(part, q).cast("bigint") * F.col("parts") + F.greatest(part, q),
        )
        dealt = (
            copies.join(hot, "anchor", "left")
            .withColumn("tile", F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(tile)))
            .drop("parts")
        )
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compare(rows: pa.Table) -> pa.RecordBatch:
            anchor, tile, fp = (rows.column(c).to_numpy() for c in ("anchor", "tile", "fp"))
            change = np.r_[True, (anchor[1:] != anchor[:-1]) | (tile[1:] != tile[:-1])]
            x, y = linked(np.cumsum(change), rows.column("visit").to_numpy(), fp.view(np.uint64), distance)
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], names=["a", "b"])

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= 200_000:
                rows = pa.Table.from_batches(held)
                anchor, tile = rows.column("anchor").to_numpy(), rows.column("tile").to_numpy()
                same = (anchor == anchor[-1]) & (tile == tile[-1])
                cut = size - int(np.count_nonzero(same))
                if cut:
                    yield compare(rows.slice(0, cut))
                held, size = rows.slice(cut).to_batches(), size - cut
        if size:
            yield compare(pa.Table.from_batches(held))

    return (
        dealt.repartition("anchor", "tile")
        .sortWithinPartitions("anchor", "tile", "visit")
        .mapInArrow(run, schema)
        .distinct()
    )


def near_duplicates(
    rows: DataFrame,
    staging: Staging,
    id: str = "doc_id",
    fp: str = "fp",
    distance: int = 4,
    blocks: Sequence[Block] = BLOCKS_WITHIN_4,
) -> DataFrame:
    """``rows (id, fp)``, ``component_id``, the smallest id reachable over links, and ``root``.

    ``root`` is the smallest fingerprint reachable over links. It tells components apart
    also where their ids do not: ids that are null, or one id on unlinked texts.
    ``rows`` is read more than once, so pass a stored table. Equal fingerprints are
    folded first; links join only different ones. Every row gets one row back,
    repeated ids too. A null id counts as larger than any other; a component whose
    ids are all null has a null ``component_id``. An empty table gives an empty one.
    """
    known = rows.select(F.col(id).alias("id"), F.col(fp).alias("fp"))
    folded = staging.table(known.groupBy("fp").agg(F.min("id").alias("first")), "fingerprints")
    roots = components(links(folded, staging, distance, blocks), staging)
    joined = roots.join(folded, roots["node"] == folded["fp"]).select("node", "root", "first")
    least = joined.groupBy("root").agg(F.min("first").alias("least"))
    found = joined.join(least, "root").select(F.col("node").alias("fp"), "least", "root")
    of_fp = staging.table(
        folded.join(found, "fp", "left").select(
            "fp",
            F.when(F.col("least").isNull(), F.col("first")).otherwise(F.col("least")).alias("component_id"),
            F.coalesce("root", "fp").alias("root"),
        ),
        "components",
    )
    return known.join(of_fp, "fp", "left").select(
        F.col("id").alias(id), F.col("fp").alias(fp), "component_id", "root"
    )


def op9_simhash(spark, sf: str) -> DataFrame:
    staging = Staging(spark)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    prints = staging.table(fingerprints(docs, keep=["doc_id"]), "documents")
    return near_duplicates(prints, staging).select(
        "doc_id", as_hex("fp").alias("fingerprint"), "component_id"
    )


QUERIES = {"op9_simhash": op9_simhash}
ORACLE: dict[str, str] = {}
