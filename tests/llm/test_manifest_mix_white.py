"""The manifest, the mix and whitening against plain models."""

import hashlib
import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.llm import merkle, mixing, whitening
from caseloom.operators.scaling import Staging

DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# ---------------------------------------------------------------------------
# Manifest
# ---------------------------------------------------------------------------
def plain_digest(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(digests):
    """Root, and for each leaf the siblings left and right by level."""
    paths = [[] for _ in digests]
    level = [(d, [i]) for i, d in enumerate(digests)]
    while len(level) > 1:
        above = []
        for start in range(0, len(level), 3):
            run = level[start : start + 3]
            for k, (_, under) in enumerate(run):
                hop = ("".join(d for d, _ in run[:k]), "".join(d for d, _ in run[k + 1 :]))
                for leaf in under:
                    paths[leaf].append(hop)
            above.append((sha("".join(d for d, _ in run)), [i for _, u in run for i in u]))
        level = above
    return level[0][0], paths


def plain_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        leaf = plain_digest(r)
        found = leaf
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
            found = plain_digest((*r[:4], r[4].replace("\n", "")))
        groups[b"" if r[1] is None else b"=" + r[1].encode()].append(
            ((r[0] is not None, r[0] or 0), leaf, found, r[0])
        )
    names = sorted(groups)
    trees = {}
    for g in names:
        groups[g].sort(key=lambda m: m[:3])
        trees[g] = plain_tree([m[1] for m in groups[g]])
    root, top = plain_tree([trees[g][0] for g in names])
    out = []
    for g, above in zip(names, top):
        subroot, paths = trees[g]
        for (_, leaf, found, doc_id), path in zip(groups[g], paths):
            folded = found
            for left, right in path + above:
                folded = sha(left + folded + right)
            proof = sha("".join(a + b for a, b in path + above))
            out.append((doc_id, leaf, subroot, root, proof, folded, folded == root))
    return out


def manifest_rows(spark, rows, extra=None):
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        df = df.withColumns(extra)
    got = merkle.manifest(df, Staging(spark), found=merkle.without_newlines(df))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, got.collect()), key=repr)


def test_manifest_equals_a_plain_tree(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(1700):
        # two sweeps for one source, one leaf for others
        source = "hot" if i % 7 else [None, "a", "ä", "\U0001f600", "Z", f"one{i}"][int(rng.integers(6))]
        rows.append((i, source, "en" if i % 3 else None, int(rng.integers(99)), f"line {i}\nmore\n" if i % 5 else None))
    rows += [(None, "hot", None, None, ""), (None, None, None, None, None), (5000, "hot", "", 0, "x" * 300_000 + "\n")]
    rows += [rows[3]] * 3 + [(10, "hot", "en", 1, "other text, same id")]
    assert manifest_rows(spark, rows) == sorted(plain_manifest(rows), key=repr)


@pytest.mark.parametrize("sizes", [[1], [2], [3, 1], [4, 1, 1, 1], [9, 10, 27, 28], [1] * 30])
def test_manifest_of_small_shapes(spark, sizes):
    rows = [(100 * s + i, f"s{s:02d}", "en", 1, f"{i}\n") for s, n in enumerate(sizes) for i in range(n)]
    assert manifest_rows(spark, rows) == sorted(plain_manifest(rows), key=repr)


def test_manifest_ignores_other_columns_and_takes_an_empty_table(spark):
    rows = [(1, "a", "en", 1, "x\n"), (2, "a", "en", 1, "y\n")]
    clash = {c: F.lit(7) for c in ("g", "pos", "digest", "leaf", "root", "n", "key")}
    assert manifest_rows(spark, rows, clash) == sorted(plain_manifest(rows), key=repr)
    assert manifest_rows(spark, []) == []


def test_proofs_are_returned_and_lead_to_the_root(spark):
    rows = [(i, "s" if i % 2 else None, "en", 1, f"text {i}") for i in range(40)]
    got = merkle.manifest(spark.createDataFrame(rows, DOCS), Staging(spark), with_proofs=True).collect()
    for r in got:
        folded = r["leaf"]
        for hop in r["proof"]:
            folded = sha(hop["left"] + folded + hop["right"])
        assert r["verified"] and folded == r["root"]


# ---------------------------------------------------------------------------
# Mix
# ---------------------------------------------------------------------------
def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """Shares by weight, the excess of full sources shared again until there is none."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        rest = sum(weight[s] for s in names if s not in full)
        share = {s: most * sizes[s] if s in full else left * weight[s] / rest for s in names}
        over = {s for s in names if s not in full and share[s] > most * sizes[s]}
        if not over:
            return share
        full |= over


def mixed(spark, rows, schema=DOCS, **more):
    return mixing.mix_sources(spark.createDataFrame(rows, schema), Staging(spark), **more).collect()


def make_docs(seed, shape):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for source, n, longest in shape:
        for _ in range(n):
            i += 1
            rows.append((i, source, "en", 0, "w " * int(rng.integers(1, longest))))
    return rows


@pytest.mark.parametrize(
    "shape",
    [
        [("a", 300, 200), ("b", 900, 60), (None, 50, 100), ("c", 40, 30), ("d", 1, 5)],
        [("big", 1500, 100), ("x", 3, 40), ("y", 3, 40), ("z", 3, 40)],
        [(f"s{i}", 30 + 5 * i, 300) for i in range(9)],
    ],
)
def test_mix_meets_its_targets(spark, shape):
    rows = make_docs(1, shape)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[1]] += len(r[4].split())
    want = plain_targets(sizes)
    got = mixed(spark, rows)
    assert sorted(r["doc_id"] for r in got) == [r[0] for r in rows]
    taken = defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["size"] == len(r["text"].split())
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-9)
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        # certain copies, and one more at most
        assert r["copies"] - math.floor(r["target"] / r["source_size"] + 1e-9) in (0, 1)
        taken[r["source"]] += r["taken"]
    for source, target in want.items():
        assert abs(taken[source] - target) <= max(2, 0.02 * target), source
    assert sorted(map(tuple, mixed(spark, rows)), key=repr) == sorted(map(tuple, got), key=repr)


def test_sampling_keeps_inclusion_probabilities(spark):
    """Over seeds, documents of any size are taken as often as they are due."""
    rows = make_docs(4, [("a", 60, 80), ("b", 120, 80)])
    share, runs = defaultdict(list), 12
    for seed in range(runs):
        for r in mixed(spark, rows, mix=mixing.Mix(weights=(1, 1), seed=str(seed))):
            if r["source"] == "b":
                share[r["size"] > 40].append(r["copies"])
                due = r["target"] / r["source_size"]
    for copies in share.values():
        assert abs(np.mean(copies) - due) < 0.08


def test_weights_prefer_documents(spark):
    rows = make_docs(2, [("a", 600, 20), ("b", 600, 60)])
    df = spark.createDataFrame(rows, DOCS)
    got = mixing.mix_sources(df, Staging(spark), weight=F.when(F.col("doc_id") % 2 == 0, 4)).collect()
    for source in "ab":
        of = [r for r in got if r["source"] == source]
        target = of[0]["target"]
        assert abs(sum(r["taken"] for r in of) - target) <= max(2, 0.02 * target)
        even, odd = ([r["copies"] for r in of if r["doc_id"] % 2 == k] for k in (0, 1))
        assert np.mean(even) > 1.5 * np.mean(odd) and max(even) <= 3


def test_mix_of_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", None, None, ""), (1, "", None, None, " \t\n")]
    rows += [(7, "a", "en", 0, "same text here")] * 500 + [(8, None, "en", 0, "y " * 200_000)]
    got = mixed(spark, [(*r, "clash") for r in rows], DOCS + ", taken string", keep=["doc_id", "source", "taken"])
    assert len(got) == len(rows)
    assert {r["source_size"] for r in got if r["source"] == "a"} == {1500}
    assert sum(r["taken"] for r in got if r["source"] == "a") == pytest.approx(got_target(got, "a"), abs=3)
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert mixed(spark, []) == []
    assert [r["taken"] for r in mixed(spark, rows[:3])] == [0, 0, 0]


def got_target(got, source):
    return next(r["target"] for r in got if r["source"] == source)


# ---------------------------------------------------------------------------
# Whitening
# ---------------------------------------------------------------------------
def rotation(rng, dims):
    return np.linalg.qr(rng.normal(size=(dims, dims)))[0]


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 100, 40),
        np.r_[100 + np.arange(6) * 1e-8, np.linspace(1, 50, 34)],
        np.r_[np.full(10, 100.0), np.full(10, 50.0), np.linspace(1, 20, 20)],
        np.r_[np.zeros(30), 1.0, 2.0, 3.0],
        np.ones(12),
        np.zeros(5),
        10.0 ** np.linspace(-8, 4, 32),
        np.r_[100 + np.array([0, 1e-6, 2e-6, 3e-6 + 1e-10]), np.ones(20)],
        np.array([3.0]),
    ],
)
def test_eigenvectors_to_double_precision(values):
    rng = np.random.default_rng(len(values))
    q = rotation(rng, len(values))
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found, x = whitening.eigenvectors(a)
    scale = max(np.abs(a).max(), 1e-300)
    assert np.abs(found - np.sort(values)[::-1]).max() <= 1e-13 * scale * len(values)
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-13
    assert np.abs(a @ x - x * found).max() <= 1e-13 * scale
    start = np.linalg.eigh((a / scale).astype(np.float32))[1].astype(float)
    if len(values) > 1 and np.ptp(values) > 1:
        rough = start.T @ a @ start
        assert np.abs(rough - np.diag(np.diag(rough))).max() > 1e-9 * scale, "float32 alone is not enough"


def test_clusters_are_told_apart():
    rng = np.random.default_rng(8)
    values = np.r_[100 + np.arange(5) * 1e-7, np.linspace(1, 50, 20)]
    q = rotation(rng, 25)
    a = (q * values) @ q.T
    _, x = whitening.eigenvectors((a + a.T) / 2)
    cos = np.abs((q[:, np.argsort(-values)] * x).sum(axis=0))
    assert cos.min() > 1 - 1e-9


def plain_white(vectors):
    x = np.floor(1024 * np.asarray(vectors, np.float32).astype(float)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    v = centred.T @ centred / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:8], q[:, ::-1][:, :8]
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    return n, deviation, centred @ q / np.sqrt(e), e / np.trace(v)


def whitened(spark, rows, schema="vec_id bigint, embedding array<float>", **more):
    return whitening.whiten(spark.createDataFrame(rows, schema), Staging(spark), **more).collect()


def test_whitening_equals_a_direct_decomposition(spark):
    rng = np.random.default_rng(6)
    good = (rng.normal(size=(700, 12)) * np.linspace(0.1, 2, 12)) @ rotation(rng, 12)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(good)]
    bad = [None, [], [None] * 12, [1.0] * 11 + [float("nan")], [float("-inf")] + [0.0] * 11, [1.0, 2.0], [0.0] * 11 + [None]]
    n, deviation, white, explained = plain_white([v for _, v in rows] + [rows[0][1], rows[0][1]])
    mixed_rows = rows + [(1000 + i, b) for i, b in enumerate(bad)] + [(0, rows[0][1]), (None, rows[0][1])]
    got = whitened(spark, mixed_rows)
    assert len(got) == 702 == n
    signs = None
    for r in sorted(got, key=lambda r: (r["vec_id"] is None, r["vec_id"])):
        i = r["vec_id"] or 0
        assert r["n"] == n and r["deviation"] == deviation[i] and r["identity_error"] < 1e-10
        assert r["explained"] == pytest.approx(list(explained), rel=1e-10)
        signs = np.sign(np.array(r["white"]) * white[i]) if signs is None else signs
        assert np.array(r["white"]) * signs == pytest.approx(white[i], rel=1e-8, abs=1e-10)


def test_whitening_of_odd_tables(spark):
    assert whitened(spark, []) == []
    assert whitened(spark, [(1, None), (2, [])]) == []
    (one,) = whitened(spark, [(1, [0.5, 0.25])])
    assert (one["n"], one["deviation"], one["white"], one["explained"], one["identity_error"]) == (1, 0, [None] * 2, [0.0] * 2, 0.0)
    flat = whitened(spark, [(i, [float(i % 3), 1.0, 1.0]) for i in range(9)])
    assert all(r["white"][0] is not None and r["white"][1:] == [None, None] for r in flat)
    huge = whitened(spark, [(1, [3e38, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 2.0])])
    assert all(r["deviation"] is None for r in huge) and all(r["white"][0] is not None for r in huge)
    clash = whitened(
        spark, [(1, [0.5, 1.0], 7, 8), (2, [0.0, 1.5], 7, 8)], "vec_id bigint, embedding array<float>, v int, white int"
    )
    assert all(r["n"] == 2 for r in clash)


def test_whitening_query_has_eight_components_a_row(spark):
    sf = "/root/testdata/sf0.001"
    got = whitening.op12_whitening(spark, sf)
    rows = got.collect()
    ids = {r["vec_id"] for r in rows}
    assert len(rows) == 8 * len(ids) and {r["component"] for r in rows} == set(range(1, 9))
