"""Operators over pairs and groups: fingerprints, benchmark windows, chats."""

from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from caseloom.llm import chat, components, decontaminate, simhash
from caseloom.operators.scaling import Staging

DOCS = "doc_id bigint, text string"


def roots(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def plain_fingerprint(text):
    words = [w for w in _ascii_words(text)]
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _ascii_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    return [w for w in lowered.split(" ") if w]


def test_fingerprints_equal_a_plain_model(spark):
    texts = [None, "", " \n", "One", "ÀB c", "a b c d", "a b c d e", "A\tB\x0bC\x85D\xa0e f g", "x y " * 30_000]
    rows = spark.createDataFrame(list(enumerate(texts)), DOCS)
    got = simhash.fingerprints(rows).select("doc_id", simhash.as_hex("fp").alias("h")).collect()
    assert {r["doc_id"]: r["h"] for r in got} == {i: f"{plain_fingerprint(t):016x}" for i, t in enumerate(texts)}


@pytest.mark.parametrize("block", simhash.BLOCKS_WITHIN_4)
def test_anchors_cover_and_are_complete(block):
    rng = np.random.default_rng(block.shift)
    values = rng.integers(0, 2**64, 300, dtype=np.uint64)
    row, anchor, home = block.anchors(values)
    at = {}
    for r, a in zip(row.tolist(), anchor.tolist(), strict=True):
        at.setdefault(r, set()).add(a)
    assert len(row) == sum(map(len, at.values())) and home.sum() == len(values)
    for i, v in enumerate(values.tolist()):
        for flip in [0, *(1 << b for b in range(block.shift, block.shift + block.width))][: 1 + block.threshold * 99]:
            _, other, nearest = block.anchors(np.array([v ^ flip], np.uint64))
            assert set(other[nearest].tolist()) <= at[i]


def test_links_find_every_pair_within_four_bits(spark):
    rng = np.random.default_rng(11)
    base = rng.integers(0, 2**64, 150, dtype=np.uint64)
    near = [base]
    for bits in range(1, 7):
        moved = base.copy()
        for i in range(len(moved)):
            for b in rng.choice(64, bits, replace=False):
                moved[i] ^= np.uint64(1) << np.uint64(b)
        near.append(moved)
    centre = np.uint64(0x0123456789ABCDEF)
    crowd = np.array([centre ^ np.uint64(1 << a) ^ np.uint64(1 << b) for a in range(24) for b in range(a)], np.uint64)
    values = np.unique(np.concatenate([*near, crowd, [np.uint64(0), np.uint64(2**64 - 1)]]))
    ids = rng.permutation(len(values))
    rows = [(int(i), int(v)) for i, v in zip(ids, values.view(np.int64), strict=True)]
    rows += [(int(ids[3]), rows[3][1]), (5000, rows[7][1]), (None, rows[8][1])]
    table = spark.createDataFrame(rows, "doc_id bigint, fp bigint")
    close = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
    want = roots(len(values), zip(*np.nonzero(close)))
    least = {}
    for k, r in enumerate(want):
        least[r] = min(least.get(r, 10**9), int(ids[k]))
    expect = {int(v): least[want[k]] for k, v in enumerate(values.view(np.int64))}
    staging = Staging(spark)
    got = simhash.near_duplicates(table, staging).collect()
    assert len(got) == len(rows) and all(r["component_id"] == expect[r["fp"]] for r in got)
    # the same when every anchor with more than eight fingerprints is dealt into tiles
    tiled = simhash.links(table.select("fp").distinct(), staging, tile_rows=8).collect()
    index = {int(v): k for k, v in enumerate(values.view(np.int64))}
    assert roots(len(values), [(index[r["a"]], index[r["b"]]) for r in tiled]) == want


def test_near_duplicates_of_nothing_and_of_ids_missing(spark):
    staging = Staging(spark)
    empty = spark.createDataFrame([], "doc_id bigint, fp bigint")
    assert simhash.near_duplicates(empty, staging).count() == 0
    lost = spark.createDataFrame([(None, 1), (None, 1), (None, 3)], "doc_id bigint, fp bigint")
    assert [r["component_id"] for r in simhash.near_duplicates(lost, staging).collect()] == [None] * 3
    with pytest.raises(ValueError):
        simhash.links(empty, staging, distance=5)


def test_components_equal_a_plain_model(spark):
    rng = np.random.default_rng(2)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))]
    pairs += [(i, i + 1) for i in range(500, 560)] + [(700, k) for k in range(701, 760)]
    links = spark.createDataFrame([*pairs, (5, 5), (None, 1)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in components.components(links, Staging(spark)).collect()}
    want = roots(800, pairs)
    assert got == {x: want[x] for p in pairs if p[0] != p[1] for x in p}


# ---------------------------------------------------------------------------
# Benchmark windows
# ---------------------------------------------------------------------------
ITEMS = [
    (1, "Tom bought 12 apples and gave Anna 5 of them because Anna was hungry after school today"),
    (2, "A train travels 60 km in 2 hours and then stops for 10 minutes before it goes on"),
    (3, "What is life"),
    (4, None),
    (5, "7 8 9 10 11 12 13 14 15 16"),
]
PAGES = {
    10: "Before. Tom bought 12 apples and gave Anna 5 of them because Anna was hungry after school today. After.",
    11: "x Tom bought 99 apples and gave Peter 3 of them because Peter was hungry after school today",
    12: "x Tom bought 99 apples and gave Peter 3 of them because Maria was hungry after lunch",
    13: "first A train travels 75 miles in 3 hours and then stops for 10 seconds before it goes on",
    14: "A train goes by and then nothing happens for a long time in this small town",
    15: "What is life",
    16: "what is life but a dream they say",
    17: "7 8 9 10 11 12 13 14 15 16",
    18: None,
    19: "",
    20: "word " * 50_000 + "a train travels 60 km in 2 hours and then stops for 10 minutes",
}


def test_templates_are_found_and_slots_checked(spark):
    rows = [(i, t) for i, t in PAGES.items()] + [(10, PAGES[10])]
    docs = spark.createDataFrame(rows, "key bigint, text string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = {r["key"]: r["item_ids"] for r in decontaminate.contaminated(docs, items, Staging(spark)).collect()}
    assert got == {10: [1], 11: [1], 13: [2], 15: [3], 16: [3], 17: [5], 20: [2]}


def test_short_items_headings_and_single_odd_values(spark):
    items = [
        (1, "Compute 12 + 30."),
        (2, "What is the capital city of France?"),
        (3, "Ben has 7 coins and loses 2 of them on the way to the old mill, then Ben counts what is left"),
        (4, "12"),
        (5, "Yes no"),
    ]
    pages = {
        1: "Now compute 12 + 30. Then rest.",
        2: "Now compute 13 + 30. Then rest.",
        3: "Question: What is the capital city of France?",
        4: "Geography\nWhat is the capital city of France?",
        5: "question what is the capital city of Spain",
        6: "Yes no 12 maybe",
        7: "Eva has 9 coins and loses 4 of them on the way to the old mill, then Ida counts what is left",
        8: "Question: Eva has 9 coins and loses 4 of them on the way to the old mill, then Eva counts what is left",
    }
    got = decontaminate.contaminated(
        spark.createDataFrame(list(pages.items()), "key bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
        Staging(spark),
    )
    # a name that does not stay the same voids the windows it is in, not those between
    # and a question asked anew of another place is the same question
    assert {r["key"]: r["item_ids"] for r in got.collect()} == {1: [1], 3: [2], 4: [2], 5: [2], 7: [3], 8: [3]}


def test_windows_equal_plain_ones_on_literal_text(spark):
    rng = np.random.default_rng(4)
    words = [f"w{a}{b}" for a in "abcdefgh" for b in "xyz"]
    items = [(i, " ".join(rng.choice(words, 20))) for i in range(30)]
    docs = []
    for i in range(200):
        body = list(rng.choice(words, 40))
        if i % 3 == 0:
            item = items[i % 30][1].split()
            start, size = int(rng.integers(0, 8)), int(rng.integers(6, 12))
            body[10:10] = item[start : start + size]
        docs.append((i, " ".join(body)))
    windows = {}
    for i, t in items:
        w = t.split()
        for k in range(len(w) - 7):
            windows.setdefault(tuple(w[k : k + 8]), set()).add(i)
    want = {}
    for i, t in docs:
        w = t.split()
        found = set().union(*(windows.get(tuple(w[k : k + 8]), set()) for k in range(len(w) - 7)))
        if found:
            want[i] = sorted(found)
    got = decontaminate.contaminated(
        spark.createDataFrame(docs, "key bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
        Staging(spark),
    )
    assert {r["key"]: r["item_ids"] for r in got.collect()} == want and want


def test_no_benchmark_or_no_documents(spark):
    docs = spark.createDataFrame([(1, "some text")], "key bigint, text string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert decontaminate.contaminated(docs, items.limit(0), Staging(spark)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), items, Staging(spark)).count() == 0


# ---------------------------------------------------------------------------
# Chats
# ---------------------------------------------------------------------------
def plain_chats(rows):
    chats = {}
    for conv, turn, role, text in dict.fromkeys(rows):
        chats.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    paths = {c: tuple(x[1:] for x in sorted(t)) for c, t in chats.items()}
    kept = {}
    for conv in sorted(paths, key=lambda c: (c is None, c or 0)):
        path = paths[conv]
        longer = any(p != path and p[: len(path)] == path for p in paths.values())
        if not longer and path not in kept.values():
            kept[conv] = path
    copies = Counter(paths.values())
    return {c: (len(p), copies[p], p) for c, p in kept.items()}


def test_chats_equal_a_plain_model(spark):
    rng = np.random.default_rng(9)
    rows, conv = [], 0
    for _ in range(40):
        turns = [("user" if k % 2 == 0 else "assistant", f"{rng.integers(0, 3)}") for k in range(int(rng.integers(1, 6)))]
        for cut in {len(turns), int(rng.integers(1, len(turns) + 1))}:
            rows += [(conv, k, *turns[k]) for k in range(cut)]
            conv += 1
    rows += [(900, k, "user", "again" if k < 2500 else "end") for k in range(2600)]
    rows += [(901, k, "user", "again") for k in range(2000)] + [(902, None, None, None), (None, 0, "user", "0")]
    rows += rows[:5]
    extra = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id bigint, turn bigint, role string, text string, n int, segment int")
    got = chat.format_chats(extra, Staging(spark)).orderBy("conv_id", "segment").collect()
    want = plain_chats(rows)
    texts, facts = {}, {}
    for r in got:
        texts[r["conv_id"]] = texts.get(r["conv_id"], "") + r["text"]
        facts[r["conv_id"]] = (r["n_turns"], r["n_copies"])
    assert facts == {c: v[:2] for c, v in want.items()}
    for c, (_, _, path) in want.items():
        assert texts[c] == "".join(f"{chat.TURN_OPEN}{r}\n{t}{chat.TURN_CLOSE}\n" for r, t in path)
    assert sum(r["conv_id"] == 900 for r in got) == 3 and 901 not in facts
    assert chat.format_chats(extra.limit(0), Staging(spark)).count() == 0


def test_chats_are_cut_however_turns_are_numbered(spark):
    size = chat.BLOCK_TURNS
    many = 2 * size + 500
    rows = [(None, None, f"{k:05d}", "lost") for k in range(many)] + [(None, 5000, "user", "late")]
    rows += [(1, 7, f"{k:05d}", "tied") for k in range(size + 1)] + [(1, size + 3, "user", "next")]
    rows += [(2, None, "user", "first")] + [(2, k, "user", str(k)) for k in range(size)]
    rows += [(3, None, f"{k:05d}", "lost") for k in range(size + 76)] + rows[:9]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = chat.format_chats(table, Staging(spark)).orderBy("conv_id", "segment").collect()
    assert all(r["text"].count(chat.TURN_OPEN) <= size for r in got)
    want = plain_chats(rows)
    assert 3 not in want
    for c, (n, copies, path) in want.items():
        ours = [r for r in got if r["conv_id"] == c]
        assert {(r["n_turns"], r["n_copies"]) for r in ours} == {(n, copies)}
        told = "".join(f"{chat.TURN_OPEN}{r}\n{t}{chat.TURN_CLOSE}\n" for r, t in path)
        assert "".join(r["text"] for r in ours) == told
    named = {c: [r["segment"] for r in got if r["conv_id"] == c] for c in want}
    # by place, whatever the numbers of the turns are
    assert named == {None: [0, 1, 2], 1: [0, 1], 2: [0, 1]}
