"""The pipeline, stage by stage, against plain statements of what each keeps."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from caseloom.llm import language_id, line_rules, simhash
from caseloom.operators.scaling import Staging

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
STAGES = dict(corpus_pipeline.STAGES)


def documents(spark, rows):
    extra = [(*r, "extra", 1) for r in rows]
    return spark.createDataFrame(
        extra, "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, fp int"
    )


def prose(rng, n):
    return " ".join("".join(rng.choice(list("abcdefghij"), 5)) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    base = [prose(rng, 120) for _ in range(6)]
    out = [(i, t, "en", "s", len(t)) for i, t in enumerate(base)]
    out += [(10, base[0], "en", "s", 1), (11, base[1] + " and one more word.", "en", "s", 1)]
    out += [(20, None, "en", "s", None), (21, "", "en", "s", 0), (22, "... 12", None, None, None)]
    out += [(23, "MENU | HOME | ABOUT | NEWS\n" * 30, "en", "s", 1), (24, base[5] + "\nAll rights reserved.", "de", None, 1)]
    out += [(3, base[3], "en", "s", len(base[3])), (None, prose(rng, 90), "en", "s", 1)]
    return out


def ids(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in df.select("doc_id").collect())


def listed(*values):
    return sorted((v is None, v or 0) for v in values)


def test_stages_keep_what_they_say(spark, rows):
    docs = documents(spark, rows)
    told = STAGES["language_id"](spark, docs, SF)
    assert told.columns == docs.columns
    assert ids(told) == listed(0, 1, 2, 3, 3, 4, 5, 10, 11, 23, 24, None)
    assert {r["score"] for r in told.collect()} == {"extra"}

    clean = STAGES["quality_rules"](spark, told, SF)
    assert clean.columns == docs.columns
    assert ids(clean) == listed(0, 1, 2, 3, 3, 4, 5, 10, 11, 24, None)
    cut = clean.filter("doc_id = 24").first()
    assert cut["text"] == rows[5][1] and cut["n_chars"] == len(rows[5][1])

    once = STAGES["simhash"](spark, clean, SF)
    assert once.columns == docs.columns
    prints = {r["doc_id"]: r["fp"] for r in simhash.fingerprints(clean.drop("fp")).collect()}
    near = bin((prints[1] ^ prints[11]) & (2**64 - 1)).count("1") <= 4
    assert ids(once) == listed(0, 1, 2, 3, 4, 5, None, *([] if near else [11]))

    items = spark.createDataFrame([(1, rows[2][1][:80])], "item_id bigint, text string")
    folder = Staging(spark)
    items.write.parquet(f"{folder.root}/benchmark.parquet")
    safe = STAGES["decontaminate"](spark, once, folder.root)
    assert safe.columns == docs.columns
    assert ids(safe) == [x for x in ids(once) if x != (False, 2)]

    coded = STAGES["segment"](spark, safe, SF)
    assert ids(coded) == ids(safe) and coded.filter(~F.col("round_trip")).count() == 0


def test_stages_take_empty_tables(spark, rows):
    docs = documents(spark, rows).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, SF)
        assert got.count() == 0
        docs = got if got.columns == docs.columns else docs


def test_the_rules_are_evaluated_once(spark, rows):
    plan = STAGES["quality_rules"](spark, documents(spark, rows), SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("n_repeat_words") <= 3 * plan.count("Generate")


def test_the_whole_run_equals_the_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert docs.columns == COLUMNS
    learned = language_id.learn_profiles(docs)
    kept = language_id.identify(docs, learned).filter("lang_pred <> 'und'")
    kept = line_rules.line_first(kept).filter("line_rules.kept").select("doc_id", F.col("line_rules.cleaned").alias("text"))
    local = kept.collect()
    prints = {r["doc_id"]: r["fp"] for r in simhash.fingerprints(kept).collect()}
    order = sorted(prints)
    root = {i: i for i in order}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(order):
        for b in order[:k]:
            if ((prints[a] ^ prints[b]) & (2**64 - 1)).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    stay = {i for i in order if find(i) == i}
    items = [r["text"].lower().split() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {tuple(w.strip(".,!?") for w in t[k : k + 8]) for t in items for k in range(len(t) - 7)}

    def leaks(text):
        words = [w.strip(".,!?#$%&*") for w in text.lower().split()]
        words = [w for w in words if w]
        return any(tuple(words[k : k + 8]) in windows for k in range(len(words) - 7))

    want = {r["doc_id"] for r in local if r["doc_id"] in stay and not leaks(r["text"])}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in got} == want and len(got) == len(want)
    assert all(r["round_trip"] and len(r["samples"]) >= 1 for r in got)


def test_near_copies_are_grouped_by_text_and_not_by_id(spark):
    rng = np.random.default_rng(21)
    a, b, c, d, e = (prose(rng, 90) for _ in range(5))
    rows = [(None, a), (None, a), (None, b), (5, c), (5, d), (5, d), (None, e), (7, e), (6, e)]
    docs = documents(spark, [(i, t, "en", "s", len(t)) for i, t in rows])
    got = [(r["doc_id"], r["text"]) for r in STAGES["simhash"](spark, docs, SF).collect()]
    assert sorted(got, key=str) == sorted([(None, a), (None, b), (5, c), (5, d), (6, e)], key=str)


def test_without_a_language_to_learn_only_texts_without_a_letter_go(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 0)
    texts = [(1000, "some words"), (1001, "\u0905"), (1002, "12 ..."), (1003, ""), (1004, None)]
    for known in ([], [(held, "more words", "en", "s", 1)], [(1005, "34", "en", "s", 1)]):
        docs = documents(spark, known + [(i, t, None, "s", 1) for i, t in texts])
        want = listed(1000, 1001, *[i for i, *_ in known if i == held])
        assert ids(STAGES["language_id"](spark, docs, SF)) == want
