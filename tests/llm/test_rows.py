"""Operators that judge rows one by one: languages, line rules, licences, quality."""

import math
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.llm import cotrain, language_id, licenses, line_rules
from caseloom.operators.scaling import Staging

SCHEMA = "doc_id bigint, text string"
ODD_TEXTS = [None, "", " \n\t ", "...", "\x00", "a", "é" * 3, "|" * 50, "x" * 300_000, "word " * 60_000, "\n" * 5000]


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {
        i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)
    }
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


@pytest.fixture(scope="module")
def mixed():
    rng = np.random.default_rng(5)
    vocabulary = ["alpha", "beta", "it", "of", "the", "Gamma.", "delta,", "#x", "é€", "\U0001f600"]
    gaps = [" ", " ", " ", "\n", "\t", "\x0b", "  ", " "]
    texts = []
    for size in rng.integers(1, 160, 120):
        texts.append("".join(rng.choice(vocabulary) + rng.choice(gaps) for _ in range(size)))
    return [*texts, *ODD_TEXTS]


def test_line_rule_counts_equal_a_plain_model(spark, mixed):
    rows = [(i, t) for i, t in enumerate(mixed)]
    got = line_rules.line_first(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "line_rules.*").collect()
    assert len(got) == len(rows)
    for r in got:
        want = plain_counts(mixed[r["doc_id"]])
        found = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert found == want, mixed[r["doc_id"]]
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_lines_are_judged_and_removed(spark):
    good = "\n".join(f"The {w} went along {w}{w} river to see what {w * 3} was there." for w in "abcdefgh")
    cases = {
        "menu | home | about | contact": True,
        "THIS IS ALL IN CAPITALS AND LOUD!": True,
        "no end of any sentence here": True,
        "We use cookies on this page.": True,
        "buy $$$ now *** cheap ### here.": True,
        "spam spam spam spam spam spam spam spam spam spam spam spam spam.": True,
        "A plain sentence stays.": False,
        "It ended. Then more followed without an end": False,
        "": False,
    }
    text = "\n".join([good, *cases])
    row = line_rules.line_first(spark.createDataFrame([(1, text)], SCHEMA)).first()["line_rules"]
    assert row["cleaned"] == "\n".join([good, *[k for k, bad in cases.items() if not bad]])
    assert row["n_failed_lines"] == 6 and row["kept"]
    junk = "\n".join([good] + ["THIS IS ALL IN CAPITALS AND LOUD!"] * 20)
    assert not line_rules.line_first(spark.createDataFrame([(1, junk)], SCHEMA)).first()["line_rules"]["kept"]


def test_running_text_that_speaks_of_pages_or_ends_in_other_signs_stays(spark):
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("aeiou") + list("bdglmnrst"), 6)) for _ in range(120)]
    prose = " ".join(words) + "."
    for line in (
        "We looked in the catalog in the hall.",
        "The design in this room was new.",
        "She taught JavaScript at the school.",
        "A set {1, 2} has two members.",
        "They log in the forest where the trees are old and tall, far from town.",
        "यह एक वाक्य है।",
        "هل هذا سؤال؟",
        "یہ ایک جملہ ہے۔",
        "นี่คือประโยคหนึ่ง",
        "Սա նախադասություն է։",
    ):
        one_line = line + " " + prose
        rows = [(1, line + "\n" + prose), (2, one_line)]
        for r in line_rules.line_first(spark.createDataFrame(rows, SCHEMA)).collect():
            judged = r["line_rules"]
            assert judged["n_failed_lines"] == 0 and judged["left_chars"] == judged["line_chars"], line
    for line in ("Read more.", "Sign in | Log in.", "We use cookies here!", "Lorem ipsum dolor sit amet, consectetur."):
        got = line_rules.line_first(spark.createDataFrame([(1, line + "\n" + prose)], SCHEMA)).first()["line_rules"]
        assert got["n_failed_lines"] == 1 and got["cleaned"] == prose, line


def test_row_operators_take_empty_tables_and_clashing_names(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert line_rules.line_first(empty).count() == 0
    assert licenses.recognise(empty).count() == 0
    assert language_id.identify(empty, {"en": np.ones(1024)}).count() == 0
    assert language_id.profiles(empty.withColumn("lang", F.lit("en"))) == {}
    clash = spark.createDataFrame([(1, "Some text.", 3, 4, 5, 6)], SCHEMA + ", score int, lang_pred int, line_rules int, license_scan int")
    assert line_rules.line_first(clash).first()["line_rules"]["n_words"] == 2
    assert licenses.recognise(clash).first()["license_scan"]["licenses"] == []
    row = language_id.identify(clash, {}).first()
    assert (row["lang_pred"], row["score"], row["line_rules"]) == ("und", 0.0, 5)


def test_languages_are_learned_and_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = language_id.op1_language_id(spark, sf).join(docs.select("doc_id", "lang"), "doc_id")
    right, n = found.filter("held_out").agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert n > 150 and right >= 0.98 * n


def test_many_short_texts_take_little_memory_and_add_up_as_they_do_alone():
    rng = np.random.default_rng(1)
    letters = [chr(c) for c in range(0x61, 0x7B)] + [chr(c) for c in range(0x430, 0x450)]
    texts = ["".join(rng.choice(letters, 95)) for _ in range(4000)]
    space = language_id.Space(dims=64)
    sums = np.zeros((len(texts), space.dims), np.float32)
    tracemalloc.start()
    language_id.Encoder(space).add(sums, texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400e6
    alone = np.zeros((1, space.dims), np.float32)
    language_id.Encoder(space).add(alone, [texts[1234]])
    assert np.array_equal(alone[0], sums[1234])


def test_language_vectors_equal_a_plain_bundle(spark):
    space = language_id.Space(dims=64)
    text = "Ab, b1c\nÄb"
    grams = Counter(" ab b c äb "[i : i + 3] for i in range(9))
    want = np.zeros(64)
    for gram, n in grams.items():
        vector = np.ones(64)
        for j, c in enumerate(gram):
            vector *= np.roll(space.letters(np.array([ord(c)]))[0], 2 - j)
        want += n * vector
    got = np.zeros((3, 64), np.float32)
    language_id.Encoder(space).add(got, [None, text, "12 3"])
    assert np.array_equal(got[1], want) and not got[0].any() and not got[2].any()


def test_odd_texts_have_a_language_or_none(spark):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(5, "a"), (None, "a")]
    learned = {"a": np.random.default_rng(1).normal(size=1024), "b": np.random.default_rng(2).normal(size=1024)}
    got = language_id.identify(spark.createDataFrame(rows, SCHEMA), learned).collect()
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
    assert len({(r["lang_pred"], r["score"]) for r in got if r["text"] == "a"}) == 1
    tie = language_id.identify(spark.createDataFrame([(1, "abc")], SCHEMA), {"z": np.ones(1024), "y": np.ones(1024)})
    assert tie.first()["lang_pred"] == "y"


def test_licences_are_matched_in_order(spark):
    names = licenses.SENTENCES
    texts = [
        "Intro. Released under the MIT License.\nMore.",
        "This work is licensed under the\nGNU General Public License,   version 3.",
        " ".join([names["bsd-grant"][0], names["bsd-source"][0], names["bsd-binary"][0]]),
        "\n".join(names[k][0] for k in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
        " ".join([names["bsd-binary"][0], names["bsd-source"][0], names["bsd-grant"][0]]),
        "We spoke about the MIT License. It was long.",
        *ODD_TEXTS,
    ]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r["license_scan"] for r in licenses.recognise(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[i]["licenses"] for i in range(6)] == [["MIT"], ["GPL-3.0"], ["BSD-2-Clause"], ["BSD-3-Clause"], [], []]
    assert all(got[i]["licenses"] == [] and got[i]["sentence_ids"] == [] for i in range(6, len(texts)))


HEADERS = {
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.""",
    "GPL-2.0": """This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version.""",
    "LGPL-2.1": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.""",
    "Apache-2.0": """Copyright 2020 Somebody
Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this""",
    "MIT": """Copyright (c) 2020 Somebody
Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
3. Neither the name of Somebody Inc nor the names of its contributors may be used to
   endorse or promote products derived from this software without specific prior written permission.""",
}


def test_standard_headers_wrapped_commented_and_joined(spark):
    rows, want = [], []
    for name, header in HEADERS.items():
        lines = header.split("\n")
        for text in (
            header,
            "My tool\n" + header + "\nint main",
            " ".join(header.split()),
            "\n".join("// " + x for x in lines),
            "/*\n" + "\n".join(" * " + x for x in lines) + "\n */",
        ):
            rows.append((len(rows), text))
            want.append([name])
    for text, name in (
        ("The code is licensed under MIT License", ["MIT"]),
        ("Licensed under the MIT license, see LICENSE.", ["MIT"]),
        ("# SPDX-License-Identifier: Apache-2.0\nimport os", ["Apache-2.0"]),
        ("SPDX-License-Identifier: GPL-3.0-or-later", ["GPL-3.0"]),
        ("SPDX-License-Identifier: MIT\nLicensed under CC BY 4.0 here", ["CC-BY-4.0", "MIT"]),
        ("This driver is licensed under the terms he read.", []),
    ):
        rows.append((len(rows), text))
        want.append(name)
    got = licenses.recognise(spark.createDataFrame(rows, SCHEMA)).sort("doc_id").collect()
    assert [r["license_scan"]["licenses"] for r in got] == want


DOC_SCHEMA = SCHEMA + ", lang string, source string, n_chars bigint"
LABEL_SCHEMA = "doc_id bigint, quality int"


def quality_rows(seed, n, labelled):
    """Good and bad texts that overlap; metadata tells three quarters of them."""
    rng = np.random.default_rng(seed)
    words = ["river", "house", "walks", "evening", "quiet", "garden"]
    rows, labels = [], []
    for i in range(n):
        good = i % 3 > 0
        tidy = good if rng.random() < 0.9 else not good
        size = int(rng.integers(10, 60))
        text = " ".join(rng.choice(words, size)) + "." if tidy else " | ".join(rng.choice(words, size)).upper() + "!!"
        lang = ("en" if good else "xx") if rng.random() < 0.75 else "yy"
        rows.append((i, text, lang, f"s{int(rng.integers(5))}", len(text)))
        if i < labelled:
            labels.append((i, int(good)))
    return rows, labels


def judged(spark, rows, labels, **settings):
    staging = Staging(spark)
    docs, known = spark.createDataFrame(rows, DOC_SCHEMA), spark.createDataFrame(labels, LABEL_SCHEMA)
    made = cotrain.features(docs, known, staging)
    return cotrain.score(made, cotrain.learn(made, staging, cotrain.CoTraining(**settings))).collect()


def plain_co_training(rows, labels, settings):
    """The same rounds with everything in memory: a pool that shrinks, lessons that grow."""
    label = dict(labels)
    text = cotrain.text_features([r[1] for r in rows])
    meta = cotrain.meta_features(*([r[k] for r in rows] for k in (2, 3, 4)))
    views = {"text": text, "meta": meta}
    known = [i for i, r in enumerate(rows) if r[0] in label]
    y = np.array([label[rows[i][0]] for i in known])
    held = known[:: max(2, round(1 / settings.calibration))]
    learn = [i for i in known if i not in set(held)]
    y_of = dict(zip(known, y))
    models = {n: cotrain.Logistic.fit(x[learn], np.array([y_of[i] for i in learn], float), settings.ridge) for n, x in views.items()}
    pool = [i for i in range(len(rows)) if i not in y_of]
    lessons = {"text": [], "meta": []}
    share, unlabelled = y.mean(), len(pool)

    def calibrate():
        for n, x in views.items():
            models[n].calibrate(x[held], np.array([y_of[i] for i in held], float))

    calibrate()
    passed = 0
    for _ in range(settings.rounds):
        chosen = {}
        for n, x in views.items():
            logit = {i: min(max(float(v), -40), 39.99) for i, v in zip(pool, models[n].logit(x[pool]))}
            for value, sign, part in ((1, 1, share), (0, -1, 1 - share)):
                sure = np.log(settings.sure / (1 - settings.sure))
                bins = sorted({math.floor(v / 0.02) for v in logit.values()}, reverse=sign > 0)
                taken = []
                for b in bins:
                    if (b < math.ceil(sure / 0.02)) if sign > 0 else (b >= -math.ceil(sure / 0.02)):
                        break
                    members = [i for i, v in logit.items() if math.floor(v / 0.02) == b]
                    if taken and len(taken) + len(members) > settings.share * unlabelled * part:
                        break
                    taken += members
                chosen[n, value] = taken
        for n, other in (("text", "meta"), ("meta", "text")):
            for value in (1, 0):
                lessons[other] += [(i, value) for i in chosen[n, value]]
        gone = {i for taken in chosen.values() for i in taken}
        passed += len(gone)
        pool = [i for i in pool if i not in gone]
        for _ in range(settings.steps):
            for n, x in views.items():
                at = learn + [i for i, _ in lessons[n]]
                labels_ = np.array([y_of[i] for i in learn] + [v for _, v in lessons[n]], float)
                models[n].newton(*models[n].sums(x[at], labels_), settings.ridge)
        calibrate()
    good = int(y.sum())
    prior = float(np.log((good + 0.5) / (len(y) - good + 0.5)))
    return cotrain.Model(models["text"], models["meta"], prior).score(text, meta)[2], passed


def test_co_training_equals_rounds_in_memory(spark):
    rows, labels = quality_rows(7, 700, 120)
    settings = cotrain.CoTraining(share=0.2, sure=0.8)
    want, passed = plain_co_training(rows, labels, settings)
    got = {r["doc_id"]: r["score"] for r in judged(spark, rows, labels, share=0.2, sure=0.8)}
    assert passed > 100
    assert [got[r[0]] for r in rows] == pytest.approx(list(want), abs=1e-6)


def test_quality_is_learned_from_some_and_given_to_all(spark):
    rows, labels = quality_rows(3, 400, 200)
    # a labelled id with two texts, unlabelled rows without id, nulls everywhere
    rows += [(900, None, None, None, None), (901, "", "en", "s1", 0), (1, rows[2][1], "en", "s1", 3), (None, "x", None, None, 1)]
    rows += [(900, None, None, None, None)] * 3
    labels += [(5, None), (None, 1), (7777, 0)]
    got = judged(spark, rows, labels, max_labelled=150)
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    unseen = [r for r in got if r["doc_id"] is not None and 200 <= r["doc_id"] < 400]
    assert sum(r["kept"] == (r["doc_id"] % 3 > 0) for r in unseen) >= 0.9 * len(unseen)
    assert len({r["score"] for r in got if r["doc_id"] == 900}) == 1
    again = judged(spark, rows[::-1], labels[::-1], max_labelled=150)
    assert sorted((r["doc_id"] or -1, round(r["score"], 9)) for r in again) == sorted(
        (r["doc_id"] or -1, round(r["score"], 9)) for r in got
    )


def test_quality_without_labels_is_flat(spark):
    row = (1, "a", "en", "s", 1)
    assert judged(spark, [row], [])[0]["score"] == 0.5
    assert judged(spark, [row], [(1, 1)])[0]["score"] == 0.75
    assert judged(spark, [], []) == []
