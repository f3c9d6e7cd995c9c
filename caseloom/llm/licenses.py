"""Licence recognition by sentences.

Normalised sentences are looked up among known licence sentences; the identifiers
found, in text order, are matched against rules that list identifiers in order.
Built-in functions only: the catalogue is part of the expression, so a row is judged
where it was read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of licences, headers and notices, by identifier; what a sentence has
# before or behind these words does not matter. A sentence may have several wordings.
SENTENCES: dict[str, tuple[str, ...]] = {
    "mit-notice": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Licensed under MIT License.",
        "Distributed under the MIT License.",
        "SPDX-License-Identifier: MIT",
    ),
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the \"Software\"), to deal in the Software without restriction,"
        " including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,"
        " and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,"
        " subject to the following conditions:",
    ),
    "mit-condition": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial"
        " portions of the Software.",
    ),
    "as-is": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT"
        " LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "isc-notice": ("Licensed under the ISC License.", "SPDX-License-Identifier: ISC"),
    "apache-notice": (
        "Licensed under the Apache License, Version 2.0",
        "Released under the Apache License, Version 2.0",
        "Licensed under the Apache License 2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "apache-comply": ("You may not use this file except in compliance with the License.",),
    "apache-limits": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is"
        " distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "gpl3-notice": (
        "Licensed under the GNU General Public License, version 3",
        "Licensed under the GNU General Public License v3",
        "Licensed under the GPL v3",
        "Licensed under GPLv3",
        "SPDX-License-Identifier: GPL-3.0",
    ),
    "gpl3-free": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by"
        " the Free Software Foundation, either version 3 of the License",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License version 3",
    ),
    "gpl2-notice": (
        "Licensed under the GNU General Public License, version 2",
        "Licensed under the GNU General Public License v2",
        "SPDX-License-Identifier: GPL-2.0",
    ),
    "gpl-free": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by"
        " the Free Software Foundation",
    ),
    "gpl2-free": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2",
    ),
    "either-2": ("either version 2 of the License",),
    "either-2.1": ("either version 2.1 of the License",),
    "agpl-free": (
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as"
        " published by the Free Software Foundation, either version 3 of the License",
        "Licensed under the GNU Affero General Public License, version 3",
        "SPDX-License-Identifier: AGPL-3.0",
    ),
    "gnu-hope": ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",),
    "lgpl-hope": ("This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",),
    "lgpl3-notice": (
        "Licensed under the GNU Lesser General Public License, version 3",
        "SPDX-License-Identifier: LGPL-3.0",
    ),
    "lgpl3-free": (
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as"
        " published by the Free Software Foundation, either version 3 of the License",
    ),
    "lgpl-free": (
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as"
        " published by the Free Software Foundation",
    ),
    "lgpl21-notice": (
        "Licensed under the GNU Lesser General Public License, version 2.1",
        "SPDX-License-Identifier: LGPL-2.1",
    ),
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met:",
    ),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the"
        " following disclaimer.",
    ),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the"
        " following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    "bsd-names": (
        "nor the names of its contributors may be used to endorse or promote products derived from this software"
        " without specific prior written permission.",
    ),
    "bsd3-notice": (
        "Licensed under the BSD 3-Clause License",
        "Licensed under the 3-Clause BSD License",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "bsd2-notice": (
        "Licensed under the BSD 2-Clause License",
        "Licensed under the 2-Clause BSD License",
        "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "cc-by-nc-notice": (
        "Licensed under CC BY-NC 4.0",
        "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "cc-by-notice": (
        "Licensed under CC BY 4.0",
        "Licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "cc-by-sa-notice": (
        "Licensed under CC BY-SA 4.0",
        "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "cc0-notice": ("Released under CC0 1.0", "Licensed under CC0 1.0", "SPDX-License-Identifier: CC0-1.0"),
    "mpl-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "unlicense": ("This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"),
}


@dataclass(frozen=True)
class Rule:
    """``license`` holds where ``sentences`` occur in this order, others between or not."""

    license: str
    sentences: tuple[str, ...]


# Which sentences, in order, make which licence.
RULES: tuple[Rule, ...] = (
    Rule("MIT", ("mit-grant", "mit-condition", "as-is")),
    Rule("MIT", ("mit-notice",)),
    Rule("ISC", ("isc-grant",)),
    Rule("ISC", ("isc-notice",)),
    Rule("Apache-2.0", ("apache-notice",)),
    Rule("GPL-3.0", ("gpl3-notice",)),
    Rule("GPL-3.0", ("gpl3-free",)),
    Rule("GPL-2.0", ("gpl2-notice",)),
    Rule("GPL-2.0", ("gpl2-free",)),
    Rule("GPL-2.0", ("gpl-free", "either-2")),
    Rule("AGPL-3.0", ("agpl-free",)),
    Rule("LGPL-3.0", ("lgpl3-notice",)),
    Rule("LGPL-3.0", ("lgpl3-free",)),
    Rule("LGPL-2.1", ("lgpl21-notice",)),
    Rule("LGPL-2.1", ("lgpl-free", "either-2.1")),
    Rule("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    Rule("BSD-3-Clause", ("bsd3-notice",)),
    Rule("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    Rule("BSD-2-Clause", ("bsd2-notice",)),
    Rule("CC-BY-NC-4.0", ("cc-by-nc-notice",)),
    Rule("CC-BY-SA-4.0", ("cc-by-sa-notice",)),
    Rule("CC-BY-4.0", ("cc-by-notice",)),
    Rule("CC0-1.0", ("cc0-notice",)),
    Rule("MPL-2.0", ("mpl-notice",)),
    Rule("Unlicense", ("unlicense",)),
)


_SPACES = r"[\x09-\x0D\x20]+"
_BREAK = "\x01"


def normal(sentence: str) -> str:
    """Lower-case letters and digits, single spaces between."""
    return re.sub(r"[^a-z0-9]+", " ", sentence.lower()).strip()


def known_sentences(sentences: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """Identifier by normalised sentence, longer ones first. A wording that is cut in
    parts, as by an abbreviation, is known by its longest part."""
    known: dict[str, str] = {}
    for id, wordings in sentences.items():
        for wording in wordings:
            whole = re.sub(r"(?i)spdx-license-identifier:", "spdx license identifier", wording)
            parts = [normal(x) for x in re.split(r"(?<=[.:;])\s+", whole)]
            key = max(parts, key=len)
            if known.setdefault(key, id) != id:
                raise ValueError(f"one sentence for {id} and {known[key]}")
    return dict(sorted(known.items(), key=lambda e: (-len(e[0]), e[0])))


def openings(known: Mapping[str, str], least: int = 3) -> str:
    """A pattern of the words known sentences begin with: so many that they do not stand
    inside another one."""

    def opening(sentence: str) -> str:
        words = sentence.split()
        for n in range(least, len(words)):
            begin = " ".join(words[:n])
            if not any(f" {begin} " in f"{s} " for s in known):
                return begin
        return sentence

    return "|".join(sorted({opening(s) for s in known}, reverse=True))


def cues(known: Mapping[str, str]) -> list[str]:
    """Words such that every known sentence has one, commonest first."""
    rest, found = set(known), []
    while rest:
        words = [w for s in rest for w in set(s.split()) if len(w) >= 4] or list(rest)
        found.append(min(set(words), key=lambda w: (-words.count(w), w)))
        rest = {s for s in rest if found[-1] not in s}
    return found


def _sentences(lowered: Column, known: Mapping[str, str]) -> Column:
    """Normalised sentences that begin as a known one does."""
    begins = openings(known)
    tagged = F.regexp_replace(lowered, "spdx-license-identifier:", "spdx license identifier")
    cut = F.regexp_replace(tagged, f"[.:;]{_SPACES}|\n[\x09\x20]*\n", _BREAK)
    plain = F.concat(F.lit(" "), F.regexp_replace(cut, f"[^a-z0-9{_BREAK}]+", " "), F.lit(" "))
    parts = F.split(F.regexp_replace(plain, f" ({begins}) ", f"{_BREAK}$1 "), _BREAK)
    return F.filter(
        F.transform(parts, lambda x: F.concat(F.trim(x), F.lit(" "))),
        lambda x: F.regexp_like(x, F.lit(f"^({begins}) ")),
    )


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def recognise(
    df: DataFrame,
    text: str = "text",
    sentences: Mapping[str, Sequence[str]] = SENTENCES,
    rules: Sequence[Rule] = RULES,
    output: str = "license_scan",
) -> DataFrame:
    """``df`` and the struct ``output``: ``sentence_ids`` in text order, ``licenses`` sorted.

    Lines are joined, so sentences may be wrapped and stand behind comment signs. A
    sentence ends with a full stop, colon or semicolon before white space, with a blank
    line, or where a known one begins; it is the longest known sentence that it begins
    with, whatever follows. A rule says nothing where a longer one of another licence
    that has all its sentences holds. Null and empty texts and texts without a known sentence get empty lists; a
    sentence found twice is there twice. Rows are judged one by one, so repeated rows
    agree and an empty table gives an empty one; a column already named ``output`` is
    replaced.
    """
    known = known_sentences(sentences)
    # longer sentences first
    catalogue = F.array(
        *[F.struct(F.lit(f"{s} ").alias("s"), F.lit(i).alias("id")) for s, i in known.items()]
    )
    whole = F.coalesce(F.col(text), F.lit(""))

    def ids(lowered: Column) -> Column:
        found = F.transform(
            _sentences(lowered, known),
            lambda x: F.get(F.filter(catalogue, lambda k: F.startswith(x, k["s"])), F.lit(0))["id"],
        )
        return F.filter(found, lambda i: i.isNotNull())

    def holds(line: Column, rule: Rule) -> Column:
        between = " (?:[^ ]+ )*"
        return F.regexp_like(line, F.lit(" " + between.join(map(re.escape, rule.sentences)) + " "))

    def scan(found: Column) -> Column:
        line = F.concat(F.lit(" "), F.array_join(found, " "), F.lit(" "))
        held = []
        for rule in rules:
            says = holds(line, rule)
            for other in rules:
                if other.license != rule.license and set(rule.sentences) < set(other.sentences):
                    says = says & ~holds(line, other)
            held.append(F.when(says, F.lit(rule.license)))
        return F.struct(
            found.alias("sentence_ids"),
            F.when(
                F.size(found) > 0,
                F.sort_array(F.array_distinct(F.filter(F.array(*held), lambda x: x.isNotNull()))),
            )
            .otherwise(F.array().cast("array<string>"))
            .alias("licenses"),
        )

    # most texts have no word that any known sentence needs, and are not cut at all
    lowered = F.lower(whole)
    suspect = reduce(or_, [lowered.contains(w) for w in cues(known)])
    none = F.array().cast("array<string>")
    return df.withColumn(output, _bound(F.when(suspect, ids(lowered)).otherwise(none), scan))


def op3_license_scan(spark, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return recognise(docs).select(
        "doc_id",
        F.array_join("license_scan.sentence_ids", " ").alias("sentence_ids"),
        F.array_join("license_scan.licenses", " ").alias("licenses"),
    )


def _sql(sentences: Mapping[str, Sequence[str]] = SENTENCES, rules: Sequence[Rule] = RULES) -> str:
    known = ", ".join(f"('{s}', '{i}')" for s, i in known_sentences(sentences).items())

    def holds(rule: Rule) -> str:
        return f"regexp_matches(line, ' {' (?:[^ ]+ )*'.join(rule.sentences)} ')"

    parts = []
    for rule in rules:
        more = [o for o in rules if o.license != rule.license and set(rule.sentences) < set(o.sentences)]
        says = " AND ".join([holds(rule), *(f"NOT {holds(o)}" for o in more)])
        parts.append(f"CASE WHEN {says} THEN '{rule.license}' END")
    begins = openings(known_sentences(sentences))
    return f"""
WITH known(sentence, id) AS (VALUES {known}),
d AS (SELECT row_number() OVER () AS rid, doc_id, lower(coalesce(text, '')) AS text FROM documents),
c AS (
  SELECT rid, ' ' || regexp_replace(regexp_replace(replace(text, 'spdx-license-identifier:', 'spdx license identifier'),
    '[.:;][\\x09-\\x0D\\x20]+|\\n[\\x09\\x20]*\\n', chr(1), 'g'), '[^a-z0-9\\x01]+', ' ', 'g') || ' ' AS text FROM d
), r AS (SELECT rid, string_split(regexp_replace(text, ' ({begins}) ', chr(1) || '\\1 ', 'g'), chr(1)) AS s FROM c),
e AS (SELECT rid, trim(unnest(s)) || ' ' AS s, generate_subscripts(s, 1) AS i FROM r),
m AS (SELECT rid, i, arg_max(id, length(sentence)) AS id FROM e JOIN known ON starts_with(s, sentence || ' ') GROUP BY rid, i),
b AS (SELECT rid, string_agg(id, ' ' ORDER BY i) AS ids FROM m GROUP BY rid),
g AS (SELECT doc_id, coalesce(ids, '') AS sentence_ids, ' ' || coalesce(ids, '') || ' ' AS line FROM d LEFT JOIN b USING (rid))
SELECT doc_id, sentence_ids, array_to_string(list_sort(list_distinct([{", ".join(parts)}])), ' ') AS licenses FROM g
"""


QUERIES = {"op3_license_scan": op3_license_scan}
ORACLE = {"op3_license_scan": _sql()}
