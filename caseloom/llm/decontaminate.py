"""Benchmark decontamination by template windows.

Numbers, names and units become typed placeholders, so that a question asked anew
with other values has the template of the original. Windows of templates are joined
by hash; along each alignment of a document with an item the values in the slots are
then checked: one value of the item has to become one value of the document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.llm.arrow import pieces
from caseloom.operators.scaling import Staging

# What may follow a number as its unit.
UNITS = frozenset(
    "mm cm m km in ft yd mi mg g kg t oz lb lbs ml cl l s sec min h hr hrs kmh mph hz khz mhz kb mb gb tb"
    " meters metres kilometers kilometres miles feet inches grams kilograms tons pounds ounces liters litres"
    " gallons seconds minutes hours days weeks months years degrees percent dollars euros cents"
    " usd eur gbp watts volts joules".split()
)
# Numbers written as words.
NUMBER_WORDS = frozenset(
    "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    " eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million".split()
)
_NUMBER = re.compile(r"[+-]?\d+(?:[.,:/]\d+)*(?:st|nd|rd|th)?")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_NAME, _NUM, _UNIT = 1, 2, 3
_MARKS = {_NAME: "<name>", _NUM: "<number>", _UNIT: "<unit>"}
# How a window is read: its placeholders as they are, its first capital as a plain word or as
# a name, or all of it as it stands
_AS_MARKED, _FIRST_WORD, _FIRST_NAME, _LITERAL = range(4)
_FILTER_BITS = 23


@dataclass(frozen=True)
class Windows:
    """``size`` tokens a window. One with fewer than ``literals`` plain words says little as
    a template and is sought as it stands.

    An item with fewer tokens is one window of its own length, at least ``literals``.
    """

    size: int = 8
    literals: int = 3


class Tokens:
    """Tokens of many texts as arrays; words already seen are looked up."""

    def __init__(self, limit: int = 400_000) -> None:
        self.limit = limit
        self._clear()

    def _clear(self) -> None:
        self.places: dict[str, int] = {}
        self.literal: list[str] = []
        self.hash = np.zeros(1024, np.uint64)
        self.flags = np.zeros((1024, 5), bool)  # ends a sentence, capital, number, unit, a token at all

    def _learn(self, raw: str) -> int:
        plain = _EDGES.sub("", raw)
        low = plain.lower()
        place = len(self.literal)
        if place == len(self.hash):
            self.hash = np.concatenate([self.hash, np.zeros_like(self.hash)])
            self.flags = np.concatenate([self.flags, np.zeros_like(self.flags)])
        tail = raw[raw.rfind(plain) + len(plain) :] if plain else raw
        self.literal.append(low)
        self.hash[place] = xxhash.xxh64_intdigest(low.encode("utf-8", "surrogatepass"), 1)
        self.flags[place] = (
            any(c in tail for c in ".!?…"),
            plain[:1].isupper() and plain[1:].islower(),
            bool(_NUMBER.fullmatch(low)) or low in NUMBER_WORDS,
            low in UNITS,
            bool(low),
        )
        self.places[raw] = place
        return place

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(row, place, kind)`` of every token; kind 0 is a plain word."""
        if len(self.places) > self.limit:
            self._clear()
        places, learn = self.places, self._learn
        found: list[int] = []
        counts = np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            words = (text or "").split()
            counts[k] = len(words)
            found += [places[w] if w in places else learn(w) for w in words]
        place = np.array(found, np.int64)
        row = np.repeat(np.arange(len(texts)), counts)
        if not len(place):
            return row, place, np.zeros(0, np.int8)
        ends, capital, number, unit, any_ = self.flags[place].T
        first = np.r_[True, row[1:] != row[:-1]]
        begins = first | np.r_[True, ends[:-1]]
        after = np.r_[False, number[:-1]] & ~first
        kind = np.zeros(len(place), np.int8)
        kind[capital & ~begins] = _NAME
        kind[unit & after] = _UNIT
        kind[number] = _NUM
        return row[any_], place[any_], kind[any_]

    def windows(
        self, row: np.ndarray, place: np.ndarray, kind: np.ndarray, size: int, literals: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(start, reading, hash)`` of all windows that stay in a row.

        A window with few plain words is read as it stands. The first capital of another
        may begin a sentence or a name - a heading or a colon before it tells nothing -
        so it is read both ways.
        """
        n = len(place) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int8), np.zeros(0, np.uint64)
        factor, salt = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)
        plain = np.r_[0, np.cumsum(kind == 0)]
        few = plain[size:] - plain[:n] < literals
        word = self.hash[place]
        mark = np.where(kind > 0, kind.astype(np.uint64) * salt, word)
        capital = self.flags[place, 1] & (kind != _NUM) & (kind != _UNIT)
        start = np.flatnonzero(row[:n] == row[size - 1 :])

        def mixed(token: np.ndarray, first: np.ndarray, begin: int) -> np.ndarray:
            out = np.full(n, begin, np.uint64)
            for j in range(size):
                out *= factor
                out += first[:n] if j == 0 else token[j : j + n]
            out ^= out >> np.uint64(32)
            return out * factor

        name = np.full(len(place), np.uint64(_NAME) * salt)
        readings = (
            (_LITERAL, few, lambda: mixed(word, word, size + 1000)),
            (_FIRST_WORD, ~few & capital[:n], lambda: mixed(mark, word, size)),
            (_FIRST_NAME, ~few & capital[:n], lambda: mixed(mark, name, size)),
            (_AS_MARKED, ~few & ~capital[:n], lambda: mixed(mark, mark, size)),
        )
        starts, kinds, hashes = [], [], []
        for reading, which, work in readings:
            at = start[which[start]]
            if len(at):
                starts.append(at)
                kinds.append(np.full(len(at), reading, np.int8))
                hashes.append(work()[at])
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int8), np.zeros(0, np.uint64)
        return np.concatenate(starts), np.concatenate(kinds), np.concatenate(hashes)

    def shown(self, place: np.ndarray, kind: np.ndarray, reading: int) -> tuple[str, list[str]]:
        """A window's template, and the values in its slots."""
        words = [self.literal[p] for p in place]
        if reading == _LITERAL:
            return "=" + " ".join(words), []
        kinds = kind.tolist()
        if reading != _AS_MARKED:
            kinds[0] = _NAME if reading == _FIRST_NAME else 0
        return (
            " ".join(_MARKS.get(k, w) for w, k in zip(words, kinds, strict=True)),
            [w for w, k in zip(words, kinds, strict=True) if k],
        )


_WINDOW = T.StructType(
    [
        T.StructField("key", T.LongType()),
        T.StructField("wh", T.LongType()),
        T.StructField("pos", T.LongType()),
        T.StructField("template", T.StringType()),
        T.StructField("slots", T.ArrayType(T.StringType())),
    ]
)


def _emit(keys: pa.Array, tokens: Tokens, row, place, kind, picked: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    first = np.searchsorted(row, np.arange(len(keys)))
    columns: list[list] = [[], [], [], [], []]
    for start, size, reading, wh in picked:
        template, slots = tokens.shown(place[start : start + size], kind[start : start + size], reading)
        for column, value in zip(
            columns, (keys[int(row[start])].as_py(), wh, int(start - first[row[start]]), template, slots), strict=True
        ):
            column.append(value)
    types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string()))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[f.name for f in _WINDOW]
    )


def item_windows(items: DataFrame, id: str = "item_id", text: str = "text", windows: Windows = Windows()) -> DataFrame:
    """``(item_id, size, wh, pos, template, slots)`` of a benchmark's items."""
    schema = T.StructType(_WINDOW.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for batch in batches:
            for piece in pieces(batch, "text", 200_000):
                row, place, kind = tokens.read(piece.column("text").to_pylist())
                picked = []
                lengths = np.bincount(row, minlength=piece.num_rows)
                for size in sorted({min(windows.size, int(n)) for n in lengths if n >= windows.literals}):
                    fits = lengths >= size if size == windows.size else lengths == size
                    start, reading, wh = tokens.windows(row, place, kind, size, windows.literals)
                    own = np.flatnonzero(fits[row[start]])
                    picked += [
                        (s, size, r, h)
                        for s, r, h in zip(
                            start[own].tolist(), reading[own].tolist(), wh[own].view(np.int64).tolist(), strict=True
                        )
                    ]
                yield _emit(piece.column("key"), tokens, row, place, kind, picked)

    return (
        items.select(F.col(id).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))
        .filter("key IS NOT NULL")
        .mapInArrow(run, schema)
        .withColumnRenamed("key", "item_id")
        .distinct()
    )


def _filter_of(found: DataFrame) -> bytes:
    """Bits of the windows' hashes: one megabyte however large the benchmark is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << _FILTER_BITS, bool)
        for batch in batches:
            wh = batch.column("wh").to_numpy().view(np.uint64)
            seen[(wh >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(seen).tobytes()])], names=["bits"])

    total = np.zeros(1 << (_FILTER_BITS - 3), np.uint8)
    for part in found.select("wh").coalesce(8).mapInArrow(run, "bits binary").toLocalIterator():
        total |= np.frombuffer(part["bits"], np.uint8)
    return total.tobytes()


def candidate_windows(docs: DataFrame, bits: bytes, sizes: list[int], windows: Windows = Windows()) -> DataFrame:
    """Windows of ``docs (key, text)`` whose hash may be one of the benchmark's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        wanted = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
        for batch in batches:
            for piece in pieces(batch, "text"):
                row, place, kind = tokens.read(piece.column("text").to_pylist())
                picked = []
                for size in sizes:
                    start, reading, wh = tokens.windows(row, place, kind, size, windows.literals)
                    hit = np.flatnonzero(wanted[(wh >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
                    picked += [
                        (s, size, r, h)
                        for s, r, h in zip(
                            start[hit].tolist(), reading[hit].tolist(), wh[hit].view(np.int64).tolist(), strict=True
                        )
                    ]
                if picked:
                    yield _emit(piece.column("key"), tokens, row, place, kind, picked)

    return docs.mapInArrow(run, _WINDOW)


def matches(
    docs: DataFrame, items: DataFrame, staging: Staging, windows: Windows = Windows()
) -> DataFrame:
    """``(key, item_id, n_windows)``: the items found in documents ``(key, text)``.

    A window without slots is evidence as it stands, and so is one whose slots hold the
    item's own values. Another is evidence if every value of the item in its slots stands
    for one value of the document along the whole alignment. Null and empty texts have
    no windows, a text of any length as many as it has words; an item of fewer than
    three words, or without id, is not looked for. Rows with equal keys count as one
    document, equal items each for itself. Empty documents or items give no rows.
    """
    found = staging.table(item_windows(items, windows=windows), "item-windows")
    size_of = F.size(F.split("template", " "))
    # at most as many as a window has tokens
    sizes = [r[0] for r in found.select(size_of.alias("n")).distinct().sort("n").collect()]
    if not sizes:
        return found.select(F.col("item_id").alias("key"), "item_id", F.col("pos").alias("n_windows"))
    seen = candidate_windows(docs.select("key", "text"), _filter_of(found), sizes, windows).distinct()
    item = found.select(
        "wh", "template", "item_id", F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots")
    )
    hits = staging.table(
        seen.join(item, ["wh", "template"]).select(
            "key", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift"), "pos", "slots", "item_slots"
        ),
        "window-hits",
    )
    alignment = ["key", "item_id", "shift"]
    odd = (
        hits.filter(F.size("slots") > 0)
        .select(*alignment, F.explode(F.arrays_zip("item_slots", "slots")).alias("z"))
        .groupBy(*alignment, F.col("z.item_slots").alias("v"))
        .agg((F.min("z.slots") != F.max("z.slots")).alias("odd"))
        .filter("odd")
        .groupBy(*alignment)
        # values of one item
        .agg(F.collect_set("v").alias("odd"))
    )
    counts = (
        F.col("odd").isNull()
        | (F.size("slots") == 0)
        | (F.col("slots") == F.col("item_slots"))
        | ~F.arrays_overlap("item_slots", "odd")
    )
    return (
        hits.join(odd, alignment, "left")
        .filter(counts)
        # a window that can be read in two ways counts once
        .select("key", "item_id", "shift", "pos")
        .distinct()
        .groupBy("key", "item_id")
        .agg(F.count(F.lit(1)).alias("n_windows"))
    )


def row_key(id: str = "doc_id", text: str = "text") -> F.col:
    """What stands for a row: its id and text, nulls included."""
    return F.xxhash64(F.col(id), F.col(text).isNull(), F.col(text))


def contaminated(
    docs: DataFrame, items: DataFrame, staging: Staging, windows: Windows = Windows()
) -> DataFrame:
    """``(key, item_ids, n_windows)`` per contaminated document ``(key, text)``."""
    return (
        matches(docs, items, staging, windows)
        .groupBy("key")
        .agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.sum("n_windows").alias("n_windows"))
    )


def op8_decontaminate(spark, sf: str) -> DataFrame:
    staging = Staging(spark)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text")
    keyed = docs.select("doc_id", row_key().alias("key"), "text")
    found = contaminated(keyed, items, staging)
    return (
        keyed.select("doc_id", "key")
        .join(found, "key", "left")
        .select(
            "doc_id",
            F.col("item_ids").isNotNull().alias("contaminated"),
            F.coalesce("n_windows", F.lit(0)).alias("n_windows"),
            F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
        )
    )


QUERIES = {"op8_decontaminate": op8_decontaminate}
ORACLE: dict[str, str] = {}
