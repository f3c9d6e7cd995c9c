"""Language identification with hyperdimensional profiles.

Every letter has a random vector of signs. An n-gram's vector is the product of its
letters' vectors, each rotated by its place; a text's vector is the sum over its
n-grams, a language's the sum over its texts. A text gets the language whose vector
has the largest cosine with its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.llm.arrow import map_batches, pieces, with_columns

UNDETERMINED = "und"
MAX_LANGUAGES = 4096
"""Prototypes are held by the driver and every task; more languages are an error."""


@dataclass(frozen=True)
class Space:
    """``dims`` signs per letter, n-grams of ``size`` letters."""

    dims: int = 1024
    size: int = 3
    seed: int = 17

    def letters(self, points: np.ndarray) -> np.ndarray:
        """Signs of code points, float32; the same for a code point everywhere."""
        out = np.empty((len(points), self.dims), np.float32)
        for i, point in enumerate(points):
            bits = np.random.default_rng((self.seed, int(point))).integers(0, 2, self.dims)
            out[i] = 2 * bits - 1
        return out


_SPACE_POINT = 32
_CHUNK = 1 << 20
# Texts times characters, and so texts times n-grams, that are counted at a time
_CELLS = 16_000_000


class Encoder:
    """Sums of n-gram vectors for the rows of a piece."""

    def __init__(self, space: Space, block: int = 2048) -> None:
        self.space, self.block = space, block
        self.is_letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        self.known: dict[int, int] = {}
        self.signs = np.empty((0, space.dims), np.float32)

    def _rows(self, points: np.ndarray) -> np.ndarray:
        new = [int(p) for p in points if int(p) not in self.known]
        if new:
            if len(self.known) + len(new) > 4096:
                self.known, self.signs = {}, self.signs[:0]
                new = [int(p) for p in points]
            self.known |= {p: len(self.known) + i for i, p in enumerate(new)}
            self.signs = np.concatenate([self.signs, self.space.letters(np.array(new))])
        return self.signs[[self.known[int(p)] for p in points]]

    def grams(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(row, gram)`` of each n-gram, and the letters of each gram.

        Letters are lower-cased; a run of other characters is one space, and a
        text starts and ends with one.
        """
        lowered = [f" {(t or '').lower()} " for t in texts]
        points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
        rows = np.repeat(
            np.arange(len(lowered)), np.fromiter(map(len, lowered), np.int64, len(lowered))
        )
        letter = self.is_letter[points]
        keep = letter.copy()
        keep[0] = len(keep) > 0
        keep[1:] |= letter[:-1] | (rows[1:] != rows[:-1])
        points, rows = np.where(letter[keep], points[keep], _SPACE_POINT), rows[keep]
        k = self.space.size
        n = max(0, len(points) - k + 1)
        whole = rows[:n] == rows[k - 1 :] if n else np.zeros(0, bool)
        alphabet, ids = np.unique(points, return_inverse=True)
        codes = np.zeros(n, np.int64)
        for j in range(k):
            codes = codes * len(alphabet) + ids[j : j + n]
        codes, rows = codes[whole], rows[:n][whole]
        if len(alphabet) ** k <= 4_000_000:
            seen = np.zeros(len(alphabet) ** k, bool)
            seen[codes] = True
            found = np.flatnonzero(seen)
            place = np.empty(len(seen), np.int32)
            place[found] = np.arange(len(found))
            gram = place[codes]
        else:
            found, gram = np.unique(codes, return_inverse=True)
        letters = np.stack(
            [alphabet[(found // len(alphabet) ** (k - 1 - j)) % len(alphabet)] for j in range(k)],
            axis=1,
        ) if len(found) else np.zeros((0, k), np.uint32)
        return rows, gram, letters

    def add(self, sums: np.ndarray, texts: list[str | None], rows_to: np.ndarray | None = None) -> None:
        """Add the n-gram vectors of ``texts`` to rows of ``sums``.

        Texts longer than a chunk are cut into overlapping pieces, and many short ones
        are added in groups, so memory is bounded however long or many they are.
        """
        to = np.arange(len(texts)) if rows_to is None else rows_to
        if any(t is not None and len(t) > 2 * _CHUNK for t in texts):
            for t, row in zip(texts, to, strict=True):
                for cut in cuts(t or "", self.space.size):
                    self._add(sums, [cut], np.array([row]))
            return
        # a group has a count for every text and n-gram of it
        start, chars, own = 0, 0, set()
        for i, t in enumerate(texts):
            size = len(t or "") + 2
            if i > start and len(own | {int(to[i])}) * (chars + size) > _CELLS:
                self._add(sums, texts[start:i], to[start:i])
                start, chars, own = i, 0, set()
            chars += size
            own.add(int(to[i]))
        self._add(sums, texts[start:], to[start:])

    def _add(self, sums: np.ndarray, texts: list[str | None], to: np.ndarray) -> None:
        rows, gram, letters = self.grams(texts)
        if not len(gram):
            return
        targets, row = np.unique(to[rows], return_inverse=True)
        alphabet, ids = np.unique(letters, return_inverse=True)
        ids = ids.reshape(letters.shape)
        signs = self._rows(alphabet)
        turned = [np.roll(signs, self.space.size - 1 - j, axis=1) for j in range(self.space.size)]
        counts = np.bincount(row * len(letters) + gram, minlength=len(targets) * len(letters))
        counts = counts.reshape(len(targets), len(letters)).astype(np.float32)
        made = np.zeros((len(targets), self.space.dims), np.float32)
        for start in range(0, len(letters), self.block):
            part = slice(start, start + self.block)
            bound = turned[0][ids[part, 0]]
            for j in range(1, self.space.size):
                bound *= turned[j][ids[part, j]]
            made += counts[:, part] @ bound
        sums[targets] += made


def cuts(text: str, overlap: int) -> Iterator[str]:
    """A long text in pieces that end at a change between letter and other signs.

    A piece starts and ends with a space of its own, so cutting anywhere else would
    make n-grams the text does not have; a run of letters longer than a chunk is cut
    all the same.
    """
    start = 0
    while start < len(text):
        end = min(len(text), start + _CHUNK)
        while start + _CHUNK // 2 < end < len(text) and text[end].isalpha():
            end -= 1
        yield text[start:end]
        start = end


def profiles(
    df: DataFrame, text: str = "text", lang: str = "lang", space: Space = Space()
) -> dict[str, np.ndarray]:
    """The vector of each language, from every row with a language.

    Each task sums its own rows; what is shuffled and gathered is one vector per
    language and task, then one per language. Rows without language or text add
    nothing; more than ``MAX_LANGUAGES`` languages raise ``ValueError``. An empty
    table gives no profiles.
    """
    schema = T.StructType(
        [T.StructField("lang", T.StringType()), T.StructField("signs", T.ArrayType(T.DoubleType()))]
    )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, places = Encoder(space), {}
        sums = np.zeros((0, space.dims), np.float64)
        for batch in batches:
            for piece in pieces(batch, "text"):
                langs = piece.column("lang").to_pylist()
                for name in langs:
                    if name not in places:
                        places[name] = len(places)
                        if len(places) > MAX_LANGUAGES:
                            raise ValueError(f"more than {MAX_LANGUAGES} languages")
                sums = np.concatenate([sums, np.zeros((len(places) - len(sums), space.dims))])
                encoder.add(sums, piece.column("text").to_pylist(), np.array([places[x] for x in langs]))
        if places:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(places)), pa.array(list(sums), pa.list_(pa.float64()))],
                names=["lang", "signs"],
            )

    rows = df.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    parts = map_batches(rows.filter("lang IS NOT NULL AND text IS NOT NULL"), learn, schema)
    summed = (
        parts.select("lang", F.posexplode("signs"))
        .groupBy("lang", "pos")
        .agg(F.sum("col").alias("v"))
        .groupBy("lang")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "v"))), lambda x: x["v"]).alias("signs"))
        .limit(MAX_LANGUAGES + 1)
        .collect()
    )
    if len(summed) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return {r["lang"]: np.array(r["signs"]) for r in sorted(summed)}


def identify(
    df: DataFrame,
    learned: Mapping[str, np.ndarray],
    text: str = "text",
    space: Space = Space(),
    keep: list[str] | None = None,
) -> DataFrame:
    """``df`` with ``lang_pred``, ``score`` (cosine, 0 if negative) and ``margin``.

    ``margin`` is the lead over the second language. A null text, one without a
    letter and every text when nothing was learned get ``und`` and 0; equal cosines
    go to the language first in order. A row's result depends on its text alone,
    so repeated rows agree and an empty table gives an empty one. Columns of the
    three output names are replaced; ``keep`` names the others to return.
    """
    names = sorted(n for n, v in learned.items() if np.any(v))
    table = np.stack([learned[n] / np.linalg.norm(learned[n]) for n in names]).astype(np.float32) if names else None

    def start():
        encoder = Encoder(space)

        def work(texts):
            sums = np.zeros((len(texts), space.dims), np.float32)
            encoder.add(sums, texts)
            norms = np.linalg.norm(sums, axis=1)
            known = np.fromiter((any(map(str.isalpha, t)) if t else False for t in texts), bool, len(texts))
            if table is None:
                return [pa.array([UNDETERMINED] * len(texts)), *[pa.array(np.zeros(len(texts)))] * 2]
            cosines = (sums @ table.T) / np.maximum(norms, 1e-30)[:, None]
            best = np.argmax(cosines, axis=1)
            top = cosines[np.arange(len(texts)), best]
            rest = cosines.copy()
            rest[np.arange(len(texts)), best] = -1
            lead = top - rest.max(axis=1) if len(names) > 1 else top
            return [
                pa.array([names[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)]),
                pa.array(np.where(known, np.round(np.clip(top, 0, 1).astype(np.float64), 6), 0)),
                pa.array(np.where(known, np.round(lead.astype(np.float64), 6), 0)),
            ]

        return work

    added = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("margin", T.DoubleType())]
    return with_columns(df, text, added, start, keep)


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from learning: one in five by its id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def learn_profiles(docs: DataFrame) -> dict[str, np.ndarray]:
    return profiles(docs.filter(~held_out()))


def op1_language_id(spark, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    learned = learn_profiles(docs)
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    return identify(rows, learned, keep=["doc_id", "held_out"])


QUERIES = {"op1_language_id": op1_language_id}
ORACLE: dict[str, str] = {}
