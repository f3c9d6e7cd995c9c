"""Text columns: normalisation, catalog lookup, defaults and regex cascades."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TILDE = "\u0303"
# What counts as white space when words are split
_WHITESPACE = r"(?U)[\s\x{1c}-\x{1f}]+"


_HANGUL = (0xAC00, 0xD7A3)
# Leading consonants, vowels and trailing consonants of Hangul syllables, as the standard numbers them
_LEADS, _VOWELS, _TAILS = (
    "".join(map(chr, range(first, first + count)))
    for first, count in ((0x1100, 19), (0x1161, 21), (0x11A8, 27))
)


def _bare(char: str, form: str, keep: str) -> str:
    """A character decomposed, without the combining marks not in ``keep``."""
    parts = unicodedata.normalize(form, char)
    bare = "".join(p for p in parts if p in keep or not unicodedata.combining(p))
    # with marks kept the text is composed again in the end
    return unicodedata.normalize("NFC", bare) if keep else bare


@lru_cache(maxsize=None)
def _folding(form: str, keep: str) -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """``translate`` arguments for characters that fold to one, and pairs for those that
    fold to several. Hangul syllables, which decompose by a rule, are in neither."""
    source, target, several = [], [], []
    for point in range(0x80, 0x110000):
        if 0xD800 <= point <= 0xDFFF or _HANGUL[0] <= point <= _HANGUL[1]:
            continue
        char = chr(point)
        folded = _bare(char, form, keep)
        if folded == char or unicodedata.combining(char):
            continue
        if len(folded) == 1:
            source.append(char)
            target.append(folded)
        elif folded:
            several.append((char, folded))
    return "".join(source), "".join(target), tuple(several)


def _ranges(points: Sequence[int]) -> str:
    """Inside of a character class of sorted code points."""
    ranges, start = [], points[0]
    for point, following in zip(points, [*points[1:], None]):
        if following != point + 1:
            ranges.append(f"\\x{{{start:x}}}-\\x{{{point:x}}}")
            start = following
    return "".join(ranges)


@lru_cache(maxsize=None)
def _mark_pattern(keep: str) -> str:
    """A character class of all combining marks but those in ``keep``, also of marks
    the engine does not know yet."""
    points = [
        p for p in range(0x300, 0x20000) if chr(p) not in keep and not _bare(chr(p), "NFD", keep)
    ]
    return f"[[\\p{{M}}\\p{{Cn}}]&&[{_ranges(points)}]]"


def _each_character(text: Column, change: Callable[[Column], Column]) -> Column:
    return F.array_join(F.transform(F.split(text, ""), change), "")


def _decompose_hangul(text: Column) -> Column:
    """Syllables as their letters: their number is (lead * 21 + vowel) * 28 + tail."""

    def letters(char: Column) -> Column:
        number = F.ascii(char) - _HANGUL[0]

        def pick(alphabet: str, place: Column) -> Column:
            return F.substring(F.lit(alphabet), place.cast("int"), F.lit(1))

        tail = number % 28
        syllable = F.concat(
            pick(_LEADS, F.floor(number / 588) + 1),
            pick(_VOWELS, F.floor(number % 588 / 28) + 1),
            F.when(tail > 0, pick(_TAILS, tail)).otherwise(""),
        )
        return F.when(number.between(0, _HANGUL[1] - _HANGUL[0]), syllable).otherwise(char)

    has_any = text.rlike(f"[\\x{{{_HANGUL[0]:x}}}-\\x{{{_HANGUL[1]:x}}}]")
    return F.when(has_any, _each_character(text, letters)).otherwise(text)


def _replace_several(text: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Characters that fold to several; looked up where a text has one of them."""
    entries = F.create_map(*[F.lit(x) for pair in pairs for x in pair])
    has_any = text.rlike(f"[{_ranges([ord(char) for char, _ in pairs])}]")
    folded = _each_character(text, lambda c: F.coalesce(F.try_element_at(entries, c), c))
    return F.when(has_any, folded).otherwise(text)


@lru_cache(maxsize=None)
def _tilde_pairs() -> tuple[tuple[str, str], ...]:
    """Upper-case letter + combining tilde, and the composed letter."""
    letters = (chr(p) for p in range(0x41, 0x250) if chr(p).isupper())
    pairs = ((c + TILDE, unicodedata.normalize("NFC", c + TILDE)) for c in letters)
    return tuple((pair, composed) for pair, composed in pairs if len(composed) == 1)


def _strip_marks(text: Column, form: str, keep: str) -> Column:
    source, target, several = _folding(form, keep)
    folded = F.translate(text, source, target)
    if not keep:
        folded = _decompose_hangul(folded)
    if several:
        folded = _replace_several(folded, several)
    folded = F.regexp_replace(folded, _mark_pattern(keep), "")
    is_ascii = F.octet_length(text) == F.length(text)
    return F.when(is_ascii, text).otherwise(folded)


def collapse_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, _WHITESPACE, " "))


def strip(text: Column) -> Column:
    """Trim white space of any kind from both ends."""
    return F.btrim(text, F.lit(_blanks()))


@lru_cache(maxsize=None)
def _blanks() -> str:
    return "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def normalize_text(text: Column) -> Column:
    """Upper case, no combining marks, single spaces."""
    return collapse_spaces(_strip_marks(F.upper(text), "NFD", ""))


def normalize_person_name(text: Column) -> Column:
    """As :func:`normalize_text`, but a tilde stays on its letter (``Ñ``)."""
    folded = _strip_marks(F.upper(text), "NFD", TILDE)
    composed = folded
    for pair, letter in _tilde_pairs():
        composed = F.replace(composed, F.lit(pair), F.lit(letter))
    return collapse_spaces(F.when(F.contains(folded, F.lit(TILDE)), composed).otherwise(folded))


def normalize_map_name(text: Column) -> Column:
    """Names of a geography: trimmed, compatibility forms folded, inner spaces kept."""
    return _strip_marks(strip(F.upper(text)), "NFKD", "")


def lookup(value: Column, catalog: Mapping[str, str], default: str) -> Column:
    """Map a free text to a closed catalog by its normalised form.

    Anything unknown, and null, becomes ``default``. Meant for catalogs of up
    to a few hundred entries; see ``operators.scaling.catalog_join`` for more.
    """
    # A value that is a key as it stands needs no normalising
    cleaned = _literal_map(normalize_text(value), catalog, F.lit(default))
    return _literal_map(value, catalog, cleaned)


def alias(value: Column, names: Mapping[str, str]) -> Column:
    """Rename the listed values and keep all others."""
    return _literal_map(value, names, value)


def _literal_map(key: Column, mapping: Mapping[str, str], otherwise: Column) -> Column:
    entries = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(entries, key), otherwise)


def insurance_group(
    value: Column, catalog: Mapping[str, str], null_value: str, other: str
) -> Column:
    """Catalog lookup where a missing value and an unknown one differ."""
    return F.when(value.isNull(), F.lit(null_value)).otherwise(lookup(value, catalog, other))


def default_if_empty(value: Column, default: str) -> Column:
    """Null and the empty string become ``default``."""
    return F.when(F.length(value) > 0, value).otherwise(F.lit(default))


def keep_only(value: Column, allowed: Iterable[str], default: str) -> Column:
    """A value outside the whitelist, or null, becomes ``default``."""
    return F.when(value.isin(*allowed), value).otherwise(F.lit(default))


def fill_null(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    return df.na.fill(dict(defaults))


def regex_cascade(
    df: DataFrame, column: str, calls: Sequence[tuple[Sequence[str], str]]
) -> DataFrame:
    """Apply replacement calls in order; each call is (patterns, value).

    Within a call a pattern fires where it matches the text the call started
    with, and replaces only the matched part of the current text. A pattern that
    refers to both is its own projection: nested, the text so far would be
    repeated per pattern and the expression grow exponentially.
    """
    text = F.col(column)
    for patterns, value in calls:
        replacement = value.replace("\\", "\\\\").replace("$", "\\$")
        first, *others = patterns
        start = df.withColumn("_before", text) if others else df
        df = start.withColumn(column, F.regexp_replace(text, first, replacement))
        for pattern in others:
            replaced = F.regexp_replace(text, pattern, replacement)
            fires = F.col("_before").rlike(pattern)
            df = df.withColumn(column, F.when(fires, replaced).otherwise(text))
        df = df.drop("_before")
    return df


def starts_with_word(text: Column, word: str) -> Column:
    """The trimmed, upper-cased cell is ``word`` or continues it with a non-alphanumeric."""
    # most cells do not hold the word at all, and need neither trimming nor matching
    holds = F.contains(F.upper(text), F.lit(word.upper()))
    begins = F.upper(strip(text)).rlike(f"^{_quote(word.upper())}(?![\\p{{L}}\\p{{N}}])")
    return F.when(holds, begins).otherwise(holds)


def _quote(literal: str) -> str:
    return re.sub(r"([\\.\[\]{}()*+?^$|])", r"\\\1", literal)
