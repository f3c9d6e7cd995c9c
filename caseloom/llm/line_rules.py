"""Quality rules, line first: lines are judged one by one, documents by what is left.

Every line is tested for punctuation, navigation and boilerplate; failing lines
are removed, and a document that loses too much of its text that way is
rejected. Whole-text counts give a first, coarser verdict. Built-in functions
only: a row is judged where it was read, nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters that separate words, and those counted as symbols.
SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"

# How sentences of running text end in the scripts that mark it, closing marks
# included. Thai and Lao have no such mark: their letters are enough.
SENTENCE_END = (
    r"[.!?:;\x{2026}\x{3002}\x{FF01}\x{FF0E}\x{FF1F}\x{FF61}\x{0589}\x{061B}\x{061F}\x{06D4}\x{0964}\x{0965}"
    r"\x{0F0D}\x{104A}\x{104B}\x{1362}\x{1367}\x{17D4}\x{17D5}]"
    r"[\"'\x{201D}\x{2019}\x{00BB}\x{300D}\x{300F})\]]*([\x20\x09-\x0D]|\z)|[\x{0E01}-\x{0EDF}]"
)

# Signs between the entries of a menu or table.
MENU_MARKS = ("|", "»", "›", "•", "·", ">")

# Phrases of page furniture, navigation first; whole words only.
PHRASES = (
    "skip to content",
    "skip to main content",
    "skip to navigation",
    "read more",
    "click here",
    "next page",
    "previous page",
    "sign in",
    "log in",
    "sign up",
    "enable javascript",
    "javascript is disabled",
    "lorem ipsum",
    "dolor sit amet",
    "use cookies",
    "uses cookies",
    "accept cookies",
    "cookie policy",
    "privacy policy",
    "terms of use",
    "terms of service",
    "all rights reserved",
    "subscribe to our",
    "subscribe now",
)
# A phrase and the signs beside it, which are no letters or digits
PHRASE = rf"(^|[^\p{{L}}\p{{N}}])(?:{'|'.join(PHRASES)})($|[^\p{{L}}\p{{N}}])"


@dataclass(frozen=True)
class LineRules:
    """Thresholds; shares are whole percents, so both engines compare integers."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_symbol_percent: int = 20
    max_upper_percent: int = 60
    min_upper_letters: int = 12
    min_distinct_percent: int = 25
    distinct_from_words: int = 12
    menu_marks: int = 3
    max_lost_percent: int = 40
    max_phrase_percent: int = 20


def words_of(text: Column) -> Column:
    """Words in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def count_of(text: Column, chars: str) -> Column:
    """How many characters of the class ``chars`` a text has."""
    return F.length(text) - F.length(F.regexp_replace(text, chars + "+", ""))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often lambdas read it."""
    return F.transform(F.array(value), use)[0]


def has_phrase(text: Column) -> Column:
    lowered = F.lower(text)
    return reduce(or_, [lowered.contains(p) for p in PHRASES])


def phrase_fails(line: Column, rules: LineRules) -> Column:
    """Whether phrases of page furniture make up much of a line.

    One that stands in a longer word counts for nothing, one in a long line for little:
    running text may speak of such things."""
    lowered = F.lower(line)
    rest = F.regexp_replace(lowered, PHRASE, "$1$2")
    return 100 * (F.length(lowered) - F.length(rest)) > rules.max_phrase_percent * F.length(lowered)


def repeated_words(words: Column, size: int = 3) -> Column:
    """How many words lie in a window of ``size`` words that occurs twice or more.

    Distinct hashes of all windows settle many texts. Else short keys of hash and
    place are sorted, so that windows with equal keys are neighbours; only those
    are then compared as text, and the places of equal ones merged into covered
    words: n log n, never n squared.
    """
    place_bits = 30

    def window(i: Column, join: Callable[..., Column]) -> Column:
        return join(*[words[i + k] for k in range(size)])

    def twice(rows: Column, key: Callable[[Column], Column], value: Callable[[Column], Column]) -> Column:
        """Values of the sorted rows whose neighbour has the same key."""
        return F.transform(
            F.filter(
                rows,
                lambda x, k: F.coalesce(key(F.get(rows, k + 1)) == key(x), F.lit(False))
                | ((k > 0) & F.coalesce(key(F.get(rows, k - 1)) == key(x), F.lit(False))),
            ),
            value,
        )

    def covered(hashes: Column) -> Column:
        keys = F.sort_array(
            F.transform(
                hashes, lambda h, i: F.shiftleft(h, place_bits).bitwiseOR(i.cast("bigint"))
            )
        )
        likely = bound(
            keys,
            lambda r: twice(
                r,
                lambda x: F.shiftright(x, place_bits),
                lambda x: x.bitwiseAND(F.lit((1 << place_bits) - 1)).cast("int"),
            ),
        )
        texts = F.sort_array(
            F.transform(
                likely,
                lambda i: F.struct(
                    window(i, lambda *w: F.concat_ws(" ", *w)).alias("w"), i.alias("i")
                ),
            )
        )
        places = bound(texts, lambda r: twice(r, lambda x: x["w"], lambda x: x["i"]))
        return F.aggregate(
            F.sort_array(places),
            F.struct(F.lit(-size).alias("last"), F.lit(0).cast("bigint").alias("n")),
            lambda a, i: F.struct(
                i.alias("last"), (a["n"] + F.least(F.lit(size), i - a["last"])).alias("n")
            ),
            lambda a: a["n"],
        )

    none = F.lit(0).cast("bigint")
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - size), lambda i: window(i, F.xxhash64)
    )
    return F.when(F.size(words) < size, none).otherwise(
        bound(
            hashes,
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(covered(h)),
        )
    )


def line_fails(line: Column, words: Column, rules: LineRules) -> Column:
    """Whether a line with words is not running text: it has no end of a sentence, or
    looks like a menu, a table, shouting, decoration or one phrase over and over."""
    n = F.size(words)
    letters = F.length(F.regexp_replace(line, r"\P{L}+", ""))
    upper = F.length(F.regexp_replace(line, r"\P{Lu}+", ""))
    marks = F.size(F.filter(words, lambda w: w.isin(*MENU_MARKS)))
    return (
        ~F.regexp_like(line, F.lit(SENTENCE_END))
        | (
            F.regexp_like(line, F.lit(f"{SYMBOLS}|[{''.join(MENU_MARKS)}]"))
            & (
                (marks >= rules.menu_marks)
                | (100 * count_of(line, SYMBOLS) > rules.max_symbol_percent * n)
            )
        )
        # two capitals in a row, other signs aside, is what any mostly upper-case line has
        | (
            F.regexp_like(line, F.lit(r"\p{Lu}\P{L}*\p{Lu}"))
            & (letters >= rules.min_upper_letters)
            & (100 * upper > rules.max_upper_percent * letters)
        )
        | (
            (n >= rules.distinct_from_words)
            & (100 * F.size(F.array_distinct(words)) < rules.min_distinct_percent * n)
        )
    )


def line_first(
    df: DataFrame,
    text: str = "text",
    rules: LineRules = LineRules(),
    output: str = "line_rules",
    with_text: bool = True,
) -> DataFrame:
    """All columns of ``df`` and the struct ``output`` with counts, text left and verdict.

    Fields: ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``n_lines`` (with a word),
    ``n_failed_lines``, ``line_chars`` and ``left_chars`` (code points of lines with
    a word, before and after), ``kept`` and, ``with_text``, ``cleaned``: the remaining
    lines in order, blank ones included.

    Null and empty texts have no words and fail. A text of one line of any length is
    one line. Rows are judged one by one, so ties and repeated rows get equal
    results, an empty table gives an empty one, and a column already named
    ``output`` is replaced; no other name is touched.
    """
    whole = F.coalesce(F.col(text), F.lit(""))

    def of_lines(lines: Column, words: Column) -> Column:
        full = F.filter(lines, lambda x: x["n"] > 0)

        def chars(rows: Column) -> Column:
            return F.aggregate(rows, F.lit(0).cast("bigint"), lambda a, x: a + F.length(x["line"]))

        n = F.size(words).cast("bigint")

        left = F.array_join(
            F.transform(F.filter(lines, lambda x: ~x["fails"]), lambda x: x["line"]), "\n"
        )

        def verdict(figures: Column) -> Column:
            repeated, before, after = (figures[c] for c in ("repeated", "before", "after"))
            failed = (n < rules.min_words) | (100 * repeated > rules.max_repeat_percent * n)
            return F.struct(
                n.alias("n_words"),
                F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
                count_of(whole, SYMBOLS).cast("bigint").alias("n_symbols"),
                figures["dup"].cast("bigint").alias("n_dup_lines"),
                repeated.alias("n_repeat_words"),
                failed.alias("base_failed"),
                figures["lines"].cast("bigint").alias("n_lines"),
                figures["fails"].cast("bigint").alias("n_failed_lines"),
                before.alias("line_chars"),
                after.alias("left_chars"),
                *([left.alias("cleaned")] if with_text else []),
                (~failed & (100 * (before - after) <= rules.max_lost_percent * before)).alias("kept"),
            )

        return bound(
            full,
            lambda f: bound(
                F.struct(
                    repeated_words(words).alias("repeated"),
                    chars(f).alias("before"),
                    chars(F.filter(f, lambda x: ~x["fails"])).alias("after"),
                    F.size(f).alias("lines"),
                    F.size(F.filter(f, lambda x: x["fails"])).alias("fails"),
                    (F.size(f) - F.size(F.array_distinct(f["line"]))).alias("dup"),
                ),
                verdict,
            ),
        )

    def judged(lines: Column, suspect: Column) -> Column:
        return F.transform(
            lines,
            lambda x: F.struct(
                x["line"].alias("line"),
                F.size(x["words"]).alias("n"),
                (
                    (F.size(x["words"]) > 0)
                    & ((suspect & phrase_fails(x["line"], rules)) | line_fails(x["line"], x["words"], rules))
                ).alias("fails"),
            ),
        )

    lines = F.transform(
        F.split(whole, "\n"), lambda x: F.struct(x.alias("line"), words_of(x).alias("words"))
    )
    # the phrases are sought in the whole text first: most texts have none
    return df.withColumn(
        output,
        bound(
            F.struct(lines.alias("lines"), has_phrase(whole).alias("suspect")),
            lambda t: bound(
                F.flatten(t["lines"]["words"]),
                lambda w: bound(judged(t["lines"], t["suspect"]), lambda x: of_lines(x, w)),
            ),
        ),
    )


COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "base_failed",
    "n_lines",
    "n_failed_lines",
    "line_chars",
    "left_chars",
    "kept",
)


def op7_line_rules(spark, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return line_first(docs, with_text=False).select("doc_id", *[f"line_rules.{c}" for c in COUNTS])


def _sql(rules: LineRules = LineRules()) -> str:
    space = r"[\x20\x09-\x0D]"
    words = f"list_filter(string_split_regex({{}}, '{space}+'), lambda x: x <> '')"
    symbols = "(length({0}) - length(translate({0}, '#*$%&|<>', '')))"
    # the list is written out apart from the code under test
    listed = (
        "skip to content|skip to main content|skip to navigation|read more|click here|next page|previous page|sign in"
        "|log in|sign up|enable javascript|javascript is disabled|lorem ipsum|dolor sit amet|use cookies|uses cookies"
        "|accept cookies|cookie policy|privacy policy|terms of use|terms of service|all rights reserved|subscribe to our"
        "|subscribe now"
    )
    rest = rf"regexp_replace(lower(line), '(^|[^\p{{L}}\p{{N}}])(?:{listed})($|[^\p{{L}}\p{{N}}])', '\1\2', 'g')"
    phrases = f"100 * (length(lower(line)) - length({rest})) > {rules.max_phrase_percent} * length(lower(line))"
    marks = ", ".join(f"'{m}'" for m in MENU_MARKS)
    end = SENTENCE_END.replace("'", "''")
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), w AS (SELECT *, {words.format("text")} AS words FROM d),
win AS (
  SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), twice AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, win) AS c FROM win) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) t(k) GROUP BY rid),
l AS (SELECT rid, line, {words.format("line")} AS words
      FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)),
m AS (
  SELECT rid, line, length(line) AS chars, len(words) AS n, words,
    length(regexp_replace(line, '\P{{L}}+', '', 'g')) AS letters,
    length(regexp_replace(line, '\P{{Lu}}+', '', 'g')) AS upper,
    regexp_matches(line, '{end}') AS ended
  FROM l
), f AS (
  SELECT rid, line, chars,
    (NOT ended
     OR len(list_filter(words, lambda x: x IN ({marks}))) >= {rules.menu_marks}
     OR {phrases}
     OR 100 * {symbols.format("line")} > {rules.max_symbol_percent} * n
     OR letters >= {rules.min_upper_letters} AND 100 * upper > {rules.max_upper_percent} * letters
     OR n >= {rules.distinct_from_words}
        AND 100 * len(list_distinct(words)) < {rules.min_distinct_percent} * n) AS fails
  FROM m WHERE n > 0
), g AS (
  SELECT rid, count(*) AS n_lines, count(*) FILTER (fails) AS n_failed_lines, sum(chars)::BIGINT AS line_chars,
    coalesce(sum(chars) FILTER (NOT fails), 0)::BIGINT AS left_chars, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM f GROUP BY rid
), a AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(translate(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::BIGINT AS word_chars,
    {symbols.format("text")}::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0)::BIGINT AS n_lines,
    coalesce(n_failed_lines, 0)::BIGINT AS n_failed_lines, coalesce(line_chars, 0)::BIGINT AS line_chars,
    coalesce(left_chars, 0)::BIGINT AS left_chars
  FROM w LEFT JOIN rep USING (rid) LEFT JOIN g USING (rid)
), b AS (
  SELECT *, (n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words) AS base_failed FROM a
)
SELECT *, (NOT base_failed AND 100 * (line_chars - left_chars) <= {rules.max_lost_percent} * line_chars) AS kept FROM b
"""


QUERIES = {"op7_line_rules": op7_line_rules}
ORACLE = {"op7_line_rules": _sql()}
