"""Dates typed in by hand: parsing, plausibility, and cells in the wrong column.

A dirty cell is a pair of columns: its text and its kind, one of ``datetime``,
``number``, ``text`` or ``bool`` (null when blank).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.text import strip
from caseloom.settings import DEFAULT_DATES, DatePolicy

_SLASH_DATE = r"(\d{1,2}/\d{1,2}/\d{2,4})"
_ISO_DATE = r"(\d{4}-\d{1,2}-\d{1,2})"
# Names of months, English and Spanish, whole or as their first letters
_MONTHS = {
    name: number
    for number, names in enumerate(
        (
            "january jan enero ene",
            "february feb febrero",
            "march mar marzo",
            "april apr abril abr",
            "may mayo",
            "june jun junio",
            "july jul julio",
            "august aug agosto ago",
            "september sept sep septiembre setiembre set",
            "october oct octubre",
            "november nov noviembre",
            "december dec diciembre dic",
        ),
        1,
    )
    for name in names.split()
}
# Names of weekdays, English and Spanish, whole or as their first letters
_WEEKDAYS = (
    "monday tuesday wednesday thursday friday saturday sunday mon tue tues wed thu thur thurs fri sat sun"
    " lunes martes miércoles miercoles jueves viernes sábado sabado domingo lun mié mie jue vie sáb sab dom"
).split()
# A time of day, with its parts, wherever it stands; and words and signs that only join
_CLOCK = (
    r"(?:^|[ ,]|(?<=\d)t)(?=\d{1,2}(?::\d{2}| ?[ap]\.? ?m\b| ?h(?:rs?|oras)?\b))"
    r"(\d{1,2})(?::(\d{2})(?::(\d{2})(?:[.,]\d+)?)?)?"
    r"(?: ?([ap])\.? ?m\b\.?| ?h(?:rs?|oras)?\b\.?)?(?=$|[ ,])"
)
_FILLERS = rf"(?<![a-zñáéíóú])(?:{'|'.join(_WEEKDAYS)}|de|del|el|la|las|los|a|at|on|of|the)(?![a-zñáéíóú])\.?"
# What a whole text can be once clock and fillers are gone: typed tokens with one sign between
_TOKENS = r"^(?:\d{1,2}-\d{1,2}-(?:\d{4}|\d{2})|\d{4}-\d{1,2}(?:-\d{1,2})?|\d{8})$"
_US_PER_DAY = 86_400_000_000
# Spreadsheet day numbers outside this range have no timestamp (years 1 to 9999)
_SERIAL_RANGE = (-693_593, 2_958_465)


def fix_year_typos(text: Column, policy: DatePolicy = DEFAULT_DATES) -> Column:
    for wrong, right in policy.year_typos:
        text = F.replace(text, F.lit(wrong), F.lit(right))
    return text


def _clean(value: Column, kind: Column, policy: DatePolicy) -> Column:
    return F.when(kind == "text", fix_year_typos(strip(value), policy))


def _plain(text: Column) -> Column:
    """A whole text without its clock, weekday and filling words."""
    joined = F.regexp_replace(F.regexp_replace(text, _CLOCK, " "), _FILLERS, " ")
    # 1st, 2nd: the day's ending goes as well
    bare = F.regexp_replace(joined, r"(\d)(?:st|nd|rd|th|o|º|°)(?![a-z])", "$1")
    wordy = text.rlike("[:a-zº°]")
    return strip(F.when(wordy, bare).otherwise(text))


def _tokens(text: Column) -> Column:
    """Its tokens with one dash between them, a month's name as its number, day first."""
    months = F.create_map(*[F.lit(x) for pair in _MONTHS.items() for x in pair])
    word = F.regexp_extract(text, r"^[^a-z]*([a-z]+)[^a-z]*$", 1)
    number = F.try_element_at(months, word).cast("string")
    named = F.when(word != "", F.replace(text, word, F.concat(F.lit("-"), number, F.lit("-")))).otherwise(text)
    dashed = F.regexp_replace(F.btrim(named, F.lit("-., ")), r"[-., ]+", "-")
    # a month in front of the day
    return F.when(
        text.rlike("^[^0-9a-z]*[a-z]"), F.regexp_replace(dashed, r"^(\d+)-(\d+)-(\d{4})$", "$2-$1-$3")
    ).otherwise(dashed)


def _found_inside(slash: Column, iso: Column) -> Column:
    """A date found in a text, rewritten as ``y-m-d``; two-digit years are 20xx."""
    four_digits = F.regexp_replace(slash, r"/(\d\d)$", "/20$1")
    return F.when(
        slash != "", F.regexp_replace(four_digits, r"^(\d+)/(\d+)/(\d+)$", "$3-$2-$1")
    ).when(iso != "", iso)


def _whole_text(tokens: Column) -> Column:
    """A text that is nothing but a date, as ``y-m-d``, else null."""
    part = F.split(tokens, "-")
    first, second, third = (F.get(part, F.lit(i)) for i in range(3))
    dash, length = F.lit("-"), F.length(first)
    year = F.when(F.length(third) == 2, F.concat(F.lit("20"), third)).otherwise(third)
    digits = F.concat_ws(
        "-", F.substring(first, 1, 4), F.substring(first, 5, 2), F.substring(first, 7, 2)
    )
    date = (
        F.when(length == 8, digits)
        .when(length == 4, F.concat(first, dash, second, dash, F.coalesce(third, F.lit("1"))))
        .otherwise(F.concat(year, dash, second, dash, first))
    )
    return F.when(tokens.rlike(_TOKENS), date)


def _clock(text: Column) -> Column:
    """Microseconds of the time of day in a whole text; 0 without one, null if there is none such."""
    found = text.rlike(_CLOCK)
    hour, minute, second = (
        F.coalesce(F.regexp_extract(text, _CLOCK, i).try_cast("int"), F.lit(0)) for i in (1, 2, 3)
    )
    half = F.regexp_extract(text, _CLOCK, 4)
    of_day = (
        F.when(half == "", hour).when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    )
    valid = of_day.between(0, 23) & (minute < 60) & (second < 60)
    micros = ((of_day * 60 + minute) * 60 + second).cast("bigint") * 1_000_000
    return F.when(found, F.when(valid, micros)).otherwise(F.lit(0).cast("bigint"))


def _read_whole(texts: list[Column]) -> Column:
    """``struct(date, clock)`` for each text, null for null ones; a date as ``y-m-d``.

    Every step names its input by a transform, so that it is worked out once.
    """
    some = F.array(*texts)
    plain = F.transform(some, lambda t: F.struct(t.alias("text"), _plain(t).alias("plain")))
    tokens = F.transform(
        plain, lambda p: F.struct(p["text"].alias("text"), _tokens(p["plain"]).alias("tokens"))
    )

    def read(t: Column) -> Column:
        clock = F.when(t["text"].rlike("[:a-z]"), _clock(t["text"])).otherwise(F.lit(0))
        # a time of day that there is not makes the whole text none
        return F.struct(F.when(clock.isNotNull(), _whole_text(t["tokens"])).alias("date"), clock.alias("clock"))

    return F.when(F.coalesce(*texts).isNotNull(), F.transform(tokens, read))


def _read_year_first(date: Column, iso: Column, policy: DatePolicy) -> Column:
    """The date as written, or with day and month exchanged where only that exists."""
    exchanged = F.regexp_replace(date, r"^(\d+)-(\d+)-(\d+)$", "$1-$3-$2")
    as_written, other = (d.try_cast("timestamp_ntz") for d in (date, exchanged))
    if policy.iso_dayfirst:
        # a year-first text with no slash date before it
        return F.when(iso == date, F.coalesce(other, as_written)).otherwise(
            F.coalesce(as_written, other)
        )
    return F.coalesce(as_written, other)


def _parse_serial(number: Column) -> Column:
    days = number.try_cast("double")
    origin = F.lit("1899-12-30").cast("timestamp_ntz")
    micros = F.round(F.when(days.between(*_SERIAL_RANGE), days) * _US_PER_DAY).cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, origin)


def parse_dates(
    df: DataFrame, cells: Mapping[str, Column], policy: DatePolicy = DEFAULT_DATES
) -> DataFrame:
    """Add the timestamp of each ``struct(v, kind)`` cell under its name; null if it
    is no date. Nothing is dropped for being implausible yet.

    A text is searched for ``d/m/y``, else ``y-m-d``, else read as a whole: its clock,
    weekday and filling words are set aside, and what is left has to be one date - day,
    month and year with any signs between, the month as a number or an English or
    Spanish name, in front of the day or behind; year first; eight digits; or year and
    month alone, which is the first of the month. The clock is part of the result of a
    whole text, 12 or 24 hours; after a date found inside a text it is not read. Each
    step is a projection of its own, so that it reads the one before as a column
    instead of repeating it, and few texts get to the last ones.
    """

    def of(name: str, part: str) -> Column:
        return F.col(f"_{name}_{part}")

    def whole(name: str) -> Column:
        """The lower-case text, where it has to be read as a whole and can hold a date."""
        text = of(name, "text")
        absent = (of(name, "slash") == "") & (of(name, "iso") == "")
        return F.when(absent & text.rlike("[0-9]"), F.lower(text))

    def parse(name: str, place: int) -> Column:
        value, kind = cells[name]["v"], cells[name]["kind"]
        read = F.get(F.col("_whole"), F.lit(place))
        date = F.coalesce(_found_inside(of(name, "slash"), of(name, "iso")), read["date"])
        day = _read_year_first(date, of(name, "iso"), policy)
        return (
            F.when(kind == "datetime", value.try_cast("timestamp_ntz"))
            .when(kind == "number", _parse_serial(value))
            .when(read["clock"] != 0, F.timestamp_add("MICROSECOND", read["clock"], day))
            .otherwise(day)
        )

    steps = (
        lambda n, i: {f"_{n}_text": _clean(cells[n]["v"], cells[n]["kind"], policy)},
        lambda n, i: {
            f"_{n}_slash": F.regexp_extract(of(n, "text"), _SLASH_DATE, 1),
            f"_{n}_iso": F.regexp_extract(of(n, "text"), _ISO_DATE, 1),
        },
        # few rows have a text that is read as a whole: all their cells are read in one go,
        # so that the long expressions are there once and not for every cell
        lambda n, i: {"_whole": _read_whole([whole(m) for m in cells])} if i == 0 else {},
        lambda n, i: {f"_{n}_parsed": parse(n, i)},
        lambda n, i: {n: shift_year(of(n, "parsed"), policy)},
    )
    for step in steps:
        df = df.withColumns({k: v for i, n in enumerate(cells) for k, v in step(n, i).items()})
    scratch = [f"_{n}_{part}" for n in cells for part in ("text", "slash", "iso", "parsed")]
    return df.drop("_whole", *scratch)


def is_unreadable(cell: Column, parsed: Column) -> Column:
    """Whether a cell holds something, but no date."""
    return (F.length(strip(cell["v"])) > 0) & parsed.isNull()


def read_dates(
    df: DataFrame, cells: Mapping[str, Column], policy: DatePolicy = DEFAULT_DATES
) -> DataFrame:
    """As :func:`parse_dates`, each date checked: ``struct(value, is_anomaly)``."""
    parsed = parse_dates(df, cells, policy)
    return parsed.withColumns({n: check_date(F.col(n), policy) for n in cells})


def shift_year(parsed: Column, policy: DatePolicy = DEFAULT_DATES) -> Column:
    """Move dates of the year known to be mistyped, after its genuine months."""
    if policy.shifted_year is None:
        return parsed
    mistyped = (F.year(parsed) == policy.shifted_year) & (
        F.month(parsed) > policy.last_genuine_month
    )
    years = F.make_ym_interval(F.lit(policy.shifted_to - policy.shifted_year), F.lit(0))
    return F.when(mistyped, parsed + years).otherwise(parsed)


def within_window(parsed: Column, policy: DatePolicy = DEFAULT_DATES) -> Column:
    return F.to_date(parsed).between(F.lit(policy.first_day), F.lit(policy.last_day))


def check_date(parsed: Column, policy: DatePolicy = DEFAULT_DATES) -> Column:
    """``struct(value, is_anomaly)``: a date outside the window is dropped and flagged."""
    plausible = within_window(parsed, policy)
    return F.struct(
        F.when(plausible, parsed).alias("value"),
        F.coalesce(~plausible, F.lit(False)).alias("is_anomaly"),
    )


def mark_swapped(
    df: DataFrame, result: str, date_cell: Column, output: str, policy: DatePolicy = DEFAULT_DATES
) -> DataFrame:
    """Flag rows whose result is a plausible date while the date cell holds other text."""
    # Few results hold digits; the others are no dates and nothing is parsed
    is_text = (date_cell["kind"] == "text") & F.col(result).rlike("[0-9]")
    names = ("_result_date", "_cell_date")
    cells = {
        name: F.struct(F.when(is_text, v).alias("v"), F.lit("text").alias("kind"))
        for name, v in zip(names, (F.col(result), date_cell["v"]))
    }
    parsed = parse_dates(df, cells, policy)
    in_result, in_cell = [F.coalesce(within_window(F.col(n), policy), F.lit(False)) for n in names]
    return parsed.withColumn(output, in_result & ~in_cell).drop(*names)


def swap_if(condition: Column, left: Column, right: Column) -> tuple[Column, Column]:
    """The two columns, exchanged where ``condition`` holds."""
    return (
        F.when(condition, right).otherwise(left),
        F.when(condition, left).otherwise(right),
    )


def lacks_capitals(value: Column, kind: Column | None = None) -> Column:
    """Older swap test: the cell shows no capital letter, or is not text at all."""
    plain = ~F.coalesce(value.rlike("[A-Z]"), F.lit(False))
    return plain if kind is None else (kind.isNull() | (kind != "text"))


def micros_between(start: Column, end: Column) -> Column:
    """Microseconds from one zoneless timestamp to another, in any session time zone."""
    interval = end - start

    def part(name: str) -> Column:
        return F.extract(F.lit(name), interval)

    minutes = (part("DAY").cast("bigint") * 24 + part("HOUR")) * 60 + part("MINUTE")
    # seconds come with their fraction
    return minutes * 60_000_000 + (part("SECOND") * 1_000_000).cast("bigint")


def elapsed_days(start: Column, end: Column) -> Column:
    """Absolute number of days, where a negative distance is floored first.

    Two hours *before* is therefore one day, two hours *after* none.
    """
    return F.abs(F.floor(micros_between(start, end) / _US_PER_DAY)).cast("int")
