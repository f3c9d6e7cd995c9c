"""Scalar functions on fixed vectors, one Spark job per group."""

import hashlib
import random
import unicodedata
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from caseloom import settings
from caseloom.errors import IntegrityError
from caseloom.functions import dates, demography, identity, measures, text


def column(spark, values, function, schema="v string"):
    df = spark.createDataFrame([(v,) if not isinstance(v, tuple) else v for v in values], schema)
    df = df.repartition(1)
    columns = [F.col(c) for c in df.columns]
    return [r[0] for r in df.select(function(*columns).alias("o")).collect()]


def python_normalize(value, keep=""):
    bare = "".join(
        c
        for c in unicodedata.normalize("NFD", value.upper())
        if c in keep or not unicodedata.combining(c)
    )
    if keep:
        bare = unicodedata.normalize("NFC", bare)
    return " ".join(bare.split())


def texts():
    rng = random.Random(5)
    letters = [chr(p) for p in (*range(0x20, 0x180), *range(0x1E00, 0x1F00), *range(0x370, 0x460))]
    marks = ["́", "̃", "̈", "̣", " ", " ", "\t", "\n"]
    made = ["".join(rng.choice(letters + marks * 20) for _ in range(40)) for _ in range(200)]
    return [*made, "Muñoz", "MUÑOZ", "  peña   niño ", "ÑÃÕ", "straße", "が", "", "й"]


def test_normalize_text_equals_the_definition(spark):
    cases = texts()
    assert column(spark, cases, text.normalize_text) == [python_normalize(c) for c in cases]


def test_every_code_point_is_normalised_as_the_standard_decomposes_it(spark):
    points = [p for p in range(0x20, 0x110000) if unicodedata.category(chr(p)) not in ("Cn", "Cs", "Co")]
    # a letter on both sides, so that marks stand on something and nothing is trimmed
    df = spark.createDataFrame([(p, f"a{chr(p)}b") for p in points], "p int, v string")
    got = df.select("p", F.upper("v").alias("u"), text.normalize_text(F.col("v")).alias("n")).collect()

    def decomposed(u):
        bare = unicodedata.normalize("NFD", u)
        return " ".join("".join(c for c in bare if not unicodedata.combining(c)).split())

    # the engine's capitals are taken as they are: its tables are of another year
    wrong = [hex(r.p) for r in got if r.n != decomposed(r.u)]
    assert wrong == []


def test_normalize_person_name_keeps_tildes(spark):
    cases = texts()
    expected = [python_normalize(c, "̃") for c in cases]
    assert column(spark, cases, text.normalize_person_name) == expected


def test_normalize_map_name(spark):
    assert column(spark, [" Nezahualcóyotl ", "México", "D.F."], text.normalize_map_name) == [
        "NEZAHUALCOYOTL",
        "MEXICO",
        "D.F.",
    ]


def test_pseudonym(spark):
    def digest(content):
        return hashlib.sha256(content.encode()).hexdigest()

    got = column(
        spark,
        [("Juan  Pérez", "123"), ("Muñoz", None), (None, None)],
        lambda n, f: identity.pseudonymize(n, f, "salt"),
        "n string, f string",
    )
    assert got == [digest("JUAN PEREZ123salt"), digest("MUÑOZsalt"), digest("salt")]


def test_coerce_text(spark):
    got = column(
        spark,
        [("1.0", "number"), ("1.5", "number"), ("1.0", "text"), (None, None), ("7", "number")],
        identity.coerce_text,
        "v string, k string",
    )
    assert got == ["1", "1.5", "1.0", None, "7"]


def test_identifying_columns_are_refused(spark):
    df = spark.createDataFrame([("a", 1)], "nombre string, n int")
    assert identity.project_without_pii(df, ["n"], ["nombre"]).columns == ["n"]
    with pytest.raises(IntegrityError):
        identity.project_without_pii(df, ["nombre"], ["NOMBRE"])
    with pytest.raises(IntegrityError):
        identity.assert_no_columns(df, ["nombre"])


def test_catalogs(spark):
    def municipality(v):
        return text.lookup(v, settings.MUNICIPALITY_CATALOG, "OTROS")

    assert column(
        spark, ["GAM", "gustavo a. madero", " Coyoacán", "Atlantis", None], municipality
    ) == ["GUSTAVO A. MADERO", "GUSTAVO A. MADERO", "COYOACAN", "OTROS", "OTROS"]

    results = settings.synonym_catalog(settings.RESULT_SYNONYMS)
    assert column(
        spark,
        ["NO SE TOMÓ", "RECHAZO", "+", "sars-cov-2", "-", "POSITIVA", None],
        lambda v: text.lookup(v, results, "NO_ESPECIFICADO"),
    ) == [
        "PENDIENTE",
        "NO_CONCLUYENTE",
        "POSITIVO",
        "POSITIVO",
        "NEGATIVO",
        "NO_ESPECIFICADO",
        "NO_ESPECIFICADO",
    ]
    status = settings.synonym_catalog(settings.STATUS_SYNONYMS)
    assert column(
        spark, ["ALTA", "UCI", "Defunción", "x"], lambda v: text.lookup(v, status, "?")
    ) == ["AMBULATORIO", "HOSPITALIZADO", "DEFUNCION", "?"]
    assert column(
        spark,
        ["imss", "NINGUNO", "SEDENA", "Privada", None],
        lambda v: text.insurance_group(v, settings.INSURANCE_CATALOG, "NINGUNA", "OTRA"),
    ) == ["IMSS", "NINGUNA", "OTRA", "PRIVADO", "NINGUNA"]
    assert column(spark, ["ECATEPEC", "TOLUCA"], lambda v: text.alias(v, settings.MAP_ALIASES)) == [
        "ECATEPEC DE MORELOS",
        "TOLUCA",
    ]


def test_defaults_and_whitelist(spark):
    assert column(spark, ["", None, "x"], lambda v: text.default_if_empty(v, "d")) == [
        "d",
        "d",
        "x",
    ]
    assert column(spark, ["a", None, "z"], lambda v: text.keep_only(v, ["a"], "d")) == [
        "a",
        "d",
        "d",
    ]
    df = spark.createDataFrame([(None, "k")], "a string, b string")
    assert text.fill_null(df, {"a": "q"}).first() == ("q", "k")


def test_cascade_fires_on_the_text_the_call_started_with(spark):
    df = spark.createDataFrame([("ABC",), ("ABMX",), ("MEXICO",)], "v string")
    got = [r[0] for r in text.regex_cascade(df, "v", [(("B", "Y"), "YY")]).collect()]
    assert got == ["AYYC", "AYYMX", "MEXICO"]
    got = [r[0] for r in text.regex_cascade(df, "v", settings.RESULT_CASCADE).collect()]
    assert got == ["ABC", "ABSOSPECHOSO", "SOSPECHOSO"]
    chained = text.regex_cascade(df, "v", settings.RESIDENCE_CASCADE * 2)
    assert len(chained.collect()) == 3


WHOLE_TEXTS = {
    "18-03-20": (2020, 3, 18),
    "18.03.20": (2020, 3, 18),
    "2020.03.18": (2020, 3, 18),
    "18 03 2020": (2020, 3, 18),
    "20200318": (2020, 3, 18),
    "18 mar 2020": (2020, 3, 18),
    "18-MAR-2020": (2020, 3, 18),
    "March 18, 2020": (2020, 3, 18),
    "18 de marzo de 2020": (2020, 3, 18),
    "2020-03": (2020, 3, 1),
    "18 foo 2020": None,
    "31-02-2020": None,
    "2020": None,
    "ayer": None,
}


def test_whole_texts_are_read_as_dates(spark):
    df = spark.createDataFrame([(t, "text") for t in WHOLE_TEXTS], "v string, kind string")
    got = dates.parse_dates(df, {"d": F.struct("v", "kind")}).collect()
    assert {r.v: r.d and (r.d.year, r.d.month, r.d.day) for r in got} == WHOLE_TEXTS


CLOCK_TEXTS = {
    "18 Mar 2020 10:30": (2020, 3, 18, 10, 30, 0),
    "18.03.2020 10:30:15": (2020, 3, 18, 10, 30, 15),
    "Wednesday, March 18, 2020 at 9:05 PM": (2020, 3, 18, 21, 5, 0),
    "miércoles 18 de marzo de 2020 a las 7 p. m.": (2020, 3, 18, 19, 0, 0),
    "Wed 18 Mar 2020": (2020, 3, 18, 0, 0, 0),
    "sábado, 21-03-2020": (2020, 3, 21, 0, 0, 0),
    "12:00 a.m. 18.03.2020": (2020, 3, 18, 0, 0, 0),
    "18-03-2020 12:15 pm": (2020, 3, 18, 12, 15, 0),
    "20200318 08:00": (2020, 3, 18, 8, 0, 0),
    "March 18th, 2020 23:59:59.5": (2020, 3, 18, 23, 59, 59),
    "the 18th of March 2020": (2020, 3, 18, 0, 0, 0),
    "18 marzo 2020 14:30 hrs": (2020, 3, 18, 14, 30, 0),
    "2020.03.18 14 h": (2020, 3, 18, 14, 0, 0),
    "18 Mar 2020 25:00": None,
    "18 Mar 2020 13:00 pm": None,
    "18 Mar 2020 10:75": None,
    "18 Mar 2020 turno B": None,
    "10:30": None,
    "Wednesday": None,
}


def test_clocks_and_weekdays_of_whole_texts(spark):
    df = spark.createDataFrame([(t, "text") for t in CLOCK_TEXTS], "v string, kind string")
    got = dates.parse_dates(df, {"d": F.struct("v", "kind")}).collect()
    read = {r.v: r.d and (r.d.year, r.d.month, r.d.day, r.d.hour, r.d.minute, r.d.second) for r in got}
    assert read == CLOCK_TEXTS


DATE_VECTORS = [
    ("43914", "number", datetime(2020, 3, 24), False),
    ("43914.5", "number", datetime(2020, 3, 24, 12), False),
    ("24/03/2020   turno B", "text", datetime(2020, 3, 24), False),
    ("18/03/2020 10:30", "text", datetime(2020, 3, 18), False),
    ("PENDIENTE", "text", None, False),
    (None, None, None, False),
    ("true", "bool", None, False),
    ("0202-05-15", "text", datetime(2020, 5, 15), False),
    ("2920-05-15", "text", datetime(2020, 5, 15), False),
    ("0208-05-15", "text", None, True),
    ("2019-12-31 00:00:00", "datetime", None, True),
    ("2024-01-01 00:00:00", "datetime", None, True),
    ("2020-01-01 00:00:00", "datetime", datetime(2020, 1, 1), False),
    ("2023-12-31 18:30:00", "datetime", datetime(2023, 12, 31, 18, 30), False),
    ("18/09/2022", "text", datetime(2020, 9, 18), False),
    ("2022-10-05 00:00:00", "datetime", datetime(2020, 10, 5), False),
    ("15/01/2022", "text", datetime(2022, 1, 15), False),
    ("30.03.2020", "text", datetime(2020, 3, 30), False),
    ("10-04-2020", "text", datetime(2020, 4, 10), False),
    ("03/24/2020", "text", datetime(2020, 3, 24), False),
    ("5/6/21", "text", datetime(2021, 6, 5), False),
    ("31/02/2021", "text", None, False),
    ("2020-03-09", "text", datetime(2020, 3, 9), False),
    ("99999999", "number", None, False),
    ("3000000", "number", None, False),
]


def read_dates(spark, cells, policy=settings.DEFAULT_DATES):
    df = spark.createDataFrame(cells, "v string, kind string").repartition(1)
    read = dates.read_dates(df, {"d": F.struct("v", "kind")}, policy)
    assert read.columns == ["v", "kind", "d"]
    return [tuple(r.d) for r in read.collect()]


def test_dates(spark):
    got = read_dates(spark, [(v, k) for v, k, _, _ in DATE_VECTORS])
    for (value, kind, expected, anomaly), date_read in zip(DATE_VECTORS, got):
        assert date_read == (expected, anomaly), (value, kind)


def test_iso_dayfirst_switch(spark):
    policy = settings.DatePolicy(iso_dayfirst=True)
    got = read_dates(spark, [("2020-03-09", "text"), ("2020-03-24", "text")], policy)
    assert [d for d, _ in got] == [datetime(2020, 9, 3), datetime(2020, 3, 24)]


def test_result_swap(spark):
    rows = [
        ("24/03/2020", "NEGATIVO", "text"),
        ("POSITIVO", "24/03/2020", "text"),
        ("24/03/2020", "25/03/2020", "text"),
        ("24/03/2020", "2020-03-25 00:00:00", "datetime"),
        ("24/03/2020", "24/03/1999", "text"),
        (None, "NEGATIVO", "text"),
        ("24/03/2020", None, None),
    ]
    df = spark.createDataFrame(rows, "r string, v string, kind string").repartition(1)
    marked = dates.mark_swapped(df, "r", F.struct("v", "kind"), "swapped")
    assert marked.columns == [*df.columns, "swapped"]
    got = [r.swapped for r in marked.collect()]
    assert got == [True, False, False, False, True, False, False]


def test_older_swap(spark):
    df = spark.createDataFrame([("12/01/2021", "POSITIVO"), ("NEG", "x")], "a string, b string")
    left, right = dates.swap_if(dates.lacks_capitals(F.col("a")), F.col("a"), F.col("b"))
    assert [tuple(r) for r in df.select(left, right).collect()] == [
        ("POSITIVO", "12/01/2021"),
        ("NEG", "x"),
    ]
    kinds = column(spark, ["text", "datetime", None], lambda k: dates.lacks_capitals(F.lit("A"), k))
    assert kinds == [False, True, True]


def test_age_and_sex(spark):
    vectors = {
        ("RN", "M"): (0, "M"),
        ("3M", "F"): (0, "F"),
        ("3 D", "F"): (0, "F"),
        ("3 MESES", "F"): (3, "F"),
        ("años: 4", "M"): (4, "M"),
        (None, None): (-1, "INDETERMINADO"),
        ("F", "34"): (34, "F"),
        ("M", "RN"): (0, "M"),
        ("50", "X"): (50, "OTRO"),
        ("F", "M"): (-1, "M"),
        (" 34.0", " f "): (34, "F"),
        ("x", ""): (-1, "INDETERMINADO"),
    }
    df = spark.createDataFrame(list(vectors), "a string, s string").repartition(1)
    got = demography.read_age_sex(df, "a", "s").select("edad", "sexo").collect()
    assert [tuple(r) for r in got] == list(vectors.values())
    ages = ["RN", "3 MESES", "años: 4", None]
    assert column(spark, ages, demography.parse_age) == [0.0, 3.0, 4.0, None]
    assert column(spark, [" f", "Z"], demography.parse_sex) == ["F", "OTRO"]


def test_age_by_sex_columns(spark):
    got = column(
        spark,
        [("30", None), (None, "40"), (None, None), ("1", "2")],
        demography.age_by_sex_columns,
        "f string, m string",
    )
    assert [tuple(r) for r in got] == [("30", "F"), ("40", "M"), (None, None), ("1", "F")]


def test_bins(spark):
    ages = [(x,) for x in (0.0, 1.0, 2.0, 11.0, 40.0, 60.0, 65.0, 66.0, -1.0, None, float("nan"), 17.5)]

    def labels(bins):
        return column(spark, ages, lambda v: demography.bin_column(v, bins), "v double")

    assert labels(settings.AGE_BINS) == [
        "0-1", "0-1", "2-11", "2-11", "36-40", "56-60", "61-65", "66+",
        "SIN_DATO", "SIN_DATO", "SIN_DATO", "18-24",
    ]
    assert labels(settings.DISPLAY_AGE_BINS) == [
        "<18", "<18", "<18", "<18", "40-59", "60+", "60+", "60+",
        "SIN_DATO", "SIN_DATO", "SIN_DATO", "<18",
    ]
    assert labels(settings.LEGACY_AGE_BINS)[3:7] == ["2-11", "40-49", "60-69", "60-69"]


def test_label_pairs_are_those_a_number_can_have():
    pairs = demography.intersecting_labels(settings.AGE_BINS, settings.DISPLAY_AGE_BINS)
    assert ("18-24", "<18") in pairs and ("36-40", "18-39") in pairs and ("36-40", "40-59") in pairs
    assert ("0-1", "60+") not in pairs and ("12-17", "18-39") not in pairs
    assert ("SIN_DATO", "SIN_DATO") in pairs and len(pairs) == 17


def test_rate_and_pyramid(spark):
    assert column(
        spark, [(30, 100), (1, 0), (0, 5)], measures.safe_rate, "a long, b long"
    ) == [0.3, 0.0, 0.0]
    assert column(
        spark, [(3, "M"), (4, "F")], demography.pyramid_side, "n long, s string"
    ) == [-3, 4]


def test_elapsed_days_floor_before_the_absolute_value(spark):
    rows = [
        (datetime(2021, 1, 2, 0), datetime(2021, 1, 1, 22)),
        (datetime(2021, 1, 1, 22), datetime(2021, 1, 2, 0)),
        (datetime(2021, 1, 8), datetime(2021, 1, 1)),
    ]
    got = column(spark, rows, dates.elapsed_days, "a timestamp_ntz, b timestamp_ntz")
    assert got == [1, 0, 7]


def test_days_do_not_depend_on_the_session_time_zone(spark):
    # the clock goes forward an hour in between
    rows = [
        (datetime(2021, 3, 10, 0, 30), datetime(2021, 3, 17, 0, 30, 0, 5)),
        (datetime(2021, 3, 17, 0, 30), datetime(2021, 3, 10, 0, 30)),
        (datetime(2021, 3, 14, 2, 30), datetime(2021, 3, 15, 2, 29, 59, 999999)),
    ]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = column(spark, rows, dates.elapsed_days, "a timestamp_ntz, b timestamp_ntz")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [7, 7, 0]


def test_window_is_a_parameter(spark):
    policy = settings.DatePolicy(first_day=date(1995, 1, 1), last_day=date(2001, 12, 31))
    got = read_dates(spark, [("1999-05-01", "text"), ("2020-05-01", "text")], policy)
    assert got == [(datetime(1999, 5, 1), False), (None, True)]
