"""The driver's tables seen as registries, cases and landed cells.

Every expression is deterministic, so the same data can be written down in SQL
(``oracle.py``). A proxy reads only the tables and columns its caller asks for.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from caseloom.functions.dates import elapsed_days
from caseloom.functions.identity import pseudonymize
from caseloom.settings import (
    DAILY_SHEET,
    EARLIER_LIMITS,
    INPATIENT_SHEET,
    OUTPATIENT_SHEET,
    DatePolicy,
    SheetSpec,
)

SALT = "salt"

# The days the tables cover
FIRST_DAY, LAST_DAY = date(1995, 1, 1), date(2001, 12, 31)
DATES = DatePolicy(
    first_day=date(1995, 1, 1),
    last_day=date(2000, 12, 31),
    year_typos=(("9199", "1999"),),
    shifted_year=1998,
    shifted_to=1996,
    last_genuine_month=6,
)
SHEET = SheetSpec(
    sheet="REGISTRO",
    keys=("NO. (consecutivo)", "NOMBRE"),
    header_rows=2,
    columns=(
        ("folio", "NO."),
        ("nombre", "NOMBRE"),
        ("edad_f", "EDAD | F"),
        ("edad_m", "EDAD | M"),
        ("saldo", "SALDO"),
    ),
    **EARLIER_LIMITS,
)
UNLIMITED_SHEET = replace(SHEET, search_rows=None, search_columns=None, blank_rows=None)
ROWS_PER_BOOK = 40


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _choose(value: Column, choices: dict, otherwise: str | None = None) -> Column:
    chosen = F.lit(otherwise)
    for key, name in reversed(list(choices.items())):
        chosen = F.when(value == key, F.lit(name)).otherwise(chosen)
    return chosen


# ---------------------------------------------------------------------------
# Cases: one line item each
# ---------------------------------------------------------------------------
def _case_columns() -> dict[str, Column]:
    flag, line = F.col("l_returnflag"), F.col("l_linenumber")
    pending = (
        F.when(line == 7, F.lit("NO_CONCLUYENTE"))
        .when(line == 6, F.lit("NO_ESPECIFICADO"))
        .otherwise(F.lit("PENDIENTE"))
    )
    admitted = F.when(F.col("l_linestatus") == "F", F.col("l_shipdate"))
    lag = elapsed_days(F.col("o_orderdate"), admitted)
    linked = F.coalesce(lag <= 7, F.lit(False))
    return {
        "paciente_id": F.sha2(F.col("c_name"), 256),
        "edad": F.when(F.col("p_partkey") % 17 == 0, F.lit(-1.0)).otherwise(
            ((F.col("p_size") - 1) * 2 + F.col("p_partkey") % 2).cast("double")
        ),
        "sexo": _choose(
            F.col("c_mktsegment"),
            {"FURNITURE": "F", "MACHINERY": "M", "HOUSEHOLD": "OTRO"},
            "INDETERMINADO",
        ),
        "municipio_residencia": F.col("n_name"),
        "derechohabiencia": _choose(
            F.col("o_orderpriority"),
            {"1-URGENT": "imss", "2-HIGH": " Issste ", "3-MEDIUM": "Privada", "5-LOW": "SEDENA"},
        ),
        "fecha_notificacion": F.col("o_orderdate"),
        "fecha_toma_muestra": F.timestamp_add(
            "DAY", (F.col("o_orderkey") % 3).cast("int"), F.col("o_orderdate")
        ),
        "fecha_resultado": F.when(~((flag == "N") & (line % 3 == 0)), F.col("l_shipdate")),
        "resultado_prueba": F.when(flag == "R", F.lit("POSITIVO"))
        .when(flag == "A", F.lit("NEGATIVO"))
        .otherwise(pending),
        "estatus_paciente": _choose(
            F.col("o_orderstatus"), {"O": "AMBULATORIO", "F": "HOSPITALIZADO", "P": "DEFUNCION"}
        ),
        "hospital": F.lit(None).cast("string"),
        "fecha_ingreso_hospital": admitted,
        "es_registro_unificado": linked,
        "dias_entre_notificacion_e_ingreso": F.when(linked, lag),
    }


_FROM_PART = {"edad"}
_FROM_CUSTOMER = {"paciente_id", "sexo"}
_FROM_NATION = {"municipio_residencia"}
_FROM_ORDERS = {
    "derechohabiencia",
    "fecha_notificacion",
    "fecha_toma_muestra",
    "estatus_paciente",
    "es_registro_unificado",
    "dias_entre_notificacion_e_ingreso",
}


def cases(spark: SparkSession, sf: str, *fields: str) -> DataFrame:
    """Cases with the given columns, joined from no more tables than they need."""
    columns = _case_columns()
    wanted = set(fields or columns)
    df = table(spark, sf, "lineitem")
    person = wanted & (_FROM_CUSTOMER | _FROM_NATION)
    if person or wanted & _FROM_ORDERS:
        df = df.join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    if person:
        df = df.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    if wanted & _FROM_NATION:
        df = df.join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    if wanted & _FROM_PART:
        df = df.join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return df.select(*[columns[c].alias(c) for c in columns if c in wanted])


def shapes(spark: SparkSession, sf: str) -> DataFrame:
    """Municipal shapes: nations, some under a longer name, in their regions."""
    longer = F.when(F.col("n_nationkey") % 4 == 3, F.lit(" de Mapa")).otherwise(F.lit(""))
    return (
        table(spark, sf, "nation")
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.initcap("r_name").alias("estado"),
            F.concat("n_name", longer).alias("municipio"),
            F.lit("{}").alias("geometry_json"),
        )
    )


MAP_STATES = ("AFRICA", "AMERICA", "ASIA")
MAP_ALIASES = {f"NATION_{k}": f"NATION_{k} DE MAPA" for k in range(3, 25, 4)}


# ---------------------------------------------------------------------------
# Dirty cells
# ---------------------------------------------------------------------------
def dirty_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates as people type them: ``(o_orderkey, v, kind)``."""
    day, way = F.col("o_orderdate"), F.col("o_orderkey") % 10
    slash = F.date_format(day, "dd/MM/yyyy")
    serial = F.datediff(F.to_date(day), F.lit("1899-12-30").cast("date")).cast("string")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(way == 0, slash)
        .when(way == 1, F.date_format(day, "yyyy-MM-dd"))
        .when(way == 2, F.concat(slash, F.lit("   turno B")))
        .when(way == 3, F.date_format(day, "dd.MM.yyyy"))
        .when(way == 4, F.date_format(day, "dd-MM-yyyy"))
        .when(way == 5, serial)
        .when(way == 6, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(way == 7, F.lit("PENDIENTE"))
        .when(way == 8, F.replace(slash, F.lit("1999"), F.lit("9199")))
        .alias("v"),
        F.when(way == 5, F.lit("number"))
        .when(way == 6, F.lit("datetime"))
        .when(way < 9, F.lit("text"))
        .alias("kind"),
    )


# Ways to type a date, by the key's remainder: (format, what stands before, what after)
DATE_SHAPES = (
    ("dd/MM/yyyy", "", ""),
    ("dd/MM/yy", "", " turno C"),
    ("yyyy-MM-dd", "el ", ""),
    ("dd-MM-yy", "", ""),
    ("dd.MM.yy", "", ""),
    ("d.M.yyyy", " ", ""),
    ("dd MM yyyy", "", ""),
    ("yyyy.MM.dd", "", ""),
    ("yyyy MM dd", "", ""),
    ("yyyyMMdd", "", ""),
    ("d MMM yyyy", "", ""),
    ("dd-MMM-yyyy", "", ""),
    ("d MMMM yyyy", "", ""),
    ("MMMM d, yyyy", "", ""),
    ("MMM d yyyy", "", ""),
    ("d. MMMM yy", "", ""),
    ("yyyy-MM", "", ""),
    ("yyyy", "PENDIENTE ", ""),
    ("EEEE", "", ""),
    ("yyyyMM", "", "?"),
)


def shaped_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates in all :data:`DATE_SHAPES`, the first of the century's years moved to 20xx."""
    way = F.col("o_orderkey") % len(DATE_SHAPES)
    day = F.col("o_orderdate") + F.expr("INTERVAL 10 YEARS")
    typed = [
        F.concat(F.lit(before), F.date_format(day, shape), F.lit(after)) for shape, before, after in DATE_SHAPES
    ]
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.element_at(F.array(*typed), (way + 1).cast("int")).alias("v"),
        F.lit("text").alias("kind"),
    )


# Whole texts with a time of day or a weekday, the last two of them no dates
CLOCK_SHAPES = (
    "d MMM yyyy HH:mm",
    "dd.MM.yyyy HH:mm:ss",
    "EEEE, MMMM d, yyyy 'at' h:mm a",
    "EEE dd-MM-yyyy",
    "h:mm a dd.MM.yyyy",
    "yyyyMMdd HH:mm",
    "yyyy.MM.dd H 'hrs'",
    "dd.MM.yyyy '25':mm",
    "d MMM yyyy 'turno' HH:mm",
)


def clocked_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates with a time of day, in all :data:`CLOCK_SHAPES`."""
    key = F.col("o_orderkey")
    at = F.timestamp_add("SECOND", (key * 7919 % 86400).cast("int"), F.col("o_orderdate"))
    typed = F.array(*[F.date_format(at, shape) for shape in CLOCK_SHAPES])
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.element_at(typed, (key % len(CLOCK_SHAPES) + 1).cast("int")).alias("v"),
        F.lit("text").alias("kind"),
    )


# Every 449th Hangul syllable, a spread over leads, vowels and tails
SYLLABLES = tuple(chr(0xAC00 + n * 449 % 11172) for n in range(25))


def dirty_results(spark: SparkSession, sf: str) -> DataFrame:
    """Result and result date, in exchanged cells for every fourth order."""
    key = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "dd/MM/yyyy")
    result = _choose(F.col("o_orderstatus"), {"O": "POSITIVO", "F": "NEGATIVO", "P": "RECHAZO"})
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(key % 4 == 0, day).otherwise(result).alias("resultado"),
        F.when(key % 4 == 0, result).when(key % 4 < 3, day).alias("v"),
        F.when(key % 4 < 3, F.lit("text")).alias("kind"),
    )


def dirty_people(spark: SparkSession, sf: str) -> DataFrame:
    """Ages and sexes of parts, abbreviated, noisy, or in exchanged cells."""
    way, size = F.col("p_partkey") % 7, F.col("p_size").cast("string")
    return table(spark, sf, "part").select(
        "p_partkey",
        F.when(way == 0, size)
        .when(way == 1, F.concat(size, F.lit(" m")))
        .when(way == 2, F.lit("RN"))
        .when(way == 3, F.concat(F.lit("años: "), size))
        .when(way == 4, F.lit("f"))
        .when(way == 5, F.concat(size, F.lit(".0")))
        .alias("edad_raw"),
        F.when(way == 0, F.lit("F"))
        .when(way == 1, F.lit(" m "))
        .when(way == 2, F.lit("  "))
        .when(way == 4, size)
        .when(way == 5, F.lit("X"))
        .alias("sexo_raw"),
    )


# ---------------------------------------------------------------------------
# Registries of orders: even keys notify, odd keys admit
# ---------------------------------------------------------------------------
def notifications(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "orders")
        .filter(F.col("o_orderkey") % 2 == 0)
        .select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("notified"))
    )


def admissions(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "orders")
        .filter(F.col("o_orderkey") % 2 == 1)
        .select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("admitted"))
    )


def both_registries(spark: SparkSession, sf: str) -> DataFrame:
    even = F.col("o_orderkey") % 2 == 0
    return table(spark, sf, "orders").select(
        "o_custkey",
        "o_orderpriority",
        "o_orderkey",
        F.when(even, F.col("o_orderdate")).alias("notified"),
        F.when(~even, F.col("o_orderdate")).alias("admitted"),
    )


def monthly_registries(spark: SparkSession, sf: str) -> DataFrame:
    """Both registries with three weeks between months, and times of day.

    Notifications come at three times of the day, every thousandth order at one of its
    own; admissions at any minute.
    """
    key = F.col("o_orderkey")
    month = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    day = F.timestamp_add("DAY", (month - 1995 * 12) * 21, F.col("o_orderdate"))
    minutes = F.when(key % 1000 == 0, 61).otherwise((key % 3 + 3) * 240)
    even = key % 2 == 0
    return table(spark, sf, "orders").select(
        "o_orderpriority",
        "o_orderkey",
        F.when(even, F.timestamp_add("MINUTE", minutes.cast("int"), day)).alias("notified"),
        F.when(~even, F.timestamp_add("MINUTE", (key * 7919 % 1440).cast("int"), day)).alias("admitted"),
    )


# How the registries of orders are read: one year is mistyped, days before June 1995 are not covered
REGISTRY_DATES = DatePolicy(
    first_day=date(1995, 6, 1),
    last_day=LAST_DAY,
    year_typos=(("9199", "1999"),),
    shifted_year=None,
)


def _day(day: Column, shape: str) -> Column:
    return F.date_format(day, shape)


def _serial(day: Column) -> Column:
    return F.datediff(F.to_date(day), F.lit("1899-12-30").cast("date")).cast("string")


def _typed(day: Column, way: Column) -> tuple[Column, Column]:
    """A day typed six ways, by ``way``: the cell's text and kind.

    A number, a date cell, year first, with a mistyped year, twenty years late, or plain.
    """
    text = (
        F.when(way == 0, _serial(day))
        .when(way == 1, _day(day, "yyyy-MM-dd HH:mm:ss"))
        .when(way == 2, _day(day, "yyyy-MM-dd"))
        .when(way == 3, F.replace(_day(day, "dd/MM/yyyy"), F.lit("1999"), F.lit("9199")))
        .when(way == 4, _day(day + F.expr("INTERVAL 20 YEARS"), "dd/MM/yyyy"))
        .otherwise(_day(day, "dd/MM/yyyy"))
    )
    kind = F.when(way == 0, F.lit("number")).when(way == 1, F.lit("datetime")).otherwise(F.lit("text"))
    return text, kind


def _registry_values() -> dict[str, tuple[Column, Column]]:
    """Logical columns of both registries, each a cell's text and kind.

    Even orders notify, odd ones admit. Result and result date stand in each other's
    cell in every eleventh order.
    """
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    even, half = key % 2 == 0, F.floor(key / 2)
    text = F.lit("text")
    age = (F.col("c_custkey") % 90).cast("string")
    woman = F.col("c_nationkey") % 2 == 0
    word = _choose(F.col("o_orderstatus"), {"O": "Detectado", "F": "NO  DETECTADO", "P": "Trámite"})
    read = _day(F.timestamp_add("DAY", (key % 5).cast("int"), day), "dd/MM/yyyy")
    swapped = key % 11 == 3
    notified, notified_kind = _typed(day, half % 6)
    admitted, admitted_kind = _typed(day, F.when(half % 3 < 2, half % 3).otherwise(5))
    sampled = _day(F.timestamp_add("DAY", (key % 3).cast("int"), day), "dd.MM.yyyy")
    return {
        "folio": (F.col("c_custkey").cast("string"), F.lit("number")),
        "nombre": (F.col("c_name"), text),
        "sexo": (F.when(woman, F.lit("f")).otherwise(F.lit("M")), text),
        "edad": (age, F.lit("number")),
        "edad_f": (F.when(woman, age), F.lit("number")),
        "edad_m": (F.when(~woman, age), F.lit("number")),
        "municipio": (
            _choose(F.col("c_nationkey") % 3, {0: "Nezahualcóyotl", 1: " ecatepec  de Morelos"}, "x"),
            text,
        ),
        "derechohabiencia": (F.when(key % 4 == 0, F.col("o_orderpriority")), text),
        "resultado": (F.when(swapped, read).otherwise(word), text),
        "fecha_resultado": (F.when(swapped, word).otherwise(read), text),
        "estatus": (_choose(key % 6, {0: "casa", 2: "Óbito"}, "HOSPITAL"), text),
        "hospital": (F.concat(F.lit("H"), (key % 7).cast("string")), text),
        "fecha_notificacion": (notified, notified_kind),
        "fecha_toma_muestra": (sampled, text),
        "fecha_ingreso": (admitted, admitted_kind),
    }


def _registry_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Raw registry rows of orders and their customers."""
    even = F.col("o_orderkey") % 2 == 0
    values = _registry_values()
    outpatient = {name for name, _ in OUTPATIENT_SHEET.columns}
    inpatient = {name for name, _ in INPATIENT_SHEET.columns}

    def raw(name: str, cell: bool = False) -> Column:
        text, kind = values[name]
        here = F.lit(False)
        if name in outpatient:
            here = here | even
        if name in inpatient or (name in ("edad", "sexo")):
            here = here | ~even
        if not cell:
            return F.when(here, text).alias(f"{name}_raw")
        there = here & text.isNotNull()
        return F.struct(F.when(there, text).alias("v"), F.when(there, kind).alias("kind")).alias(f"{name}_raw")

    # an inpatient's sex is told by the column that holds the age
    sex = F.when(even, values["sexo"][0]).otherwise(F.upper(values["sexo"][0])).alias("sexo_raw")
    dates = ("fecha_notificacion", "fecha_toma_muestra", "fecha_resultado", "fecha_ingreso")
    texts = ("municipio", "derechohabiencia", "resultado", "estatus", "hospital")
    return _registry_orders(spark, sf).select(
        F.col("o_orderkey").alias("row_order"),
        pseudonymize(values["nombre"][0], values["folio"][0], SALT).alias("paciente_id"),
        F.when(even, F.lit("seguimiento")).otherwise(F.lit("nominal")).alias("fuente"),
        values["folio"][0].alias("folio_origen"),
        sex,
        raw("edad"),
        *[raw(name) for name in texts],
        *[raw(name, cell=True) for name in dates],
    )


ORDERS_PER_BOOK = 400


def _lay(df: DataFrame, sheet: str, first_row: Column, header: list[tuple[int, int, str]], places: Mapping[str, int]) -> DataFrame:
    """A registry as cells: rows from ``first_row`` on, the header above the first one.

    ``header`` holds (rows above the data, column, text).
    """
    values = _registry_values()
    # Values are columns of their own first: what a generator takes apart is not compiled
    # where it is long, and a file's name would be put together for every cell
    named = F.concat(F.lit("libro_"), F.lpad(F.col("book").cast("string"), 9, "0")).alias("file")
    valued = df.select(
        named,
        "at",
        first_row.alias("first_row"),
        *[part.alias(f"{name}_{k}") for name in places for k, part in enumerate(values[name])],
    )

    def entry(r: Column, c: int, v: Column, kind: Column) -> Column:
        return F.struct(r.cast("int").alias("r"), F.lit(c).alias("c"), v.alias("v"), kind.alias("kind"))

    row = F.col("first_row") + F.col("at")
    data = F.array(
        *[entry(row, c, F.col(f"{name}_0"), F.col(f"{name}_1")) for name, c in places.items()]
    )
    top = F.array(
        *[entry(F.col("first_row") - up, c, F.lit(text), F.lit("text")) for up, c, text in header]
    )
    cells = F.when(F.col("at") == 0, F.concat(top, data)).otherwise(data)
    return valued.select("file", F.lit(sheet).alias("sheet"), F.inline(cells)).filter(
        F.col("v").isNotNull()
    )


def registry_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Workbooks of both registries, and of a daily sheet that is counted only.

    What :func:`bronze` has as rows: a book holds the notifications and admissions of 400
    orders. Headers wander, the admissions' spans three rows; the daily sheet lists nations.
    """
    book = F.floor(F.col("o_orderkey") / ORDERS_PER_BOOK)
    in_book = W.partitionBy("book").orderBy("o_orderkey")
    even = F.col("o_orderkey") % 2 == 0

    def numbered(side: Column) -> DataFrame:
        # each side is numbered by itself: no side sorts the other's orders
        orders = _registry_orders(spark, sf).filter(side).withColumn("book", book)
        return orders.withColumn("at", F.row_number().over(in_book) - 1)

    titles = [(OUTPATIENT_SHEET.keys[0], "folio"), ("CASO (nombre)", "nombre")]
    titles += [(f"{prefix} del caso", name) for name, prefix in OUTPATIENT_SHEET.columns[2:]]
    out_places = {name: c for c, (_, name) in enumerate(titles, 2)}
    out_header = [(1, out_places[name], title) for title, name in titles]
    in_places = dict(zip(("folio", "nombre", "edad_f", "edad_m", "fecha_ingreso", "resultado", "fecha_resultado", "hospital"), (1, 2, 3, 4, 5, 7, 8, 9)))
    in_header = [
        (3, 1, "NO."),
        (3, 2, "NOMBRE DEL PACIENTE"),
        (3, 3, "EDAD"),
        (2, 3, "F"),
        (2, 4, "M"),
        (3, 5, "FECHA DE INGRESO"),
        (3, 7, "PRUEBA"),
        (1, 7, "RESULTADO"),
        (1, 8, "FECHA DE RESULTADO"),
        (3, 9, "HOSPITAL"),
    ]
    outpatients = _lay(
        numbered(even), OUTPATIENT_SHEET.sheet, F.col("book") % 5 + 4, out_header, out_places
    )
    inpatients = _lay(
        numbered(~even), INPATIENT_SHEET.sheet, F.col("book") % 3 + 6, in_header, in_places
    )
    nation = table(spark, sf, "nation")
    first = F.col("n_nationkey") == 0
    daily = nation.select(
        F.lit("libro_000000000").alias("file"),
        F.lit(DAILY_SHEET.sheet).alias("sheet"),
        F.inline(
            F.concat(
                F.when(first, F.array(F.struct(F.lit(1).alias("r"), F.lit(1).alias("c"), F.lit(DAILY_SHEET.keys[0]).alias("v"), F.lit("text").alias("kind")))).otherwise(F.array()),
                F.array(F.struct((F.col("n_nationkey") + 2).cast("int").alias("r"), F.lit(1).alias("c"), F.col("n_name").alias("v"), F.lit("text").alias("kind"))),
            )
        ),
    )
    return outpatients.unionByName(inpatients).unionByName(daily)


# ---------------------------------------------------------------------------
# Landed workbooks of customers
# ---------------------------------------------------------------------------
def cells(spark: SparkSession, sf: str) -> DataFrame:
    """Forty customers a workbook, under a two-level header that wanders.

    Some keys are blank after the header, one is blank near the end, and the
    customers after it are stray cells.
    """
    key = F.col("c_custkey")
    book = F.floor(key / ROWS_PER_BOOK).cast("int")
    at = (key % ROWS_PER_BOOK).cast("int")
    customers = table(spark, sf, "customer").withColumn("book", book).withColumn("at", at)
    header = F.lit(3) + F.col("book") % 5
    blanks = F.when(F.col("book") % 13 == 12, F.lit(11)).otherwise(F.col("book") % 3)
    row = header + 2 + blanks + F.col("at")

    def entry(r: Column, c: int, v: Column, kind: str) -> Column:
        return F.struct(
            r.cast("int").alias("r"),
            F.lit(c).alias("c"),
            v.cast("string").alias("v"),
            F.lit(kind).alias("kind"),
        )

    age = F.col("c_custkey") % 90
    has_key = F.col("at") != 30 + F.col("book") % 10
    data = F.array(
        entry(row, 1, F.when(has_key, F.col("c_custkey")), "number"),
        entry(row, 2, F.col("c_name"), "text"),
        entry(row, 3, F.when(F.col("at") % 2 == 0, age), "number"),
        entry(row, 4, F.when(F.col("at") % 2 == 1, age), "number"),
        entry(row, 6, F.col("c_acctbal"), "number"),
    )
    titles = [
        (0, 1, "No. (Consecutivo)"),
        (0, 2, "NOMBRE DEL PACIENTE"),
        (0, 3, "EDAD"),
        (1, 3, "F"),
        (1, 4, "M"),
        (0, 6, "SALDO"),
    ]
    top = F.array(
        entry(F.lit(1), 1, F.lit("RELACION DE NO. (CONSECUTIVO) Y NOMBRE"), "text"),
        *[entry(header + level, c, F.lit(text), "text") for level, c, text in titles],
    )
    all_cells = F.when(F.col("at") == 0, F.concat(top, data)).otherwise(data)
    return customers.select(
        F.concat(F.lit("libro_"), F.col("book").cast("string")).alias("file"),
        F.lit(SHEET.sheet).alias("sheet"),
        F.inline(all_cells),
    ).filter(F.col("v").isNotNull())


# ---------------------------------------------------------------------------
# Cells of the older one-table report
# ---------------------------------------------------------------------------
# As typed, by the rules that read them
TYPED_CELLS = {
    "country": ("MEXICO", "MÉXICO DF", "MEX", "CUBA", "EN MEXICO"),
    "sample": ("PENSIENTE", "PENDIENTE DE TOMA", "NEGATIVO", "POS", "NO", "NO SE TOMO", "SI", "NINGUNO POSIBLE"),
    "result": (
        "POSITIVO A SARS", "POS", "´POSITIVO", "NEG.", " NEGATIVO", "NEGATIVO", "INDETERMINADO", "´NO", "MUESTRA MALA",
        "NO ADECUADA", "EN PENDIENTE", "RECHAZADA", "SIN RESULTADO", "DUDOSO", "A POS",
    ),
    "result_date": ("PENSIENTE", "PENDIENTE", "NO HAY", "ERROR", "DEFUNCION", "SIN FECHA", "NEGATIVO", "POSITIVO", "01/05/2020", "NEGADO"),
    "result_date_second": ("PENDIENTE", "NEGATIVO", "POSITIVO", "NO SE TOMÓ", "01/05/2020"),
    "age": ("RN", "3D", "5 MESES", "2 d", "8 m", "34", "45 AÑOS", "3MESES"),
    "age_second": ("M", "HOMBRE", "NIÑO", "34", "5,M", "f"),
    "sex": ("F", "FEMENINO", "MASC", "HOMBRE", "NIÑA", "RN", "D", "40 AÑ", "X", "DOS AÑ"),
    "sex_second": ("F", "M", "H", "NO", "GAY", "SN", "X", "TRAVESTI R", "45", "OTRO"),
}


def older_registry(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as raw rows of the older report: result and its date, and sex and age, may be exchanged."""
    key = F.col("o_orderkey")

    def pick(values: tuple, by: Column) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), by.cast("int"))

    result = pick(("POSITIVO", "NEG.", "RECHAZADA", "SIN MUESTRA", None), key % 5)
    day = F.date_format("o_orderdate", "dd/MM/yyyy")
    sex = pick(("FEMENINO", "MASC", "HOMBRE", "F"), key % 4)
    age = pick(("RN", "5 MESES"), key % 13)
    years = F.coalesce(age, (F.col("o_custkey") % 97).cast("string"))
    swapped, turned = key % 7 == 3, key % 11 == 5
    null = F.lit(None).cast("string")
    return table(spark, sf, "orders").select(
        F.when(turned, (F.col("o_custkey") % 97).cast("string")).otherwise(sex).alias("sexo"),
        F.when(turned, sex).otherwise(years).alias("edad"),
        F.when(key % 3 > 0, pick(("GAM NORTE", "COL. NEZA"), key % 2)).alias("residencia"),
        F.when(key % 6 > 0, F.col("o_orderpriority")).alias("derechohabiencia"),
        day.alias("fecha_notificacion"),
        null.alias("toma_muestra"),
        F.when(swapped, day).otherwise(result).alias("resultado"),
        F.when(swapped, F.coalesce(result, F.lit("NADA"))).otherwise(day).alias("fecha_resultado"),
        pick(("AMB", "PACIENTE AMBULATORIO", "DEFUNCIÓN", "UCI", "HOSPITALIZADO", "ALTA"), key % 8).alias("estatus"),
        F.lit("MEXICO").alias("pais"),
    )
