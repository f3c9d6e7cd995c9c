"""The older one-table report: rule-based cleaning and five crosstabs.

Kept for comparing with figures published from it. Its rules are broad (a blank
sex ends as ``M``); the unified cases do not use them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom import settings
from caseloom.functions.dates import lacks_capitals, swap_if
from caseloom.functions.demography import bin_column
from caseloom.functions.text import fill_null, keep_only, regex_cascade
from caseloom.operators.cubes import crosstabs
from caseloom.operators.scaling import Staging, by_dictionary

COLUMNS = (
    "sexo",
    "edad",
    "residencia",
    "derechohabiencia",
    "fecha_notificacion",
    "toma_muestra",
    "resultado",
    "fecha_resultado",
    "estatus",
    "pais",
)
# What blanks become, and the only values kept at the end
_NO_DATE = "01/01/2000  12:00:00 a. m."
BLANKS = {
    "fecha_resultado": _NO_DATE,
    "pais": "MÉXICO",
    "residencia": "FORANEO",
    "derechohabiencia": "NINGUNO",
    "fecha_notificacion": _NO_DATE,
    "toma_muestra": "PENDIENTE",
    "resultado": "SOSPECHOSO",
    "edad": "-1",
    "sexo": "SIN DATO",
}
_NO_AGE = ("M", "F", "H", "NIÑO", "SIN DATO")
STATES = ("AMBULATORIO", "HOSPITALIZADO", "DEFUNCION")


def _swap(df: DataFrame, left: str, right: str, kind: str) -> DataFrame:
    """Exchange two cells where the left one is no text."""
    kinds = F.col(kind) if kind in df.columns else None
    first, second = swap_if(lacks_capitals(F.col(left), kinds), F.col(left), F.col(right))
    return df.withColumns({left: first, right: second})


def _cascade(df: DataFrame, column: str, calls, staging: Staging | None) -> DataFrame:
    """Rules by row or, with a staging, once for every different value."""
    if staging is None:
        return regex_cascade(df, column, calls)
    return by_dictionary(df, column, lambda d: regex_cascade(d, column, calls), staging)


def clean_older(registry: DataFrame, staging: Staging | None = None) -> DataFrame:
    """Text columns of :data:`COLUMNS`, cleaned by the older rules.

    With ``staging`` the first rules, which see cells as typed, are worked out once for
    every different value; pass a stored table then.

    ``resultado_kind`` and ``sexo_kind``, if present, tell cells that are no
    text; without them a cell without capitals counts as such.
    """
    cascades = {
        "pais": settings.COUNTRY_CASCADE,
        "estatus": settings.STATUS_CASCADE,
        "residencia": settings.RESIDENCE_CASCADE,
        "toma_muestra": settings.SAMPLE_CASCADE,
        "resultado": settings.RESULT_CASCADE,
        "fecha_resultado": settings.RESULT_DATE_CASCADE,
        "edad": settings.AGE_CASCADE,
        "sexo": settings.SEX_CASCADE,
    }
    df = fill_null(registry, BLANKS)
    for column, calls in cascades.items():
        df = _cascade(df, column, calls, staging)
    df = _swap(df, "resultado", "fecha_resultado", "resultado_kind")
    df = _swap(df, "sexo", "edad", "sexo_kind")
    df = _cascade(df, "fecha_resultado", settings.RESULT_DATE_SECOND_CASCADE, None)
    df = _cascade(df, "sexo", settings.SEX_SECOND_CASCADE, None)
    df = _cascade(df, "edad", settings.AGE_SECOND_CASCADE, None)
    age = F.when(~F.col("edad").isin(*_NO_AGE), F.col("edad").try_cast("double"))
    return df.withColumns(
        {
            "resultado": keep_only(F.col("resultado"), settings.LEGACY_RESULTS, "SOSPECHOSO"),
            "sexo": keep_only(F.col("sexo"), settings.LEGACY_SEXES, "OTRO"),
            "edad": F.coalesce(age, F.lit(settings.UNKNOWN_AGE)),
        }
    ).select(*COLUMNS)


def _label(column: str, labels: tuple[str, ...]) -> Column:
    """The first of ``labels`` a text contains, else the text."""
    text = F.col(column)
    return F.coalesce(*[F.when(text.contains(label), F.lit(label)) for label in labels], text)


TABLES = {
    "resultado_sexo": ("resultado", "sexo"),
    "estatus_resultado": ("estatus", "resultado"),
    "estatus_sexo": ("estatus", "sexo"),
    "edad_resultado": ("rango", "resultado"),
    "edad_estatus": ("rango", "estatus"),
}
DOMAINS = {
    "resultado": settings.LEGACY_RESULTS,
    "sexo": settings.LEGACY_SEXES,
    "estatus": STATES,
    "rango": (*settings.LEGACY_AGE_BINS.labels, settings.LEGACY_AGE_BINS.missing),
}


def older_cells(
    cleaned: DataFrame, staging: Staging | None = None, other: str | None = None
) -> DataFrame:
    """``(tabla, fila, columna, n)``: all cells of the report's five crosstabs, zeros included.

    A status counts as what it contains, as ``PACIENTE AMBULATORIO`` does; one that
    contains several labels counts as the first of them. Other statuses are left out,
    or counted as ``other`` if given.

    The cleaned table is stored first, in the columns that are counted, and scanned
    once for all tables: conditions pushed down through the many steps of the rules
    would repeat them without end.
    """
    staging = staging or Staging(cleaned.sparkSession)
    stored = staging.table(cleaned.select("edad", "estatus", "resultado", "sexo"), "older-cleaned")
    df = stored.withColumns(
        {
            "rango": bin_column(F.col("edad"), settings.LEGACY_AGE_BINS),
            "estatus": _label("estatus", STATES),
        }
    )
    return crosstabs(df, TABLES, DOMAINS, other)


def older_crosstabs(
    cleaned: DataFrame, staging: Staging | None = None, other: str | None = None
) -> dict[str, DataFrame]:
    """The five crosstabs of :func:`older_cells`, each with a column per value."""
    staging = staging or Staging(cleaned.sparkSession)
    cells = staging.table(older_cells(cleaned, staging, other), "older-cells")
    more = () if other is None else (other,)

    def wide(name: str, row: str, column: str) -> DataFrame:
        values = [
            F.sum(F.when(F.col("columna") == v, F.col("n")).otherwise(0)).alias(v)
            for v in (*DOMAINS[column], *more)
        ]
        return cells.filter(F.col("tabla") == name).groupBy(F.col("fila").alias(row)).agg(*values)

    return {name: wide(name, *pair) for name, pair in TABLES.items()}
