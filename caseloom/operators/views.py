"""Filters and small reshapings a dashboard applies to the stored tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.text import alias, normalize_map_name
from caseloom.operators.scaling import join_checked
from caseloom.settings import INSURANCE_OTHER, MAP_ALIASES, MAP_STATES, UNSPECIFIED


def _within(column: str, values: Sequence[str]) -> Column:
    """Membership, where an empty selection selects everything."""
    return F.col(column).isin(*values) if values else F.lit(True)


def filter_series(
    series: DataFrame, first_day: date | None, last_day: date | None, day: str = "fecha"
) -> DataFrame:
    """Days from ``first_day`` to ``last_day``, both included; None is open."""
    if first_day is not None:
        series = series.filter(F.to_date(day) >= F.lit(first_day))
    if last_day is not None:
        series = series.filter(F.to_date(day) <= F.lit(last_day))
    return series


def filter_demographic(
    cube: DataFrame, sexes: Sequence[str] = (), age_groups: Sequence[str] = ()
) -> DataFrame:
    return cube.filter(_within("sexo", sexes) & _within("grupo_edad_ui", age_groups))


def filter_insurance(cube: DataFrame, insurances: Sequence[str] = ()) -> DataFrame:
    return cube.filter(_within("derechohabiencia", insurances))


def curve_days(series: DataFrame, count: str = "resultados_positivos") -> DataFrame:
    """The days the curve is drawn through: those with cases."""
    return series.filter(F.col(count) > 0)


def risk_rows(cube: DataFrame) -> DataFrame:
    """Insurance rows worth comparing: named insurance, known result, some cases."""
    return cube.filter(
        (F.col("derechohabiencia") != INSURANCE_OTHER)
        & (F.col("resultado_prueba") != UNSPECIFIED)
        & (F.col("total_casos") > 0)
    )


def insurance_rates(cube: DataFrame) -> DataFrame:
    """The hospitalisation rate of each insurance, once."""
    return risk_rows(cube).select("derechohabiencia", "tasa_hospitalizacion_grupo").distinct()


def map_dimension(shapes: DataFrame, states: Sequence[str] = MAP_STATES) -> DataFrame:
    """Municipalities of the covered states: ``(municipio_match, geometry_json)``.

    States bound the choice since other states have towns of the same name.
    """
    return shapes.filter(normalize_map_name(F.col("estado")).isin(*states)).select(
        normalize_map_name(F.col("municipio")).alias("municipio_match"), "geometry_json"
    )


def _with_map_name(table: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    return table.withColumn("municipio_mapa", alias(F.col("municipio_residencia"), aliases))


def geo_match(
    table: DataFrame, dimension: DataFrame, aliases: Mapping[str, str] = MAP_ALIASES
) -> DataFrame:
    """Rows of the municipal table that have a shape, with the name to draw by."""
    names = dimension.select(F.col("municipio_match").alias("municipio_mapa")).distinct()
    return join_checked(_with_map_name(table, aliases), names, ["municipio_mapa"], "left_semi")


def geo_omitted(
    table: DataFrame, dimension: DataFrame, aliases: Mapping[str, str] = MAP_ALIASES
) -> DataFrame:
    """Municipalities without a shape, in order."""
    names = dimension.select(F.col("municipio_match").alias("municipio_mapa")).distinct()
    without = join_checked(_with_map_name(table, aliases), names, ["municipio_mapa"], "left_anti")
    return without.select("municipio_residencia").distinct().orderBy("municipio_residencia")


def missing_values(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Values of a column in ``left`` that ``right`` does not have, in order."""
    return left.select(column).subtract(right.select(column)).orderBy(column)
