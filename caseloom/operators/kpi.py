"""One-row key figures, stored and recomputed for a filtered view."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions.measures import case_indicators, safe_rate, weighted_count
from caseloom.operators.series import is_inverted
from caseloom.operators.views import filter_demographic, filter_insurance, filter_series
from caseloom.settings import INCONCLUSIVE, PENDING


def _lag_percentile(share: float | Sequence[float], weight: str | None) -> Column:
    """Percentile of the link lag. The lag has few distinct values (the link
    window bounds it), so the exact aggregate keeps only a handful of counts."""
    lag = F.when(F.col("es_registro_unificado"), F.col("dias_entre_notificacion_e_ingreso"))
    shares = F.lit(share) if isinstance(share, float) else F.array(*[F.lit(s) for s in share])
    return F.percentile(lag, shares, F.col(weight) if weight else F.lit(1))


def kpi_row(cases: DataFrame, weight: str | None = None) -> DataFrame:
    """The global figures; the median lag is null when nothing was linked."""
    is_a = case_indicators()
    result = F.col("resultado_prueba")
    inverted = (
        F.col("fechas_invertidas")
        if weight
        else is_inverted("fecha_toma_muestra", "fecha_resultado")
    )

    def count(condition: Column | None = None) -> Column:
        return weighted_count(condition, weight)

    totals = cases.agg(
        count().alias("total_pacientes_atendidos"),
        count(is_a["positive"]).alias("total_positivos"),
        count(is_a["negative"]).alias("total_negativos"),
        count(result == PENDING).alias("total_pendientes"),
        count(result == INCONCLUSIVE).alias("total_no_concluyentes"),
        count(is_a["hospitalised"]).alias("total_hospitalizados"),
        count(is_a["deceased"]).alias("total_defunciones"),
        count(is_a["positive_deceased"]).alias("_deceased"),
        count(is_a["positive_hospitalised"]).alias("_hospitalised"),
        count(F.col("es_registro_unificado")).alias("registros_unificados_cruce"),
        _lag_percentile(0.5, weight).alias("mediana_dias_notificacion_ingreso"),
        count(inverted).alias("casos_fechas_invertidas"),
    )
    positives = F.col("total_positivos")
    return totals.select(
        "total_pacientes_atendidos",
        "total_positivos",
        "total_negativos",
        "total_pendientes",
        "total_no_concluyentes",
        "total_hospitalizados",
        "total_defunciones",
        safe_rate(positives, positives + F.col("total_negativos")).alias(
            "tasa_global_positividad"
        ),
        safe_rate(F.col("_deceased"), positives).alias("tasa_global_letalidad"),
        safe_rate(F.col("_hospitalised"), positives).alias("tasa_global_hospitalizacion"),
        "registros_unificados_cruce",
        "mediana_dias_notificacion_ingreso",
        "casos_fechas_invertidas",
    )


def lag_percentiles(cases: DataFrame, weight: str | None = None) -> DataFrame:
    """One row: quartiles of the days between notification and admission."""
    found = cases.agg(_lag_percentile([0.25, 0.5, 0.75], weight).alias("p"))
    return found.select(
        F.get("p", F.lit(0)).alias("p25_dias"),
        F.get("p", F.lit(1)).alias("p50_dias"),
        F.get("p", F.lit(2)).alias("p75_dias"),
    )


# ---------------------------------------------------------------------------
# Filtered views
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class ViewFilter:
    """What a reader of the tables selected; empty means no filter."""

    first_day: date | None = None
    last_day: date | None = None
    sexes: tuple[str, ...] = ()
    age_groups: tuple[str, ...] = ()
    insurances: tuple[str, ...] = ()


def _view(tests: Column, positives: Column, negatives: Column, hospitalised: Column) -> list:
    return [
        tests.alias("total_pruebas"),
        positives.alias("casos_positivos_confirmados"),
        safe_rate(positives, positives + negatives).alias("tasa_global_positividad"),
        safe_rate(hospitalised, positives).alias("tasa_hospitalizacion"),
    ]


def kpi_view_from_cube(cube: DataFrame) -> DataFrame:
    """The four figures out of any cube of results and statuses; zeros if empty."""
    is_a = case_indicators()

    def count(condition: Column | None = None) -> Column:
        return weighted_count(condition, "total_casos")

    totals = cube.agg(
        count().alias("tests"),
        count(is_a["positive"]).alias("positives"),
        count(is_a["negative"]).alias("negatives"),
        count(is_a["positive_hospitalised"]).alias("hospitalised"),
    )
    return totals.select(*_view(*[F.col(c) for c in totals.columns]))


def kpi_view_from_series(series: DataFrame) -> DataFrame:
    """The four figures out of daily counts. Admissions are not split by result
    there, so the hospitalisation rate is an approximation."""
    totals = series.agg(
        *[
            weighted_count(weight=c).alias(c)
            for c in (
                "pruebas_tomadas",
                "resultados_positivos",
                "resultados_negativos",
                "ingresos_hospitalarios",
            )
        ]
    )
    return totals.select(*_view(*[F.col(c) for c in totals.columns]))


def kpi_view_stored(kpis: DataFrame) -> DataFrame:
    return kpis.limit(1).select(
        F.col("total_pacientes_atendidos").alias("total_pruebas"),
        F.col("total_positivos").alias("casos_positivos_confirmados"),
        "tasa_global_positividad",
        F.col("tasa_global_hospitalizacion").alias("tasa_hospitalizacion"),
    )


def kpi_view(
    view: ViewFilter,
    kpis: DataFrame | None,
    series: DataFrame | None,
    demographic: DataFrame | None,
    insurance: DataFrame | None,
    covers_all_days: bool = True,
) -> DataFrame:
    """The four figures from the table that knows a filter.

    In order: the insurance cube when insurances are selected; the demographic cube
    when sexes or ages are (neither knows dates, so a date filter is then ignored); the
    stored row when nothing is filtered, if it has one; else the daily series. A filter
    whose own table is absent or empty has zeros: no other table stands in for it.
    ``covers_all_days`` tells that the selected days are all there are.
    """
    if view.insurances:
        if insurance is not None:
            insurance = filter_insurance(insurance, view.insurances)
        return _cube_or_zeros(insurance)
    if view.sexes or view.age_groups:
        if demographic is not None:
            demographic = filter_demographic(demographic, view.sexes, view.age_groups)
        return _cube_or_zeros(demographic)
    if covers_all_days and kpis is not None and not kpis.isEmpty():
        return kpi_view_stored(kpis)
    if series is None:
        return _cube_or_zeros(None)
    return kpi_view_from_series(filter_series(series, view.first_day, view.last_day))


def _cube_or_zeros(cube: DataFrame | None) -> DataFrame:
    if cube is None:
        columns = "resultado_prueba string, estatus_paciente string, total_casos bigint"
        cube = SparkSession.active().createDataFrame([], columns)
    return kpi_view_from_cube(cube)
