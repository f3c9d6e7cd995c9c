"""Row contracts, reconciliation of derived tables, and the quality summary."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.errors import IntegrityError
from caseloom.functions.measures import safe_rate
from caseloom.settings import (
    AGE_BINS,
    DEFAULT_DATES,
    DISPLAY_AGE_BINS,
    INSURANCE_DOMAIN,
    NO_DATA,
    POSITIVE,
    RESULT_DOMAIN,
    SEX_DOMAIN,
    STATUS_DOMAIN,
)


# ---------------------------------------------------------------------------
# Row contracts: name -> the condition a good row meets
# ---------------------------------------------------------------------------
def in_domain(column: str, domain: Sequence[str]) -> Column:
    return F.col(column).isin(*domain)


def at_least_zero(column: str) -> Column:
    return F.col(column) >= 0


def is_share(column: str) -> Column:
    return F.col(column).between(0.0, 1.0)


def case_contract() -> dict[str, Column]:
    return {
        "paciente_id": F.length("paciente_id") == 64,
        "edad": F.col("edad") >= -1.0,
        "sexo": in_domain("sexo", SEX_DOMAIN),
        "municipio_residencia": F.col("municipio_residencia").isNotNull(),
        "derechohabiencia": F.col("derechohabiencia").isNotNull(),
        "resultado_prueba": in_domain("resultado_prueba", RESULT_DOMAIN),
        "estatus_paciente": in_domain("estatus_paciente", STATUS_DOMAIN),
        "es_registro_unificado": F.col("es_registro_unificado").isNotNull(),
    }


def one_date_contract() -> dict[str, Column]:
    """What rows look like before linking: notified or admitted, not both."""
    both = F.col("fecha_notificacion").isNotNull() & F.col("fecha_ingreso_hospital").isNotNull()
    return {"una_sola_fecha": ~both}


def demographic_contract() -> dict[str, Column]:
    ages = [*AGE_BINS.labels, AGE_BINS.missing]
    display = [*DISPLAY_AGE_BINS.labels, DISPLAY_AGE_BINS.missing]
    return {
        "grupo_edad": in_domain("grupo_edad", ages),
        "grupo_edad_ui": in_domain("grupo_edad_ui", display),
        "sexo": in_domain("sexo", SEX_DOMAIN),
        "resultado_prueba": in_domain("resultado_prueba", RESULT_DOMAIN),
        "estatus_paciente": in_domain("estatus_paciente", STATUS_DOMAIN),
        "total_casos": at_least_zero("total_casos"),
        "porcentaje_del_total": is_share("porcentaje_del_total"),
        "tasa_positividad_grupo": is_share("tasa_positividad_grupo"),
    }


def insurance_contract() -> dict[str, Column]:
    return {
        "derechohabiencia": in_domain("derechohabiencia", INSURANCE_DOMAIN),
        "resultado_prueba": in_domain("resultado_prueba", RESULT_DOMAIN),
        "estatus_paciente": in_domain("estatus_paciente", STATUS_DOMAIN),
        "total_casos": at_least_zero("total_casos"),
        **{
            rate: is_share(rate)
            for rate in (
                "porcentaje_del_total",
                "tasa_positividad_grupo",
                "tasa_hospitalizacion_grupo",
                "tasa_letalidad_grupo",
            )
        },
    }


def municipal_contract() -> dict[str, Column]:
    counts = ("casos", "positivos", "negativos", "hospitalizados", "defunciones")
    rates = ("positividad", "letalidad", "hospitalizacion")
    return {
        "municipio_residencia": F.col("municipio_residencia").isNotNull(),
        **{f"total_{c}": at_least_zero(f"total_{c}") for c in counts},
        **{f"tasa_{r}": is_share(f"tasa_{r}") for r in rates},
    }


def series_contract() -> dict[str, Column]:
    counts = (
        "casos_notificados",
        "pruebas_tomadas",
        "resultados_positivos",
        "resultados_negativos",
        "ingresos_hospitalarios",
        "defunciones",
        "media_movil_7d_positivos",
        "casos_positivos_acumulados",
    )
    return {"fecha": F.col("fecha").isNotNull(), **{c: at_least_zero(c) for c in counts}}


def kpi_contract() -> dict[str, Column]:
    counts = (
        "total_pacientes_atendidos",
        "total_positivos",
        "total_negativos",
        "total_pendientes",
        "total_no_concluyentes",
        "total_hospitalizados",
        "total_defunciones",
        "registros_unificados_cruce",
        "casos_fechas_invertidas",
    )
    rates = ("positividad", "letalidad", "hospitalizacion")
    return {
        **{c: at_least_zero(c) for c in counts},
        **{f"tasa_global_{r}": is_share(f"tasa_global_{r}") for r in rates},
    }


def check_contract(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row: rows seen, and rows breaking each rule. A rule that is null is broken."""
    return df.agg(
        F.count(F.lit(1)).alias("filas"),
        *[
            F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"viola_{name}")
            for name, rule in rules.items()
        ],
    )


def assert_contract(df: DataFrame, rules: Mapping[str, Column], what: str) -> None:
    counts = check_contract(df, rules).first().asDict()
    broken = {k: v for k, v in counts.items() if k.startswith("viola_") and v}
    if broken:
        raise IntegrityError(f"{what} breaks its row contract: {broken}")


# ---------------------------------------------------------------------------
# Reconciliation
# ---------------------------------------------------------------------------
def case_totals(
    first_day: date = DEFAULT_DATES.first_day, last_day: date = DEFAULT_DATES.last_day
) -> dict[str, Column]:
    """What derived tables are held against, as aggregates over the cases.

    The series only knows positives whose result date lies in the window.
    """
    positive = F.col("resultado_prueba") == POSITIVE
    dated = F.to_date("fecha_resultado").between(F.lit(first_day), F.lit(last_day))
    return {
        "rows": F.count(F.lit(1)),
        "positives": F.count_if(positive),
        "dated_positives": F.count_if(positive & dated),
    }


def table_totals() -> dict[str, dict[str, Column]]:
    """The same totals as aggregates over each derived table."""
    positive = F.col("resultado_prueba") == POSITIVE

    def total(condition: Column | None = None, count: str = "total_casos") -> Column:
        counted = F.col(count) if condition is None else F.when(condition, F.col(count))
        return F.coalesce(F.sum(counted), F.lit(0))

    return {
        "demografia": {
            "rows": total(),
            "positives": total(positive),
            "sin_dato": total(F.col("grupo_edad") == NO_DATA),
            "sin_dato_ui": total(F.col("grupo_edad_ui") == NO_DATA),
        },
        "geografia": {"rows": total(), "positives": total(count="total_positivos")},
        "derechohabiencia": {"rows": total(), "positives": total(positive)},
        "kpis": {
            "rows": F.max("total_pacientes_atendidos"),
            "positives": F.max("total_positivos"),
        },
        "series": {"dated_positives": total(count="resultados_positivos")},
    }


def controls(
    expected: Mapping[str, int], measured: Mapping[str, Mapping[str, int]]
) -> list[tuple[str, int, int]]:
    """``(control, measured, expected)`` of every table; both age binnings must agree
    on who has no age."""
    out = []
    for table, totals in measured.items():
        out += [(f"{table}.{k}", v, expected[k]) for k, v in totals.items() if k in expected]
        if "sin_dato" in totals:
            out.append((f"{table}.sin_dato", totals["sin_dato"], totals["sin_dato_ui"]))
    return out


def reconcile(
    expected: Mapping[str, int],
    demographic: DataFrame,
    series: DataFrame,
    municipal: DataFrame,
    insurance: DataFrame,
    kpis: DataFrame,
) -> DataFrame:
    """``(control, valor, esperado, coincide)``: every table's totals against the cases'.

    ``expected`` are the :func:`case_totals`, observed when the cases were first scanned;
    the tables, bounded by their domains, are one union of one-row aggregates.
    """
    tables = {
        "demografia": demographic,
        "geografia": municipal,
        "derechohabiencia": insurance,
        "kpis": kpis,
        "series": series,
    }
    rows = []
    for name, totals in table_totals().items():
        pairs = [
            F.struct(
                F.lit(f"{name}.{k}").alias("control"),
                F.col(k).cast("bigint").alias("valor"),
                F.lit(expected[k]).cast("bigint").alias("esperado"),
            )
            for k in totals
            if k in expected
        ]
        if "sin_dato" in totals:
            pairs.append(
                F.struct(
                    F.lit(f"{name}.sin_dato").alias("control"),
                    F.col("sin_dato").cast("bigint").alias("valor"),
                    F.col("sin_dato_ui").cast("bigint").alias("esperado"),
                )
            )
        one_row = tables[name].agg(*[c.alias(k) for k, c in totals.items()])
        rows.append(one_row.select(F.inline(F.array(*pairs))))
    return reduce(DataFrame.unionByName, rows).withColumn(
        "coincide", F.col("valor") == F.col("esperado")
    )


def wrong_controls(found: Iterable[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return [c for c in found if c[1] != c[2]]


def assert_reconciled(found: Iterable[tuple[str, int, int]]) -> None:
    wrong = wrong_controls(found)
    if wrong:
        listed = ", ".join(f"{name}={value} (expected {right})" for name, value, right in wrong)
        raise IntegrityError(f"tables do not add up to the cases: {listed}")


# ---------------------------------------------------------------------------
# Quality summary
# ---------------------------------------------------------------------------
def cleaning_facts() -> dict[str, Column]:
    """What a run reports of its cleaned rows, as aggregates."""
    return {
        "registros_hasheados": F.count(F.lit(1)),
        "correcciones_columnas_intercambiadas": F.count_if("columnas_intercambiadas"),
        "fechas_anomalas_fuera_ventana": F.coalesce(F.sum("fechas_anomalas"), F.lit(0)),
    }


def linking_facts() -> dict[str, Column]:
    """What a run reports of its unified cases, as aggregates."""
    linked = F.col("es_registro_unificado")
    return {
        "cruces_exitosos": F.count_if(linked),
        "registros_huerfanos": F.count_if(~linked),
        "colisiones_llave_sintetica": F.count_if("link_collided"),
    }


def quality_summary(
    spark: SparkSession, rows_outpatient: int, rows_inpatient: int, facts: Mapping[str, int]
) -> DataFrame:
    """One row of run telemetry from what its writes observed."""
    read = {
        "filas_leidas_bronze_seguimiento": rows_outpatient,
        "filas_leidas_bronze_nominal": rows_inpatient,
    }
    names = (*read, *cleaning_facts(), *linking_facts())
    one = spark.range(1).select(
        *[F.lit({**read, **facts}[n]).cast("bigint").alias(n) for n in names]
    )
    matched, orphans = F.col("cruces_exitosos"), F.col("registros_huerfanos")
    return one.select(
        *read,
        "registros_hasheados",
        "cruces_exitosos",
        "registros_huerfanos",
        safe_rate(orphans, matched + orphans).alias("porcentaje_huerfanos"),
        "correcciones_columnas_intercambiadas",
        "colisiones_llave_sintetica",
        "fechas_anomalas_fuera_ventana",
    )
