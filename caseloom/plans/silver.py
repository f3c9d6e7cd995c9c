"""Landed cells to unified cases."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.dates import mark_swapped, read_dates, swap_if
from caseloom.functions.demography import age_by_sex_columns, read_age_sex
from caseloom.functions.identity import coerce_text, project_without_pii, pseudonymize
from caseloom.functions.text import default_if_empty, lookup
from caseloom.operators.linkage import LinkOptions, link_cases
from caseloom.operators.scaling import Staging
from caseloom.settings import (
    DAILY_SHEET,
    DATE_COLUMNS,
    DEFAULT_DATES,
    INPATIENT_SHEET,
    INSURANCE_BLANK,
    MUNICIPALITY_CATALOG,
    MUNICIPALITY_DEFAULT,
    OUTPATIENT_SHEET,
    PII_COLUMNS,
    RESULT_SYNONYMS,
    STATUS_SYNONYMS,
    UNSPECIFIED,
    DatePolicy,
    SheetSpec,
    synonym_catalog,
)
from caseloom.sources.landing import read_columns

_TEXTS = ("sexo", "edad", "municipio", "derechohabiencia", "resultado", "estatus", "hospital")
_DATES = ("fecha_notificacion", "fecha_toma_muestra", "fecha_resultado", "fecha_ingreso")
BRONZE_COLUMNS = (
    "row_order",
    "paciente_id",
    "fuente",
    "folio_origen",
    *[f"{t}_raw" for t in _TEXTS],
    *[f"{d}_raw" for d in _DATES],
)
SILVER_COLUMNS = (
    "paciente_id",
    "edad",
    "sexo",
    "municipio_residencia",
    "derechohabiencia",
    "fecha_notificacion",
    "fecha_toma_muestra",
    "fecha_resultado",
    "resultado_prueba",
    "estatus_paciente",
    "hospital",
    "fecha_ingreso_hospital",
    "es_registro_unificado",
    "dias_entre_notificacion_e_ingreso",
)
_NO_CELL = "struct<v:string,kind:string>"


@dataclass(frozen=True)
class Registries:
    """The landed sheets of one source and the salt of its pseudonyms."""

    salt: str
    outpatient: SheetSpec = OUTPATIENT_SHEET
    inpatient: SheetSpec = INPATIENT_SHEET
    daily: SheetSpec = DAILY_SHEET


def _to_bronze(rows: DataFrame, source: str, rank: int, spec: SheetSpec, salt: str) -> DataFrame:
    """Registry rows with pseudonyms; names and folios end here."""
    logical = {name for name, _ in spec.columns}

    def raw(name: str) -> Column:
        return F.col("cells")[name] if name in logical else F.lit(None).cast(_NO_CELL)

    def text(name: str) -> Column:
        return coerce_text(raw(name)["v"], raw(name)["kind"])

    texts = {name: text(name) for name in _TEXTS}
    if "edad_f" in logical:
        pair = age_by_sex_columns(text("edad_f"), text("edad_m"))
        texts["edad"], texts["sexo"] = pair["edad"], pair["sexo"]
    bronze = rows.select(
        F.struct(F.lit(rank).alias("rank"), F.col("file"), F.col("r")).alias("row_order"),
        pseudonymize(text("nombre"), text("folio"), salt).alias("paciente_id"),
        F.lit(source).alias("fuente"),
        text("folio").alias("folio_origen"),
        *[column.alias(f"{name}_raw") for name, column in texts.items()],
        *[raw(name).alias(f"{name}_raw") for name in _DATES],
    )
    return project_without_pii(bronze, BRONZE_COLUMNS, PII_COLUMNS)


def ingest_registries(
    cells: DataFrame, registries: Registries, staging: Staging | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """Both patient registries as one table, and the rows read per sheet.

    The rows of the daily sheet are counted only. A row's order is (registry,
    file, sheet row), which linking goes by.
    """
    staging = staging or Staging(cells.sparkSession)
    specs = [registries.outpatient, registries.inpatient, registries.daily]
    sheets = read_columns(cells, specs, staging=staging)
    bronze = staging.table(
        reduce(
            DataFrame.unionByName,
            [
                _to_bronze(sheets[spec.sheet], source, rank, spec, registries.salt)
                for rank, (source, spec) in enumerate(zip(("seguimiento", "nominal"), specs))
            ],
        ),
        "bronze",
    )
    per_sheet = bronze.groupBy("fuente").agg(F.count("*").alias("n")).unionByName(
        sheets[registries.daily.sheet].agg(F.lit("red_negativa").alias("fuente"), F.count("*").alias("n"))
    )
    counts = {r["fuente"]: r["n"] for r in per_sheet.collect()}
    return bronze, {name: counts.get(name, 0) for name in ("seguimiento", "nominal", "red_negativa")}


def clean_cases(bronze: DataFrame, policy: DatePolicy = DEFAULT_DATES) -> DataFrame:
    """Typed cases, not yet linked, with what was repaired in each row.

    What is final is computed first, so that the raw cells it came from are not
    carried through the repairs. Store the result before filtering it: a filter pushed
    down through the repairs would repeat them.
    """
    results = synonym_catalog(RESULT_SYNONYMS)
    started = bronze.select(
        "row_order",
        "paciente_id",
        lookup(F.col("municipio_raw"), MUNICIPALITY_CATALOG, MUNICIPALITY_DEFAULT).alias(
            "municipio_residencia"
        ),
        default_if_empty(F.col("derechohabiencia_raw"), INSURANCE_BLANK).alias("derechohabiencia"),
        lookup(F.col("estatus_raw"), synonym_catalog(STATUS_SYNONYMS), UNSPECIFIED).alias(
            "estatus_paciente"
        ),
        F.col("hospital_raw").alias("hospital"),
        "edad_raw",
        "sexo_raw",
        "resultado_raw",
        "fecha_notificacion_raw",
        "fecha_toma_muestra_raw",
        "fecha_resultado_raw",
        "fecha_ingreso_raw",
    )
    aged = read_age_sex(started, "edad_raw", "sexo_raw").drop("edad_raw", "sexo_raw")
    date_cell = F.col("fecha_resultado_raw")
    marked = mark_swapped(aged, "resultado_raw", date_cell, "_swapped", policy)
    result, date_text = swap_if(F.col("_swapped"), F.col("resultado_raw"), date_cell["v"])
    repaired = marked.withColumns(
        {
            "resultado_prueba": lookup(result, results, UNSPECIFIED),
            "fecha_resultado_raw": F.struct(
                date_text.alias("v"), date_cell["kind"].alias("kind")
            ),
            "columnas_intercambiadas": F.col("_swapped")
            & (F.col("resultado_raw") != date_cell["v"]),
        }
    ).drop("_swapped", "resultado_raw")
    raw = {d: f"{d}_raw" for d in DATE_COLUMNS}
    raw["fecha_ingreso_hospital"] = "fecha_ingreso_raw"
    dated = read_dates(repaired, {d: F.col(column) for d, column in raw.items()}, policy)
    anomalies = sum((F.col(f"{d}.is_anomaly").cast("int") for d in DATE_COLUMNS), F.lit(0))
    typed = {
        **{d: F.col(f"{d}.value") for d in DATE_COLUMNS},
        "es_registro_unificado": F.lit(False),
        "dias_entre_notificacion_e_ingreso": F.lit(None).cast("int"),
    }
    return dated.select(
        "row_order",
        *[typed.get(c, F.col(c)).alias(c) for c in SILVER_COLUMNS],
        "columnas_intercambiadas",
        anomalies.alias("fechas_anomalas"),
    )


def unify_cases(
    cleaned: DataFrame, options: LinkOptions = LinkOptions(), staging: Staging | None = None
) -> DataFrame:
    """Linked cases in the stored layout, plus ``link_collided``."""
    linked = link_cases(
        cleaned.drop("columnas_intercambiadas", "fechas_anomalas"), options, staging
    )
    return linked.select(*SILVER_COLUMNS, "link_collided")
