"""Unified cases to the stored analytical tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from caseloom.operators import quality
from caseloom.operators.cubes import (
    BASE_COLUMNS,
    BASE_WEIGHT,
    case_base,
    demographic_cube,
    insurance_cube,
    municipal_table,
)
from caseloom.operators.kpi import kpi_row
from caseloom.operators.scaling import Staging, together
from caseloom.operators.series import case_series
from caseloom.plans.silver import SILVER_COLUMNS
from caseloom.settings import DEFAULT_DATES, DatePolicy
from caseloom.sources.release import Release, metrics_of, published
from caseloom.sources.tables import (
    read_table,
    read_table_or_none,
    write_summary,
    write_table,
)

# Names of the stored tables
TABLE_FILES = {
    "demographic": "metricas_demografia.parquet",
    "series": "series_temporales.parquet",
    "municipal": "distribucion_geografica.parquet",
    "insurance": "metricas_derechohabiencia.parquet",
    "kpis": "kpis_generales.parquet",
}
SUMMARY_FILE = "resumen_ejecutivo.json"
SILVER_FILE = "casos_unificados.parquet"


@dataclass(frozen=True)
class GoldTables:
    """The tables, and the totals of the cases they were computed from."""

    demographic: DataFrame
    series: DataFrame
    municipal: DataFrame
    insurance: DataFrame
    kpis: DataFrame
    totals: Mapping[str, int]


# Names of the tables in controls
_CONTROLLED = {
    "demographic": "demografia",
    "municipal": "geografia",
    "insurance": "derechohabiencia",
    "kpis": "kpis",
    "series": "series",
}
_CONTRACTS = {
    "demographic": quality.demographic_contract,
    "municipal": quality.municipal_contract,
    "insurance": quality.insurance_contract,
    "kpis": quality.kpi_contract,
    "series": quality.series_contract,
}


def plan_gold(
    cases: DataFrame, policy: DatePolicy = DEFAULT_DATES, staging: Staging | None = None
) -> GoldTables:
    """All tables from two scans of the cases: one for counts, one for days.

    The counts per combination of closed domains are stored once, with the cases'
    totals observed in that scan; cubes, municipal table and KPIs are computed from them.
    """
    staging = staging or Staging(cases.sparkSession)
    series = case_series(cases, policy.first_day, policy.last_day)
    seen = Observation()
    totals = quality.case_totals(policy.first_day, policy.last_day)
    # columns are not pruned through an observation
    observed = cases.select(*BASE_COLUMNS).observe(
        seen, *[c.alias(name) for name, c in totals.items()]
    )
    scans = together(
        {
            "base": lambda: staging.table(case_base(observed), "case-base"),
            "series": lambda: staging.table(series, "series"),
        }
    )
    base = scans["base"]
    return GoldTables(
        demographic=demographic_cube(base, weight=BASE_WEIGHT),
        municipal=municipal_table(base, BASE_WEIGHT),
        insurance=insurance_cube(base, BASE_WEIGHT),
        kpis=kpi_row(base, BASE_WEIGHT).withColumn("timestamp_generacion", utc_now()),
        series=scans["series"],
        totals=metrics_of(seen, cases, totals),
    )


def build_gold(
    cases: DataFrame, policy: DatePolicy = DEFAULT_DATES, staging: Staging | None = None
) -> GoldTables:
    """The tables of :func:`plan_gold`, stored: they are small and read again and again."""
    staging = staging or Staging(cases.sparkSession)
    planned = plan_gold(cases, policy, staging)
    names = ("demographic", "municipal", "insurance", "kpis")
    stored = together(
        {name: partial(staging.table, getattr(planned, name), name) for name in names}
    )
    return replace(planned, **stored)


def utc_now():
    now = F.convert_timezone(None, F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
    return F.concat(F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def _totals_again(cases: DataFrame, policy: DatePolicy) -> dict[str, int]:
    totals = quality.case_totals(policy.first_day, policy.last_day)
    return cases.agg(*[c.alias(name) for name, c in totals.items()]).first().asDict()


def _assert_reconciled(
    cases: DataFrame,
    totals: Mapping[str, int],
    measured: Mapping[str, Mapping[str, int]],
    policy: DatePolicy,
) -> None:
    """The totals were observed ahead of a shuffle, where tasks repeated for a lost
    executor count again: before tables are refused the cases are counted once more."""
    if quality.wrong_controls(quality.controls(totals, measured)):
        totals = _totals_again(cases, policy)
    quality.assert_reconciled(quality.controls(totals, measured))


def check_gold(cases: DataFrame, tables: GoldTables, policy: DatePolicy = DEFAULT_DATES) -> None:
    """Fail unless every table adds up to the cases."""
    totals = quality.table_totals()

    def measure(name: str) -> dict[str, int]:
        wanted = totals[_CONTROLLED[name]]
        return getattr(tables, name).agg(*[c.alias(k) for k, c in wanted.items()]).first().asDict()

    found = together({_CONTROLLED[name]: partial(measure, name) for name in _CONTROLLED})
    _assert_reconciled(cases, tables.totals, found, policy)


def write_gold(tables: GoldTables, folder: str) -> None:
    writes = {
        name: partial(write_table, getattr(tables, name), f"{folder}/{file}")
        for name, file in TABLE_FILES.items()
    }
    writes["summary"] = partial(write_summary, tables.kpis, f"{folder}/{SUMMARY_FILE}")
    together(writes)


def release_gold(
    cases: DataFrame,
    release: Release,
    folder: str,
    policy: DatePolicy = DEFAULT_DATES,
    staging: Staging | None = None,
) -> None:
    """Write all tables into a release, each checked by its own write, and reconcile them.

    Totals are observed on the way to the file, so no table is read again.
    """
    tables = plan_gold(cases, policy, staging)
    totals = quality.table_totals()

    def write(name: str) -> dict[str, int]:
        wanted = totals[_CONTROLLED[name]]
        found = release.write(
            getattr(tables, name), TABLE_FILES[name], _CONTRACTS[name](), wanted, folder=folder
        )
        return {k: found[k] for k in wanted}

    written = together({name: partial(write, name) for name in TABLE_FILES})
    measured = {_CONTROLLED[name]: found for name, found in written.items()}
    _assert_reconciled(cases, tables.totals, measured, policy)
    stored = cases.sparkSession.read.parquet(release.tables[TABLE_FILES["kpis"]])
    release.write_summary(stored, SUMMARY_FILE, folder)


def load_silver(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, SILVER_COLUMNS)


def load_gold(spark: SparkSession, folder: str) -> dict[str, DataFrame | None]:
    """Every stored table that can be read; each one may be missing on its own."""
    paths = published(spark, folder) or {}
    return {
        name: read_table_or_none(spark, paths.get(file, f"{folder}/{file}"))
        for name, file in TABLE_FILES.items()
    }
