"""Whole runs over layers, and their exit codes."""

from __future__ import annotations

import sys
from dataclasses import dataclass, field
from typing import Literal

from pyspark.sql import SparkSession

from caseloom.errors import HeaderNotFound, IntegrityError, SchemaMismatch
from caseloom.operators.linkage import LinkOptions
from caseloom.operators.quality import (
    case_contract,
    cleaning_facts,
    linking_facts,
    one_date_contract,
    quality_summary,
)
from caseloom.operators.scaling import Staging
from caseloom.plans.gold import SILVER_FILE, load_silver, release_gold, utc_now
from caseloom.plans.silver import (
    SILVER_COLUMNS,
    Registries,
    clean_cases,
    ingest_registries,
    unify_cases,
)
from caseloom.session import tune
from caseloom.settings import DEFAULT_DATES, DatePolicy
from caseloom.sources.landing import CELL_COLUMNS
from caseloom.sources.release import Release, published, write_checked
from caseloom.sources.tables import read_table

QUALITY_FILE = "data_quality_summary.json"
OK, UNREADABLE, INCONSISTENT = 0, 1, 2


@dataclass(frozen=True)
class RunConfig:
    cells_path: str
    silver_folder: str
    registries: Registries
    gold_folder: str | None = None
    dates: DatePolicy = DEFAULT_DATES
    link: LinkOptions = field(default_factory=LinkOptions)
    staging_folder: str | None = None


def run(spark: SparkSession, config: RunConfig, layer: Literal["silver", "gold"] = "silver") -> int:
    """Landed cells to unified cases, and with ``layer="gold"`` on to the tables; an exit code.

    Tables are written to a release and published together, when the last of them is
    written and all add up; :func:`published_tables` finds them. ``UNREADABLE`` tells that
    the cells are missing or a sheet is not laid out as described, ``INCONSISTENT`` that
    rows broke a contract or tables did not add up; what was published before is then
    still there. Each layer is read back from what was written, so that later steps prune
    columns and a lost executor costs no more than its own tasks.
    """
    staging = Staging(tune(spark), config.staging_folder)
    release = Release(spark, config.silver_folder)
    code = OK
    try:
        _run(spark, config, layer, staging, release)
        release.publish()
    except (FileNotFoundError, HeaderNotFound, SchemaMismatch) as error:
        print(f"landed cells cannot be read: {error}", file=sys.stderr)
        code = UNREADABLE
    except IntegrityError as error:
        print(f"nothing was published: {error}", file=sys.stderr)
        code = INCONSISTENT
    finally:
        if code != OK:
            release.discard()
        staging.clear()
    return code


def _run(
    spark: SparkSession, config: RunConfig, layer: str, staging: Staging, release: Release
) -> None:
    cells = read_table(spark, config.cells_path, CELL_COLUMNS)
    bronze, counts = ingest_registries(cells, config.registries, staging)
    path = staging.path("cleaned")
    facts = write_checked(
        clean_cases(bronze, config.dates), path, one_date_contract(), cleaning_facts()
    )
    unified = unify_cases(spark.read.parquet(path), config.link, staging)
    facts |= release.write(
        unified, SILVER_FILE, case_contract(), linking_facts(), columns=SILVER_COLUMNS
    )
    if layer == "gold":
        folder = config.gold_folder or f"{config.silver_folder}/gold"
        cases = load_silver(spark, release.tables[SILVER_FILE])
        release_gold(cases, release, folder, config.dates, staging)
    summary = quality_summary(spark, counts["seguimiento"], counts["nominal"], facts)
    release.write_summary(summary.withColumn("timestamp_ejecucion", utc_now()), QUALITY_FILE)


def published_tables(spark: SparkSession, silver_folder: str) -> dict[str, str]:
    """Paths by file name of what the last complete run published."""
    found = published(spark, silver_folder)
    if found is None:
        raise FileNotFoundError(f"nothing was published from {silver_folder}")
    return found


def run_stored_silver(spark: SparkSession, silver_path: str, folder: str) -> int:
    """Tables from stored cases; the exit code tells what went wrong."""
    staging = Staging(tune(spark))
    try:
        cases = load_silver(spark, silver_path)
    except (FileNotFoundError, SchemaMismatch) as error:
        print(f"stored cases cannot be read: {error}", file=sys.stderr)
        return UNREADABLE
    release = Release(spark, folder)
    code = OK
    try:
        release_gold(cases, release, folder, staging=staging)
        release.publish()
    except IntegrityError as error:
        print(f"tables were not written: {error}", file=sys.stderr)
        code = INCONSISTENT
    finally:
        if code != OK:
            release.discard()
        staging.clear()
    return code
