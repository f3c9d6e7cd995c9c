"""Time the headline queries and print one JSON line.

Reads ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``. Every query is run whole into
the ``noop`` sink, once to warm the JVM and then measured; session start-up is
reported apart from query time.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from caseloom.operators.scaling import Staging
from caseloom.operators.kpi import ViewFilter, kpi_view
from caseloom.operators.views import filter_demographic, filter_series
from caseloom.plans.gold import build_gold, check_gold, load_gold, write_gold
from caseloom.session import tune
from caseloom.settings import DatePolicy
from caseloom.workloads import proxy
from caseloom.workloads.queries import QUERIES

POLICY = DatePolicy(first_day=proxy.FIRST_DAY, last_day=proxy.LAST_DAY)
HEADLINE = (
    "daily_series",
    "daily_series_multi_date",
    "demographic_cube",
    "municipal_rates",
    "insurance_cube",
    "kpi_row",
    "kpi_row_from_base",
    "crosstab_age_result",
    "link_candidates_90_days",
    "link_greedy_90_days",
    "link_greedy_hot_keys",
    "clean_cases",
    "unified_cases",
    "parse_dates",
    "parse_age_sex",
    "normalize_text",
    "pseudonymize",
    "residence_cascade",
    "read_sheet",
    "reconciliation",
    "profile_top_values",
    "describe",
)


def all_tables(cases: DataFrame) -> None:
    """The five tables from stored cases, reconciled."""
    staging = Staging(cases.sparkSession)
    check_gold(cases, build_gold(cases, POLICY, staging), POLICY)
    staging.clear()


def first_load(spark: SparkSession, folder: str) -> None:
    """All stored tables read, and the unfiltered figures and series shown."""
    stored = load_gold(spark, folder)
    show(stored, ViewFilter(), True)


def re_filter(stored: dict[str, DataFrame | None]) -> None:
    """Figures and views again for days, a sex and an insurance, one after the other."""
    days = ViewFilter(first_day=date(1996, 1, 1), last_day=date(1997, 6, 30))
    for view in (days, ViewFilter(sexes=("F",)), ViewFilter(insurances=("IMSS",))):
        show(stored, view, False)


def show(stored: dict[str, DataFrame | None], view: ViewFilter, covers: bool) -> None:
    tables = (stored[k] for k in ("kpis", "series", "demographic", "insurance"))
    kpi_view(view, *tables, covers_all_days=covers).collect()
    filter_series(stored["series"], view.first_day, view.last_day).toArrow()
    filter_demographic(stored["demographic"], view.sexes, view.age_groups).toArrow()
    stored["municipal"].toArrow()


def timed(task: Callable[[], None]) -> float:
    """Seconds of the second of two runs."""
    task()
    start = time.perf_counter()
    task()
    return round(time.perf_counter() - start, 3)


def run_query(spark: SparkSession, sf: str, name: str) -> None:
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    start = time.perf_counter()
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("caseloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1).count()
    startup = time.perf_counter() - start
    seconds = {}
    for name in HEADLINE:
        seconds[name] = timed(partial(run_query, spark, sf, name))
    staging = Staging(tune(spark))
    cases = staging.table(proxy.cases(spark, sf), "cases")
    seconds["all_tables"] = timed(partial(all_tables, cases))
    folder = staging.path("gold")
    write_gold(build_gold(cases, POLICY, staging), folder)
    seconds["first_load"] = timed(partial(first_load, spark, folder))
    seconds["re_filter"] = timed(partial(re_filter, load_gold(spark, folder)))
    staging.clear()
    print(
        json.dumps(
            {
                "metric": "headline query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf.rstrip("/").rsplit("sf", 1)[-1],
                "startup_sec": round(startup, 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
