"""Dense daily series: counts on several date columns, moving mean, running total.

Everything after the daily aggregation works on the days of a bounded window
(some 1,500 rows), so the unpartitioned windows below stay small at any scale.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from caseloom.functions.measures import case_indicators
from caseloom.settings import DATE_COLUMNS, DEFAULT_DATES

Counters = Mapping[str, tuple[str, Column | None]]


def daily_counts(
    df: DataFrame,
    counters: Counters,
    first_day: date,
    last_day: date,
    date_columns: Sequence[str] | None = None,
    day: str = "fecha",
) -> DataFrame:
    """One row per day from the first to the last day any date column shows.

    ``counters`` maps an output to (date column, condition). Days outside the
    window are ignored. One scan and one shuffle: the date columns are unpivoted
    and the window's days enter the same aggregation as rows that count nothing.
    """
    columns = list(date_columns or dict.fromkeys(c for c, _ in counters.values()))
    flags = {
        name: F.lit(True) if condition is None else condition
        for name, (_, condition) in counters.items()
    }
    entries = [
        F.struct(
            F.to_date(column).alias("day"),
            *[
                (flags[name] if counters[name][0] == column else F.lit(False)).alias(name)
                for name in counters
            ],
        )
        for column in columns
    ]
    events = (
        df.select(F.explode(F.array(*entries)).alias("e"))
        .filter(F.col("e.day").between(F.lit(first_day), F.lit(last_day)))
        .select("e.*", F.lit(True).alias("_seen"))
    )
    days = F.sequence(F.lit(first_day), F.lit(last_day))
    calendar = df.sparkSession.range(1).select(
        F.explode(days).alias("day"),
        *[F.lit(False).alias(name) for name in counters],
        F.lit(False).alias("_seen"),
    )
    counted = (
        events.unionByName(calendar)
        .groupBy("day")
        .agg(
            *[F.count_if(name).alias(name) for name in counters],
            F.bool_or("_seen").alias("_seen"),
        )
    )
    active = F.when(F.col("_seen"), F.col("day"))
    everything = W.partitionBy()
    return (
        counted.withColumn("_first", F.min(active).over(everything))
        .withColumn("_last", F.max(active).over(everything))
        .filter(F.col("day").between(F.col("_first"), F.col("_last")))
        .select(F.col("day").alias(day), *counters)
    )


def moving_mean(column: str, day: str = "fecha", rows: int = 7) -> Column:
    """Mean over the trailing rows, over as many as there are at the start."""
    return F.avg(column).over(W.orderBy(day).rowsBetween(1 - rows, 0))


def running_total(column: str, day: str = "fecha") -> Column:
    return F.sum(column).over(W.orderBy(day).rowsBetween(W.unboundedPreceding, 0))


def case_series(
    cases: DataFrame,
    first_day: date = DEFAULT_DATES.first_day,
    last_day: date = DEFAULT_DATES.last_day,
) -> DataFrame:
    """The daily table of cases: six counts, 7-day mean and total of positives."""
    is_a = case_indicators()
    counters = {
        "casos_notificados": ("fecha_notificacion", None),
        "pruebas_tomadas": ("fecha_toma_muestra", None),
        "resultados_positivos": ("fecha_resultado", is_a["positive"]),
        "resultados_negativos": ("fecha_resultado", is_a["negative"]),
        "ingresos_hospitalarios": ("fecha_ingreso_hospital", None),
        "defunciones": ("fecha_notificacion", is_a["deceased"]),
    }
    daily = daily_counts(cases, counters, first_day, last_day, DATE_COLUMNS)
    return daily.select(
        "*",
        moving_mean("resultados_positivos").alias("media_movil_7d_positivos"),
        running_total("resultados_positivos").alias("casos_positivos_acumulados"),
    )


def weekly_rollup(daily: DataFrame, columns: Sequence[str], day: str = "fecha") -> DataFrame:
    """Sums per week, named by its Monday."""
    return daily.groupBy(F.trunc(day, "week").alias("semana")).agg(
        *[F.sum(c).alias(c) for c in columns]
    )


def date_bounds(df: DataFrame, columns: Sequence[str], first_day: date, last_day: date) -> DataFrame:
    """First and last day within the window over several date columns."""
    days = [F.to_date(c) for c in columns]
    inside = [F.when(d.between(F.lit(first_day), F.lit(last_day)), d) for d in days]
    low = F.array_min(F.array(*inside))
    high = F.array_max(F.array(*inside))
    return df.agg(F.min(low).alias("primer_dia"), F.max(high).alias("ultimo_dia"))


def is_inverted(earlier: str, later: str) -> Column:
    """Both dates are known and the later stage comes first."""
    return F.coalesce(F.col(later) < F.col(earlier), F.lit(False))


def inverted_dates(cases: DataFrame) -> DataFrame:
    """One row: results dated before their sample, admissions before notification."""
    return cases.agg(
        F.count_if(is_inverted("fecha_toma_muestra", "fecha_resultado")).alias(
            "casos_fechas_invertidas"
        ),
        F.count_if(is_inverted("fecha_notificacion", "fecha_ingreso_hospital")).alias(
            "ingresos_antes_de_notificacion"
        ),
    )


def null_inverted_lag(
    lag: str = "dias_entre_notificacion_e_ingreso",
    earlier: str = "fecha_notificacion",
    later: str = "fecha_ingreso_hospital",
) -> Column:
    """The lag, dropped where the stages are in the wrong order."""
    return F.when(~is_inverted(earlier, later), F.col(lag))


def undated_rows(cases: DataFrame, columns: Sequence[str] = DATE_COLUMNS) -> DataFrame:
    """One row: cases without each date, and without any."""
    nothing = F.coalesce(*[F.col(c) for c in columns]).isNull()
    return cases.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"sin_{c}") for c in columns],
        F.count_if(nothing).alias("sin_ninguna_fecha"),
    )


def mean_lags(cases: DataFrame) -> DataFrame:
    """One row: mean days between the stages of a case, where both are known."""

    def days(start: str, end: str) -> Column:
        return F.avg(F.datediff(F.to_date(end), F.to_date(start)).cast("double"))

    return cases.agg(
        days("fecha_notificacion", "fecha_toma_muestra").alias("dias_notificacion_muestra"),
        days("fecha_toma_muestra", "fecha_resultado").alias("dias_muestra_resultado"),
        days("fecha_notificacion", "fecha_ingreso_hospital").alias("dias_notificacion_ingreso"),
    )


