"""Case indicators and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseloom.settings import DECEASED, HOSPITALISED, NEGATIVE, POSITIVE


def safe_rate(part: Column, whole: Column) -> Column:
    """``part / whole``; 0.0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def case_indicators(
    result: str = "resultado_prueba", status: str = "estatus_paciente"
) -> dict[str, Column]:
    """The boolean columns every table counts."""
    positive = F.col(result) == POSITIVE
    hospitalised = F.col(status) == HOSPITALISED
    deceased = F.col(status) == DECEASED
    return {
        "positive": positive,
        "negative": F.col(result) == NEGATIVE,
        "hospitalised": hospitalised,
        "deceased": deceased,
        "positive_hospitalised": positive & hospitalised,
        "positive_deceased": positive & deceased,
    }


def weighted_count(condition: Column | None = None, weight: str | None = None) -> Column:
    """Number of cases, or the sum of a weight when rows are pre-aggregated."""
    one = F.col(weight) if weight else F.lit(1)
    counted = one if condition is None else F.when(condition, one)
    return F.coalesce(F.sum(counted), F.lit(0)).cast("bigint")
