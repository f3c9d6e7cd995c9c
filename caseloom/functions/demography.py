"""Age and sex cells, and the bins ages are reported in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.text import strip
from caseloom.settings import INF, UNKNOWN_AGE, Bins

_DIGITS = r"[0-9]+"


def parse_age(text: Column) -> Column:
    """Years; newborns and ages given in months or days are 0, no digits is null."""
    return _age(F.upper(strip(text)))


def parse_sex(text: Column) -> Column:
    return _sex(F.upper(strip(text)))


def _age(cell: Column) -> Column:
    infant = (cell == "RN") | cell.rlike(r"^[0-9]+\s*[MD]$")
    first_number = F.regexp_extract(cell, f"({_DIGITS})", 1).try_cast("double")
    return F.when(infant, F.lit(0.0)).otherwise(first_number)


def _sex(cell: Column) -> Column:
    return (
        F.when(cell.isNull() | (cell == ""), F.lit("INDETERMINADO"))
        .when(cell.isin("F", "M"), cell)
        .otherwise(F.lit("OTRO"))
    )


def read_age_sex(
    df: DataFrame, age: str, sex: str, age_output: str = "edad", sex_output: str = "sexo"
) -> DataFrame:
    """Add age and sex, exchanged first where the age cell holds a sex code while
    the sex cell looks like an age; an unknown age is -1."""
    cells = df.withColumns(
        {"_age": F.upper(strip(F.col(age))), "_sex": F.upper(strip(F.col(sex)))}
    )
    looks_like_age = (F.col("_sex") == "RN") | F.col("_sex").rlike(_DIGITS)
    swapped = F.coalesce(F.col("_age").isin("F", "M") & looks_like_age, F.lit(False))
    repaired = cells.withColumn("_swap", swapped).withColumns(
        {
            "_age": F.when(F.col("_swap"), F.col("_sex")).otherwise(F.col("_age")),
            "_sex": F.when(F.col("_swap"), F.col("_age")).otherwise(F.col("_sex")),
        }
    )
    return repaired.withColumns(
        {
            age_output: F.coalesce(_age(F.col("_age")), F.lit(UNKNOWN_AGE)),
            sex_output: _sex(F.col("_sex")),
        }
    ).drop("_age", "_sex", "_swap")


def age_by_sex_columns(female: Column, male: Column) -> Column:
    """One age/sex pair out of one age column per sex; the female column wins."""
    return F.struct(
        F.coalesce(female, male).alias("edad"),
        F.when(female.isNotNull(), F.lit("F"))
        .when(male.isNotNull(), F.lit("M"))
        .alias("sexo"),
    )


def bin_column(value: Column, bins: Bins) -> Column:
    """Label of the interval a number falls in; null, NaN and too low are ``missing``."""
    unknown = value.isNull() | F.isnan(value.cast("double")) | (value < bins.edges[0])
    label = F.when(unknown, F.lit(bins.missing))
    for upper, name in zip(bins.edges[1:-1], bins.labels):
        label = label.when(value <= upper if bins.right_closed else value < upper, F.lit(name))
    return label.otherwise(F.lit(bins.labels[-1]))


def intersecting_labels(first: Bins, second: Bins) -> list[tuple[str, str]]:
    """Label pairs one value can carry at the same time under two binnings."""

    def spans(bins: Bins):
        for i, (low, high) in enumerate(zip(bins.edges, bins.edges[1:])):
            low_in = not bins.right_closed or i == 0
            high_in = bins.right_closed or high == INF
            yield bins.labels[i], (low, low_in), (high, high_in)

    pairs = []
    for name, low_a, high_a in spans(first):
        for other, low_b, high_b in spans(second):
            low = max(low_a[0], low_b[0])
            high = min(high_a[0], high_b[0])
            touches = all(
                closed for edge, closed in (low_a, low_b) if edge == low
            ) and all(closed for edge, closed in (high_a, high_b) if edge == high)
            if low < high or (low == high and touches):
                pairs.append((name, other))
    pairs.append((first.missing, second.missing))
    return pairs


def pyramid_side(count: Column, sex: Column, left: str = "M") -> Column:
    """Counts of one side of a population pyramid are drawn to the left."""
    return F.when(sex == left, -count).otherwise(count)
