"""Case tables by age and sex, by municipality and by insurance.

Each table is one hash aggregation over the cases. All can also be computed from
``case_base``: one scan of the cases reduced to counts per combination of closed
domains, passed on with ``weight``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from caseloom.functions.demography import bin_column, intersecting_labels, pyramid_side
from caseloom.functions.measures import case_indicators, safe_rate, weighted_count
from caseloom.functions.text import insurance_group
from caseloom.operators.series import is_inverted
from caseloom.settings import (
    AGE_BINS,
    DISPLAY_AGE_BINS,
    INSURANCE_CATALOG,
    INSURANCE_NULL,
    INSURANCE_OTHER,
    NEGATIVE,
    POSITIVE,
    Bins,
)

BASE_WEIGHT = "n_casos"
_CASE_CELL = ["sexo", "resultado_prueba", "estatus_paciente"]


def age_groups(
    age: str = "edad", bins: Bins = AGE_BINS, display: Bins = DISPLAY_AGE_BINS
) -> tuple[Column, Column]:
    return (
        bin_column(F.col(age), bins).alias("grupo_edad"),
        bin_column(F.col(age), display).alias("grupo_edad_ui"),
    )


def insurance(column: str = "derechohabiencia") -> Column:
    return insurance_group(F.col(column), INSURANCE_CATALOG, INSURANCE_NULL, INSURANCE_OTHER)


# What the counts are made of
BASE_COLUMNS = (
    "edad",
    "sexo",
    "resultado_prueba",
    "estatus_paciente",
    "municipio_residencia",
    "derechohabiencia",
    "es_registro_unificado",
    "dias_entre_notificacion_e_ingreso",
    "fecha_toma_muestra",
    "fecha_resultado",
)


def case_base(cases: DataFrame) -> DataFrame:
    """Counts per combination of everything the tables and KPIs look at.

    All dimensions come from closed catalogs (the lag is bounded by the link
    window), so the result is small however many cases there are.
    """
    return (
        cases.select(
            *age_groups(),
            *_CASE_CELL,
            "municipio_residencia",
            insurance().alias("derechohabiencia"),
            "es_registro_unificado",
            "dias_entre_notificacion_e_ingreso",
            is_inverted("fecha_toma_muestra", "fecha_resultado").alias("fechas_invertidas"),
        )
        .groupBy(
            "grupo_edad",
            "grupo_edad_ui",
            *_CASE_CELL,
            "municipio_residencia",
            "derechohabiencia",
            "es_registro_unificado",
            "dias_entre_notificacion_e_ingreso",
            "fechas_invertidas",
        )
        .agg(F.count(F.lit(1)).alias(BASE_WEIGHT))
    )


def _share_of_all(count: str = "total_casos") -> Column:
    # over the finished table, whose rows the closed domains bound
    return safe_rate(F.col(count), F.sum(count).over(W.partitionBy()))


def _group_rate(
    group: Sequence[str], part: Column, whole: Column, count: str = "total_casos"
) -> Column:
    window = W.partitionBy(*group)

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col(count)).otherwise(0)).over(window)

    return safe_rate(total(part), total(whole))


def demographic_cube(
    cases: DataFrame,
    bins: Bins = AGE_BINS,
    display: Bins = DISPLAY_AGE_BINS,
    weight: str | None = None,
) -> DataFrame:
    """Counts by age group, display age group, sex, result and status.

    Every age group is present, with zeros: all label pairs one age can carry,
    for each (sex, result, status) seen. The counts of a combination are put in
    a map of at most as many entries as there are pairs, and read off by pair.
    """
    labelled = cases
    if weight is None:
        labelled = cases.select(*age_groups(bins=bins, display=display), *_CASE_CELL)
    observed = labelled.groupBy("grupo_edad", "grupo_edad_ui", *_CASE_CELL).agg(
        weighted_count(weight=weight).alias("total_casos")
    )
    pair = F.struct("grupo_edad", "grupo_edad_ui")
    pairs = F.array(
        *[
            F.struct(F.lit(a).alias("grupo_edad"), F.lit(b).alias("grupo_edad_ui"))
            for a, b in intersecting_labels(bins, display)
        ]
    )
    counts = observed.groupBy(*_CASE_CELL).agg(
        F.map_from_entries(F.collect_list(F.struct(pair, F.col("total_casos")))).alias("counts")
    )
    cells = counts.withColumn("pair", F.explode(pairs)).select(
        "pair.grupo_edad",
        "pair.grupo_edad_ui",
        *_CASE_CELL,
        F.coalesce(F.try_element_at("counts", F.col("pair")), F.lit(0)).alias("total_casos"),
    )
    is_a = case_indicators()
    return cells.select(
        "*",
        _share_of_all().alias("porcentaje_del_total"),
        _group_rate(
            ["grupo_edad", "sexo"], is_a["positive"], is_a["positive"] | is_a["negative"]
        ).alias("tasa_positividad_grupo"),
    )


def municipal_table(cases: DataFrame, weight: str | None = None) -> DataFrame:
    """Counts and rates per municipality; severity rates are among positives."""
    is_a = case_indicators()
    counted = cases.groupBy("municipio_residencia").agg(
        weighted_count(weight=weight).alias("total_casos"),
        weighted_count(is_a["positive"], weight).alias("total_positivos"),
        weighted_count(is_a["negative"], weight).alias("total_negativos"),
        weighted_count(is_a["hospitalised"], weight).alias("total_hospitalizados"),
        weighted_count(is_a["deceased"], weight).alias("total_defunciones"),
        weighted_count(is_a["positive_deceased"], weight).alias("_deceased"),
        weighted_count(is_a["positive_hospitalised"], weight).alias("_hospitalised"),
    )
    positives = F.col("total_positivos")
    return counted.select(
        "*",
        safe_rate(positives, positives + F.col("total_negativos")).alias("tasa_positividad"),
        safe_rate(F.col("_deceased"), positives).alias("tasa_letalidad"),
        safe_rate(F.col("_hospitalised"), positives).alias("tasa_hospitalizacion"),
    ).drop("_deceased", "_hospitalised")


def insurance_cube(cases: DataFrame, weight: str | None = None) -> DataFrame:
    """Counts by insurance, result and status, with three rates per insurance."""
    cell = ["derechohabiencia", "resultado_prueba", "estatus_paciente"]
    labelled = cases
    if weight is None:
        labelled = cases.select(insurance().alias("derechohabiencia"), *cell[1:])
    counted = labelled.groupBy(*cell).agg(weighted_count(weight=weight).alias("total_casos"))
    is_a = case_indicators()
    group = ["derechohabiencia"]
    return counted.select(
        "*",
        _share_of_all().alias("porcentaje_del_total"),
        _group_rate(group, is_a["positive"], is_a["positive"] | is_a["negative"]).alias(
            "tasa_positividad_grupo"
        ),
        _group_rate(group, is_a["positive_hospitalised"], is_a["positive"]).alias(
            "tasa_hospitalizacion_grupo"
        ),
        _group_rate(group, is_a["positive_deceased"], is_a["positive"]).alias(
            "tasa_letalidad_grupo"
        ),
    )


def pyramid(cube: DataFrame, with_unknown: bool = True) -> DataFrame:
    """Cases by display age and sex, one sex counted to the left."""
    known = cube if with_unknown else cube.filter(F.col("grupo_edad_ui") != "SIN_DATO")
    summed = known.groupBy("grupo_edad_ui", "sexo").agg(F.sum("total_casos").alias("total_casos"))
    return summed.withColumn(
        "casos_mostrados", pyramid_side(F.col("total_casos"), F.col("sexo"))
    )


def unknown_age_cases(cube: DataFrame) -> DataFrame:
    """One row: cases a pyramid without unknown ages leaves out."""
    return cube.filter(F.col("grupo_edad_ui") == "SIN_DATO").agg(
        F.coalesce(F.sum("total_casos"), F.lit(0)).alias("casos_sin_dato")
    )


def positivity_by_age(cube: DataFrame) -> DataFrame:
    """Positivity per display age out of a (filtered) cube, from counts, not rates."""
    result, count = F.col("resultado_prueba"), F.col("total_casos")
    summed = cube.groupBy("grupo_edad_ui").agg(
        F.sum(F.when(result == POSITIVE, count).otherwise(0)).alias("casos_positivos"),
        F.sum(F.when(result == NEGATIVE, count).otherwise(0)).alias("casos_negativos"),
    )
    positives = F.col("casos_positivos")
    return summed.withColumn(
        "tasa_positividad", safe_rate(positives, positives + F.col("casos_negativos"))
    )


def value_counts(df: DataFrame, column: str, output: str = "n") -> DataFrame:
    """Rows per value of a column, the most frequent first."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias(output))
    return counted.orderBy(F.desc(output), column)


def crosstab(
    df: DataFrame,
    rows: str,
    columns: str,
    row_domain: Sequence[str],
    column_domain: Sequence[str],
    names: Mapping[str, str] | None = None,
    other: str | None = None,
) -> DataFrame:
    """Counts of a closed row domain by a closed column domain, zeros included.

    The aggregation has one count per column value, so there is a single
    shuffle and no pass to find the values; absent rows come from the domain.
    With ``other`` a row and a column of that name hold all values outside the
    domains, nulls too, so that the counts add up to the rows there are.
    """
    names = names or {}
    row, column = F.col(rows), F.col(columns)
    if other is not None:
        row_domain, column_domain = [*row_domain, other], [*column_domain, other]
        row = F.when(row.isin(*row_domain), row).otherwise(other)
        column = F.when(column.isin(*column_domain), column).otherwise(other)
    domain = df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(value) for value in row_domain])).alias(rows),
        F.lit(None).cast("string").alias(columns),
    )
    counted = (
        df.select(row.alias(rows), column.alias(columns))
        .filter(F.col(rows).isin(*row_domain))
        .unionByName(domain)
    )
    return counted.groupBy(rows).agg(
        *[
            F.count_if(F.col(columns) == value).alias(names.get(value, value))
            for value in column_domain
        ]
    )


def crosstabs(
    df: DataFrame,
    tables: Mapping[str, tuple[str, str]],
    domains: Mapping[str, Sequence[str]],
    other: str | None = None,
) -> DataFrame:
    """``(tabla, fila, columna, n)``: several crosstabs of one table from one scan of it.

    ``tables`` names the row and the column of each, ``domains`` the values every column
    may have; pairs nobody has are there with 0. Counts come from grouping sets: each row
    is expanded to one per table ahead of the partial counts, which closed domains keep
    small. With ``other`` a value of that name holds all outside the domains, nulls too;
    else rows with such values are in the tables of other columns only.
    """
    used = list(dict.fromkeys(c for pair in tables.values() for c in pair))

    def closed(column: str) -> Column:
        value = F.col(column)
        inside = value.isin(*domains[column])
        return F.when(inside, value).otherwise(F.lit(other)).alias(column)

    narrow = df.select(*[closed(c) for c in used])

    def number(pair: tuple[str, str]) -> int:
        """The grouping id: a bit for each column left out, the first one highest."""
        return sum(1 << (len(used) - 1 - i) for i, c in enumerate(used) if c not in pair)

    # a table and its transpose come from the same counts
    sets = {number(pair): [F.col(c) for c in pair] for pair in tables.values()}
    counted = narrow.groupingSets(list(sets.values()), *used).agg(
        F.grouping_id().alias("which"), F.count(F.lit(1)).alias("n")
    )

    def both(name: str) -> tuple[list[str], list[str]]:
        more = [] if other is None else [other]
        return tuple([*domains[c], *more] for c in tables[name])

    cells = F.array(
        *[
            F.struct(F.lit(name).alias("tabla"), F.lit(number(pair)).alias("which"), F.col(pair[0]).alias("fila"), F.col(pair[1]).alias("columna"))
            for name, pair in tables.items()
        ]
    )
    found = (
        counted.select("n", "which", F.explode(F.filter(cells, lambda c: c["which"] == F.col("which"))).alias("c"))
        .select("c.tabla", "c.fila", "c.columna", "n")
        .filter("fila IS NOT NULL AND columna IS NOT NULL")
    )
    pairs = [
        F.struct(F.lit(name).alias("tabla"), F.lit(r).alias("fila"), F.lit(c).alias("columna"), F.lit(0).cast("bigint").alias("n"))
        for name in tables
        for r in both(name)[0]
        for c in both(name)[1]
    ]
    zeros = df.sparkSession.range(1).select(F.inline(F.array(*pairs)))
    return found.unionByName(zeros).groupBy("tabla", "fila", "columna").agg(F.sum("n").alias("n"))
