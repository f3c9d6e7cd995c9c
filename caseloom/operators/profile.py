"""Column profiles of an unknown table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from caseloom.operators.scaling import Staging, exact_quantiles

_NUMERIC = {"byte", "short", "integer", "long", "float", "double", "decimal"}


def column_nulls(df: DataFrame) -> DataFrame:
    """``(columna, tipo, filas, pct_nulos)`` for every column, in one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(c).alias(c) for c in df.columns],
    )
    entries = [
        F.struct(
            F.lit(name).alias("columna"),
            F.lit(dtype).alias("tipo"),
            F.col("_rows").alias("filas"),
            F.coalesce(F.try_divide(F.col("_rows") - F.col(name), F.col("_rows")), F.lit(0.0))
            .cast("double")
            .alias("pct_nulos"),
        )
        for name, dtype in df.dtypes
    ]
    return counted.select(F.inline(F.array(*entries)))


def top_values(df: DataFrame, columns: Sequence[str], k: int = 10) -> DataFrame:
    """``(columna, valor, n, puesto)``: the most frequent values of each column.

    Ranked after counting; a rank filter keeps ``k`` rows per column on every
    task before anything is brought together.
    """
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("columna"), F.col(c).cast("string").alias("valor"))
            for c in columns
        ]
    )
    counted = (
        df.select(F.explode(entries).alias("e"))
        .filter("e.valor IS NOT NULL")
        .groupBy("e.columna", "e.valor")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = W.partitionBy("columna").orderBy(F.desc("n"), "valor")
    return counted.withColumn("puesto", F.row_number().over(order)).filter(F.col("puesto") <= k)


def pattern_share(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """One row: share of rows whose text matches a pattern."""
    hit = F.coalesce(F.col(column).rlike(pattern), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("filas"),
        F.count_if(hit).alias("coinciden"),
        F.coalesce(F.avg(hit.cast("double")), F.lit(0.0)).alias("proporcion"),
    )


def describe(df: DataFrame, staging: Staging | None = None) -> DataFrame:
    """Numeric summary of every numeric column, with exact quartiles."""
    numeric = [f.name for f in df.schema.fields if f.dataType.typeName() in _NUMERIC]
    moments = df.agg(
        *[
            F.struct(
                F.count(c).alias("n"),
                F.avg(c).alias("media"),
                F.stddev_samp(c).alias("desviacion"),
                F.min(c).cast("double").alias("minimo"),
                F.max(c).cast("double").alias("maximo"),
            ).alias(c)
            for c in numeric
        ]
    )
    entries = F.array(
        *[F.struct(F.lit(c).alias("columna"), F.col(c).alias("m")) for c in numeric]
    )
    summary = moments.select(F.explode(entries).alias("e")).select("e.columna", "e.m.*")
    shares = {0.25: "p25", 0.5: "p50", 0.75: "p75"}
    quartiles = (
        exact_quantiles(df, numeric, list(shares), staging or Staging(df.sparkSession))
        .groupBy(F.col("column").alias("columna"))
        .agg(
            *[
                F.max(F.when(F.col("share") == share, F.col("value"))).alias(name)
                for share, name in shares.items()
            ]
        )
    )
    # both sides have one row per column
    return summary.join(quartiles, "columna", "left")
