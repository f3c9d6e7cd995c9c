"""Stored tables: checked and tolerant reads, Parquet and JSON writes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from caseloom.errors import SchemaMismatch


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_table(spark: SparkSession, path: str, required: Iterable[str]) -> DataFrame:
    """A Parquet table that must exist and have at least the required columns."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no table at {path}")
    df = spark.read.parquet(path)
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise SchemaMismatch(f"columns missing from {path}: {missing}")
    return df


def read_table_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or None where there is none or it cannot be read."""
    if not path_exists(spark, path):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def read_summary_or_none(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """A one-object JSON summary, or None where it is absent or not valid JSON."""
    if not path_exists(spark, path):
        return None
    guarded = StructType(list(schema.fields)).add("_corrupt_record", "string")
    summary = (
        spark.read.schema(guarded)
        .option("mode", "PERMISSIVE")
        .option("multiLine", True)
        .json(path)
    )
    rows = summary.limit(2).collect()
    if len(rows) != 1 or rows[0]["_corrupt_record"] is not None:
        return None
    return summary.drop("_corrupt_record")


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_summary(one_row: DataFrame, path: str) -> None:
    """A one-row table as one flat JSON object in UTF-8; null fields are kept."""
    one_row.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
