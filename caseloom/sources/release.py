"""Sets of tables that are checked while they are written and become visible at once.

A release writes its tables to a folder of its own, where no reader looks. Row
contracts are counted by the write itself and a table that breaks one is refused.
Only :meth:`Release.publish` makes the set known, by one manifest moved into place;
readers follow the newest manifest, so that a run that fails or is killed at any
moment leaves them the previous set, whole.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from caseloom.errors import IntegrityError
from caseloom.sources.tables import path_exists, write_summary, write_table

MANIFESTS = "_manifests"


def metrics_of(seen: Observation, df: DataFrame, asked: Mapping[str, Column]) -> dict[str, int]:
    """What was observed; counted by a scan where a table known to be empty was planned away."""
    try:
        return seen.get
    except Py4JJavaError:
        return df.agg(*[c.alias(name) for name, c in asked.items()]).first().asDict()


def write_checked(
    df: DataFrame,
    path: str,
    rules: Mapping[str, Column] | None = None,
    measures: Mapping[str, Column] | None = None,
    columns: Sequence[str] | None = None,
) -> dict[str, int]:
    """Write ``columns`` of a table and return what was observed on the way.

    That is the number of rows, ``filas``, and the aggregates ``measures``, each over all
    columns of ``df``. Rows that break one of ``rules``, or for which it is null, raise
    :class:`IntegrityError`; the table is then written, but nobody should read it. No
    further pass over the data is needed, and since a task of the last stage counts
    once however often it is repeated, the numbers survive lost executors.
    """
    counted = {
        f"viola_{name}": F.count_if(~F.coalesce(rule, F.lit(False)))
        for name, rule in (rules or {}).items()
    }
    asked = {"filas": F.count(F.lit(1)), **counted, **(measures or {})}
    seen = Observation()
    observed = df.observe(seen, *[c.alias(name) for name, c in asked.items()])
    write_table(observed.select(*(columns or df.columns)), path)
    found = metrics_of(seen, df, asked)
    broken = {name: found[name] for name in counted if found[name]}
    if broken:
        raise IntegrityError(f"{path.rsplit('/', 1)[-1]} breaks its row contract: {broken}")
    return {name: found[name] for name in ("filas", *(measures or {}))}


class Release:
    """A set of tables on its way to be published from ``folder``."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.name = uuid.uuid4().hex
        self.tables: dict[str, str] = {}

    def path(self, file: str, folder: str | None = None) -> str:
        return f"{(folder or self.folder).rstrip('/')}/release-{self.name}/{file}"

    def write(
        self,
        df: DataFrame,
        file: str,
        rules: Mapping[str, Column] | None = None,
        measures: Mapping[str, Column] | None = None,
        columns: Sequence[str] | None = None,
        folder: str | None = None,
    ) -> dict[str, int]:
        target = self.path(file, folder)
        found = write_checked(df, target, rules, measures, columns)
        self.tables[file] = target
        return found

    def write_summary(self, one_row: DataFrame, file: str, folder: str | None = None) -> None:
        target = self.path(file, folder)
        write_summary(one_row, target)
        self.tables[file] = target

    def publish(self) -> int:
        """Make all tables written so far visible; the number of the manifest."""
        number = max(_numbers(self.spark, self.folder), default=0) + 1
        text = json.dumps({"release": self.name, "tables": self.tables}, sort_keys=True)
        folder = f"{self.folder}/{MANIFESTS}"
        _move_in(self.spark, f"{folder}/.{self.name}", f"{folder}/{number:09d}.json", text)
        return number

    def discard(self) -> None:
        """Delete what was written, if it was not published."""
        folders = {self.path("").rstrip("/")} | {t.rsplit("/", 1)[0] for t in self.tables.values()}
        for folder in folders:
            path, files = _file_system(self.spark, folder)
            files.delete(path, True)


def published(spark: SparkSession, folder: str) -> dict[str, str] | None:
    """The tables of the newest manifest, by file name, or None where there is none."""
    numbers = _numbers(spark, folder)
    if not numbers:
        return None
    newest = f"{folder.rstrip('/')}/{MANIFESTS}/{max(numbers):09d}.json"
    return json.loads(spark.read.text(newest, wholetext=True).first()[0])["tables"]


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    where = f"{folder.rstrip('/')}/{MANIFESTS}"
    if not path_exists(spark, where):
        return []
    path, files = _file_system(spark, where)
    names = [status.getPath().getName() for status in files.listStatus(path)]
    return [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]


def _move_in(spark: SparkSession, draft: str, target: str, text: str) -> None:
    """Put a file in place at once, or fail if another run has put one there."""
    source, files = _file_system(spark, draft)
    out = files.create(source, True)
    out.write(bytearray(text.encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    no_overwrite = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        context.rename(source, hadoop.Path(target), no_overwrite)
    except Py4JJavaError as error:
        files.delete(source, False)
        raise IntegrityError(f"another run has published {target} meanwhile") from error
