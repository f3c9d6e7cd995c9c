"""Registries landed as cells: find headers, bound the data, resolve columns.

A landed workbook is a long table ``(file, sheet, r, c, v, kind)`` with rows and
columns counted from 1; blank cells are absent or null. All functions work on
many workbooks at once. What is gathered per sheet is the header block and the
rows that hold a header's key; data rows are never gathered by sheet.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from caseloom.errors import HeaderNotFound
from caseloom.functions.text import starts_with_word, strip
from caseloom.operators.scaling import Staging, join_checked
from caseloom.settings import SheetSpec

CELL_SCHEMA = "file string, sheet string, r int, c int, v string, kind string"
CELL_COLUMNS = ("file", "sheet", "r", "c", "v", "kind")
SHEET_KEY = ["file", "sheet"]
LEVEL_SEPARATOR = " | "


def _within(column: str, limit: int | None) -> Column:
    return F.lit(True) if limit is None else F.col(column) <= limit


def find_headers(
    cells: DataFrame,
    keys: Sequence[str],
    header_rows: int,
    search_rows: int | None = None,
    search_columns: int | None = None,
) -> DataFrame:
    """``(file, sheet, header_row)``: first row of each sheet's header block.

    The first key must stand in that row, every key somewhere in the block; the whole
    block lies in the first ``search_rows`` and ``search_columns``, if they are given.
    ``header_row`` is null for sheets without one. Only rows that hold a key are
    compared with their neighbours, so a long sheet is no large group.
    """
    found = [f"_k{i}" for i in range(len(keys))]
    sheets = cells.filter(F.col("v").isNotNull()).select(*SHEET_KEY).distinct()
    holds_key = F.lit(False)
    for key in keys:
        holds_key = holds_key | starts_with_word(F.col("v"), key)
    rows = (
        cells.filter(
            F.col("v").isNotNull() & _within("r", search_rows) & _within("c", search_columns) & holds_key
        )
        .groupBy(*SHEET_KEY, "r")
        .agg(*[F.bool_or(starts_with_word(F.col("v"), k)).alias(n) for k, n in zip(keys, found)])
    )
    block = W.partitionBy(*SHEET_KEY).orderBy("r").rangeBetween(0, header_rows - 1)
    complete = F.col(found[0])
    if search_rows is not None:
        complete = complete & (F.col("r") + header_rows - 1 <= search_rows)
    in_block = rows.select(
        *SHEET_KEY,
        "r",
        found[0],
        *[F.bool_or(n).over(block).alias(f"{n}_block") for n in found],
    )
    for name in found:
        complete = complete & F.col(f"{name}_block")
    placed = in_block.groupBy(*SHEET_KEY).agg(F.min(F.when(complete, F.col("r"))).alias("header_row"))
    return sheets.join(placed, SHEET_KEY, "left")


def assert_headers(headers: DataFrame, what: str) -> DataFrame:
    """Fail if a sheet has no header block; otherwise the headers."""
    lost = headers.filter("header_row IS NULL").select(*SHEET_KEY).limit(5).collect()
    if lost:
        sheets = ", ".join(f"{r.file!r}/{r.sheet!r}" for r in lost)
        raise HeaderNotFound(f"no header block with {what} in: {sheets}")
    return headers


def flatten_headers(
    cells: DataFrame, headers: DataFrame, header_rows: int, search_columns: int | None = None
) -> DataFrame:
    """``(file, sheet, header_row, c, name)``: one flat name per column.

    Within a level a value covers the blank cells to its right, up to a column
    where this or an upper level has a value of its own. Columns right of the
    last value are no columns. Levels are joined, repeats dropped.
    """
    placed = headers.filter("header_row IS NOT NULL")
    block = (
        join_checked(
            cells.filter(_within("c", search_columns) & F.col("v").isNotNull()), placed, SHEET_KEY
        )
        .withColumn("_level", F.col("r") - F.col("header_row"))
        .filter((F.col("_level") >= 0) & (F.col("_level") < header_rows))
    )
    levels = [f"_l{i}" for i in range(header_rows)]
    own = block.groupBy(*SHEET_KEY, "header_row", "c").agg(
        *[
            F.max(F.when(F.col("_level") == i, strip(F.col("v")))).alias(n)
            for i, n in enumerate(levels)
        ]
    )
    # Blank columns inside the header come back: one row per column up to the last
    order = W.partitionBy(*SHEET_KEY).orderBy("c")
    following = F.coalesce(F.lead("c").over(order), F.col("c") + 1)
    previous = F.lag("c").over(order)
    first_gap = F.when(previous.isNull(), F.lit(1)).otherwise(F.col("c"))
    dense = own.withColumn("_span", F.sequence(first_gap, following - 1)).select(
        *SHEET_KEY, "header_row", F.explode("_span").alias("_c"), "c", *levels
    )
    is_own = F.col("_c") == F.col("c")
    filled = dense.select(
        *SHEET_KEY,
        "header_row",
        F.col("_c").alias("c"),
        *[F.when(is_own, F.col(n)).alias(n) for n in levels],
    )
    so_far = order.rowsBetween(W.unboundedPreceding, 0)
    upper = F.lit(False)
    parts = []
    for name in levels:
        # A null inside the struct resets the fill, a null struct continues it
        mark = F.when(F.col(name).isNotNull() | upper, F.struct(F.col(name).alias("text")))
        parts.append(F.last(mark, ignorenulls=True).over(so_far)["text"])
        upper = upper | F.col(name).isNotNull()
    named = filled.select(
        *SHEET_KEY, "header_row", "c", F.array_compact(F.array(*parts)).alias("_parts")
    )
    text = F.concat_ws(LEVEL_SEPARATOR, F.array_distinct("_parts"))
    blank = F.concat(F.lit("__col_"), (F.col("c") - 1).cast("string"), F.lit("__"))
    return named.select(
        *SHEET_KEY, "header_row", "c", F.when(F.length(text) > 0, text).otherwise(blank).alias("name")
    )


def key_columns(names: DataFrame, key: str) -> DataFrame:
    """``(file, sheet, header_row, key_c, width)``: the column of the first key."""
    return names.groupBy(*SHEET_KEY, "header_row").agg(
        F.min(F.when(starts_with_word(F.col("name"), key), F.col("c"))).alias("key_c"),
        F.max("c").alias("width"),
    )


def bound_rows(
    cells: DataFrame, key_cols: DataFrame, header_rows: int, blank_rows: int | None = None
) -> DataFrame:
    """``(file, sheet, first_row, stop_row, key_c, width)``: the run of data rows.

    Rows with a blank key, up to ``blank_rows`` if given, are skipped after the header; the data end
    before the first blank key after that, whatever stray cells follow. The run
    is found from row pairs, so a sheet of any length is spread over tasks.
    """
    start = F.col("header_row") + header_rows
    filled = (
        join_checked(
            cells.filter(F.col("v").isNotNull()),
            key_cols.withColumnRenamed("key_c", "c"),
            [*SHEET_KEY, "c"],
        )
        .filter(F.col("r") >= start)
    )
    runs = _runs(filled, [*SHEET_KEY, "header_row", "c", "width"])
    near = F.lit(True) if blank_rows is None else F.col("first_row") <= start + blank_rows
    return runs.filter(near & F.col("first_row").isNotNull()).select(
        *SHEET_KEY, "first_row", "stop_row", F.col("c").alias("key_c"), "width"
    )


def _runs(filled: DataFrame, sheet: Sequence[str]) -> DataFrame:
    """``first_row`` with a key and the first row after it without, from rows with a key."""
    edges = (
        filled.select(
            *sheet,
            F.explode(
                F.array(
                    F.struct(F.col("r"), F.lit(True).alias("here")),
                    F.struct((F.col("r") + 1).alias("r"), F.lit(False).alias("here")),
                )
            ).alias("e"),
        )
        .groupBy(*sheet, F.col("e.r").alias("r"))
        .agg(F.bool_or("e.here").alias("here"))
    )
    return edges.groupBy(*sheet).agg(
        F.min(F.when(F.col("here"), F.col("r"))).alias("first_row"),
        F.min(F.when(~F.col("here"), F.col("r"))).alias("stop_row"),
    )


def resolve_columns(names: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """``(file, sheet, logical, c)``: first column whose name starts with the prefix.

    A prefix is compared with every level of the name, or with the whole name
    if it spells out several levels. Logical names nothing matches are absent.
    """
    wanted = F.array(
        *[
            F.struct(
                F.lit(logical).alias("logical"),
                F.lit(prefix.upper()).alias("prefix"),
                F.lit(LEVEL_SEPARATOR in prefix).alias("whole"),
            )
            for logical, prefix in columns
        ]
    )
    name = F.upper("name")
    by_level = F.exists(
        F.split(name, r" \| "), lambda part: strip(part).startswith(F.col("w.prefix"))
    )
    matches = F.when(F.col("w.whole"), name.startswith(F.col("w.prefix"))).otherwise(by_level)
    return (
        names.withColumn("w", F.explode(wanted))
        .filter(matches)
        .groupBy(*SHEET_KEY, F.col("w.logical").alias("logical"))
        .agg(F.min("c").alias("c"))
    )


def read_rows(cells: DataFrame, bounds: DataFrame) -> DataFrame:
    """The cells of the data block: rows and columns within their bounds."""
    return (
        join_checked(cells.filter(F.col("v").isNotNull()), bounds, SHEET_KEY)
        .filter(
            (F.col("r") >= F.col("first_row"))
            & (F.col("r") < F.col("stop_row"))
            & (F.col("c") <= F.col("width"))
        )
        .drop("first_row", "stop_row", "width")
    )


def _layout(
    cells: DataFrame, spec: SheetSpec, staging: Staging
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The sheet's cells, and its stored headers, column names and bounds."""
    sheet = cells.filter(F.col("sheet") == spec.sheet)
    headers = staging.table(
        find_headers(sheet, spec.keys, spec.header_rows, spec.search_rows, spec.search_columns),
        "headers",
    )
    names = staging.table(
        flatten_headers(sheet, headers, spec.header_rows, spec.search_columns), "names"
    )
    keys = key_columns(names, spec.keys[0])
    bounds = staging.table(bound_rows(sheet, keys, spec.header_rows, spec.blank_rows), "bounds")
    return sheet, headers, names, bounds


# Why cells of a sheet are not in its data rows
REASONS = ("no_header", "header", "no_data", "after_data", "beyond_columns")


def sheet_rejects(cells: DataFrame, spec: SheetSpec, staging: Staging | None = None) -> DataFrame:
    """``(file, sheet, reason, cells)``: all non-blank cells of a sheet, counted by what became of them.

    ``kept`` cells are those :func:`read_sheet` reads its rows from; the others have one
    of :data:`REASONS`, so the counts add up to the cells landed. ``header`` is the
    header itself and what stands above the data, ``no_data`` what follows a header
    without a data row, ``after_data`` what follows the first blank key.
    """
    staging = staging or Staging(cells.sparkSession)
    sheet, headers, _, bounds = _layout(cells, spec, staging)
    facts = headers.join(bounds, SHEET_KEY, "left").select(
        *SHEET_KEY, "header_row", "first_row", "stop_row", "width"
    )
    row = F.col("r")
    reason = (
        F.when(F.col("header_row").isNull(), "no_header")
        .when(row < F.coalesce("first_row", F.col("header_row") + spec.header_rows), "header")
        .when(F.col("first_row").isNull(), "no_data")
        .when(row >= F.col("stop_row"), "after_data")
        .when(F.col("c") > F.col("width"), "beyond_columns")
        .otherwise("kept")
    )
    placed = join_checked(sheet.filter(F.col("v").isNotNull()), facts, SHEET_KEY)
    return (
        placed.select(*SHEET_KEY, reason.alias("reason"))
        .groupBy(*SHEET_KEY, "reason")
        .agg(F.count(F.lit(1)).alias("cells"))
    )


def _sheet_rows(cells: DataFrame, specs: Sequence[SheetSpec]) -> DataFrame:
    """``(file, sheet, r, _k0, _k1, ..., cells)``: described sheets by row, from one scan of the cells.

    ``cells`` holds a row's cells by column; one landed twice counts by its smallest value.
    ``_k0`` tells whether the row holds the sheet's first key, and so on.
    """
    some_key = F.lit(False)
    for word in sorted({k.upper() for s in specs for k in s.keys}):
        some_key = some_key | F.contains(F.col("_upper"), F.lit(word))
    grouped = (
        cells.withColumn("_upper", F.upper("v"))
        .select(*SHEET_KEY, "r", F.struct("c", "v", "kind").alias("_cell"), some_key.alias("_some"))
        .groupBy(*SHEET_KEY, "r")
        .agg(
            F.bool_or("_some").alias("_some"),
            # a set is compared by a given function in array_sort, by the engine's own order here
            F.sort_array(F.collect_set("_cell")).alias("cells"),
        )
    )

    def holds(i: int) -> Column:
        """Next to no row has a key's text in it: which key it holds, and where, is asked of those alone."""

        def here(cell: Column) -> Column:
            flag = F.lit(False)
            for spec in specs:
                if i < len(spec.keys):
                    inside = F.lit(True)
                    if spec.search_columns is not None:
                        inside = cell["c"] <= spec.search_columns
                    own = _within("r", spec.search_rows) & inside
                    own = own & starts_with_word(cell["v"], spec.keys[i])
                    flag = F.when(F.col("sheet") == spec.sheet, own).otherwise(flag)
            return F.coalesce(flag, F.lit(False))

        return F.when(F.col("_some"), F.exists("cells", here)).otherwise(False)

    flags = [holds(i).alias(f"_k{i}") for i in range(max(len(s.keys) for s in specs))]
    return grouped.select(*SHEET_KEY, "r", *flags, "cells")


def _find_all_headers(rows: DataFrame, specs: Sequence[SheetSpec], staging: Staging) -> DataFrame:
    """``(file, sheet, header_row, header_rows)`` of all described sheets, from their stored rows.

    Rows that hold a key, few in a sheet, are stored with what they hold; a sheet
    without any is there as one row without a number.
    """
    flags = [c for c in rows.columns if c.startswith("_k")]
    any_key = reduce(Column.__or__, [F.col(c) for c in flags])
    key_rows = staging.table(
        rows.select(*SHEET_KEY, F.when(any_key, F.col("r")).alias("r"), *flags)
        .groupBy(*SHEET_KEY, "r")
        .agg(*[F.bool_or(c).alias(c) for c in flags]),
        "key-rows",
    )
    found = []
    for spec in specs:
        block = W.partitionBy(*SHEET_KEY).orderBy("r").rangeBetween(0, spec.header_rows - 1)
        complete = F.col("_k0") & F.col("r").isNotNull()
        if spec.search_rows is not None:
            complete = complete & (F.col("r") + spec.header_rows - 1 <= spec.search_rows)
        in_block = key_rows.filter(F.col("sheet") == spec.sheet).withColumns(
            {f"_b{i}": F.bool_or(f"_k{i}").over(block) for i in range(len(spec.keys))}
        )
        for i in range(len(spec.keys)):
            complete = complete & F.col(f"_b{i}")
        found.append(
            in_block.groupBy(*SHEET_KEY).agg(
                F.min(F.when(complete, F.col("r"))).alias("header_row"),
                F.lit(spec.header_rows).alias("header_rows"),
            )
        )
    return staging.table(reduce(DataFrame.unionByName, found), "headers")


def _all_layouts(
    rows: DataFrame, headers: DataFrame, specs: Sequence[SheetSpec], staging: Staging
) -> DataFrame:
    """One row per sheet: ``(file, sheet, first, key_c, width, columns)``.

    ``columns`` maps the logical names to columns; ``first`` is the first row below the header.
    """
    block = staging.table(
        join_checked(rows, headers.filter("header_row IS NOT NULL"), SHEET_KEY)
        .filter(
            (F.col("r") >= F.col("header_row"))
            & (F.col("r") < F.col("header_row") + F.col("header_rows"))
        )
        .select(*SHEET_KEY, "header_row", "header_rows", "r", F.inline("cells")),
        "header-cells",
    )
    layouts = []
    for spec in specs:
        own = block.filter(F.col("sheet") == spec.sheet)
        headers = own.select(*SHEET_KEY, "header_row").distinct()
        names = flatten_headers(
            own.select(*SHEET_KEY, "r", "c", "v"), headers, spec.header_rows, spec.search_columns
        )
        layout = key_columns(names, spec.keys[0]).withColumn(
            "first", F.col("header_row") + spec.header_rows
        )
        no_columns = F.array().cast("array<struct<logical:string,c:int>>")
        if spec.columns:
            pair = F.struct("logical", "c")
            mapped = (
                resolve_columns(names, spec.columns)
                .groupBy(*SHEET_KEY)
                .agg(F.sort_array(F.collect_list(pair)).alias("columns"))
            )
            layout = layout.join(mapped, SHEET_KEY, "left").withColumn(
                "columns", F.coalesce("columns", no_columns)
            )
        else:
            layout = layout.withColumn("columns", no_columns)
        layouts.append(layout.select(*SHEET_KEY, "first", "key_c", "width", "columns"))
    return staging.table(reduce(DataFrame.unionByName, layouts), "layouts")


def read_columns(
    cells: DataFrame,
    specs: Sequence[SheetSpec],
    strict: bool = True,
    staging: Staging | None = None,
) -> dict[str, DataFrame]:
    """The data rows of several sheets of all workbooks, by sheet: ``(file, sheet, r, cells)``.

    ``cells`` is a struct with ``struct(v, kind)`` of the key's cell, ``_row``, and of each
    logical name, null where there is no cell. The landed cells are
    scanned once whatever the number of sheets, to put rows together and see which hold
    keys. A landing partitioned by ``sheet`` is read in those parts only. Headers, names,
    columns and bounds are found from the stored rows. What is
    left out is counted by :func:`sheet_rejects`.
    """
    staging = staging or Staging(cells.sparkSession)
    described = cells.filter(
        F.col("sheet").isin(*[s.sheet for s in specs]) & F.col("v").isNotNull()
    )
    rows = staging.table(_sheet_rows(described, specs), "sheet-rows", ["sheet"])
    headers = _find_all_headers(rows, specs, staging)
    if strict:
        for spec in specs:
            own = headers.filter(F.col("sheet") == spec.sheet)
            assert_headers(own, f"{list(spec.keys)} in {spec.header_rows} row(s)")
    rows = rows.select(*SHEET_KEY, "r", "cells")
    layouts = _all_layouts(rows, headers, specs, staging)

    def place(c: Column) -> Column:
        """Where the smallest cell of a column stands, from 1; cells are sorted."""
        return F.array_position("cells.c", c)

    def column_of(logical: str) -> Column:
        return F.get(F.filter("columns", lambda m: m["logical"] == logical), F.lit(0))["c"]

    def entry(logical: str, c: Column) -> Column:
        found = F.get("cells", place(c).cast("int") - 1)
        value = F.struct(found["v"].alias("v"), found["kind"].alias("kind"))
        return F.when(found.isNotNull(), value).alias(logical)

    # which rows have a key is told by the cells' columns alone
    filled = join_checked(rows, layouts.select(*SHEET_KEY, "first", "key_c"), SHEET_KEY).filter(
        (F.col("r") >= F.col("first")) & (place(F.col("key_c")) > 0)
    )
    runs = _runs(filled.select(*SHEET_KEY, "r"), SHEET_KEY).join(layouts, SHEET_KEY)
    runs = staging.table(runs, "runs")
    read = {}
    for spec in specs:
        near = F.lit(True)
        if spec.blank_rows is not None:
            near = F.col("first_row") <= F.col("first") + spec.blank_rows
        names = sorted({logical for logical, _ in spec.columns})
        # where each logical column stands is looked up once a sheet, not for every row
        bounds = runs.filter(near & (F.col("sheet") == spec.sheet)).select(
            *SHEET_KEY, "first_row", "stop_row", "key_c", *[column_of(n).alias(f"_c{i}") for i, n in enumerate(names)]
        )
        # all rows of a run have a key
        own = join_checked(rows.filter(F.col("sheet") == spec.sheet), bounds, SHEET_KEY).filter(
            (F.col("r") >= F.col("first_row")) & (F.col("r") < F.col("stop_row"))
        )
        entries = [entry("_row", F.col("key_c"))]
        entries += [entry(n, F.col(f"_c{i}")) for i, n in enumerate(names)]
        read[spec.sheet] = own.select(*SHEET_KEY, "r", F.struct(*entries).alias("cells"))
    return read


def read_sheets(
    cells: DataFrame,
    specs: Sequence[SheetSpec],
    strict: bool = True,
    staging: Staging | None = None,
) -> dict[str, DataFrame]:
    """As :func:`read_columns`, but ``cells`` maps each resolved logical name to ``struct(v, kind)``."""

    def entry(logical: str) -> Column:
        """An array of one map entry, or of none; to drop nulls takes a function, which is not compiled."""
        value = F.col("cells")[logical]
        one = F.array(F.struct(F.lit(logical).alias("key"), value.alias("value")))
        return F.when(value.isNotNull(), one).otherwise(
            F.array().cast("array<struct<key:string,value:struct<v:string,kind:string>>>")
        )

    def mapped(rows: DataFrame) -> DataFrame:
        entries = [entry(name) for name in rows.schema["cells"].dataType.names]
        return rows.withColumn("cells", F.map_from_entries(F.concat(*entries)))

    return {sheet: mapped(rows) for sheet, rows in read_columns(cells, specs, strict, staging).items()}


def read_sheet(
    cells: DataFrame, spec: SheetSpec, strict: bool = True, staging: Staging | None = None
) -> DataFrame:
    """As :func:`read_sheets` for one sheet: a row per data row."""
    return read_sheets(cells, [spec], strict, staging)[spec.sheet]


def cell(logical: str) -> Column:
    """``struct(v, kind)`` of a logical column of :func:`read_sheet`, or null."""
    return F.try_element_at(F.col("cells"), F.lit(logical))
