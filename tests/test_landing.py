from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from caseloom.errors import HeaderNotFound
from caseloom.settings import DAILY_SHEET, EARLIER_LIMITS, INPATIENT_SHEET, OUTPATIENT_SHEET
from caseloom.plans import silver
from caseloom.session import tune
from caseloom.sources import landing


def three_rows(n=3):
    return [{"folio": i + 1, "nombre": f"Nombre {i}", "sexo": "F"} for i in range(n)]


def test_headers_are_found_by_text_in_many_books(spark):
    cells = fx.cell_table(
        spark,
        fx.workbook("a.xlsx", three_rows()),
        [(f, s, r + 4, c, v, k) for f, s, r, c, v, k in fx.workbook("b.xlsx", three_rows(2))],
    )
    found = landing.find_headers(
        cells.filter(F.col("sheet") == fx.OUT), OUTPATIENT_SHEET.keys, 1
    )
    assert {(r.file, r.header_row) for r in found.collect()} == {("a.xlsx", fx.OUT_HEADER), ("b.xlsx", fx.OUT_HEADER + 4)}


def test_word_boundary_keeps_titles_out(spark):
    cells = fx.cell_table(spark, fx.workbook("a.xlsx", inpatient=[{"hospital": "H"}]))
    found = landing.find_headers(cells.filter(F.col("sheet") == fx.IN), INPATIENT_SHEET.keys, 3)
    assert found.first().header_row == fx.IN_HEADER


def test_missing_header_is_reported(spark):
    cells = fx.cell_table(spark, [("x.xlsx", fx.OUT, 1, 1, "nothing", "text")])
    with pytest.raises(HeaderNotFound, match="x.xlsx"):
        landing.read_sheet(cells, OUTPATIENT_SHEET)


def test_merged_headers_are_flattened(spark):
    cells = fx.cell_table(spark, fx.workbook("a.xlsx", inpatient=[{"hospital": "H"}]))
    cells = cells.filter(F.col("sheet") == fx.IN)
    headers = landing.find_headers(cells, INPATIENT_SHEET.keys, 3)
    names = landing.flatten_headers(cells, headers, 3).orderBy("c")
    assert [r.name for r in names.collect()][1:] == [
        "NO.",
        "FECHA DE INGRESO al piso",
        "EDAD | M",
        "EDAD | F",
        "NOMBRE DEL PACIENTE",
        "HOSPITAL",
        "PRUEBA | FECHA DE RESULTADO",
        "PRUEBA | RESULTADO",
    ]


def flatten_model(rows):
    """Column by column, level by level."""
    width = max(len(r) for r in rows)
    rows = [list(r) + [None] * (width - len(r)) for r in rows]
    names, last = [], 0
    for c in range(width):
        parts = []
        for level, row in enumerate(rows):
            for back in range(c, -1, -1):
                if row[back] is not None:
                    parts.append(row[back].strip())
                    break
                if any(rows[up][back] is not None for up in range(level)):
                    break
        names.append(" | ".join(dict.fromkeys(parts)) or f"__col_{c}__")
        if any(row[c] is not None for row in rows):
            last = c + 1
    return names[:last]


def test_flattening_equals_the_model(spark):
    blocks = [
        [["K", None, "B", None, None, "C"], [None, "x", None, "y", None, None], ["1", None, "2", "3", None, "4"]],
        [[None, None, "K", None], ["a", None, None, "b"], [None, "c", "K", None, None, "z"]],
        [["K", "K"], ["K", None], [None, " q "]],
    ]
    cells = [
        (f"{i}", "s", 4 + level, c + 1, v, "text")
        for i, block in enumerate(blocks)
        for level, row in enumerate(block)
        for c, v in enumerate(row)
        if v is not None
    ]
    table = fx.cell_table(spark, cells)
    headers = spark.createDataFrame([(f"{i}", "s", 4) for i in range(3)], "file string, sheet string, header_row int")
    names = landing.flatten_headers(table, headers, 3).orderBy("file", "c").collect()
    for i, block in enumerate(blocks):
        assert [n.name for n in names if n.file == f"{i}"] == flatten_model(block), i


@pytest.mark.parametrize("blanks", [0, 10, 11])
def test_data_are_bounded_and_what_is_left_out_is_counted(spark, blanks):
    cells = fx.cell_table(spark, fx.workbook("a.xlsx", three_rows(), phantom=True, blanks=blanks))
    limited = replace(OUTPATIENT_SHEET, **EARLIER_LIMITS)
    assert landing.read_sheet(cells, limited).count() == (3 if blanks < 11 else 0)
    assert landing.read_sheet(cells, OUTPATIENT_SHEET).count() == 3
    for spec in (limited, OUTPATIENT_SHEET):
        got = {r.reason: r.cells for r in landing.sheet_rejects(cells, spec).collect()}
        assert sum(got.values()) == cells.filter(F.col("sheet") == fx.OUT).count()
        if spec is limited and blanks == 11:
            assert got == {"header": 1 + len(fx.OUTPATIENT), "no_data": 11}
        else:
            assert got == {"header": 1 + len(fx.OUTPATIENT), "kept": 9, "after_data": 2}


def test_wide_low_and_doubled_sheets_are_read(spark):
    wide = [("w", fx.OUT, 70, c, v, "text") for c, v in ((1, "NO. (consecutivo)"), (2, "CASO"), (225, "ESTATUS"))]
    wide += [("w", fx.OUT, 71, c, v, "text") for c, v in ((1, "1"), (2, "Ana"), (225, "ALTA"), (225, "BAJA"), (300, "x"))]
    rows = landing.read_sheet(fx.cell_table(spark, wide), OUTPATIENT_SHEET).collect()
    assert [r.cells["estatus"].v for r in rows] == ["ALTA"]
    got = {r.reason: r.cells for r in landing.sheet_rejects(fx.cell_table(spark, wide), OUTPATIENT_SHEET).collect()}
    assert got == {"header": 3, "kept": 4, "beyond_columns": 1}
    with pytest.raises(HeaderNotFound):
        landing.read_sheet(fx.cell_table(spark, wide), replace(OUTPATIENT_SHEET, **EARLIER_LIMITS))


def test_rows_carry_resolved_columns(spark):
    when = datetime(2020, 3, 18)
    cells = fx.cell_table(
        spark,
        fx.workbook("a.xlsx", [{"folio": 7, "nombre": "Uno", "fecha_notificacion": when, "resultado": "POSITIVO", "fecha_resultado": "19/03/2020"}]),
    )
    row = landing.read_sheet(cells, OUTPATIENT_SHEET).first()
    assert row.r == fx.OUT_FIRST
    assert row.cells["folio"].v == "7" and row.cells["folio"].kind == "number"
    assert row.cells["fecha_notificacion"].kind == "datetime"
    assert row.cells["resultado"].v == "POSITIVO"
    assert row.cells["fecha_resultado"].v == "19/03/2020"
    assert "sexo" not in row.cells


def test_columns_resolve_by_level_or_whole_name(spark):
    names = spark.createDataFrame(
        [("a", "s", 1, 1, "LABORATORIO | RESULTADO"), ("a", "s", 1, 2, "RESULTADO"), ("a", "s", 1, 3, "Edad | M (x)")],
        "file string, sheet string, header_row int, c int, name string",
    )
    got = landing.resolve_columns(names, [("res", "RESULTADO"), ("m", "EDAD | M"), ("no", "ZZZ")])
    assert {r.logical: r.c for r in got.collect()} == {"res": 1, "m": 3}


def test_sheets_read_together_are_those_read_alone(spark, tmp_path):
    books = [
        fx.workbook("a.xlsx", three_rows(4), [{"hospital": "H1", "folio": 3, "F": 20}], daily=[["1", "x"], ["2", None], ["3", "y"]], phantom=True),
        fx.workbook("b.xlsx", three_rows(1), [{"hospital": "H2", "folio": 4, "M": 30}, {"hospital": "H3"}], blanks=2),
    ]
    path = str(tmp_path / "cells")
    fx.cell_table(spark, *books).write.partitionBy("sheet").parquet(path)
    # a sheet that nobody described, and that cannot be read
    other = tmp_path / "cells" / "sheet=NOTAS"
    other.mkdir()
    (other / "part-0.parquet").write_text("no table")
    schema = "file string, r int, c int, v string, kind string, sheet string"
    cells = spark.read.schema(schema).parquet(path)
    specs = [OUTPATIENT_SHEET, INPATIENT_SHEET, DAILY_SHEET]
    together = landing.read_sheets(cells, specs)
    for spec in specs:
        alone = landing.read_sheet(cells, spec)
        rows = [sorted((r.file, r.r, sorted(r.cells)) for r in df.collect()) for df in (together[spec.sheet], alone)]
        assert rows[0] == rows[1]
        limited = replace(spec, **EARLIER_LIMITS)
        rows.append(sorted((r.file, r.r, sorted(r.cells)) for r in landing.read_sheet(cells, limited).collect()))
        assert rows[2] == rows[0]
    assert [together[s.sheet].count() for s in specs] == [5, 3, 1]


def test_a_cell_landed_twice_counts_by_its_smallest_value(spark):
    book = fx.workbook("a.xlsx", three_rows(2))
    twice = [(f, s, r, c, "0" + v, k) for f, s, r, c, v, k in book if r == fx.OUT_FIRST and c == fx.PLACES["folio"]]
    got = landing.read_sheet(fx.cell_table(spark, book + twice + book), OUTPATIENT_SHEET).orderBy("r").collect()
    assert [r.cells["folio"].v for r in got] == ["01", "2"]


def test_landed_cells_are_scanned_once(spark):
    book = fx.workbook("a.xlsx", three_rows(), [{"hospital": "H"}])
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    cells = fx.cell_table(spark, book)
    read = landing.read_sheets(cells.mapInArrow(passed, cells.schema), [OUTPATIENT_SHEET, INPATIENT_SHEET])
    assert [read[s.sheet].count() for s in (OUTPATIENT_SHEET, INPATIENT_SHEET)] == [3, 1]
    assert seen.value == len([x for x in book if x[4] is not None])


def test_registry_rows_are_read_from_columns_as_from_maps(spark):
    """The bronze of a run takes a cell out of a struct: no map is built and searched for every row."""
    book = fx.workbook("a.xlsx", three_rows(), inpatient=[{"hospital": "H", "nombre": "N"}])
    cells = fx.cell_table(spark, book)
    specs = [OUTPATIENT_SHEET, INPATIENT_SHEET]
    columns, maps = landing.read_columns(cells, specs), landing.read_sheets(cells, specs)
    for spec in specs:
        wide = columns[spec.sheet].collect()
        got = {(r.file, r.r): {k: tuple(v) for k, v in r.cells.asDict().items() if v is not None} for r in wide}
        rows = maps[spec.sheet].collect()
        assert got == {(r.file, r.r): {k: tuple(v) for k, v in r.cells.items()} for r in rows}
        assert got
    bronze = silver._to_bronze(columns[OUTPATIENT_SHEET.sheet], "seguimiento", 0, OUTPATIENT_SHEET, "s")
    assert "map_from_entries" not in bronze._jdf.queryExecution().toString()


def test_keys_are_told_by_row_as_by_cell(spark):
    """A row with a key's text that is no key, or stands beyond the limits, holds none."""
    key, other = OUTPATIENT_SHEET.keys
    rows = [
        ("a", fx.OUT, 1, 1, f"x {key}", "text"),
        ("a", fx.OUT, 2, 1, f" {key.lower()} ", "text"),
        ("a", fx.OUT, 2, 2, f"{other}S", "text"),
        ("a", fx.OUT, 3, 1, "y", "text"),
        ("a", fx.OUT, 3, 2, f"{other}: z", "text"),
        ("a", fx.OUT, 4, 201, key, "text"),
        ("a", fx.OUT, 51, 1, key, "text"),
        ("a", fx.IN, 2, 1, key, "text"),
    ]
    cells = fx.cell_table(spark, rows)
    limited = replace(OUTPATIENT_SHEET, **EARLIER_LIMITS)

    def found(*specs):
        got = landing._sheet_rows(cells, specs).collect()
        return {(r.sheet, r.r): (r._k0, r._k1) for r in got if r._k0 or r._k1}

    near = {(fx.OUT, 2): (True, False), (fx.OUT, 3): (False, True)}
    far = {(fx.OUT, 4): (True, False), (fx.OUT, 51): (True, False)}
    assert found(limited, INPATIENT_SHEET) == near
    assert found(OUTPATIENT_SHEET, INPATIENT_SHEET) == near | far
    # a key is sought once a row, not once a cell: the scan only tells which rows may hold one
    plan = landing._sheet_rows(cells, [OUTPATIENT_SHEET])._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan[plan.index("Aggregate") :]


def test_many_sheets_written_side_by_side_stay_whole(spark, tmp_path):
    """More sheets than files a task keeps open at once, in turn."""
    tune(spark)
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 0
    df = spark.range(3000).select(F.concat(F.lit("s"), F.col("id") % 23).alias("sheet"), "id").coalesce(1)
    df.write.partitionBy("sheet").parquet(str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert {(r.id, r.sheet) for r in back.collect()} == {(i, f"s{i % 23}") for i in range(3000)}
    assert back.count() == 3000
