"""Whole runs, from cells to tables."""

import glob
import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from caseloom.errors import HeaderNotFound, IntegrityError, SchemaMismatch
from caseloom.operators import quality
from caseloom.operators.scaling import Staging
from caseloom.plans import gold, run, silver
from caseloom.settings import PII_COLUMNS
from caseloom.sources import release, tables


def outpatient(folio, nombre, edad="34", fecha_notificacion="18/03/2020", resultado="POSITIVO", sexo="F", **more):
    row = dict(more, folio=folio, nombre=nombre, edad=edad, sexo=sexo, resultado=resultado)
    return row | {"fecha_notificacion": fecha_notificacion}


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("run"))
    books = [
        fx.workbook(
            "a.xlsx",
            [
                outpatient(1, "Ana Pérez", municipio="GAM", estatus="AMBULATORIO", fecha_resultado="20/03/2020"),
                outpatient(2, "Luis  Peña", "M", 43914, "24/03/2020", "50", fecha_resultado="NEGATIVO"),
                outpatient(3, "Eva", "34", "0208-05-15", "RECHAZO", estatus="Defunción", derechohabiencia=""),
            ],
            [
                {"hospital": "H1", "folio": 1.0, "nombre": "ANA PEREZ", "F": 34, "ingreso": datetime(2020, 3, 22), "res": "POSITIVO"},
                {"hospital": "H2", "folio": 9, "nombre": "Otro", "M": "70", "ingreso": "01/05/2020"},
            ],
            daily=[["30.03.2020", "H1"], ["31.03.2020", "H1"]],
            phantom=True,
        ),
        fx.workbook("b.xlsx", [outpatient(1, "Zoe", "3M", municipio="Ecatepec de Morelos")]),
    ]
    fx.cell_table(spark, *books).write.parquet(f"{folder}/cells")
    config = run.RunConfig(
        f"{folder}/cells", f"{folder}/silver", silver.Registries(salt="s"), f"{folder}/gold"
    )
    assert run.run(spark, config, "gold") == run.OK
    return folder


@pytest.fixture(scope="module")
def published(spark, finished):
    return run.published_tables(spark, f"{finished}/silver")


def read_json(folder):
    (part,) = glob.glob(f"{folder}/part-*.json")
    with open(part, encoding="utf-8") as f:
        return json.load(f)


def test_cases_are_unified(spark, published):
    cases = gold.load_silver(spark, published[gold.SILVER_FILE])
    assert cases.columns == list(silver.SILVER_COLUMNS)
    assert not {c.upper() for c in cases.columns} & {p.upper() for p in PII_COLUMNS}
    rows = cases.collect()
    assert len(rows) == 5
    linked = [r for r in rows if r.es_registro_unificado]
    assert len(linked) == 1
    ana = linked[0]
    assert (ana.hospital, ana.dias_entre_notificacion_e_ingreso) == ("H1", 4)
    assert ana.municipio_residencia == "GUSTAVO A. MADERO" and ana.resultado_prueba == "POSITIVO"
    luis = next(r for r in rows if r.edad == 50.0)
    assert luis.sexo == "M" and luis.fecha_resultado == datetime(2020, 3, 24)
    assert luis.resultado_prueba == "NEGATIVO" and luis.fecha_notificacion == datetime(2020, 3, 24)
    eva = next(r for r in rows if r.resultado_prueba == "NO_CONCLUYENTE")
    assert eva.fecha_notificacion is None and eva.estatus_paciente == "DEFUNCION"
    assert eva.derechohabiencia == "NINGUNO"
    assert all(len(r.paciente_id) == 64 for r in rows)


def test_quality_summary_is_written(published):
    summary = read_json(published[run.QUALITY_FILE])
    stamp = summary.pop("timestamp_ejecucion")
    assert stamp.endswith("+00:00")
    assert summary == {
        "filas_leidas_bronze_seguimiento": 4,
        "filas_leidas_bronze_nominal": 2,
        "registros_hasheados": 6,
        "cruces_exitosos": 1,
        "registros_huerfanos": 4,
        "porcentaje_huerfanos": 0.8,
        "correcciones_columnas_intercambiadas": 1,
        "colisiones_llave_sintetica": 0,
        "fechas_anomalas_fuera_ventana": 1,
    }


def test_tables_and_summary_are_written(spark, finished, published):
    stored = {name: spark.read.parquet(published[file]) for name, file in gold.TABLE_FILES.items()}
    summary = read_json(published[gold.SUMMARY_FILE])
    assert summary["total_pacientes_atendidos"] == 5
    assert summary["mediana_dias_notificacion_ingreso"] == 4.0
    assert stored["demographic"].agg(F.sum("total_casos")).first()[0] == 5
    quality.assert_contract(stored["demographic"], quality.demographic_contract(), "d")
    quality.assert_contract(stored["insurance"], quality.insurance_contract(), "i")
    quality.assert_contract(stored["municipal"], quality.municipal_contract(), "m")
    quality.assert_contract(stored["series"], quality.series_contract(), "s")
    quality.assert_contract(stored["kpis"], quality.kpi_contract(), "k")


def test_exit_codes(spark, finished, published, tmp_path, monkeypatch):
    path = published[gold.SILVER_FILE]
    ok = str(tmp_path / "ok")
    assert run.run_stored_silver(spark, path, ok) == 0
    assert all(df is not None for df in gold.load_gold(spark, ok).values())
    assert run.run_stored_silver(spark, f"{finished}/nowhere", str(tmp_path / "x")) == 1
    spark.range(1).write.parquet(str(tmp_path / "thin"))
    assert run.run_stored_silver(spark, str(tmp_path / "thin"), str(tmp_path / "x")) == 1

    def fail(found):
        raise IntegrityError("totals differ")

    monkeypatch.setattr(quality, "assert_reconciled", fail)
    assert run.run_stored_silver(spark, path, str(tmp_path / "x")) == 2
    assert not list((tmp_path / "x").glob("*"))
    # what was there before a failed run stays readable
    before = gold.load_gold(spark, ok)["kpis"].collect()
    assert run.run_stored_silver(spark, path, ok) == 2
    assert gold.load_gold(spark, ok)["kpis"].collect() == before


def config_of(finished, target):
    return run.RunConfig(f"{finished}/cells", f"{target}/silver", silver.Registries(salt="s"))


def test_a_run_refuses_rows_that_break_a_rule(spark, finished, tmp_path, monkeypatch):
    config = config_of(finished, tmp_path)
    assert run.run(spark, config, "gold") == run.OK
    before = run.published_tables(spark, config.silver_folder)
    rules = {**quality.case_contract(), "edad": F.col("edad") < 60}
    monkeypatch.setattr(run, "case_contract", lambda: rules)
    assert run.run(spark, config) == run.INCONSISTENT
    assert run.published_tables(spark, config.silver_folder) == before
    assert spark.read.parquet(before[gold.SILVER_FILE]).count() == 5
    folders = [p for p in os.listdir(config.silver_folder) if p.startswith("release-")]
    assert len(folders) == 1


def test_a_run_without_cells_or_headers_is_unreadable(spark, tmp_path):
    config = config_of(tmp_path, tmp_path)
    assert run.run(spark, config) == run.UNREADABLE
    fx.cell_table(spark, [("x", fx.OUT, 1, 1, "nothing", "text")]).write.parquet(f"{tmp_path}/cells")
    assert run.run(spark, config) == run.UNREADABLE
    with pytest.raises(FileNotFoundError):
        run.published_tables(spark, config.silver_folder)


def test_a_killed_run_leaves_the_earlier_set(spark, finished, tmp_path, monkeypatch):
    config = config_of(finished, tmp_path)
    assert run.run(spark, config) == run.OK
    before = run.published_tables(spark, config.silver_folder)

    def killed(self):
        raise KeyboardInterrupt

    monkeypatch.setattr(release.Release, "publish", killed)
    with pytest.raises(KeyboardInterrupt):
        run.run(spark, config, "gold")
    assert run.published_tables(spark, config.silver_folder) == before
    assert spark.read.parquet(before[gold.SILVER_FILE]).count() == 5


def test_an_empty_table_is_written_and_counted(spark, tmp_path):
    empty = spark.createDataFrame([], "n int")
    found = release.write_checked(empty, str(tmp_path / "e"), {"n": F.col("n") > 0}, {"s": F.sum("n")})
    assert found == {"filas": 0, "s": None} and spark.read.parquet(str(tmp_path / "e")).count() == 0


def test_two_runs_cannot_publish_the_same_number(spark, tmp_path, monkeypatch):
    one, two = (release.Release(spark, str(tmp_path)) for _ in range(2))
    for r in (one, two):
        r.write(spark.range(3).toDF("n"), "t")
    assert one.publish() == 1
    monkeypatch.setattr(release, "_numbers", lambda *a: [])
    with pytest.raises(IntegrityError):
        two.publish()
    monkeypatch.undo()
    assert release.published(spark, str(tmp_path)) == one.tables
    assert two.publish() == 2 and release.published(spark, str(tmp_path)) == two.tables


@pytest.mark.parametrize(
    ("contract", "table"),
    [
        (quality.demographic_contract, "demographic"),
        (quality.insurance_contract, "insurance"),
        (quality.municipal_contract, "municipal"),
        (quality.series_contract, "series"),
        (quality.kpi_contract, "kpis"),
    ],
)
def test_every_rule_of_a_table_is_enforced(spark, published, tmp_path, contract, table):
    """A row with a null, or a share above one, in each column in turn."""
    good = spark.read.parquet(published[gold.TABLE_FILES[table]])
    assert release.write_checked(good, str(tmp_path / "good"), contract())["filas"] == good.count()
    bad = good.limit(1)
    counted = quality.check_contract(
        bad.unionByName(bad.select(*[F.lit(None).cast(t).alias(c) for c, t in bad.dtypes])), contract()
    ).first()
    assert counted["filas"] == 2
    assert all(counted[f"viola_{rule}"] == 1 for rule in contract())
    with pytest.raises(IntegrityError, match="viola_"):
        nulls = bad.select(*[F.lit(None).cast(t).alias(c) for c, t in bad.dtypes])
        release.write_checked(bad.unionByName(nulls), str(tmp_path / "bad"), contract())


def test_reads(spark, finished, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path / "no"), [])
    spark.range(1).write.parquet(str(tmp_path / "t"))
    with pytest.raises(SchemaMismatch, match="a.*b"):
        tables.read_table(spark, str(tmp_path / "t"), ["b", "id", "a"])
    assert tables.read_table_or_none(spark, str(tmp_path / "no")) is None
    os.makedirs(tmp_path / "empty")
    assert tables.read_table_or_none(spark, str(tmp_path / "empty")) is None
    schema = spark.createDataFrame([(1,)], "n int").schema
    (tmp_path / "good.json").write_text('{\n "n": 3\n}')
    (tmp_path / "bad.json").write_text("{ n: ")
    assert tables.read_summary_or_none(spark, str(tmp_path / "good.json"), schema).first().n == 3
    assert tables.read_summary_or_none(spark, str(tmp_path / "bad.json"), schema) is None
    assert tables.read_summary_or_none(spark, str(tmp_path / "none.json"), schema) is None


def test_rows_with_both_dates_are_rejected_before_linking(spark):
    both = fx.silver(spark, [{"fecha_notificacion": "2021-01-01", "fecha_ingreso_hospital": "2021-01-01"}])
    with pytest.raises(IntegrityError):
        quality.assert_contract(both, quality.one_date_contract(), "cases")


def test_unknown_sheet_layout_stops_the_run(spark, tmp_path):
    cells = fx.cell_table(spark, [("x", fx.OUT, 1, 1, "nothing", "text")])
    with pytest.raises(HeaderNotFound):
        silver.ingest_registries(cells, silver.Registries("s"), Staging(spark))
