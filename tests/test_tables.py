"""Analytical tables on case fixtures."""

import statistics
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from caseloom.errors import IntegrityError
from caseloom.operators import cubes, kpi, profile, quality, scaling, series, views
from caseloom.plans import gold

ROWS = fx.random_rows(480)


@pytest.fixture(scope="module")
def cases(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cases"))
    fx.silver(spark, ROWS).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def as_set(df):
    return {tuple(r) for r in df.select(*sorted(df.columns)).collect()}


def test_cube(cases):
    cube = cubes.demographic_cube(cases)
    rows = cube.collect()
    assert sum(r.total_casos for r in rows) == len(ROWS)
    assert sum(r.porcentaje_del_total for r in rows) == pytest.approx(1.0)
    assert len({r.grupo_edad for r in rows}) == 14
    combinations = {(r["sexo"], r["resultado_prueba"], r["estatus_paciente"]) for r in ROWS}
    assert len(rows) == 17 * len(combinations)
    assert all((r.grupo_edad == "SIN_DATO") == (r.grupo_edad_ui == "SIN_DATO") for r in rows)
    group = [r for r in ROWS if r["edad"] == 33.0 and r["sexo"] == "F"]
    positives = sum(r["resultado_prueba"] == "POSITIVO" for r in group)
    negatives = sum(r["resultado_prueba"] == "NEGATIVO" for r in group)
    rate = next(r for r in rows if r.grupo_edad == "31-35" and r.sexo == "F").tasa_positividad_grupo
    assert rate == positives / (positives + negatives)


def test_empty_cases(spark):
    empty = fx.silver(spark, [])
    assert cubes.demographic_cube(empty).count() == 0
    assert cubes.municipal_table(empty).count() == 0
    assert cubes.insurance_cube(empty).count() == 0
    assert series.case_series(empty).count() == 0
    row = kpi.kpi_row(empty).first()
    assert row.total_pacientes_atendidos == 0 and row.tasa_global_letalidad == 0.0
    assert row.mediana_dias_notificacion_ingreso is None
    gold.check_gold(empty, gold.build_gold(empty))


def test_positivity_leaves_pending_out(spark):
    rows = [{"resultado_prueba": r} for r, n in (("POSITIVO", 30), ("NEGATIVO", 70), ("PENDIENTE", 10)) for _ in range(n)]
    cube = cubes.demographic_cube(fx.silver(spark, rows))
    row = cube.filter("grupo_edad = '25-30' and resultado_prueba = 'POSITIVO'").first()
    assert (row.total_casos, row.tasa_positividad_grupo) == (30, 0.3)


def test_tables_from_counts_equal_tables_from_cases(cases):
    base = cubes.case_base(cases)
    weight = cubes.BASE_WEIGHT
    for table in (cubes.demographic_cube, cubes.municipal_table, cubes.insurance_cube, kpi.kpi_row, kpi.lag_percentiles):
        assert as_set(table(base, weight=weight)) == as_set(table(cases)), table.__name__


def test_municipal_rates(spark):
    rows = (
        [{"municipio_residencia": "TOLUCA", "resultado_prueba": "POSITIVO", "estatus_paciente": s} for s in ("DEFUNCION", "HOSPITALIZADO", "AMBULATORIO", "AMBULATORIO")]
        + [{"municipio_residencia": "TOLUCA", "resultado_prueba": "NEGATIVO", "estatus_paciente": "DEFUNCION"}]
        + [{"municipio_residencia": "ECATEPEC"}]
    )
    got = {r.municipio_residencia: r for r in cubes.municipal_table(fx.silver(spark, rows)).collect()}
    assert tuple(got["TOLUCA"])[1:] == (5, 4, 1, 1, 2, 0.8, 0.25, 0.25)
    assert tuple(got["ECATEPEC"])[1:] == (1, 0, 0, 0, 0, 0.0, 0.0, 0.0)


def test_insurance_rates(cases):
    rows = cubes.insurance_cube(cases).collect()
    assert sum(r.total_casos for r in rows) == len(ROWS)
    assert {r.derechohabiencia for r in rows} == {"IMSS", "ISSSTE", "NINGUNA", "OTRA"}
    mine = [r for r in ROWS if r["derechohabiencia"] == "SEDENA" and r["resultado_prueba"] == "POSITIVO"]
    deaths = sum(r["estatus_paciente"] == "DEFUNCION" for r in mine)
    assert {r.tasa_letalidad_grupo for r in rows if r.derechohabiencia == "OTRA"} == {deaths / len(mine)}


def test_series(cases):
    rows = series.case_series(cases).orderBy("fecha").collect()
    days = [r.fecha for r in rows]
    used = {v.date() for r in ROWS for k, v in r.items() if k.startswith("fecha_")}
    span = (max(used) - min(used)).days + 1
    assert days == [min(used) + timedelta(days=i) for i in range(span)]
    positives = [
        sum(r["resultado_prueba"] == "POSITIVO" and r["fecha_resultado"].date() == d for r in ROWS)
        for d in days
    ]
    assert [r.resultados_positivos for r in rows] == positives
    assert [r.casos_positivos_acumulados for r in rows] == [sum(positives[: i + 1]) for i in range(len(days))]
    for i, r in enumerate(rows):
        assert r.media_movil_7d_positivos == pytest.approx(statistics.mean(positives[max(0, i - 6) : i + 1]))
    deaths = sum(r["estatus_paciente"] == "DEFUNCION" for r in ROWS)
    assert sum(r.defunciones for r in rows) == deaths
    week = series.weekly_rollup(series.case_series(cases), ["defunciones"])
    assert week.agg(F.sum("defunciones")).first()[0] == deaths
    assert all(r.semana.weekday() == 0 for r in week.collect())


def test_days_outside_the_window_do_not_stretch_the_series(spark):
    rows = [
        {"fecha_notificacion": "2021-05-15", "fecha_resultado": "2021-05-17", "resultado_prueba": "POSITIVO"},
        {"fecha_notificacion": "0202-05-15", "fecha_resultado": "0202-05-17"},
        {"fecha_notificacion": "2920-05-15"},
    ]
    assert series.case_series(fx.silver(spark, rows)).count() == 3
    assert series.case_series(fx.silver(spark, rows[1:])).count() == 0
    bounds = series.date_bounds(
        fx.silver(spark, rows), ["fecha_notificacion", "fecha_resultado"], date(2020, 1, 1), date(2023, 12, 31)
    )
    assert tuple(bounds.first()) == (date(2021, 5, 15), date(2021, 5, 17))


def test_inverted_and_missing_dates(spark):
    rows = [
        {"fecha_toma_muestra": "2021-01-05", "fecha_resultado": "2021-01-01"},
        {"fecha_notificacion": "2021-01-05", "fecha_ingreso_hospital": "2021-01-04", "dias_entre_notificacion_e_ingreso": 1},
        {"fecha_notificacion": "2021-01-05", "fecha_toma_muestra": "2021-01-08"},
        {},
    ]
    df = fx.silver(spark, rows)
    assert tuple(series.inverted_dates(df).first()) == (1, 1)
    assert [r[0] for r in df.select(series.null_inverted_lag()).collect()] == [None] * 4
    assert tuple(series.undated_rows(df).first()) == (2, 2, 3, 3, 1)
    assert tuple(series.mean_lags(df).first()) == (3.0, -4.0, -1.0)


def test_kpis(spark):
    rows = [
        {"resultado_prueba": "POSITIVO", "estatus_paciente": "HOSPITALIZADO", "es_registro_unificado": True, "dias_entre_notificacion_e_ingreso": 2},
        {"resultado_prueba": "POSITIVO", "estatus_paciente": "HOSPITALIZADO", "es_registro_unificado": True, "dias_entre_notificacion_e_ingreso": 4},
        {"resultado_prueba": "POSITIVO", "estatus_paciente": "DEFUNCION"},
        {"resultado_prueba": "NEGATIVO"},
    ]
    row = kpi.kpi_row(fx.silver(spark, rows)).first()
    assert row.tasa_global_letalidad == 1 / 3 and row.tasa_global_hospitalizacion == 2 / 3
    assert row.mediana_dias_notificacion_ingreso == 3.0 and row.tasa_global_positividad == 0.75
    assert tuple(kpi.lag_percentiles(fx.silver(spark, rows)).first()) == (2.5, 3.0, 3.5)


def test_kpi_view_sources(spark, cases):
    stored = kpi.kpi_row(cases)
    daily = series.case_series(cases)
    demographic, insurance = cubes.demographic_cube(cases), cubes.insurance_cube(cases)

    def view(covers=True, tables=(stored, daily, demographic, insurance), **selected):
        return tuple(kpi.kpi_view(kpi.ViewFilter(**selected), *tables, covers_all_days=covers).first())

    n = len(ROWS)
    positives = sum(r["resultado_prueba"] == "POSITIVO" for r in ROWS)
    assert view()[:2] == (n, positives)
    women = [r for r in ROWS if r["sexo"] == "F"]
    assert view(sexes=("F",), covers=False)[0] == len(women)
    insured = [r for r in ROWS if r["derechohabiencia"] == "IMSS"]
    assert view(sexes=("F",), insurances=("IMSS",))[0] == len(insured)
    got = view(covers=False, first_day=date(2021, 1, 10), last_day=date(2021, 1, 12))
    assert got[0] == sum(date(2021, 1, 10) <= r["fecha_toma_muestra"].date() <= date(2021, 1, 12) for r in ROWS)
    assert view(sexes=("nobody",)) == (0, 0, 0.0, 0.0)
    zeros = (0, 0, 0.0, 0.0)
    # a filter whose own table is absent has no figures; it is not answered by another table
    assert view(tables=(stored, daily, None, insurance), sexes=("F",)) == zeros
    assert view(tables=(stored, daily, demographic, None), insurances=("IMSS",)) == zeros
    assert view(tables=(stored, None, demographic, insurance), covers=False, first_day=date(2021, 1, 10)) == zeros
    assert view(tables=(stored.limit(0), daily, None, None))[0] == n
    assert view(tables=(None, daily, None, None))[0] == n
    assert view(tables=(None, None, None, None)) == zeros


@pytest.mark.parametrize("there", range(16))
def test_kpi_view_with_any_tables(cases, there):
    stored, daily = kpi.kpi_row(cases), series.case_series(cases)
    whole = (stored, daily, cubes.demographic_cube(cases), cubes.insurance_cube(cases))
    tables = [t if there >> k & 1 else None for k, t in enumerate(whole)]

    def tests(**selected):
        return kpi.kpi_view(kpi.ViewFilter(**selected), *tables).first()[0]

    assert tests() == (len(ROWS) if tables[0] or tables[1] else 0)
    assert tests(sexes=("F",)) == (sum(r["sexo"] == "F" for r in ROWS) if tables[2] else 0)
    assert tests(insurances=("IMSS",)) == (sum(r["derechohabiencia"] == "IMSS" for r in ROWS) if tables[3] else 0)


def test_filters(cases):
    cube = cubes.demographic_cube(cases)
    assert views.filter_demographic(cube).count() == cube.count()
    some = views.filter_demographic(cube, ["F", "M"], ["<18"])
    assert {(r.sexo, r.grupo_edad_ui) for r in some.collect()} <= {("F", "<18"), ("M", "<18")}
    insurance = cubes.insurance_cube(cases)
    assert views.filter_insurance(insurance, []).count() == insurance.count()
    assert {r[0] for r in views.risk_rows(insurance).select("derechohabiencia").collect()} == {"IMSS", "ISSSTE", "NINGUNA"}
    assert views.insurance_rates(insurance).count() == 3
    daily = series.case_series(cases)
    assert views.curve_days(daily).filter("resultados_positivos = 0").count() == 0


def test_pyramid_and_positivity(cases):
    cube = cubes.demographic_cube(cases)
    bars = cubes.pyramid(cube).collect()
    assert sum(r.total_casos for r in bars) == len(ROWS)
    assert all(r.casos_mostrados == (-r.total_casos if r.sexo == "M" else r.total_casos) for r in bars)
    hidden = cubes.unknown_age_cases(cube).first()[0]
    assert hidden == sum(r["edad"] < 0 for r in ROWS) > 0
    assert sum(r.total_casos for r in cubes.pyramid(cube, with_unknown=False).collect()) == len(ROWS) - hidden
    young = [r for r in ROWS if 0 <= r["edad"] < 18]
    row = cubes.positivity_by_age(cube).filter("grupo_edad_ui = '<18'").first()
    assert row.casos_positivos == sum(r["resultado_prueba"] == "POSITIVO" for r in young)


def test_geography(spark, cases):
    shapes = spark.createDataFrame(
        [("México", "Ecatepec de Morelos", "{}"), ("MEXICO", "Toluca", "{}"), ("Baja California", "Atenco", "{}")],
        "estado string, municipio string, geometry_json string",
    )
    dimension = views.map_dimension(shapes)
    table = cubes.municipal_table(cases)
    drawn = views.geo_match(table, dimension)
    assert {r.municipio_mapa for r in drawn.collect()} == {"ECATEPEC DE MORELOS", "TOLUCA"}
    assert [r[0] for r in views.geo_omitted(table, dimension).collect()] == ["ATENCO", "OTROS"]


def test_reconciliation(spark, cases):
    tables = gold.build_gold(cases)
    gold.check_gold(cases, tables)
    broken = gold.GoldTables(**{**tables.__dict__, "municipal": tables.municipal.filter("municipio_residencia <> 'TOLUCA'")})
    with pytest.raises(IntegrityError, match="geografia"):
        gold.check_gold(cases, broken)
    shifted = tables.demographic.withColumn("grupo_edad_ui", F.lit("<18"))
    with pytest.raises(IntegrityError, match="sin_dato"):
        gold.check_gold(cases, gold.GoldTables(**{**tables.__dict__, "demographic": shifted}))


def test_contract_counts(spark):
    bad = fx.silver(spark, [{"sexo": "X"}, {"edad": -2.0, "resultado_prueba": None}, {}])
    got = quality.check_contract(bad, quality.case_contract()).first()
    assert (got.filas, got.viola_sexo, got.viola_edad, got.viola_resultado_prueba) == (3, 1, 1, 1)
    with pytest.raises(IntegrityError, match="sexo"):
        quality.assert_contract(bad, quality.case_contract(), "cases")


def test_crosstab_and_value_counts(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), ("q", "x"), (None, "x")], "k string, v string")
    table = cubes.crosstab(df, "k", "v", ["a", "b", "c"], ["x", "y"], {"x": "n_x"})
    assert {tuple(r) for r in table.collect()} == {("a", 2, 0), ("b", 0, 1), ("c", 0, 0)}
    assert [tuple(r) for r in cubes.value_counts(df, "v").collect()] == [("x", 4), ("y", 1)]


def test_prefix_sums_and_quantiles_of_hot_groups(spark):
    df = spark.range(1000).select((F.col("id") % 10 == 0).cast("int").alias("g"), F.col("id").alias("o"))
    got = scaling.dense_index(df, ["g"], ["o"], "i", scaling.Staging(spark)).collect()
    for group in (0, 1):
        rows = sorted((r.o, r.i) for r in got if r.g == group)
        assert [i for _, i in rows] == list(range(len(rows)))
    values = spark.range(101).select((F.col("id") % 20).alias("a"), F.when(F.col("id") % 2 == 0, F.col("id") / 3).alias("b"))
    pdf = values.toPandas()
    found = scaling.exact_quantiles(values, ["a", "b"], [0.0, 0.25, 0.5, 0.77, 1.0], scaling.Staging(spark))
    for r in found.collect():
        assert r.value == pytest.approx(pdf[r.column].quantile(r.share)), r
    summary = {r.columna: r for r in profile.describe(values).collect()}
    assert summary["b"].n == 51 and summary["b"].desviacion == pytest.approx(pdf["b"].std())
    assert summary["b"].p50 == pytest.approx(pdf["b"].median())


def test_profile(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 3), ("b", 3)], "t string, n int")
    nulls = {r.columna: (r.tipo, r.pct_nulos) for r in profile.column_nulls(df).collect()}
    assert nulls == {"t": ("string", 0.25), "n": ("int", 0.25)}
    top = profile.top_values(df, ["t", "n"], 1).collect()
    assert {(r.columna, r.valor, r.n) for r in top} == {("t", "a", 2), ("n", "3", 2)}
    assert profile.pattern_share(df, "t", "^a").first().proporcion == 0.5


def test_catalog_table_lookup(spark):
    catalog = spark.createDataFrame([("Zúrich", "ZH"), ("Genève", "GE")], "synonym string, canonical string")
    df = spark.createDataFrame([(" zurich",), ("GENEVE",), ("x",), (None,)], "v string")
    got = scaling.catalog_join(df, F.col("v"), catalog, "o", "??")
    assert {(r.v, r.o) for r in got.collect()} == {(" zurich", "ZH"), ("GENEVE", "GE"), ("x", "??"), (None, "??")}


def test_crosstabs_of_one_scan_equal_single_ones(spark, cases):
    df = cases.select("sexo", "resultado_prueba", "estatus_paciente")
    domains = {
        "sexo": ("F", "M"),
        "resultado_prueba": ("POSITIVO", "NEGATIVO", "NADIE"),
        "estatus_paciente": ("AMBULATORIO", "DEFUNCION"),
    }
    tables = {
        "a": ("resultado_prueba", "sexo"),
        "b": ("estatus_paciente", "sexo"),
        "c": ("sexo", "resultado_prueba"),
    }
    for other in (None, "RESTO"):
        whole = cubes.crosstabs(df, tables, domains, other)
        got = {(r.tabla, r.fila, r.columna): r.n for r in whole.collect()}
        want = {}
        for name, (row, column) in tables.items():
            single = cubes.crosstab(df, row, column, domains[row], domains[column], other=other)
            for r in single.collect():
                want |= {(name, r[row], c): n for c, n in r.asDict().items() if c != row}
        assert got == want
        plan = whole._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Expand") == 1
