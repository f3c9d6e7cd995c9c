from caseloom.plans.older_report import COLUMNS, clean_older, older_crosstabs


def rows(spark, *records):
    schema = ", ".join(f"{c} string" for c in COLUMNS)
    return spark.createDataFrame([tuple(r.get(c) for c in COLUMNS) for r in records], schema)


def test_rules_and_swaps(spark):
    df = rows(
        spark,
        {"sexo": "FEM", "edad": "34", "resultado": "POS.", "estatus": "AMB", "pais": "MEXICO DF"},
        {"edad": "RN", "resultado": "INDETERMINADO", "estatus": "DEFUNCIÓN", "residencia": "COL. NEZA"},
        {"sexo": "45", "edad": "M", "resultado": "24/03/2020", "fecha_resultado": "NEGATIVO", "estatus": "ALTA"},
    )
    first, second, third = clean_older(df).collect()
    assert (first.sexo, first.edad, first.resultado) == ("F", 34.0, "POSITIVO")
    assert (first.estatus, first.pais, first.residencia) == ("AMBULATORIO", "MÉXICO", "FORANEO")
    assert first.fecha_resultado == "01/01/2000  12:00:00 a. m."
    assert (second.sexo, second.edad, second.resultado) == ("M", 0.0, "SOSPECHOSO")
    # NEZA becomes NEZAHUALCOYOTL, which a later rule takes for COYO
    assert (second.estatus, second.residencia) == ("DEFUNCION", "COYOACAN")
    assert (third.sexo, third.edad) == ("M", 45.0)
    assert (third.resultado, third.fecha_resultado) == ("NEGATIVO", "24/03/2020")
    tables = older_crosstabs(clean_older(df))
    by_sex = {r.resultado: r.asDict() for r in tables["resultado_sexo"].collect()}
    assert by_sex["POSITIVO"] == {"resultado": "POSITIVO", "M": 0, "F": 1, "OTRO": 0}
    by_age = {r.rango: r.SOSPECHOSO for r in tables["edad_resultado"].collect()}
    assert len(by_age) == 10 and by_age["0-1"] == 1 and sum(by_age.values()) == 1
    assert tables["estatus_sexo"].count() == 3


def test_kinds_decide_what_is_text(spark):
    df = rows(spark, {"resultado": "sin letras", "fecha_resultado": "20/03/2020", "sexo": "F"})
    kept = df.selectExpr("*", "'text' AS resultado_kind", "'text' AS sexo_kind")
    assert clean_older(kept).first().fecha_resultado == "20/03/2020"
    assert clean_older(df).first().fecha_resultado == "sin letras"


def test_a_status_counts_as_what_it_contains_and_nothing_is_lost(spark):
    df = rows(
        spark,
        *[{"sexo": "F", "edad": "1.5", "resultado": "POSITIVO", "estatus": s} for s in ("PACIENTE AMBULATORIO", "EGRESO", None)],
    )
    tables = older_crosstabs(clean_older(df), other="RESTO")
    by_status = {r.estatus: r.POSITIVO for r in tables["estatus_resultado"].collect()}
    assert by_status == {"AMBULATORIO": 1, "HOSPITALIZADO": 0, "DEFUNCION": 0, "RESTO": 2}
    assert {r.rango: r.POSITIVO for r in tables["edad_resultado"].collect()}["2-11"] == 3
