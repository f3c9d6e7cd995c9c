"""Small cell tables and case tables."""

import random
from datetime import datetime, timedelta

from caseloom.sources.landing import CELL_SCHEMA

OUT = "SEGUIMIENTO DE CASOS COVID 19"
IN = " NOMINAL DE HOSPITALIZADOS"
DAILY = "RED NEGATIVA"

# Headings begin as the readers need them and go on freely; a column's place is its rank here.
OUTPATIENT = {
    "folio": "NO. (consecutivo)",
    "edad": "EDAD del caso",
    "sexo": "SEXO del caso",
    "nombre": "CASO",
    "estatus": "ESTATUS hoy",
    "notas": "Notas de la mesa",
    "municipio": "MUNICIPIO donde vive",
    "derechohabiencia": "DERECHOHABIENCIA si la hay",
    "resultado": "RESULTADO leído",
    "fecha_resultado": "FECHA DE RESULTADO leída",
    "fecha_toma_muestra": "FECHA TOMA DE MUESTRA escrita",
    "fecha_notificacion": "FECHA DE NOTIFICACIÓN escrita",
}
OUT_HEADER, OUT_FIRST = 7, 8
PLACES = {name: c for c, name in enumerate(OUTPATIENT, 1)}

# Three header rows with merged cells: (level, place, text)
INPATIENT_HEADER = [
    (0, 2, "NO."),
    (0, 3, "FECHA DE INGRESO al piso"),
    (0, 4, "EDAD"),
    (1, 4, "M"),
    (1, 5, "F"),
    (0, 6, "NOMBRE DEL PACIENTE"),
    (0, 7, "HOSPITAL"),
    (0, 8, "PRUEBA"),
    (2, 8, "FECHA DE RESULTADO"),
    (2, 9, "RESULTADO"),
]
INPATIENT = {"folio": 2, "ingreso": 3, "M": 4, "F": 5, "nombre": 6, "hospital": 7, "fres": 8, "res": 9}
IN_HEADER, IN_FIRST = 4, 7


def _cell(file, sheet, r, c, value):
    if value is None:
        return None
    if isinstance(value, datetime):
        return (file, sheet, r, c, str(value), "datetime")
    kind = "number" if isinstance(value, (int, float)) else "text"
    return (file, sheet, r, c, str(value), kind)


def workbook(file="a.xlsx", outpatient=(), inpatient=(), daily=(), phantom=False, blanks=0):
    """Cells of one workbook; rows map names of columns to values."""
    placed = [(DAILY, 1, c, v) for c, v in ((1, "FECHA 1"), (2, "HOSPITAL"))]
    placed += [(DAILY, 2 + i, c, v) for i, row in enumerate(daily) for c, v in enumerate(row, 1)]
    # a title that has the words of a heading, but not as one
    placed += [(OUT, 3, 2, "NO. DE CASOS DE LA SEMANA"), (IN, 1, 1, "HOSPITALES Y SUS PACIENTES")]
    placed += [(OUT, OUT_HEADER, PLACES[k], v) for k, v in OUTPATIENT.items()]
    placed += [(IN, IN_HEADER + level, c, v) for level, c, v in INPATIENT_HEADER]
    for sheet, first, places, rows in (
        (OUT, OUT_FIRST + blanks, PLACES, outpatient),
        (IN, IN_FIRST, INPATIENT, inpatient),
    ):
        placed += [(sheet, first + i, places[k], v) for i, row in enumerate(rows) for k, v in row.items()]
    if phantom:
        placed += [(OUT, 90_000, 1, "x"), (OUT, 90_000, 30, " ")]
    return [cell for cell in (_cell(file, *place) for place in placed) if cell]


def cell_table(spark, *books):
    return spark.createDataFrame([c for book in books for c in book], CELL_SCHEMA)


SILVER_SCHEMA = (
    "paciente_id string, edad double, sexo string, municipio_residencia string,"
    " derechohabiencia string, fecha_notificacion timestamp_ntz,"
    " fecha_toma_muestra timestamp_ntz, fecha_resultado timestamp_ntz, resultado_prueba string,"
    " estatus_paciente string, hospital string, fecha_ingreso_hospital timestamp_ntz,"
    " es_registro_unificado boolean, dias_entre_notificacion_e_ingreso int"
)
_DEFAULT = {
    "paciente_id": "0" * 64,
    "edad": 30.0,
    "sexo": "F",
    "municipio_residencia": "OTROS",
    "derechohabiencia": "NINGUNO",
    "resultado_prueba": "PENDIENTE",
    "estatus_paciente": "AMBULATORIO",
    "es_registro_unificado": False,
}


def silver(spark, rows):
    names = [field.split()[0] for field in SILVER_SCHEMA.split(",")]

    def value(row, name):
        got = row.get(name, _DEFAULT.get(name))
        if name.startswith("fecha_") and isinstance(got, str):
            return datetime.fromisoformat(got)
        return got

    return spark.createDataFrame([tuple(value(r, n) for n in names) for r in rows], SILVER_SCHEMA)


def random_rows(n, seed=20):
    """``n`` cases over forty days with every kind of value; nothing follows a pattern."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        notified = datetime(2021, 1, 1) + timedelta(days=rng.randrange(40))
        sampled = notified + timedelta(days=rng.randrange(-1, 2))
        row = {
            "edad": rng.choice([-1.0, *map(float, range(0, 95, 3))]),
            "sexo": rng.choice(["F", "M", "OTRO", "INDETERMINADO"]),
            "resultado_prueba": rng.choice(["POSITIVO", "NEGATIVO", "PENDIENTE", "NO_CONCLUYENTE"]),
            "estatus_paciente": rng.choice(["AMBULATORIO", "HOSPITALIZADO", "DEFUNCION"]),
            "municipio_residencia": rng.choice(["TOLUCA", "ECATEPEC", "ATENCO", "OTROS"]),
            "derechohabiencia": rng.choice(["IMSS", "Issste", "SEDENA", "NINGUNO"]),
            "fecha_notificacion": notified,
            "fecha_toma_muestra": sampled,
            "fecha_resultado": sampled + timedelta(days=rng.randrange(-2, 6)),
        }
        if row["estatus_paciente"] == "HOSPITALIZADO":
            lag = rng.randrange(5)
            row["fecha_ingreso_hospital"] = notified + timedelta(days=lag)
            row["es_registro_unificado"] = True
            row["dias_entre_notificacion_e_ingreso"] = lag
        out.append(row)
    return out
