"""The queries written down in SQL, from the driver's tables alone."""

from __future__ import annotations

from caseloom import settings
from caseloom.workloads.proxy import TYPED_CELLS
from caseloom.workloads.queries import PLACES

ORACLE: dict[str, str] = {}

CASES = """
casos AS (
  SELECT
    sha256(c_name) AS paciente_id,
    CASE WHEN p_partkey % 17 = 0 THEN -1.0
         ELSE (p_size - 1) * 2 + p_partkey % 2 END::DOUBLE AS edad,
    CASE c_mktsegment WHEN 'FURNITURE' THEN 'F' WHEN 'MACHINERY' THEN 'M'
         WHEN 'HOUSEHOLD' THEN 'OTRO' ELSE 'INDETERMINADO' END AS sexo,
    n_name AS municipio_residencia,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'imss' WHEN '2-HIGH' THEN ' Issste '
         WHEN '3-MEDIUM' THEN 'Privada' WHEN '5-LOW' THEN 'SEDENA' END AS derechohabiencia,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'IMSS' WHEN '2-HIGH' THEN 'ISSSTE'
         WHEN '3-MEDIUM' THEN 'PRIVADO' WHEN '5-LOW' THEN 'OTRA' ELSE 'NINGUNA' END AS seguro,
    o_orderdate AS fecha_notificacion,
    o_orderdate + to_days((o_orderkey % 3)::INTEGER) AS fecha_toma_muestra,
    CASE WHEN NOT (l_returnflag = 'N' AND l_linenumber % 3 = 0) THEN l_shipdate END
      AS fecha_resultado,
    CASE WHEN l_returnflag = 'R' THEN 'POSITIVO' WHEN l_returnflag = 'A' THEN 'NEGATIVO'
         WHEN l_linenumber = 7 THEN 'NO_CONCLUYENTE' WHEN l_linenumber = 6 THEN 'NO_ESPECIFICADO'
         ELSE 'PENDIENTE' END AS resultado_prueba,
    CASE o_orderstatus WHEN 'O' THEN 'AMBULATORIO' WHEN 'F' THEN 'HOSPITALIZADO'
         WHEN 'P' THEN 'DEFUNCION' END AS estatus_paciente,
    CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS fecha_ingreso_hospital,
    coalesce(l_linestatus = 'F' AND abs(date_diff('day', o_orderdate, l_shipdate)) <= 7, false)
      AS unificado,
    CASE WHEN l_linestatus = 'F' AND abs(date_diff('day', o_orderdate, l_shipdate)) <= 7
         THEN abs(date_diff('day', o_orderdate, l_shipdate)) END AS lag
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey
)"""


def rate(part: str, whole: str) -> str:
    return f"CASE WHEN ({whole}) = 0 THEN 0.0::DOUBLE ELSE ({part})::DOUBLE / ({whole})::DOUBLE END"


def count(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


POS, NEG = "resultado_prueba = 'POSITIVO'", "resultado_prueba = 'NEGATIVO'"
HOSP, DEAD = "estatus_paciente = 'HOSPITALIZADO'", "estatus_paciente = 'DEFUNCION'"

# ---------------------------------------------------------------------------
# Series
# ---------------------------------------------------------------------------
EVENT_DAYS = """
limites AS (SELECT min(ts)::DATE AS a, max(ts)::DATE AS b FROM events),
dias AS (
  SELECT unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 DAY))::DATE AS fecha
  FROM limites
),
diaria AS (
  SELECT fecha, count(event_id) AS eventos,
         count(event_id) FILTER (WHERE event_type = 'purchase') AS compras,
         count(event_id) FILTER (WHERE event_type = 'error') AS errores
  FROM dias LEFT JOIN events ON ts::DATE = fecha
  GROUP BY fecha
)"""
ORACLE["daily_series"] = f"""
WITH {EVENT_DAYS}
SELECT fecha, eventos, compras, errores,
       avg(compras) OVER (ORDER BY fecha ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
         AS media_movil_7d_compras,
       (sum(compras) OVER (ORDER BY fecha))::BIGINT AS compras_acumuladas
FROM diaria"""
ORACLE["weekly_series"] = f"""
WITH {EVENT_DAYS}
SELECT date_trunc('week', fecha)::DATE AS semana, sum(eventos)::BIGINT AS eventos,
       sum(compras)::BIGINT AS compras, sum(errores)::BIGINT AS errores
FROM diaria GROUP BY 1"""

IN_WINDOW = "BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'"
CASE_DAYS = f"""
sucesos AS (
  SELECT fecha_notificacion::DATE AS d, 1 AS n, 0 AS t, 0 AS p, 0 AS g, 0 AS h,
         ({DEAD})::INTEGER AS m FROM casos
  UNION ALL SELECT fecha_toma_muestra::DATE, 0, 1, 0, 0, 0, 0 FROM casos
  UNION ALL SELECT fecha_resultado::DATE, 0, 0, ({POS})::INTEGER, ({NEG})::INTEGER, 0, 0
            FROM casos
  UNION ALL SELECT fecha_ingreso_hospital::DATE, 0, 0, 0, 0, 1, 0 FROM casos
),
dentro AS (SELECT * FROM sucesos WHERE d {IN_WINDOW}),
limites AS (SELECT min(d) AS a, max(d) AS b FROM dentro),
dias AS (
  SELECT unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 DAY))::DATE AS fecha
  FROM limites
),
conteo AS (
  SELECT fecha, coalesce(sum(n), 0)::BIGINT AS casos_notificados,
         coalesce(sum(t), 0)::BIGINT AS pruebas_tomadas,
         coalesce(sum(p), 0)::BIGINT AS resultados_positivos,
         coalesce(sum(g), 0)::BIGINT AS resultados_negativos,
         coalesce(sum(h), 0)::BIGINT AS ingresos_hospitalarios,
         coalesce(sum(m), 0)::BIGINT AS defunciones
  FROM dias LEFT JOIN dentro ON d = fecha GROUP BY fecha
),
serie AS (
  SELECT *,
         avg(resultados_positivos) OVER (ORDER BY fecha ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
           AS media_movil_7d_positivos,
         (sum(resultados_positivos) OVER (ORDER BY fecha))::BIGINT AS casos_positivos_acumulados
  FROM conteo
)"""
ORACLE["daily_series_multi_date"] = f"WITH {CASES}, {CASE_DAYS} SELECT * FROM serie"
ORACLE["curve_days"] = f"""
WITH {CASES}, {CASE_DAYS}
SELECT fecha, resultados_positivos, media_movil_7d_positivos FROM serie
WHERE fecha BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' AND resultados_positivos > 0"""
ORACLE["date_bounds"] = f"""
WITH {CASES}, fechas AS (
  SELECT unnest([fecha_notificacion, fecha_toma_muestra, fecha_resultado,
                 fecha_ingreso_hospital])::DATE AS d FROM casos)
SELECT min(d) AS primer_dia, max(d) AS ultimo_dia FROM fechas
WHERE d BETWEEN DATE '1995-03-01' AND DATE '2001-12-31'"""
ORACLE["inverted_dates"] = f"""
WITH {CASES}
SELECT {count("fecha_resultado < fecha_toma_muestra")} AS casos_fechas_invertidas,
       {count("fecha_ingreso_hospital < fecha_notificacion")} AS ingresos_antes_de_notificacion
FROM casos"""
ORACLE["undated_rows"] = f"""
WITH {CASES}
SELECT {", ".join(f'{count(c + " IS NULL")} AS sin_{c}' for c in settings.DATE_COLUMNS)},
       {count(" AND ".join(f"{c} IS NULL" for c in settings.DATE_COLUMNS))} AS sin_ninguna_fecha
FROM casos"""
ORACLE["lag_mean"] = f"""
WITH {CASES}
SELECT avg(date_diff('day', fecha_notificacion, fecha_toma_muestra))
         AS dias_notificacion_muestra,
       avg(date_diff('day', fecha_toma_muestra, fecha_resultado)) AS dias_muestra_resultado,
       avg(date_diff('day', fecha_notificacion, fecha_ingreso_hospital))
         AS dias_notificacion_ingreso
FROM casos"""


# ---------------------------------------------------------------------------
# Cubes
# ---------------------------------------------------------------------------
def bins(edges: list[tuple[str, str]], last: str, missing: str) -> str:
    tests = " ".join(f"WHEN edad {edge} THEN '{label}'" for edge, label in edges)
    return f"CASE WHEN edad IS NULL OR edad < 0 THEN '{missing}' {tests} ELSE '{last}' END"


AGE14 = bins(
    [
        (f"<= {high}", label)
        for high, label in (
            (1, "0-1"), (11, "2-11"), (17, "12-17"), (24, "18-24"), (30, "25-30"), (35, "31-35"),
            (40, "36-40"), (45, "41-45"), (50, "46-50"), (55, "51-55"), (60, "56-60"),
            (65, "61-65"),
        )
    ],
    "66+",
    "SIN_DATO",
)
AGE4 = bins([("< 18", "<18"), ("< 40", "18-39"), ("< 60", "40-59")], "60+", "SIN_DATO")
AGE10 = bins(
    [
        (f"{'<=' if high == 1 else '<'} {high}", label)
        for high, label in (
            (1, "0-1"), (12, "2-11"), (18, "12-17"), (30, "18-29"), (40, "30-39"), (50, "40-49"),
            (60, "50-59"), (70, "60-69"),
        )
    ],
    "70+",
    "SIN DATO",
)
PAIRS = """(VALUES
  ('0-1','<18'),('2-11','<18'),('12-17','<18'),('18-24','<18'),('18-24','18-39'),
  ('25-30','18-39'),('31-35','18-39'),('36-40','18-39'),('36-40','40-59'),('41-45','40-59'),
  ('46-50','40-59'),('51-55','40-59'),('56-60','40-59'),('56-60','60+'),('61-65','60+'),
  ('66+','60+'),('SIN_DATO','SIN_DATO')) AS pares(grupo_edad, grupo_edad_ui)"""
CUBE = f"""
grupos AS (
  SELECT {AGE14} AS grupo_edad, {AGE4} AS grupo_edad_ui, sexo, resultado_prueba, estatus_paciente
  FROM casos
),
dominio AS (
  SELECT * FROM {PAIRS}
  CROSS JOIN (SELECT DISTINCT sexo, resultado_prueba, estatus_paciente FROM grupos)
),
celdas AS (
  SELECT grupo_edad, grupo_edad_ui, sexo, resultado_prueba, estatus_paciente, count(*) AS n
  FROM grupos GROUP BY ALL
),
tasas AS (
  SELECT grupo_edad, sexo, {rate(count(POS), count(f"{POS} OR {NEG}"))} AS t
  FROM grupos GROUP BY ALL
),
cubo AS (
  SELECT d.*, coalesce(n, 0)::BIGINT AS total_casos,
         coalesce(n, 0)::DOUBLE / (SELECT count(*) FROM grupos) AS porcentaje_del_total,
         coalesce(t, 0.0) AS tasa_positividad_grupo
  FROM dominio d
  LEFT JOIN celdas USING (grupo_edad, grupo_edad_ui, sexo, resultado_prueba, estatus_paciente)
  LEFT JOIN tasas USING (grupo_edad, sexo)
)"""
ORACLE["demographic_cube"] = f"WITH {CASES}, {CUBE} SELECT * FROM cubo"
ORACLE["filter_demographic"] = f"""
WITH {CASES}, {CUBE} SELECT * FROM cubo WHERE sexo = 'F' AND grupo_edad_ui IN ('<18', '60+')"""


def pyramid(condition: str) -> str:
    return f"""
WITH {CASES}, {CUBE}
SELECT grupo_edad_ui, sexo, sum(total_casos)::BIGINT AS total_casos,
       (sum(total_casos) * CASE WHEN sexo = 'M' THEN -1 ELSE 1 END)::BIGINT AS casos_mostrados
FROM cubo WHERE {condition} GROUP BY grupo_edad_ui, sexo"""


ORACLE["pyramid"] = pyramid("true")
ORACLE["pyramid_known_ages"] = pyramid("grupo_edad_ui <> 'SIN_DATO'")
ORACLE["pyramid_unknown"] = f"WITH {CASES} SELECT {count('edad < 0')} AS casos_sin_dato FROM casos"
ORACLE["positivity_by_age"] = f"""
WITH {CASES}
SELECT {AGE4} AS grupo_edad_ui, {count(POS)} AS casos_positivos, {count(NEG)} AS casos_negativos,
       {rate(count(POS), count(f"{POS} OR {NEG}"))} AS tasa_positividad
FROM casos WHERE sexo IN ('F', 'M') GROUP BY 1"""
MUNICIPAL = f"""
municipal AS (
  SELECT municipio_residencia, count(*) AS total_casos, {count(POS)} AS total_positivos,
         {count(NEG)} AS total_negativos, {count(HOSP)} AS total_hospitalizados,
         {count(DEAD)} AS total_defunciones,
         {rate(count(POS), count(f"{POS} OR {NEG}"))} AS tasa_positividad,
         {rate(count(f"{POS} AND {DEAD}"), count(POS))} AS tasa_letalidad,
         {rate(count(f"{POS} AND {HOSP}"), count(POS))} AS tasa_hospitalizacion
  FROM casos GROUP BY municipio_residencia
)"""
ORACLE["municipal_rates"] = f"WITH {CASES}, {MUNICIPAL} SELECT * FROM municipal"
INSURANCE = f"""
por_seguro AS (
  SELECT seguro AS derechohabiencia, {rate(count(POS), count(f"{POS} OR {NEG}"))} AS tp,
         {rate(count(f"{POS} AND {HOSP}"), count(POS))} AS th,
         {rate(count(f"{POS} AND {DEAD}"), count(POS))} AS tl
  FROM casos GROUP BY seguro
),
seguros AS (
  SELECT c.*, total_casos::DOUBLE / (SELECT count(*) FROM casos) AS porcentaje_del_total,
         tp AS tasa_positividad_grupo, th AS tasa_hospitalizacion_grupo,
         tl AS tasa_letalidad_grupo
  FROM (SELECT seguro AS derechohabiencia, resultado_prueba, estatus_paciente,
               count(*) AS total_casos FROM casos GROUP BY ALL) c
  JOIN por_seguro USING (derechohabiencia)
)"""
ORACLE["insurance_cube"] = f"WITH {CASES}, {INSURANCE} SELECT * FROM seguros"
ORACLE["filter_insurance"] = f"""
WITH {CASES}, {INSURANCE} SELECT * FROM seguros WHERE derechohabiencia IN ('IMSS', 'PRIVADO')"""
RISK = "derechohabiencia <> 'OTRA' AND resultado_prueba <> 'NO_ESPECIFICADO' AND total_casos > 0"
ORACLE["risk_rows"] = f"WITH {CASES}, {INSURANCE} SELECT * FROM seguros WHERE {RISK}"
ORACLE["distinct_rows"] = f"""
WITH {CASES}, {INSURANCE}
SELECT DISTINCT derechohabiencia, tasa_hospitalizacion_grupo FROM seguros WHERE {RISK}"""
ORACLE["insurance_lookup"] = f"""
WITH {CASES} SELECT seguro AS derechohabiencia, count(*) AS n FROM casos GROUP BY seguro"""
ORACLE["legacy_bins"] = f"WITH {CASES} SELECT {AGE10} AS rango, count(*) AS n FROM casos GROUP BY 1"
ORACLE["age_bins"] = f"""
WITH {CASES}
SELECT edad, {AGE14} AS grupo_edad, {AGE4} AS grupo_edad_ui, count(*) AS n
FROM casos GROUP BY ALL"""
ORACLE["value_counts_result"] = f"""
WITH {CASES} SELECT resultado_prueba, count(*) AS n FROM casos GROUP BY 1"""


def crosstab(rows: str, columns: str, row_domain, column_domain) -> str:
    source = f"(SELECT *, {AGE10} AS rango FROM casos)"
    domain = ", ".join(f"('{v}')" for v in row_domain)
    counts = ", ".join(f"""{count(f"{columns} = '{v}'")} AS "{v}" """ for v in column_domain)
    return f"""
WITH {CASES}
SELECT d.{rows}, {counts}
FROM (VALUES {domain}) AS d({rows}) LEFT JOIN {source} s ON s.{rows} = d.{rows}
GROUP BY d.{rows}"""


RANGES = (*settings.LEGACY_AGE_BINS.labels, "SIN DATO")
for _name, _arguments in {
    "result_sex": ("resultado_prueba", "sexo", settings.RESULT_DOMAIN, settings.SEX_DOMAIN),
    "status_result": (
        "estatus_paciente",
        "resultado_prueba",
        settings.STATUS_DOMAIN,
        settings.RESULT_DOMAIN,
    ),
    "status_sex": ("estatus_paciente", "sexo", settings.STATUS_DOMAIN, settings.SEX_DOMAIN),
    "age_result": ("rango", "resultado_prueba", RANGES, settings.RESULT_DOMAIN),
    "age_status": ("rango", "estatus_paciente", RANGES, settings.STATUS_DOMAIN),
}.items():
    ORACLE[f"crosstab_{_name}"] = crosstab(*_arguments)

# ---------------------------------------------------------------------------
# Key figures
# ---------------------------------------------------------------------------
KPIS = f"""
kpis AS (
  SELECT count(*) AS total_pacientes_atendidos, {count(POS)} AS total_positivos,
         {count(NEG)} AS total_negativos,
         {count("resultado_prueba = 'PENDIENTE'")} AS total_pendientes,
         {count("resultado_prueba = 'NO_CONCLUYENTE'")} AS total_no_concluyentes,
         {count(HOSP)} AS total_hospitalizados, {count(DEAD)} AS total_defunciones,
         {rate(count(POS), count(f"{POS} OR {NEG}"))} AS tasa_global_positividad,
         {rate(count(f"{POS} AND {DEAD}"), count(POS))} AS tasa_global_letalidad,
         {rate(count(f"{POS} AND {HOSP}"), count(POS))} AS tasa_global_hospitalizacion,
         {count("unificado")} AS registros_unificados_cruce,
         median(lag)::DOUBLE AS mediana_dias_notificacion_ingreso,
         {count("fecha_resultado < fecha_toma_muestra")} AS casos_fechas_invertidas
  FROM casos
)"""
ORACLE["kpi_row"] = f"WITH {CASES}, {KPIS} SELECT * FROM kpis"
ORACLE["kpi_row_from_base"] = ORACLE["kpi_row"]
ORACLE["lag_percentiles"] = f"""
WITH {CASES}
SELECT quantile_cont(lag, 0.25)::DOUBLE AS p25_dias, quantile_cont(lag, 0.5)::DOUBLE AS p50_dias,
       quantile_cont(lag, 0.75)::DOUBLE AS p75_dias FROM casos"""
ORACLE["kpi_view_stored"] = f"""
WITH {CASES}, {KPIS}
SELECT total_pacientes_atendidos AS total_pruebas, total_positivos AS casos_positivos_confirmados,
       tasa_global_positividad, tasa_global_hospitalizacion AS tasa_hospitalizacion FROM kpis"""


def cube_view(condition: str) -> str:
    return f"""
WITH {CASES}
SELECT count(*) AS total_pruebas, {count(POS)} AS casos_positivos_confirmados,
       {rate(count(POS), count(f"{POS} OR {NEG}"))} AS tasa_global_positividad,
       {rate(count(f"{POS} AND {HOSP}"), count(POS))} AS tasa_hospitalizacion
FROM casos WHERE {condition}"""


ORACLE["kpi_view_insurance"] = cube_view("seguro IN ('IMSS', 'ISSSTE')")
ORACLE["kpi_view_demographic"] = cube_view("sexo = 'F' AND edad >= 18 AND edad < 40")
ORACLE["kpi_view_days"] = f"""
WITH {CASES}, {CASE_DAYS}
SELECT sum(pruebas_tomadas)::BIGINT AS total_pruebas,
       sum(resultados_positivos)::BIGINT AS casos_positivos_confirmados,
       {rate("sum(resultados_positivos)", "sum(resultados_positivos + resultados_negativos)")}
         AS tasa_global_positividad,
       {rate("sum(ingresos_hospitalarios)", "sum(resultados_positivos)")} AS tasa_hospitalizacion
FROM serie WHERE fecha BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'"""
ORACLE["kpi_view_missing_cube"] = f"""
WITH {CASES}, c AS (
  SELECT s.sexo, count(edad) AS total_pruebas, {count(POS)} AS casos_positivos_confirmados,
    {count(NEG)} AS negativos, {count(f"{POS} AND {HOSP}")} AS graves
  FROM (SELECT unnest(['F', 'OTRO']) AS sexo) s LEFT JOIN casos ON casos.sexo = s.sexo AND s.sexo <> 'OTRO' AND edad >= 0
  GROUP BY s.sexo
)
SELECT sexo, total_pruebas, casos_positivos_confirmados,
  {rate("casos_positivos_confirmados", "casos_positivos_confirmados + negativos")} AS tasa_global_positividad,
  {rate("graves", "casos_positivos_confirmados")} AS tasa_hospitalizacion FROM c"""
ORACLE["kpi_view_empty_kpis"] = ORACLE["kpi_view_days"].split(" FROM serie WHERE")[0].split("\nFROM serie WHERE")[0] + " FROM serie"
ORACLE["crosstab_other"] = """
WITH t AS (
  SELECT CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_mktsegment ELSE 'OTRO' END AS c_mktsegment,
         o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey
  UNION ALL SELECT unnest(['BUILDING', 'MACHINERY', 'NONE', 'OTRO']), NULL
)
SELECT c_mktsegment, count(*) FILTER (o_orderstatus = 'O') AS O, count(*) FILTER (o_orderstatus = 'F') AS F,
       count(*) FILTER (o_orderstatus NOT IN ('O', 'F')) AS OTRO FROM t GROUP BY 1"""
ORACLE["safe_rate"] = f"""
SELECT l_orderkey, {count("l_returnflag = 'R'")} AS positivos,
       {count("l_returnflag = 'A'")} AS negativos,
       {rate(count("l_returnflag = 'R'"), count("l_returnflag IN ('R', 'A')"))} AS tasa
FROM lineitem GROUP BY l_orderkey"""


# ---------------------------------------------------------------------------
# Linkage
# ---------------------------------------------------------------------------
def candidates(days: int) -> str:
    return f"""
SELECT n.o_orderkey, count(h.o_orderkey) AS n_candidates,
       min(abs(date_diff('day', n.o_orderdate, h.o_orderdate)))::INTEGER AS nearest_days
FROM orders n LEFT JOIN orders h
  ON n.o_custkey = h.o_custkey AND h.o_orderkey % 2 = 1
 AND abs(date_diff('day', n.o_orderdate, h.o_orderdate)) <= {days}
WHERE n.o_orderkey % 2 = 0 GROUP BY n.o_orderkey"""


ORACLE["link_candidates"] = candidates(7)
ORACLE["link_candidates_90_days"] = candidates(90)


def day_distance(start: str, end: str) -> str:
    """Whole days apart, where a negative distance is floored first."""
    return f"abs(floor((epoch_us({end}) - epoch_us({start})) / 86400000000.0))::BIGINT"


def greedy(source: str, days: int) -> str:
    """CTEs ``enlace(id, h, dias, cand)`` over ``source(k, id, n, h)``: one step per rank."""
    apart = day_distance("a.n", "x.d")
    return f"""
filas AS ({source}),
avisos AS (
  SELECT k, id, n, row_number() OVER (PARTITION BY k ORDER BY id) AS rn
  FROM filas WHERE n IS NOT NULL
),
camas AS (
  SELECT k, list({{'id': id, 'd': h}} ORDER BY id) AS camas
  FROM filas WHERE h IS NOT NULL GROUP BY k
),
paso(k, rn, usadas, id, mejor, cand) AS (
  SELECT k, 0::BIGINT, []::BIGINT[], NULL::BIGINT,
         NULL::STRUCT(dias BIGINT, id BIGINT), 0::BIGINT
  FROM camas
  UNION ALL
  SELECT k, rn, CASE WHEN mejor IS NULL THEN usadas ELSE list_append(usadas, mejor.id) END,
         id, mejor, cand
  FROM (
    SELECT k, rn, usadas, id, list_min(cerca) AS mejor, len(cerca) AS cand
    FROM (
      SELECT p.k, a.rn, p.usadas, a.id,
             list_transform(
               list_filter(c.camas, lambda x: NOT list_contains(p.usadas, x.id)
                           AND {apart} <= {days}),
               lambda x: {{'dias': {apart}, 'id': x.id}}) AS cerca
      FROM paso p JOIN avisos a ON a.k = p.k AND a.rn = p.rn + 1 JOIN camas c ON c.k = p.k
    )
  )
),
enlace AS (
  SELECT id, mejor.id AS h, mejor.dias::INTEGER AS dias, cand FROM paso WHERE mejor IS NOT NULL
)"""


ORDER_DAYS = """SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate END AS n,
      CASE WHEN o_orderkey % 2 = 1 THEN o_orderdate END AS h FROM orders"""
MONTHLY = """SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN day + INTERVAL 1 MINUTE *
        CASE WHEN o_orderkey % 1000 = 0 THEN 61 ELSE (o_orderkey % 3 + 3) * 240 END END AS n,
      CASE WHEN o_orderkey % 2 = 1 THEN day + INTERVAL 1 MINUTE * (o_orderkey * 7919 % 1440) END AS h
    FROM (SELECT *, o_orderdate + INTERVAL 1 DAY * ((year(o_orderdate) - 1995) * 12 + month(o_orderdate)) * 21 AS day
          FROM orders)"""


def greedy_orders(key: str, days: int, source: str = ORDER_DAYS) -> str:
    rows = f"SELECT {key} AS k, o_orderkey AS id, n, h FROM ({source})"
    return f"""
WITH RECURSIVE {greedy(rows, days)}
SELECT f.id AS o_orderkey, e.h AS taken_orderkey, e.dias, coalesce(e.cand > 1, false) AS colision
FROM filas f LEFT JOIN enlace e ON e.id = f.id
WHERE f.id NOT IN (SELECT h FROM enlace)"""


ORACLE["link_greedy"] = greedy_orders("o_custkey", 7)
ORACLE["link_greedy_90_days"] = greedy_orders("o_custkey", 90)
ORACLE["link_greedy_hot_keys"] = greedy_orders("o_orderpriority", 7)
ORACLE["link_greedy_hot_many_chunks"] = ORACLE["link_greedy_hot_keys"]
ORACLE["link_greedy_hot_clock"] = greedy_orders("o_orderpriority", 7, MONTHLY)
ORACLE["link_candidates_one_key"] = f"""
WITH r AS ({MONTHLY})
SELECT a.o_orderkey, count(b.o_orderkey) AS n_candidates, min({day_distance("a.n", "b.h")})::INTEGER AS nearest_days
FROM r a LEFT JOIN r b ON b.h IS NOT NULL AND {day_distance("a.n", "b.h")} <= 7
WHERE a.n IS NOT NULL GROUP BY a.o_orderkey"""

SERIAL = "date_diff('day', DATE '1899-12-30', o_orderdate::DATE)::VARCHAR"
PLAIN = "strftime(o_orderdate, '%d/%m/%Y')"
# Registries of orders: even keys notify, odd ones admit. ``r`` is the result's day, which
# stands in the result's cell in every eleventh order and is put back where it is plausible.
CLEAN = """
pedidos AS (
  SELECT *, o_orderkey % 2 = 0 AS par, o_orderkey // 2 % 6 AS modo, o_orderkey % 11 = 3 AS cruzado,
         o_orderdate + INTERVAL 1 DAY * (o_orderkey % 3) AS m,
         o_orderdate + INTERVAL 1 DAY * (o_orderkey % 5) AS r,
         CASE o_orderstatus WHEN 'O' THEN 'POSITIVO' WHEN 'F' THEN 'NEGATIVO' ELSE 'PENDIENTE' END AS palabra
  FROM orders JOIN customer ON o_custkey = c_custkey
),
fechas AS (
  SELECT *, CASE WHEN par THEN CASE WHEN modo = 4 THEN o_orderdate + INTERVAL 20 YEAR ELSE o_orderdate END END AS aviso,
         CASE WHEN NOT par THEN o_orderdate END AS ingreso, CASE WHEN par THEN m END AS muestra,
         CASE WHEN cruzado AND r < TIMESTAMP '1995-06-01' THEN NULL ELSE r END AS lectura,
         cruzado AND r >= TIMESTAMP '1995-06-01' AND r < TIMESTAMP '2002-01-01' AS intercambiado
  FROM pedidos
),
limpios AS (
  SELECT o_orderkey AS row_order, sha256(upper(c_name) || c_custkey || 'salt') AS paciente_id,
         (c_custkey % 90)::DOUBLE AS edad,
         CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS sexo,
         CASE WHEN NOT par THEN 'OTROS' WHEN c_nationkey % 3 = 0 THEN 'NEZAHUALCOYOTL'
              WHEN c_nationkey % 3 = 1 THEN 'ECATEPEC' ELSE 'OTROS' END AS municipio_residencia,
         CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority ELSE 'NINGUNO' END AS derechohabiencia,
         CASE WHEN aviso BETWEEN TIMESTAMP '1995-06-01' AND TIMESTAMP '2001-12-31' THEN aviso END AS n,
         CASE WHEN ingreso BETWEEN TIMESTAMP '1995-06-01' AND TIMESTAMP '2001-12-31' THEN ingreso END AS h,
         CASE WHEN muestra BETWEEN TIMESTAMP '1995-06-01' AND TIMESTAMP '2001-12-31' THEN muestra END AS fecha_toma_muestra,
         CASE WHEN lectura BETWEEN TIMESTAMP '1995-06-01' AND TIMESTAMP '2001-12-31' THEN lectura END AS fecha_resultado,
         CASE WHEN cruzado AND NOT intercambiado THEN 'NO_ESPECIFICADO' ELSE palabra END AS resultado_prueba,
         CASE WHEN NOT par THEN 'NO_ESPECIFICADO' WHEN o_orderkey % 6 = 0
              THEN 'AMBULATORIO' WHEN o_orderkey % 6 = 2 THEN 'DEFUNCION'
              ELSE 'HOSPITALIZADO' END AS estatus_paciente,
         CASE WHEN NOT par THEN 'H' || (o_orderkey % 7) END AS hospital,
         intercambiado AS columnas_intercambiadas,
         len(list_filter([aviso, ingreso, muestra, lectura], lambda d: NOT d BETWEEN TIMESTAMP '1995-06-01' AND TIMESTAMP '2001-12-31'))::INTEGER
           AS fechas_anomalas
  FROM fechas
)"""
RAW_RESULT = """CASE o_orderstatus WHEN 'O' THEN 'Detectado' WHEN 'F' THEN 'NO  DETECTADO' ELSE 'Trámite' END"""
ORACLE["ingest_registries"] = f"""
WITH {CLEAN}, c AS (SELECT *, {RAW_RESULT} AS dicho, strftime(r, '%d/%m/%Y') AS dia FROM pedidos)
SELECT sha256(upper(c_name) || c_custkey || 'salt') AS paciente_id, CASE WHEN par THEN 'seguimiento' ELSE 'nominal' END AS fuente,
  c_custkey::VARCHAR AS folio_origen, (c_custkey % 90)::VARCHAR AS edad_raw,
  CASE WHEN c_nationkey % 2 = 0 THEN CASE WHEN par THEN 'f' ELSE 'F' END ELSE 'M' END AS sexo_raw,
  CASE WHEN par THEN CASE c_nationkey % 3 WHEN 0 THEN 'Nezahualcóyotl' WHEN 1 THEN ' ecatepec  de Morelos' ELSE 'x' END END AS municipio_raw,
  CASE WHEN par AND o_orderkey % 4 = 0 THEN o_orderpriority END AS derechohabiencia_raw,
  CASE WHEN cruzado THEN dia ELSE dicho END AS resultado_raw,
  CASE WHEN par THEN CASE o_orderkey % 6 WHEN 0 THEN 'casa' WHEN 2 THEN 'Óbito' ELSE 'HOSPITAL' END END AS estatus_raw,
  CASE WHEN NOT par THEN 'H' || (o_orderkey % 7) END AS hospital_raw,
  CASE WHEN par THEN CASE modo WHEN 0 THEN {SERIAL} WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
    WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 3 THEN replace({PLAIN}, '1999', '9199')
    WHEN 4 THEN strftime(o_orderdate + INTERVAL 20 YEAR, '%d/%m/%Y') ELSE {PLAIN} END END AS fecha_notificacion,
  CASE WHEN cruzado THEN dicho ELSE dia END AS fecha_resultado,
  CASE WHEN NOT par THEN CASE o_orderkey // 2 % 3 WHEN 0 THEN {SERIAL} WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') ELSE {PLAIN} END END AS fecha_ingreso,
  CASE WHEN par THEN CASE modo WHEN 0 THEN 'number' WHEN 1 THEN 'datetime' ELSE 'text' END END AS tipo_notificacion,
  (SELECT count(*) FROM nation) AS filas_red_negativa
FROM c"""
ORACLE["clean_cases"] = f"""
WITH {CLEAN}
SELECT row_order, edad, sexo, municipio_residencia, derechohabiencia,
       n::DATE AS fecha_notificacion, h::DATE AS fecha_ingreso_hospital, fecha_toma_muestra::DATE AS fecha_toma_muestra,
       fecha_resultado::DATE AS fecha_resultado, resultado_prueba,
       estatus_paciente, hospital, columnas_intercambiadas, fechas_anomalas
FROM limpios"""


def linked(days: int) -> str:
    """The unified cases as a CTE ``unidos``, of admissions ``days`` away at most."""
    source = "SELECT paciente_id AS k, row_order AS id, n, h FROM limpios"
    return f"""{greedy(source, days)},
unidos AS (
  SELECT l.paciente_id, l.edad, l.sexo, l.municipio_residencia, l.derechohabiencia,
       l.n AS fecha_notificacion, l.fecha_toma_muestra, l.fecha_resultado, l.resultado_prueba,
       CASE WHEN e.id IS NULL THEN l.estatus_paciente ELSE 'HOSPITALIZADO' END
         AS estatus_paciente,
       coalesce(t.hospital, l.hospital) AS hospital,
       coalesce(t.h, l.h) AS fecha_ingreso_hospital,
       e.id IS NOT NULL AS es_registro_unificado, e.dias AS dias_entre_notificacion_e_ingreso,
       coalesce(e.cand > 1, false) AS link_collided
  FROM limpios l LEFT JOIN enlace e ON e.id = l.row_order LEFT JOIN limpios t ON t.row_order = e.h
  WHERE l.row_order NOT IN (SELECT h FROM enlace)
)"""


ORACLE["unified_cases"] = f"""
WITH RECURSIVE {CLEAN}, {linked(30)}
SELECT * REPLACE (fecha_notificacion::DATE AS fecha_notificacion, fecha_toma_muestra::DATE AS fecha_toma_muestra,
  fecha_resultado::DATE AS fecha_resultado, fecha_ingreso_hospital::DATE AS fecha_ingreso_hospital) FROM unidos"""
QUALITY = """
SELECT a AS filas_leidas_bronze_seguimiento, b AS filas_leidas_bronze_nominal,
       a + b AS registros_hasheados, cruces AS cruces_exitosos, sueltos AS registros_huerfanos,
       sueltos::DOUBLE / (sueltos + cruces) AS porcentaje_huerfanos,
       c AS correcciones_columnas_intercambiadas,
       choques AS colisiones_llave_sintetica, f AS fechas_anomalas_fuera_ventana
FROM (
  SELECT count(*) FILTER (es_registro_unificado) AS cruces, count(*) FILTER (NOT es_registro_unificado) AS sueltos,
         count(*) FILTER (link_collided) AS choques FROM unidos
), (
  SELECT count(*) FILTER (WHERE row_order % 2 = 0) AS a, count(*) FILTER (columnas_intercambiadas) AS c,
         count(*) FILTER (WHERE row_order % 2 = 1) AS b, sum(fechas_anomalas)::BIGINT AS f
  FROM limpios
)"""
ORACLE["full_run"] = f"""
WITH RECURSIVE {CLEAN}, {linked(30)}, figuras AS (
  SELECT count(*) AS total_pacientes_atendidos, {count("resultado_prueba = 'POSITIVO'")} AS total_positivos,
    {count("resultado_prueba = 'NEGATIVO'")} AS total_negativos, {count("resultado_prueba = 'PENDIENTE'")} AS total_pendientes,
    {count("resultado_prueba = 'NO_CONCLUYENTE'")} AS total_no_concluyentes,
    {count("estatus_paciente = 'HOSPITALIZADO'")} AS total_hospitalizados, {count("estatus_paciente = 'DEFUNCION'")} AS total_defunciones,
    {count("es_registro_unificado")} AS registros_unificados_cruce,
    median(dias_entre_notificacion_e_ingreso) FILTER (es_registro_unificado) AS mediana_dias_notificacion_ingreso,
    {count("fecha_resultado < fecha_toma_muestra")} AS casos_fechas_invertidas,
    {count("resultado_prueba = 'POSITIVO' AND estatus_paciente = 'DEFUNCION'")} AS letales,
    {count("resultado_prueba = 'POSITIVO' AND estatus_paciente = 'HOSPITALIZADO'")} AS graves
  FROM unidos
)
SELECT * EXCLUDE (letales, graves), {rate("total_positivos", "total_positivos + total_negativos")} AS tasa_global_positividad,
  {rate("letales", "total_positivos")} AS tasa_global_letalidad, {rate("graves", "total_positivos")} AS tasa_global_hospitalizacion,
  1 AS codigo_sin_celdas, 0 AS codigo, 8::BIGINT AS publicados
FROM figuras"""
ORACLE["contract_enforced"] = """
SELECT count(*) AS filas, regla, regla <> '' AS rechazada
FROM lineitem, (SELECT unnest(['', 'paciente_id', 'edad', 'sexo', 'municipio_residencia', 'derechohabiencia',
  'resultado_prueba', 'estatus_paciente', 'es_registro_unificado']) AS regla) GROUP BY regla"""
ORACLE["quality_summary"] = f"WITH RECURSIVE {CLEAN}, {linked(30)} {QUALITY}"

# ---------------------------------------------------------------------------
# Text and identity
# ---------------------------------------------------------------------------
_UPPER = "replace(upper(text), 'ẞ', 'SS')"


def spaced(value: str) -> str:
    return rf"trim(regexp_replace({value}, '[\s\x0b\x1c-\x1f\x{{85}}\x{{a0}}]+', ' ', 'g'))"


ORACLE["normalize_text"] = f"""
SELECT doc_id, {spaced(f"strip_accents({_UPPER})")} AS texto FROM documents"""
# a syllable's number is (lead * 21 + vowel) * 28 + tail
ORACLE["normalize_hangul"] = """
WITH n AS (SELECT c_custkey, c_name, c_nationkey * 449 % 11172 AS n FROM customer)
SELECT c_custkey, chr((4352 + n // 588)::INTEGER) || chr((4449 + n % 588 // 28)::INTEGER)
  || CASE WHEN n % 28 > 0 THEN chr((4519 + n % 28)::INTEGER) ELSE '' END || 'E ' || upper(c_name) AS texto FROM n"""
_TILDES = f"replace(replace(replace({_UPPER}, 'Ñ', '\x01'), 'Ã', '\x02'), 'Õ', '\x03')"
_NAME = f"""replace(replace(replace(strip_accents({_TILDES}),
  '\x01', 'Ñ'), '\x02', 'Ã'), '\x03', 'Õ')"""
ORACLE["pseudonymize"] = f"""
SELECT doc_id, sha256({spaced(_NAME)} ||
  CASE WHEN doc_id % 5 <> 0 THEN doc_id::VARCHAR ELSE '' END || 'salt') AS paciente_id
FROM documents"""
ORACLE["pii_projection"] = """
SELECT sha256(upper(c_name) || 'salt') AS paciente_id, c_nationkey, c_mktsegment FROM customer"""
ORACLE["coerce_text"] = r"""
SELECT p_partkey, regexp_replace(p_retailprice::VARCHAR, '\.0+$', '') AS folio FROM part"""
ORACLE["catalog_lookup"] = """
SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'A' WHEN 'MEDIUM' THEN 'B' WHEN 'LARGE' THEN 'B'
  WHEN 'SMALL' THEN 'C' ELSE 'OTROS' END AS tipo FROM part"""
ORACLE["catalog_table_lookup"] = """
SELECT c_custkey, CASE WHEN n_nationkey % 5 > 0 THEN 'R' || n_regionkey ELSE 'OTROS' END AS region
FROM customer JOIN nation ON c_nationkey = n_nationkey"""
ORACLE["default_if_empty"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN o_orderpriority ELSE 'NINGUNO' END
  AS derechohabiencia FROM orders"""
MAP_NAME = """CASE WHEN split_part(municipio_residencia, '_', 2)::INTEGER % 4 = 3
  THEN municipio_residencia || ' DE MAPA' ELSE municipio_residencia END"""
ORACLE["alias_names"] = f"""
WITH {CASES} SELECT DISTINCT municipio_residencia, {MAP_NAME} AS municipio_mapa FROM casos"""


def cascade(source: str, key: str, column: str, calls, whole_cell: bool) -> str:
    """One subquery per call, one CASE per pattern of the call."""
    current = source
    for patterns, value in calls:
        text = column
        for pattern in patterns:
            quoted = pattern.replace("'", "''")
            replaced = (
                f"'{value}'"
                if whole_cell
                else f"regexp_replace({text}, '{quoted}', '{value}', 'g')"
            )
            text = f"CASE WHEN regexp_matches({column}, '{quoted}') THEN {replaced} ELSE {text} END"
        current = f"(SELECT {key}, {text} AS {column} FROM {current})"
    return f"SELECT {key}, {column} FROM {current}"


ORACLE["regex_cascade"] = cascade(
    "(SELECT p_partkey, p_type AS tipo FROM part)",
    "p_partkey",
    "tipo",
    ((("M", "^P.*", "L"), "LL"), (("LL.*",), "x"), (("(^.*A.*$)",), "CON_A")),
    whole_cell=False,
)
ORACLE["status_cascade"] = """
SELECT o_orderkey, CASE o_orderkey % 7 WHEN 1 THEN 'AMBULATORIO' WHEN 2 THEN 'AMBULATORIO'
  WHEN 3 THEN 'DEFUNCION' WHEN 4 THEN 'HOSPITALIZADO' WHEN 5 THEN 'HOSPITALIZADO'
  WHEN 6 THEN 'OTRO' ELSE 'AMBULATORIO' END AS estatus FROM orders"""
_PLACE = " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(PLACES))
# The same rules, written out apart from the code under test
RESIDENCE_RULES = (
    (
        (
            "^NIC.*",
            "^CHIA.*",
            "(^.*JA.*$)",
            "(^.*VER.*$)",
            "^HID.*",
            "^DA.*",
            "(^.*EEUU.*$)",
            "^MOR.*",
            "^PUEB.*",
            "^SONO.*",
            "(^.*JUAR.*$)",
        ),
        "FORANEO",
    ),
    (("(^.*GUSTAVO.*$)", "(^.*GAM.*$)"), "GUSTAVO A. MADERO"),
    (("(^.*IZTAP.*$)", "(^.*APA.*$)"), "IZTAPALAPA"),
    (("(^.*IZTAC.*$)", "(^.*LCO.*$)", "(^.*AGRICOLA.*$)", "(^.*ORIENTAL.*$)"), "IZTACALCO"),
    (("(^.*CHIMA.*$)", "(^.*HUACAN.*$)"), "CHIMALHUACAN"),
    (("(^.*NEZA.*$)", "(^.*AV..*$)", "(^.*CORO.*$)"), "NEZAHUALCOYOTL"),
    (("(^.*BENI.*$)",), "BENITO JUAREZ"),
    (("(^.*CUAU.*$)", "(^.*CUAH.*$)"), "CUAUHTEMOC"),
    (("(^.*COYO.*$)",), "COYOACAN"),
    (("(^.*CUAJ.*$)",), "CUAJIMALPA"),
    (("(^.*ECAT.*$)",), "ECATEPEC"),
    (("(^.*XOCH.*$)",), "XOCHIMILCO"),
    (("(^.*ALVARO.*$)",), "ALVARO OBREGON"),
    (("(^.*AMECA.*$)", "(^.*CAMINO.*$)"), "AMECAMECA"),
    (("(^.*JUCHITE.*$)",), "JUCHITEPEC"),
    (("(^.*TLA.*$)",), "TLALPAN"),
    (("(^.*AZCAP.*$)",), "AZCAPOTZALCO"),
    (("(^.*IXTA.*$)", "(^.*LA MAG.*$)"), "IXTAPALUCA"),
    (("(^.*MIGUE.*$)",), "MIGUEL HIDALGO"),
    (("(^.*VENU.*$)",), "VENUSTIANO CARRANZA"),
    (("(^.*PAZ.*$)", "(^.*REYES.*$)"), "LOS REYES - LA PAZ"),
    (("(^.*TECA.*$)", "(^.*AMAC.*$)"), "TECAMAC"),
    (("(^.*TEX.*$)", "(^.*COCO.*$)"), "TEXCOCO"),
    (("(^.*CHIN.*$)", "(^.*CONCUAC.*$)"), "CHINCONCUAC"),
    (("(^.*TULTE.*$)", "(^.*SAN PABLO.*$)"), "TULTEPEC"),
    (("(^.*NAUC.*$)",), "NAUCALPAN"),
    (("(^.*ATEN.*$)",), "ATENCO"),
    (("(^.*HUIX.*$)",), "HUIXQUILUCAN"),
    (("(^.*ACOL.*$)",), "ACOLMAN"),
    (("(^.*TOL.*$)",), "TOLUCA"),
    (("(^.*LER.*$)",), "LERMA"),
    (("(^.*TEPET.*$)", "(^.*LIXPA.*$)"), "TEPETLIXPA"),
    (("(^.*TEOL.*$)",), "TEOLOYUCAN"),
    (("(^.*CHICO.*$)",), "CHICOLOAPAN"),
    (("(^.*NICOL.*$)",), "NICOLAS ROMERO"),
    (("(^.*TENAN.*$)",), "TENANGO DEL VALLE"),
)
ORACLE["residence_cascade"] = cascade(
    f"(SELECT c_custkey, CASE c_custkey % {len(PLACES) + 1} {_PLACE} ELSE 'FORANEO' END"
    " AS residencia FROM customer)",
    "c_custkey",
    "residencia",
    RESIDENCE_RULES,
    whole_cell=True,
)
# The rules of the older report, written out apart from the code under test
RULES = {
    "country": ((("^MEX.*", "^MÉX.*"), "MÉXICO"),),
    "sample": (
        (("(^.*PENS.*$)", "(^.*PEND.*$)", "(^.*NEG.*$)", "(^.*POS.*$)"), "PENDIENTE"),
        (("(^.*NO.*$)",), "NO SE TOMÓ"),
    ),
    "result": (
        (("^POS.*", "^´POS.*"), "POSITIVO"),
        (("^NEG.*", "^ NEG.*"), "NEGATIVO"),
        (("^IN.*", "^´NO.*", "M.*", "NO.*", "PEN.*", "REC.*", "SIN.*"), "SOSPECHOSO"),
    ),
    "result_date": (
        (("(^.*PENS.*$)", "(^.*PEND.*$)"), "PENDIENTE"),
        (("(^.*NO.*$)", "(^.*ERR.*$)", "(^.*DEF.*$)", "(^.*SIN.*$)"), "NO SE TOMÓ"),
        (("(^.*NEG.*$)",), "NEGATIVO"),
        (("(^.*PO.*$)",), "POSITIVO"),
    ),
    "result_date_second": ((("(^.*P.*$)", "(^.*NE.*$)"), "PENDIENTE"),),
    "age": ((("(^.*RN.*$)", "(^.*D.*$)", "(^.*ME.*$)", "(^.*d.*$)", "(^.*m.*$)"), "0"),),
    "age_second": ((("(^.*M.*$)", "(^.*H.*$)", "(^.*N.*$)", "(^.*,M.*$)"), "M"),),
    "sex": (
        (("(^.*F.*$)",), "F"),
        (("(^.*M.*$)", "(^.*H.*$)", "(^.*N.*$)"), "M"),
        (("(^.*RN.*$)", "(^.*D.*$)"), "0"),
        (("(^.*AÑ.*$)",), ""),
    ),
    "sex_second": (
        (("(^.*F.*$)",), "F"),
        (("(^.*M.*$)", "(^.*H.*$)", "(^.*N.*$)", "(^.*,M.*$)"), "M"),
        (("(^.*G.*$)", "(^.*SN.*$)", "(^.*X.*$)", "(^.*R.*$)"), "OTRO"),
    ),
}
for _rule, _calls in RULES.items():
    _cells = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(TYPED_CELLS[_rule]))
    ORACLE[f"{_rule}_cascade"] = cascade(
        f"(SELECT o_orderkey, CASE o_orderkey % {len(TYPED_CELLS[_rule]) + 1} {_cells} END AS celda FROM orders)",
        "o_orderkey",
        "celda",
        _calls,
        whole_cell=False,
    )
_PICKED = "CASE o_orderkey % 5 WHEN 0 THEN 'POSITIVO' WHEN 1 THEN 'NEGATIVO' ELSE 'SOSPECHOSO' END"
_OLDER_AGES = [(0, 1, "0-1"), (2, 11, "2-11"), (12, 17, "12-17"), (18, 29, "18-29"), (30, 39, "30-39"), (40, 49, "40-49"),
               (50, 59, "50-59"), (60, 69, "60-69"), (70, 200, "70+")]
_BANDS = " ".join(f"WHEN edad BETWEEN {a} AND {b} THEN '{name}'" for a, b, name in _OLDER_AGES)
_DOMAINS = {
    "resultado": ["POSITIVO", "NEGATIVO", "SOSPECHOSO", "RESTO"],
    "sexo": ["M", "F", "OTRO", "RESTO"],
    "estatus": ["AMBULATORIO", "HOSPITALIZADO", "DEFUNCION", "RESTO"],
    "rango": [*(name for _, _, name in _OLDER_AGES), "SIN DATO", "RESTO"],
}
# FEMENINO in the age's cell is read as an age in months before cells are exchanged
ORACLE["older_crosstabs"] = f"""
WITH t AS (
  SELECT {_PICKED} AS resultado, CASE WHEN o_orderkey % 4 = 0 AND o_orderkey % 11 = 5 THEN 'OTRO'
      WHEN o_orderkey % 4 IN (0, 3) THEN 'F' ELSE 'M' END AS sexo,
    CASE o_orderkey % 8 WHEN 0 THEN 'AMBULATORIO' WHEN 1 THEN 'AMBULATORIO' WHEN 2 THEN 'DEFUNCION'
      WHEN 4 THEN 'HOSPITALIZADO' WHEN 5 THEN 'HOSPITALIZADO' ELSE 'RESTO' END AS estatus,
    CASE WHEN o_orderkey % 11 <> 5 AND o_orderkey % 13 < 2 THEN 0 ELSE o_custkey % 97 END AS edad
  FROM orders
), e AS (SELECT *, CASE {_BANDS} ELSE 'SIN DATO' END AS rango FROM t)
""" + " UNION ALL ".join(
    f"""SELECT '{name}' AS tabla, fila, columna, count(e.{row}) AS n
FROM (SELECT unnest({_DOMAINS[row]}) AS fila) CROSS JOIN (SELECT unnest({_DOMAINS[column]}) AS columna)
LEFT JOIN e ON e.{row} = fila AND e.{column} = columna GROUP BY fila, columna"""
    for name, (row, column) in {
        "resultado_sexo": ("resultado", "sexo"),
        "estatus_resultado": ("estatus", "resultado"),
        "estatus_sexo": ("estatus", "sexo"),
        "edad_resultado": ("rango", "resultado"),
        "edad_estatus": ("rango", "estatus"),
    }.items()
)
ORACLE["whitelist"] = """
SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_mktsegment
  ELSE 'SOSPECHOSO' END AS resultado FROM customer"""
ORACLE["fill_null"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority ELSE 'NINGUNO' END
  AS prioridad, CASE WHEN o_orderkey % 4 > 0 THEN o_orderstatus ELSE 'FORANEO' END AS estatus
FROM orders"""

# ---------------------------------------------------------------------------
# Dates, ages and sexes
# ---------------------------------------------------------------------------
ORACLE["parse_dates"] = """
WITH d AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 10 IN (7, 9) THEN NULL
    WHEN year(o_orderdate) = 1998 AND month(o_orderdate) > 6
    THEN o_orderdate - INTERVAL 2 YEAR ELSE o_orderdate END AS f FROM orders)
SELECT o_orderkey, CASE WHEN f < TIMESTAMP '2001-01-01' THEN f::DATE END AS fecha,
       coalesce(f >= TIMESTAMP '2001-01-01', false) AS anomalia FROM d"""
ORACLE["parse_date_shapes"] = """
WITH d AS (SELECT o_orderkey, o_orderkey % 20 AS w, (o_orderdate + INTERVAL 10 YEAR)::DATE AS f FROM orders)
SELECT o_orderkey, w > 16 AS ilegible,
       CASE WHEN w = 16 THEN date_trunc('month', f)::DATE WHEN w < 16 THEN f END AS fecha FROM d"""
ORACLE["parse_date_clocks"] = """
SELECT o_orderkey, ilegible, strftime(t, '%Y-%m-%d %H:%M:%S') AS leida FROM (WITH d AS (SELECT o_orderkey, o_orderkey % 9 AS w, o_orderdate + INTERVAL 1 SECOND * (o_orderkey * 7919 % 86400) AS f FROM orders)
SELECT o_orderkey, w > 6 AS ilegible, CASE w WHEN 0 THEN date_trunc('minute', f) WHEN 1 THEN date_trunc('second', f)
  WHEN 2 THEN date_trunc('minute', f) WHEN 3 THEN date_trunc('day', f)::TIMESTAMP WHEN 4 THEN date_trunc('minute', f)
  WHEN 5 THEN date_trunc('minute', f) WHEN 6 THEN date_trunc('hour', f) END AS t FROM d)"""
RESULT_CELLS = """
c AS (
  SELECT o_orderkey, o_orderkey % 4 AS w, strftime(o_orderdate, '%d/%m/%Y') AS dia, o_orderdate,
         CASE o_orderstatus WHEN 'O' THEN 'POSITIVO' WHEN 'F' THEN 'NEGATIVO'
              ELSE 'RECHAZO' END AS r
  FROM orders
)"""
ORACLE["swap_repair"] = f"""
WITH {RESULT_CELLS}, s AS (
  SELECT *, w = 0 AND o_orderdate < TIMESTAMP '2001-01-01' AS intercambio FROM c)
SELECT o_orderkey, CASE WHEN w = 0 AND NOT intercambio THEN dia ELSE r END AS resultado,
       CASE WHEN w = 0 AND NOT intercambio THEN r WHEN w < 3 THEN dia END AS fecha_resultado,
       intercambio FROM s"""
ORACLE["legacy_swap"] = f"""
WITH {RESULT_CELLS}
SELECT o_orderkey, r AS resultado, CASE WHEN w < 3 THEN dia END AS fecha_resultado FROM c"""
ORACLE["parse_age_sex"] = """
SELECT p_partkey,
       CASE p_partkey % 7 WHEN 1 THEN 0 WHEN 2 THEN 0 WHEN 6 THEN -1 ELSE p_size END::DOUBLE
         AS edad,
       CASE p_partkey % 7 WHEN 0 THEN 'F' WHEN 1 THEN 'M' WHEN 4 THEN 'F' WHEN 5 THEN 'OTRO'
         ELSE 'INDETERMINADO' END AS sexo
FROM part"""
ORACLE["age_by_sex_columns"] = """
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_size::VARCHAR WHEN 1 THEN p_size || '0' END
  AS edad, CASE p_partkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' END AS sexo FROM part"""

# ---------------------------------------------------------------------------
# Geography and sets
# ---------------------------------------------------------------------------
MAPPED = """
mapa AS (
  SELECT n_name || CASE WHEN n_nationkey % 4 = 3 THEN ' DE MAPA' ELSE '' END AS municipio_match
  FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE r_name IN ('AFRICA', 'AMERICA', 'ASIA')
)"""
ORACLE["geo_match"] = f"""
WITH {CASES}, {MUNICIPAL}, {MAPPED}, m AS (SELECT *, {MAP_NAME} AS municipio_mapa FROM municipal)
SELECT * FROM m WHERE municipio_mapa IN (SELECT municipio_match FROM mapa)"""
ORACLE["geo_omitted"] = f"""
WITH {CASES}, {MAPPED}, m AS (
  SELECT DISTINCT municipio_residencia, {MAP_NAME} AS municipio_mapa FROM casos)
SELECT municipio_residencia FROM m
WHERE municipio_mapa NOT IN (SELECT municipio_match FROM mapa)"""
ORACLE["map_dimension"] = f"""
WITH {CASES}, {MUNICIPAL}, {MAPPED}, m AS (
  SELECT {MAP_NAME} AS municipio_match, total_casos FROM municipal)
SELECT municipio_match, total_casos FROM mapa LEFT JOIN m USING (municipio_match)"""
ORACLE["set_difference"] = """
SELECT DISTINCT c_custkey AS k FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)"""
ORACLE["union_all"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'seguimiento' ELSE 'nominal' END AS fuente,
       o_orderdate::DATE AS fecha FROM orders"""

# ---------------------------------------------------------------------------
# Landing
# ---------------------------------------------------------------------------
BOOKS = """
fichas AS (
  SELECT *, (c_custkey // 40)::INTEGER AS libro, (c_custkey % 40)::INTEGER AS i FROM customer
),
libros AS (
  SELECT 'libro_' || libro AS file, libro, (3 + libro % 5)::INTEGER AS header_row,
         (3 + libro % 5 + 2 + CASE WHEN libro % 13 = 12 THEN 11 ELSE libro % 3 END)::INTEGER
           AS first_row,
         least(max(i) + 1, 30 + libro % 10) AS n
  FROM fichas GROUP BY libro
)"""
ORACLE["header_rows"] = f"WITH {BOOKS} SELECT file, header_row FROM libros"
ORACLE["header_names"] = f"""
WITH {BOOKS}
SELECT file, c, name FROM libros CROSS JOIN (VALUES
  (1, 'No. (Consecutivo)'), (2, 'NOMBRE DEL PACIENTE'), (3, 'EDAD | F'), (4, 'EDAD | M'),
  (5, 'EDAD | M'), (6, 'SALDO')) AS t(c, name)"""
ORACLE["bounded_rows"] = f"""
WITH {BOOKS}
SELECT file, first_row, (first_row + n)::INTEGER AS stop_row, 1 AS key_c
FROM libros WHERE libro % 13 <> 12"""
ORACLE["resolve_columns"] = f"""
WITH {BOOKS}
SELECT file, logical, c FROM libros CROSS JOIN (VALUES
  ('folio', 1), ('nombre', 2), ('edad_f', 3), ('edad_m', 4), ('saldo', 6)) AS t(logical, c)"""
ORACLE["read_sheet"] = f"""
WITH {BOOKS}
SELECT file, (first_row + i)::INTEGER AS r, c_custkey::VARCHAR AS folio, c_name AS nombre,
       (c_custkey % 90)::VARCHAR AS edad, CASE WHEN i % 2 = 0 THEN 'F' ELSE 'M' END AS sexo,
       c_acctbal AS saldo
FROM fichas JOIN libros USING (libro) WHERE libro % 13 <> 12 AND i < n"""

ORACLE["read_sheet_unlimited"] = ORACLE["read_sheet"].replace("libro % 13 <> 12 AND ", "")
# Per customer four cells: name, one of two ages, balance, and the key unless it is the blank one;
# seven cells of title and header per workbook.
ORACLE["landing_rejects"] = f"""
WITH {BOOKS}, c AS (
  SELECT file, CASE WHEN libro % 13 = 12 THEN 'no_data' WHEN i < n THEN 'kept' ELSE 'after_data' END AS reason,
         CASE WHEN i = 30 + libro % 10 THEN 3 ELSE 4 END AS cells
  FROM fichas JOIN libros USING (libro)
  UNION ALL SELECT file, 'header', 7 FROM libros)
SELECT file, reason, sum(cells)::BIGINT AS cells FROM c GROUP BY file, reason"""

# ---------------------------------------------------------------------------
# Quality and profiles
# ---------------------------------------------------------------------------
ORACLE["reconciliation"] = f"""
WITH {CASES}, t AS (
  SELECT count(*) AS n, {count(POS)} AS p,
         {count(f"{POS} AND fecha_resultado::DATE {IN_WINDOW}")} AS d, {count("edad < 0")} AS s
  FROM casos)
SELECT control, valor, valor AS esperado, true AS coincide FROM (
  SELECT unnest(['demografia.rows', 'geografia.rows', 'derechohabiencia.rows', 'kpis.rows',
                 'demografia.positives', 'geografia.positives', 'derechohabiencia.positives',
                 'kpis.positives', 'series.dated_positives', 'demografia.sin_dato']) AS control,
         unnest([n, n, n, n, p, p, p, p, d, s]) AS valor FROM t)"""
ORACLE["reconciliation_broken"] = (
    ORACLE["reconciliation"]
    .replace("count(*) AS n,", f"""count(*) AS n, {count("seguro <> 'IMSS'")} AS i,
         {count(f"{POS} AND seguro <> 'IMSS'")} AS j,""", 1)
    .replace("unnest([n, n, n, n, p, p, p, p, d, s]) AS valor",
             "unnest([n, n, i, n, p, p, j, p, d, s]) AS valor, unnest([n, n, n, n, p, p, p, p, d, s]) AS bueno")
    .replace("valor, valor AS esperado, true AS coincide", "valor, bueno AS esperado, valor = bueno AS coincide")
)
ORACLE["silver_roundtrip"] = f"""
WITH {CASES} SELECT resultado_prueba, estatus_paciente, count(*) AS n, true AS falta_otra FROM casos GROUP BY ALL"""
ORACLE["summary_roundtrip"] = ORACLE["kpi_row"]
ORACLE["contract_check"] = f"""
WITH {CASES}
SELECT count(*) AS filas, 0::BIGINT AS viola_paciente_id, 0::BIGINT AS viola_edad,
       0::BIGINT AS viola_sexo, 0::BIGINT AS viola_municipio_residencia,
       {count("derechohabiencia IS NULL")} AS viola_derechohabiencia,
       0::BIGINT AS viola_resultado_prueba, 0::BIGINT AS viola_estatus_paciente,
       0::BIGINT AS viola_es_registro_unificado
FROM casos"""
ORACLE["profile_columns"] = """
SELECT unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate',
               'o_orderpriority']) AS columna, n AS filas,
       unnest([0.0, 0.0, 0.0, 0.0, 0.0, z::DOUBLE / n]) AS pct_nulos
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderkey % 7 = 0) AS z FROM orders)"""
ORACLE["profile_top_values"] = """
WITH v AS (
  SELECT 'event_type' AS columna, event_type AS valor FROM events
  UNION ALL SELECT 'user_id', user_id::VARCHAR FROM events
  UNION ALL SELECT 'props', props FROM events),
n AS (SELECT columna, valor, count(*) AS n FROM v GROUP BY ALL)
SELECT * FROM (
  SELECT *, (row_number() OVER (PARTITION BY columna ORDER BY n DESC, valor))::INTEGER AS puesto
  FROM n) WHERE puesto <= 10"""
ORACLE["profile_pattern"] = """
SELECT count(*) AS filas, count(*) FILTER (WHERE regexp_matches(text, '[0-9]{3}-[0-9]{2}'))
  AS coinciden, avg(regexp_matches(text, '[0-9]{3}-[0-9]{2}')::INTEGER) AS proporcion
FROM documents"""
ORACLE["describe"] = " UNION ALL ".join(
    f"""
SELECT '{c}' AS columna, count({c}) AS n, round(avg({c}), 4) AS media,
       round(stddev_samp({c}), 4) AS desviacion, min({c})::DOUBLE AS minimo,
       max({c})::DOUBLE AS maximo, round(quantile_cont({c}::DOUBLE, 0.25), 4) AS p25,
       round(quantile_cont({c}::DOUBLE, 0.5), 4) AS p50,
       round(quantile_cont({c}::DOUBLE, 0.75), 4) AS p75 FROM lineitem"""
    for c in ("l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
)
