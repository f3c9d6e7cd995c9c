"""Every operator as a query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom import settings
from caseloom.errors import IntegrityError
from caseloom.functions import dates, demography, identity, measures, text
from caseloom.operators import cubes, kpi, profile, quality, scaling, series, views
from caseloom.operators.hot_linkage import HotSizes
from caseloom.operators.linkage import LinkOptions, link_candidates, link_rows
from caseloom.plans.gold import TABLE_FILES, build_gold
from caseloom.plans import older_report, run, silver
from caseloom.plans.silver import clean_cases, unify_cases
from caseloom.session import tune
from caseloom.sources import landing, release, tables
from caseloom.workloads import proxy

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SALT = proxy.SALT


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# ---------------------------------------------------------------------------
# Series
# ---------------------------------------------------------------------------
def _event_days(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    return series.daily_counts(
        proxy.table(spark, sf, "events"),
        {
            "eventos": ("ts", None),
            "compras": ("ts", kind == "purchase"),
            "errores": ("ts", kind == "error"),
        },
        date(2023, 1, 1),
        date(2025, 12, 31),
    )


@query
def daily_series(spark, sf):
    """Dense days, trailing mean and running total of purchases."""
    return _event_days(spark, sf).select(
        "*",
        series.moving_mean("compras").alias("media_movil_7d_compras"),
        series.running_total("compras").alias("compras_acumuladas"),
    )


@query
def weekly_series(spark, sf):
    """Weekly sums of the daily counts."""
    return series.weekly_rollup(_event_days(spark, sf), ["eventos", "compras", "errores"])


_SERIES_FIELDS = (*settings.DATE_COLUMNS, "resultado_prueba", "estatus_paciente")


def _case_series(spark: SparkSession, sf: str) -> DataFrame:
    return series.case_series(
        proxy.cases(spark, sf, *_SERIES_FIELDS), proxy.FIRST_DAY, proxy.LAST_DAY
    )


@query
def daily_series_multi_date(spark, sf):
    """Six counts over four date columns, with mean and total."""
    return _case_series(spark, sf)


@query
def date_bounds(spark, sf):
    """First and last day of the four date columns within a window."""
    return series.date_bounds(
        proxy.cases(spark, sf, *settings.DATE_COLUMNS),
        settings.DATE_COLUMNS,
        date(1995, 3, 1),
        proxy.LAST_DAY,
    )


@query
def inverted_dates(spark, sf):
    """Stages dated in the wrong order."""
    return series.inverted_dates(proxy.cases(spark, sf, *settings.DATE_COLUMNS))


@query
def undated_rows(spark, sf):
    """Cases without a date."""
    return series.undated_rows(proxy.cases(spark, sf, *settings.DATE_COLUMNS))


@query
def lag_mean(spark, sf):
    """Mean days between stages."""
    return series.mean_lags(proxy.cases(spark, sf, *settings.DATE_COLUMNS))


@query
def curve_days(spark, sf):
    """selected days that have cases."""
    chosen = views.filter_series(_case_series(spark, sf), date(1996, 1, 1), date(1996, 12, 31))
    return views.curve_days(chosen).select(
        "fecha", "resultados_positivos", "media_movil_7d_positivos"
    )


# ---------------------------------------------------------------------------
# Cubes
# ---------------------------------------------------------------------------
_CUBE_FIELDS = ("edad", "sexo", "resultado_prueba", "estatus_paciente")


def _demographic(spark: SparkSession, sf: str) -> DataFrame:
    return cubes.demographic_cube(proxy.cases(spark, sf, *_CUBE_FIELDS))


def _insurance(spark: SparkSession, sf: str) -> DataFrame:
    return cubes.insurance_cube(
        proxy.cases(spark, sf, "derechohabiencia", "resultado_prueba", "estatus_paciente")
    )


def _municipal(spark: SparkSession, sf: str) -> DataFrame:
    return cubes.municipal_table(
        proxy.cases(spark, sf, "municipio_residencia", "resultado_prueba", "estatus_paciente")
    )


@query
def demographic_cube(spark, sf):
    """The cube by two age binnings, sex, result and status."""
    return _demographic(spark, sf)


@query
def municipal_rates(spark, sf):
    """Counts and rates per municipality."""
    return _municipal(spark, sf)


@query
def insurance_cube(spark, sf):
    """Counts and rates by insurance."""
    return _insurance(spark, sf)


@query
def pyramid(spark, sf):
    """Cases by display age and sex."""
    return cubes.pyramid(_demographic(spark, sf))


@query
def pyramid_known_ages(spark, sf):
    """The pyramid of cases whose age is known."""
    return cubes.pyramid(_demographic(spark, sf), with_unknown=False)


@query
def pyramid_unknown(spark, sf):
    """The cases a pyramid of known ages leaves out."""
    return cubes.unknown_age_cases(_demographic(spark, sf))


@query
def positivity_by_age(spark, sf):
    """Positivity by display age, women and men only."""
    chosen = views.filter_demographic(_demographic(spark, sf), ["F", "M"])
    return cubes.positivity_by_age(chosen)


@query
def filter_demographic(spark, sf):
    """the cube for some sexes and ages."""
    return views.filter_demographic(_demographic(spark, sf), ["F"], ["<18", "60+"])


@query
def filter_insurance(spark, sf):
    """the insurance cube for some insurances."""
    return views.filter_insurance(_insurance(spark, sf), ["IMSS", "PRIVADO"])


@query
def risk_rows(spark, sf):
    """insurance rows worth comparing."""
    return views.risk_rows(_insurance(spark, sf))


@query
def distinct_rows(spark, sf):
    """O3: the hospitalisation rate of each insurance, once."""
    return views.insurance_rates(_insurance(spark, sf))


@query
def legacy_bins(spark, sf):
    """Cases by the ten older age groups."""
    ages = proxy.cases(spark, sf, "edad").select(
        demography.bin_column(F.col("edad"), settings.LEGACY_AGE_BINS).alias("rango")
    )
    return ages.groupBy("rango").agg(F.count(F.lit(1)).alias("n"))


@query
def age_bins(spark, sf):
    """Both labels of every age there is."""
    ages = proxy.cases(spark, sf, "edad")
    counted = ages.groupBy("edad").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("edad", *cubes.age_groups(), "n")


@query
def value_counts_result(spark, sf):
    """Cases per result."""
    return cubes.value_counts(proxy.cases(spark, sf, "resultado_prueba"), "resultado_prueba")


def _crosstab(rows: str, columns: str, row_domain, column_domain, names=None) -> Query:
    def run(spark, sf):
        fields = {"edad" if c == "rango" else c for c in (rows, columns)}
        df = proxy.cases(spark, sf, *fields)
        if rows == "rango":
            label = demography.bin_column(F.col("edad"), settings.LEGACY_AGE_BINS)
            df = df.withColumn("rango", label)
        return cubes.crosstab(df, rows, columns, row_domain, column_domain, names)

    return run


_RANGES = (*settings.LEGACY_AGE_BINS.labels, settings.LEGACY_AGE_BINS.missing)
_RESULTS, _STATES = settings.RESULT_DOMAIN, settings.STATUS_DOMAIN
_SEXES = settings.SEX_DOMAIN
QUERIES["crosstab_result_sex"] = _crosstab("resultado_prueba", "sexo", _RESULTS, _SEXES)
QUERIES["crosstab_status_result"] = _crosstab(
    "estatus_paciente", "resultado_prueba", _STATES, _RESULTS
)
QUERIES["crosstab_status_sex"] = _crosstab("estatus_paciente", "sexo", _STATES, _SEXES)
QUERIES["crosstab_age_result"] = _crosstab("rango", "resultado_prueba", _RANGES, _RESULTS)
QUERIES["crosstab_age_status"] = _crosstab("rango", "estatus_paciente", _RANGES, _STATES)


@query
def crosstab_other(spark, sf):
    """A10: segments and a status outside the domains counted too, so that nothing is lost."""
    joined = proxy.table(spark, sf, "orders").join(
        proxy.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return cubes.crosstab(
        joined, "c_mktsegment", "o_orderstatus", ["BUILDING", "MACHINERY", "NONE"], ["O", "F"], other="OTRO"
    )


# ---------------------------------------------------------------------------
# Key figures
# ---------------------------------------------------------------------------
_KPI_FIELDS = (
    "resultado_prueba",
    "estatus_paciente",
    "fecha_toma_muestra",
    "fecha_resultado",
    "es_registro_unificado",
    "dias_entre_notificacion_e_ingreso",
)


@query
def kpi_row(spark, sf):
    """A4: the global figures."""
    return kpi.kpi_row(proxy.cases(spark, sf, *_KPI_FIELDS))


@query
def kpi_row_from_base(spark, sf):
    """A4: the same figures from counts per combination of closed domains."""
    return kpi.kpi_row(cubes.case_base(proxy.cases(spark, sf)), cubes.BASE_WEIGHT)


@query
def lag_percentiles(spark, sf):
    """A5: quartiles of the link lag."""
    return kpi.lag_percentiles(
        proxy.cases(spark, sf, "es_registro_unificado", "dias_entre_notificacion_e_ingreso")
    )


@query
def kpi_view_stored(spark, sf):
    """Nothing selected, so the stored figures."""
    return kpi.kpi_view(
        kpi.ViewFilter(), kpi.kpi_row(proxy.cases(spark, sf, *_KPI_FIELDS)), None, None, None
    )


@query
def kpi_view_insurance(spark, sf):
    """Insurances selected, which go before sexes."""
    chosen = kpi.ViewFilter(insurances=("IMSS", "ISSSTE"), sexes=("F",))
    return kpi.kpi_view(chosen, None, None, None, _insurance(spark, sf))


@query
def kpi_view_demographic(spark, sf):
    """A sex and an age group selected."""
    chosen = kpi.ViewFilter(sexes=("F",), age_groups=("18-39",))
    return kpi.kpi_view(chosen, None, None, _demographic(spark, sf), None)


@query
def kpi_view_days(spark, sf):
    """Days selected."""
    chosen = kpi.ViewFilter(first_day=date(1996, 1, 1), last_day=date(1997, 6, 30))
    return kpi.kpi_view(
        chosen, None, _case_series(spark, sf), None, None, covers_all_days=False
    )


@query
def kpi_view_missing_cube(spark, sf):
    """A sex selected that only cases without an age have, out of a cube of those with
    one: what is left of the cube answers, and not the unfiltered series."""
    cube = _demographic(spark, sf)
    known = cube.filter((F.col("grupo_edad") != settings.NO_DATA) & (F.col("sexo") != "OTRO"))
    figures = [
        kpi.kpi_view(kpi.ViewFilter(sexes=(sex,)), None, None, known, None).withColumn("sexo", F.lit(sex))
        for sex in ("F", "OTRO")
    ]
    return figures[0].unionByName(figures[1])


@query
def kpi_view_empty_kpis(spark, sf):
    """Nothing selected and a stored table without a row: the daily series answers."""
    kpis = kpi.kpi_row(proxy.cases(spark, sf, *_KPI_FIELDS)).limit(0)
    return kpi.kpi_view(kpi.ViewFilter(), kpis, _case_series(spark, sf), None, None)


@query
def safe_rate(spark, sf):
    """A rate per order, 0 where its base is empty."""
    flag = F.col("l_returnflag")
    per_order = proxy.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count_if(flag == "R").alias("positivos"), F.count_if(flag == "A").alias("negativos")
    )
    return per_order.withColumn(
        "tasa",
        measures.safe_rate(F.col("positivos"), F.col("positivos") + F.col("negativos")),
    )


# ---------------------------------------------------------------------------
# Linkage
# ---------------------------------------------------------------------------
_ORDER_LINK = LinkOptions(
    keys=("o_custkey",), order="o_orderkey", notified="notified", admitted="admitted"
)


def _candidates(days: int) -> Query:
    def run(spark, sf):
        found = link_candidates(
            proxy.notifications(spark, sf),
            proxy.admissions(spark, sf).drop("o_orderkey"),
            replace(_ORDER_LINK, window_days=days),
        )
        return found.select("o_orderkey", "n_candidates", "nearest_days")

    return run


QUERIES["link_candidates"] = _candidates(7)
QUERIES["link_candidates_90_days"] = _candidates(90)


@query
def link_candidates_one_key(spark, sf):
    """L1: candidates where all rows share one key and have a time of day."""
    rows = proxy.monthly_registries(spark, sf).withColumn("todos", F.lit("x"))
    notified = rows.filter("notified IS NOT NULL").drop("admitted")
    admitted = rows.filter("admitted IS NOT NULL").select("todos", "admitted")
    found = link_candidates(notified, admitted, replace(_ORDER_LINK, keys=("todos",)))
    return found.select("o_orderkey", "n_candidates", "nearest_days")


def _links(rows: DataFrame, options: LinkOptions) -> DataFrame:
    return link_rows(rows, options).select(
        F.col("row.o_orderkey").alias("o_orderkey"),
        F.col("taken.o_orderkey").alias("taken_orderkey"),
        F.col("days").alias("dias"),
        F.col("collided").alias("colision"),
    )


def _greedy(key: str, days: int) -> Query:
    def run(spark, sf):
        options = replace(_ORDER_LINK, keys=(key,), window_days=days)
        return _links(proxy.both_registries(spark, sf), options)

    return run


QUERIES["link_greedy"] = _greedy("o_custkey", 7)
QUERIES["link_greedy_90_days"] = _greedy("o_custkey", 90)
QUERIES["link_greedy_hot_keys"] = _greedy("o_orderpriority", 7)


@query
def link_greedy_hot_many_chunks(spark, sf):
    """L2: five hot keys without gaps, folded in a dozen chunks each."""
    rows = proxy.both_registries(spark, sf)
    sizes = HotSizes(group_rows=1, chunk_rows=max(1, rows.count() // 120))
    return _links(rows, replace(_ORDER_LINK, keys=("o_orderpriority",), sizes=sizes))


@query
def link_greedy_hot_clock(spark, sf):
    """L2: hot keys that fall into months, with times of day on both sides."""
    rows = proxy.monthly_registries(spark, sf)
    small = max(1, rows.count() // 1000)
    options = replace(_ORDER_LINK, keys=("o_orderpriority",), sizes=HotSizes(small, small))
    return _links(rows, options)


def _stored_cleaned(spark: SparkSession, sf: str) -> tuple[DataFrame, scaling.Staging]:
    staging = scaling.Staging(spark)
    cleaned = clean_cases(proxy.bronze(spark, sf), proxy.REGISTRY_DATES)
    return staging.table(cleaned, "cleaned"), staging


@query
def unified_cases(spark, sf):
    """Registries cleaned and linked to unified cases."""
    cleaned, staging = _stored_cleaned(spark, sf)
    unified = unify_cases(cleaned, LinkOptions(window_days=30), staging)
    shown = [
        F.to_date(c).alias(c) if c in settings.DATE_COLUMNS else F.col(c) for c in unified.columns
    ]
    return unified.select(*shown)


@query
def quality_summary(spark, sf):
    """The telemetry of that run."""
    staging = scaling.Staging(spark)
    path, bronze = staging.path("cleaned"), proxy.bronze(spark, sf)
    cleaned = clean_cases(bronze, proxy.REGISTRY_DATES)
    rules, facts = quality.one_date_contract(), quality.cleaning_facts()
    sides = {
        side: F.count_if(F.col("row_order") % 2 == k) for k, side in enumerate(("out", "into"))
    }
    found = release.write_checked(cleaned, path, rules, facts | sides)
    unified = unify_cases(spark.read.parquet(path), LinkOptions(window_days=30), staging)
    found |= release.write_checked(
        unified, staging.path("unified"), quality.case_contract(), quality.linking_facts()
    )
    return quality.quality_summary(spark, found["out"], found["into"], found)


@query
def full_run(spark, sf):
    """Workbooks to published tables in one run, and the key figures found there.

    A run before it, which finds no cells, ends with another code and publishes nothing.
    """
    staging = scaling.Staging(spark)
    cells, folder = staging.path("cells"), staging.path("silver")
    config = run.RunConfig(
        cells, folder, silver.Registries(SALT), dates=proxy.REGISTRY_DATES, link=LinkOptions(window_days=30)
    )
    absent = run.run(spark, config)
    proxy.registry_cells(spark, sf).write.partitionBy("sheet").parquet(cells)
    done = run.run(spark, config, "gold")
    tables_before = run.published_tables(spark, folder)
    figures = spark.read.parquet(tables_before[TABLE_FILES["kpis"]]).drop("timestamp_generacion")
    return figures.select(
        "*",
        F.lit(absent).alias("codigo_sin_celdas"),
        F.lit(done).alias("codigo"),
        F.lit(len(tables_before)).cast("bigint").alias("publicados"),
    )


@query
def contract_enforced(spark, sf):
    """Q1: cases with one broken row per rule, each refused by the write that counts it."""
    staging = scaling.Staging(spark)
    whole = staging.table(
        proxy.cases(spark, sf, *_CONTRACT_FIELDS)
        .fillna("NINGUNO", ["derechohabiencia"])
        .withColumn("n", F.monotonically_increasing_id()),
        "cases",
    )
    first = F.col("n") == 0
    broken = {
        "paciente_id": F.lit("x"),
        "edad": F.lit(-2.0),
        "sexo": F.lit("m"),
        "municipio_residencia": F.lit(None),
        "derechohabiencia": F.lit(None),
        "resultado_prueba": F.lit("DUDOSO"),
        "estatus_paciente": F.lit(None),
        "es_registro_unificado": F.lit(None),
    }

    def refused(rule: str | None) -> bool:
        df = whole
        if rule is not None:
            wrong = F.when(first, broken[rule]).otherwise(F.col(rule))
            df = df.withColumn(rule, wrong.cast(df.schema[rule].dataType))
        try:
            release.write_checked(df, staging.path("checked"), quality.case_contract())
        except IntegrityError:
            return True
        return False

    names = ["", *broken]
    outcome = scaling.together({n: lambda n=n: refused(n or None) for n in names})
    rows = whole.agg(F.count(F.lit(1)).alias("filas"))
    each = F.array(
        *[F.struct(F.lit(n).alias("regla"), F.lit(outcome[n]).alias("rechazada")) for n in names]
    )
    return rows.select("filas", F.inline(each))


_CONTRACT_FIELDS = (
    "paciente_id",
    "edad",
    "sexo",
    "municipio_residencia",
    "derechohabiencia",
    "resultado_prueba",
    "estatus_paciente",
    "es_registro_unificado",
)


@query
def clean_cases_query(spark, sf):
    """Registry rows cleaned, before linking."""
    cleaned = clean_cases(proxy.bronze(spark, sf), proxy.REGISTRY_DATES)
    return cleaned.select(
        "row_order",
        "edad",
        "sexo",
        "municipio_residencia",
        "derechohabiencia",
        *[F.to_date(c).alias(c) for c in settings.DATE_COLUMNS],
        "resultado_prueba",
        "estatus_paciente",
        "hospital",
        "columnas_intercambiadas",
        F.col("fechas_anomalas").cast("int").alias("fechas_anomalas"),
    )


QUERIES["clean_cases"] = QUERIES.pop("clean_cases_query")


# ---------------------------------------------------------------------------
# Text and identity
# ---------------------------------------------------------------------------
@query
def normalize_text(spark, sf):
    """Whole documents without marks, in capitals, single-spaced."""
    return proxy.table(spark, sf, "documents").select(
        "doc_id", text.normalize_text(F.col("text")).alias("texto")
    )


@query
def normalize_hangul(spark, sf):
    """Syllables told by number fall into their letters."""
    syllable = F.get(F.array(*[F.lit(s) for s in proxy.SYLLABLES]), F.col("c_nationkey"))
    return proxy.table(spark, sf, "customer").select(
        "c_custkey", text.normalize_text(F.concat(syllable, F.lit("é "), F.col("c_name"))).alias("texto")
    )


@query
def pseudonymize(spark, sf):
    """Salted hashes of names, keeping tildes; every fifth has no folio."""
    folio = F.when(F.col("doc_id") % 5 != 0, F.col("doc_id").cast("string"))
    return proxy.table(spark, sf, "documents").select(
        "doc_id", identity.pseudonymize(F.col("text"), folio, SALT).alias("paciente_id")
    )


@query
def pii_projection(spark, sf):
    """T5: customers without their names."""
    hashed = proxy.table(spark, sf, "customer").withColumn(
        "paciente_id", identity.pseudonymize(F.col("c_name"), F.lit(None).cast("string"), SALT)
    )
    return identity.project_without_pii(
        hashed, ["paciente_id", "c_nationkey", "c_mktsegment"], ["c_name"]
    )


@query
def coerce_text(spark, sf):
    """Prices as text, whole ones without a fraction."""
    return proxy.table(spark, sf, "part").select(
        "p_partkey",
        identity.coerce_text(F.col("p_retailprice").cast("string"), F.lit("number")).alias("folio"),
    )


_TYPES = {"PROMO": "A", "MEDIUM": "B", "LARGE": "B", "SMALL": "C"}


@query
def catalog_lookup(spark, sf):
    """Free text to a closed catalog held as a dictionary."""
    typed = F.concat(F.lit("  "), F.replace(F.lower("p_type"), F.lit("o"), F.lit("ó")), F.lit(" "))
    return proxy.table(spark, sf, "part").select(
        "p_partkey", text.lookup(typed, _TYPES, "OTROS").alias("tipo")
    )


@query
def catalog_table_lookup(spark, sf):
    """Free text to a catalog held as a table."""
    # every fifth nation is spelt in a way that nobody types
    spelt = F.when(F.col("n_nationkey") % 5 > 0, F.initcap("n_name")).otherwise(F.reverse("n_name"))
    catalog = proxy.table(spark, sf, "nation").select(
        spelt.alias("synonym"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("canonical"),
    )
    typed = proxy.table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("natión_"), F.col("c_nationkey").cast("string")).alias("v")
    )
    return scaling.catalog_join(typed, F.col("v"), catalog, "region", "OTROS").select(
        "c_custkey", "region"
    )


@query
def insurance_lookup(spark, sf):
    """Null and unknown insurances differ."""
    return proxy.cases(spark, sf, "derechohabiencia").groupBy(
        cubes.insurance().alias("derechohabiencia")
    ).agg(F.count(F.lit(1)).alias("n"))


@query
def default_if_empty(spark, sf):
    """Null and blank become one default."""
    way = F.col("o_orderkey") % 3
    cell = F.when(way == 0, F.lit("")).when(way == 1, F.col("o_orderpriority"))
    return proxy.table(spark, sf, "orders").select(
        "o_orderkey", text.default_if_empty(cell, "NINGUNO").alias("derechohabiencia")
    )


@query
def alias_names(spark, sf):
    """Names the map spells differently."""
    return _municipal(spark, sf).select(
        "municipio_residencia",
        text.alias(F.col("municipio_residencia"), proxy.MAP_ALIASES).alias("municipio_mapa"),
    )


def _raw_status() -> Column:
    raw = F.lit(" AMBULATORIO PEDIATRIA")
    for n, value in enumerate(("AMB", "ABM", "DEFUNCIÓN", "HOSPITALIZADO UCI", "ALTA", "OTRO"), 1):
        raw = F.when(F.col("o_orderkey") % 7 == n, F.lit(value)).otherwise(raw)
    return raw


@query
def regex_cascade(spark, sf):
    """Unanchored rules replace what they match, judged on the call's input."""
    df = proxy.table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("tipo"))
    calls = ((("M", "^P.*", "L"), "LL"), (("LL.*",), "x"), (("(^.*A.*$)",), "CON_A"))
    return text.regex_cascade(df, "tipo", calls)


def _by_dictionary(df: DataFrame, column: str, calls) -> DataFrame:
    def change(values: DataFrame) -> DataFrame:
        return text.regex_cascade(values, column, calls)

    return scaling.by_dictionary(df, column, change, scaling.Staging(df.sparkSession))


@query
def status_cascade(spark, sf):
    """The status rules."""
    df = proxy.table(spark, sf, "orders").select("o_orderkey", _raw_status().alias("estatus"))
    return _by_dictionary(df, "estatus", settings.STATUS_CASCADE)


PLACES = (
    "GAM NORTE", "COL. JARDIN", "IZTAPALAPA", "CHIMALHUACAN", "NEZA", "ECATEPEC", "XOCHIMILCO",
    "TLALNEPANTLA", "LOS REYES", "AMECAMECA", "NAUCALPAN", "PUEBLA", "OTRA CIUDAD",
)


@query
def residence_cascade(spark, sf):
    """The 36 residence rules, blanks filled first."""
    raw = F.get(
        F.array(*[F.lit(p) for p in PLACES]),
        (F.col("c_custkey") % (len(PLACES) + 1)).cast("int"),
    )
    df = proxy.table(spark, sf, "customer").select("c_custkey", raw.alias("residencia"))
    filled = text.fill_null(df, {"residencia": "FORANEO"})
    return _by_dictionary(filled, "residencia", settings.RESIDENCE_CASCADE)


def _typed_cascade(name: str, calls) -> Query:
    def run(spark, sf):
        typed = proxy.TYPED_CELLS[name]
        way = (F.col("o_orderkey") % (len(typed) + 1)).cast("int")
        cell = F.get(F.array(*[F.lit(t) for t in typed]), way)
        df = proxy.table(spark, sf, "orders").select("o_orderkey", cell.alias("celda"))
        return _by_dictionary(df, "celda", calls)

    run.__doc__ = f"T11: the {name} rules, on cells as typed and null ones."
    return run


for _name, _calls in {
    "country": settings.COUNTRY_CASCADE,
    "sample": settings.SAMPLE_CASCADE,
    "result": settings.RESULT_CASCADE,
    "result_date": settings.RESULT_DATE_CASCADE,
    "result_date_second": settings.RESULT_DATE_SECOND_CASCADE,
    "age": settings.AGE_CASCADE,
    "age_second": settings.AGE_SECOND_CASCADE,
    "sex": settings.SEX_CASCADE,
    "sex_second": settings.SEX_SECOND_CASCADE,
}.items():
    QUERIES[f"{_name}_cascade"] = _typed_cascade(_name, _calls)


@query
def older_crosstabs(spark, sf):
    """The older report from raw cells to all cells of its five crosstabs."""
    staging = scaling.Staging(spark)
    registry = staging.table(proxy.older_registry(spark, sf), "registry")
    cleaned = older_report.clean_older(registry, staging)
    return older_report.older_cells(cleaned, staging, other="RESTO")


@query
def whitelist(spark, sf):
    """Values outside the list become a default."""
    return proxy.table(spark, sf, "customer").select(
        "c_custkey",
        text.keep_only(F.col("c_mktsegment"), ["BUILDING", "MACHINERY"], "SOSPECHOSO").alias(
            "resultado"
        ),
    )


@query
def fill_null(spark, sf):
    """Nulls become a constant per column."""
    key = F.col("o_orderkey")
    df = proxy.table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(key % 3 > 0, F.col("o_orderpriority")).alias("prioridad"),
        F.when(key % 4 > 0, F.col("o_orderstatus")).alias("estatus"),
    )
    return text.fill_null(df, {"prioridad": "NINGUNO", "estatus": "FORANEO"})


# ---------------------------------------------------------------------------
# Dates, ages and sexes
# ---------------------------------------------------------------------------
@query
def parse_dates(spark, sf):
    """Dates typed nine ways, with mistyped years and a window."""
    cell = F.struct("v", "kind")
    return dates.read_dates(proxy.dirty_dates(spark, sf), {"d": cell}, proxy.DATES).select(
        "o_orderkey", F.to_date("d.value").alias("fecha"), F.col("d.is_anomaly").alias("anomalia")
    )


@query
def parse_date_shapes(spark, sf):
    """Twenty ways to type a date, three of them none."""
    cell = F.struct("v", "kind")
    policy = replace(proxy.DATES, year_typos=(), shifted_year=None)
    return dates.parse_dates(proxy.shaped_dates(spark, sf), {"d": cell}, policy).select(
        "o_orderkey",
        F.to_date("d").alias("fecha"),
        dates.is_unreadable(cell, F.col("d")).alias("ilegible"),
    )


@query
def parse_date_clocks(spark, sf):
    """Whole texts with a time of day or a weekday, two of nine being no dates."""
    cell = F.struct("v", "kind")
    policy = replace(proxy.DATES, year_typos=(), shifted_year=None)
    return dates.parse_dates(proxy.clocked_dates(spark, sf), {"d": cell}, policy).select(
        "o_orderkey",
        F.date_format("d", "yyyy-MM-dd HH:mm:ss").alias("leida"),
        dates.is_unreadable(cell, F.col("d")).alias("ilegible"),
    )


@query
def swap_repair(spark, sf):
    """Results and dates put back into their columns."""
    marked = dates.mark_swapped(
        proxy.dirty_results(spark, sf), "resultado", F.struct("v", "kind"), "intercambio", proxy.DATES
    )
    result, cell = dates.swap_if(F.col("intercambio"), F.col("resultado"), F.col("v"))
    return marked.select(
        "o_orderkey", result.alias("resultado"), cell.alias("fecha_resultado"), "intercambio"
    )


@query
def legacy_swap(spark, sf):
    """The older swap test, on cells without capitals."""
    df = proxy.dirty_results(spark, sf)
    swapped = dates.lacks_capitals(F.col("resultado"))
    result, cell = dates.swap_if(swapped, F.col("resultado"), F.col("v"))
    return df.select("o_orderkey", result.alias("resultado"), cell.alias("fecha_resultado"))


@query
def parse_age_sex(spark, sf):
    """Ages and sexes repaired and parsed."""
    read = demography.read_age_sex(proxy.dirty_people(spark, sf), "edad_raw", "sexo_raw")
    return read.select("p_partkey", "edad", "sexo")


@query
def age_by_sex_columns(spark, sf):
    """One age column per sex turned into age and sex."""
    key, size = F.col("p_partkey"), F.col("p_size").cast("string")
    pair = demography.age_by_sex_columns(
        F.when(key % 3 == 0, size), F.when(key % 3 < 2, F.concat(size, F.lit("0")))
    )
    return proxy.table(spark, sf, "part").select("p_partkey", pair.alias("p")).select(
        "p_partkey", "p.edad", "p.sexo"
    )


# ---------------------------------------------------------------------------
# Geography and sets
# ---------------------------------------------------------------------------
@query
def geo_match(spark, sf):
    """Municipalities that can be drawn."""
    dimension = views.map_dimension(proxy.shapes(spark, sf), proxy.MAP_STATES)
    return views.geo_match(_municipal(spark, sf), dimension, proxy.MAP_ALIASES)


@query
def geo_omitted(spark, sf):
    """Municipalities without a shape."""
    dimension = views.map_dimension(proxy.shapes(spark, sf), proxy.MAP_STATES)
    return views.geo_omitted(_municipal(spark, sf), dimension, proxy.MAP_ALIASES)


@query
def map_dimension(spark, sf):
    """the municipalities of the covered states, with the cases of each."""
    dimension = views.map_dimension(proxy.shapes(spark, sf), proxy.MAP_STATES)
    named = _municipal(spark, sf).select(
        text.alias(F.col("municipio_residencia"), proxy.MAP_ALIASES).alias("municipio_match"),
        "total_casos",
    )
    return dimension.select("municipio_match").join(named, "municipio_match", "left")


@query
def set_difference(spark, sf):
    """Customers without orders."""
    return views.missing_values(
        proxy.table(spark, sf, "customer").select(F.col("c_custkey").alias("k")),
        proxy.table(spark, sf, "orders").select(F.col("o_custkey").alias("k")),
        "k",
    )


@query
def union_all(spark, sf):
    """O2: both registries one under the other."""
    out = proxy.notifications(spark, sf).select(
        "o_orderkey", F.lit("seguimiento").alias("fuente"), F.to_date("notified").alias("fecha")
    )
    into = proxy.admissions(spark, sf).select(
        "o_orderkey", F.lit("nominal").alias("fuente"), F.to_date("admitted").alias("fecha")
    )
    return out.unionByName(into)


# ---------------------------------------------------------------------------
# Landing
# ---------------------------------------------------------------------------
def _names(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    sheet = proxy.cells(spark, sf).filter(F.col("sheet") == proxy.SHEET.sheet)
    headers = landing.find_headers(sheet, proxy.SHEET.keys, proxy.SHEET.header_rows)
    return sheet, landing.flatten_headers(sheet, headers, proxy.SHEET.header_rows)


@query
def header_rows(spark, sf):
    """Where each workbook's header begins."""
    return landing.find_headers(
        proxy.cells(spark, sf), proxy.SHEET.keys, proxy.SHEET.header_rows
    ).select("file", "header_row")


@query
def header_names(spark, sf):
    """Flat names of two-level headers."""
    return _names(spark, sf)[1].select("file", "c", "name")


@query
def bounded_rows(spark, sf):
    """S3: first data row and first row after the data, per workbook."""
    sheet, names = _names(spark, sf)
    keys = landing.key_columns(names, proxy.SHEET.keys[0])
    bounds = landing.bound_rows(sheet, keys, proxy.SHEET.header_rows, proxy.SHEET.blank_rows)
    return bounds.select("file", "first_row", "stop_row", "key_c")


@query
def resolve_columns(spark, sf):
    """Columns found by the prefix of their names."""
    found = landing.resolve_columns(_names(spark, sf)[1], proxy.SHEET.columns)
    return found.select("file", "logical", "c")


def _people(rows: DataFrame) -> DataFrame:
    pair = demography.age_by_sex_columns(landing.cell("edad_f")["v"], landing.cell("edad_m")["v"])
    return rows.select(
        "file",
        "r",
        landing.cell("folio")["v"].alias("folio"),
        landing.cell("nombre")["v"].alias("nombre"),
        pair["edad"].alias("edad"),
        pair["sexo"].alias("sexo"),
        landing.cell("saldo")["v"].cast("double").alias("saldo"),
    )


@query
def read_sheet(spark, sf):
    """The data rows of all workbooks, under the limits of earlier runs."""
    return _people(landing.read_sheet(proxy.cells(spark, sf), proxy.SHEET))


@query
def read_sheet_unlimited(spark, sf):
    """The same without limits, so that no workbook is lost to blank rows."""
    return _people(landing.read_sheet(proxy.cells(spark, sf), proxy.UNLIMITED_SHEET))


@query
def ingest_registries(spark, sf):
    """Both registries and the daily sheet from their workbooks, as raw rows."""
    bronze, counts = silver.ingest_registries(
        proxy.registry_cells(spark, sf), silver.Registries(SALT), scaling.Staging(spark)
    )
    cells = {name: F.col(f"{name}_raw") for name in ("fecha_notificacion", "fecha_resultado", "fecha_ingreso")}
    return bronze.select(
        "paciente_id",
        "fuente",
        "folio_origen",
        "edad_raw",
        "sexo_raw",
        "municipio_raw",
        "derechohabiencia_raw",
        "resultado_raw",
        "estatus_raw",
        "hospital_raw",
        *[c["v"].alias(name) for name, c in cells.items()],
        F.col("fecha_notificacion_raw.kind").alias("tipo_notificacion"),
        F.lit(counts["red_negativa"]).cast("bigint").alias("filas_red_negativa"),
    )


@query
def landing_rejects(spark, sf):
    """Cells by what became of them; kept and rejected add up to what was landed."""
    return landing.sheet_rejects(proxy.cells(spark, sf), proxy.SHEET).select("file", "reason", "cells")


# ---------------------------------------------------------------------------
# Quality and profiles
# ---------------------------------------------------------------------------
def _reconciled(spark: SparkSession, sf: str, lost: str | None = None) -> DataFrame:
    """The controls over all tables; ``lost`` is an insurance left out of its cube."""
    staging = scaling.Staging(spark)
    cases = staging.table(proxy.cases(spark, sf), "cases")
    policy = replace(settings.DEFAULT_DATES, first_day=proxy.FIRST_DAY, last_day=proxy.LAST_DAY)
    gold = build_gold(cases, policy, staging)
    insurance = gold.insurance if lost is None else gold.insurance.filter(F.col("derechohabiencia") != lost)
    return quality.reconcile(
        gold.totals, gold.demographic, gold.series, gold.municipal, insurance, gold.kpis
    )


@query
def reconciliation(spark, sf):
    """Q2-Q4: every table's totals against the cases."""
    return _reconciled(spark, sf)


@query
def reconciliation_broken(spark, sf):
    """Q2-Q4: the same with an insurance missing from its cube, which two controls tell."""
    return _reconciled(spark, sf, "IMSS")


@query
def silver_roundtrip(spark, sf):
    """Cases stored, read back under their contract, and counted."""
    path = scaling.Staging(spark).path("cases")
    tables.write_table(proxy.cases(spark, sf), path)
    cases = tables.read_table(spark, path, ["resultado_prueba", "estatus_paciente"])
    absent = tables.read_table_or_none(spark, path + "-none")
    return cases.groupBy("resultado_prueba", "estatus_paciente").agg(
        F.count(F.lit(1)).alias("n"), F.lit(absent is None).alias("falta_otra")
    )


@query
def summary_roundtrip(spark, sf):
    """The global figures as a JSON object and back."""
    row = kpi.kpi_row(proxy.cases(spark, sf, *_KPI_FIELDS))
    path = scaling.Staging(spark).path("summary")
    tables.write_summary(row, path)
    return tables.read_summary_or_none(spark, path, row.schema)


@query
def contract_check(spark, sf):
    """Q1: rows breaking the case contract (the proxy has insurances missing)."""
    return quality.check_contract(proxy.cases(spark, sf), quality.case_contract())


@query
def profile_columns(spark, sf):
    """Types and null shares."""
    key = F.col("o_orderkey")
    df = proxy.table(spark, sf, "orders").withColumn(
        "o_orderpriority", F.when(key % 7 > 0, F.col("o_orderpriority"))
    )
    return profile.column_nulls(df).select("columna", "filas", "pct_nulos")


@query
def profile_top_values(spark, sf):
    """The ten most frequent values of several columns."""
    df = proxy.table(spark, sf, "events")
    return profile.top_values(df, ["event_type", "user_id", "props"])


@query
def profile_pattern(spark, sf):
    """Share of documents that show a digit pattern."""
    return profile.pattern_share(proxy.table(spark, sf, "documents"), "text", r"[0-9]{3}-[0-9]{2}")


@query
def describe(spark, sf):
    """Numeric summary with exact quartiles."""
    df = proxy.table(spark, sf, "lineitem").select(
        "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"
    )
    summary = profile.describe(df)
    rounded = ["media", "desviacion", "p25", "p50", "p75"]
    return summary.select(
        *[F.round(c, 4).alias(c) if c in rounded else F.col(c) for c in summary.columns]
    )


def _tuned(function: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return function(tune(spark), sf)

    return run


QUERIES = {name: _tuned(function) for name, function in QUERIES.items()}
