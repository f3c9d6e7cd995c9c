"""Linking outpatient notifications to hospital admissions.

Notifications are taken in row order; each takes the unused admission of the
same person key that is fewest days away, within a window, the earliest row
winning a tie; an admission is used once. Keys do not influence each other.

* Keys with few rows on either side - persons - are matched inside one shuffle
  by a higher-order expression over the key's rows.
* Keys beyond that (blank names hash alike) are matched in ``hot_linkage``, by their
  numbers and times only; their rows are joined to the matches afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.dates import elapsed_days, micros_between
from caseloom.operators.hot_linkage import DAY_US, HotSizes, match_hot
from caseloom.operators.scaling import Staging, join_checked, running
from caseloom.settings import HOSPITALISED, LINK_KEYS, LINK_WINDOW_DAYS


@dataclass(frozen=True)
class LinkOptions:
    """What links, and the sizes from which on a key is matched in another way."""

    keys: tuple[str, ...] = LINK_KEYS
    order: str = "row_order"
    notified: str = "fecha_notificacion"
    admitted: str = "fecha_ingreso_hospital"
    window_days: int = LINK_WINDOW_DAYS
    small_key_rows: int = 64
    sizes: HotSizes = HotSizes()


def _key(columns: Sequence[str]) -> Column:
    """One join column that, unlike SQL equality, treats nulls as equal."""
    return F.concat_ws(
        "\u001f", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns]
    )


def _micros(timestamp: Column) -> Column:
    return micros_between(F.lit("1970-01-01").cast("timestamp_ntz"), timestamp)


# ---------------------------------------------------------------------------
# Candidates: counts and nearest distance, without listing pairs
# ---------------------------------------------------------------------------
def link_candidates(
    notifications: DataFrame,
    admissions: DataFrame,
    options: LinkOptions = LinkOptions(),
    staging: Staging | None = None,
) -> DataFrame:
    """Per notification: admissions of its key within the window, and the least days.

    No pairs are made. Admissions of a key are counted in order of time: those up to the
    end of a notification's window, less those before it, are its candidates, and the
    last before it and the next after it are the nearest. Both sides are first reduced
    to distinct (key, time), each notified time asks at three points, and a key of any
    size is spread over ranges of time.
    """
    staging = staging or Staging(notifications.sparkSession)
    keys, window = list(options.keys), options.window_days
    key = F.struct(*[F.col(k) for k in keys]).alias("_key")
    notified, admitted = _micros(F.col(options.notified)), _micros(F.col(options.admitted))
    # a struct is never null, so rows without a key are told apart by the null inside
    there = F.lit(True)
    for k in keys:
        there = there & F.col(k).isNotNull()
    cells = (
        admissions.filter(there & F.col(options.admitted).isNotNull())
        .groupBy(key, admitted.alias("at"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("_key", "at", F.lit(3).alias("part"), F.lit(0).cast("bigint").alias("asked"), "rows")
    )
    times = notifications.filter(there & F.col(options.notified).isNotNull()).select(
        key, notified.alias("asked")
    )
    day, none = F.lit(DAY_US), F.lit(0).cast("bigint")
    points = F.array(
        F.struct((F.col("asked") - window * day).alias("at"), F.lit(0).alias("part")),
        F.struct(F.col("asked").alias("at"), F.lit(1).alias("part")),
        F.struct((F.col("asked") + (window + 1) * day).alias("at"), F.lit(2).alias("part")),
    )
    probes = times.distinct().select("_key", "asked", F.inline(points)).select(
        "_key", "at", "part", "asked", none.alias("rows")
    )
    here = F.when(F.col("part") == 3, F.col("at"))
    swept = running(
        cells.unionByName(probes),
        ["_key"],
        ["at", "part", "asked"],
        staging,
        {"before": ("sum", F.col("rows")), "last": ("max", here)},
        {"next": ("min", here)},
    )

    def at_point(part: int, value: Column) -> Column:
        return F.max(F.when(F.col("part") == part, value))

    def days(admission: str) -> Column:
        return F.abs(F.floor((F.col(admission) - F.col("asked")) / day)).cast("int")

    nearest = F.least(days("last"), days("next"))
    found = (
        swept.filter("part < 3")
        .groupBy("_key", "asked")
        .agg(
            (at_point(2, F.col("before")) - at_point(0, F.col("before"))).alias("n_candidates"),
            at_point(1, nearest).alias("nearest_days"),
        )
        .withColumn("nearest_days", F.when(F.col("n_candidates") > 0, F.col("nearest_days")))
    )
    joined = notifications.withColumns({"_key": key, "asked": notified}).join(
        found, ["_key", "asked"], "left"
    )
    return joined.drop("_key", "asked").withColumn(
        "n_candidates", F.coalesce("n_candidates", F.lit(0))
    )


# ---------------------------------------------------------------------------
# Small keys
# ---------------------------------------------------------------------------
def _match_small(rows: DataFrame, payload: Sequence[str], options: LinkOptions) -> DataFrame:
    """All rows of a key in arrays, matched by folding over the notifications."""
    entry = F.struct(
        F.col(options.order).alias("ord"), F.struct(*payload).alias("row")
    )

    def side(flag: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col(flag), entry)))

    grouped = rows.groupBy("_key").agg(
        side("_is_notified").alias("n"), side("_is_admitted").alias("h")
    )

    def fold(state: Column, notification: Column) -> Column:
        def candidate(admission: Column, position: Column) -> Column:
            days = elapsed_days(
                notification["row"][options.notified], admission["row"][options.admitted]
            )
            return F.struct(days.alias("days"), position.cast("int").alias("pos"))

        in_reach = F.filter(
            F.transform(F.col("h"), candidate),
            lambda c: (c["days"] <= options.window_days)
            & ~F.exists(state, lambda taken: F.coalesce(taken["best"]["pos"] == c["pos"], F.lit(False))),
        )
        # A one-element transform names the candidate list, so it is built once.
        outcome = F.transform(
            F.array(in_reach),
            lambda c: F.struct(F.array_min(c).alias("best"), F.size(c).alias("n")),
        )
        return F.concat(state, outcome)

    empty = F.from_json(
        F.lit("[]"), "array<struct<best:struct<days:int,pos:int>,n:int>>"
    )
    nobody = F.lit(None).cast(rows.select(F.struct(*payload)).schema[0].dataType)

    def linked(notification: Column, outcome: Column) -> Column:
        # get() is null where the position is null
        taken = F.get(F.col("h"), outcome["best"]["pos"])["row"]
        return F.struct(
            notification["row"].alias("row"),
            taken.alias("taken"),
            outcome["best"]["days"].alias("days"),
            (outcome["n"] > 1).alias("collided"),
        )

    def orphan(admission: Column) -> Column:
        return F.struct(
            admission["row"].alias("row"),
            nobody.alias("taken"),
            F.lit(None).cast("int").alias("days"),
            F.lit(False).alias("collided"),
        )

    matched = grouped.withColumn("m", F.aggregate("n", empty, fold)).withColumn(
        "used", F.transform("m", lambda o: o["best"]["pos"])
    )
    unused = F.filter(
        "h", lambda _, i: ~F.coalesce(F.array_contains("used", i), F.lit(False))
    )
    return matched.select(
        F.explode(
            F.concat(F.zip_with("n", "m", linked), F.transform(unused, orphan))
        ).alias("o")
    ).select("o.*")


# ---------------------------------------------------------------------------
# Hot keys
# ---------------------------------------------------------------------------
def _events(rows: DataFrame, options: LinkOptions) -> DataFrame:
    """``(_key, notified, ord, at)``: a row for each date of a row."""
    order = F.col(options.order)

    def side(flag: str, notified: bool, at: str) -> DataFrame:
        return rows.filter(flag).select(
            "_key", F.lit(notified).alias("notified"), order.alias("ord"), _micros(F.col(at)).alias("at")
        )

    return side("_is_notified", True, options.notified).unionByName(
        side("_is_admitted", False, options.admitted)
    )


def _output_hot(
    rows: DataFrame,
    stats: DataFrame,
    payload: Sequence[str],
    options: LinkOptions,
    staging: Staging,
) -> DataFrame:
    """Rows of hot keys in the shape :func:`_match_small` gives."""
    record = F.struct(*payload)
    order = F.col(options.order)
    notified = rows.filter("_is_notified").select(order.alias("_n_ord"), record.alias("row"))
    admitted = rows.filter("_is_admitted").select(order.alias("_h_ord"), record.alias("row"))
    events = _events(rows, options)
    matches = staging.table(
        match_hot(events, stats, options.window_days, options.sizes, staging), "hot-matches"
    )
    taken = matches.join(admitted.withColumnRenamed("row", "taken"), "_h_ord").drop("_h_ord")
    linked = notified.join(taken, "_n_ord", "left").select(
        "row", "taken", "days", F.coalesce("collided", F.lit(False)).alias("collided")
    )
    orphans = admitted.join(matches, "_h_ord", "left_anti").select(
        "row",
        F.lit(None).cast(linked.schema["taken"].dataType).alias("taken"),
        F.lit(None).cast("int").alias("days"),
        F.lit(False).alias("collided"),
    )
    return linked.unionByName(orphans)


# ---------------------------------------------------------------------------
# Public operators
# ---------------------------------------------------------------------------
def link_rows(
    rows: DataFrame, options: LinkOptions = LinkOptions(), staging: Staging | None = None
) -> DataFrame:
    """Match and give every dated row back: ``(row, taken, days, collided)``.

    ``row`` is the notification, or an admission nobody took; ``taken`` is the
    admission it was linked to. ``rows`` is read more than once, so pass a
    stored table. ``order`` must be unique among notifications and among
    admissions.
    """
    staging = staging or Staging(rows.sparkSession)
    payload = rows.columns
    dated = (
        rows.withColumn("_is_notified", F.col(options.notified).isNotNull())
        .withColumn("_is_admitted", F.col(options.admitted).isNotNull())
        .filter("_is_notified OR _is_admitted")
        .withColumn("_key", _key(options.keys))
    )
    limit = options.small_key_rows
    hot = staging.table(
        dated.groupBy("_key")
        .agg(
            F.count_if("_is_notified").alias("n_rows"),
            F.count_if("_is_admitted").alias("h_rows"),
        )
        .filter((F.col("n_rows") > limit) | (F.col("h_rows") > limit)),
        "hot-keys",
    )
    if hot.isEmpty():
        return _match_small(dated, payload, options)
    hot_keys = hot.select("_key")
    small = join_checked(dated, hot_keys, ["_key"], "left_anti")
    large = staging.table(join_checked(dated, hot_keys, ["_key"], "left_semi"), "hot-rows")
    return _match_small(small, payload, options).unionByName(
        _output_hot(large, hot, payload, options, staging)
    )


def link_cases(
    cases: DataFrame,
    options: LinkOptions = LinkOptions(),
    staging: Staging | None = None,
    keep_death: bool = False,
) -> DataFrame:
    """Unified cases: linked notifications, others as they were.

    A linked row takes hospital and admission date from the admission and
    becomes hospitalised - also when it was a death, unless ``keep_death``.
    ``link_collided`` marks links that had more than one unused candidate.
    """
    outcome = link_rows(cases, options, staging)
    linked = F.col("taken").isNotNull()
    forced = linked
    if keep_death:
        forced = linked & (F.col("row.estatus_paciente") != "DEFUNCION")
    replaced = {
        "hospital": F.when(linked, F.col("taken.hospital")),
        options.admitted: F.when(linked, F.col(f"taken.{options.admitted}")),
        "estatus_paciente": F.when(forced, F.lit(HOSPITALISED)),
        "es_registro_unificado": F.when(linked, F.lit(True)),
        "dias_entre_notificacion_e_ingreso": F.when(linked, F.col("days")),
    }
    columns = [
        replaced[c].otherwise(F.col(f"row.{c}")).alias(c) if c in replaced
        else F.col(f"row.{c}").alias(c)
        for c in cases.columns
    ]
    unified = outcome.select(*columns, F.col("collided").alias("link_collided"))
    undated = cases.filter(
        F.col(options.notified).isNull() & F.col(options.admitted).isNull()
    ).withColumn("link_collided", F.lit(False))
    return unified.unionByName(undated)


def link_counters(unified: DataFrame) -> DataFrame:
    """One row: links, rows left alone, and links that had a choice."""
    return unified.agg(
        F.count_if("es_registro_unificado").alias("cruces_exitosos"),
        F.count_if(~F.col("es_registro_unificado")).alias("registros_huerfanos"),
        F.count_if("link_collided").alias("colisiones_llave_sintetica"),
    )
