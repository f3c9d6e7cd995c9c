"""Linkage against a plain greedy model."""

import random
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from caseloom.operators import hot_linkage
from caseloom.operators.hot_linkage import DAY_US, HotSizes, cut_at_gaps, with_cells
from caseloom.operators.linkage import (
    LinkOptions,
    link_candidates,
    link_cases,
    link_counters,
    link_rows,
)
from caseloom.operators.scaling import Staging

SCHEMA = (
    "row_order bigint, paciente_id string, edad double, sexo string,"
    " fecha_notificacion timestamp_ntz, fecha_ingreso_hospital timestamp_ntz,"
    " estatus_paciente string, hospital string, es_registro_unificado boolean,"
    " dias_entre_notificacion_e_ingreso int"
)


def row(order, key, notified=None, admitted=None, status="AMBULATORIO", hospital=None):
    return (order, key, 30.0, "F", notified, admitted, status, hospital, False, None)


def model(rows, window=7):
    """notification order -> (admission order, days, had a choice)"""
    used, out = set(), {}
    admissions = sorted((r for r in rows if r[5]), key=lambda r: r[0])
    for n in sorted((r for r in rows if r[4]), key=lambda r: r[0]):
        near = [
            (abs((h[5] - n[4]).days), h[0])
            for h in admissions
            if h[1] == n[1] and h[0] not in used and abs((h[5] - n[4]).days) <= window
        ]
        if near:
            days, taken = min(near)
            used.add(taken)
            out[n[0]] = (taken, days, len(near) > 1)
    return out


def outcome(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    got = link_rows(df, LinkOptions(**options)).select(
        "row.row_order", F.col("taken.row_order").alias("taken"), "days", "collided"
    )
    return [tuple(r) for r in got.collect()]


def random_rows(seed, n, keys, days, clock):
    rng = random.Random(seed)
    base = datetime(2021, 1, 1)
    rows = []
    for i in range(n):
        when = base + timedelta(days=rng.randrange(days))
        if clock == "both" or (clock == "admitted" and i % 2):
            when += timedelta(hours=rng.randrange(24))
        if clock == "shifted":
            when += timedelta(hours=9 if i % 2 == 0 else rng.randrange(24))
        key = f"k{rng.randrange(keys)}"
        rows.append(row(i, key, None if i % 2 else when, when if i % 2 else None))
    rng.shuffle(rows)
    return [(i, *r[1:]) for i, r in enumerate(rows)]


@pytest.mark.parametrize(
    ("clock", "options"),
    [
        ("dates", {}),
        ("both", {"small_key_rows": 1000}),
        ("dates", {"small_key_rows": 0, "sizes": HotSizes(1000)}),
        ("admitted", {"small_key_rows": 20, "sizes": HotSizes(10, 25)}),
        ("shifted", {"small_key_rows": 20, "sizes": HotSizes(10, 25)}),
        ("both", {"small_key_rows": 0, "sizes": HotSizes(3, 40, 600)}),
        ("shifted", {"small_key_rows": 0, "sizes": HotSizes(20)}),
        ("both", {"small_key_rows": 5, "sizes": HotSizes(20)}),
    ],
)
def test_same_as_greedy_model(spark, clock, options):
    rows = random_rows(7, 160, 4, 25, clock)
    # one key with far more rows than the others
    rows += [
        (1000 + r[0], "hot", *r[2:]) for r in random_rows(8, 140, 1, 20, clock)
    ]
    expected = model(rows)
    got = outcome(spark, rows, **options)
    assert {o: (t, d, c) for o, t, d, c in got if t is not None} == expected
    taken = {t for t, _, _ in expected.values()}
    rest = {r[0] for r in rows} - set(expected) - taken
    assert sorted(o for o, t, _, _ in got if t is None) == sorted(rest)


def test_a_hot_key_falls_into_pieces(spark):
    """Twenty clusters of some days, three weeks apart: each is matched on its own."""
    rng = random.Random(5)
    rows = []
    for i in range(400):
        cluster, day = i % 20, rng.randrange(3)
        when = datetime(2021, 1, 1) + timedelta(days=24 * cluster + day, minutes=rng.randrange(1440))
        rows.append(row(i, "hot", when if rng.random() < 0.5 else None, None))
        if rows[-1][4] is None:
            rows[-1] = row(i, "hot", None, when)
    expected = model(rows)
    got = outcome(spark, rows, small_key_rows=0, sizes=HotSizes(30, 10))
    assert {o: (t, d, c) for o, t, d, c in got if t is not None} == expected
    events = spark.createDataFrame(
        [("hot", r[4] is not None, r[0], int((r[4] or r[5]).timestamp() * 1e6)) for r in rows],
        "_key string, notified boolean, ord bigint, at bigint",
    )
    pieces = cut_at_gaps(events, 7, Staging(spark))
    assert pieces.count() == 400 and pieces.select("_key").distinct().count() >= 20
    # within reach of each other, nothing is cut
    assert cut_at_gaps(events, 24, Staging(spark)).select("_key").distinct().count() == 1


def test_a_chunk_gets_its_admissions_in_runs():
    """Lists of admissions, a row for each stored run of a cell, in any order."""
    chunk = pa.table({"_key": ["k"] * 3, "n_seq": [2, 0, 1], "at": [0, 0, DAY_US]})
    runs = pa.table(
        {
            "_key": ["k"] * 3,
            "cell": [DAY_US, 0, 0],
            "run": pa.array([0, 1, 0], pa.int32()),
            "heads": [[7], [5], [1]],
            "free": [1, 2, 2],
        }
    )
    found = hot_linkage._fold_chunk(7)(chunk, runs)
    assert found.select(["n_seq", "h_seq", "days", "collided"]).to_pylist() == [
        {"n_seq": 0, "h_seq": 1, "days": 0, "collided": True},
        {"n_seq": 1, "h_seq": 7, "days": 0, "collided": True},
        {"n_seq": 2, "h_seq": 5, "days": 0, "collided": False},
    ]
    assert hot_linkage._fold_chunk(7)(chunk.slice(0, 0), runs).num_rows == 0


def test_runs_of_a_cell_follow_each_other(spark, monkeypatch):
    """Cells of many short runs, a chunk beginning inside one."""
    monkeypatch.setattr(hot_linkage, "RUN_ROWS", 3)
    rows = random_rows(11, 150, 1, 6, "dates")
    got = outcome(spark, rows, small_key_rows=0, sizes=HotSizes(3, 20))
    assert {o: (t, d, c) for o, t, d, c in got if t is not None} == model(rows)


def test_a_stray_time_of_day_doubles_the_cells_at_most(spark):
    events = [("k", True, i, i * DAY_US + 9 * 3_600_000_000) for i in range(20)]
    events += [("k", False, i, i * 3_600_000_000 * 5) for i in range(96)]
    schema = "_key string, notified boolean, ord bigint, at bigint"

    def cells(rows):
        found = with_cells(spark.createDataFrame(rows, schema), Staging(spark))
        return found.select("cell").distinct().count()

    plain = cells(events)
    assert plain == 21 and cells([*events, ("k", True, 99, 3 * DAY_US + 5)]) <= 2 * plain


def test_four_days_link_and_fourteen_do_not(spark):
    base = datetime(2020, 3, 18)
    rows = [
        row(1, "a", notified=base),
        row(2, "a", admitted=base + timedelta(days=4), hospital="H"),
        row(3, "b", notified=base),
        row(4, "b", admitted=base + timedelta(days=14)),
        row(5, "c", notified=base),
        row(6, "c", admitted=base + timedelta(days=5), hospital="far"),
        row(7, "c", admitted=base + timedelta(days=2), hospital="near"),
        row(8, "d", status="DEFUNCION"),
        row(9, "e", notified=base, status="DEFUNCION"),
        row(10, "e", admitted=base),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    unified = link_cases(df)
    by_order = {r.row_order: r for r in unified.collect()}
    assert sorted(by_order) == [1, 3, 4, 5, 6, 8, 9]
    assert by_order[1].es_registro_unificado and by_order[1].hospital == "H"
    assert by_order[1].dias_entre_notificacion_e_ingreso == 4
    assert by_order[1].estatus_paciente == "HOSPITALIZADO"
    assert by_order[5].hospital == "near" and by_order[5].link_collided
    assert by_order[9].estatus_paciente == "HOSPITALIZADO"
    kept = {r.row_order: r for r in link_cases(df, keep_death=True).collect()}
    assert kept[9].estatus_paciente == "DEFUNCION" and kept[9].es_registro_unificado
    counters = link_counters(unified).first()
    assert tuple(counters) == (3, 4, 1)


def test_earlier_admission_counts_a_started_day(spark):
    base = datetime(2021, 5, 1, 12)
    rows = [row(1, "a", notified=base), row(2, "a", admitted=base - timedelta(hours=2))]
    assert outcome(spark, rows)[0][1:3] == (2, 1)


def test_row_with_both_dates_can_link_to_itself(spark):
    base = datetime(2021, 5, 1)
    rows = [row(1, "a", notified=base, admitted=base)]
    assert outcome(spark, rows) == [(1, 1, 0, False)]
    assert outcome(spark, rows, small_key_rows=0) == [(1, 1, 0, False)]


def test_hot_key_with_one_side_only(spark):
    base = datetime(2021, 5, 1)
    rows = [row(i, "a", notified=base) for i in range(9)]
    assert sorted(outcome(spark, rows, small_key_rows=2)) == [
        (i, None, None, False) for i in range(9)
    ]


def test_candidates_are_counted_without_pairs(spark):
    rows = random_rows(3, 120, 3, 30, "both")
    df = spark.createDataFrame(rows, SCHEMA)
    notified = df.filter("fecha_notificacion is not null").drop("fecha_ingreso_hospital")
    admitted = df.filter("fecha_ingreso_hospital is not null").drop("fecha_notificacion")
    got = {
        r.row_order: (r.n_candidates, r.nearest_days)
        for r in link_candidates(notified, admitted).collect()
    }
    for n in (r for r in rows if r[4]):
        near = [
            abs((h[5] - n[4]).days)
            for h in rows
            if h[5] and h[1] == n[1] and abs((h[5] - n[4]).days) <= 7
        ]
        assert got[n[0]] == (len(near), min(near, default=None))


def test_staging_reads_the_checkpoint_folder_from_the_session(spark):
    staging = Staging(spark)
    assert staging.root.startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))
    table = staging.table(spark.range(3).withColumn("k", F.col("id") % 2), "t", ["k"])
    assert table.count() == 3
    staging.clear()
