"""Where intermediate tables go."""

import random
from functools import reduce
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from caseloom.errors import ConfigError
from caseloom.functions.text import regex_cascade
from caseloom.operators.scaling import Staging, by_dictionary, prefix_sum, running, shared_folder


def session(master, conf=None, context=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: (conf or {}).get(key, default)),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: context),
    )


def test_the_session_names_the_folder_then_the_context():
    assert shared_folder(session("yarn", {"spark.checkpoint.dir": "hdfs:///c"}, "hdfs:///d")) == "hdfs:///c"
    assert shared_folder(session("yarn", context="hdfs:///d")) == "hdfs:///d"


def test_a_temp_folder_serves_one_machine_only():
    assert shared_folder(session("local[4]")) and shared_folder(session("local"))
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ConfigError):
            shared_folder(session(master))


def test_a_named_folder_is_used_and_no_setting_changed(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    staging = Staging(spark, f"file://{tmp_path}/own")
    kept = staging.table(spark.range(3), "three")
    assert kept.count() == 3 and any((tmp_path / "own").iterdir())
    assert spark.conf.get("spark.checkpoint.dir", None) == before
    staging.clear()
    assert not [p for p in (tmp_path / "own").rglob("*.parquet")]


def test_running_values_are_summed_up_row_by_row(spark):
    """A frame that ends with the group is worked out anew for every row: work grows with the square."""
    df = spark.range(50).selectExpr("'hot' g", "id o", "id v")
    got = running(df, ["g"], ["o"], Staging(spark), {"b": ("sum", F.col("v"))}, {"n": ("min", F.col("v"))})
    plan = got._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "unboundedpreceding" in plan and "unboundedfollowing" not in plan


def test_running_values_equal_those_of_one_list(spark):
    """One group holds most rows; sums, extremes and exclusive-ors before a row, and from it on."""
    rng = random.Random(2)
    rows = [(rng.choice(["hot"] * 8 + ["a", "b"]), i, rng.choice([None, rng.randrange(1000)])) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, o int, v bigint")
    v = F.col("v")
    kinds = ("sum", "max", "min", "bit_xor")
    got = running(
        df,
        ["g"],
        ["o"],
        Staging(spark),
        {f"before_{k}": (k, v) for k in kinds},
        {f"onward_{k}": (k, v) for k in kinds},
    ).collect()
    assert len(got) == len(rows)
    make = {
        "sum": sum,
        "max": lambda x: max(x, default=None),
        "min": lambda x: min(x, default=None),
        "bit_xor": lambda x: reduce(lambda a, b: a ^ b, x, 0),
    }
    for r in got:
        before = [w for g, o, w in rows if g == r["g"] and o < r["o"] and w is not None]
        onward = [w for g, o, w in rows if g == r["g"] and o >= r["o"] and w is not None]
        for k in kinds:
            assert r[f"before_{k}"] == make[k](before) and r[f"onward_{k}"] == make[k](onward), (r, k)
    empty = prefix_sum(df.limit(0), ["g"], ["o"], F.lit(1), "n", Staging(spark))
    assert empty.count() == 0 and empty.columns == ["g", "o", "v", "n"]


def test_a_dictionary_gives_what_rows_give(spark):
    calls = ((("^A.*", "B"), "x"), (("C",), "$1"))
    rows = [(i, ["ABC", "BC", None, "C", ""][i % 5]) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, t string")
    seen = []

    def change(d):
        seen.append(d.columns)
        return regex_cascade(d, "t", calls)

    want = sorted(map(tuple, regex_cascade(df, "t", calls).collect()), key=repr)
    for share, through in ((0.5, ["t", "_t_before"]), (0.0, ["id", "t"])):
        seen.clear()
        got = by_dictionary(df, "t", change, Staging(spark), max_share=share)
        assert got.columns == ["id", "t"] and seen == [through]
        assert sorted(map(tuple, got.collect()), key=repr) == want
    assert by_dictionary(df.limit(0), "t", change, Staging(spark)).count() == 0
