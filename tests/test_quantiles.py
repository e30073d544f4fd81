"""Exact quantiles by selection against numpy."""

import math
import random

import numpy as np
import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from pledgeflow.operators import quantiles


def _frame(spark, groups):
    data = [(g, v) for g, values in groups.items() for v in values]
    return spark.createDataFrame(data, "g string, v double").repartition(4)


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(7)
    return {
        "hot": [round(rng.lognormvariate(5, 2), 2) for _ in range(3000)],
        "ties": [1.0] * 500 + [2.0] * 499,
        "signed": [rng.gauss(0, 1000) for _ in range(301)],
        "one": [-3.5],
        "two": [1.0, 4.0],
        "tiny": [1e-9 * i for i in range(50)],
    }


def test_matches_numpy(spark, groups):
    probs = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    got = quantiles.group_quantiles(_frame(spark, groups), ["g"], "v", probs)
    for r in got.collect():
        assert r.n == len(groups[r.g])
        for name, p in probs.items():
            assert math.isclose(r[name], float(np.percentile(groups[r.g], p * 100)), rel_tol=1e-12, abs_tol=1e-18)


def test_nulls_and_nan_are_left_out(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", float("nan")), ("a", 3.0), ("b", None)], "g string, v double")
    assert rows(quantiles.group_quantiles(df, ["g"], "v", {"m": 0.5})) == [("a", 2, 2.0)]


def test_without_groups(spark):
    df = spark.range(101).select((F.col("id") * F.col("id")).alias("v"))
    assert quantiles.middle_rows_median(df, "v").collect()[0][0] == 2500.0


def test_large_target_table_falls_back_to_a_shuffle_join(spark, groups, monkeypatch):
    monkeypatch.setattr(quantiles, "MAX_BROADCAST", 0)
    got = {r.g: r.m for r in quantiles.group_quantiles(_frame(spark, groups), ["g"], "v", {"m": 0.5}).collect()}
    assert all(math.isclose(got[g], float(np.median(v)), rel_tol=1e-12, abs_tol=1e-18) for g, v in groups.items())


def test_box_whisker_ends_on_a_data_point(spark, groups):
    for r in quantiles.box_stats(_frame(spark, groups), ["g"], "v").collect():
        values = np.array(groups[r.g])
        assert r.whisker_low == values.min()
        assert r.whisker_high == values[values <= np.percentile(values, 90)].max()


def test_no_group_is_collected(spark, groups):
    text = plan(quantiles.group_quantiles(_frame(spark, groups), ["g"], "v", {"m": 0.5}))
    assert "collect_list" not in text and "percentile" not in text.lower()


def test_describe_uses_sample_and_stats_population_deviation(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "v double")
    wide = quantiles.describe_wide(df, ["v"]).collect()[0]
    stats = quantiles.column_stats(df, ["v"]).collect()[0]
    assert math.isclose(wide.std_dev, np.std([1, 2, 4], ddof=1))
    assert stats.sd == round(float(np.std([1, 2, 4])), 4)
    assert (stats.n, stats.median, wide.sum) == (3, 2.0, 7.0)


def test_crowded_intervals_are_cut(spark, monkeypatch):
    """Bounds that hold too many rows are sketched again: values near each other, steep ones and ties."""
    monkeypatch.setattr(quantiles, "RANKED_ROWS", 50)
    monkeypatch.setattr(quantiles, "SKETCH_K", 200)
    groups = {
        "tiny": [i * 1e-9 for i in range(2000)],
        "near": [1000 + i * 1e-4 for i in range(2000)],
        "steep": [2.0**-i for i in range(1000)] + [0.0] * 300 + [-(2.0**-i) for i in range(900)],
        "ties": [5.0] * 900 + [5.0000001] * 901 + [5.0000002],
    }
    probs = {"p1": 0.01, "p50": 0.5, "p77": 0.77, "p100": 1.0}
    for r in quantiles.group_quantiles(_frame(spark, groups), ["g"], "v", probs).collect():
        for name, p in probs.items():
            assert math.isclose(r[name], float(np.percentile(groups[r.g], p * 100)), rel_tol=1e-12, abs_tol=1e-300), (r.g, name)


def test_a_million_values_below_the_first_bucket_bound(spark):
    df = spark.range(1_000_000).select((F.col("id") * 7e-10).alias("v"))
    assert math.isclose(quantiles.middle_rows_median(df, "v").collect()[0][0], 499_999.5 * 7e-10, rel_tol=1e-12)


def test_column_without_values_keeps_its_row(spark):
    df = spark.createDataFrame([(1.0, None)], "v double, w double")
    got = {r.variable: (r.n, r.mean, r.median) for r in quantiles.column_stats(df, ["v", "w"]).collect()}
    assert got == {"v": (1, 1.0, 1.0), "w": (0, None, None)}


def _scans(monkeypatch):
    """Record how often the rows are scanned after the first look."""
    calls, counted = [], quantiles._counted
    monkeypatch.setattr(quantiles, "_counted", lambda *a, **k: calls.append(k["ranked"]) or counted(*a, **k))
    return calls


def test_two_scans_of_the_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "rows")
    spark.range(200_000).select((F.col("id") % 7).alias("g"), F.rand(3).alias("v"), F.rand(4).alias("w")).write.parquet(path)
    df = spark.read.parquet(path)
    for make in (
        lambda: quantiles.describe_wide(df, ["v", "w"]),
        lambda: quantiles.box_stats(df, ["g"], "v"),
        lambda: quantiles.group_quantiles(df, ["g"], "w", {"m": 0.5}),
    ):
        calls = _scans(monkeypatch)
        result = make()
        assert calls == [True]  # one look for the sketches, one ranking scan
        assert path not in plan(result)
        monkeypatch.undo()


def test_missed_bounds_are_found_again(spark, monkeypatch):
    """Bounds too narrow for the sketch's error miss most ranks; exact counts see it."""
    monkeypatch.setattr(quantiles, "SKETCH_K", 50)
    monkeypatch.setattr(quantiles, "_slack", lambda: 0.0)
    calls = _scans(monkeypatch)
    rng = random.Random(5)
    groups = {g: [rng.gauss(0, 1) for _ in range(2000)] for g in "ab"}
    probs = {"p10": 0.1, "p50": 0.5, "p95": 0.95}
    for r in quantiles.group_quantiles(_frame(spark, groups), ["g"], "v", probs).collect():
        for name, p in probs.items():
            assert math.isclose(r[name], float(np.percentile(groups[r.g], p * 100)), rel_tol=1e-12)
    assert len(calls) > 1


def test_null_keys_are_a_group_and_infinities_are_values(spark):
    inf = math.inf
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", -inf), ("a", 2.0), ("a", inf)], "g string, v double")
    assert rows(quantiles.group_quantiles(df, ["g"], "v", {"m": 0.5})) == [("a", 3, 2.0), (None, 2, 2.0)]
    assert {(r.g, r.q50) for r in quantiles.box_stats(df.filter("abs(v) < 9"), ["g"], "v").collect()} == {(None, 2.0), ("a", 2.0)}
    empty = df.filter("false")
    assert rows(quantiles.group_quantiles(empty, ["g"], "v", {"m": 0.5})) == []
    assert [(r.n, r.median) for r in quantiles.column_stats(empty, ["v"]).collect()] == [(0, None)]
