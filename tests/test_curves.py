"""Interpolation against numpy."""

import numpy as np
from helpers import rows

from pledgeflow.operators import curves


def _filled(spark, data, **kw):
    df = spark.createDataFrame(data, "e string, day int, ts long, v double, c double")
    daily = curves.latest_per_day(df, "e", "day", ["ts"], ["v", "c"])
    return curves.interpolate_daily(daily, "e", "day", ["v"], ["c"], **kw)


def test_matches_linear_interpolation(spark):
    points = {0: 1.0, 2: 5.0, 3: 4.0, 7: 9.0, 12: 20.0}
    got = _filled(spark, [("a", d, d, v, v) for d, v in points.items()]).orderBy("day").collect()
    want = np.interp(range(13), list(points), list(points.values()))
    assert np.allclose([r.v for r in got], want)
    assert [r.c for r in got] == [float(np.round(w)) for w in want]  # numpy rounds half-even too


def test_day_zero_is_added_and_counts_as_a_point(spark):
    data = [("a", d, d, 8.0, 1.0) for d in (4, 5, 6, 7)]
    got = _filled(spark, data).orderBy("day").collect()
    assert [r.day for r in got] == list(range(8))
    assert [r.v for r in got][:5] == [0.0, 2.0, 4.0, 6.0, 8.0]


def test_few_points_are_dropped(spark):
    assert _filled(spark, [("a", d, d, 1.0, 1.0) for d in (0, 1, 2, 3)]).count() == 0
    assert _filled(spark, [("a", d, d, 1.0, 1.0) for d in (0, 1, 2, 3, 4)]).count() == 5


def test_latest_row_of_a_day_wins_and_negative_days_go(spark):
    data = [("a", 0, 1, 1.0, 0.0), ("a", 0, 2, 3.0, 0.0), ("a", -2, 0, 9.0, 0.0)]
    data += [("a", d, d, float(d), 0.0) for d in (1, 2, 3, 4)]
    got = _filled(spark, data).orderBy("day").collect()
    assert [r.v for r in got] == [3.0, 1.0, 2.0, 3.0, 4.0]


def test_curve_medians(spark):
    data = [("a", d, d, float(d), 0.0) for d in range(6)] + [("b", d, d, 3.0 * d, 0.0) for d in range(5)]
    got = rows(curves.funding_curve(_filled(spark, data), "day", ["v"]))
    assert got == [(d, 2.0 * d, 2) for d in range(5)] + [(5, 5.0, 1)]
