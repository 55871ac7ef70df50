"""Calendars without gaps and yearly waves, against least squares in numpy."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest

from stayscope.operators.seasons import months_without_gaps, yearly_wave

D = dt.date


def test_gaps_are_filled_per_group(spark, rows):
    data = [("a", D(2020, 11, 3), 2.0, 1), ("a", D(2020, 11, 30), 4.0, 1), ("a", D(2021, 2, 1), None, 1), (None, D(2019, 1, 5), 1.0, 1), ("b", None, 5.0, 1)]
    df = spark.createDataFrame(data, "hotel string, day date, score double, month int")
    got = months_without_gaps(df, ["hotel"], "day", "score")
    assert rows(got) == sorted(
        [("a", D(2020, 11, 1), 2, 3.0), ("a", D(2020, 12, 1), 0, None), ("a", D(2021, 1, 1), 0, None), ("a", D(2021, 2, 1), 1, None), (None, D(2019, 1, 1), 1, 1.0)],
        key=repr,
    )
    assert rows(months_without_gaps(df.where("false"), ["hotel"], "day")) == []
    assert months_without_gaps(df, [], "day").count() == 26


def test_waves_are_least_squares(spark):
    pick, data = np.random.default_rng(1), []
    for group in range(5):
        for i in range(int(pick.integers(4, 60))):
            month = D(2015 + i // 12, i % 12 + 1, 1)
            data.append((group, month, float(3 + group + 2 * np.cos((month.month - 4) * np.pi / 6) + pick.normal() * 0.3)))
    data += [(0, D(2001, 1, 1), None), (8, D(2001, 1, 1), 1.0), (8, D(2002, 1, 1), 2.0)]
    got = {r["g"]: r for r in yearly_wave(spark.createDataFrame(data, "g int, month date, y double"), ["g"], "y").collect()}
    assert (got[8]["months"], got[8]["level"], got[8]["amplitude"]) == (2, None, None)
    for group in range(5):
        own = [(m.month - 1, y) for g, m, y in data if g == group and y is not None]
        angle = np.array([m for m, _ in own]) * np.pi / 6
        basis = np.column_stack([np.ones(len(own)), np.cos(angle), np.sin(angle)])
        want = np.linalg.lstsq(basis, np.array([y for _, y in own]), rcond=None)[0]
        r = got[group]
        assert (r["level"], r["cosine"], r["sine"]) == pytest.approx(tuple(want), abs=1e-8)
        assert r["amplitude"] == pytest.approx(np.hypot(*want[1:])) and r["months"] == len(own)
        assert r["peak"] == pytest.approx(np.arctan2(want[2], want[1]) * 6 / np.pi % 12)
