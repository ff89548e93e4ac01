from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from branchledger.operators.periods import Closing, assign_period, intervals, shift_month


def loop(closings, day, fallback):
    """The rule as a scan over the calendar of one department."""
    for c in closings:
        end = c.end or date(2099, 12, 31)
        if day <= c.start:
            return shift_month(c.period, -1)
        if c.start < day <= end:
            return shift_month(c.period, 0)
        if day > end and c == closings[-1]:
            return shift_month(c.period, 1)
    return day.replace(day=1) if fallback else None


def random_calendar(rng):
    closings, day = [], date(2025, 1, rng.randint(1, 28))
    for i in range(rng.randint(0, 5)):
        start = day + timedelta(days=rng.randint(-10, 10))
        end = None if rng.random() < 0.15 else start + timedelta(days=rng.randint(-5, 45))
        closings.append(Closing(start, end, f"2025-{i + 1:02d}"))
        if rng.random() < 0.1:
            closings.append(closings[rng.randrange(len(closings))])
        day = (end or start) + timedelta(days=rng.randint(-5, 12))
    return closings


def test_intervals_equal_the_loop():
    rng = random.Random(7)
    for _ in range(1500):
        closings = random_calendar(rng)
        rows = intervals(closings)
        for k in range(40):
            day = date(2024, 11, 1) + timedelta(days=rng.randint(0, 420))
            hits = [m for after, until, m in rows if after < day <= until]
            assert len(hits) <= 1
            assert (hits[0] if hits else None) == loop(closings, day, fallback=False)


@pytest.mark.parametrize("fallback", ["month", None])
def test_assign_period(spark, fallback):
    rng = random.Random(11)
    calendar = {f"d{i}": random_calendar(rng) for i in range(12)} | {"empty": []}
    days = [date(2024, 12, 1) + timedelta(days=i) for i in range(0, 300, 3)]
    data = [(d, x) for d in [*calendar, "absent", None] for x in [*days, None]]
    df = spark.createDataFrame(data, "dept string, posting_date date")
    got = assign_period(df, calendar, fallback=fallback).collect()
    assert len(got) == len(data)
    for r in got:
        want = r.posting_date and loop(calendar.get(r.dept, []), r.posting_date, fallback)
        assert (r.period, r.closing_month, r.closing_year) == (
            (want.strftime("%Y-%m"), want.month, want.year) if want else (None, None, None)
        ), r


def test_bounds_are_exclusive_inclusive(spark):
    calendar = {"d": [Closing(date(2026, 1, 3), date(2026, 2, 3), "2026-01"), Closing(date(2026, 2, 10), date(2026, 3, 3), "2026-02")]}
    days = {date(2026, 1, 3): "2025-12", date(2026, 1, 4): "2026-01", date(2026, 2, 3): "2026-01",
            date(2026, 2, 4): "2026-01", date(2026, 2, 10): "2026-01", date(2026, 2, 11): "2026-02",
            date(2026, 3, 4): "2026-03"}
    df = spark.createDataFrame([("d", d) for d in days], "dept string, posting_date date")
    assert {r.posting_date: r.period for r in assign_period(df, calendar).collect()} == days


def test_period_needs_no_join(spark):
    calendar = {"d": [Closing(date(2026, 1, 3), None, "2026-01")]}
    df = spark.range(10).select(F.col("id").cast("string").alias("dept"), F.date_add(F.current_date(), F.col("id").cast("int")).alias("posting_date"))
    plan = assign_period(df, calendar)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and "split(" not in plan


def test_closings_a_few_days_apart(spark):
    """And dates far outside of them, and behind an open end."""
    rng = random.Random(3)
    day, closings = date(2024, 1, 1), []
    for i in range(60):
        end = day + timedelta(days=rng.randint(1, 4))
        closings.append(Closing(day, end, f"{2020 + i // 12}-{i % 12 + 1:02d}"))
        day = end + timedelta(days=rng.randint(0, 2))
    calendar = {"d": closings, "short": [Closing(date(1999, 5, 2), date(1999, 5, 3), "1999-05")],
                "open": [Closing(date(1999, 5, 2), None, "1999-05")]}
    days = [date(2023, 12, 1) + timedelta(days=i) for i in range(300)] + [date(1970, 1, 1), date(1901, 3, 4), date(2099, 12, 31), date(2100, 1, 1), date(2500, 1, 1), date(9999, 12, 31)]
    df = spark.createDataFrame([(d, x) for d in calendar for x in days], "dept string, posting_date date")
    for r in assign_period(df, calendar, fallback=None).collect():
        assert r.period == loop(calendar[r.dept], r.posting_date, None).strftime("%Y-%m"), r
