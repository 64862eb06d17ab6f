from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattframe.plans.ingest import latest_period, load_periods, load_ranges, run_range, step_back
from wattframe.sources.catalog import SOURCES


def test_latest_period_skips_blanks_and_headers(raw):
    frame = raw(["period"], *[{"period": p} for p in ("2025-01", "2025-03", " ", "", None, "period")])
    assert latest_period(frame).first()[0] == "2025-03"
    assert latest_period(frame.limit(0)).first()[0] is None


@pytest.mark.parametrize(
    "latest, grain, step, start",
    [
        ("2024", "annual", "1 year", "2023"), ("2024", "annual", "2 years", "2022"),
        ("2025-03", "monthly", "2 months", "2025-01"),
        ("2025-03-31", "weekly", "1 month", "2025-02"),
        ("2025-03-31", "weekly", "2 weeks", "2025-03-17"),
        ("2025-03", "monthly", "1 year", "2024-03"), ("2025-01", "monthly", "1 month", "2024-12"),
        ("nonsense", "monthly", "1 month", None),
    ],
)
def test_step_back(spark, latest, grain, step, start):
    frame = spark.createDataFrame([(latest,)], "p string")
    assert frame.select(step_back(F.col("p"), grain, step)).first()[0] == start


@pytest.mark.parametrize(
    "start, end, grain, periods",
    [
        ("2025-01", "2025-03", "monthly", ["2025-01", "2025-02", "2025-03"]),
        ("2023", "2025", "annual", ["2023", "2024", "2025"]),
        ("2025-01-20", "2025-02-03", "weekly", ["2025-01", "2025-02"]),
        ("2025-02", "2025-01", "monthly", []), ("2025", "2024", "annual", []),
        ("2025-05", "2025-05", "monthly", ["2025-05"]),
    ],
)
def test_load_ranges(spark, start, end, grain, periods):
    found = [tuple(row) for row in load_ranges(spark, start, end, grain).collect()]
    assert found == [(period, period) for period in periods]


def test_no_start_is_one_open_range(spark):
    assert [tuple(r) for r in load_ranges(spark, None, "2025", "annual").collect()] == [(None, None)]


@settings(max_examples=15, deadline=None)
@given(st.integers(0, 400), st.integers(0, 60))
def test_periods_cover_the_range_without_gap(spark, first, length):
    def month(number):
        return f"{1990 + number // 12}-{number % 12 + 1:02d}"

    frame = spark.range(1).select(
        load_periods(F.lit(month(first)), F.lit(month(first + length)), "monthly")
    )
    assert frame.first()[0] == [month(n) for n in range(first, first + length + 1)]


def test_run_range_precedence():
    day = date(2026, 4, 15)
    monthly, annual, weekly = SOURCES["natural_gas"], SOURCES["coal"], SOURCES["petroleum"]
    rankings = SOURCES["electricity_state_rankings"]
    assert run_range(monthly, day, given=("a", "b"), override=("c", "d")) == ("a", "b")
    assert run_range(monthly, day, given=("a", None), override=("c", "d")) == ("c", "d")
    assert run_range(monthly, day) == ("2025-01", "2026-04")
    assert run_range(annual, day, incremental_start="2022") == ("2022", "2026")
    assert run_range(weekly, day, incremental=False, incremental_start="x") == ("2025-01-01", "2026-04-15")
    assert run_range(rankings, day, incremental_start="2022") == (None, "2026")
    assert run_range(monthly, day, override=("2020-01", None), incremental_start="2024-01") == (
        "2020-01", "2026-04"
    )
    assert run_range(monthly, day, override=(None, "2025-06")) == ("2025-01", "2025-06")
