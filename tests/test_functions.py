from datetime import date

import pytest
from pyspark.sql import functions as F

from wattframe.functions.calendar import calendar_columns, period_bounds, period_label
from wattframe.functions.fixed_values import FUEL_COLUMN_LABELS, REGIONS, STATES
from wattframe.functions.labels import BLANKS, column_label, lookup, place_name, state_code
from wattframe.functions.measures import mean, percent, ratio
from wattframe.functions.parsing import code_part, day, month_start, number, whole, year_number


def values(frame, *columns):
    return [tuple(row) if len(columns) > 1 else row[0] for row in frame.select(*columns).collect()]


@pytest.mark.parametrize(
    "raw, name",
    [
        ("California", "California"), ("TEXAS", "Texas"), ("USA-NM", "New Mexico"),
        ("NM", "New Mexico"), ("R20", "PADD 2 (Midwest)"), ("NUS", "U.S. Total"),
        ("Baltimore, MD", "Baltimore, MD"), ("DISTRICT OF COLUMBIA", "DISTRICT OF COLUMBIA"),
        ("ZZ", "ZZ"), ("USA-ZZ", "USA-ZZ"), ("  ", ""), (None, None), (" new york ", "New York"),
        ("tx", "tx"), ("District of Columbia", "District of Columbia"), ("USA-TXX", "USA-TXX"),
    ],
)
def test_place_name(spark, raw, name):
    frame = spark.createDataFrame([(raw,)], "p string")
    assert values(frame, place_name(F.col("p"))) == [name]


def test_place_names_are_stable(spark):
    names = [*STATES, *STATES.values(), *REGIONS, *REGIONS.values()]
    frame = spark.createDataFrame([(name,) for name in names], "p string")
    once = frame.select(place_name(F.col("p")).alias("p"))
    assert values(once, "p") == values(once, place_name(F.col("p")))


def test_state_codes(spark):
    frame = spark.createDataFrame([("Texas",), ("TEXAS",), ("Guam",), (None,)], "p string")
    assert values(frame, state_code(F.col("p"))) == ["TX", None, None, None]


@pytest.mark.parametrize(
    "column, label",
    [
        ("TE", "Total Energy (All Sources)"), ("co_pct", "Coal (% of Total)"),
        ("wy_pct", "Wind Energy (% of Total)"), ("zz_pct", "ZZ (% of Total)"),
        ("num_series", "Num Series"), ("te", "Total Energy (All Sources)"),
        ("total_btu", "TOTAL (Billion BTU)"), ("x_mbtu", "X (Million BTU)"),
    ],
)
def test_column_label(column, label):
    assert column_label(column) == label


def test_fixed_tables_are_whole():
    assert len(STATES) == 51 and len(REGIONS) == 10 and len(FUEL_COLUMN_LABELS) == 33


def test_parsing_gives_null_for_anything_malformed(spark):
    texts = ["12", " 12.5 ", "NA", "", None, "12.0", "value"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert values(frame, number("t")) == [12.0, 12.5, None, None, None, 12.0, None]
    assert values(frame, whole("t")) == [12, 12, None, None, None, 12, None]
    assert values(frame, year_number("t"))[:3] == [12, None, None]
    dates = spark.createDataFrame(
        [("2025-01", "2025-01-03"), ("2025-13", "2025-02-30"), ("x", ""), (None, None)],
        "m string, d string",
    )
    assert values(dates, month_start("m"), day("d")) == [
        (date(2025, 1, 1), date(2025, 1, 3)), (None, None), (None, None), (None, None)
    ]


def test_hyphenated_headers_and_code_parts(spark):
    frame = spark.createDataFrame([("1", "COTCB")], "`area-name` string, c string")
    assert values(frame, number("area-name")) == [1.0]
    parts = [code_part("c", 1, 2), code_part("c", 3, 2), code_part("c", 5, 1)]
    assert values(frame, *parts) == [("CO", "TC", "B")]


def test_lookup_and_measures(spark):
    frame = spark.createDataFrame([("a", 1.0, 3.0), ("z", 1.0, 0.0), ("z", None, 2.0)], "c string, x double, y double")
    code = F.col("c")
    assert values(frame, lookup({"a": "A"}, code)) == ["A", None, None]
    assert values(frame, lookup({"a": "A"}, code, code)) == ["A", "z", "z"]
    assert values(frame, percent("x", "y", 2)) == [33.33, None, None]
    assert values(frame, ratio("x", "y"))[1] is None
    assert frame.agg(mean("x")).first()[0] == 1.0
    assert frame.where("x IS NULL").agg(mean("x")).first()[0] is None


def test_calendar(spark):
    frame = spark.createDataFrame([(date(2024, 12, 30),), (date(2024, 3, 5),)], "d date")
    weekly = calendar_columns(F.col("d"), "weekly")
    assert values(frame, weekly["year"], weekly["week"]) == [(2025, 1), (2024, 10)]
    monthly = calendar_columns(F.col("d"), "monthly")
    assert values(frame, monthly["year"], monthly["month"]) == [(2024, 12), (2024, 3)]
    labels = [
        period_label("monthly", F.col("d")), period_label("weekly", F.col("d")),
        period_label("annual", year=F.year("d")),
    ]
    assert values(frame, *labels)[0] == ("December 2024", "Week 1, 2025", "2024")


def test_period_bounds():
    assert period_bounds("monthly", 2024, 12) == (date(2024, 12, 1), date(2025, 1, 1))
    assert period_bounds("monthly", 2024) == (date(2024, 1, 1), date(2025, 1, 1))
    assert period_bounds("weekly", 2025, week=1) == (date(2024, 12, 30), date(2025, 1, 6))
    assert period_bounds("weekly", 2020, week=53) == (date(2020, 12, 28), date(2021, 1, 4))
    first, after = period_bounds("weekly", 2024, week=53)  # 2024 has 52 ISO weeks
    assert first == after
    first, after = period_bounds("monthly", 2024, 13)
    assert first == after


def test_places_lose_any_blanks_at_their_ends(spark):
    """Tabs, line breaks and wide blanks as well as spaces; blanks inside stay."""
    assert set(BLANKS) == {chr(i) for i in range(0x110000) if chr(i).isspace()}
    written = ["\tTX", "TEXAS\r\n", " USA-NM 　", " new\tmexico ", "\n", "", None, "New Mexico\t"]
    rows = spark.createDataFrame([(i, name) for i, name in enumerate(written)], "i int, name string")
    found = rows.select("i", place_name(F.col("name")), state_code(F.col("name"))).orderBy("i").collect()
    assert [r[1] for r in found] == ["Texas", "Texas", "New Mexico", "new\tmexico", "", "", None, "New Mexico"]
    assert [r[2] for r in found] == [None] * 7 + ["NM"]
