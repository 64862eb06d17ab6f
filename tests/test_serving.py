from datetime import date

import pytest
from pyspark.sql import functions as F

from wattframe.plans import serving
from wattframe.sources.catalog import TABLES, TableSpec
from wattframe.sources.files import write_table


@pytest.fixture
def fuel_table(spark):
    return spark.createDataFrame(
        [(date(2024, 1, 1), "TEXAS", "COL", "Coal", 5.0, 1.0, 9.0, 1.0),
         (date(2024, 1, 1), "Texas", "NG", "Natural Gas", 7.0, 2.0, 9.0, 2.0),
         (date(2024, 1, 1), "OH", "COL", "Coal", 4.0, None, 9.0, 3.0),
         (date(2024, 2, 1), "Ohio", "COL", "Coal", 1.0, 1.0, 9.0, 4.0),
         (date(2023, 1, 1), "Ohio", "NG", "Natural Gas", 2.0, 1.0, 9.0, 5.0),
         (date(2024, 1, 1), None, "NG", "Natural Gas", 50.0, 1.0, 9.0, 6.0),
         (date(2024, 1, 1), "U.S.", "NG", "Natural Gas", 60.0, 1.0, 9.0, 6.0),
         (None, "Ohio", "NG", "Natural Gas", 99.0, 1.0, 9.0, 7.0)],
        "period date, state_name string, fuel_type_id string, fuel_type_label string,"
        " consumption_thousand_mwh double, consumption_btu double, us_fuel_thousand_mwh double,"
        " pct_us_fuel_consumption double",
    )


SPEC = TABLES["electricity_by_fuel"]


@pytest.fixture
def rows(spark, fuel_table, tmp_path):
    write_table(fuel_table, f"{tmp_path}/{SPEC.path}", sort=SPEC.sort)
    return serving.load(spark, SPEC, str(tmp_path))


def listed(frame, *columns):
    return [tuple(row) for row in frame.select(*columns).collect()]


def test_load(rows):
    assert rows.count() == 7  # the undated row is gone
    places = {row[0] for row in rows.select("state").collect()}
    assert places == {"Texas", "Ohio", "U.S.", None}
    assert "state_name" not in rows.columns and {"year", "month"} <= set(rows.columns)


def test_choices(rows):
    assert listed(serving.choices(rows, "year"), "year") == [(2024,), (2023,)]


def test_slice_reaches_the_scan(rows):
    sliced = serving.time_slice(rows, SPEC, 2024, month=1)
    assert sliced.count() == 5
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(period,2024-01-01)" in plan
    assert "LessThan(period,2024-02-01)" in plan and "Exchange" not in plan
    narrow = serving.by_place(sliced, SPEC.value)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<period:date,state_name:string,consumption_thousand_mwh:double>" in narrow


def test_place_queries(rows):
    month = serving.time_slice(rows, SPEC, 2024, month=1)
    places = serving.by_place(month, SPEC.value)
    assert sorted(listed(places, "state", SPEC.value)) == [("Ohio", 4.0), ("Texas", 12.0), ("U.S.", 60.0)]
    states = serving.states_only(places)
    assert sorted(listed(states, "state_abbrev")) == [("OH",), ("TX",)]
    assert listed(serving.top_places(month, SPEC, SPEC.value, 2), "state") == [("U.S.",), ("Texas",)]
    ranked = serving.ranking(month, SPEC, "no such metric")
    assert sorted(listed(ranked, "position", "state")) == [(1, "U.S."), (2, "Texas"), (3, "Ohio")]
    assert serving.by_place(month, "fuel_type_id") is month


def test_drill_down(rows):
    month = serving.time_slice(rows, SPEC, 2024, month=1)
    seen = serving.snapshot(month, SPEC, "Texas").first().asDict()
    assert seen.pop("consumption_thousand_mwh") == 12.0
    assert seen == {"fuel_type_label": "Coal", "consumption_btu": 3.0, "us_fuel_thousand_mwh": 18.0,
                    "pct_us_fuel_consumption": 3.0}
    trend = serving.trend(rows, SPEC, SPEC.value, place="Ohio")
    assert listed(trend, "period", SPEC.value) == [
        (date(2023, 1, 1), 2.0), (date(2024, 1, 1), 4.0), (date(2024, 2, 1), 1.0)
    ]
    assert serving.trend(rows, SPEC, SPEC.value).count() == 3
    assert listed(serving.breakdown(month, SPEC, "Texas"), "fuel_type_id") == [("NG",), ("COL",)]
    everywhere = serving.breakdown(month, SPEC, n=1)
    assert sorted(listed(everywhere, "state", "fuel_type_id")) == [
        ("Ohio", "COL"), ("Texas", "NG"), ("U.S.", "NG")
    ]


def test_metrics(rows, spark):
    assert serving.metrics(rows, SPEC) == {
        "Consumption": "consumption_thousand_mwh", "Consumption (BTU)": "consumption_btu",
        "US Total by Fuel (Thousand MWh)": "us_fuel_thousand_mwh",
        "% of US Fuel Consumption": "pct_us_fuel_consumption",
    }
    wide = spark.createDataFrame([(2024, "TX", 1.0, 2.0)], "year int, state string, TE double, co_pct double")
    assert serving.metrics(wide, TABLES["seds_fuel_pivot"]) == {
        "Total Energy (All Sources)": "TE", "Coal (% of Total)": "co_pct"
    }


def test_annual_tables_and_place_fallback(spark):
    spec = TABLES["seds_state_consumption"]
    table = spark.createDataFrame(
        [(2024, "TX", None, "CO", 1.0), (2024, "OH", "Ohio", "CO", 2.0), (None, "OH", "Ohio", "CO", 3.0)],
        "year int, state_id string, state_name string, fuel_prefix string, total_btu double",
    )
    rows = serving.prepare(table, spec)
    assert sorted(listed(rows, "state")) == [("Ohio",), ("Texas",)]
    assert serving.time_slice(rows, spec, 2024).count() == 2
    without = serving.prepare(table.drop("state_name"), spec)
    assert sorted(listed(without, "state")) == [("Ohio",), ("Texas",)]


def test_weekly_calendar_and_foreign_duplicates(spark):
    spec = TableSpec("w", "W", "w", "area", "v", "V", "u", "weekly", "Own")
    table = spark.createDataFrame(
        [(date(2024, 12, 30), "R10", 1.0)] * 2, "period date, area string, v double"
    )
    rows = serving.prepare(table, spec)
    assert listed(rows, "year", "week", "state") == [(2025, 1, "PADD 1 (East Coast)")]
    assert serving.time_slice(rows, spec, 2025, week=1).count() == 1
    assert serving.time_slice(rows, spec, 2024).count() == 0


def test_table_without_place_groups_by_its_breakdown(spark):
    spec = TABLES["total_energy"]
    table = spark.createDataFrame(
        [(date(2024, 1, 1), "A", "a", 2.0, "q"), (date(2024, 1, 1), "B", "b", 3.0, "q")],
        "period date, series_code string, series_description string, value_quad_btu double, unit string",
    )
    rows = serving.prepare(table, spec)
    assert serving.dimension(rows, spec) == "series_code"
    assert listed(serving.top_places(rows, spec, None), "series_code") == [("B",), ("A",)]


def test_other_aggregate_for_metrics_that_do_not_add(spark):
    spec = TABLES["electricity_rankings"]
    assert not spec.additive
    table = spark.createDataFrame(
        [(2024, "TX", "Texas", 1), (2025, "TX", "Texas", 4)],
        "year int, state_id string, state_name string, net_generation_rank int",
    )
    rows = serving.prepare(table, spec)
    assert listed(serving.by_place(rows, spec.value, agg=F.avg), spec.value) == [(2.5,)]


def test_a_table_without_breakdown_or_metric_says_so(spark):
    spec = TABLES["seds_fuel_pivot"]
    table = spark.createDataFrame([(2024, "TX", "Texas", 1.0)], "year int, state_id string, state_name string, TE double")
    rows = serving.prepare(table, spec)
    with pytest.raises(ValueError):
        serving.breakdown(rows, spec, "Texas")
    with pytest.raises(ValueError):
        serving.ranking(rows, spec, None)
    assert serving.snapshot(rows, spec, "Texas", "TE").first()["TE"] == 1.0
    assert serving.trend(rows, spec, "TE").collect()[0]["TE"] == 1.0
