"""Result tables on small hand-written cleaned rows."""

from datetime import date

import pytest

from wattframe.plans import tables
from wattframe.plans.tables import ANALYSES, RESULT_TABLES
from wattframe.sources.catalog import TABLES

JAN, FEB = date(2025, 1, 1), date(2025, 2, 1)


def by(frame, *keys):
    rows = [row.asDict() for row in frame.collect()]
    found = {tuple(row[key] for key in keys): row for row in rows}
    assert len(found) == len(rows)
    return found


def test_builders_match_the_catalog():
    assert set(RESULT_TABLES) == set(TABLES) and len(ANALYSES) == 8


def test_gas_production_keeps_rows(spark):
    clean = spark.createDataFrame(
        [(JAN, "STX", "Texas", 30.0), (JAN, "SOH", "Ohio", 10.0), (FEB, "STX", "Texas", 0.0),
         (None, "STX", "Texas", 5.0)],
        "period date, duoarea string, state_name string, production_mmcf double",
    )
    found = by(tables.gas_production(clean), "period", "duoarea")
    assert found[JAN, "STX"]["us_total_mmcf"] == 40 and found[JAN, "STX"]["pct_us_production"] == 75
    assert found[FEB, "STX"]["us_total_mmcf"] == 0 and found[FEB, "STX"]["pct_us_production"] is None
    assert found[None, "STX"]["us_total_mmcf"] is None


def test_gas_trade_wide(spark):
    clean = spark.createDataFrame(
        [(2024, "STX", "Texas", p, "label", v, "MMCF") for p, v in
         [("EEI", 1.0), ("EEI", 2.0), ("IMI", 4.0), ("MID", 5.0), ("MIE", 9.0)]],
        "year int, duoarea string, state_name string, process string, process_label string,"
        " value_mmcf double, units string",
    )
    assert [tuple(r) for r in tables.gas_international(clean).collect()] == [
        (2024, "STX", "Texas", 3.0, 4.0, None)
    ]
    assert [tuple(r) for r in tables.gas_interstate(clean).collect()] == [
        (2024, "STX", "Texas", 5.0, None)
    ]


@pytest.fixture
def crude(spark):
    return spark.createDataFrame(
        [(JAN, "Canada", "C", "Ohio", "OH", "Heavy", 6.0), (JAN, "Iraq", "I", "Ohio", "OH", "Light", 2.0),
         (JAN, "Canada", "C", "Texas", "TX", "Heavy", 8.0), (JAN, "Iraq", "I", None, None, "Light", 4.0)],
        "period date, origin_country string, originId string, refinery_state string,"
        " destinationId string, crude_grade string, quantity_thousand_bbl double",
    )


def test_crude_tables(crude):
    origin = by(tables.crude_by_origin(crude), "refinery_state", "origin_country")
    assert origin["Ohio", "Canada"]["total_thousand_bbl"] == 6 and len(origin) == 4
    state = by(tables.crude_by_state(crude), "refinery_state")
    assert state["Ohio",]["us_total_thousand_bbl"] == 20 and state["Ohio",]["pct_us_imports"] == 40
    assert state[None,]["pct_us_imports"] == 20  # a NULL place is a group of its own
    grade = by(tables.crude_by_grade(crude), "refinery_state", "crude_grade")
    assert grade["Ohio", "Heavy"]["pct_of_state_imports"] == 75
    assert grade[None, "Light"]["state_total_thousand_bbl"] is None  # a NULL key has no total


def test_movements(spark):
    base = ("product", "P", "series", "S", "MBBL/D")
    rows = [
        (JAN, area, name, "EPC0", "Crude", process, "label", *base[2:4], value, base[4])
        for area, name, process, value in [
            ("NUS-Z00", "U.S.", "EEX", 10.0), ("NUS-Z00", "U.S.", "EIM", 4.0),
            ("R10", "PADD 1", "EEX", 2.0), ("R10", "PADD 1", "ENT", 1.0), ("R10", "PADD 1", "STK", 7.0),
        ]
    ]
    clean = spark.createDataFrame(
        rows,
        "period date, duoarea string, area_name string, product_id string, product_name string,"
        " process_id string, process_label string, series_id string, series_description string,"
        " value_kbd double, units string",
    )
    wide = by(tables.movements_wide(clean), "duoarea")
    assert wide["NUS-Z00",]["trade_balance_kbd"] == 6 and wide["R10",]["trade_balance_kbd"] is None
    assert wide["R10",]["net_imports_kbd"] == 1
    share = by(tables.movements_by_area(clean), "duoarea", "process_id")
    assert share["R10", "EEX"]["pct_us"] == 20 and share["NUS-Z00", "EEX"]["pct_us"] == 100
    assert share["R10", "ENT"]["us_total_kbd"] is None and len(share) == 4


@pytest.fixture
def coal(spark):
    return spark.createDataFrame(
        [(2021, "exports", "BIT", "Bituminous", "CA", "Canada", "13", "Baltimore, MD", 10.0, 50.0),
         (2021, "exports", "BIT", "Bituminous", "CA", "Canada", "13", "Baltimore, MD", 30.0, None),
         (2021, "exports", "BIT", "Bituminous", "JP", "Japan", "14", "Norfolk, VA", 60.0, 70.0),
         (2023, "exports", "BIT", "Bituminous", "CA", "Canada", "13", "Baltimore, MD", 20.0, 90.0),
         (2023, "imports", "MET", "Coke", "CA", "Canada", "13", "Baltimore, MD", None, 10.0)],
        "year int, export_import_type string, coal_rank_id string, coal_rank_desc string,"
        " country_id string, country_desc string, customs_district_id string,"
        " customs_district string, quantity_short_tons double, price_usd_per_ton double",
    )


def test_coal_tables(coal):
    summary = by(tables.coal_summary(coal), "year", "export_import_type", "country_id")
    canada = summary[2021, "exports", "CA"]
    assert (canada["total_short_tons"], canada["avg_price_usd_per_ton"]) == (40, 50)
    assert canada["us_avg_price_usd_per_ton"] == 60 and canada["pct_us_direction"] == 40
    assert summary[2023, "imports", "CA"]["total_short_tons"] is None
    country = by(tables.coal_by_country(coal), "year", "export_import_type", "country_id")
    assert country[2021, "exports", "JP"]["pct_us_total"] == 60
    district = by(tables.coal_by_district(coal), "year", "export_import_type", "customs_district_id")
    assert district[2021, "exports", "13"]["num_countries"] == 1
    rank = by(tables.coal_by_rank(coal), "year", "export_import_type")
    assert rank[2021, "exports"]["num_countries"] == 2 and rank[2021, "exports"]["max_price_usd_per_ton"] == 70
    change = by(tables.coal_country_change(coal), "year", "export_import_type", "country_id")
    assert change[2023, "exports", "CA"]["yoy_change_pct"] == -50  # against 2021: previous row
    wide = by(tables.coal_rank_wide(coal), "year", "export_import_type")
    assert wide[2021, "exports"]["BIT"] == 100 and wide[2023, "imports"]["MET"] is None


def test_electricity_tables(spark):
    clean = spark.createDataFrame(
        [(JAN, "Ohio", "COL", "Coal", 30.0, 3.0), (JAN, "Utah", "COL", "Coal", 10.0, None),
         (JAN, "Ohio", "ALL", "All Fuels", 80.0, 1.0), (JAN, "Utah", "ALL", "All Fuels", 20.0, 1.0)],
        "period date, state_name string, fuel_type_id string, fuel_type_label string,"
        " consumption_thousand_mwh double, consumption_btu double",
    )
    fuel = by(tables.electricity_by_fuel(clean), "state_name")
    assert fuel["Ohio",]["pct_us_fuel_consumption"] == 75 and len(fuel) == 2
    total = by(tables.electricity_state_total(clean), "state_name")
    assert total["Utah",]["pct_us_consumption"] == 20


def test_capacity(spark):
    clean = spark.createDataFrame(
        [(2024, "TX", "Texas", "EU", "Utility", "SUN", "Solar", 60.0),
         (2024, "TX", "Texas", "IPP", None, "SUN", "Solar", 20.0),
         (2024, "OH", "Ohio", "EU", "Utility", "SUN", "Solar", 20.0)],
        "year int, state_id string, state_name string, producertypeid string, producer_type string,"
        " energysourceid string, energy_source string, capability_mw double",
    )
    found = by(tables.capacity_by_state(clean), "state_id")
    assert found["TX",]["pct_us_capacity"] == 80 and found["TX",]["num_producer_types"] == 1


@pytest.fixture
def state_energy(spark):
    rows = []
    for year, state, name, series, value in [
        (2021, "TX", "Texas", "TETCB", 100.0), (2021, "TX", "Texas", "COTCB", 25.0),
        (2021, "TX", "Texas", "CORCB", 5.0), (2021, "OH", "Ohio", "TETCB", 100.0),
        (2023, "TX", "Texas", "TETCB", 150.0), (2023, "TX", "Texas", "TETCP", 999.0),
        (2023, "OH", "Ohio", "NGTCB", 7.0),
    ]:
        rows.append((year, state, name, series, "d", series[:2], series[2:4], series[4], value, "u"))
    return spark.createDataFrame(
        rows,
        "year int, state_id string, state_name string, series_code string,"
        " series_description string, fuel_prefix string, sector_code string, unit_type string,"
        " value double, unit string",
    )


def test_state_energy_tables(state_energy):
    shares = by(tables.state_fuel_shares(state_energy), "year", "state_id", "fuel_prefix")
    assert shares[2021, "TX", "CO"]["num_series"] == 2 and shares[2021, "TX", "CO"]["total_btu"] == 30
    assert shares[2021, "TX", "TE"]["pct_us_fuel_consumption"] == 50
    total = by(tables.state_shares(state_energy), "year", "state_id")
    assert set(total) == {(2021, "TX"), (2021, "OH"), (2023, "TX")}
    assert total[2023, "TX"]["yoy_change_pct"] == 50 and total[2023, "TX"]["pct_us_total_consumption"] == 100
    every = by(tables.state_shares_all_fuels(state_energy), "year", "state_id")
    assert every[2021, "TX"]["total_btu"] == 130 and every[2023, "OH"]["yoy_change_btu"] == -93
    mix = tables.state_fuel_mix(state_energy)
    assert mix.columns == ["year", "state_id", "state_name", "CO", "NG", "TE", "co_pct", "ng_pct"]
    mix = by(mix, "year", "state_id")
    assert mix[2021, "TX"]["co_pct"] == 30 and mix[2023, "OH"]["ng_pct"] is None
