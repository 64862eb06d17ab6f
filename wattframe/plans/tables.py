"""Result tables from cleaned rows: shares of totals, wide tables, price statistics, changes.

Each function takes the cleaned rows of one source and returns an unsorted table; the catalog
holds the sort order for the sink. Measures that arrive as decimals are summed exactly and leave
as doubles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.functions import fixed_values as fixed
from wattframe.functions.measures import ratio
from wattframe.operators.changes import change_from_previous
from wattframe.operators.pivots import pivot_discovered, pivot_named, pivot_share
from wattframe.operators.rows import doubles
from wattframe.operators.shares import group_share, row_share
from wattframe.session import keep


# ---------------------------------------------------------------- natural gas


def gas_production(clean: DataFrame) -> DataFrame:
    """Each production row with the month's total and its share."""
    return doubles(
        row_share(
            clean, "production_mmcf", ["period"], total="us_total_mmcf", share="pct_us_production"
        ).select(
            "period", "duoarea", "state_name", "production_mmcf", "us_total_mmcf",
            "pct_us_production",
        )
    )


def _gas_wide(clean: DataFrame, columns: dict[str, str]) -> DataFrame:
    keys = ["year", "duoarea", "state_name"]
    return doubles(pivot_named(clean, keys, "process", "value_mmcf", columns))


def gas_international(clean: DataFrame) -> DataFrame:
    """Exports, imports and net movement per year and state."""
    return _gas_wide(clean, fixed.INTERNATIONAL_PROCESSES)


def gas_interstate(clean: DataFrame) -> DataFrame:
    """Deliveries and net receipts between states per year and state."""
    return _gas_wide(clean, fixed.INTERSTATE_PROCESSES)


# ---------------------------------------------------------------- crude oil


def _crude_groups(clean: DataFrame, keys: list[str], total: str) -> DataFrame:
    return clean.groupBy(*keys).agg(F.sum("quantity_thousand_bbl").alias(total))


def crude_by_origin(clean: DataFrame) -> DataFrame:
    """Imports per month, refinery state and country."""
    keys = ["period", "refinery_state", "origin_country"]
    return doubles(_crude_groups(clean, keys, "total_thousand_bbl"))


def crude_by_state(clean: DataFrame) -> DataFrame:
    """Imports per month and refinery state with the share of the month."""
    groups = _crude_groups(clean, ["period", "refinery_state"], "total_thousand_bbl")
    return doubles(
        group_share(
            groups, "total_thousand_bbl", ["period"],
            total="us_total_thousand_bbl", share="pct_us_imports",
        )
    )


def crude_by_grade(clean: DataFrame) -> DataFrame:
    """Imports per month, state and grade with the grade's share of the state's month."""
    groups = _crude_groups(
        clean, ["period", "refinery_state", "crude_grade"], "grade_quantity_thousand_bbl"
    )
    return doubles(
        group_share(
            groups, "grade_quantity_thousand_bbl", ["period", "refinery_state"],
            total="state_total_thousand_bbl", share="pct_of_state_imports",
        )
    )


# ---------------------------------------------------------------- petroleum

_MOVEMENT_KEYS = ["period", "duoarea", "area_name", "product_id", "product_name"]


def petroleum_rows(clean: DataFrame) -> DataFrame:
    """Weekly production rows as cleaned."""
    return doubles(clean)


def movement_rows(clean: DataFrame) -> DataFrame:
    """Weekly movement rows as cleaned."""
    return doubles(clean)


def movements_wide(clean: DataFrame) -> DataFrame:
    """Exports, imports and net imports per week, area and product, with the trade balance."""
    wide = pivot_named(clean, _MOVEMENT_KEYS, "process_id", "value_kbd", fixed.MOVEMENT_COLUMNS)
    return doubles(
        wide.withColumn("trade_balance_kbd", F.col("exports_kbd") - F.col("imports_kbd"))
    )


def movements_by_area(clean: DataFrame) -> DataFrame:
    """Area volumes with their share of the *published* national row, not of a sum over areas."""
    groups = (
        clean.where(F.col("process_id").isin(list(fixed.MOVEMENT_COLUMNS)))
        .groupBy(*_MOVEMENT_KEYS, "process_id")
        .agg(F.sum("value_kbd").alias("total_kbd"))
    )
    published = F.col("duoarea") == fixed.US_PUBLISHED_AREA
    return doubles(
        group_share(
            groups, "total_kbd", ["period", "process_id", "product_id"],
            total="us_total_kbd", share="pct_us", member=published,
        )
    )


# ---------------------------------------------------------------- coal

_COAL_TOTAL_KEYS = ["year", "export_import_type", "coal_rank_id"]


def coal_rows(clean: DataFrame) -> DataFrame:
    """Annual trade rows as cleaned."""
    return doubles(clean)


def _coal_share(clean: DataFrame, keys: list[str], share: str, aggregates: dict) -> DataFrame:
    """Grouped coal trade with the total and mean price of its direction and rank.

    Sum and count of the price travel with the groups, so that the national mean comes from the
    groups and not from a second pass over the rows. Groups with further aggregates are kept:
    pruned to what the totals need, their plan would differ and scan the rows again.
    """
    groups = clean.groupBy(*_COAL_TOTAL_KEYS, *keys).agg(
        F.sum("quantity_short_tons").alias("total_short_tons"),
        F.sum("price_usd_per_ton").alias("_price_sum"),
        F.count("price_usd_per_ton").alias("_price_count"),
        *[column.alias(name) for name, column in aggregates.items()],
    )
    if aggregates:
        groups = keep(groups)
    us_mean = ratio(F.sum("_price_sum"), F.sum("_price_count"))
    shared = group_share(
        groups, "total_short_tons", _COAL_TOTAL_KEYS, total="us_total_short_tons", share=share,
        more_totals={"us_avg_price_usd_per_ton": us_mean},
    )
    return doubles(
        shared.select(
            *_COAL_TOTAL_KEYS, *keys, "total_short_tons",
            ratio("_price_sum", "_price_count").alias("avg_price_usd_per_ton"),
            *aggregates, "us_total_short_tons", "us_avg_price_usd_per_ton", share,
        )
    )


def coal_summary(clean: DataFrame) -> DataFrame:
    """Trade and price range per country and customs district with the share of its direction."""
    return _coal_share(
        clean,
        ["coal_rank_desc", "country_id", "country_desc", "customs_district_id", "customs_district"],
        "pct_us_direction",
        {
            "min_price_usd_per_ton": F.min("price_usd_per_ton"),
            "max_price_usd_per_ton": F.max("price_usd_per_ton"),
        },
    )


def coal_by_country(clean: DataFrame) -> DataFrame:
    """Trade and mean price per country with its share."""
    return _coal_share(clean, ["coal_rank_desc", "country_id", "country_desc"], "pct_us_total", {})


def coal_by_district(clean: DataFrame) -> DataFrame:
    """Trade, mean price and number of countries per customs district with its share."""
    return _coal_share(
        clean, ["coal_rank_desc", "customs_district_id", "customs_district"], "pct_us_total",
        {"num_countries": F.countDistinct("country_id")},
    )


def coal_by_rank(clean: DataFrame) -> DataFrame:
    """Trade, price range and number of countries and districts per direction and rank.

    Two distinct counts multiply the rows they see, so the rows are first summed per country and
    district.
    """
    keys = [*_COAL_TOTAL_KEYS, "coal_rank_desc"]
    by_route = clean.groupBy(*keys, "country_id", "customs_district_id").agg(
        F.sum("quantity_short_tons").alias("_tons"),
        F.sum("price_usd_per_ton").alias("_price_sum"),
        F.count("price_usd_per_ton").alias("_price_count"),
        F.min("price_usd_per_ton").alias("_price_min"),
        F.max("price_usd_per_ton").alias("_price_max"),
    )
    return doubles(
        by_route.groupBy(*keys).agg(
            F.sum("_tons").alias("total_short_tons"),
            ratio(F.sum("_price_sum"), F.sum("_price_count")).alias("avg_price_usd_per_ton"),
            F.min("_price_min").alias("min_price_usd_per_ton"),
            F.max("_price_max").alias("max_price_usd_per_ton"),
            F.countDistinct("country_id").alias("num_countries"),
            F.countDistinct("customs_district_id").alias("num_districts"),
        )
    )


def coal_country_change(clean: DataFrame) -> DataFrame:
    """:func:`coal_by_country` with the change against the country's previous year."""
    return change_from_previous(
        coal_by_country(clean), ["export_import_type", "coal_rank_id", "country_id"], "year",
        "total_short_tons", change="yoy_change_short_tons", change_pct="yoy_change_pct",
        ties=("coal_rank_desc", "country_desc"),
    )


def coal_rank_wide(clean: DataFrame, ranks: list[str] | None = None) -> DataFrame:
    """Quantity per year and direction, one column per coal rank found."""
    keys = ["year", "export_import_type"]
    groups = clean.groupBy(*keys, "coal_rank_id").agg(
        F.sum("quantity_short_tons").alias("_tons")
    )
    if ranks is None:  # one pass over the rows, then both the codes and the pivot from the groups
        groups = keep(groups)
    return doubles(pivot_discovered(groups, keys, "coal_rank_id", "_tons", ranks))


# ---------------------------------------------------------------- electricity


def electricity_by_fuel(clean: DataFrame) -> DataFrame:
    """Rows of single fuels with the month's national total of the fuel and the share."""
    fuels = clean.where(F.col("fuel_type_id") != fixed.ALL_FUELS)
    return doubles(
        row_share(
            fuels, "consumption_thousand_mwh", ["period", "fuel_type_id"],
            total="us_fuel_thousand_mwh", share="pct_us_fuel_consumption",
        ).select(
            "period", "state_name", "fuel_type_id", "fuel_type_label", "consumption_thousand_mwh",
            "consumption_btu", "us_fuel_thousand_mwh", "pct_us_fuel_consumption",
        )
    )


def electricity_state_total(clean: DataFrame) -> DataFrame:
    """All-fuels consumption per month and state with the share of the month."""
    groups = (
        clean.where(F.col("fuel_type_id") == fixed.ALL_FUELS)
        .groupBy("period", "state_name")
        .agg(F.sum("consumption_thousand_mwh").alias("state_total_thousand_mwh"))
    )
    return doubles(
        group_share(
            groups, "state_total_thousand_mwh", ["period"],
            total="us_total_thousand_mwh", share="pct_us_consumption",
        )
    )


def ranking_rows(clean: DataFrame) -> DataFrame:
    """State ranks as cleaned."""
    return clean


def net_metering_rows(clean: DataFrame) -> DataFrame:
    """Net metering as cleaned."""
    return doubles(clean)


def capacity_by_state(clean: DataFrame) -> DataFrame:
    """Capacity per year, state and source with its share and the number of producer types.

    Grouping by producer type first makes the distinct count a plain count over few rows, and lets
    the totals share that first exchange.
    """
    keys = ["year", "state_id", "state_name", "energy_source"]
    by_type = clean.groupBy(*keys, "producer_type").agg(F.sum("capability_mw").alias("_mw"))
    groups = by_type.groupBy(*keys).agg(
        F.sum("_mw").alias("state_total_mw"), F.count("producer_type").alias("num_producer_types")
    )
    return doubles(
        group_share(
            groups, "state_total_mw", ["year", "energy_source"],
            total="us_total_mw", share="pct_us_capacity",
        ).select(*keys, "state_total_mw", "us_total_mw", "pct_us_capacity", "num_producer_types")
    )


# ---------------------------------------------------------------- total and state energy


def total_energy_rows(clean: DataFrame) -> DataFrame:
    """Monthly series as cleaned."""
    return doubles(clean)


_STATE_KEYS = ["year", "state_id", "state_name"]


def _state_fuel(clean: DataFrame) -> DataFrame:
    """Btu per year, state and fuel with the number of series behind it."""
    by_series = (
        clean.where(F.col("unit_type") == fixed.BTU_UNIT)
        .groupBy(*_STATE_KEYS, "fuel_prefix", "series_code")
        .agg(F.sum("value").alias("_btu"))
    )
    return by_series.groupBy(*_STATE_KEYS, "fuel_prefix").agg(
        F.sum("_btu").alias("total_btu"), F.count("series_code").alias("num_series")
    )


def state_fuel_shares(clean: DataFrame) -> DataFrame:
    """Btu per state and fuel with the share of the fuel's national total."""
    return doubles(
        group_share(
            _state_fuel(clean), "total_btu", ["year", "fuel_prefix"],
            total="us_total_btu", share="pct_us_fuel_consumption",
        ).select(
            *_STATE_KEYS, "fuel_prefix", "total_btu", "us_total_btu", "pct_us_fuel_consumption",
            "num_series",
        )
    )


def _state_btu(clean: DataFrame) -> DataFrame:
    return (
        clean.where(F.col("unit_type") == fixed.BTU_UNIT)
        .groupBy(*_STATE_KEYS)
        .agg(F.sum("value").alias("total_btu"))
    )


def _state_shares(groups: DataFrame, share: str) -> DataFrame:
    shared = group_share(groups, "total_btu", ["year"], total="us_all_btu", share=share)
    changed = change_from_previous(
        shared, ["state_id"], "year", "total_btu",
        change="yoy_change_btu", change_pct="yoy_change_pct", ties=("state_name",),
    )
    return doubles(
        changed.select(
            *_STATE_KEYS, "total_btu", "us_all_btu", share, "yoy_change_btu", "yoy_change_pct"
        )
    )


def state_shares(clean: DataFrame) -> DataFrame:
    """All-source Btu per year and state with share and change, from the published TE series."""
    all_sources = clean.where(F.col("fuel_prefix") == fixed.TOTAL_ENERGY_PREFIX)
    return _state_shares(_state_btu(all_sources), "pct_us_total_consumption")


def state_shares_all_fuels(clean: DataFrame) -> DataFrame:
    """Like :func:`state_shares`, but summed over every fuel prefix."""
    return _state_shares(_state_btu(clean), "pct_us_total")


def state_fuel_mix(clean: DataFrame, fuels: list[str] | None = None) -> DataFrame:
    """One row per year and state, one column per fuel found, and each fuel's percent of TE."""
    groups = (
        clean.where(F.col("unit_type") == fixed.BTU_UNIT)
        .groupBy(*_STATE_KEYS, "fuel_prefix")
        .agg(F.sum("value").alias("total_btu"))
    )
    if fuels is None:
        groups = keep(groups)
    return doubles(
        pivot_share(
            groups, _STATE_KEYS, "fuel_prefix", "total_btu", fixed.TOTAL_ENERGY_PREFIX, codes=fuels
        )
    )


# Table of the catalog -> (source, builder).
RESULT_TABLES: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "ng_production": ("natural_gas", gas_production),
    "ng_intl_trade": ("natural_gas_trade", gas_international),
    "ng_interstate": ("natural_gas_trade", gas_interstate),
    "crude_by_origin": ("crude_oil_imports", crude_by_origin),
    "crude_by_state": ("crude_oil_imports", crude_by_state),
    "crude_grade": ("crude_oil_imports", crude_by_grade),
    "petroleum_production": ("petroleum", petroleum_rows),
    "petroleum_movements": ("petroleum_movements", movement_rows),
    "petroleum_movements_wide": ("petroleum_movements", movements_wide),
    "coal_trade": ("coal", coal_rows),
    "coal_trade_summary": ("coal", coal_summary),
    "electricity_by_fuel": ("electricity", electricity_by_fuel),
    "electricity_rankings": ("electricity_state_rankings", ranking_rows),
    "electricity_net_metering": ("electricity_net_metering", net_metering_rows),
    "electricity_capacity": ("electricity_generating_capacity", capacity_by_state),
    "total_energy": ("total_energy", total_energy_rows),
    "seds_state_consumption": ("seds", state_fuel_shares),
    "seds_state_pct_us": ("seds", state_shares),
    "seds_fuel_pivot": ("seds", state_fuel_mix),
}

# Further analyses, not part of the written set.
ANALYSES: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "coal_by_country": ("coal", coal_by_country),
    "coal_by_district": ("coal", coal_by_district),
    "coal_by_rank": ("coal", coal_by_rank),
    "coal_country_yoy": ("coal", coal_country_change),
    "coal_rank_pivot": ("coal", coal_rank_wide),
    "elec_state_total": ("electricity", electricity_state_total),
    "petro_by_area": ("petroleum_movements", movements_by_area),
    "seds_state_all_fuels": ("seds", state_shares_all_fuels),
}
