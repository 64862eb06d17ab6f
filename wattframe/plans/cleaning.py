"""Raw text rows -> typed, distinct rows, one step per source.

Every step types by try-casts, keeps a row by its *typed* measure (so a header repeated inside a
file or a malformed number falls out), and ends in a whole-row dedup. Nothing sorts here: sorting
belongs to the sink. ``measure`` is the type of the measures: double, or a decimal type where sums
have to be bit-stable. Rows that come with the time and file of their delivery keep both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.functions import fixed_values as fixed
from wattframe.functions.labels import lookup
from wattframe.functions.parsing import (
    code_part,
    day,
    month_start,
    number,
    trimmed,
    whole,
    year_number,
)
from wattframe.operators.rows import any_present, delivery, distinct_rows


def natural_gas(raw: DataFrame, measure: str = "double") -> DataFrame:
    """Monthly marketed production of state areas."""
    kept = raw.where(F.col("duoarea").startswith("S") & (F.col("process") == fixed.MARKETED_PRODUCTION))
    typed = kept.select(
        *delivery(raw),
        month_start("period").alias("period"),
        "duoarea",
        F.col("area-name").alias("state_name"),
        number("value", measure).alias("production_mmcf"),
    )
    return distinct_rows(typed.where(any_present("production_mmcf")))


def natural_gas_trade(raw: DataFrame, measure: str = "double") -> DataFrame:
    """Annual natural-gas movements of state areas with process labels."""
    kept = raw.where(
        F.col("duoarea").rlike(fixed.STATE_AREA_PATTERN)
        & F.col("process").isin(list(fixed.GAS_TRADE_PROCESSES))
    )
    typed = kept.select(
        *delivery(raw),
        year_number("period").alias("year"),
        "duoarea",
        F.col("area-name").alias("state_name"),
        "process",
        lookup(fixed.GAS_TRADE_PROCESSES, F.col("process")).alias("process_label"),
        number("value", measure).alias("value_mmcf"),
        "units",
    )
    return distinct_rows(typed.where(any_present("value_mmcf")))


def crude_oil_imports(raw: DataFrame, measure: str = "double") -> DataFrame:
    """Monthly imports; of the levels at which an import repeats, country to refinery state."""
    kept = raw.where(
        (F.col("destinationTypeName") == fixed.IMPORT_DESTINATION)
        & (F.col("originType") == fixed.IMPORT_ORIGIN)
    )
    typed = kept.select(
        *delivery(raw),
        month_start("period").alias("period"),
        F.col("originName").alias("origin_country"),
        "originId",
        F.col("destinationName").alias("refinery_state"),
        "destinationId",
        F.col("gradeName").alias("crude_grade"),
        number("quantity", measure).alias("quantity_thousand_bbl"),
    )
    return distinct_rows(typed.where(any_present("quantity_thousand_bbl")))


def _weekly_petroleum(raw: DataFrame, process, measure: str) -> DataFrame:
    typed = raw.select(
        *delivery(raw),
        day("period").alias("period"),
        "duoarea",
        trimmed("area-name").alias("area_name"),
        F.col("product").alias("product_id"),
        trimmed("product-name").alias("product_name"),
        F.col("process").alias("process_id"),
        process,
        F.col("series").alias("series_id"),
        trimmed("series-description").alias("series_description"),
        number("value", measure).alias("value_kbd"),
        "units",
    )
    return distinct_rows(typed.where(any_present("value_kbd")))


def petroleum(raw: DataFrame, measure: str = "double") -> DataFrame:
    """Weekly petroleum production."""
    return _weekly_petroleum(raw, trimmed("process-name").alias("process_name"), measure)


def petroleum_movements(raw: DataFrame, measure: str = "double") -> DataFrame:
    """Weekly petroleum movements; unknown processes keep their own name as label."""
    label = lookup(fixed.PETROLEUM_MOVEMENTS, F.col("process"), trimmed("process-name"))
    return _weekly_petroleum(raw, label.alias("process_label"), measure)


def coal(raw: DataFrame, measure: str = "double") -> DataFrame:
    """Annual coal trade without the all-countries member; quantity or price must be there."""
    typed = raw.select(
        *delivery(raw),
        year_number("period").alias("year"),
        trimmed("exportImportType").alias("export_import_type"),
        trimmed("coalRankId").alias("coal_rank_id"),
        trimmed("coalRankDescription").alias("coal_rank_desc"),
        trimmed("countryId").alias("country_id"),
        trimmed("countryDescription").alias("country_desc"),
        trimmed("customsDistrictId").alias("customs_district_id"),
        trimmed("customsDistrictDescription").alias("customs_district"),
        number("quantity", measure).alias("quantity_short_tons"),
        number("price", measure).alias("price_usd_per_ton"),
    )
    return distinct_rows(
        typed.where(
            any_present("quantity_short_tons", "price_usd_per_ton")
            & (F.col("country_id") != fixed.ALL_COUNTRIES)
        )
    )


def electricity(raw: DataFrame, measure: str = "double") -> DataFrame:
    """Monthly consumption for generation by known fuel, the all-fuels member included."""
    fuel = F.col("fueltypeid")
    typed = raw.where(fuel.isin(list(fixed.ELECTRICITY_FUELS))).select(
        *delivery(raw),
        month_start("period").alias("period"),
        trimmed("stateDescription").alias("state_name"),
        fuel.alias("fuel_type_id"),
        lookup(fixed.ELECTRICITY_FUELS, fuel, fuel).alias("fuel_type_label"),
        number("consumption-for-eg", measure).alias("consumption_thousand_mwh"),
        number("consumption-for-eg-btu", measure).alias("consumption_btu"),
    )
    return distinct_rows(typed.where(any_present("consumption_thousand_mwh", "consumption_btu")))


def electricity_state_rankings(raw: DataFrame, measure: str = "double") -> DataFrame:
    """Annual state ranks; at least one rank must be there. Ranks are int whatever ``measure``.

    Some extracts hold three more ranks: they are kept where they are.
    """
    more = [name for name in fixed.MORE_RANKING_COLUMNS if name in raw.columns]
    ranks = {name: name.replace("-", "_") for name in (*fixed.RANKING_COLUMNS, *more)}
    typed = raw.select(
        *delivery(raw),
        year_number("period").alias("year"),
        trimmed("stateID").alias("state_id"),
        trimmed("stateDescription").alias("state_name"),
        *[whole(source).alias(name) for source, name in ranks.items()],
    )
    return distinct_rows(typed.where(any_present(*ranks.values())))


def electricity_net_metering(raw: DataFrame, measure: str = "double") -> DataFrame:
    """Annual net metering by state and sector; capacity or customers must be there."""
    typed = raw.select(
        *delivery(raw),
        year_number("period").alias("year"),
        trimmed("state").alias("state_id"),
        trimmed("stateName").alias("state_name"),
        "sector",
        "sectorName",
        number("capacity", measure).alias("capacity_mw"),
        whole("customers").alias("customers_count"),
    )
    return distinct_rows(
        typed.where(
            any_present("capacity_mw", "customers_count")
            & F.col("state_id").rlike(fixed.STATE_ID_PATTERN)
        )
    )


def electricity_generating_capacity(raw: DataFrame, measure: str = "double") -> DataFrame:
    """Annual capability by state, producer type and energy source."""
    typed = raw.select(
        *delivery(raw),
        year_number("period").alias("year"),
        trimmed("stateID").alias("state_id"),
        trimmed("stateDescription").alias("state_name"),
        "producertypeid",
        F.col("producerTypeDescription").alias("producer_type"),
        "energysourceid",
        F.col("energySourceDescription").alias("energy_source"),
        number("capability", measure).alias("capability_mw"),
    )
    return distinct_rows(
        typed.where(
            any_present("capability_mw") & F.col("state_id").rlike(fixed.STATE_ID_PATTERN)
        )
    )


def total_energy(raw: DataFrame, measure: str = "double") -> DataFrame:
    """Monthly total-energy series."""
    typed = raw.select(
        *delivery(raw),
        month_start("period").alias("period"),
        F.col("msn").alias("series_code"),
        trimmed("seriesDescription").alias("series_description"),
        number("value", measure).alias("value_quad_btu"),
        "unit",
    )
    return distinct_rows(typed.where(any_present("value_quad_btu")))


def seds(raw: DataFrame, measure: str = "double") -> DataFrame:
    """Annual state series; the series code is split into fuel, sector and unit type."""
    state = F.col("stateId")
    kept = raw.where(state.rlike(fixed.STATE_ID_PATTERN) & (state != fixed.NATION_STATE_ID))
    typed = kept.select(
        *delivery(raw),
        year_number("period").alias("year"),
        state.alias("state_id"),
        trimmed("stateDescription").alias("state_name"),
        F.col("seriesId").alias("series_code"),
        trimmed("seriesDescription").alias("series_description"),
        code_part("seriesId", 1, 2).alias("fuel_prefix"),
        code_part("seriesId", 3, 2).alias("sector_code"),
        code_part("seriesId", 5, 1).alias("unit_type"),
        number("value", measure).alias("value"),
        "unit",
    )
    return distinct_rows(typed.where(any_present("value")))


# Source name -> cleaning step. Two sources of the catalog have raw data only.
CLEANING: dict[str, Callable[..., DataFrame]] = {
    step.__name__: step
    for step in (
        natural_gas,
        natural_gas_trade,
        crude_oil_imports,
        petroleum,
        petroleum_movements,
        coal,
        electricity,
        electricity_state_rankings,
        electricity_net_metering,
        electricity_generating_capacity,
        total_energy,
        seds,
    )
}
