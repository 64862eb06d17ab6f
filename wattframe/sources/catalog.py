"""Catalog of the raw sources and of the result tables.

Adding an entry makes a source readable and a table queryable; the operators take everything they
need from here. The names, codes, units and labels in the entries are fixed values: users and
existing files know the data under them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from wattframe.functions.calendar import ANNUAL, MONTHLY, WEEKLY


@dataclass(frozen=True)
class SourceSpec:
    """A raw source: what is measured, how often, and how far an incremental load steps back."""

    name: str
    label: str
    grain: str
    measures: tuple[str, ...]
    start: str | None
    step: str

    @property
    def raw_prefix(self) -> str:
        return f"raw/{self.name}/{self.grain}"


@dataclass(frozen=True)
class TableSpec:
    """A result table: where it is kept and how it is sliced, summed and broken down.

    ``extras`` maps further columns to their labels. ``columns_are_codes`` says that a wide table's
    columns are codes with a suffix, which their labels spell out. ``unique_rows`` says that the writer
    guarantees distinct rows, as the tables of this engine do, so that reading needs no shuffle to
    drop duplicates. ``additive`` is False where sums of the value have no meaning (ranks).
    """

    name: str
    label: str
    path: str
    place: str | None
    value: str | None
    value_label: str | None
    unit: str
    grain: str
    category: str
    extras: dict[str, str] = field(default_factory=dict)
    breakdown: str | None = None
    breakdown_value: str | None = None
    on_map: bool = True
    additive: bool = True
    unique_rows: bool = False
    sort: tuple[str, ...] = ()
    columns_are_codes: bool = False

    @property
    def described_metrics(self) -> dict[str, str]:
        """Column -> label of the value and the extras, without what lacks a label."""
        value = {self.value: self.value_label} if self.value and self.value_label else {}
        return value | {name: label for name, label in self.extras.items() if name not in value}

    @property
    def time(self) -> str:
        return "year" if self.grain == ANNUAL else "period"


def _by_name(specs):
    return {spec.name: spec for spec in specs}


# The raw sources.
SOURCES: dict[str, SourceSpec] = _by_name(
    [
        SourceSpec("petroleum", "Petroleum Production", WEEKLY, ("value",), "2025-01-01", "1 month"),
        SourceSpec(
            "petroleum_movements", "Petroleum Imports / Exports & Movements", WEEKLY,
            ("value",), "2025-01-01", "1 month",
        ),
        SourceSpec(
            "natural_gas", "Natural Gas Monthly Production", MONTHLY,
            ("value",), "2025-01", "2 months",
        ),
        SourceSpec(
            "natural_gas_trade", "Natural Gas Import / Export by State", ANNUAL,
            ("value",), "2024", "1 year",
        ),
        SourceSpec(
            "crude_oil_imports", "Crude Oil Imports", MONTHLY, ("quantity",), "2025-01", "2 months"
        ),
        SourceSpec(
            "coal", "Coal Import / Export", ANNUAL, ("price", "quantity"), "2024", "1 year"
        ),
        SourceSpec(
            "electricity", "Electricity Operations", MONTHLY,
            ("consumption-for-eg", "consumption-for-eg-btu"), "2025-01", "2 months",
        ),
        SourceSpec(
            "electricity_state_rankings", "State Electricity Rankings", ANNUAL,
            (
                "average-retail-price-rank", "carbon-dioxide-rank", "direct-use-rank",
                "fsp-sales-rank", "generation-elect-utils-rank", "net-generation-rank",
                "nitrogen-oxide-rank", "sulfer-dioxide-rank",
            ),
            None, "1 year",
        ),
        SourceSpec(
            "electricity_net_metering", "State Electricity Net Metering", ANNUAL,
            ("capacity", "customers"), "2024", "1 year",
        ),
        SourceSpec(
            "electricity_generating_capacity", "State Electricity Generating Capacity", ANNUAL,
            ("capability",), "2024", "1 year",
        ),
        SourceSpec("total_energy", "Total Energy", MONTHLY, ("value",), "2025-01", "2 months"),
        SourceSpec("seds", "State Energy Data System", ANNUAL, ("value",), "2024", "1 year"),
        SourceSpec(
            "densified_biomass", "Densified Biomass Export Prices & Quantity", MONTHLY,
            ("average-price", "quantity"), "2025-01", "2 months",
        ),
        SourceSpec("steo", "Short Term Energy Outlook", MONTHLY, ("value",), "2025-01", "2 months"),
    ]
)


def _written(**entry) -> TableSpec:
    """A table that this engine writes: its rows are distinct by construction."""
    return TableSpec(unique_rows=True, **entry)


# The result tables.
TABLES: dict[str, TableSpec] = _by_name(
    [
        _written(
            name="ng_production", label="Natural Gas — State Production",
            path="natural_gas_production", place="state_name", value="production_mmcf",
            value_label="Production", unit="MMcf", grain=MONTHLY, category="Natural Gas",
            extras={
                "us_total_mmcf": "US Total (MMcf)",
                "pct_us_production": "% of US Production",
            },
            sort=("period", "-production_mmcf"),
        ),
        _written(
            name="ng_intl_trade", label="Natural Gas — International Trade",
            path="natural_gas_trade_international", place="state_name", value="exports_mmcf",
            value_label="Exports", unit="MMcf", grain=ANNUAL, category="Natural Gas",
            extras={
                "imports_mmcf": "Imports (MMcf)",
                "net_intl_mmcf": "Net Intl Movement (MMcf)",
            },
            sort=("year", "state_name"),
        ),
        _written(
            name="ng_interstate", label="Natural Gas — Interstate Movements",
            path="natural_gas_trade_interstate", place="state_name",
            value="interstate_delivered_mmcf", value_label="Delivered", unit="MMcf", grain=ANNUAL,
            category="Natural Gas",
            extras={"net_interstate_received_mmcf": "Net Interstate Received (MMcf)"},
            sort=("year", "state_name"),
        ),
        _written(
            name="crude_by_state", label="Crude Oil — Imports by State",
            path="crude_oil_imports_by_state", place="refinery_state", value="total_thousand_bbl",
            value_label="Imports", unit="Thousand Bbl", grain=MONTHLY, category="Crude Oil",
            extras={
                "us_total_thousand_bbl": "US Total (Thousand Bbl)",
                "pct_us_imports": "% of US Imports",
            },
            sort=("period", "-total_thousand_bbl"),
        ),
        _written(
            name="crude_by_origin", label="Crude Oil — Imports by Origin Country",
            path="crude_oil_imports_by_state_country", place="refinery_state",
            value="total_thousand_bbl", value_label="Imports", unit="Thousand Bbl", grain=MONTHLY,
            category="Crude Oil", breakdown="origin_country", breakdown_value="total_thousand_bbl",
            sort=("period", "refinery_state", "-total_thousand_bbl"),
        ),
        _written(
            name="crude_grade", label="Crude Oil — Grade Breakdown",
            path="crude_oil_imports_grade_breakdown", place="refinery_state",
            value="state_total_thousand_bbl", value_label="Total Imports", unit="Thousand Bbl",
            grain=MONTHLY, category="Crude Oil", breakdown="crude_grade",
            breakdown_value="grade_quantity_thousand_bbl",
            sort=("period", "refinery_state", "-grade_quantity_thousand_bbl"),
        ),
        _written(
            name="petroleum_production", label="Petroleum — Production by Area & Product",
            path="petroleum_production", place="area_name", value="value_kbd",
            value_label="Production", unit="MBBL/D", grain=WEEKLY, category="Petroleum",
            extras={
                "product_name": "Product",
                "process_name": "Process",
                "series_description": "Series Description",
            },
            breakdown="product_id", breakdown_value="value_kbd", on_map=False,
            sort=("period", "duoarea", "product_id"),
        ),
        _written(
            name="petroleum_movements", label="Petroleum — Movements (Imports / Exports)",
            path="petroleum_movements", place="area_name", value="value_kbd",
            value_label="Volume", unit="MBBL/D", grain=WEEKLY, category="Petroleum",
            extras={
                "product_name": "Product",
                "process_label": "Movement Type",
                "series_description": "Series Description",
            },
            breakdown="process_id", breakdown_value="value_kbd", on_map=False,
            sort=("period", "duoarea", "product_id"),
        ),
        _written(
            name="petroleum_movements_wide", label="Petroleum — Imports vs Exports (Wide)",
            path="petroleum_movements_wide", place="area_name", value="exports_kbd",
            value_label="Exports", unit="MBBL/D", grain=WEEKLY, category="Petroleum",
            extras={
                "imports_kbd": "Imports (MBBL/D)",
                "net_imports_kbd": "Net Imports (MBBL/D)",
                "trade_balance_kbd": "Trade Balance (MBBL/D)",
            },
            breakdown="product_id", breakdown_value="exports_kbd", on_map=False,
            sort=("period", "duoarea", "product_id"),
        ),
        _written(
            name="coal_trade", label="Coal — Raw Trade (by Country & District)",
            path="coal_trade", place="customs_district", value="quantity_short_tons",
            value_label="Quantity", unit="Short Tons", grain=ANNUAL, category="Coal",
            extras={
                "price_usd_per_ton": "Price (USD/Ton)",
                "coal_rank_desc": "Coal Rank",
                "export_import_type": "Direction",
            },
            breakdown="country_desc", breakdown_value="quantity_short_tons", on_map=False,
            sort=("year", "export_import_type", "country_id"),
        ),
        _written(
            name="coal_trade_summary", label="Coal — Trade Summary w/ % of US",
            path="coal_trade_summary", place="customs_district", value="total_short_tons",
            value_label="Total Quantity", unit="Short Tons", grain=ANNUAL, category="Coal",
            extras={
                "avg_price_usd_per_ton": "Avg Price (USD/Ton)",
                "min_price_usd_per_ton": "Min Price (USD/Ton)",
                "max_price_usd_per_ton": "Max Price (USD/Ton)",
                "us_total_short_tons": "US Total (Short Tons)",
                "us_avg_price_usd_per_ton": "US Avg Price (USD/Ton)",
                "pct_us_direction": "% of US Direction",
            },
            breakdown="country_desc", breakdown_value="total_short_tons", on_map=False,
            sort=("year", "export_import_type", "-total_short_tons"),
        ),
        _written(
            name="electricity_by_fuel", label="Electricity — Consumption by Fuel & State",
            path="electricity_by_fuel_state", place="state_name",
            value="consumption_thousand_mwh", value_label="Consumption", unit="Thousand MWh",
            grain=MONTHLY, category="Electricity",
            extras={
                "fuel_type_label": "Fuel Type",
                "consumption_btu": "Consumption (BTU)",
                "us_fuel_thousand_mwh": "US Total by Fuel (Thousand MWh)",
                "pct_us_fuel_consumption": "% of US Fuel Consumption",
            },
            breakdown="fuel_type_id", breakdown_value="consumption_thousand_mwh",
            sort=("period", "state_name", "fuel_type_id"),
        ),
        _written(
            name="electricity_rankings", label="Electricity — State Rankings",
            path="electricity_state_rankings", place="state_name", value="net_generation_rank",
            value_label="Net Generation Rank", unit="Rank", grain=ANNUAL, category="Electricity",
            extras={
                "average_retail_price_rank": "Avg Retail Price Rank",
                "carbon_dioxide_rank": "CO2 Rank",
                "direct_use_rank": "Direct Use Rank",
                "fsp_sales_rank": "FSP Sales Rank",
                "generation_elect_utils_rank": "Generation (Elec Utils) Rank",
                "nitrogen_oxide_rank": "NOx Rank",
                "sulfer_dioxide_rank": "SO2 Rank",
            },
            additive=False, sort=("year", "state_id"),
        ),
        _written(
            name="electricity_net_metering", label="Electricity — Net Metering by State",
            path="electricity_net_metering", place="state_name", value="capacity_mw",
            value_label="Capacity", unit="MW", grain=ANNUAL, category="Electricity",
            extras={"customers_count": "Number of Customers", "sectorName": "Sector"},
            breakdown="sector", breakdown_value="capacity_mw", sort=("year", "state_id"),
        ),
        _written(
            name="electricity_capacity", label="Electricity — Generating Capacity by State",
            path="electricity_generating_capacity", place="state_name", value="state_total_mw",
            value_label="Capacity", unit="MW", grain=ANNUAL, category="Electricity",
            extras={
                "us_total_mw": "US Total (MW)",
                "pct_us_capacity": "% of US Capacity",
                "num_producer_types": "# Producer Types",
            },
            breakdown="energy_source", breakdown_value="state_total_mw",
            sort=("year", "state_id", "energy_source"),
        ),
        _written(
            name="total_energy", label="Total Energy — Monthly Series", path="total_energy",
            place=None, value="value_quad_btu", value_label="Value", unit="Quad BTU",
            grain=MONTHLY, category="Total Energy",
            extras={"series_description": "Series Description", "unit": "Unit"},
            breakdown="series_code", breakdown_value="value_quad_btu", on_map=False,
            sort=("period", "series_code"),
        ),
        _written(
            name="seds_state_consumption", label="SEDS — State Consumption by Fuel",
            path="seds_state_consumption", place="state_name", value="total_btu",
            value_label="Consumption", unit="Billion BTU", grain=ANNUAL, category="SEDS",
            extras={
                "fuel_prefix": "Fuel Code",
                "us_total_btu": "US Total (Billion BTU)",
                "pct_us_fuel_consumption": "% of US Fuel Consumption",
                "num_series": "# Series",
            },
            breakdown="fuel_prefix", breakdown_value="total_btu",
            sort=("year", "state_id", "fuel_prefix"),
        ),
        _written(
            name="seds_state_pct_us", label="SEDS — State % of US Total Energy",
            path="seds_state_pct_us", place="state_name", value="total_btu",
            value_label="Total Consumption", unit="Billion BTU", grain=ANNUAL, category="SEDS",
            extras={
                "us_all_btu": "US All Fuels (Billion BTU)",
                "pct_us_total_consumption": "% of US Total",
                "yoy_change_btu": "YoY Change (Billion BTU)",
                "yoy_change_pct": "YoY Change (%)",
            },
            sort=("year", "-total_btu"),
        ),
        _written(
            name="seds_fuel_pivot", label="SEDS — Fuel Mix by State (Wide)",
            path="seds_fuel_pivot", place="state_name", value=None, value_label=None,
            unit="Billion BTU / %", grain=ANNUAL, category="SEDS", on_map=False,
            sort=("year", "state_id"), columns_are_codes=True,
        ),
    ]
)


def tables_by_category(tables: dict[str, TableSpec] = TABLES) -> dict[str, list[str]]:
    """Table names under each category, in catalog order."""
    grouped: dict[str, list[str]] = {}
    for spec in tables.values():
        grouped.setdefault(spec.category, []).append(spec.name)
    return grouped


def list_tables(spark: SparkSession, tables: dict[str, TableSpec] = TABLES) -> DataFrame:
    """The catalog as a table, one row per result table."""
    rows = [
        (spec.category, spec.name, spec.label, spec.path, spec.grain, spec.unit, spec.on_map)
        for spec in tables.values()
    ]
    return spark.createDataFrame(
        rows,
        "category string, name string, label string, path string, grain string, unit string,"
        " on_map boolean",
    )
