"""Cleaning steps, result tables, analyses and read-side queries over the derived raw feeds."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.feeds import feed, feed_sql
from checks.registry import check
from wattframe.plans import serving
from wattframe.plans.cleaning import CLEANING
from wattframe.plans.maintenance import maintain, rebuild
from wattframe.plans.refresh import add_picked_up, refresh, table_path
from wattframe.plans.tables import (
    ANALYSES,
    RESULT_TABLES,
    electricity_by_fuel,
    gas_production,
)
from wattframe.session import keep, scratch_path
from wattframe.sources.catalog import SOURCES, TABLES
from wattframe.sources.files import raw_folder, read_table, write_csv
from wattframe.streaming.pickup import pick_up

EXACT = "decimal(18,2)"  # the feeds have two decimals; exact sums compare bit for bit


def _clean(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return CLEANING[source](feed(spark, sf_dir, source), measure=EXACT)


# ------------------------------------------------------------------ SQL of the cleaning steps


def _num(column: str, alias: str) -> str:
    return f'TRY_CAST("{column}" AS DECIMAL(18,2)) AS {alias}'


def _whole(column: str, alias: str) -> str:
    return f'CAST(trunc(TRY_CAST("{column}" AS DOUBLE)) AS INTEGER) AS {alias}'


_YEAR = "TRY_CAST(period AS INTEGER) AS year"
_MONTH = "CAST(try_strptime(period, '%Y-%m') AS DATE) AS period"
_DAY = "CAST(try_strptime(period, '%Y-%m-%d') AS DATE) AS period"


def _labels(column: str, pairs: dict[str, str], fallback: str) -> str:
    cases = " ".join(f"WHEN '{code}' THEN '{label}'" for code, label in pairs.items())
    return f"CASE {column} {cases} ELSE {fallback} END"


_GAS_LABELS = {
    "EEI": "Exports (Intl)", "IMI": "Imports (Intl)", "IMB": "Net Intl Movements",
    "MID": "Interstate Deliveries", "MIN": "Net Interstate Receipts",
    "MIE": "Net Intl + Interstate",
}
_MOVEMENT_LABELS = {
    "EEX": "Exports", "EIM": "Imports", "ENT": "Net Imports", "STK": "Stock Change",
    "VUA": "Supply Adjustment", "YPA": "Net Production",
}
_FUEL_LABELS = {
    "COL": "Coal", "NG": "Natural Gas", "NUC": "Nuclear", "HYC": "Conventional Hydroelectric",
    "WND": "Wind", "SUN": "Solar", "GEO": "Geothermal", "ALL": "All Fuels",
    "AOR": "All Renewables",
}


def _petroleum_sql(process: str) -> str:
    return f"""SELECT DISTINCT {_DAY}, duoarea, trim("area-name") AS area_name,
  product AS product_id, trim("product-name") AS product_name, process AS process_id, {process},
  series AS series_id, trim("series-description") AS series_description,
  {_num("value", "value_kbd")}, units
FROM raw WHERE TRY_CAST(value AS DECIMAL(18,2)) IS NOT NULL"""


CLEAN_SQL = {
    "natural_gas": f"""SELECT DISTINCT {_MONTH}, duoarea, "area-name" AS state_name,
  {_num("value", "production_mmcf")}
FROM raw WHERE starts_with(duoarea, 'S') AND process = 'VGM'
  AND TRY_CAST(value AS DECIMAL(18,2)) IS NOT NULL""",
    "natural_gas_trade": f"""SELECT DISTINCT {_YEAR}, duoarea, "area-name" AS state_name, process,
  {_labels("process", _GAS_LABELS, "NULL")} AS process_label, {_num("value", "value_mmcf")}, units
FROM raw WHERE regexp_matches(duoarea, '^S[A-Z]{{2}}')
  AND process IN ('EEI', 'IMI', 'IMB', 'MID', 'MIN', 'MIE')
  AND TRY_CAST(value AS DECIMAL(18,2)) IS NOT NULL""",
    "crude_oil_imports": f"""SELECT DISTINCT {_MONTH}, "originName" AS origin_country, "originId",
  "destinationName" AS refinery_state, "destinationId", "gradeName" AS crude_grade,
  {_num("quantity", "quantity_thousand_bbl")}
FROM raw WHERE "destinationTypeName" = 'Refinery State' AND "originType" = 'CTY'
  AND TRY_CAST(quantity AS DECIMAL(18,2)) IS NOT NULL""",
    "petroleum": _petroleum_sql('trim("process-name") AS process_name'),
    "petroleum_movements": _petroleum_sql(
        _labels("process", _MOVEMENT_LABELS, 'trim("process-name")') + " AS process_label"
    ),
    "coal": f"""SELECT * FROM (SELECT DISTINCT {_YEAR},
  trim("exportImportType") AS export_import_type, trim("coalRankId") AS coal_rank_id,
  trim("coalRankDescription") AS coal_rank_desc, trim("countryId") AS country_id,
  trim("countryDescription") AS country_desc, trim("customsDistrictId") AS customs_district_id,
  trim("customsDistrictDescription") AS customs_district,
  {_num("quantity", "quantity_short_tons")}, {_num("price", "price_usd_per_ton")} FROM raw)
WHERE country_id <> 'TOT' AND (quantity_short_tons IS NOT NULL OR price_usd_per_ton IS NOT NULL)""",
    "electricity": f"""SELECT * FROM (SELECT DISTINCT {_MONTH},
  trim("stateDescription") AS state_name, fueltypeid AS fuel_type_id,
  {_labels("fueltypeid", _FUEL_LABELS, "fueltypeid")} AS fuel_type_label,
  {_num("consumption-for-eg", "consumption_thousand_mwh")},
  {_num("consumption-for-eg-btu", "consumption_btu")} FROM raw
  WHERE fueltypeid IN ('COL', 'NG', 'NUC', 'HYC', 'WND', 'SUN', 'GEO', 'ALL', 'AOR'))
WHERE consumption_thousand_mwh IS NOT NULL OR consumption_btu IS NOT NULL""",
    "electricity_state_rankings": f"""SELECT * FROM (SELECT DISTINCT {_YEAR},
  trim("stateID") AS state_id, trim("stateDescription") AS state_name,
  {_whole("average-retail-price-rank", "average_retail_price_rank")},
  {_whole("carbon-dioxide-rank", "carbon_dioxide_rank")},
  {_whole("net-generation-rank", "net_generation_rank")},
  {_whole("nitrogen-oxide-rank", "nitrogen_oxide_rank")},
  {_whole("sulfer-dioxide-rank", "sulfer_dioxide_rank")} FROM raw)
WHERE coalesce(average_retail_price_rank, carbon_dioxide_rank, net_generation_rank,
  nitrogen_oxide_rank, sulfer_dioxide_rank) IS NOT NULL""",
    "electricity_net_metering": f"""SELECT * FROM (SELECT DISTINCT {_YEAR},
  trim(state) AS state_id, trim("stateName") AS state_name, sector, "sectorName",
  {_num("capacity", "capacity_mw")}, {_whole("customers", "customers_count")} FROM raw)
WHERE regexp_matches(state_id, '^[A-Z]{{2}}$')
  AND (capacity_mw IS NOT NULL OR customers_count IS NOT NULL)""",
    "electricity_generating_capacity": f"""SELECT * FROM (SELECT DISTINCT {_YEAR},
  trim("stateID") AS state_id, trim("stateDescription") AS state_name, producertypeid,
  "producerTypeDescription" AS producer_type, energysourceid,
  "energySourceDescription" AS energy_source, {_num("capability", "capability_mw")} FROM raw)
WHERE regexp_matches(state_id, '^[A-Z]{{2}}$') AND capability_mw IS NOT NULL""",
    "total_energy": f"""SELECT DISTINCT {_MONTH}, msn AS series_code,
  trim("seriesDescription") AS series_description, {_num("value", "value_quad_btu")}, unit
FROM raw WHERE TRY_CAST(value AS DECIMAL(18,2)) IS NOT NULL""",
    "seds": f"""SELECT DISTINCT {_YEAR}, "stateId" AS state_id,
  trim("stateDescription") AS state_name, "seriesId" AS series_code,
  trim("seriesDescription") AS series_description, substr("seriesId", 1, 2) AS fuel_prefix,
  substr("seriesId", 3, 2) AS sector_code, substr("seriesId", 5, 1) AS unit_type,
  {_num("value", "value")}, unit
FROM raw WHERE regexp_matches("stateId", '^[A-Z]{{2}}$') AND "stateId" <> 'US'
  AND TRY_CAST(value AS DECIMAL(18,2)) IS NOT NULL""",
}


def _with_clean(source: str, body: str) -> str:
    return f"WITH raw AS ({feed_sql(source)}),\nclean AS ({CLEAN_SQL[source]})\n{body}"


def _with_more(source: str, ctes: str, body: str) -> str:
    return f"WITH raw AS ({feed_sql(source)}),\nclean AS ({CLEAN_SQL[source]}),\n{ctes}\n{body}"


def _pct(part: str, base: str, digits: int) -> str:
    return (
        f"round(CAST({part} AS DOUBLE) / nullif(CAST({base} AS DOUBLE), 0) * 100, {digits})"
    )


def _mean(column: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE) / nullif(count({column}), 0)"


def _rows_sql(source: str, *measures: str) -> str:
    """All cleaned rows, with decimals as doubles."""
    replaced = ", ".join(f"CAST({name} AS DOUBLE) AS {name}" for name in measures)
    return _with_clean(source, f"SELECT * REPLACE ({replaced}) FROM clean")


# ------------------------------------------------------------------ C: cleaning steps

_MEASURES = {
    "natural_gas": ("production_mmcf",),
    "natural_gas_trade": ("value_mmcf",),
    "crude_oil_imports": ("quantity_thousand_bbl",),
    "petroleum": ("value_kbd",),
    "petroleum_movements": ("value_kbd",),
    "coal": ("quantity_short_tons", "price_usd_per_ton"),
    "electricity": ("consumption_thousand_mwh", "consumption_btu"),
    "electricity_state_rankings": (),
    "electricity_net_metering": ("capacity_mw",),
    "electricity_generating_capacity": ("capability_mw",),
    "total_energy": ("value_quad_btu",),
    "seds": ("value",),
}


def _cleaned(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return CLEANING[source](feed(spark, sf_dir, source))


for _position, _source in enumerate(CLEANING, start=1):
    _sql = (
        _rows_sql(_source, *_MEASURES[_source])
        if _MEASURES[_source]
        else _with_clean(_source, "SELECT * FROM clean")
    )
    check(f"c{_position:02d}_clean_{_source}", _sql)(partial(_cleaned, source=_source))


# ------------------------------------------------------------------ T: written tables, N: analyses


def _row_share_sql(source: str, value: str, keys: str, total: str, share: str, where: str) -> str:
    """Rows next to the total of their group; a NULL key has no total."""
    names = [key.strip() for key in keys.split(",")]
    on = " AND ".join(f"r.{name} = t.{name}" for name in names)
    return _with_more(
        source,
        f"""kept AS (SELECT * FROM clean{where}),
totals AS (SELECT {keys}, sum({value}) AS {total} FROM kept GROUP BY {keys})""",
        f"""SELECT r.* REPLACE (CAST({value} AS DOUBLE) AS {value}),
  CAST({total} AS DOUBLE) AS {total}, {_pct(value, total, 4)} AS {share}
FROM kept r LEFT JOIN totals t ON {on}""",
    )


def _group_share_sql(
    source: str, keys: str, value: str, name: str, within: str, total: str, share: str,
    where: str = "", more: str = "", base_where: str = "",
) -> str:
    names = [key.strip() for key in within.split(",")]
    on = " AND ".join(f"g.{key} = t.{key}" for key in names)
    columns = ", ".join(f"g.{key.strip()}" for key in keys.split(","))
    more_names = "".join(f", {part.rsplit(' AS ', 1)[1]}" for part in more.split(";") if part)
    more_sql = "".join(f", {part}" for part in more.split(";") if part)
    return _with_more(
        source,
        f"""g AS (SELECT {keys}, sum({value}) AS {name}{more_sql} FROM clean{where} GROUP BY {keys}),
t AS (SELECT {within}, sum({name}) AS {total} FROM g{base_where} GROUP BY {within})""",
        f"""SELECT {columns}, CAST({name} AS DOUBLE) AS {name}{more_names},
  CAST({total} AS DOUBLE) AS {total}, {_pct(name, total, 4)} AS {share}
FROM g LEFT JOIN t ON {on}""",
    )


def _named_pivot_sql(
    source: str, keys: str, code: str, value: str, columns: dict[str, str], more: str = ""
) -> str:
    codes = ", ".join(f"'{known}'" for known in columns)
    sums = ", ".join(
        f"CAST(sum({value}) FILTER (WHERE {code} = '{known}') AS DOUBLE) AS {name}"
        for known, name in columns.items()
    )
    return _with_clean(
        source,
        f"SELECT {keys}, {sums}{more} FROM clean WHERE {code} IN ({codes}) GROUP BY {keys}",
    )


_COAL_KEYS = "year, export_import_type, coal_rank_id"


def _coal_sql(keys: str, share: str, aggregates: str = "", names: str = "") -> str:
    all_keys = f"{_COAL_KEYS}, {keys}"
    grouped = ", ".join(f"g.{key.strip()}" for key in all_keys.split(","))
    on = " AND ".join(f"g.{key.strip()} = t.{key.strip()}" for key in _COAL_KEYS.split(","))
    return _with_more(
        "coal",
        f"""g AS (SELECT {all_keys}, sum(quantity_short_tons) AS total_short_tons,
  {_mean("price_usd_per_ton")} AS avg_price_usd_per_ton{aggregates} FROM clean GROUP BY {all_keys}),
t AS (SELECT {_COAL_KEYS}, sum(quantity_short_tons) AS us_total_short_tons,
  {_mean("price_usd_per_ton")} AS us_avg_price_usd_per_ton FROM clean GROUP BY {_COAL_KEYS})""",
        f"""SELECT {grouped}, CAST(total_short_tons AS DOUBLE) AS total_short_tons,
  avg_price_usd_per_ton{names}, CAST(us_total_short_tons AS DOUBLE) AS us_total_short_tons,
  us_avg_price_usd_per_ton, {_pct("total_short_tons", "us_total_short_tons", 4)} AS {share}
FROM g LEFT JOIN t ON {on}""",
    )


_PRICE_RANGE = """,
  CAST(min(price_usd_per_ton) AS DOUBLE) AS min_price_usd_per_ton,
  CAST(max(price_usd_per_ton) AS DOUBLE) AS max_price_usd_per_ton"""

_COUNTRY_SQL = _coal_sql("coal_rank_desc, country_id, country_desc", "pct_us_total")

_STATE_KEYS = "year, state_id, state_name"


def _state_share_sql(where: str, share: str) -> str:
    lag = "lag(total_btu) OVER (PARTITION BY state_id ORDER BY year NULLS FIRST, state_name NULLS FIRST)"
    return _with_more(
        "seds",
        f"""g AS (SELECT {_STATE_KEYS}, sum(value) AS total_btu FROM clean
  WHERE unit_type = 'B'{where} GROUP BY {_STATE_KEYS}),
t AS (SELECT year, sum(total_btu) AS us_all_btu FROM g GROUP BY year),
p AS (SELECT *, {lag} AS previous FROM g)""",
        f"""SELECT p.year, state_id, state_name, CAST(total_btu AS DOUBLE) AS total_btu,
  CAST(us_all_btu AS DOUBLE) AS us_all_btu, {_pct("total_btu", "us_all_btu", 4)} AS {share},
  CAST(total_btu - previous AS DOUBLE) AS yoy_change_btu,
  {_pct("(total_btu - previous)", "previous", 2)} AS yoy_change_pct
FROM p LEFT JOIN t ON p.year = t.year""",
    )


_FUELS = ("CO", "HY", "NG", "PA", "RE", "TE")

TABLE_SQL = {
    "ng_production": _row_share_sql(
        "natural_gas", "production_mmcf", "period", "us_total_mmcf", "pct_us_production", ""
    ),
    "ng_intl_trade": _named_pivot_sql(
        "natural_gas_trade", "year, duoarea, state_name", "process", "value_mmcf",
        {"EEI": "exports_mmcf", "IMI": "imports_mmcf", "IMB": "net_intl_mmcf"},
    ),
    "ng_interstate": _named_pivot_sql(
        "natural_gas_trade", "year, duoarea, state_name", "process", "value_mmcf",
        {"MID": "interstate_delivered_mmcf", "MIN": "net_interstate_received_mmcf"},
    ),
    "crude_by_origin": _with_clean(
        "crude_oil_imports",
        """SELECT period, refinery_state, origin_country,
  CAST(sum(quantity_thousand_bbl) AS DOUBLE) AS total_thousand_bbl
FROM clean GROUP BY period, refinery_state, origin_country""",
    ),
    "crude_by_state": _group_share_sql(
        "crude_oil_imports", "period, refinery_state", "quantity_thousand_bbl",
        "total_thousand_bbl", "period", "us_total_thousand_bbl", "pct_us_imports",
    ),
    "crude_grade": _group_share_sql(
        "crude_oil_imports", "period, refinery_state, crude_grade", "quantity_thousand_bbl",
        "grade_quantity_thousand_bbl", "period, refinery_state", "state_total_thousand_bbl",
        "pct_of_state_imports",
    ),
    "petroleum_production": _rows_sql("petroleum", "value_kbd"),
    "petroleum_movements": _rows_sql("petroleum_movements", "value_kbd"),
    "petroleum_movements_wide": _named_pivot_sql(
        "petroleum_movements", "period, duoarea, area_name, product_id, product_name",
        "process_id", "value_kbd",
        {"EEX": "exports_kbd", "EIM": "imports_kbd", "ENT": "net_imports_kbd"},
        """, CAST(sum(value_kbd) FILTER (WHERE process_id = 'EEX')
    - sum(value_kbd) FILTER (WHERE process_id = 'EIM') AS DOUBLE) AS trade_balance_kbd""",
    ),
    "coal_trade": _rows_sql("coal", "quantity_short_tons", "price_usd_per_ton"),
    "coal_trade_summary": _coal_sql(
        "coal_rank_desc, country_id, country_desc, customs_district_id, customs_district",
        "pct_us_direction", _PRICE_RANGE, ", min_price_usd_per_ton, max_price_usd_per_ton",
    ),
    "electricity_by_fuel": _row_share_sql(
        "electricity", "consumption_thousand_mwh", "period, fuel_type_id", "us_fuel_thousand_mwh",
        "pct_us_fuel_consumption", " WHERE fuel_type_id <> 'ALL'",
    ).replace(
        "SELECT r.* REPLACE (", "SELECT r.* REPLACE (CAST(consumption_btu AS DOUBLE) AS consumption_btu, "
    ),
    "electricity_rankings": _with_clean("electricity_state_rankings", "SELECT * FROM clean"),
    "electricity_net_metering": _rows_sql("electricity_net_metering", "capacity_mw"),
    "electricity_capacity": _group_share_sql(
        "electricity_generating_capacity", "year, state_id, state_name, energy_source",
        "capability_mw", "state_total_mw", "year, energy_source", "us_total_mw", "pct_us_capacity",
        more="count(DISTINCT producer_type) AS num_producer_types",
    ),
    "total_energy": _rows_sql("total_energy", "value_quad_btu"),
    "seds_state_consumption": _group_share_sql(
        "seds", f"{_STATE_KEYS}, fuel_prefix", "value", "total_btu", "year, fuel_prefix",
        "us_total_btu", "pct_us_fuel_consumption", where=" WHERE unit_type = 'B'",
        more="count(DISTINCT series_code) AS num_series",
    ),
    "seds_state_pct_us": _state_share_sql(
        " AND fuel_prefix = 'TE'", "pct_us_total_consumption"
    ),
    "seds_fuel_pivot": _with_more(
        "seds",
        f"g AS (SELECT {_STATE_KEYS}, "
        + ", ".join(
            f"sum(value) FILTER (WHERE fuel_prefix = '{fuel}') AS \"{fuel}\"" for fuel in _FUELS
        )
        + f" FROM clean WHERE unit_type = 'B' GROUP BY {_STATE_KEYS})",
        f"SELECT {_STATE_KEYS}, "
        + ", ".join(f'CAST("{fuel}" AS DOUBLE) AS "{fuel}"' for fuel in _FUELS)
        + ", "
        + ", ".join(
            f'{_pct(chr(34) + fuel + chr(34), chr(34) + "TE" + chr(34), 2)} AS {fuel.lower()}_pct'
            for fuel in _FUELS
            if fuel != "TE"
        )
        + " FROM g",
    ),
    "coal_by_country": _COUNTRY_SQL,
    "coal_by_district": _coal_sql(
        "coal_rank_desc, customs_district_id, customs_district", "pct_us_total",
        ", count(DISTINCT country_id) AS num_countries", ", num_countries",
    ),
    "coal_by_rank": _with_clean(
        "coal",
        f"""SELECT {_COAL_KEYS}, coal_rank_desc,
  CAST(sum(quantity_short_tons) AS DOUBLE) AS total_short_tons,
  {_mean("price_usd_per_ton")} AS avg_price_usd_per_ton{_PRICE_RANGE},
  count(DISTINCT country_id) AS num_countries,
  count(DISTINCT customs_district_id) AS num_districts
FROM clean GROUP BY {_COAL_KEYS}, coal_rank_desc""",
    ),
    "coal_country_yoy": f"""SELECT *, total_short_tons - previous AS yoy_change_short_tons,
  {_pct("(total_short_tons - previous)", "previous", 2)} AS yoy_change_pct
FROM (SELECT *, lag(total_short_tons) OVER (PARTITION BY export_import_type, coal_rank_id, country_id
  ORDER BY year NULLS FIRST, coal_rank_desc NULLS FIRST, country_desc NULLS FIRST) AS previous FROM ({_COUNTRY_SQL}))""".replace(
        "SELECT *, total_short_tons", "SELECT * EXCLUDE (previous), total_short_tons", 1
    ),
    "coal_rank_pivot": _with_clean(
        "coal",
        "SELECT year, export_import_type, "
        + ", ".join(
            f"CAST(sum(quantity_short_tons) FILTER (WHERE coal_rank_id = '{rank}') AS DOUBLE)"
            f' AS "{rank}"'
            for rank in "ANR"
        )
        + " FROM clean GROUP BY year, export_import_type",
    ),
    "elec_state_total": _group_share_sql(
        "electricity", "period, state_name", "consumption_thousand_mwh",
        "state_total_thousand_mwh", "period", "us_total_thousand_mwh", "pct_us_consumption",
        where=" WHERE fuel_type_id = 'ALL'",
    ),
    "petro_by_area": _group_share_sql(
        "petroleum_movements", "period, duoarea, area_name, product_id, product_name, process_id",
        "value_kbd", "total_kbd", "period, process_id, product_id", "us_total_kbd", "pct_us",
        where=" WHERE process_id IN ('EEX', 'EIM', 'ENT')",
        base_where=" WHERE duoarea = 'NUS-Z00'",
    ),
    "seds_state_all_fuels": _state_share_sql("", "pct_us_total"),
}


# Builders that read the cleaned rows more than once get a stored copy, as in a refresh.
_READ_TWICE = (gas_production, electricity_by_fuel)


def _built(spark: SparkSession, sf_dir: str, source: str, build) -> DataFrame:
    clean = _clean(spark, sf_dir, source)
    return build(keep(clean) if build in _READ_TWICE else clean)


for _letter, _group in (("t", RESULT_TABLES), ("n", ANALYSES)):
    for _position, (_name, (_source, _build)) in enumerate(_group.items(), start=1):
        check(f"{_letter}{_position:02d}_{_name}", TABLE_SQL[_name])(
            partial(_built, source=_source, build=_build)
        )


# ------------------------------------------------------------------ read-side queries on the tables


def _prepared(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, build = RESULT_TABLES[name]
    return serving.prepare(_built(spark, sf_dir, source, build), TABLES[name])


_CRUDE_PLACE = """CASE refinery_state WHEN 'TEXAS' THEN 'Texas' WHEN 'OHIO' THEN 'Ohio'
  ELSE refinery_state END AS state"""


@check(
    "s01_map_month",
    f"""WITH tab AS ({TABLE_SQL["crude_by_state"]})
SELECT state, CASE state WHEN 'Texas' THEN 'TX' WHEN 'Ohio' THEN 'OH' ELSE 'UT' END AS state_abbrev,
  sum(total_thousand_bbl) AS total_thousand_bbl
FROM (SELECT *, {_CRUDE_PLACE} FROM tab)
WHERE period = DATE '1997-03-01' AND state IN ('Texas', 'Ohio', 'Utah') GROUP BY state""",
)
def _map_month(spark, sf_dir):
    spec = TABLES["crude_by_state"]
    rows = serving.time_slice(_prepared(spark, sf_dir, spec.name), spec, 1997, month=3)
    return serving.states_only(serving.by_place(rows, "total_thousand_bbl"))


@check(
    "s02_ranking_year",
    f"""WITH tab AS ({TABLE_SQL["seds_state_pct_us"]})
SELECT state_name AS state, total_btu,
  row_number() OVER (ORDER BY total_btu DESC, state_name) AS position
FROM tab WHERE year = 1999""",
)
def _ranking_year(spark, sf_dir):
    spec = TABLES["seds_state_pct_us"]
    rows = serving.time_slice(_prepared(spark, sf_dir, spec.name), spec, 1999)
    return serving.ranking(rows, spec, spec.value)


@check(
    "s03_breakdown_all_places",
    f"""WITH tab AS ({TABLE_SQL["crude_grade"]}), g AS (
SELECT state, crude_grade, round(sum(grade_quantity_thousand_bbl), 2) AS grade_quantity_thousand_bbl
FROM (SELECT *, {_CRUDE_PLACE} FROM tab) WHERE year(period) = 1998 GROUP BY state, crude_grade)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY state
  ORDER BY grade_quantity_thousand_bbl DESC, crude_grade) AS INTEGER) AS position FROM g) WHERE position <= 3""",
)
def _breakdown_all(spark, sf_dir):
    spec = TABLES["crude_grade"]
    rows = serving.time_slice(_prepared(spark, sf_dir, spec.name), spec, 1998)
    top = serving.breakdown(rows, spec, n=3)
    value = spec.breakdown_value
    return top.withColumn(value, F.round(value, 2))


@check(
    "s04_trend_one_place",
    f"""WITH tab AS ({TABLE_SQL["electricity_by_fuel"]})
SELECT period, round(coalesce(sum(consumption_btu), 0), 2) AS consumption_btu
FROM tab WHERE state_name = 'NATION_15' AND period IS NOT NULL GROUP BY period""",
)
def _trend_one(spark, sf_dir):
    spec = TABLES["electricity_by_fuel"]
    rows = _prepared(spark, sf_dir, spec.name)
    found = serving.trend(rows, spec, "consumption_btu", place="NATION_15")
    return found.withColumn("consumption_btu", F.round("consumption_btu", 2))


@check(
    "s05_snapshot",
    f"""WITH tab AS ({TABLE_SQL["electricity_net_metering"]})
SELECT round(coalesce(sum(capacity_mw), 0), 2) AS capacity_mw,
  CAST(coalesce(sum(customers_count), 0) AS BIGINT) AS customers_count, min("sectorName") AS "sectorName"
FROM tab WHERE state_name = 'NATION_15' AND year = 1998""",
)
def _snapshot(spark, sf_dir):
    spec = TABLES["electricity_net_metering"]
    rows = serving.time_slice(_prepared(spark, sf_dir, spec.name), spec, 1998)
    return serving.snapshot(rows, spec, "NATION_15").withColumn(
        "capacity_mw", F.round("capacity_mw", 2)
    )


@check(
    "s06_top_week",
    f"""WITH tab AS ({TABLE_SQL["petroleum_movements"]})
SELECT area_name AS state, round(sum(value_kbd), 2) AS value_kbd FROM tab
WHERE isoyear(period) = 1998 AND week(period) = 1 GROUP BY area_name
ORDER BY value_kbd DESC, state LIMIT 15""",
)
def _top_week(spark, sf_dir):
    spec = TABLES["petroleum_movements"]
    rows = serving.time_slice(_prepared(spark, sf_dir, spec.name), spec, 1998, week=1)
    return serving.top_places(rows, spec, spec.value).withColumn(
        "value_kbd", F.round("value_kbd", 2)
    )


@check(
    "s07_unadditive_metric_mean",
    f"""WITH tab AS ({TABLE_SQL["electricity_rankings"]})
SELECT year, round(avg(carbon_dioxide_rank), 6) AS carbon_dioxide_rank FROM tab
WHERE year IS NOT NULL GROUP BY year""",
)
def _mean_rank(spark, sf_dir):
    spec = TABLES["electricity_rankings"]
    rows = _prepared(spark, sf_dir, spec.name)
    return serving.trend(rows, spec, "carbon_dioxide_rank", agg=F.avg).withColumn(
        "carbon_dioxide_rank", F.round("carbon_dioxide_rank", 6)
    )



@check(
    "s08_refresh_then_trend",
    f"""WITH tab AS ({TABLE_SQL["ng_intl_trade"]})
SELECT year, round(coalesce(sum(net_intl_mmcf), 0), 2) AS net_intl_mmcf FROM tab
WHERE year IS NOT NULL GROUP BY year""",
)
def _refreshed_trend(spark, sf_dir):
    """From raw CSV files through a full refresh to a query on the stored table."""
    base = scratch_path(spark, "refresh")
    source, spec = SOURCES["natural_gas_trade"], TABLES["ng_intl_trade"]
    write_csv(feed(spark, sf_dir, source.name), raw_folder(base, source, "1995", "2001"))
    refresh(spark, base, [source.name])
    rows = serving.load(spark, spec, f"{base}/processed")
    return serving.trend(rows, spec, "net_intl_mmcf").withColumn(
        "net_intl_mmcf", F.round("net_intl_mmcf", 2)
    )


@check(
    "s09_refresh_then_deliveries",
    f"""WITH tab AS ({TABLE_SQL["ng_intl_trade"]})
SELECT year, round(coalesce(sum(net_intl_mmcf), 0), 2) AS net_intl_mmcf FROM tab
WHERE year IS NOT NULL GROUP BY year""",
)
def _refreshed_and_picked_up(spark, sf_dir):
    """A refresh of the older years, two deliveries of the others and of some known rows, a rebuild:
    the same as a full refresh."""
    base = scratch_path(spark, "deliveries")
    source, spec = SOURCES["natural_gas_trade"], TABLES["ng_intl_trade"]
    rows = feed(spark, sf_dir, source.name)
    old = F.coalesce(F.col("period") < "1997", F.lit(True))
    write_csv(rows.where(old), raw_folder(base, source, "1995", "1996"))
    refresh(spark, base, [source.name])
    later = F.col("period") >= "1997"
    for number_, landed in enumerate((rows.where(F.col("period") == "1996"), rows.where(later))):
        write_csv(landed, f"{base}/landing/{number_}")
    pick_up(
        spark, f"{base}/landing", rows.columns, CLEANING[source.name], f"{base}/picked", f"{base}/state"
    ).awaitTermination()
    add_picked_up(spark, base, source.name, f"{base}/picked")
    rows = serving.load(spark, spec, f"{base}/processed")
    return serving.trend(rows, spec, "net_intl_mmcf").withColumn(
        "net_intl_mmcf", F.round("net_intl_mmcf", 2)
    )


def _maintained(spark, sf_dir, source: str, first: str) -> str:
    """Raw rows before the year ``first`` are cleaned and built; the rest, and a year that is
    known already, arrive in two deliveries, each taken over by the years it touches."""
    base = scratch_path(spark, "maintained")
    rows = feed(spark, sf_dir, source)
    old = F.coalesce(F.col("period") < first, F.lit(True))
    write_csv(rows.where(old & (F.pmod(F.xxhash64(*rows.columns), F.lit(3)) > 0)), raw_folder(base, SOURCES[source], "1995", "1996"))
    rebuild(spark, base, source)
    for number_, landed in enumerate((rows.where(F.col("period") >= first), rows.where(old))):
        write_csv(landed, f"{base}/landing/{number_}")
        pick_up(
            spark, f"{base}/landing", rows.columns, CLEANING[source], f"{base}/picked", f"{base}/state"
        ).awaitTermination()
        maintain(spark, base, source, f"{base}/picked")
    return base


@check(
    "s10_maintained_by_touched_years",
    f"""WITH tab AS ({TABLE_SQL["ng_intl_trade"]})
SELECT year, round(coalesce(sum(net_intl_mmcf), 0), 2) AS net_intl_mmcf FROM tab
WHERE year IS NOT NULL GROUP BY year""",
)
def _maintained_trend(spark, sf_dir):
    """Appended years and rows missing in old years: the same as a full refresh."""
    spec = TABLES["ng_intl_trade"]
    base = _maintained(spark, sf_dir, "natural_gas_trade", "1998")
    rows = serving.load(spark, spec, f"{base}/processed")
    return serving.trend(rows, spec, "net_intl_mmcf").withColumn("net_intl_mmcf", F.round("net_intl_mmcf", 2))


@check(
    "s11_maintained_changes",
    f"""WITH tab AS ({TABLE_SQL["seds_state_pct_us"]})
SELECT year, state_id, state_name, round(total_btu, 2) AS total_btu,
  round(yoy_change_btu, 2) AS yoy_change_btu, round(pct_us_total_consumption, 3) AS pct FROM tab""",
)
def _maintained_changes(spark, sf_dir):
    """Changes against the previous year, after late rows of older years."""
    base = _maintained(spark, sf_dir, "seds", "1998")
    rows = read_table(spark, table_path(base, "seds_state_pct_us"))
    return rows.select(
        "year", "state_id", "state_name", F.round("total_btu", 2).alias("total_btu"),
        F.round("yoy_change_btu", 2).alias("yoy_change_btu"), F.round("pct_us_total_consumption", 3).alias("pct"),
    )


# ------------------------------------------------------------------ tables with measures as doubles


def _on_doubles(spark: SparkSession, sf_dir: str, name: str, columns: tuple[str, ...]) -> DataFrame:
    """A result table from measures as a refresh stores them; their sums, in no fixed order, are
    rounded to the two places that the feeds have."""
    source, build = RESULT_TABLES[name]
    rows = build(keep(CLEANING[source](feed(spark, sf_dir, source))))
    return rows.withColumns({column: F.round(column, 2) for column in columns})


def _rounded_sql(name: str, columns: tuple[str, ...]) -> str:
    replaced = ", ".join(f"round({column}, 2) AS {column}" for column in columns)
    return f"WITH built AS ({TABLE_SQL[name]}) SELECT * REPLACE ({replaced}) FROM built"


for _name, _columns in (
    ("ng_production", ("production_mmcf", "us_total_mmcf")),
    ("ng_intl_trade", ("exports_mmcf", "imports_mmcf", "net_intl_mmcf")),
):
    check(f"d_{_name}_on_doubles", _rounded_sql(_name, _columns))(
        partial(_on_doubles, name=_name, columns=_columns)
    )
