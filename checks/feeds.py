"""Raw text extracts that Spark derives from the star-schema tables.

Each feed has the columns of a raw source and its typical dirt: padded and malformed text, bad
dates, missing measures, aggregate members, unknown codes, repeated rows. All rows of the tables
go in. The text of a feed runs in Spark and DuckDB alike; ``{orders}`` stands for a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from checks.registry import table

_BY_CUSTOMER = """
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"""
_BY_SUPPLIER = """
FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey
JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"""
_BY_PART = "\nFROM {lineitem} JOIN {part} ON l_partkey = p_partkey"

_STATE = "(chr(65 + n_nationkey) || chr(65 + n_regionkey))"
_ORDER_MONTH = """CASE WHEN o_totalprice > 497000
  THEN (substr(cast(o_orderdate AS string), 1, 4) || '-13')
  ELSE substr(cast(o_orderdate AS string), 1, 7) END"""
_SHIP_YEAR = "substr(cast(l_shipdate AS string), 1, 4)"
_SHIP_DAY = "substr(cast(l_shipdate AS string), 1, 10)"


def _amount(column: str, bad_below: int, empty_below: int) -> str:
    """Amount as padded text; small ones malformed or empty."""
    return f"""CASE WHEN {column} < {bad_below} THEN 'NA' WHEN {column} < {empty_below} THEN ''
  ELSE (' ' || cast(cast({column} AS decimal(18,2)) AS string)) END"""


_ORDER_AMOUNT = _amount("o_totalprice", 2000, 4000)
_LINE_AMOUNT = _amount("l_extendedprice", 1200, 1500)
_LINE_QUANTITY = _amount("l_quantity", 2, 3)

_PETROLEUM_COLUMNS = f"""
  CASE WHEN l_quantity > 49 THEN 'unknown' ELSE {_SHIP_DAY} END AS period,
  CASE l_returnflag WHEN 'N' THEN 'NUS-Z00' WHEN 'A' THEN 'R10' ELSE 'R20' END AS duoarea,
  CASE l_returnflag WHEN 'N' THEN 'U.S.' WHEN 'A' THEN ' PADD 1 ' ELSE 'PADD 2 ' END AS `area-name`,
  p_type AS product, (p_type || ' product ') AS `product-name`,"""

FEEDS: dict[str, str] = {
    "natural_gas": f"""SELECT {_ORDER_MONTH} AS period,
  CASE o_orderpriority WHEN '5-LOW' THEN 'NUS' ELSE ('S' || {_STATE}) END AS duoarea,
  n_name AS `area-name`,
  CASE o_orderstatus WHEN 'P' THEN 'VRN' ELSE 'VGM' END AS process,
  {_ORDER_AMOUNT} AS value {_BY_CUSTOMER}""",
    "natural_gas_trade": f"""SELECT {_SHIP_YEAR} AS period,
  CASE n_regionkey WHEN 4 THEN 'NUS' ELSE ('S' || {_STATE}) END AS duoarea,
  n_name AS `area-name`,
  CASE l_linenumber WHEN 1 THEN 'EEI' WHEN 2 THEN 'IMI' WHEN 3 THEN 'IMB' WHEN 4 THEN 'MID'
    WHEN 5 THEN 'MIN' WHEN 6 THEN 'MIE' ELSE 'ZZZ' END AS process,
  {_LINE_AMOUNT} AS value, 'MMCF' AS units {_BY_SUPPLIER}""",
    "crude_oil_imports": f"""SELECT {_ORDER_MONTH} AS period,
  n_name AS `originName`, ('CTY_' || {_STATE}) AS `originId`,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'REG' ELSE 'CTY' END AS `originType`,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'TEXAS' WHEN 'MACHINERY' THEN 'OHIO'
    WHEN 'FURNITURE' THEN 'Utah' ELSE c_mktsegment END AS `destinationName`,
  substr(c_mktsegment, 1, 2) AS `destinationId`, r_name AS `gradeName`,
  CASE o_orderstatus WHEN 'P' THEN 'Port' ELSE 'Refinery State' END AS `destinationTypeName`,
  {_ORDER_AMOUNT} AS quantity {_BY_CUSTOMER}""",
    "petroleum": f"""SELECT {_PETROLEUM_COLUMNS}
  l_linestatus AS process, (' process ' || l_linestatus) AS `process-name`,
  p_brand AS series, (p_brand || ' series ') AS `series-description`,
  {_LINE_AMOUNT} AS value, 'MBBL/D' AS units {_BY_PART}""",
    "petroleum_movements": f"""SELECT {_PETROLEUM_COLUMNS}
  CASE l_linenumber WHEN 1 THEN 'EEX' WHEN 2 THEN 'EIM' WHEN 3 THEN 'ENT' WHEN 4 THEN 'STK'
    WHEN 5 THEN 'VUA' WHEN 6 THEN 'YPA' ELSE 'ZZZ' END AS process,
  ' own name ' AS `process-name`, p_brand AS series, (p_brand || ' series ') AS `series-description`,
  {_LINE_AMOUNT} AS value, 'MBBL/D' AS units {_BY_PART}""",
    "coal": f"""SELECT {_SHIP_YEAR} AS period,
  CASE l_linestatus WHEN 'O' THEN ' Exports' ELSE 'Imports ' END AS `exportImportType`,
  (l_returnflag || ' ') AS `coalRankId`, (' rank ' || l_returnflag) AS `coalRankDescription`,
  CASE n_nationkey WHEN 0 THEN 'TOT' ELSE {_STATE} END AS `countryId`, n_name AS `countryDescription`,
  (' ' || cast(l_linenumber AS string)) AS `customsDistrictId`,
  ('District ' || cast(l_linenumber AS string) || ' ') AS `customsDistrictDescription`,
  {_LINE_QUANTITY} AS quantity, {_LINE_AMOUNT} AS price {_BY_SUPPLIER}""",
    "electricity": f"""SELECT substr(cast(l_shipdate AS string), 1, 7) AS period,
  (' ' || n_name || ' ') AS `stateDescription`,
  CASE l_linenumber WHEN 1 THEN 'COL' WHEN 2 THEN 'NG' WHEN 3 THEN 'NUC' WHEN 4 THEN 'WND'
    WHEN 5 THEN 'SUN' WHEN 6 THEN 'ALL' ELSE 'PEL' END AS fueltypeid,
  {_LINE_QUANTITY} AS `consumption-for-eg`, {_LINE_AMOUNT} AS `consumption-for-eg-btu` {_BY_SUPPLIER}""",
    "electricity_state_rankings": f"""SELECT {_SHIP_YEAR} AS period,
  (' ' || {_STATE}) AS `stateID`, (n_name || ' ') AS `stateDescription`,
  (cast(l_linenumber AS string) || '.0') AS `average-retail-price-rank`,
  {_LINE_QUANTITY} AS `carbon-dioxide-rank`,
  CASE l_returnflag WHEN 'N' THEN 'NA' ELSE cast(l_linenumber AS string) END AS `net-generation-rank`,
  nullif(cast(l_linenumber AS string), '3') AS `nitrogen-oxide-rank`,
  nullif(l_linestatus, 'O') AS `sulfer-dioxide-rank` {_BY_SUPPLIER}""",
    "electricity_net_metering": f"""SELECT {_SHIP_YEAR} AS period,
  CASE n_regionkey WHEN 3 THEN 'USA' ELSE ({_STATE} || ' ') END AS state,
  (' ' || n_name) AS `stateName`, l_returnflag AS sector,
  ('sector ' || l_returnflag) AS `sectorName`, {_LINE_AMOUNT} AS capacity,
  CASE WHEN l_quantity < 10 THEN '' ELSE (cast(cast(l_quantity AS int) AS string) || '.75') END
    AS customers {_BY_SUPPLIER}""",
    "electricity_generating_capacity": f"""SELECT {_SHIP_YEAR} AS period,
  CASE n_regionkey WHEN 3 THEN 'USA' ELSE {_STATE} END AS `stateID`,
  n_name AS `stateDescription`, l_linestatus AS producertypeid,
  ('producer ' || l_linestatus) AS `producerTypeDescription`,
  cast(l_linenumber AS string) AS energysourceid,
  ('source ' || cast(l_linenumber AS string)) AS `energySourceDescription`,
  {_LINE_AMOUNT} AS capability {_BY_SUPPLIER}""",
    "total_energy": f"""SELECT {_ORDER_MONTH} AS period, o_orderpriority AS msn,
  (' series ' || o_orderpriority) AS `seriesDescription`, {_ORDER_AMOUNT} AS value,
  'Quadrillion Btu' AS unit
FROM {{orders}}""",
    "seds": f"""SELECT {_SHIP_YEAR} AS period,
  CASE n_nationkey WHEN 0 THEN 'US' WHEN 1 THEN 'usa' ELSE {_STATE} END AS `stateId`,
  (n_name || ' ') AS `stateDescription`,
  (CASE l_linenumber WHEN 1 THEN 'CO' WHEN 2 THEN 'PA' WHEN 3 THEN 'NG' WHEN 4 THEN 'RE'
      WHEN 5 THEN 'HY' ELSE 'TE' END
    || CASE l_linestatus WHEN 'O' THEN 'TC' ELSE 'RC' END
    || CASE l_returnflag WHEN 'R' THEN 'P' ELSE 'B' END) AS `seriesId`,
  ' a series' AS `seriesDescription`, {_LINE_AMOUNT} AS value, 'Billion Btu' AS unit {_BY_SUPPLIER}""",
}

_TABLES = ("orders", "customer", "nation", "region", "lineitem", "supplier", "part")


def feed(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Raw rows of a source, derived from the whole tables."""
    text = FEEDS[source]
    used = {name: table(spark, sf_dir, name) for name in _TABLES if "{" + name + "}" in text}
    return spark.sql(text, **used)


def feed_sql(source: str) -> str:
    """The same rows in DuckDB."""
    text = FEEDS[source].replace("`", '"')
    for name in _TABLES:
        text = text.replace("{" + name + "}", name)
    return text
