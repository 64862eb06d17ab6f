"""Every generic operator on an analogous shape over the star-schema tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import check, money, table
from wattframe.functions.calendar import ANNUAL, MONTHLY, WEEKLY, calendar_columns, period_label
from wattframe.functions.labels import column_label, lookup, place_name, state_code
from wattframe.functions.measures import mean
from wattframe.functions.parsing import code_part, day, month_start, number, trimmed, whole, year_number
from wattframe.operators.changes import change_from_previous, change_in_long_series
from wattframe.operators.distincts import distinct_counts, stored_bitmaps
from wattframe.operators.pivots import (
    pivot_discovered,
    pivot_named,
    pivot_share,
    sums_by_code,
    unpivot_labelled,
)
from wattframe.operators.ranking import rank_all, sum_by, top_n, top_n_per
from wattframe.operators.rows import (
    any_present,
    delivery,
    distinct_rows,
    doubles,
    latest_revision,
    numeric_columns,
    within_range,
)
from wattframe.operators.shares import group_share, row_share
from wattframe.plans import serving
from wattframe.plans.ingest import latest_period, load_periods, missing_ranges, step_back
from wattframe.plans.refresh import clean_range
from wattframe.session import keep, scratch_path
from wattframe.sources import snapshots
from wattframe.sources.catalog import SOURCES, TableSpec
from wattframe.sources.files import (
    explode_records,
    raw_folder,
    read_csv,
    read_pages,
    read_table,
    write_csv,
    write_table,
)
from wattframe.sources.manifest import latest_known_period, read_known, update_manifest
from wattframe.streaming.pickup import newest_delivery, pick_up, read_picked_up

MONTH_SQL = "CAST(date_trunc('month', o_orderdate) AS DATE)"
AMOUNT_SQL = "CAST(o_totalprice AS DECIMAL(18,2))"
PRICE_SQL = "CAST(l_extendedprice AS DECIMAL(18,2))"


def _order_month():
    return F.trunc("o_orderdate", "month").alias("month")


def _pct(part: str, base: str, digits: int) -> str:
    return f"round(CAST({part} AS DOUBLE) / nullif(CAST({base} AS DOUBLE), 0) * 100, {digits})"


def _orders_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with nation and segment. Catalyst broadcasts a side only when its files are small;
    otherwise AQE splits a hot customer's partition."""
    customers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return table(spark, sf_dir, "orders").join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    )


_ORDERS_SQL = """orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey"""


def _lines_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return table(spark, sf_dir, "lineitem").join(
        suppliers, F.col("l_suppkey") == F.col("s_suppkey")
    )


_LINES_SQL = """lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey"""


# ------------------------------------------------------------------ shares


@check(
    "q01_nation_month_share",
    f"""WITH g AS (SELECT {MONTH_SQL} AS month, n_name AS nation, sum({AMOUNT_SQL}) AS order_value
FROM {_ORDERS_SQL} GROUP BY ALL),
t AS (SELECT month, sum(order_value) AS month_value FROM g GROUP BY month)
SELECT g.month, nation, CAST(order_value AS DOUBLE) AS order_value,
  CAST(month_value AS DOUBLE) AS month_value, {_pct("order_value", "month_value", 4)} AS pct_of_month
FROM g LEFT JOIN t ON g.month = t.month ORDER BY g.month, order_value DESC, nation""",
)
def nation_month_share(spark, sf_dir):
    groups = (
        _orders_by_nation(spark, sf_dir)
        .groupBy(_order_month(), F.col("n_name").alias("nation"))
        .agg(F.sum(money("o_totalprice")).alias("order_value"))
    )
    shares = group_share(
        groups, "order_value", ["month"], total="month_value", share="pct_of_month"
    )
    return doubles(shares).orderBy("month", F.desc("order_value"), "nation")


@check(
    "q02_priority_share_in_nation_month",
    f"""WITH g AS (SELECT {MONTH_SQL} AS month, n_name AS nation, o_orderpriority AS priority,
  sum({AMOUNT_SQL}) AS order_value FROM {_ORDERS_SQL} GROUP BY ALL),
t AS (SELECT month, nation, sum(order_value) AS nation_month_value FROM g GROUP BY ALL)
SELECT g.month, g.nation, priority, CAST(order_value AS DOUBLE) AS order_value,
  CAST(nation_month_value AS DOUBLE) AS nation_month_value,
  {_pct("order_value", "nation_month_value", 4)} AS pct_of_nation_month
FROM g LEFT JOIN t ON g.month = t.month AND g.nation = t.nation""",
)
def priority_share(spark, sf_dir):
    groups = (
        _orders_by_nation(spark, sf_dir)
        .groupBy(_order_month(), F.col("n_name").alias("nation"), F.col("o_orderpriority").alias("priority"))
        .agg(F.sum(money("o_totalprice")).alias("order_value"))
    )
    return doubles(
        group_share(
            groups, "order_value", ["month", "nation"],
            total="nation_month_value", share="pct_of_nation_month",
        )
    )


@check(
    "q31_share_of_published_member",
    f"""WITH g AS (SELECT {MONTH_SQL} AS month, o_orderpriority AS priority, o_orderstatus AS status,
  sum({AMOUNT_SQL}) AS order_value FROM orders GROUP BY ALL),
t AS (SELECT month, status, sum(order_value) AS member_value FROM g
  WHERE priority = '1-URGENT' GROUP BY ALL)
SELECT g.month, priority, g.status, CAST(order_value AS DOUBLE) AS order_value,
  CAST(member_value AS DOUBLE) AS member_value, {_pct("order_value", "member_value", 4)} AS pct_of_member
FROM g LEFT JOIN t ON g.month = t.month AND g.status = t.status""",
)
def share_of_member(spark, sf_dir):
    groups = (
        table(spark, sf_dir, "orders")
        .groupBy(_order_month(), F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))
        .agg(F.sum(money("o_totalprice")).alias("order_value"))
    )
    return doubles(
        group_share(
            groups, "order_value", ["month", "status"], total="member_value",
            share="pct_of_member", member=F.col("priority") == "1-URGENT",
        )
    )


@check(
    "q34_row_level_share",
    f"""WITH r AS (SELECT o_orderkey, {MONTH_SQL} AS month, o_orderpriority AS priority,
  {AMOUNT_SQL} AS order_value FROM orders),
t AS (SELECT month, priority, sum(order_value) AS group_value FROM r GROUP BY ALL)
SELECT o_orderkey, r.month, r.priority, CAST(order_value AS DOUBLE) AS order_value,
  CAST(group_value AS DOUBLE) AS group_value, {_pct("order_value", "group_value", 4)} AS pct_of_group
FROM r LEFT JOIN t ON r.month = t.month AND r.priority = t.priority""",
)
def row_level_share(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", _order_month(), F.col("o_orderpriority").alias("priority"),
        money("o_totalprice").alias("order_value"),
    )
    return doubles(
        row_share(
            rows, "order_value", ["month", "priority"], total="group_value", share="pct_of_group"
        )
    )


@check(
    "q35_share_with_distinct_customers",
    f"""WITH g AS (SELECT year(o_orderdate) AS year, n_name AS nation, c_mktsegment AS segment,
  sum({AMOUNT_SQL}) AS order_value, count(DISTINCT o_custkey) AS customers
FROM {_ORDERS_SQL} GROUP BY ALL),
t AS (SELECT year, segment, sum(order_value) AS segment_value FROM g GROUP BY ALL)
SELECT CAST(g.year AS INTEGER) AS year, nation, g.segment, CAST(order_value AS DOUBLE) AS order_value,
  customers, CAST(segment_value AS DOUBLE) AS segment_value,
  {_pct("order_value", "segment_value", 4)} AS pct_of_segment
FROM g LEFT JOIN t ON g.year = t.year AND g.segment = t.segment""",
)
def share_with_customers(spark, sf_dir):
    keys = ["year", "nation", "segment"]
    by_customer = (
        _orders_by_nation(spark, sf_dir)
        .groupBy(
            F.year("o_orderdate").alias("year"), F.col("n_name").alias("nation"),
            F.col("c_mktsegment").alias("segment"), "o_custkey",
        )
        .agg(F.sum(money("o_totalprice")).alias("_value"))
    )
    groups = by_customer.groupBy(*keys).agg(
        F.sum("_value").alias("order_value"), F.count("o_custkey").alias("customers")
    )
    return doubles(
        group_share(
            groups, "order_value", ["year", "segment"], total="segment_value", share="pct_of_segment"
        )
    )


@check(
    "q36_two_level_share",
    f"""WITH g AS (SELECT n_name AS nation, l_returnflag AS flag, sum({PRICE_SQL}) AS line_value
FROM {_LINES_SQL} GROUP BY ALL),
t AS (SELECT flag, sum(line_value) AS flag_value FROM g GROUP BY ALL)
SELECT nation, g.flag, CAST(line_value AS DOUBLE) AS line_value,
  CAST(flag_value AS DOUBLE) AS flag_value, {_pct("line_value", "flag_value", 4)} AS pct_of_flag
FROM g LEFT JOIN t ON g.flag = t.flag""",
)
def two_level_share(spark, sf_dir):
    groups = (
        _lines_by_nation(spark, sf_dir)
        .groupBy(F.col("n_name").alias("nation"), F.col("l_returnflag").alias("flag"))
        .agg(F.sum(money("l_extendedprice")).alias("line_value"))
    )
    return doubles(
        group_share(groups, "line_value", ["flag"], total="flag_value", share="pct_of_flag")
    )


# ------------------------------------------------------------------ pivots


@check(
    "q03_returnflag_columns",
    """SELECT CAST(year(l_shipdate) AS INTEGER) AS year,
  sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS qty_accepted,
  sum(l_quantity) FILTER (WHERE l_returnflag = 'N') AS qty_none,
  sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS qty_returned
FROM lineitem GROUP BY 1""",
)
def returnflag_columns(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate"))
    return pivot_named(
        rows, ["year"], "l_returnflag", "l_quantity",
        {"A": "qty_accepted", "N": "qty_none", "R": "qty_returned"},
    )


@check(
    "q04_status_columns_with_balance",
    f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, n_name AS nation,
  CAST(sum({AMOUNT_SQL}) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS filled,
  CAST(sum({AMOUNT_SQL}) FILTER (WHERE o_orderstatus = 'O') AS DOUBLE) AS open,
  CAST(sum({AMOUNT_SQL}) FILTER (WHERE o_orderstatus = 'P') AS DOUBLE) AS partial,
  CAST(sum({AMOUNT_SQL}) FILTER (WHERE o_orderstatus = 'F')
    - sum({AMOUNT_SQL}) FILTER (WHERE o_orderstatus = 'O') AS DOUBLE) AS balance
FROM {_ORDERS_SQL} WHERE o_orderstatus IN ('F', 'O', 'P') GROUP BY 1, 2""",
)
def status_columns(spark, sf_dir):
    rows = _orders_by_nation(spark, sf_dir).select(
        F.year("o_orderdate").alias("year"), F.col("n_name").alias("nation"), "o_orderstatus",
        money("o_totalprice").alias("amount"),
    )
    wide = pivot_named(
        rows, ["year", "nation"], "o_orderstatus", "amount",
        {"F": "filled", "O": "open", "P": "partial"},
    )
    return doubles(wide.withColumn("balance", F.col("filled") - F.col("open")))


_PRIORITIES = {
    "1-URGENT": "URGENT", "2-HIGH": "HIGH", "3-MEDIUM": "MEDIUM",
    "4-NOT SPECIFIED": "NOT SPECIFIED", "5-LOW": "LOW",
}
_PRIORITY_SUMS = ", ".join(
    f"sum({AMOUNT_SQL}) FILTER (WHERE o_orderpriority = '{code}') AS \"{name}\""
    for code, name in _PRIORITIES.items()
)


def _priority_groups(spark, sf_dir):
    """Year and priority sums, computed once: both the codes and the pivot come from them."""
    return keep(
        table(spark, sf_dir, "orders")
        .groupBy(
            F.year("o_orderdate").alias("year"),
            F.substring("o_orderpriority", 3, 20).alias("priority"),
        )
        .agg(F.sum(money("o_totalprice")).alias("amount"))
    )


@check(
    "q05_discovered_columns_with_shares",
    f"""WITH g AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, {_PRIORITY_SUMS}
FROM orders GROUP BY 1)
SELECT year, """
    + ", ".join(f'CAST("{name}" AS DOUBLE) AS "{name}"' for name in _PRIORITIES.values())
    + ", "
    + ", ".join(
        f'{_pct(chr(34) + name + chr(34), "HIGH", 2)} AS "{name.lower()}_pct"'
        for name in _PRIORITIES.values()
        if name != "HIGH"
    )
    + " FROM g",
)
def discovered_with_shares(spark, sf_dir):
    return doubles(
        pivot_share(_priority_groups(spark, sf_dir), ["year"], "priority", "amount", "HIGH")
    )


@check(
    "q37b_discovered_columns",
    f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, """
    + _PRIORITY_SUMS.replace("sum(CAST", "CAST(sum(CAST").replace("') AS", "') AS DOUBLE) AS")
    + " FROM orders GROUP BY ALL",
)
def discovered_columns(spark, sf_dir):
    groups = keep(
        table(spark, sf_dir, "orders")
        .groupBy(
            F.year("o_orderdate").alias("year"), "o_orderstatus",
            F.substring("o_orderpriority", 3, 20).alias("priority"),
        )
        .agg(F.sum(money("o_totalprice")).alias("amount"))
    )
    return doubles(pivot_discovered(groups, ["year", "o_orderstatus"], "priority", "amount"))


_SEGMENT_FUELS = {"AUTOMOBILE": "CO", "BUILDING": "NG", "FURNITURE": "TE", "HOUSEHOLD": "WY", "MACHINERY": "ZZ"}
_FUEL_SUMS = ", ".join(
    f"CAST(sum({AMOUNT_SQL}) FILTER (WHERE c_mktsegment = '{segment}') AS DOUBLE) AS \"{fuel}\""
    for segment, fuel in _SEGMENT_FUELS.items()
)
_FUEL_LABELS = {
    "CO": "Coal", "NG": "Natural Gas", "TE": "Total Energy (All Sources)", "WY": "Wind Energy",
    "ZZ": "Zz", "co_pct": "Coal (% of Total)", "ng_pct": "Natural Gas (% of Total)",
    "wy_pct": "Wind Energy (% of Total)", "zz_pct": "ZZ (% of Total)",
}


@check(
    "q25_labelled_long_fuel_mix",
    f"""WITH g AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, {_FUEL_SUMS}
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1),
w AS (SELECT *, {_pct("CO", "TE", 2)} AS co_pct, {_pct("NG", "TE", 2)} AS ng_pct,
  {_pct("WY", "TE", 2)} AS wy_pct, {_pct("ZZ", "TE", 2)} AS zz_pct FROM g)
"""
    + " UNION ALL ".join(
        f"SELECT year, '{name}' AS metric, \"{name}\" AS amount, '{label}' AS metric_label FROM w"
        for name, label in _FUEL_LABELS.items()
    ),
)
def labelled_long(spark, sf_dir):
    groups = keep(
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(
            F.year("o_orderdate").alias("year"),
            lookup(_SEGMENT_FUELS, F.col("c_mktsegment")).alias("fuel"),
        )
        .agg(F.sum(money("o_totalprice")).alias("amount"))
    )
    wide = doubles(pivot_share(groups, ["year"], "fuel", "amount", "TE"))
    labels = {name: column_label(name) for name in wide.columns if name != "year"}
    return unpivot_labelled(wide, ["year"], labels, "metric", "amount")


# ------------------------------------------------------------------ changes and statistics


@check(
    "q06_nation_year_change",
    f"""WITH g AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, n_name AS nation,
  sum({AMOUNT_SQL}) AS order_value FROM {_ORDERS_SQL} GROUP BY ALL),
t AS (SELECT year, sum(order_value) AS year_value FROM g GROUP BY ALL),
p AS (SELECT *, lag(order_value) OVER (PARTITION BY nation ORDER BY year NULLS FIRST) AS previous FROM g)
SELECT p.year, nation, CAST(order_value AS DOUBLE) AS order_value,
  CAST(year_value AS DOUBLE) AS year_value, {_pct("order_value", "year_value", 4)} AS pct_of_year,
  CAST(order_value - previous AS DOUBLE) AS yoy_change,
  {_pct("(order_value - previous)", "previous", 2)} AS yoy_change_pct
FROM p LEFT JOIN t ON p.year = t.year""",
)
def nation_year_change(spark, sf_dir):
    groups = (
        _orders_by_nation(spark, sf_dir)
        .groupBy(F.year("o_orderdate").alias("year"), F.col("n_name").alias("nation"))
        .agg(F.sum(money("o_totalprice")).alias("order_value"))
    )
    shares = group_share(groups, "order_value", ["year"], total="year_value", share="pct_of_year")
    return doubles(
        change_from_previous(
            shares, ["nation"], "year", "order_value",
            change="yoy_change", change_pct="yoy_change_pct",
        )
    )


@check(
    "q37_change_in_three_column_series",
    f"""WITH g AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag, l_linestatus,
  n_name AS nation, sum({PRICE_SQL}) AS line_value FROM {_LINES_SQL} GROUP BY ALL),
p AS (SELECT *, lag(line_value) OVER w AS previous, lag(year) OVER w AS previous_year FROM g
  WINDOW w AS (PARTITION BY l_returnflag, l_linestatus, nation ORDER BY year NULLS FIRST))
SELECT year, l_returnflag, l_linestatus, nation, CAST(line_value AS DOUBLE) AS line_value,
  CAST(line_value - previous AS DOUBLE) AS change,
  {_pct("(line_value - previous)", "previous", 2)} AS change_pct FROM p""",
)
def three_column_change(spark, sf_dir):
    groups = (
        _lines_by_nation(spark, sf_dir)
        .groupBy(
            F.year("l_shipdate").alias("year"), "l_returnflag", "l_linestatus",
            F.col("n_name").alias("nation"),
        )
        .agg(F.sum(money("l_extendedprice")).alias("line_value"))
    )
    return doubles(
        change_from_previous(
            groups, ["l_returnflag", "l_linestatus", "nation"], "year", "line_value",
            change="change", change_pct="change_pct",
        )
    )


@check(
    "q08b_distinct_customers_by_level",
    f"""WITH g AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, n_name AS nation, o_orderpriority AS priority,
  o_custkey FROM {_ORDERS_SQL})
SELECT year, nation, priority, count(DISTINCT o_custkey) AS customers FROM g
GROUP BY GROUPING SETS ((year, nation, priority), (year, nation), (nation, priority), (year), ())""",
)
def distinct_customers_by_level(spark, sf_dir):
    """One pass over the orders; the coarser levels unite the stored bitmaps of the finest."""
    orders = _orders_by_nation(spark, sf_dir).select(
        F.year("o_orderdate").alias("year"), F.col("n_name").alias("nation"),
        F.col("o_orderpriority").alias("priority"), "o_custkey",
    )
    finest = ["year", "nation", "priority"]
    stored = stored_bitmaps(orders, finest, "o_custkey")
    types = dict(stored.dtypes)
    levels = [
        distinct_counts(stored, keys, "customers").select(
            *[F.col(k) if k in keys else F.lit(None).cast(types[k]).alias(k) for k in finest], "customers"
        )
        for keys in (finest, ["year", "nation"], ["nation", "priority"], ["year"], [])
    ]
    return reduce(DataFrame.unionByName, levels)


@check(
    "q37d_change_in_one_long_series",
    f"""WITH g AS (SELECT CAST(l_shipdate AS DATE) AS day, l_orderkey, l_linenumber, {PRICE_SQL} AS price
  FROM lineitem),
p AS (SELECT *, lag(price) OVER (ORDER BY day NULLS FIRST, l_orderkey NULLS FIRST,
  l_linenumber NULLS FIRST, price NULLS FIRST) AS previous FROM g)
SELECT day, l_orderkey, l_linenumber, CAST(price AS DOUBLE) AS price,
  CAST(price - previous AS DOUBLE) AS change, {_pct("(price - previous)", "previous", 2)} + 0.0 AS change_pct FROM p""",
)
def one_long_series(spark, sf_dir):
    """Every line item against the one shipped before it: one series over all rows."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("day"), "l_orderkey", "l_linenumber", money("l_extendedprice").alias("price")
    )
    return doubles(
        change_in_long_series(
            rows, [], "day", "price", change="change", change_pct="change_pct",
            ties=("l_orderkey", "l_linenumber"),
        )
    )


@check(
    "q37e_change_between_neighbouring_months",
    f"""WITH g AS (SELECT CAST(year(l_shipdate) * 12 + month(l_shipdate) AS INTEGER) AS month_number, l_suppkey,
  sum({PRICE_SQL}) AS line_value FROM lineitem GROUP BY ALL),
p AS (SELECT *, CASE WHEN month_number - lag(month_number) OVER w = 1 THEN lag(line_value) OVER w END AS previous
  FROM g WINDOW w AS (PARTITION BY l_suppkey ORDER BY month_number NULLS FIRST))
SELECT month_number, l_suppkey, CAST(line_value AS DOUBLE) AS line_value,
  CAST(line_value - previous AS DOUBLE) AS change, {_pct("(line_value - previous)", "previous", 2)} AS change_pct FROM p""",
)
def change_between_neighbouring_months(spark, sf_dir):
    """A supplier's month against the month before, if it has one: gaps leave the change NULL."""
    month_number = (F.year("l_shipdate") * 12 + F.month("l_shipdate")).alias("month_number")
    groups = (
        table(spark, sf_dir, "lineitem").groupBy(month_number, "l_suppkey")
        .agg(F.sum(money("l_extendedprice")).alias("line_value"))
    )
    return doubles(
        change_from_previous(
            groups, ["l_suppkey"], "month_number", "line_value",
            change="change", change_pct="change_pct", consecutive_only=True,
        )
    )


@check(
    "q07_price_statistics",
    f"""WITH g AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag, l_linestatus,
  n_name AS nation, sum(CAST(l_quantity AS DECIMAL(18,2))) AS quantity,
  CAST(sum({PRICE_SQL}) AS DOUBLE) / count(l_extendedprice) AS avg_price,
  min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price
FROM {_LINES_SQL} GROUP BY ALL),
t AS (SELECT year, l_returnflag, sum(quantity) AS flag_quantity FROM g GROUP BY ALL)
SELECT g.* REPLACE (CAST(quantity AS DOUBLE) AS quantity),
  CAST(flag_quantity AS DOUBLE) AS flag_quantity, {_pct("quantity", "flag_quantity", 4)} AS pct_of_flag
FROM g LEFT JOIN t ON g.year = t.year AND g.l_returnflag = t.l_returnflag""",
)
def price_statistics(spark, sf_dir):
    groups = keep(
        _lines_by_nation(spark, sf_dir)
        .groupBy(
            F.year("l_shipdate").alias("year"), "l_returnflag", "l_linestatus",
            F.col("n_name").alias("nation"),
        )
        .agg(
            F.sum(money("l_quantity")).alias("quantity"),
            mean(money("l_extendedprice")).alias("avg_price"),
            F.min("l_extendedprice").alias("min_price"),
            F.max("l_extendedprice").alias("max_price"),
        )
    )
    return doubles(
        group_share(
            groups, "quantity", ["year", "l_returnflag"],
            total="flag_quantity", share="pct_of_flag",
        )
    )


@check(
    "q08_two_distinct_counts",
    """SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag,
  count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers,
  min(l_quantity) AS min_quantity, max(l_quantity) AS max_quantity
FROM lineitem GROUP BY ALL""",
)
def two_distinct_counts(spark, sf_dir):
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.year("l_shipdate").alias("year"), "l_returnflag")
        .agg(
            F.countDistinct("l_partkey").alias("parts"),
            F.countDistinct("l_suppkey").alias("suppliers"),
            F.min("l_quantity").alias("min_quantity"),
            F.max("l_quantity").alias("max_quantity"),
        )
    )


@check(
    "q38_grouped_sum_sorted",
    f"""SELECT {MONTH_SQL} AS month, c_mktsegment AS segment, n_name AS nation,
  CAST(sum({AMOUNT_SQL}) AS DOUBLE) AS order_value
FROM {_ORDERS_SQL} GROUP BY ALL ORDER BY month, segment, order_value DESC, nation""",
)
def grouped_sum_sorted(spark, sf_dir):
    return doubles(
        _orders_by_nation(spark, sf_dir)
        .groupBy(_order_month(), F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation"))
        .agg(F.sum(money("o_totalprice")).alias("order_value"))
    ).orderBy("month", "segment", F.desc("order_value"), "nation")


# ------------------------------------------------------------------ row-level functions


@check(
    "q09_labels_with_and_without_fallback",
    """SELECT CASE event_type WHEN 'view' THEN 'Viewed' WHEN 'click' THEN 'Clicked' END AS label,
  CASE event_type WHEN 'view' THEN 'Viewed' WHEN 'click' THEN 'Clicked' ELSE trim(event_type) END
    AS label_or_code, count(*) AS n FROM events GROUP BY ALL""",
)
def labels(spark, sf_dir):
    known = {"view": "Viewed", "click": "Clicked"}
    code = F.col("event_type")
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            lookup(known, code).alias("label"),
            lookup(known, code, F.trim(code)).alias("label_or_code"),
        )
        .agg(F.count("*").alias("n"))
    )


@check(
    "q10_code_parts",
    f"""SELECT substr(o_orderpriority, 1, 1) AS level, substr(o_orderpriority, 3, 2) AS word,
  substr(o_orderpriority, 5, 1) AS letter, count(*) AS n, CAST(sum({AMOUNT_SQL}) AS DOUBLE) AS amount
FROM orders GROUP BY ALL""",
)
def code_parts(spark, sf_dir):
    return doubles(
        table(spark, sf_dir, "orders")
        .groupBy(
            code_part("o_orderpriority", 1, 1).alias("level"),
            code_part("o_orderpriority", 3, 2).alias("word"),
            code_part("o_orderpriority", 5, 1).alias("letter"),
        )
        .agg(F.count("*").alias("n"), F.sum(money("o_totalprice")).alias("amount"))
    )


@check(
    "q11_union_then_distinct",
    """SELECT l_orderkey, count(*) AS n FROM (
  SELECT l_orderkey, l_linenumber FROM lineitem
  UNION SELECT l_orderkey, l_linenumber FROM lineitem) GROUP BY l_orderkey""",
)
def union_distinct(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return (
        distinct_rows(rows.unionByName(rows)).groupBy("l_orderkey").agg(F.count("*").alias("n"))
    )


@check(
    "q12_filters",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderpriority IS NOT NULL AND NOT starts_with(o_orderpriority, '5')
  AND regexp_matches(o_orderpriority, '^[1-4]-[A-Z]{3}') AND o_orderstatus <> 'P'
  AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND o_orderstatus = 'F'""",
)
def filters(spark, sf_dir):
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    return (
        table(spark, sf_dir, "orders")
        .where(priority.isNotNull() & ~priority.startswith("5"))
        .where(priority.rlike("^[1-4]-[A-Z]{3}"))
        .where((status != "P") & priority.isin("1-URGENT", "2-HIGH", "3-MEDIUM"))
        .where(status == "F")
        .select("o_orderkey", "o_orderstatus", "o_orderpriority")
    )


@check(
    "q13_presence",
    """WITH r AS (SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'N') AS flag,
  nullif(l_linestatus, 'O') AS status, nullif(l_discount, 0) AS discount, nullif(l_tax, 0) AS tax FROM lineitem)
SELECT *, flag IS NOT NULL OR status IS NOT NULL AS either_text FROM r
WHERE coalesce(CAST(discount AS VARCHAR), CAST(tax AS VARCHAR), flag) IS NOT NULL""",
)
def presence(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif("l_returnflag", F.lit("N")).alias("flag"),
        F.nullif("l_linestatus", F.lit("O")).alias("status"),
        F.nullif("l_discount", F.lit(0.0)).alias("discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("tax"),
    )
    return rows.where(any_present("discount", "tax", "flag")).withColumn(
        "either_text", any_present("flag", "status")
    )


_TEXT_SQL = """SELECT o_orderkey,
  (' ' || CASE o_orderstatus WHEN 'P' THEN (substr(CAST(o_orderdate AS VARCHAR), 1, 4) || '-13')
    ELSE substr(CAST(o_orderdate AS VARCHAR), 1, 7) END) AS month_text,
  substr(CAST(o_orderdate AS VARCHAR), 1, 10) AS day_text,
  substr(CAST(o_orderdate AS VARCHAR), 1, 4) AS year_text,
  CASE o_orderpriority WHEN '5-LOW' THEN 'NA'
    ELSE (' ' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || ' ') END AS amount_text
FROM orders"""


@check(
    "q14_parsing",
    f"""SELECT o_orderkey, CAST(try_strptime(trim(month_text), '%Y-%m') AS DATE) AS month,
  CAST(try_strptime(day_text, '%Y-%m-%d') AS DATE) AS day, TRY_CAST(year_text AS INTEGER) AS year,
  TRY_CAST(trim(amount_text) AS DOUBLE) AS amount,
  CAST(trunc(TRY_CAST(trim(amount_text) AS DOUBLE)) AS INTEGER) AS whole_amount,
  try_strptime(trim(month_text), '%Y-%m') IS NOT NULL AS dated
FROM ({_TEXT_SQL}) WHERE TRY_CAST(trim(amount_text) AS DOUBLE) IS NOT NULL""",
)
def parsing(spark, sf_dir):
    date_text = F.col("o_orderdate").cast("string")
    year = F.substring(date_text, 1, 4)
    texts = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(
            F.lit(" "),
            F.when(F.col("o_orderstatus") == "P", F.concat(year, F.lit("-13"))).otherwise(
                F.substring(date_text, 1, 7)
            ),
        ).alias("month_text"),
        F.substring(date_text, 1, 10).alias("day_text"),
        year.alias("year_text"),
        F.when(F.col("o_orderpriority") == "5-LOW", "NA")
        .otherwise(F.concat(F.lit(" "), money("o_totalprice").cast("string"), F.lit(" ")))
        .alias("amount_text"),
    )
    typed = texts.select(
        "o_orderkey",
        month_start(trimmed("month_text")).alias("month"),
        day("day_text").alias("day"),
        year_number("year_text").alias("year"),
        number("amount_text").alias("amount"),
        whole("amount_text").alias("whole_amount"),
    )
    return typed.where(any_present("amount")).withColumn("dated", F.col("month").isNotNull())


@check(
    "q25b_period_labels",
    """SELECT strftime(o_orderdate, '%B %Y') AS month_label,
  'Week ' || CAST(week(o_orderdate) AS VARCHAR) || ', ' || CAST(isoyear(o_orderdate) AS VARCHAR) AS week_label,
  CAST(year(o_orderdate) AS VARCHAR) AS year_label, count(*) AS n FROM orders GROUP BY ALL""",
)
def period_labels(spark, sf_dir):
    date = F.col("o_orderdate").cast("date")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            period_label(MONTHLY, date).alias("month_label"),
            period_label(WEEKLY, date).alias("week_label"),
            period_label(ANNUAL, year=F.year(date)).alias("year_label"),
        )
        .agg(F.count("*").alias("n"))
    )


_SPELLINGS = {
    0: "California", 1: "TEXAS", 2: "USA-NM", 3: "NM", 4: "R20", 5: "NUS", 6: "Baltimore, MD",
    7: "DISTRICT OF COLUMBIA", 8: "ZZ", 9: "USA-ZZ", 10: "  ", 11: " ohio ", 12: "new york",
    13: "USA-TX", 14: "texas",
}
_SPELLED_SQL = " ".join(f"WHEN {key} THEN '{text}'" for key, text in _SPELLINGS.items())
_PLACES = {
    "California": "California", "TEXAS": "Texas", "USA-NM": "New Mexico", "NM": "New Mexico",
    "R20": "PADD 2 (Midwest)", "NUS": "U.S. Total", " ohio ": "Ohio", "new york": "New York",
    "USA-TX": "Texas", "texas": "Texas",
}
_PLACE_SQL = " ".join(f"WHEN '{raw}' THEN '{name}'" for raw, name in _PLACES.items())


@check(
    "q24_place_names",
    f"""WITH r AS (SELECT CASE n_nationkey {_SPELLED_SQL} END AS raw, n_name,
  {AMOUNT_SQL} AS amount FROM {_ORDERS_SQL}),
p AS (SELECT CASE coalesce(raw, n_name) {_PLACE_SQL} ELSE trim(coalesce(raw, n_name)) END AS state, amount FROM r)
SELECT state, CASE state WHEN 'California' THEN 'CA' WHEN 'Texas' THEN 'TX' WHEN 'New Mexico' THEN 'NM'
  WHEN 'Ohio' THEN 'OH' WHEN 'New York' THEN 'NY' END AS state_abbrev,
  CAST(sum(amount) AS DOUBLE) AS amount FROM p GROUP BY ALL""",
)
def place_names(spark, sf_dir):
    rows = _orders_by_nation(spark, sf_dir).withColumn(
        "raw", lookup({str(k): v for k, v in _SPELLINGS.items()}, F.col("n_nationkey").cast("string"))
    )
    state = place_name(F.coalesce("raw", "n_name"))
    places = rows.groupBy(state.alias("state")).agg(F.sum(money("o_totalprice")).alias("amount"))
    return doubles(places.withColumn("state_abbrev", state_code(F.col("state"))))


# ------------------------------------------------------------------ time slices and choices

ORDERS_TABLE = TableSpec(
    name="order_values", label="Order values", path="order_values", place="nation",
    value="amount", value_label="Amount", unit="USD", grain=MONTHLY, category="Orders",
    extras={"orders": "Orders", "segment": "Segment"}, breakdown="segment",
    breakdown_value="amount", unique_rows=True,
)
EVENTS_TABLE = TableSpec(
    name="event_values", label="Event values", path="event_values", place="event_type",
    value="value", value_label="Value", unit="", grain=WEEKLY, category="Events", unique_rows=True,
)


def _order_rows(spark, sf_dir):
    rows = _orders_by_nation(spark, sf_dir).select(
        F.col("o_orderdate").cast("date").alias("period"), F.col("n_name").alias("nation"),
        F.col("c_mktsegment").alias("segment"), "o_orderkey", "o_custkey",
        money("o_totalprice").alias("amount"), F.lit(1).alias("orders"),
    )
    return serving.prepare(rows, ORDERS_TABLE)


_ORDER_ROWS_SQL = f"""SELECT CAST(o_orderdate AS DATE) AS period, n_name AS state,
  c_mktsegment AS segment, o_orderkey, o_custkey, {AMOUNT_SQL} AS amount FROM {_ORDERS_SQL}"""


def _event_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").alias("period"), "event_type", "event_id", "value"
    )
    return serving.prepare(rows, EVENTS_TABLE)


@check(
    "q15_iso_week_slice",
    """SELECT CAST(ts AS DATE) AS period, event_type AS state, event_id, "value",
  CAST(isoyear(ts) AS INTEGER) AS year, CAST(week(ts) AS INTEGER) AS week FROM events
WHERE isoyear(ts) = 2024 AND week(ts) = 3""",
)
def iso_week_slice(spark, sf_dir):
    return serving.time_slice(_event_rows(spark, sf_dir), EVENTS_TABLE, 2024, week=3)


@check(
    "q16_month_slice",
    f"""SELECT o_orderkey, state, CAST(amount AS DOUBLE) AS amount, 1997 AS year, 5 AS month
FROM ({_ORDER_ROWS_SQL}) WHERE year(period) = 1997 AND month(period) = 5""",
)
def month_slice(spark, sf_dir):
    rows = serving.time_slice(_order_rows(spark, sf_dir), ORDERS_TABLE, 1997, month=5)
    return doubles(rows.select("o_orderkey", "state", "amount", "year", "month"))


@check(
    "q17_choices",
    """SELECT DISTINCT 'year' AS kind, CAST(year(o_orderdate) AS INTEGER) AS choice FROM orders WHERE o_orderdate IS NOT NULL
UNION ALL SELECT DISTINCT 'month', CAST(month(o_orderdate) AS INTEGER) FROM orders WHERE o_orderdate IS NOT NULL
UNION ALL SELECT DISTINCT 'week', CAST(week(o_orderdate) AS INTEGER) FROM orders WHERE o_orderdate IS NOT NULL
UNION ALL SELECT DISTINCT 'iso_year', CAST(isoyear(o_orderdate) AS INTEGER) FROM orders WHERE o_orderdate IS NOT NULL""",
)
def choices(spark, sf_dir):
    days = F.col("o_orderdate").cast("date").alias("period")
    dates = keep(table(spark, sf_dir, "orders").select(days).distinct())
    monthly = dates.withColumns(calendar_columns(F.col("period"), MONTHLY))
    weekly = dates.withColumns(calendar_columns(F.col("period"), WEEKLY)).withColumnRenamed(
        "year", "iso_year"
    )
    lists = [
        serving.choices(rows, column).select(F.lit(column).alias("kind"), F.col(column).alias("choice"))
        for rows, column in (
            (monthly, "year"), (monthly, "month"), (weekly, "week"), (weekly, "iso_year")
        )
    ]
    return lists[0].unionByName(lists[1]).unionByName(lists[2]).unionByName(lists[3])


# ------------------------------------------------------------------ top lists, rankings, trends


@check(
    "q18_top_parts",
    f"""SELECT p_name, CAST(coalesce(sum({PRICE_SQL}), 0) AS DOUBLE) AS amount
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name
ORDER BY amount DESC, p_name LIMIT 15""",
)
def top_parts(spark, sf_dir):
    rows = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select("p_name", money("l_extendedprice").alias("amount"))
    )
    return doubles(top_n(sum_by(rows, ["p_name"], "amount"), "amount", 15, ["p_name"]))


@check(
    "q19_top_parts_per_nation",
    f"""SELECT * FROM (SELECT *, CAST(row_number() OVER (
  PARTITION BY nation ORDER BY amount DESC, l_partkey) AS INTEGER) AS position
FROM (SELECT n_name AS nation, l_partkey, CAST(coalesce(sum({PRICE_SQL}), 0) AS DOUBLE) AS amount
  FROM {_LINES_SQL} GROUP BY ALL)) WHERE position <= 10""",
)
def top_parts_per_nation(spark, sf_dir):
    rows = _lines_by_nation(spark, sf_dir).select(
        F.col("n_name").alias("nation"), "l_partkey", money("l_extendedprice").alias("amount")
    )
    groups = sum_by(rows, ["nation", "l_partkey"], "amount")
    return doubles(top_n_per(groups, ["nation"], "amount", 10, ["l_partkey"]))


@check(
    "q20_trend",
    f"""SELECT {MONTH_SQL} AS period, CAST(coalesce(sum({AMOUNT_SQL}), 0) AS DOUBLE) AS amount
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1 ORDER BY 1""",
)
def trend(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.trunc("o_orderdate", "month").alias("period"), money("o_totalprice").alias("amount")
    )
    return doubles(serving.trend(rows, ORDERS_TABLE, "amount"))


@check(
    "q21_trend_of_one_place",
    f"""SELECT period, CAST(coalesce(sum(amount), 0) AS DOUBLE) AS amount FROM ({_ORDER_ROWS_SQL})
WHERE state = 'NATION_3' AND period IS NOT NULL GROUP BY period ORDER BY period""",
)
def trend_of_place(spark, sf_dir):
    rows = _order_rows(spark, sf_dir)
    return doubles(serving.trend(rows, ORDERS_TABLE, "amount", place="NATION_3"))


@check(
    "q22_full_ranking",
    f"""SELECT o_custkey, amount, row_number() OVER (ORDER BY amount DESC, o_custkey) AS position
FROM (SELECT o_custkey, CAST(coalesce(sum({AMOUNT_SQL}), 0) AS DOUBLE) AS amount FROM orders GROUP BY 1)""",
)
def full_ranking(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", money("o_totalprice").alias("amount"))
    groups = sum_by(rows, ["o_custkey"], "amount")
    return doubles(rank_all(groups, [F.desc("amount"), F.asc("o_custkey")]))


@check(
    "q23_snapshot",
    f"""SELECT CAST(coalesce(sum(amount), 0) AS DOUBLE) AS amount, CAST(count(*) AS BIGINT) AS orders,
  min(segment) AS segment
FROM ({_ORDER_ROWS_SQL}) WHERE state = 'NATION_5' AND year(period) = 1999""",
)
def snapshot(spark, sf_dir):
    rows = serving.time_slice(_order_rows(spark, sf_dir), ORDERS_TABLE, 1999)
    return doubles(serving.snapshot(rows, ORDERS_TABLE, "NATION_5"))


@check(
    "q23b_breakdown_of_one_place",
    f"""SELECT segment, CAST(sum(amount) AS DOUBLE) AS amount FROM ({_ORDER_ROWS_SQL})
WHERE state = 'NATION_5' AND year(period) = 1999 GROUP BY segment
ORDER BY amount DESC, segment LIMIT 10""",
)
def breakdown_of_place(spark, sf_dir):
    rows = serving.time_slice(_order_rows(spark, sf_dir), ORDERS_TABLE, 1999)
    return doubles(serving.breakdown(rows, ORDERS_TABLE, place="NATION_5"))


_LINE_METRICS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@check(
    "q32_all_numeric_metrics",
    "WITH s AS (SELECT l_returnflag, "
    + ", ".join(
        f"CAST(sum(CAST({name} AS DECIMAL(18,2))) AS DOUBLE) AS {name}"
        for name in ("l_linenumber", *_LINE_METRICS)
    )
    + " FROM lineitem GROUP BY l_returnflag)\n"
    + " UNION ALL ".join(
        f"SELECT l_returnflag, '{name}' AS metric, {name} AS total, '{label}' AS metric_label FROM s"
        for name, label in {
            "l_linenumber": "L Linenumber", "l_quantity": "L Quantity",
            "l_extendedprice": "L Extendedprice", "l_discount": "L Discount", "l_tax": "L Tax",
        }.items()
    ),
)
def all_numeric_metrics(spark, sf_dir):
    """Metrics found in the schema, as for a table without a declared value."""
    lines = table(spark, sf_dir, "lineitem")
    spec = TableSpec(
        name="lines", label="Lines", path="lines", place=None, value=None, value_label=None,
        unit="", grain=ANNUAL, category="Lines",
    )
    keys = [name for name in numeric_columns(lines) if name.endswith("key")]
    found = {name: label for label, name in serving.metrics(lines.drop(*keys), spec).items()}
    sums = doubles(
        lines.groupBy("l_returnflag").agg(*[F.sum(money(name)).alias(name) for name in found])
    )
    return unpivot_labelled(sums, ["l_returnflag"], found, "metric", "total")


# ------------------------------------------------------------------ incremental loads, files


@check(
    "q26_rows_since_step_back",
    f"""WITH r AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS period,
  CAST({AMOUNT_SQL} AS DOUBLE) AS amount FROM orders)
SELECT * FROM r WHERE period >= (SELECT strftime(max(CAST(period || '-01' AS DATE)) - INTERVAL 2 MONTH, '%Y-%m') FROM r)""",
)
def rows_since_step_back(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(
        "o_orderkey", "o_orderdate", F.date_format("o_orderdate", "yyyy-MM").alias("period"),
        money("o_totalprice").cast("double").alias("amount"),
    )
    start = (
        latest_period(rows)
        .select(F.to_date(step_back(F.col("latest"), MONTHLY, "2 months"), "yyyy-MM"))
        .first()[0]
    )
    return within_range(rows, "o_orderdate", start).drop("o_orderdate")


@check(
    "q27_load_periods",
    """WITH r AS (SELECT c_mktsegment AS segment, min(o_orderdate) AS first, max(o_orderdate) AS last
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
SELECT segment, 'monthly' AS grain, strftime(m, '%Y-%m') AS period FROM r,
  unnest(generate_series(date_trunc('month', first), date_trunc('month', last), INTERVAL 1 MONTH)) AS u(m)
UNION ALL SELECT segment, 'annual', CAST(y AS VARCHAR) FROM r,
  unnest(generate_series(year(first), year(last))) AS u(y)""",
)
def load_period_list(spark, sf_dir):
    days = F.col("o_orderdate").cast("date")
    ranges = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_mktsegment").alias("segment"))
        .agg(F.min(days).cast("string").alias("first"), F.max(days).cast("string").alias("last"))
    )
    lists = [
        ranges.select(
            "segment", F.lit(grain).alias("grain"),
            F.explode(load_periods(F.col("first"), F.col("last"), grain)).alias("period"),
        )
        for grain in (MONTHLY, ANNUAL)
    ]
    return lists[0].unionByName(lists[1])


@check(
    "q28_latest_revision",
    """SELECT * EXCLUDE (rn) REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
  l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem) WHERE rn = 1""",
)
def newest_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "l_shipdate", F.col("l_shipdate").cast("date")
    )
    return latest_revision(lines, ["l_orderkey", "l_linenumber"], [F.desc("l_shipdate")])


@check(
    "q29_records_of_pages",
    """SELECT event_type, count(*) AS records,
  CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS total
FROM events GROUP BY 1""",
)
def page_records(spark, sf_dir):
    page = F.concat(F.lit('{"response":{"total":"1","data":['), "props", F.lit("]}}"))
    schema = "response struct<total: string, data: array<map<string, string>>>"
    pages = table(spark, sf_dir, "events").select(
        F.from_json(page, schema).alias("page"), "event_type"
    )
    records = F.transform(
        F.col("page.response.data"),
        lambda record: F.map_concat(record, F.create_map(F.lit("event_type"), F.col("event_type"))),
    )
    return (
        explode_records(pages, records, ["event_type", "k"])
        .groupBy("event_type")
        .agg(F.count("*").alias("records"), F.sum(whole("k")).alias("total"))
    )


@check(
    "q29b_landed_page_files",
    """SELECT event_type, count(*) AS records,
  CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS total
FROM events GROUP BY 1""",
)
def landed_pages(spark, sf_dir):
    """Every event lands as a page of two records, one of which has none of the fields."""
    base = scratch_path(spark, "pages")
    record = F.struct("event_type", F.get_json_object("props", "$.k").alias("k"))
    other = F.struct(F.lit(None).cast("string").alias("event_type"), F.lit(None).cast("string").alias("k"))
    page = F.struct(F.lit("2").alias("total"), F.array(record, other).alias("data"))
    table(spark, sf_dir, "events").select(page.alias("response")).write.json(base)
    rows = read_pages(spark, base, ["event_type", "k"], one_per_line=True)
    return (
        rows.where(F.col("event_type").isNotNull())
        .groupBy("event_type")
        .agg(F.count("*").alias("records"), F.sum(whole("k")).alias("total"))
    )


_ROUND_TRIP_SQL = f"""SELECT strftime(o_orderdate, '%Y-%m') AS period, o_orderpriority AS priority,
  count(*) AS n, CAST(sum({AMOUNT_SQL}) AS DOUBLE) AS amount FROM orders GROUP BY ALL"""


def _order_extract(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("period"), "o_orderkey",
        F.col("o_orderpriority").alias("priority"), money("o_totalprice").cast("string").alias("value"),
    )


def _by_period(rows):
    return doubles(
        rows.groupBy("period", "priority").agg(
            F.count("*").alias("n"), F.sum(number("value", "decimal(18,2)")).alias("amount")
        )
    )


@check("q30_file_round_trip", _ROUND_TRIP_SQL)
def file_round_trip(spark, sf_dir):
    """Raw CSV in two column orders and an incremental folder that is not read, then Parquet."""
    base = scratch_path(spark, "round-trip")
    rows = _order_extract(spark, sf_dir)
    source = SOURCES["steo"]
    urgent = F.col("priority").eqNullSafe("1-URGENT")
    write_csv(rows.where(~urgent), raw_folder(base, source, "1995-01", "2001-08"))
    write_csv(
        rows.where(urgent).select("value", "priority", "period", "o_orderkey"),
        raw_folder(base, source, "1995-01", "2001-09"),
    )
    write_csv(rows, raw_folder(base, source, "2001-06", "2001-08", "20010815", incremental=True))
    raw = read_csv(spark, f"{base}/{source.raw_prefix}")
    write_table(raw, f"{base}/table", sort=("period", "-o_orderkey"))
    return _by_period(read_table(spark, f"{base}/table"))


@check(
    "q39_versions_of_a_table",
    f"""SELECT version, o_orderstatus, count(*) AS orders, CAST(sum({AMOUNT_SQL}) AS DOUBLE) AS amount
FROM (SELECT 'first' AS version, * FROM orders UNION ALL
  SELECT 'second', * FROM orders WHERE o_orderdate < '1998-01-01' OR o_orderstatus = 'F' UNION ALL
  SELECT 'third', * FROM orders WHERE o_orderdate < '1998-01-01' OR o_orderstatus = 'F') GROUP BY ALL""",
)
def versions_of_a_table(spark, sf_dir):
    """All orders; then years from 1998 replaced by their filled ones; then small parts merged.

    Each reader goes on with the version it has opened.
    """
    path = scratch_path(spark, "versions")
    orders = table(spark, sf_dir, "orders").withColumn("amount", money("o_totalprice"))
    year = F.year("o_orderdate")
    early = orders.where(year < 1998)
    snapshots.replace(orders.where((year >= 1998) | (F.col("o_orderkey") % 2 == 0)), path, year)
    written = snapshots.write_parts(early.where(F.col("o_orderkey") % 2 != 0), path, year)
    snapshots.commit(spark, path, written, snapshots.current(spark, path), append=True)
    opened = {"first": read_table(spark, path)}
    late = orders.where(year >= 1998)
    replaced = [str(row[0]) for row in late.select(year).distinct().collect()]
    snapshots.replace(late.where("o_orderstatus = 'F'"), path, year, replaced=replaced)
    opened["second"] = read_table(spark, path)
    snapshots.compact(spark, path)
    opened["third"] = read_table(spark, path)
    frames = [rows.select(F.lit(name).alias("version"), "o_orderstatus", "amount") for name, rows in opened.items()]
    return (
        frames[0].unionByName(frames[1]).unionByName(frames[2]).groupBy("version", "o_orderstatus")
        .agg(F.count("*").alias("orders"), F.sum("amount").cast("double").alias("amount"))
    )


@check(
    "q40_manifest_of_raw_files",
    f"""SELECT strftime(o_orderdate, '%Y-%m') AS period, o_orderpriority AS priority, count(*) AS n,
  CAST(sum({AMOUNT_SQL}) AS DOUBLE) AS amount,
  (SELECT strftime(max(o_orderdate), '%Y-%m') FROM orders) AS latest
FROM orders WHERE o_orderdate >= '1996-03-01' AND o_orderdate < '1997-06-01' GROUP BY ALL""",
)
def manifest_of_raw_files(spark, sf_dir):
    """A range of periods from extracts by year that landed in two goes, the second with other columns."""
    base, source = scratch_path(spark, "manifest"), SOURCES["steo"]
    root, stored = f"{base}/{source.raw_prefix}", f"{base}/manifest"
    rows = _order_extract(spark, sf_dir)
    for years, columns in (((1992, 1996), rows.columns), ((1996, 2002), rows.columns[::-1])):
        for year in map(str, range(*years)):
            landed = rows.where(F.col("period").startswith(year)).select(*columns)
            write_csv(landed, raw_folder(base, source, year, year))
        update_manifest(spark, root, stored)
    found = read_known(spark, stored, "1996-03", "1997-05")
    ranged = found.where(F.col("period").between("1996-03", "1997-05"))
    return _by_period(ranged).withColumn("latest", F.lit(latest_known_period(spark, stored)))


@check(
    "q41_ranges_still_to_load",
    """WITH months AS (
  SELECT unnest(generate_series(DATE '1991-11-01', DATE '2002-02-01', INTERVAL 1 MONTH)) AS month),
stored AS (SELECT DISTINCT date_trunc('month', o_orderdate) AS month FROM orders
  WHERE month(o_orderdate) % 5 <> 0 AND NOT (year(o_orderdate) = 1995 AND month(o_orderdate) IN (7, 8, 9))),
missing AS (SELECT month, row_number() OVER (ORDER BY month) AS n FROM months
  WHERE month NOT IN (SELECT month FROM stored)),
runs AS (SELECT month, CAST(month AS DATE) - to_months(CAST(n AS INTEGER)) AS run FROM missing)
SELECT strftime(min(month), '%Y-%m') AS start, strftime(max(month), '%Y-%m') AS "end", count(*) AS periods
FROM runs GROUP BY run""",
)
def ranges_still_to_load(spark, sf_dir):
    """Order months with planted gaps against the whole range."""
    month = F.month("o_orderdate")
    gap = (F.year("o_orderdate") == 1995) & month.isin(7, 8, 9)
    stored = table(spark, sf_dir, "orders").where((month % 5 != 0) & ~gap)
    return missing_ranges(
        stored.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("period")), "1991-11", "2002-02", WEEKLY
    )


@check("q33_pick_up_of_new_files", _ROUND_TRIP_SQL)
def streamed_pick_up(spark, sf_dir):
    """Three landings, the last one a repetition; every row counts once."""
    base = scratch_path(spark, "pick-up")
    rows = _order_extract(spark, sf_dir)
    columns = rows.columns

    def clean(raw):
        return distinct_rows(
            raw.select(month_start("period").alias("period"), "o_orderkey", "priority", "value")
        )

    def run():
        query = pick_up(spark, f"{base}/landing", columns, clean, f"{base}/table", f"{base}/state")
        query.awaitTermination()

    early = F.col("period") < "1998-07"
    for number_, landed in enumerate((rows.where(early), rows.where(~early), rows)):
        write_csv(landed, f"{base}/landing/{number_}")
        run()
    run()  # nothing new
    picked = read_picked_up(spark, f"{base}/table")
    return _by_period(picked.withColumn("period", F.date_format("period", "yyyy-MM")))



@check(
    "q33b_latest_revision_of_deliveries",
    f"""SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, o_orderkey,
  o_orderpriority AS priority, CAST(CASE WHEN o_orderstatus = 'F' THEN 2 * {AMOUNT_SQL}
    ELSE {AMOUNT_SQL} END AS DOUBLE) AS amount FROM orders""",
)
def streamed_revisions(spark, sf_dir):
    """Orders land twice, filled ones with a revised value, and both are picked up in one run.

    The last delivery of each order counts, whatever its value.
    """
    base = scratch_path(spark, "revisions")
    filled = F.col("o_orderstatus") == "F"

    def extract(amount):
        return table(spark, sf_dir, "orders").select(
            F.date_format("o_orderdate", "yyyy-MM").alias("period"), "o_orderkey",
            F.col("o_orderpriority").alias("priority"), amount.cast("string").alias("value"),
        )

    def clean(raw):
        return raw.select(
            month_start("period").alias("period"), F.col("o_orderkey").cast("long"), "priority",
            number("value").alias("amount"), *delivery(raw),
        )

    first = extract(F.when(filled, money("o_totalprice") * 3).otherwise(money("o_totalprice")))
    second = extract(F.when(filled, money("o_totalprice") * 2).otherwise(money("o_totalprice")))
    for number_, landed in enumerate((first, second)):
        write_csv(landed, f"{base}/landing/{number_}")
    pick_up(
        spark, f"{base}/landing", first.columns, clean, f"{base}/table", f"{base}/state",
        every_delivery=True,
    ).awaitTermination()
    picked = read_picked_up(spark, f"{base}/table", picked_at=True)
    latest = latest_revision(picked, ["o_orderkey"], newest_delivery(picked))
    return latest.select("period", "o_orderkey", "priority", "amount")


# ------------------------------------------------------------------ wide, many, missing


@check(
    "q19b_long_top_lists",
    f"""WITH g AS (SELECT n_name AS nation, o_orderkey, sum({AMOUNT_SQL}) AS amount
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)
SELECT nation, o_orderkey, CAST(amount AS DOUBLE) AS amount,
  row_number() OVER (PARTITION BY nation ORDER BY amount DESC, o_orderkey) AS position
FROM g QUALIFY position <= 5000""",
)
def long_top_lists(spark, sf_dir):
    """More rows per group than Spark's own window group limit takes."""
    orders = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    groups = orders.groupBy(F.col("n_name").alias("nation"), "o_orderkey").agg(
        F.sum(money("o_totalprice")).alias("amount")
    )
    return doubles(top_n_per(groups, ["nation"], "amount", 5000, ["o_orderkey"]))


@check(
    "q37c_sums_by_any_code",
    """SELECT l_returnflag, to_json(map_from_entries(list((CAST(l_suppkey AS VARCHAR), n) ORDER BY l_suppkey))) AS quantities
FROM (SELECT l_returnflag, l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS n FROM lineitem GROUP BY ALL) GROUP BY 1""",
)
def sums_by_any_code(spark, sf_dir):
    """As many codes as there are, in one map."""
    lines = table(spark, sf_dir, "lineitem")
    sums = sums_by_code(lines, ["l_returnflag"], "l_suppkey", "l_quantity", "sums")
    texts = F.transform_keys("sums", lambda key, _: key.cast("string"))
    whole_sums = F.transform_values(texts, lambda _, value: value.cast("long"))
    return sums.select("l_returnflag", F.to_json(whole_sums).alias("quantities"))


_RANK_SQL = """SELECT n_name AS state, {agg}(CASE WHEN n_regionkey = 0 THEN NULL ELSE s_nationkey END) AS rank
FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1"""


def _places_without_rank(spark, sf_dir, agg):
    rows = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    rank = F.when(F.col("n_regionkey") != 0, F.col("s_nationkey"))
    return sum_by(rows.select(F.col("n_name").alias("state"), rank.alias("rank")), ["state"], "rank", agg)


@check("q31b_average_of_nothing", _RANK_SQL.format(agg="avg"))
def average_of_nothing(spark, sf_dir):
    """Places without any rank have no average rank."""
    return _places_without_rank(spark, sf_dir, F.avg)


@check("q31c_smallest_of_nothing", _RANK_SQL.format(agg="min"))
def smallest_of_nothing(spark, sf_dir):
    return _places_without_rank(spark, sf_dir, F.min)


@check(
    "q14b_measures_that_are_no_numbers",
    f"""SELECT o_orderpriority AS priority, count(*) AS n, CAST(sum({AMOUNT_SQL}) AS DOUBLE) AS amount
FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 7 <> 0 GROUP BY 1""",
)
def measures_that_are_no_numbers(spark, sf_dir):
    """Texts like NaN and Infinity are dropped with the malformed ones and spoil no total."""
    text = money("o_totalprice").cast("string")
    spoiled = (
        F.when(F.col("o_orderstatus") == "P", F.lit("NaN"))
        .when(F.col("o_orderkey") % 7 == 0, F.element_at(F.array(*map(F.lit, ("Infinity", "-Infinity", "+inf"))), (F.col("o_orderkey") % 3 + 1).cast("int")))
        .otherwise(text)
    )
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("priority"), number(spoiled).alias("value")
    )
    kept = rows.where(any_present("value"))
    return kept.groupBy("priority").agg(
        F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("amount")
    )


@check("q30b_newest_extract", f"""SELECT strftime(o_orderdate, '%Y-%m') AS period, o_orderpriority AS priority,
  count(*) AS n, CAST(sum({AMOUNT_SQL}) AS DOUBLE) AS amount FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL""")
def newest_extract_only(spark, sf_dir):
    """Two extracts land; only the one written last is read."""
    base = scratch_path(spark, "newest")
    source = SOURCES["steo"]
    rows = _order_extract(spark, sf_dir)
    filled = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey")
    write_csv(rows, raw_folder(base, source, "1995-01", "2001-08"))
    write_csv(rows.join(filled, "o_orderkey", "left_semi"), raw_folder(base, source, "1995-01", "2001-09"))
    return _by_period(read_csv(spark, f"{base}/{source.raw_prefix}", newest_only=True))


@check(
    "q29c_pages_without_given_columns",
    """SELECT event_type, count(*) AS records,
  CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS total
FROM events GROUP BY 1""",
)
def pages_without_given_columns(spark, sf_dir):
    """The first record of the pages names the columns."""
    base = scratch_path(spark, "pages")
    record = F.struct("event_type", F.coalesce(F.get_json_object("props", "$.k"), F.lit("")).alias("k"))
    page = F.struct(F.lit("1").alias("total"), F.array(record).alias("data"))
    table(spark, sf_dir, "events").select(page.alias("response")).write.json(base)
    rows = read_pages(spark, base, one_per_line=True)
    return rows.groupBy("event_type").agg(F.count("*").alias("records"), F.sum(whole("k")).alias("total"))


@check(
    "q26b_cleaned_rows_of_a_range",
    f"""SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS period, CAST({AMOUNT_SQL} AS DOUBLE) AS amount
FROM orders WHERE o_orderdate >= '1996-03-01' AND o_orderdate < '1997-06-01'""",
)
def cleaned_rows_of_a_range(spark, sf_dir):
    """Typed rows of a monthly source between two months, both included."""
    clean = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.trunc("o_orderdate", "month").alias("period"),
        money("o_totalprice").cast("double").alias("amount"),
    )
    return clean_range(clean, SOURCES["steo"], "1996-03", "1997-05")


@check(
    "q38b_rows_per_group",
    """SELECT o_orderstatus AS status, count(*) AS n, count(o_totalprice) AS valued FROM orders GROUP BY 1""",
)
def rows_per_group(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count("*").alias("n"), F.count("o_totalprice").alias("valued")
    )
