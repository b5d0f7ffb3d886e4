"""Yearly tables: long and wide, stacked, with drifting headings, complete over the years.

Nations stand for counties and order years for survey years.  Orders are added up per
customer and year before they meet the customer table, so that a customer with very many
orders is down to one row per year by then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import in_year
from ..functions.text import county_name, metric_key, split_metric_key
from ..operators.reshape import (
    balanced_panel as keep_complete,
    columns_numbered as number_columns,
    heading_faults,
    key_set_difference as difference,
    long_to_wide as widen,
    map_headings,
    stack,
    wide_to_long as melt,
)
from .common import given, report

# Parameters of the registered queries.
NATIONS = [f"NATION_{i}" for i in range(25)]  # of the given tables; SQL has to spell its columns out
# Columns of a wide table are names in the plan; more of them are refused.
MOST_COLUMNS = 10_000
SECOND_VINTAGE = 1998
THIRD_VINTAGE = 2000
HEADINGS = [
    (0, 1997, "Orders!!Estimate!!Total", "orders"),
    (0, 1997, "Orders!!Estimate!!Revenue (dollars)", "revenue"),
    (1998, 1999, "Estimate!!Orders!!Total", "orders"),
    (1998, 1999, "Estimate!!Orders MOE!!Revenue (dollars)", "revenue"),
    (2000, 9999, "Estimate!!Orders!!Total", "orders"),
    (2000, 9999, "Estimate!!Orders!!Revenue (dollars)", "revenue"),
]
COMPARED_YEARS = (2000, 2001)


def customer_years(spark, folder) -> DataFrame:
    """Orders and revenue per customer and year."""
    return (
        given(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("customer"), F.year("o_orderdate").alias("year"))
        .agg(F.count("*").alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("revenue"))
    )


def county_years(spark, folder) -> DataFrame:
    """Orders and revenue per county and year."""
    nations = given(spark, folder, "nation")
    homes = (
        given(spark, folder, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("customer"), F.col("n_name").alias("county"))
    )
    return (
        customer_years(spark, folder)
        .join(homes, "customer")
        .groupBy("county", "year")
        .agg(F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"))
    )


def county_metrics(spark, folder) -> DataFrame:
    """The same in long form: (county, year, metric, value)."""
    numbers = county_years(spark, folder).select(
        "county", "year", F.col("orders").cast("decimal(28,2)").alias("orders"), F.col("revenue").cast("decimal(28,2)").alias("revenue")
    )
    return melt(numbers, ["county", "year"], ["orders", "revenue"], "metric", "value")


def counties(spark, folder) -> list[str]:
    """Names of all nations: they become columns, so the driver has to know them; more than MOST_COLUMNS are an error."""
    names = given(spark, folder, "nation").select("n_name").dropna().distinct().orderBy("n_name").limit(MOST_COLUMNS + 1)
    found = [r.n_name for r in names.collect()]
    if len(found) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} counties cannot be columns; keep the long form")
    return found


def _matrix(spark, folder, names: list[str]) -> DataFrame:
    keyed = county_metrics(spark, folder).withColumn("index", metric_key(F.col("year"), F.col("metric")))
    return widen(keyed, ["index"], "county", "value", names)


def long_to_wide(spark, folder):
    return report(_matrix(spark, folder, counties(spark, folder)))


def wide_to_long(spark, folder):
    year, metric = split_metric_key(F.col("index"))
    names = counties(spark, folder)
    long = melt(_matrix(spark, folder, names), ["index"], names, "county", "value")
    return report(long.select("county", year.alias("year"), metric.alias("metric"), "value"))


def stack_years(spark, folder):
    """Early years carry the order count only; tables of one source are stacked as one aggregate with a condition."""
    late = F.when(F.col("year") >= SECOND_VINTAGE, F.col("revenue"))
    return report(county_years(spark, folder).select("county", "year", "orders", late.alias("revenue")))


def stack_accounts(spark, folder):
    """Customers and suppliers under each other, columns matched by name; suppliers have no segment."""
    customers = given(spark, folder, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
    )
    suppliers = given(spark, folder, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation"),
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"),
    )
    return report(stack([customers, suppliers]))


def area_names(spark, folder):
    """Customers per area, the area named in full and by its county alone."""
    per_nation = given(spark, folder, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("customers"))
    nations = given(spark, folder, "nation").join(given(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    area = F.concat("n_name", F.lit(" County, "), "r_name")
    return report(per_nation.join(nations, "n_nationkey").select(area.alias("area"), county_name(area).alias("county"), "customers"))


def _spelled(spark, folder) -> DataFrame:
    """Long table whose headings are spelled differently over the years, with comment headings the mapping does not know."""
    year, metric = F.col("year"), F.col("metric")
    total = F.when(year < SECOND_VINTAGE, "Orders!!Estimate!!Total").otherwise("Estimate!!Orders!!Total")
    revenue = (
        F.when(year < SECOND_VINTAGE, "Orders!!Estimate!!Revenue (dollars)")
        .when(year < THIRD_VINTAGE, "Estimate!!Orders MOE!!Revenue (dollars)")
        .otherwise("Estimate!!Orders!!Revenue (dollars)")
    )
    label = F.when(metric == "orders", total).otherwise(revenue)
    labels = F.explode(F.array(label, F.concat(F.lit("Comment!!"), label)))
    return county_metrics(spark, folder).withColumn("label", labels).drop("metric")


def header_mapping(spark, folder):
    mapped = map_headings(_spelled(spark, folder), HEADINGS)
    return report(mapped.select("county", "year", "metric", "value"))


def balanced_panel(spark, folder):
    return report(keep_complete(customer_years(spark, folder), "customer", "year", one_row_each=True))


def key_set_difference(spark, folder):
    first, second = COMPARED_YEARS
    # Ranges of the stored column reach the scan, a year worked out from it would not.
    either = in_year("o_orderdate", first) | in_year("o_orderdate", second)
    pairs = given(spark, folder, "orders").filter(either).select(F.col("o_custkey").alias("customer"), "o_orderdate")
    found = difference(pairs, "customer", in_year("o_orderdate", first), in_year("o_orderdate", second))
    return report(found)


def heading_check(spark, folder):
    """(year, metric) pairs that are not found under exactly one heading; one spelling of the mapping is left out on purpose."""
    gap = [m for m in HEADINGS if (m[0], m[3]) != (THIRD_VINTAGE, "revenue")]
    gap.append((THIRD_VINTAGE, 9999, "Estimate!!Orders!!Revenue", "revenue"))
    return report(heading_faults(_spelled(spark, folder), gap))


def columns_numbered(spark, folder):
    return report(number_columns(given(spark, folder, "lineitem")))


def panel_counts(spark, folder):
    """Customers, orders and revenue per year."""
    return report(
        customer_years(spark, folder)
        .groupBy("year")
        .agg(F.count("*").alias("customers"), F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"))
    )


QUERIES = {
    f.__name__: f
    for f in (
        long_to_wide, wide_to_long, stack_years, header_mapping, balanced_panel, key_set_difference,
        columns_numbered, panel_counts, heading_check, stack_accounts, area_names,
    )
}

YEARS_SQL = """
years AS (
  SELECT n_name AS county, YEAR(o_orderdate) AS year, COUNT(*) AS orders,
         SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY n_name, YEAR(o_orderdate)),
long AS (
  SELECT county, year, 'orders' AS metric, CAST(orders AS DOUBLE) AS value FROM years
  UNION ALL
  SELECT county, year, 'revenue', CAST(revenue AS DOUBLE) FROM years)"""
CUSTOMER_YEARS_SQL = """
pairs AS (
  SELECT o_custkey AS customer, YEAR(o_orderdate) AS year, COUNT(*) AS orders,
         SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue
  FROM orders GROUP BY o_custkey, YEAR(o_orderdate))"""
LINE_COLUMNS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
).split()

ORACLES = {
    "long_to_wide": f"""WITH {YEARS_SQL}
SELECT year || '_' || metric AS index,
{', '.join(f"MAX(CASE WHEN county = '{c}' THEN value END) AS {c}" for c in NATIONS)}
FROM long GROUP BY year, metric""",
    "wide_to_long": f"""WITH {YEARS_SQL},
keys AS (SELECT DISTINCT year, metric FROM long)
SELECT n_name AS county, k.year, k.metric, l.value
FROM keys k CROSS JOIN nation LEFT JOIN long l ON l.county = n_name AND l.year = k.year AND l.metric = k.metric""",
    "stack_years": f"""WITH {YEARS_SQL}
SELECT county, year, orders, CASE WHEN year >= {SECOND_VINTAGE} THEN CAST(revenue AS DOUBLE) END AS revenue FROM years""",
    "stack_accounts": """
SELECT 'customer' AS kind, c_custkey AS key, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL
SELECT 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier""",
    "area_names": """
SELECT n_name || ' County, ' || r_name AS area, n_name AS county, COUNT(*) AS customers
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY n_name, r_name, n_nationkey""",
    "header_mapping": f"WITH {YEARS_SQL} SELECT county, year, metric, value FROM long",
    "balanced_panel": f"""WITH {CUSTOMER_YEARS_SQL}
SELECT customer, year, orders, CAST(revenue AS DOUBLE) AS revenue FROM pairs
WHERE customer IN (SELECT customer FROM pairs GROUP BY customer
                   HAVING COUNT(year) = (SELECT COUNT(DISTINCT year) FROM pairs))""",
    "key_set_difference": """WITH
a AS (SELECT DISTINCT o_custkey AS customer FROM orders WHERE YEAR(o_orderdate) = 2000),
b AS (SELECT DISTINCT o_custkey AS customer FROM orders WHERE YEAR(o_orderdate) = 2001)
SELECT customer, 'first' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL
SELECT customer, 'second' AS side FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
    "columns_numbered": "\nUNION ALL\n".join(
        f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS column_name, '{i}_{c}' AS numbered_name, COUNT({c}) AS n_filled FROM lineitem"
        for i, c in enumerate(LINE_COLUMNS)
    ),
    "heading_check": f"""WITH {YEARS_SQL}
SELECT DISTINCT year, 'revenue' AS metric, CAST(0 AS BIGINT) AS n_headings FROM long WHERE year >= {THIRD_VINTAGE}""",
    "panel_counts": f"""WITH {CUSTOMER_YEARS_SQL}
SELECT year, COUNT(*) AS customers, CAST(SUM(orders) AS BIGINT) AS orders, CAST(SUM(revenue) AS DOUBLE) AS revenue
FROM pairs GROUP BY year""",
}
