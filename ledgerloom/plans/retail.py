"""Retail analysis: sales per item, country and customer, running revenue, returns.

The retail table is read off the order tables: one row per line, ``InvoiceNo`` with a C in
front and a negative quantity for returned lines, the part's retail price as unit price.
Only the tables behind the wanted columns are joined.  Orders get their customer and country
first, so the lines are shuffled once per big table they meet.  Sums are taken per order or
per part before the join wherever the result allows it: the shuffle of that sum also serves
the join, and a part or order that holds a large share of the lines is down to one row by then.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.dates import month_start
from ..operators.filters import suffix_or_equal, with_threshold
from ..operators.ranking import share_of_total, top_k
from ..operators.running import running_summary, running_total
from ..sources.tables import register
from .common import given, report

MONEY = "decimal(18,2)"
QUANTITY = "decimal(12,2)"
# Columns that make the order of lines unique.
LINE_KEY = ["order_key", "line_number", "part_key", "supplier_key", "Quantity"]
LINE_ORDER = ["InvoiceDate", *LINE_KEY]
# A block of this many order numbers holds a bounded number of lines.
ORDERS_PER_BLOCK = 1 << 20

# Parameters of the registered queries.
MIN_QUANTITY = 40
COUNTRY = "NATION_7"
ITEM = "blue ring"
CUSTOMERS = ["42", "77"]
SUFFIX = "ring"
NAMED_ITEM = "hot bolt"
RETURNED_ITEMS = ["blue ring", "hot bolt", "large plate"]
PEAK = 400_000
COUNTRY_PEAKS = {"NATION_3": 500_000, "NATION_7": 400_000, "NATION_12": 300_000, "NATION_20": 450_000}

SQL_YEARS = (1995, 2001)

ORDER_COLUMNS = {"InvoiceDate", "CustomerID", "Country"}
PART_COLUMNS = {"Description", "UnitPrice"}
Filters = Mapping[str, Column]


def _filtered(spark: SparkSession, folder: str, name: str, filters: Filters) -> DataFrame:
    df = given(spark, folder, name)
    return df.filter(filters[name]) if name in filters else df


def invoices(spark: SparkSession, folder: str, columns: Sequence[str], filters: Filters = {}) -> DataFrame:
    """(order_key, InvoiceDate, CustomerID, Country) as far as wanted."""
    orders = _filtered(spark, folder, "orders", filters).select(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_custkey").alias("customer_key"),
        F.col("o_orderdate").alias("InvoiceDate"),
    )
    if "Country" in columns or "nation" in filters:
        how = "inner" if "nation" in filters else "left"
        customers = (
            given(spark, folder, "customer")
            .join(_filtered(spark, folder, "nation", filters), F.col("c_nationkey") == F.col("n_nationkey"), how)
            .select(F.col("c_custkey").alias("customer_key"), F.col("n_name").alias("Country"))
        )
        orders = orders.join(customers, "customer_key", how)
    return orders.withColumn("CustomerID", F.col("customer_key").cast("string"))


def items(spark: SparkSession, folder: str, filters: Filters = {}) -> DataFrame:
    return _filtered(spark, folder, "part", filters).select(
        F.col("p_partkey").alias("part_key"),
        F.col("p_name").alias("Description"),
        F.col("p_retailprice").cast(MONEY).alias("UnitPrice"),
    )


def lines(spark: SparkSession, folder: str, filters: Filters = {}) -> DataFrame:
    """The line items alone, with signed quantity and invoice number."""
    returned = F.col("l_returnflag") == "R"
    quantity = F.col("l_quantity").cast(QUANTITY)
    return _filtered(spark, folder, "lineitem", filters).select(
        F.concat(F.when(returned, "C").otherwise(""), F.col("l_orderkey").cast("string")).alias("InvoiceNo"),
        F.when(returned, -quantity).otherwise(quantity).alias("Quantity"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("supplier_key"),
    )


def add_items(df: DataFrame, spark: SparkSession, folder: str, filters: Filters = {}) -> DataFrame:
    return df.join(items(spark, folder, filters), "part_key", "inner" if "part" in filters else "left")


def add_invoices(
    df: DataFrame, spark: SparkSession, folder: str, columns: Sequence[str], filters: Filters = {}
) -> DataFrame:
    how = "inner" if {"orders", "nation"} & set(filters) else "left"
    return df.join(invoices(spark, folder, columns, filters), "order_key", how)


def retail(spark: SparkSession, folder: str, columns: Sequence[str], filters: Filters = {}) -> DataFrame:
    """The retail table with the wanted columns; ``filters`` are conditions per source table.

    Lines meet the filtered tables first; the join that filters nothing then gets what is left of them.
    """
    df = lines(spark, folder, filters)
    by_order = {"orders", "nation"} & set(filters)
    if by_order:
        df = add_invoices(df, spark, folder, columns, filters)
    if PART_COLUMNS & set(columns) or "part" in filters:
        df = add_items(df, spark, folder, filters)
    if ORDER_COLUMNS & set(columns) and not by_order:
        df = add_invoices(df, spark, folder, columns, filters)
    return df.select(*columns)


def line_revenue() -> Column:
    return F.round(F.col("Quantity") * F.col("UnitPrice"), 2)


ALL_COLUMNS = [
    "InvoiceNo", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country",
    "order_key", "line_number", "part_key", "supplier_key",
]


# ---------------------------------------------------------------- sales reports


def top_orders_by_quantity(spark, folder):
    big = lines(spark, folder, {"lineitem": F.col("l_quantity") > MIN_QUANTITY}).filter(
        F.col("Quantity") > MIN_QUANTITY
    )
    ties = ["order_key", "line_number", "part_key", "supplier_key"]
    best = top_k(big, 10, "Quantity", ties)
    named = add_items(best, spark, folder).orderBy(F.desc("Quantity"), *ties)
    return report(named.select("Description", "Quantity", "order_key", "line_number"))


def revenue_by_item(spark, folder):
    # Lines of one part and quantity have one rounded revenue, so they are counted before they meet the parts.
    alike = lines(spark, folder).groupBy("part_key", "Quantity").agg(F.count("*").alias("n"))
    totals = (
        add_items(alike, spark, folder).groupBy("Description").agg(F.sum(line_revenue() * F.col("n")).alias("raw"))
    )
    # The order goes by the unrounded sum.
    return report(
        top_k(totals, 10, "raw", ["Description"]).select("Description", F.round("raw", 2).alias("total_revenue"))
    )


def quantity_by_country(spark, folder):
    per_order = lines(spark, folder).groupBy("order_key").agg(F.sum("Quantity").alias("Quantity"))
    totals = (
        add_invoices(per_order, spark, folder, ["Country"])
        .groupBy("Country")
        .agg(F.sum("Quantity").alias("total_sold"))
    )
    return report(top_k(totals, 20, "total_sold", ["Country"]))


def _revenue_per_order(spark, folder, revenue: Column) -> DataFrame:
    priced = add_items(lines(spark, folder), spark, folder)
    return priced.groupBy("order_key").agg(F.sum(revenue).alias("revenue"))


def revenue_by_country(spark, folder):
    per_order = _revenue_per_order(spark, folder, F.col("Quantity") * F.col("UnitPrice"))
    totals = (
        add_invoices(per_order, spark, folder, ["Country"])
        .groupBy("Country")
        .agg(F.round(F.sum("revenue"), 2).alias("total_revenue"))
    )
    return report(top_k(totals, 20, "total_revenue", ["Country"]))


def revenue_by_item_in_country(spark, folder):
    filters = {"nation": F.col("n_name") == COUNTRY}
    here = add_invoices(lines(spark, folder), spark, folder, ["Country"], filters)
    alike = here.groupBy("part_key", "Quantity").agg(F.count("*").alias("n"))
    totals = (
        add_items(alike, spark, folder)
        .groupBy("Description")
        .agg(F.round(F.sum(line_revenue() * F.col("n")), 2).alias("total_revenue"))
    )
    return report(top_k(totals, 10, "total_revenue", ["Description"]))


def date_extent(spark, folder):
    # One row per order is enough to know which order dates occur.
    sold = lines(spark, folder).groupBy("order_key").agg(F.count("*").alias("n_lines"))
    dated = add_invoices(sold, spark, folder, ["InvoiceDate"])
    return report(dated.agg(F.min("InvoiceDate").alias("first_date"), F.max("InvoiceDate").alias("last_date")))


def item_lookup(spark, folder):
    return report(retail(spark, folder, ALL_COLUMNS, {"part": F.col("p_name") == ITEM}))


def customer_history(spark, folder):
    ids = [int(c) for c in CUSTOMERS]
    # Compared as numbers in the scan, where the filter can skip data; the column itself is text.
    return report(retail(spark, folder, ALL_COLUMNS, {"orders": F.col("o_custkey").isin(ids)}))


def sample_rows(spark, folder):
    first = top_k(lines(spark, folder), 10, "order_key", LINE_KEY[1:], ascending=True)
    full = add_invoices(add_items(first, spark, folder), spark, folder, ["Country"])
    return report(full.select(*ALL_COLUMNS).orderBy(*LINE_KEY))


def top_lines_by_revenue(spark, folder):
    ties = ["order_key", "line_number", "part_key", "supplier_key"]
    priced = add_items(lines(spark, folder), spark, folder).withColumn("revenue", line_revenue())
    best = top_k(priced, 10, "revenue", ties)
    full = add_invoices(best, spark, folder, ["Country"]).orderBy(F.desc("revenue"), *ties)
    return report(full.select(*ALL_COLUMNS, "revenue"))


def customer_revenue(spark, folder) -> DataFrame:
    """Revenue per customer and country; lines add up per order, then per customer."""
    per_order = _revenue_per_order(spark, folder, line_revenue())
    orders = invoices(spark, folder, ["CustomerID"])
    per_customer = (
        per_order.join(orders, "order_key", "left")
        .filter(F.col("customer_key").isNotNull())
        .groupBy("customer_key")
        .agg(F.sum("revenue").alias("revenue"))
    )
    nations = given(spark, folder, "nation").select(F.col("n_nationkey"), F.col("n_name").alias("Country"))
    customers = given(spark, folder, "customer").select(F.col("c_custkey").alias("customer_key"), "c_nationkey")
    homes = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("customer_key", "Country")
    return per_customer.join(homes, "customer_key", "left").select(
        "customer_key",
        F.col("customer_key").cast("string").alias("CustomerID"),
        "Country",
        F.round("revenue", 2).alias("total_rev"),
    )


def top_customers(spark, folder):
    return report(top_k(customer_revenue(spark, folder), 10, "total_rev", ["CustomerID"]).drop("customer_key"))


def top_customer_basket(spark, folder):
    best = top_k(customer_revenue(spark, folder), 1, "total_rev", ["CustomerID"]).select("customer_key")
    # A one-row list of customers; as a scalar it becomes a filter of the order scan.
    theirs = retail(
        spark,
        folder,
        ["CustomerID", "Description", "UnitPrice", "Quantity"],
        {"orders": F.col("o_custkey") == best.scalar(), "lineitem": ~F.col("l_returnflag").eqNullSafe("R")},
    )
    bought = (
        theirs.groupBy("CustomerID", "Description", "UnitPrice")
        .agg(F.sum("Quantity").alias("total_purchased"))
        .withColumn("total_revenue", F.round(F.col("UnitPrice") * F.col("total_purchased"), 2))
    )
    best_items = top_k(bought, 5, "total_revenue", ["Description", "UnitPrice"])
    return report(share_of_total(best_items, "total_revenue", "share_pct"))


# ---------------------------------------------------------------- running revenue


def _with_levels(df: DataFrame) -> DataFrame:
    """Day, then block of order numbers: coarse steps of the line order."""
    return df.withColumn("_day", F.to_date("InvoiceDate")).withColumn(
        "_block", F.floor(F.col("order_key") / ORDERS_PER_BLOCK)
    )


LEVELS = ["_day", "_block"]


def running_item_revenue(spark, folder):
    df = retail(spark, folder, ["Description", "UnitPrice", "InvoiceDate", *LINE_KEY])
    df = _with_levels(df.withColumn("revenue", line_revenue()))
    running = running_total(df, ["Description"], LINE_ORDER, "revenue", "cumulative_rev", LEVELS)
    return report(running.drop(*LEVELS, "UnitPrice"))


def monthly_cumulative(df: DataFrame, keys: Sequence[str], threshold: Column | None) -> DataFrame:
    """Mean of the running revenue per month, for keys whose running revenue ever passes the threshold.

    ``df`` has the keys, the line order and ``revenue``.  The peak may lie before the last
    line, as returns lower the total again.
    """
    daily = running_summary(_with_levels(df), keys, LINE_ORDER, "revenue", LEVELS)
    if threshold is not None:
        # Picking items from a list of names leaves out lines without a name.
        daily = daily.dropna(subset=list(keys))
        peak = F.max("running_max").over(Window.partitionBy(*keys))
        daily = daily.withColumn("_peak", peak).filter(F.col("_peak") > threshold)
    monthly = (
        daily.groupBy(*keys, F.year("_day").alias("year"), F.month("_day").alias("month"))
        .agg(F.sum("running_sum").alias("_sum"), F.sum("n_valued").alias("_n"))
        .withColumn("monthly_cumulative_rev", F.try_divide(F.col("_sum").cast("double"), F.col("_n")))
        .drop("_sum", "_n")
        .withColumn("date", month_start(F.col("year"), F.col("month")))
    )
    return monthly.withColumnRenamed("Description", "item")


def _revenue_lines(spark, folder, filters: Filters = {}, columns: Sequence[str] = ()) -> DataFrame:
    df = retail(spark, folder, ["Description", "UnitPrice", "InvoiceDate", *LINE_KEY, *columns], filters)
    return df.withColumn("revenue", line_revenue())


def monthly_cumulative_top_items(spark, folder):
    df = _revenue_lines(spark, folder, {"nation": F.col("n_name") == COUNTRY})
    return report(monthly_cumulative(df, ["Description"], F.lit(PEAK)).orderBy("year", "month", "item"))


def monthly_cumulative_by_country_threshold(spark, folder):
    # One pass over all listed countries, each with its own threshold.
    df = _revenue_lines(spark, folder, {"nation": F.col("n_name").isin(list(COUNTRY_PEAKS))}, ["Country"])
    df = with_threshold(df, "Country", COUNTRY_PEAKS, "threshold")
    result = monthly_cumulative(df, ["Country", "threshold", "Description"], F.col("threshold"))
    return report(result.drop("threshold").orderBy("Country", "year", "month", "item"))


PEAKS_TEXT = """
WITH peaked AS (
  SELECT *, MAX(running_max) OVER (PARTITION BY Country, Description) AS peak
  FROM running_days WHERE Description IS NOT NULL),
monthly AS (
  SELECT Country, Description AS item, YEAR(_day) AS year, MONTH(_day) AS month,
         try_divide(CAST(SUM(running_sum) AS DOUBLE), SUM(n_valued)) AS monthly_cumulative_rev
  FROM peaked WHERE peak > :peaks[Country] AND year(_day) BETWEEN :first_year AND :last_year
  GROUP BY Country, Description, YEAR(_day), MONTH(_day))
SELECT *, make_date(year, month, 1) AS date FROM monthly ORDER BY Country, year, month, item"""


def monthly_cumulative_sql(spark, folder):
    """The threshold report as SQL text over a view; thresholds and years are typed parameters, not parts of the text."""
    lines = _revenue_lines(spark, folder, {"nation": F.col("n_name").isin(list(COUNTRY_PEAKS))}, ["Country"])
    register(running_summary(_with_levels(lines), ["Country", "Description"], LINE_ORDER, "revenue", LEVELS), "running_days")
    peaks = F.create_map(*[F.lit(x) for pair in COUNTRY_PEAKS.items() for x in pair])
    return report(spark.sql(PEAKS_TEXT, args={"peaks": peaks, "first_year": SQL_YEARS[0], "last_year": SQL_YEARS[1]}))


def monthly_cumulative_named_items(spark, folder):
    named = suffix_or_equal(F.col("p_name"), SUFFIX, NAMED_ITEM)
    filters = {"nation": F.col("n_name").isin(list(COUNTRY_PEAKS)), "part": named}
    df = _revenue_lines(spark, folder, filters, ["Country"])
    return report(monthly_cumulative(df, ["Country", "Description"], None).orderBy("Country", "year", "month", "item"))


# ---------------------------------------------------------------- returns


def _returns(spark, folder) -> DataFrame:
    per_part = (
        lines(spark, folder, {"lineitem": F.col("l_returnflag") == "R"})
        .groupBy("part_key")
        .agg(F.count("InvoiceNo").alias("n"), F.sum("Quantity").alias("Quantity"))
    )
    return (
        add_items(per_part, spark, folder)
        .groupBy("Description")
        .agg(F.sum("n").alias("total_returned"), F.sum(F.col("UnitPrice") * F.col("Quantity")).alias("total_value"))
    )


def returns_by_count(spark, folder):
    return report(top_k(_returns(spark, folder), 10, "total_returned", ["Description"]))


def returns_by_value(spark, folder):
    cost = _returns(spark, folder).withColumn("total_value", -F.col("total_value"))
    return report(top_k(cost, 10, "total_value", ["Description"]))


def running_returns(spark, folder):
    filters = {"lineitem": F.col("l_returnflag") == "R", "part": F.col("p_name").isin(RETURNED_ITEMS)}
    columns = ["Description", "InvoiceNo", "InvoiceDate", "CustomerID", "Country", *LINE_KEY]
    df = _with_levels(retail(spark, folder, columns, filters))
    total = running_total(df, ["Description"], LINE_ORDER, "Quantity", "_total", LEVELS)
    return report(
        total.withColumn("cumulative_total_returned", -F.col("_total")).select(
            "Description", "InvoiceNo", "InvoiceDate", "CustomerID", "Country", "cumulative_total_returned"
        )
    )


QUERIES = {
    f.__name__: f
    for f in (
        top_orders_by_quantity, revenue_by_item, quantity_by_country, revenue_by_country,
        revenue_by_item_in_country, date_extent, item_lookup, customer_history, sample_rows,
        top_lines_by_revenue, top_customers, top_customer_basket, running_item_revenue,
        monthly_cumulative_top_items, monthly_cumulative_by_country_threshold,
        monthly_cumulative_sql, monthly_cumulative_named_items, returns_by_count, returns_by_value, running_returns,
    )
}


# ---------------------------------------------------------------- the same in SQL

RETAIL_SQL = """
retail AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || CAST(l_orderkey AS VARCHAR) AS InvoiceNo,
         p_name AS Description,
         CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS DECIMAL(12,2)) AS Quantity,
         o_orderdate AS InvoiceDate,
         CAST(p_retailprice AS DECIMAL(18,2)) AS UnitPrice,
         CAST(o_custkey AS VARCHAR) AS CustomerID,
         n_name AS Country,
         l_orderkey AS order_key, CAST(l_linenumber AS BIGINT) AS line_number,
         l_partkey AS part_key, l_suppkey AS supplier_key
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN part ON l_partkey = p_partkey
)"""
ALL_SQL = """InvoiceNo, Description, CAST(Quantity AS DOUBLE) AS Quantity, CAST(InvoiceDate AS TIMESTAMP) AS InvoiceDate,
  CAST(UnitPrice AS DOUBLE) AS UnitPrice, CustomerID, Country, order_key, line_number, part_key, supplier_key"""
TIES_SQL = "order_key, line_number, part_key, supplier_key"
# Nulls come first in ascending order, as in Spark.
ORDER_SQL = "InvoiceDate NULLS FIRST, order_key, line_number, part_key, supplier_key, Quantity"
PRICED_SQL = f"""{RETAIL_SQL},
priced AS (SELECT *, ROUND(Quantity * UnitPrice, 2) AS revenue FROM retail)"""


def _monthly_sql(keys: str, where: str, having: str, item_filter: str = "TRUE") -> str:
    lead = keys.replace("Description", "")
    # Plain equality, as with IN: a line without a name is on no list.
    matched = " AND ".join(f"l.{k} = r.{k}" for k in keys.split(", "))
    return f"""WITH {PRICED_SQL},
running AS (
  SELECT *, ROUND(SUM(revenue) OVER (PARTITION BY {keys} ORDER BY {ORDER_SQL}
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS cumulative_rev
  FROM priced WHERE {where}),
listed AS (SELECT {keys} FROM running GROUP BY {keys} HAVING {having}),
kept AS (
  SELECT r.* FROM running r
  WHERE {item_filter} AND EXISTS (SELECT 1 FROM listed l WHERE {matched}))
SELECT {lead} Description AS item, YEAR(InvoiceDate) AS year, MONTH(InvoiceDate) AS month,
       CAST(SUM(cumulative_rev) AS DOUBLE) / COUNT(cumulative_rev) AS monthly_cumulative_rev,
       CAST(MAKE_DATE(YEAR(InvoiceDate), MONTH(InvoiceDate), 1) AS VARCHAR) AS date
FROM kept GROUP BY {lead} Description, YEAR(InvoiceDate), MONTH(InvoiceDate)"""


_NAMES_SQL = ", ".join(f"'{c}'" for c in COUNTRY_PEAKS)
_PEAK_SQL = " ".join(f"WHEN '{c}' THEN {v}" for c, v in COUNTRY_PEAKS.items())

ORACLES = {
    "top_orders_by_quantity": f"""WITH {RETAIL_SQL}
SELECT Description, CAST(Quantity AS DOUBLE) AS Quantity, order_key, line_number FROM retail r WHERE Quantity > {MIN_QUANTITY}
ORDER BY r.Quantity DESC, {TIES_SQL} LIMIT 10""",
    "revenue_by_item": f"""WITH {PRICED_SQL}
SELECT Description, CAST(ROUND(SUM(revenue), 2) AS DOUBLE) AS total_revenue FROM priced
GROUP BY Description ORDER BY SUM(revenue) DESC, Description LIMIT 10""",
    "quantity_by_country": f"""WITH {RETAIL_SQL}
SELECT Country, CAST(SUM(Quantity) AS DOUBLE) AS total_sold FROM retail
GROUP BY Country ORDER BY total_sold DESC, Country LIMIT 20""",
    "revenue_by_country": f"""WITH {RETAIL_SQL}
SELECT Country, CAST(ROUND(SUM(Quantity * UnitPrice), 2) AS DOUBLE) AS total_revenue FROM retail
GROUP BY Country ORDER BY total_revenue DESC, Country LIMIT 20""",
    "revenue_by_item_in_country": f"""WITH {PRICED_SQL}
SELECT Description, CAST(ROUND(SUM(revenue), 2) AS DOUBLE) AS total_revenue FROM priced
WHERE Country = '{COUNTRY}' GROUP BY Description ORDER BY total_revenue DESC, Description LIMIT 10""",
    "date_extent": f"""WITH {RETAIL_SQL}
SELECT CAST(MIN(InvoiceDate) AS TIMESTAMP) AS first_date, CAST(MAX(InvoiceDate) AS TIMESTAMP) AS last_date FROM retail""",
    "item_lookup": f"""WITH {RETAIL_SQL} SELECT {ALL_SQL} FROM retail WHERE Description = '{ITEM}'""",
    "customer_history": f"""WITH {RETAIL_SQL} SELECT {ALL_SQL} FROM retail
WHERE CustomerID IN ({', '.join(f"'{c}'" for c in CUSTOMERS)})""",
    "sample_rows": f"""WITH {RETAIL_SQL} SELECT {ALL_SQL} FROM retail r ORDER BY {TIES_SQL}, r.Quantity LIMIT 10""",
    "top_lines_by_revenue": f"""WITH {PRICED_SQL} SELECT {ALL_SQL}, CAST(revenue AS DOUBLE) AS revenue
FROM priced p ORDER BY p.revenue DESC, {TIES_SQL} LIMIT 10""",
    "top_customers": f"""WITH {PRICED_SQL}
SELECT CustomerID, Country, CAST(ROUND(SUM(revenue), 2) AS DOUBLE) AS total_rev FROM priced
WHERE CustomerID IS NOT NULL GROUP BY CustomerID, Country ORDER BY total_rev DESC, CustomerID LIMIT 10""",
    "top_customer_basket": f"""WITH {RETAIL_SQL},
best AS (
  SELECT CustomerID, Country, ROUND(SUM(Quantity * UnitPrice), 2) AS total_rev FROM retail
  WHERE CustomerID IS NOT NULL GROUP BY CustomerID, Country ORDER BY total_rev DESC, CustomerID LIMIT 1),
purchased AS (
  SELECT CustomerID, Description, UnitPrice, SUM(Quantity) AS total_purchased FROM retail
  WHERE InvoiceNo NOT LIKE 'C%' AND CustomerID IN (SELECT CustomerID FROM best)
  GROUP BY CustomerID, Description, UnitPrice),
top AS (
  SELECT *, ROUND(UnitPrice * total_purchased, 2) AS total_revenue FROM purchased
  ORDER BY total_revenue DESC, Description, UnitPrice LIMIT 5)
SELECT CustomerID, Description, CAST(UnitPrice AS DOUBLE) AS UnitPrice, CAST(total_purchased AS DOUBLE) AS total_purchased,
       CAST(total_revenue AS DOUBLE) AS total_revenue,
       ROUND(CAST(total_revenue AS DOUBLE) * 100 / CAST(SUM(total_revenue) OVER () AS DOUBLE), 2) AS share_pct
FROM top""",
    "running_item_revenue": f"""WITH {PRICED_SQL}
SELECT Description, CAST(InvoiceDate AS TIMESTAMP) AS InvoiceDate, order_key, line_number, part_key, supplier_key,
       CAST(Quantity AS DOUBLE) AS Quantity, CAST(revenue AS DOUBLE) AS revenue,
       CAST(ROUND(SUM(p.revenue) OVER (PARTITION BY Description ORDER BY p.{ORDER_SQL}
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS DOUBLE) AS cumulative_rev
FROM priced p""",
    "monthly_cumulative_top_items": _monthly_sql("Description", f"Country = '{COUNTRY}'", f"MAX(cumulative_rev) > {PEAK}"),
    "monthly_cumulative_by_country_threshold": _monthly_sql(
        "Country, Description",
        f"Country IN ({_NAMES_SQL})",
        f"MAX(cumulative_rev) > CASE Country {_PEAK_SQL} END",
    ),
    "monthly_cumulative_sql": "SELECT * FROM ("
    + _monthly_sql("Country, Description", f"Country IN ({_NAMES_SQL})", f"MAX(cumulative_rev) > CASE Country {_PEAK_SQL} END")
    + f") WHERE year BETWEEN {SQL_YEARS[0]} AND {SQL_YEARS[1]}",
    "monthly_cumulative_named_items": _monthly_sql(
        "Country, Description",
        f"Country IN ({_NAMES_SQL})",
        "TRUE",
        f"(Description LIKE '%{SUFFIX}' OR Description = '{NAMED_ITEM}')",
    ),
    "returns_by_count": f"""WITH {RETAIL_SQL}
SELECT Description, COUNT(InvoiceNo) AS total_returned, CAST(SUM(UnitPrice * Quantity) AS DOUBLE) AS total_value
FROM retail WHERE InvoiceNo LIKE 'C%' GROUP BY Description ORDER BY total_returned DESC, Description LIMIT 10""",
    "returns_by_value": f"""WITH {RETAIL_SQL}
SELECT Description, COUNT(InvoiceNo) AS total_returned, CAST(-SUM(UnitPrice * Quantity) AS DOUBLE) AS total_value
FROM retail WHERE InvoiceNo LIKE 'C%' GROUP BY Description ORDER BY total_value DESC, Description LIMIT 10""",
    "running_returns": f"""WITH {RETAIL_SQL}
SELECT Description, InvoiceNo, CAST(InvoiceDate AS TIMESTAMP) AS InvoiceDate, CustomerID, Country,
       CAST(-SUM(Quantity) OVER (PARTITION BY Description ORDER BY {ORDER_SQL}
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cumulative_total_returned
FROM retail WHERE Description IN ({', '.join(f"'{c}'" for c in RETURNED_ITEMS)}) AND InvoiceNo LIKE 'C%'""",
}
