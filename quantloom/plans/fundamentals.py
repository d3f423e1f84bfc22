"""Stand-in company fundamentals over the order tables.

A company is (nation, market segment); its fiscal quarters are those of the order date. Line
items give revenue, discounts, taxes, quantities and counts, from which every statement item
follows by whole-number rules that also make NULLs, zeros and both signs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Every item as a rule over the sums revenue, disc, tax, qty, n (SQL that Spark and DuckDB share; // is whole division).
ITEMS = {
    "cogs": "revenue - 8 * disc",
    "gross_profit": "8 * disc",
    "operating_income": "8 * disc - 10 * tax",
    "interest_expense": "CASE WHEN n % 5 = 0 THEN NULL WHEN n % 7 = 0 THEN 0 ELSE n * 10000 END",
    "ebt": "operating_income - coalesce(interest_expense, 0)",
    "tax_expense": "CASE WHEN ebt > 0 THEN (ebt * 22) // 100 ELSE 0 END",
    "net_income": "ebt - tax_expense",
    "controlling_ni": "CASE WHEN n % 3 = 0 THEN NULL WHEN n % 8 = 0 THEN 0 ELSE net_income - qty * 100 END",
    "da_total": "CASE WHEN n % 11 = 0 THEN NULL ELSE n * 50000 END",
    "ebitda": "operating_income + da_total",
    "cfo": "net_income + coalesce(da_total, 0) - qty * 200",
    "capex": "-(qty * 900)",
    "fcf": "cfo - abs(capex)",
    "total_assets": "revenue * 3 + qty * 1000",
    "total_liabilities": "revenue + n * 100000",
    "total_equity": "total_assets - total_liabilities",
    "controlling_equity": "CASE WHEN n % 3 = 0 THEN NULL ELSE total_equity - qty * 50 END",
    "current_assets": "revenue",
    "current_liabilities": "CASE WHEN n % 13 = 0 THEN NULL ELSE revenue - disc * 5 END",
    "receivables": "disc",
    "inventory": "CASE WHEN n % 4 = 0 THEN NULL ELSE disc * 2 END",
    "trade_payables": "tax",
    "cash": "qty * 2000",
    "net_debt": "CASE WHEN n % 6 = 0 THEN NULL ELSE n * 80000 - qty * 2000 END",
    "ppe": "revenue // 2",
    "short_term_debt": "n * 30000",
    "long_term_debt": "CASE WHEN n % 5 = 1 THEN NULL ELSE n * 50000 END",
    "shares_out": "1000 + n",
    "dividends_paid": "CASE WHEN net_income > 0 THEN -(net_income // 4) END",
    "market_cap": "CASE WHEN n % 9 = 0 THEN NULL ELSE revenue * 2 END",
    "price": "market_cap // shares_out",
    "data_quality": "CASE WHEN n % 17 = 0 THEN 3 WHEN n % 10 = 0 THEN 2 ELSE 1 END",
}
MONEY = ("revenue", *(c for c in ITEMS if c != "data_quality"))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def with_items(sums: DataFrame) -> DataFrame:
    """The items, each from those before it."""
    out = sums
    for name, rule in ITEMS.items():
        out = out.withColumn(name, F.expr(rule.replace("//", "div")).cast("int" if name == "data_quality" else "long"))
    return out


def company() -> Column:
    return F.concat_ws("-", F.col("c_nationkey").cast("string"), "c_mktsegment")


def ordered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with company, year, quarter, month and status of their order."""
    customers = read(spark, sf_dir, "customer").select("c_custkey", company().alias("corp"))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("fy"), F.quarter("o_orderdate").alias("q"), "o_orderstatus", "o_orderpriority")
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount", "l_tax", "l_quantity")
    # Orders find their company first, so the lines are shuffled once.
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey", "c_custkey")
    return lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))


def statements(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    """A row of items for each company and ``keys`` (fy, q, o_orderstatus, ...)."""
    whole = lambda e: F.sum(F.floor(e).cast("long"))
    price = F.col("l_extendedprice")
    sums = ordered_lines(spark, sf_dir).groupBy("corp", *keys).agg(whole(price * 100).alias("revenue"), whole(price * F.col("l_discount") * 100).alias("disc"), whole(price * F.col("l_tax") * 100).alias("tax"), whole(F.col("l_quantity")).alias("qty"), F.count(F.lit(1)).alias("n"))
    return with_items(sums)


def annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statements(spark, sf_dir, "fy")


def quarterly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statements(spark, sf_dir, "fy", "q")


def sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(corp, sector): the region of the company's nation."""
    nation = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("sector"))
    return read(spark, sf_dir, "customer").select("c_nationkey", company().alias("corp")).distinct().join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("corp", "sector")


def sql_statements(name: str, *keys: str) -> str:
    """The same as a DuckDB common table expression ``name``."""
    group = ", ".join(["corp", *keys])
    layers = f"""(SELECT {group}, sum(floor(l_extendedprice * 100)::BIGINT)::BIGINT AS revenue, sum(floor(l_extendedprice * l_discount * 100)::BIGINT)::BIGINT AS disc,
        sum(floor(l_extendedprice * l_tax * 100)::BIGINT)::BIGINT AS tax, sum(floor(l_quantity)::BIGINT)::BIGINT AS qty, count(*) AS n
      FROM (SELECT *, c_nationkey::VARCHAR || '-' || c_mktsegment AS corp, year(o_orderdate) AS fy, quarter(o_orderdate) AS q
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey) GROUP BY {group})"""
    for item, rule in ITEMS.items():
        layers = f"(SELECT *, ({rule})::{'INT' if item == 'data_quality' else 'BIGINT'} AS {item} FROM {layers})"
    return f"{name} AS {layers}"


SQL_SECTORS = "sectors AS (SELECT DISTINCT c_nationkey::VARCHAR || '-' || c_mktsegment AS corp, r_name AS sector FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
