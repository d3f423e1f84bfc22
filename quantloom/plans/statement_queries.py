"""Queries of O2, O6, O7, O9 and O10 over statements, filings and labels.

Filings are orders: the priority's first digit is the place of a version within a company and
year, so amendments exist for most of them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quantloom.functions import text
from quantloom.functions.metrics import sign_fixed_expense
from quantloom.functions.nullsafe import safe_div
from quantloom.operators import aggregates, checks, grids, periods, standardize, windows
from quantloom.plans.catalog import grow, query
from quantloom.plans.fundamentals import annual, quarterly, read, sql_statements

A, Q = sql_statements("a", "fy"), sql_statements("qs", "fy", "q")
_FLOWS, _STOCKS = ["revenue", "net_income", "interest_expense"], ["total_assets", "cash"]

# --- periods ----------------------------------------------------------------------------

_CUM = "cum AS (SELECT corp, fy, q, ['Q1', 'H1', 'Q3', 'FY'][q::INT] AS period, sum(revenue) OVER w AS revenue, sum(net_income) OVER w AS net_income, CASE WHEN bool_and(interest_expense IS NOT NULL) OVER w THEN sum(interest_expense) OVER w END AS interest_expense, total_assets, cash, data_quality FROM qs WINDOW w AS (PARTITION BY corp, fy ORDER BY q))"


def cumulative(spark, sf_dir):
    w = windows.over(["corp", "fy"], "q").rowsBetween(-100, 0)
    out = quarterly(spark, sf_dir)
    kept = F.when(F.bool_and(F.col("interest_expense").isNotNull()).over(w), F.sum("interest_expense").over(w))
    return out.select("corp", "fy", F.element_at(F.array(*map(F.lit, ("Q1", "H1", "Q3", "FY"))), F.col("q")).alias("period"), F.sum("revenue").over(w).alias("revenue"), F.sum("net_income").over(w).alias("net_income"), kept.alias("interest_expense"), "total_assets", "cash", "data_quality")


_DISCRETE = """dq AS (SELECT * FROM (SELECT e.corp, e.fy, e.q AS quarter, e.revenue - CASE WHEN e.q = 1 THEN 0 ELSE b.revenue END AS revenue, e.net_income - CASE WHEN e.q = 1 THEN 0 ELSE b.net_income END AS net_income,
  e.interest_expense - CASE WHEN e.q = 1 THEN 0 ELSE b.interest_expense END AS interest_expense, e.total_assets, e.cash,
  CASE WHEN e.q > 1 AND e.interest_expense IS NOT NULL AND b.interest_expense IS NULL THEN greatest(e.data_quality, b.data_quality, 2) WHEN e.q > 1 THEN greatest(e.data_quality, b.data_quality) ELSE e.data_quality END AS data_quality
  FROM cum e LEFT JOIN cum b ON e.corp = b.corp AND e.fy = b.fy AND b.q = e.q - 1 WHERE e.q = 1 OR b.corp IS NOT NULL))"""


def discrete(spark, sf_dir):
    return periods.discrete_quarters(cumulative(spark, sf_dir), ["corp"], "fy", "period", _FLOWS, _STOCKS, "data_quality")


@query("o7_01_discrete_quarters", "corp #fy #quarter #revenue #net_income #interest_expense #total_assets #cash #data_quality", "SELECT * FROM dq", f"{Q}, {_CUM}, {_DISCRETE}")
def discrete_quarters(spark, sf_dir):
    return discrete(spark, sf_dir)


# Fiscal years that end in December, March or June by company, so that calendar slots differ from fiscal ones.
_CAL = "cal AS (SELECT *, last_day(make_date(fy::INT, 3 * quarter::INT, 1) - to_months((length(corp) % 3 * 3)::INT)) AS period_end FROM dq), cq AS (SELECT *, 'CQ' || (month(period_end) // 3) AS cq, year(period_end) AS cy, 12 - length(corp) % 3 * 3 AS fiscal_month FROM cal WHERE period_end <= DATE '2001-03-31' QUALIFY row_number() OVER (PARTITION BY corp, year(period_end), month(period_end) ORDER BY fy DESC, quarter DESC) = 1)"


def calendar(spark, sf_dir):
    shift = F.length("corp") % 3 * 3
    rows = discrete(spark, sf_dir).withColumns({"period_end": F.last_day(F.add_months(F.make_date("fy", F.col("quarter") * 3, F.lit(1)), -shift)), "fiscal_month": 12 - shift})
    return periods.calendar_quarters(rows, ["corp"], "period_end", "fy", "quarter", F.to_date(F.lit("2001-03-31")))


@query("o7_02_calendar_quarters", "corp #cy cq #revenue #total_assets %period_end", "SELECT * FROM cq", f"{Q}, {_CUM}, {_DISCRETE}, {_CAL}")
def calendar_quarters(spark, sf_dir):
    return calendar(spark, sf_dir)


@query("o7_03_calendar_years", "corp #cy #revenue #interest_expense #total_assets #data_quality derivation", "SELECT corp, cy, CASE WHEN count(revenue) = 4 THEN sum(revenue) END AS revenue, CASE WHEN count(interest_expense) = 4 THEN sum(interest_expense) END AS interest_expense, max(CASE WHEN cq = 'CQ4' THEN total_assets END) AS total_assets, max(data_quality) AS data_quality, CASE WHEN min(fiscal_month) = 12 AND max(fiscal_month) = 12 THEN 'native' ELSE 'derived' END AS derivation FROM cq GROUP BY corp, cy HAVING count(DISTINCT cq) = 4", f"{Q}, {_CUM}, {_DISCRETE}, {_CAL}")
def calendar_years(spark, sf_dir):
    return periods.calendar_years(calendar(spark, sf_dir), ["corp"], ["revenue", "interest_expense"], ["total_assets"], "data_quality", "fiscal_month")


@query("o7_06_period_changes", "corp #fy #q #revenue #revenue_qoq_diff ~revenue_qoq #revenue_yoy_diff ~revenue_yoy", f"SELECT x.corp, x.fy, x.q, x.revenue, x.revenue - p.revenue AS revenue_qoq_diff, {grow('x.revenue', 'p.revenue')} AS revenue_qoq, x.revenue - y.revenue AS revenue_yoy_diff, {grow('x.revenue', 'y.revenue')} AS revenue_yoy FROM qs x LEFT JOIN qs p ON x.corp = p.corp AND p.fy * 4 + p.q = x.fy * 4 + x.q - 1 LEFT JOIN qs y ON x.corp = y.corp AND y.fy = x.fy - 1 AND y.q = x.q", Q)
def period_changes(spark, sf_dir):
    return periods.period_changes(quarterly(spark, sf_dir).select("corp", "fy", "q", "revenue"), ["corp"], "fy", "q", ["revenue"])


@query("o7_07_missing_periods", "corp %due_end", "SELECT corp, due_end FROM (SELECT DISTINCT corp FROM qs) c, (SELECT max(d) AS due_end FROM (SELECT last_day(make_date(y::INT, m::INT, 1)) AS d FROM range(1995, 2002) t(y), (SELECT unnest([3, 6, 9, 12]) AS m)) WHERE d + (CASE WHEN month(d) = 12 THEN 90 ELSE 45 END + 15)::INT < DATE '2001-06-20') WHERE (corp, due_end) NOT IN (SELECT (corp, last_day(make_date(fy::INT, (q * 3)::INT, 1))) FROM qs)", Q)
def missing_periods(spark, sf_dir):
    q = quarterly(spark, sf_dir)
    have = q.select("corp", F.last_day(F.make_date("fy", F.col("q") * 3, F.lit(1))).alias("period_end"))
    return periods.missing_periods(q.select("corp").distinct(), have, "corp", "period_end", F.to_date(F.lit("2001-06-20")), 1995, 2001)


@query("o7_08_trading_days", "%day %is_open", "SELECT DISTINCT o_orderdate::DATE AS day, isodow(o_orderdate) < 6 AND NOT (day(o_orderdate) = 1 AND month(o_orderdate) IN (1, 5)) AS is_open FROM orders")
def trading_days(spark, sf_dir):
    days = read(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    return periods.trading_days(days, "day", days.where("day(day) = 1 AND month(day) IN (1, 5)").select(F.col("day").alias("h")))


@query("o7_12_available", "#o_custkey #fy %available_at", "SELECT o_custkey, year(o_orderdate) AS fy, min(o_orderdate)::DATE AS available_at FROM orders GROUP BY 1, 2 HAVING min(o_orderdate) <= TIMESTAMP '1998-06-30'")
def available(spark, sf_dir):
    f = read(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("fy"), F.col("o_orderdate").cast("date").alias("filed"))
    return periods.available(f, ["o_custkey", "fy"], "filed", F.to_date(F.lit("1998-06-30")))


@query("o6_42_fiscal_position", "#o_orderkey #fy period", "SELECT o_orderkey, CASE WHEN month(o_orderdate) > fm THEN year(o_orderdate) + 1 ELSE year(o_orderdate) END AS fy, CASE (month(o_orderdate) - fm + 12) % 12 WHEN 0 THEN 'FY' WHEN 3 THEN 'Q1' WHEN 6 THEN 'H1' WHEN 9 THEN 'Q3' END AS period FROM (SELECT *, [12, 3, 6][(o_custkey % 3 + 1)::INT] AS fm FROM orders)")
def fiscal_position(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    fm = F.when(F.col("o_custkey") % 3 == 0, 12).when(F.col("o_custkey") % 3 == 1, 3).otherwise(6)
    year, period = periods.fiscal_position(F.year("o_orderdate"), F.month("o_orderdate"), fm)
    return o.select("o_orderkey", year.alias("fy"), period.alias("period"))


@query("o6_39_period_end", "#o_orderkey %period_end", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN o_orderdate::DATE ELSE last_day(make_date(year(o_orderdate)::INT, 9, 1) - to_months([0, 3, 6, 9][(o_orderkey % 4 + 1)::INT])) END AS period_end FROM orders")
def period_end(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 4
    period = F.when(k == 0, "FY").when(k == 1, "Q3").when(k == 2, "H1").otherwise("Q1")
    own = F.when(k == 0, F.col("o_orderdate").cast("date"))
    return o.select("o_orderkey", periods.period_end(own, F.year("o_orderdate"), period, F.lit(9)).alias("period_end"))


# --- filings and standardization --------------------------------------------------------


def cells(spark, sf_dir):
    """A cell per line item class: company, year, filing place (seq), account (line number), value."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("fy"), F.substring("o_orderpriority", 1, 1).cast("int").alias("seq"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey", "fy", "seq", "l_linenumber").agg(F.sum(F.floor(F.col("l_extendedprice") / 20000).cast("long")).alias("value"), F.max("l_returnflag").alias("track"))


_CELLS = "c AS (SELECT o_custkey, year(o_orderdate) AS fy, left(o_orderpriority, 1)::INT AS seq, l_linenumber, sum(floor(l_extendedprice / 20000)::BIGINT)::BIGINT AS value, max(l_returnflag) AS track FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)"


@query("o6_08_delta_merge", "#o_custkey #fy #l_linenumber #value #n_changes %amended", "SELECT o_custkey, fy, l_linenumber, arg_max(value, seq) AS value, count(*) FILTER (ch AND nth > 1) AS n_changes, count(*) FILTER (ch AND nth > 1) > 0 AS amended FROM (SELECT *, row_number() OVER w AS nth, lag(value) OVER w IS DISTINCT FROM value AS ch FROM c WINDOW w AS (PARTITION BY o_custkey, fy, l_linenumber ORDER BY seq)) GROUP BY 1, 2, 3", _CELLS)
def delta_merge(spark, sf_dir):
    return standardize.merged(cells(spark, sf_dir), ["o_custkey", "fy"], ["l_linenumber"], "value").withColumn("n_changes", F.size("amend_chain"))


@query("o6_09_track_replacement", "#o_custkey #fy #l_linenumber #value", "SELECT o_custkey, fy, l_linenumber, arg_max(value, seq) AS value FROM c JOIN (SELECT o_custkey, fy, max(CASE WHEN p <> t THEN seq END) AS start FROM (SELECT o_custkey, fy, seq, max(track) AS t, lag(max(track)) OVER (PARTITION BY o_custkey, fy ORDER BY seq) AS p FROM c GROUP BY 1, 2, 3) GROUP BY 1, 2) USING (o_custkey, fy) WHERE start IS NULL OR seq >= start GROUP BY 1, 2, 3", _CELLS)
def track_replacement(spark, sf_dir):
    return standardize.merged(cells(spark, sf_dir), ["o_custkey", "fy"], ["l_linenumber"], "value", track="track")


@query("o6_07_filing_chain", "#o_custkey #fy #rcept #seq", "SELECT o_custkey, fy, o_orderkey AS rcept, row_number() OVER (PARTITION BY o_custkey, fy ORDER BY filed NULLS FIRST, o_orderkey) AS seq FROM (SELECT *, year(o_orderdate) AS fy, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderdate END AS filed, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE quarter(o_orderdate) // 4 END AS pe, max(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE quarter(o_orderdate) // 4 END) OVER (PARTITION BY o_custkey, year(o_orderdate)) AS last FROM orders) WHERE pe IS NULL OR pe = last")
def filing_chain(spark, sf_dir):
    f = read(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("fy"), F.col("o_orderkey").alias("rcept"), F.when(F.col("o_orderkey") % 6 != 0, F.col("o_orderdate")).alias("filed_at"), F.when(F.col("o_orderkey") % 5 != 0, (F.quarter("o_orderdate") / 4).cast("int")).alias("period_end"))
    return standardize.chain(f, ["o_custkey", "fy"])


@query("o5_08_final_version", "#o_custkey #fy #o_orderkey", "SELECT o_custkey, year(o_orderdate) AS fy, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderstatus = 'F' DESC, o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1")
def final_version(spark, sf_dir):
    o = read(spark, sf_dir, "orders").withColumn("fy", F.year("o_orderdate"))
    return windows.top_n(o, ["o_custkey", "fy"], [(F.col("o_orderstatus") == "F").desc(), F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").desc()])


def _candidates(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.floor(F.col("l_extendedprice") / 9000).cast("long").alias("value"), "l_quantity", "l_returnflag", "l_linestatus", "l_discount")
    stage = F.when(F.col("l_quantity") < 15, "exact").when(F.col("l_quantity") < 35, "taxonomy").otherwise("fuzzy")
    return lines.select("l_orderkey", F.concat(F.lit("acct"), (F.col("l_linenumber") % 3).cast("string")).alias("code"), "value", stage.alias("stage"), F.col("l_returnflag").alias("label"), (F.round(F.col("l_discount") * 100) % 4).cast("int").alias("depth"), (F.col("l_linestatus") == "F").alias("is_total"), (F.col("l_returnflag") != "R").alias("is_current"))


_CAND = "k AS (SELECT DISTINCT l_orderkey, 'acct' || (l_linenumber % 3) AS code, CASE WHEN l_quantity < 15 THEN 3.0 WHEN l_quantity < 35 THEN 1.5 ELSE 1.0 END AS st, floor(l_extendedprice / 9000)::BIGINT AS value, l_returnflag AS label, (round(l_discount * 100)::INT % 4) AS depth, l_linestatus = 'F' AS is_total, l_returnflag <> 'R' AS is_current FROM lineitem)"
_STEPS = f"""{_CAND}, b AS (SELECT * FROM k QUALIFY st = max(st) OVER (PARTITION BY l_orderkey, code)), s1 AS (SELECT * FROM b QUALIFY is_current OR NOT bool_or(is_current) OVER (PARTITION BY l_orderkey, code)), s2 AS (SELECT * FROM s1 QUALIFY is_total OR NOT bool_or(is_total) OVER (PARTITION BY l_orderkey, code)),
  nz AS (SELECT * FROM s2 WHERE value <> 0), sh AS (SELECT * FROM nz QUALIFY depth = min(depth) OVER (PARTITION BY l_orderkey, code)),
  agg AS (SELECT l_orderkey, code, {', '.join(f"max(value) FILTER (src = '{s}') AS v_{s}, count(DISTINCT value) FILTER (src = '{s}') AS n_{s}" for s in ("k", "b", "s1", "s2", "nz", "sh"))}, min(value) FILTER (src = 's2') AS lo FROM ({' UNION ALL '.join(f"SELECT '{s}' AS src, l_orderkey, code, value FROM {s}" for s in ("k", "b", "s1", "s2", "nz", "sh"))}) GROUP BY 1, 2),
  sums AS (SELECT l_orderkey, code, sum(v)::BIGINT AS total FROM (SELECT DISTINCT l_orderkey, code, label, abs(value) AS v FROM k) GROUP BY 1, 2)"""


@query(
    "o6_15_conflict_resolution",
    "#l_orderkey code #value how #n_values",
    """SELECT l_orderkey, code, n_k AS n_values, CASE WHEN code = 'acct2' THEN total WHEN code = 'acct1' THEN CASE WHEN n_k = 1 THEN v_k END WHEN n_k = 1 THEN v_k WHEN n_b = 1 THEN v_b WHEN n_s1 = 1 THEN v_s1 WHEN n_s2 = 1 THEN v_s2 WHEN lo > 0 AND lo >= v_s2 * (1 - 0.001::DOUBLE) THEN v_s2 WHEN n_nz = 1 THEN v_nz WHEN n_sh = 1 THEN v_sh END AS value,
       CASE WHEN code = 'acct2' THEN 'sum' WHEN n_k = 1 THEN 'single' WHEN code = 'acct1' THEN 'held' WHEN n_b = 1 THEN 'stage' WHEN n_s1 = 1 THEN 'current' WHEN n_s2 = 1 THEN 'total' WHEN lo > 0 AND lo >= v_s2 * (1 - 0.001::DOUBLE) THEN 'near' WHEN n_nz = 1 THEN 'nonzero' WHEN n_sh = 1 THEN 'shallow' ELSE 'held' END AS how FROM agg JOIN sums USING (l_orderkey, code)""",
    _STEPS,
)
def conflict_resolution(spark, sf_dir):
    return standardize.resolved(_candidates(spark, sf_dir), ["l_orderkey"], additive=["acct2"], held=["acct1"])


@query("o6_12_unfilled", "#n_rows #n_units", "SELECT count(*) AS n_rows, count(DISTINCT corp || fy) AS n_units FROM lines WHERE NOT (basis, corp, fy, statement) IN (SELECT (basis, corp, fy, statement) FROM (SELECT basis, corp, fy, statement, max(abs(value)) AS most FROM lines GROUP BY ALL) WHERE most = 0 AND (basis, corp, fy) IN (SELECT (basis, corp, fy) FROM (SELECT basis, corp, fy, count(*) AS n, max(abs(value)) AS most FROM lines WHERE statement = 'BS' GROUP BY ALL) WHERE n >= 8 AND most = 0))", f"{A}, lines AS (SELECT corp, fy, CASE WHEN n % 2 = 0 THEN 'consolidated' ELSE 'separate' END AS basis, unnest(['BS', 'BS', 'BS', 'BS', 'BS', 'BS', 'BS', 'BS', 'IS', 'IS', 'CF']) AS statement, unnest([revenue, disc, tax, qty, cash, revenue, disc, tax, revenue, cogs, cfo]) * unnest([m, m, m, m, m, m, m, m, m, m, 1]) AS value FROM (SELECT *, CASE WHEN n % 7 = 0 THEN 0 ELSE 1 END AS m FROM a))")
def unfilled(spark, sf_dir):
    names = ["revenue", "disc", "tax", "qty", "cash", "revenue", "disc", "tax", "revenue", "cogs", "cfo"]
    kinds = ["BS"] * 8 + ["IS", "IS", "CF"]
    m = F.when(F.col("n") % 7 == 0, 0).otherwise(1)
    cell = F.array(*(F.struct(F.lit(k).alias("statement"), (F.col(c) * (F.lit(1) if k == "CF" else m)).cast("long").alias("value")) for k, c in zip(kinds, names, strict=True)))
    lines = annual(spark, sf_dir).select("corp", "fy", F.when(F.col("n") % 2 == 0, "consolidated").otherwise("separate").alias("basis"), F.inline(cell))
    kept = standardize.without_unfilled(lines, ["corp", "fy"])
    return kept.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(F.concat("corp", F.col("fy").cast("string"))).alias("n_units"))


@query("o6_14_reprints", "#l_suppkey #fy period #table_seq #n", "SELECT l_suppkey, fy, period, table_seq, count(*) AS n FROM x WHERE NOT EXISTS (SELECT 1 FROM (SELECT p.l_suppkey, p.fy, p.period, p.table_seq FROM pr p JOIN (SELECT DISTINCT l_suppkey, fy, period AS o, label, value FROM pr) z ON p.l_suppkey = z.l_suppkey AND p.fy = z.fy AND p.label = z.label AND p.value = z.value AND p.period <> z.o GROUP BY p.l_suppkey, p.fy, p.period, p.table_seq, z.o HAVING count(*) >= 3) s WHERE s.l_suppkey = x.l_suppkey AND s.fy = x.fy AND s.period = x.period AND s.table_seq = x.table_seq) GROUP BY ALL", "x AS (SELECT l_suppkey, year(l_shipdate) AS fy, ['Q1', 'H1', 'Q3', 'FY'][quarter(l_shipdate)::INT] AS period, l_linenumber AS table_seq, l_returnflag || l_linestatus AS label, floor(l_quantity / 10)::BIGINT AS value FROM lineitem), pr AS (SELECT DISTINCT * FROM x WHERE period <> 'FY' AND fy <= 1999)")
def reprints(spark, sf_dir):
    x = read(spark, sf_dir, "lineitem").select("l_suppkey", F.year("l_shipdate").alias("fy"), F.element_at(F.array(*map(F.lit, ("Q1", "H1", "Q3", "FY"))), F.quarter("l_shipdate")).alias("period"), F.lit("IS").alias("statement"), F.col("l_linenumber").alias("table_seq"), F.concat("l_returnflag", "l_linestatus").alias("label"), F.floor(F.col("l_quantity") / 10).cast("long").alias("value"), F.lit(True).alias("is_cumulative"))
    return standardize.without_reprints(x, ["l_suppkey"], 1999, 3).groupBy("l_suppkey", "fy", "period", "table_seq").agg(F.count(F.lit(1)).alias("n"))


@query("o6_18_attribution", "corp #fy #controlling_ni #noncontrolling_ni", "SELECT corp, fy, CASE WHEN n0 = 1 THEN c0 WHEN n0 = 0 AND n2 = 1 THEN c2 END AS controlling_ni, CASE WHEN n0 = 1 THEN m0 WHEN n0 = 0 AND n2 = 1 THEN m2 END AS noncontrolling_ni FROM (SELECT corp, fy, count(*) FILTER (d = 0) AS n0, max(c) FILTER (d = 0) AS c0, max(m) FILTER (d = 0) AS m0, count(*) FILTER (d <= 2) AS n2, max(c) FILTER (d <= 2) AS c2, max(m) FILTER (d <= 2) AS m2 FROM (SELECT DISTINCT corp, fy, c, m, abs(c + m - net_income) AS d FROM (SELECT corp, fy, net_income, unnest([net_income - qty, net_income - qty + 1, net_income + n % 2 * 5]) AS c, [qty, qty + n % 3, 0] AS ms FROM a), unnest(ms) t(m)) GROUP BY 1, 2)", A)
def attribution(spark, sf_dir):
    a = annual(spark, sf_dir).withColumns({"controlling": F.expr("array_distinct(array(net_income - qty, net_income - qty + 1, net_income + n % 2 * 5))"), "noncontrolling": F.expr("array(qty, qty + n % 3)")}).drop("controlling_ni")
    return standardize.attribution(a)


@query("o6_17_revenue_identity", "corp #fy #revenue", "SELECT corp, fy, CASE WHEN NOT coalesce(abs(r - cogs - gross_profit) <= 2, false) AND n1 = 1 THEN v1 ELSE r END AS revenue FROM (SELECT corp, fy, cogs, gross_profit, r, (SELECT count(DISTINCT v) FROM unnest(l) t(v) WHERE abs(v - abs(cogs) - gross_profit) <= 2) AS n1, (SELECT max(v) FROM unnest(l) t(v) WHERE abs(v - abs(cogs) - gross_profit) <= 2) AS v1 FROM (SELECT corp, fy, abs(cogs) AS cogs, gross_profit, revenue + (n % 3) * 1000 AS r, [revenue, revenue + (n % 5 % 2) * 1, revenue + 777] AS l FROM a))", A)
def revenue_identity(spark, sf_dir):
    a = annual(spark, sf_dir).withColumns({"cogs": F.abs("cogs"), "candidates": F.expr("array(revenue, revenue + (n % 5 % 2) * 1, revenue + 777)"), "revenue": F.expr("revenue + (n % 3) * 1000")})
    return standardize.revenue_by_identity(a)


@query("o6_21_identities", "corp #fy #tax #expense", "SELECT corp, fy, CASE WHEN abs(ebt + t - net_income) <= 2 AND NOT abs(ebt - t - net_income) <= 2 THEN -t ELSE t END AS tax, CASE WHEN abs(gross_profit + e - operating_income) <= slack AND NOT abs(gross_profit - e - operating_income) <= slack THEN -e WHEN NOT abs(gross_profit - e - operating_income) <= slack AND e < 0 THEN -e ELSE e END AS expense FROM (SELECT *, tax_expense * CASE WHEN n % 2 = 0 THEN -1 ELSE 1 END AS t, (gross_profit - operating_income) * CASE WHEN n % 3 = 0 THEN -1 ELSE 1 END AS e, greatest(1000, abs(gross_profit) / 100000.0::DOUBLE) AS slack FROM a)", A)
def sign_identities(spark, sf_dir):
    a = annual(spark, sf_dir).withColumns({"t": F.expr("tax_expense * CASE WHEN n % 2 = 0 THEN -1 ELSE 1 END"), "e": F.expr("(gross_profit - operating_income) * CASE WHEN n % 3 = 0 THEN -1 ELSE 1 END")})
    return a.withColumns({"tax": standardize.signed_tax(F.col("ebt"), F.col("t"), F.col("net_income")), "expense": sign_fixed_expense("e", "gross_profit", "operating_income")})


@query("o6_24_wide_columns", "#l_orderkey #first #second #third", "SELECT l_orderkey, coalesce(max(v) FILTER (l_linenumber = 1), max(v) FILTER (l_linenumber = 2)) AS first, max(v) FILTER (l_linenumber = 3) AS second, coalesce(max(v) FILTER (l_linenumber = 7), max(v) FILTER (l_linenumber = 6), max(v) FILTER (l_linenumber = 5)) AS third FROM (SELECT l_orderkey, l_linenumber, floor(l_extendedprice)::BIGINT AS v FROM lineitem) GROUP BY 1")
def wide_columns(spark, sf_dir):
    facts = read(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("string").alias("code"), F.floor("l_extendedprice").cast("long").alias("value"))
    return standardize.to_columns(facts, ["l_orderkey"], {"first": ["1", "2"], "second": ["3"], "third": ["7", "6", "5"]})


@query("o6_34_derived", "corp #fy #ebitda #fcf #net_debt", "SELECT corp, fy, CASE WHEN da_total > 0 THEN operating_income + da_total END AS ebitda, cfo - abs(capex) AS fcf, CASE WHEN s IS NOT NULL OR long_term_debt IS NOT NULL THEN coalesce(s, 0) + coalesce(long_term_debt, 0) - cash END AS net_debt FROM (SELECT *, CASE WHEN n % 4 = 1 THEN NULL ELSE short_term_debt END AS s FROM a)", A)
def derived(spark, sf_dir):
    a = annual(spark, sf_dir).withColumn("short_term_debt", F.expr("CASE WHEN n % 4 = 1 THEN NULL ELSE short_term_debt END"))
    return a.withColumns(standardize.derived())


@query("o6_38_cross_year_grade", "corp #fy #cross_grade", "SELECT corp, fy, greatest(data_quality, CASE WHEN m >= 1000 AND (r > 200 OR r < 1 / 200.0) THEN 3 WHEN m >= 1000 AND r > 30 THEN 2 ELSE 1 END) AS cross_grade FROM (SELECT *, abs(v)::DOUBLE / nullif(m, 0) AS r FROM (SELECT *, median(CASE WHEN data_quality < 3 THEN abs(v)::DOUBLE END) OVER (PARTITION BY corp ORDER BY fy ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM (SELECT *, CASE WHEN n % 6 = 0 THEN fcf * 300 WHEN n % 6 = 1 THEN fcf * 40 ELSE fcf END AS v FROM a)))", A)
def cross_year_grade(spark, sf_dir):
    a = annual(spark, sf_dir).withColumn("v", F.expr("CASE WHEN n % 6 = 0 THEN fcf * 300 WHEN n % 6 = 1 THEN fcf * 40 ELSE fcf END"))
    return standardize.cross_year_grade(a, ["corp"], "fy", "v", "data_quality", 1000)


@query("o6_41_share_count", "#o_orderkey #shares_out", "SELECT o.o_orderkey, coalesce(CASE WHEN s.o_orderkey % 3 = 0 THEN s.o_orderkey * 10 END, n.newest) AS shares_out FROM orders o LEFT JOIN orders s ON o.o_orderkey = s.o_orderkey LEFT JOIN (SELECT o_custkey, max(o_orderkey) * 10 AS newest FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1) n ON o.o_custkey = n.o_custkey")
def share_count(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    shares = o.withColumn("shares", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey") * 10))
    return standardize.share_count(o, shares, ["o_custkey"], "o_orderkey")


@query("o6_46_metric_merge", "#o_custkey l_returnflag #occurrence #value", "SELECT o_custkey, l_returnflag, occurrence, arg_max(v, seq) AS value FROM (SELECT o_custkey, l_returnflag, v, seq, row_number() OVER (PARTITION BY o_custkey, l_returnflag, seq ORDER BY v) AS occurrence FROM (SELECT DISTINCT o_custkey, l_returnflag, left(o_orderpriority, 1)::INT AS seq, floor(l_quantity)::BIGINT AS v FROM lineitem JOIN orders ON l_orderkey = o_orderkey)) GROUP BY 1, 2, 3")
def metric_merge(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("seq"))
    x = read(spark, sf_dir, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "l_returnflag", "seq", F.floor("l_quantity").cast("long").alias("value")).distinct()
    return standardize.merged_metrics(x, ["o_custkey"], ["l_returnflag"], "value", "value")


@query("o6_48_source_tiers", "#l_partkey #html #pdf tier adopt", "SELECT *, CASE WHEN tier = 'T1' THEN CASE WHEN nh >= np THEN 'html' ELSE 'pdf' END WHEN pdf IS NULL THEN 'html' WHEN html IS NULL THEN 'pdf' END AS adopt FROM (SELECT *, CASE WHEN coalesce(abs(html - pdf) <= 0.3::DOUBLE * greatest(abs(html), abs(pdf)), false) THEN 'T1' ELSE 'T3' END AS tier FROM (SELECT coalesce(h.l_partkey, p.l_partkey) AS l_partkey, html, pdf, nh, np FROM (SELECT l_partkey, sum(floor(l_quantity)::BIGINT)::BIGINT AS html, count(*) AS nh FROM lineitem WHERE l_linenumber <= 3 GROUP BY 1) h FULL JOIN (SELECT l_partkey, sum(floor(l_quantity)::BIGINT)::BIGINT AS pdf, count(*) AS np FROM lineitem WHERE l_linenumber BETWEEN 4 AND 6 GROUP BY 1) p ON h.l_partkey = p.l_partkey))")
def source_tiers(spark, sf_dir):
    x = read(spark, sf_dir, "lineitem").select("l_partkey", "l_linenumber", F.floor("l_quantity").cast("long").alias("value"))
    return standardize.source_tiers(x.where("l_linenumber <= 3"), x.where("l_linenumber BETWEEN 4 AND 6"), ["l_partkey"], 0.3)


@query("o6_50_outflow_signs", "corp #fy %flip", "SELECT corp, fy, coalesce(((h < 0 AND abs(s + h) <= slack) OR (h > 0 AND abs(s - h) <= slack) OR (abs(t - (i - s)) <= slack AND NOT abs(t - (i + s)) <= slack)), false) AND NOT coalesce((h < 0 AND abs(s - h) <= slack) OR (abs(t - (i + s)) <= slack AND NOT abs(t - (i - s)) <= slack), false) AND n % 4 > 0 AS flip FROM (SELECT *, qty AS s, CASE n % 4 WHEN 0 THEN -qty WHEN 1 THEN qty WHEN 2 THEN NULL ELSE -qty - 5000 END AS h, CASE WHEN n % 5 < 2 THEN cash - qty WHEN n % 5 < 4 THEN cash + qty END AS t, cash AS i, 1000 AS slack FROM a)", A)
def outflow_signs(spark, sf_dir):
    a = annual(spark, sf_dir).withColumns({"total": F.col("qty"), "header": F.expr("CASE n % 4 WHEN 0 THEN -qty WHEN 1 THEN qty WHEN 2 THEN NULL ELSE -qty - 5000 END"), "activity": F.expr("CASE WHEN n % 5 < 2 THEN cash - qty WHEN n % 5 < 4 THEN cash + qty END"), "inflow": F.col("cash"), "unit": F.lit(1), "n_positive": F.col("n") % 4, "n": F.lit(10)})
    return standardize.outflow_signs(a)


_ALIASES = (("r", "A1", "red widget", 1), ("r", "A2", "blue bolt", 2), ("r", "A3", "small ring", 3), ("r", "A4", "heavy gear", 4), ("s", "B1", "red bolt", 5), ("s", "B2", "large ring assembly", 6), ("s", "B3", "steel", 7))


@query(
    "o6_02_label_mapping",
    "section label code stage ~confidence",
    f"""SELECT section, label, CASE WHEN c1 IS NOT NULL THEN c1 WHEN c3 IS NOT NULL THEN c3 WHEN f IS NOT NULL AND score >= 0.88 THEN f END AS code, CASE WHEN c1 IS NOT NULL OR c3 IS NOT NULL THEN 'exact' WHEN score >= 0.88 THEN 'fuzzy' ELSE 'unknown' END AS stage, CASE WHEN c1 IS NOT NULL OR c3 IS NOT NULL THEN 1.0 WHEN score >= 0.88 THEN score ELSE 0.0 END AS confidence
      FROM (SELECT l.section, l.label, (SELECT min_by(code, place) FROM al WHERE al.section = l.section AND alias = l.label) AS c1, (SELECT min_by(code, place) FROM al WHERE alias = l.label) AS c3, arg_max(code, (sc, -place)) AS f, max(sc) AS score
            FROM l LEFT JOIN (SELECT l.section AS s, l.label AS b, code, place, CASE WHEN contains(l.label, alias) OR contains(alias, l.label) THEN CASE WHEN least(length(l.label), length(alias)) / greatest(length(l.label), length(alias))::DOUBLE < 0.65 AND least(length(l.label), length(alias)) <= 4 THEN NULL ELSE 0.9::DOUBLE + 0.09::DOUBLE * (least(length(l.label), length(alias)) / greatest(length(l.label), length(alias))::DOUBLE) END WHEN jaro_winkler_similarity(l.label, alias) >= 0.88 THEN jaro_winkler_similarity(l.label, alias) END AS sc FROM l JOIN al ON al.section = l.section) z ON z.s = l.section AND z.b = l.label AND sc IS NOT NULL GROUP BY 1, 2)""",
    f"l AS (SELECT DISTINCT CASE WHEN p_size % 2 = 0 THEN 'r' ELSE 's' END AS section, p_name AS label FROM part), al AS (SELECT * FROM (VALUES {', '.join(map(str, _ALIASES))}) t(section, code, alias, place))",
)
def label_mapping(spark, sf_dir):
    labels = read(spark, sf_dir, "part").select(F.when(F.col("p_size") % 2 == 0, "r").otherwise("s").alias("section"), F.col("p_name").alias("label"))
    aliases = spark.createDataFrame(_ALIASES, "section string, code string, alias string, place int")
    return text.map_labels(labels, aliases)


@query("o6_05_amounts", "#o_orderkey #value", "SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN floor(o_totalprice)::BIGINT * 1000 WHEN 1 THEN -floor(o_totalprice)::BIGINT * 1000 WHEN 2 THEN NULL WHEN 3 THEN -floor(o_totalprice)::BIGINT * 1000 WHEN 4 THEN floor(o_totalprice)::BIGINT WHEN 5 THEN NULL END AS value FROM orders")
def amounts(spark, sf_dir):
    v = F.floor("o_totalprice").cast("long")
    shown = F.format_number(v, 0)
    k = F.col("o_orderkey") % 6
    printed = F.when(k == 0, shown).when(k == 1, F.concat(F.lit("("), shown, F.lit(")"))).when(k == 2, F.lit("-")).when(k == 3, F.concat(F.lit("△ "), shown)).when(k == 4, F.concat(v.cast("string"), F.lit(" 원"))).otherwise(F.concat(shown, F.lit(" 12,345,678")))
    return text.with_amounts(read(spark, sf_dir, "orders").select("o_orderkey", printed.alias("printed")), "printed", F.lit(1000))


@query("o6_04_label_keys", "#p_partkey key", "SELECT p_partkey, p_name AS key FROM part")
def label_keys(spark, sf_dir):
    k = F.col("p_partkey") % 5
    dressed = F.when(k == 0, F.concat(F.lit("1. "), "p_name")).when(k == 1, F.concat(F.lit("Ⅲ. "), "p_name", F.lit(" (주석 5,6)"))).when(k == 2, F.concat(F.lit("[ "), "p_name", F.lit("]  "))).when(k == 3, F.concat(F.lit("(2) "), F.regexp_replace("p_name", " ", "   "))).otherwise(F.concat(F.lit("• "), "p_name", F.lit(",3,4>")))
    return read(spark, sf_dir, "part").select("p_partkey", text.label_key(dressed).alias("key"))


# --- checks -----------------------------------------------------------------------------


def _tables(spark, sf_dir):
    a = annual(spark, sf_dir).withColumns({"period_end": F.make_date("fy", F.lit(12), F.lit(31)), "total_assets": F.expr("CASE WHEN n % 19 = 0 THEN 0 WHEN n % 23 = 0 THEN total_assets + total_assets div 10 ELSE total_assets END"), "net_income": F.expr("CASE WHEN n % 12 = 0 THEN operating_income ELSE net_income END")})
    return {"rows": a}


_BENT = f"{A}, t AS (SELECT * REPLACE (CASE WHEN n % 19 = 0 THEN 0 WHEN n % 23 = 0 THEN total_assets + total_assets // 10 ELSE total_assets END AS total_assets, CASE WHEN n % 12 = 0 THEN operating_income ELSE net_income END AS net_income) FROM a)"


@query("o10_01_row_assertions", "name severity #n_violations", "SELECT 'future_period' AS name, 'ERROR' AS severity, count(*) FILTER (make_date(fy::INT, 12, 31) > DATE '2000-12-31' AND data_quality < 3) AS n_violations FROM t UNION ALL SELECT 'impossible_shares', 'ERROR', count(*) FILTER (shares_out > 100000000000) FROM t UNION ALL SELECT 'impossible_cap', 'ERROR', count(*) FILTER (market_cap > 5000000000000000000) FROM t UNION ALL SELECT 'assets_not_positive', 'ERROR', count(*) FILTER (total_assets <= 0) FROM t UNION ALL SELECT 'assets_too_large', 'WARN', count(*) FILTER (total_assets > 2000000000000000) FROM t UNION ALL SELECT 'revenue_too_large', 'WARN', count(*) FILTER (abs(revenue) > 1000000000000000) FROM t UNION ALL SELECT 'operating_equals_net', 'WARN', count(*) FILTER (operating_income = net_income AND operating_income <> 0) FROM t UNION ALL SELECT 'balance_identity', 'ERROR', count(*) FILTER (abs(total_assets - total_liabilities - total_equity)::DOUBLE > 0.03::DOUBLE * abs(total_assets)) FROM t", _BENT)
def row_assertions(spark, sf_dir):
    return checks.counts(checks.row_assertions(F.to_date(F.lit("2000-12-31"))), _tables(spark, sf_dir))


@query("o10_03_incomplete_years", "corp #fy #n", "SELECT corp, fy, count(*) AS n FROM qs GROUP BY 1, 2 HAVING count(*) < 4", Q)
def incomplete_years(spark, sf_dir):
    q = quarterly(spark, sf_dir).select("corp", F.col("fy").alias("cy"), F.col("q").alias("cq"))
    return checks.incomplete_years(q, q.select("corp", "cy").distinct(), ["corp"]).withColumn("fy", F.col("cy"))


@query("o10_13_attribution_excess", "corp #fy #net_income #controlling_ni", "SELECT * FROM (SELECT corp, fy, net_income, net_income + n % 4 * 2000000 AS controlling_ni FROM a) WHERE abs(controlling_ni) > abs(net_income) * (1 + 0.02::DOUBLE) + 1000000", A)
def attribution_excess(spark, sf_dir):
    return checks.attribution_excess(annual(spark, sf_dir).withColumn("controlling_ni", F.col("net_income") + F.col("n") % 4 * 2000000))


@query("o10_17_identities", "corp #fy %assets_ok %gross_ok %operating_ok %net_ok", "SELECT corp, fy, abs(total_assets - (total_liabilities + total_equity))::DOUBLE <= 0.005::DOUBLE * greatest(abs(total_assets), abs(total_liabilities + total_equity), 1) AS assets_ok, abs(gross_profit - (revenue - cogs))::DOUBLE <= 0.005::DOUBLE * greatest(abs(gross_profit), abs(revenue - cogs), 1) AS gross_ok, abs(operating_income - (gross_profit - sga))::DOUBLE <= 0.005::DOUBLE * greatest(abs(operating_income), abs(gross_profit - sga), 1) AS operating_ok, abs(net_income - (ebt - tax_expense))::DOUBLE <= 0.005::DOUBLE * greatest(abs(net_income), abs(ebt - tax_expense), 1) AS net_ok FROM (SELECT *, CASE WHEN n % 3 = 0 THEN NULL ELSE tax * 10 + (n % 2) * 900000000 END AS sga FROM t)", _BENT)
def identities(spark, sf_dir):
    return checks.identities(_tables(spark, sf_dir)["rows"].withColumn("sga", F.expr("CASE WHEN n % 3 = 0 THEN NULL ELSE tax * 10 + (n % 2) * 900000000 END")))


@query("o10_18_equity_breaks", "corp #fy kind", "SELECT x.corp, x.fy, CASE WHEN sign(x.fcf) * sign(y.fcf) < 0 THEN 'sign' ELSE 'jump' END AS kind FROM a x JOIN a y ON x.corp = y.corp AND y.fy = x.fy - 1 WHERE sign(x.fcf) * sign(y.fcf) < 0 OR (y.fcf <> 0 AND (abs(x.fcf) > 10.0 * abs(y.fcf) OR abs(x.fcf) * 10.0 < abs(y.fcf)))", A)
def equity_breaks(spark, sf_dir):
    return checks.equity_breaks(annual(spark, sf_dir).withColumn("total_equity", F.col("fcf")), ["corp"], "fy")


@query("o10_20_anomaly", "#l_orderkey #l_linenumber kind #n", "SELECT l_orderkey, l_linenumber, kind, count(*) AS n FROM (SELECT l_orderkey, l_linenumber, CASE WHEN p = s THEN NULL WHEN p = -s THEN 'SIGN' WHEN starts_with(abs(p)::VARCHAR, abs(s)::VARCHAR) THEN 'DIGIT_TRUNC' WHEN starts_with(abs(s)::VARCHAR, abs(p)::VARCHAR) THEN 'DIGIT_EXTRA' ELSE 'OTHER' END AS kind FROM (SELECT *, floor(l_extendedprice)::BIGINT AS p, CASE l_linenumber % 5 WHEN 0 THEN floor(l_extendedprice)::BIGINT WHEN 1 THEN -floor(l_extendedprice)::BIGINT WHEN 2 THEN floor(l_extendedprice)::BIGINT // 100 WHEN 3 THEN floor(l_extendedprice)::BIGINT * 10 ELSE floor(l_extendedprice)::BIGINT + 7 END AS s FROM lineitem)) WHERE kind IS NOT NULL GROUP BY 1, 2, 3")
def anomaly(spark, sf_dir):
    p = F.floor("l_extendedprice").cast("long")
    s = F.when(F.col("l_linenumber") % 5 == 0, p).when(F.col("l_linenumber") % 5 == 1, -p).when(F.col("l_linenumber") % 5 == 2, (p / 100).cast("long")).when(F.col("l_linenumber") % 5 == 3, p * 10).otherwise(p + 7)
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", checks.anomaly(p, s).alias("kind")).where("kind IS NOT NULL").groupBy("l_orderkey", "l_linenumber", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("o10_22_roll_forward", "#l_orderkey #opening #moves #closing #gap why", "SELECT *, CASE WHEN gap = 0 THEN 'closed' WHEN gap % 2 = 0 AND list_contains(e, gap // 2) THEN 'sign' WHEN list_contains(e, gap) OR list_contains(e, -gap) THEN 'shift' ELSE 'open' END AS why FROM (SELECT *, opening + coalesce(moves, 0) - closing AS gap FROM (SELECT l_orderkey, sum(v) FILTER (l_linenumber = 1)::BIGINT AS opening, sum(v) FILTER (l_linenumber BETWEEN 2 AND 6)::BIGINT AS moves, sum(v) FILTER (l_linenumber = 7)::BIGINT AS closing, list(DISTINCT v) FILTER (l_linenumber BETWEEN 2 AND 6) AS e FROM (SELECT l_orderkey, l_linenumber, floor(l_quantity / 12)::BIGINT AS v FROM lineitem) GROUP BY 1))")
def roll_forward(spark, sf_dir):
    role = F.when(F.col("l_linenumber") == 1, "open").when(F.col("l_linenumber") == 7, "close").otherwise("move")
    c = read(spark, sf_dir, "lineitem").select("l_orderkey", role.alias("role"), F.floor(F.col("l_quantity") / 12).cast("long").alias("value"), F.lit(False).alias("is_subtotal"))
    return checks.roll_forward(c, ["l_orderkey"])


@query("o10_24_gate", "#l_orderkey gate #n_fields", "SELECT l_orderkey, CASE WHEN count(*) FILTER (st = 'fail' AND b) > 0 THEN 'fail_a' WHEN count(*) FILTER (st = 'fail' AND NOT b) > 0 THEN 'fail_b' WHEN count(*) FILTER (st <> 'pass') = 0 THEN 'pass' ELSE 'pending' END AS gate, count(*) AS n_fields FROM (SELECT l_orderkey, l_linenumber <= 3 AS b, CASE l_returnflag WHEN 'A' THEN 'pass' WHEN 'N' THEN CASE WHEN l_quantity < 45 THEN 'pass' ELSE 'pending' END ELSE CASE WHEN l_quantity < 40 THEN 'pass' ELSE 'fail' END END AS st FROM lineitem) GROUP BY 1")
def gate(spark, sf_dir):
    return checks.gate(_fields(spark, sf_dir), ["l_orderkey"])


def _fields(spark, sf_dir):
    st = F.when(F.col("l_returnflag") == "A", "pass").when(F.col("l_returnflag") == "N", F.when(F.col("l_quantity") < 45, "pass").otherwise("pending")).otherwise(F.when(F.col("l_quantity") < 40, "pass").otherwise("fail"))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_linenumber") <= 3).alias("blocking"), st.alias("status"))


@query("o2_14_gated", "#o_orderkey", "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber <= 3 AND l_returnflag NOT IN ('A', 'N') AND l_quantity >= 40)")
def gated(spark, sf_dir):
    audits = checks.gate(_fields(spark, sf_dir), ["l_orderkey"]).withColumnRenamed("l_orderkey", "o_orderkey")
    return checks.gated(read(spark, sf_dir, "orders").select("o_orderkey"), audits, ["o_orderkey"])


@query("o10_28_changed_scopes", "#user_id event_type change", "SELECT coalesce(b.user_id, a.user_id) AS user_id, coalesce(b.event_type, a.event_type) AS event_type, CASE WHEN b.h IS NULL THEN 'added' WHEN a.h IS NULL THEN 'removed' ELSE 'changed' END AS change FROM (SELECT user_id, event_type, md5(string_agg(event_id::VARCHAR, chr(10) ORDER BY event_id::VARCHAR)) AS h FROM events WHERE event_id % 7 <> 0 GROUP BY 1, 2) b FULL JOIN (SELECT user_id, event_type, md5(string_agg(event_id::VARCHAR, chr(10) ORDER BY event_id::VARCHAR)) AS h FROM events WHERE event_id % 7 <> 0 AND user_id % 3 = 0 OR event_id % 11 = 0 GROUP BY 1, 2) a ON b.user_id = a.user_id AND b.event_type = a.event_type WHERE b.h IS DISTINCT FROM a.h")
def changed_scopes(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    digest = lambda df: aggregates.content_hash(df, ["user_id", "event_type"], F.col("event_id").cast("string"))
    return checks.changed_scopes(digest(e.where("event_id % 7 <> 0")), digest(e.where("event_id % 7 <> 0 AND user_id % 3 = 0 OR event_id % 11 = 0")), ["user_id"], "event_type", "content_hash")


@query("o10_29_slot_status", "#o_custkey #n_open #n_done #n status", "SELECT o_custkey, count(*) FILTER (o_orderstatus = 'O') AS n_open, count(*) FILTER (o_orderstatus = 'F') AS n_done, count(*) AS n, CASE WHEN count(*) FILTER (o_orderstatus = 'O') > 0 THEN 'open' WHEN count(*) FILTER (o_orderstatus = 'F') = count(*) THEN 'done' ELSE 'waiting' END AS status FROM orders GROUP BY 1")
def slot_status(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_custkey", F.when(F.col("o_orderstatus") == "O", "open").when(F.col("o_orderstatus") == "F", "done").otherwise("waiting").alias("state"))
    return checks.slot_status(o, ["o_custkey"])


@query("o10_25_orphans", "#l_orderkey #l_partkey", "SELECT l_orderkey, l_partkey FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size < 45)")
def orphans(spark, sf_dir):
    parents = read(spark, sf_dir, "part").where("p_size < 45").select(F.col("p_partkey").alias("l_partkey"))
    return checks.orphans(read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey"), parents, ["l_partkey"])


@query("o10_16_duplicates", "#l_orderkey #l_linenumber #n", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1 AND bool_or(l_linestatus = 'F')")
def duplicates(spark, sf_dir):
    return checks.duplicates(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], F.col("l_linestatus") == "F")


@query("o10_14_repeated_quarters", "corp #fy", "SELECT x.corp, x.fy FROM h x JOIN h y ON x.corp = y.corp AND y.fy = x.fy + 1 WHERE x.v IS NOT DISTINCT FROM y.v AND x.w IS NOT DISTINCT FROM y.w AND x.v IS NOT NULL", f"{Q}, h AS (SELECT corp, fy, n // 8 AS v, CASE WHEN n % 2 = 0 THEN NULL ELSE q END AS w FROM qs WHERE q = 1)")
def repeated_quarters(spark, sf_dir):
    h = quarterly(spark, sf_dir).where("q = 1").select("corp", "fy", F.expr("n div 8").alias("v"), F.expr("CASE WHEN n % 2 = 0 THEN NULL ELSE q END").alias("w"))
    return checks.repeated_quarters(h, ["corp"], "fy", ["v", "w"])


# --- composed reads ---------------------------------------------------------------------


@query("o9_21_source_drill_down", "corp #fy #n_filings statements", "SELECT corp, fy, count(DISTINCT o_orderpriority) AS n_filings, string_agg(DISTINCT st, ',' ORDER BY st) AS statements FROM (SELECT c_nationkey || '-' || c_mktsegment AS corp, year(o_orderdate) AS fy, o_orderpriority, o_orderstatus AS st FROM orders JOIN customer ON o_custkey = c_custkey) GROUP BY 1, 2")
def source_drill_down(spark, sf_dir):
    lines = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return lines.groupBy(F.concat_ws("-", "c_nationkey", "c_mktsegment").alias("corp"), F.year("o_orderdate").alias("fy")).agg(F.count_distinct("o_orderpriority").alias("n_filings"), F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ",").alias("statements"))


@query("o9_20_latest_year_profile", "#o_custkey #fy #o_orderkey #place", "SELECT o_custkey, fy, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY pct DESC NULLS LAST, o_orderkey) AS place FROM (SELECT o_custkey, year(o_orderdate) AS fy, o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice END AS pct FROM orders QUALIFY year(o_orderdate) = max(year(o_orderdate)) OVER (PARTITION BY o_custkey))")
def latest_year_profile(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("fy"), "o_orderkey", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice")).alias("pct"))
    newest = o.groupBy("o_custkey").agg(F.max("fy").alias("fy"))
    return windows.top_n(o.join(newest, ["o_custkey", "fy"]), ["o_custkey"], [F.col("pct").desc_nulls_last(), F.col("o_orderkey")], 10**9, rank="place")


@query("o9_23_event_classes", "#event_id kind", "SELECT event_id, CASE WHEN event_type = 'error' AND contains(props, '9') THEN 'lift' WHEN event_type = 'error' THEN 'halt' WHEN contains(event_type, 'i') AND value > 50 THEN 'notice' WHEN contains(event_type, 'c') THEN 'capital' ELSE 'other' END AS kind FROM events")
def event_classes(spark, sf_dir):
    t = F.col("event_type")
    kind = F.when((t == "error") & F.col("props").contains("9"), "lift").when(t == "error", "halt").when(t.contains("i") & (F.col("value") > 50), "notice").when(t.contains("c"), "capital").otherwise("other")
    return read(spark, sf_dir, "events").select("event_id", kind.alias("kind"))


@query("o9_25_universe", "#c_custkey c_name", "SELECT c_custkey, c_name FROM customer WHERE NOT regexp_matches(c_name, '(77|13)$') AND NOT starts_with(c_custkey::VARCHAR, '9')")
def universe(spark, sf_dir):
    return read(spark, sf_dir, "customer").where(~F.col("c_name").rlike("(77|13)$") & ~F.col("c_custkey").cast("string").startswith("9"))


@query("o2_06_company_search", "#c_custkey c_name", "SELECT c_custkey, c_name FROM customer WHERE c_name ILIKE '%omer#00000001%' OR c_custkey::VARCHAR LIKE '12%' ORDER BY c_name ILIKE 'omer%' DESC, length(c_name), c_name LIMIT 30")
def company_search(spark, sf_dir):
    q, code = "omer#00000001", "12"
    rows = read(spark, sf_dir, "customer").where(F.col("c_name").ilike(f"%{q}%") | F.col("c_custkey").cast("string").startswith(code))
    return rows.orderBy(F.col("c_name").ilike("omer%").desc(), F.length("c_name"), "c_name").limit(30)


@query("o8_22_anomaly_messages", "corp #fy message", f"SELECT corp, fy, unnest(list_filter([CASE WHEN gross_profit::DOUBLE / nullif(revenue, 0) > 0.6 THEN 'margin' END, CASE WHEN abs(net_income) > 4 * abs(p) AND p <> 0 THEN 'yoy' END], lambda x: x IS NOT NULL)) AS message FROM (SELECT x.*, y.net_income AS p FROM a x LEFT JOIN a y ON x.corp = y.corp AND y.fy = x.fy - 1)", A)
def anomaly_messages(spark, sf_dir):
    rows = windows.with_year_before(annual(spark, sf_dir), ["corp"], "fy", ["net_income"])
    said = F.array_compact(F.array(F.when(safe_div("gross_profit", "revenue") > 0.6, "margin"), F.when((F.abs("net_income") > 4 * F.abs("p_net_income")) & (F.col("p_net_income") != 0), "yoy")))
    return rows.select("corp", "fy", F.explode(F.array_distinct(said)).alias("message"))


@query("o8_20_tidy_metrics", "corp #fy metric ~value", "SELECT corp, fy, unnest(['revenue', 'net_income', 'fcf']) AS metric, unnest([revenue, net_income, fcf]) AS value FROM a", A)
def tidy_metrics(spark, sf_dir):
    return annual(spark, sf_dir).unpivot(["corp", "fy"], ["revenue", "net_income", "fcf"], "metric", "value")


@query("o8_21_chart_pivot", "corp #y1998 #y1999 #y2000", "SELECT corp, max(revenue) FILTER (fy = 1998) AS y1998, max(revenue) FILTER (fy = 1999) AS y1999, max(revenue) FILTER (fy = 2000) AS y2000 FROM a GROUP BY corp", A)
def chart_pivot(spark, sf_dir):
    return annual(spark, sf_dir).groupBy("corp").pivot("fy", [1998, 1999, 2000]).agg(F.max("revenue")).withColumnsRenamed({str(y): f"y{y}" for y in (1998, 1999, 2000)})


@query("o8_17_dividends", "corp #fy #dps ~payout ~dps_growth", f"SELECT corp, fy, dps, payout, CASE WHEN pd > 0 THEN (dps - pd)::DOUBLE / pd END AS dps_growth FROM (SELECT *, lag(dps) OVER (PARTITION BY corp ORDER BY fy) AS pd FROM (SELECT corp, fy, CASE WHEN dividends_paid <> 0 AND shares_out <> 0 THEN trunc(abs(dividends_paid)::DOUBLE / shares_out)::BIGINT END AS dps, CASE WHEN net_income > 0 AND dividends_paid <> 0 THEN abs(dividends_paid)::DOUBLE / net_income END AS payout FROM a))", A)
def dividends(spark, sf_dir):
    paid = F.when(F.col("dividends_paid") != 0, F.abs("dividends_paid"))
    rows = annual(spark, sf_dir).withColumns({"dps": F.try_divide(paid.cast("double"), F.col("shares_out")).cast("long"), "payout": F.when(F.col("net_income") > 0, safe_div(paid, "net_income"))})
    before = F.lag("dps").over(windows.over(["corp"], "fy"))
    return rows.withColumn("dps_growth", F.when(before > 0, (F.col("dps") - before).cast("double") / before))


@query("o8_18_shareholder_return", "corp #fy ~payout_pct #total_return", "SELECT corp, fy, coalesce(CASE WHEN n % 4 = 0 THEN n / 10.0::DOUBLE END, CASE WHEN net_income <> 0 THEN d * 1000000.0::DOUBLE / net_income * 100 END) AS payout_pct, coalesce(d, 0) * 1000000 + CASE WHEN n % 3 = 0 THEN qty ELSE 0 END AS total_return FROM (SELECT *, abs(dividends_paid) // 1000000 AS d FROM a)", A)
def shareholder_return(spark, sf_dir):
    a = annual(spark, sf_dir).withColumn("d", F.expr("abs(dividends_paid) div 1000000"))
    return a.withColumns({"payout_pct": F.coalesce(F.when(F.col("n") % 4 == 0, F.col("n") / 10), safe_div(F.col("d") * 1000000.0, "net_income") * 100), "total_return": F.coalesce("d", F.lit(0)) * 1000000 + F.when(F.col("n") % 3 == 0, F.col("qty")).otherwise(0)})


# --- grids ------------------------------------------------------------------------------


@query("o1_11_page_links", "#page_id #n_items #n_tables", "SELECT page_id, len(regexp_extract_all(html, '<li>')) AS n_items, 0 AS n_tables FROM pages")
def page_grids(spark, sf_dir):
    """Each page's list as a one-column table, through grid expansion."""
    table = F.concat(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col("html"), "<table", "<x"), "<ul>", "<table><tr><th>item</th></tr>"), "</ul>", "</table>"), "<li>(.*?)</li>", "<tr><td>$1</td></tr>"))
    g = grids.grids(read(spark, sf_dir, "pages").select("page_id", table.alias("html")), "html", ["page_id"])
    rows = grids.grid_rows(g, ["page_id", "table_ord"])
    return rows.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_items"), F.lit(0).alias("n_tables"))


@query("o1_10_node_roles", "#l_orderkey #l_linenumber #depth role", "SELECT l_orderkey, l_linenumber, depth, CASE WHEN lead(depth) OVER w > depth THEN 'P' WHEN lead(depth) OVER w IS NULL OR lead(depth) OVER w < depth THEN 'S' ELSE 'F' END AS role FROM (SELECT l_orderkey, l_linenumber, max(floor(l_quantity / 13)::BIGINT) AS depth FROM lineitem GROUP BY 1, 2) WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber)")
def node_roles(spark, sf_dir):
    d = read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max(F.floor(F.col("l_quantity") / 13)).cast("long").alias("depth"))
    return d.withColumn("role", grids.node_role(["l_orderkey"], "l_linenumber", "depth"))

