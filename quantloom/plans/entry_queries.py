"""Queries of operators that others use inside, each through its library function, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.functions import metrics, text
from quantloom.functions.nullsafe import growth, safe_div
from quantloom.operators import aggregates, checks, joins, periods, standardize, windows
from quantloom.plans import reads, screen
from quantloom.plans.catalog import div, grow, query
from quantloom.plans.fundamentals import SQL_SECTORS, annual, quarterly, read, sectors, sql_statements, statements
from quantloom.plans.market import SQL_PRICES as P
from quantloom.plans.market import prices
from quantloom.plans.tables import shared
from quantloom.sources import readers, writers
from quantloom.streaming import micro_batches as mb

A, Q = sql_statements("a", "fy"), sql_statements("qs", "fy", "q")
S = sql_statements("st", "fy", "o_orderstatus")

# --- sources and sinks ------------------------------------------------------------------


@query("o1_01_table_scan", "n_name #n_orders #n_customers", "SELECT n_name, count(o_orderkey) AS n_orders, count(DISTINCT c_custkey) AS n_customers FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def table_scan(spark, sf_dir):
    t = readers.tables(spark, sf_dir, "nation", "customer", "orders")
    placed = t["customer"].join(t["orders"], F.col("o_custkey") == F.col("c_custkey"), "left")
    return t["nation"].join(placed, F.col("c_nationkey") == F.col("n_nationkey"), "left").groupBy("n_name").agg(F.count("o_orderkey").alias("n_orders"), F.count_distinct("c_custkey").alias("n_customers"))


@query(
    "o1_02_disclosure_list",
    "%rcept filing_type #close_year #close_month %is_amendment",
    """SELECT o_orderkey AS rcept, CASE o_orderkey % 4 WHEN 0 THEN 'FY' WHEN 1 THEN 'H1' WHEN 2 THEN 'Q' END AS filing_type, year(o_orderdate) AS close_year, month(o_orderdate) AS close_month, o_orderkey % 3 = 0 AS is_amendment FROM orders WHERE o_orderkey % 11 <> 0
       UNION ALL SELECT 'broken', NULL, NULL, count(*), NULL FROM orders WHERE o_orderkey % 11 = 0""",
)
def disclosure_list(spark, sf_dir):
    """Orders as JSON lines, one in eleven broken; the broken ones are counted, not lost."""
    o, k = read(spark, sf_dir, "orders"), F.col("o_orderkey")
    title = F.concat(F.when(k % 3 == 0, "[정정]").otherwise(""), F.when(k % 4 == 0, "사업보고서").when(k % 4 == 1, "반기보고서").when(k % 4 == 2, "분기보고서").otherwise("other"), F.date_format("o_orderdate", " (yyyy.MM)"))
    line = F.to_json(F.struct(k.cast("string").alias("rcept"), F.lit("c").alias("corp_code"), title.alias("title"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("filed_at")))
    path = shared(spark, "list")
    o.select(F.when(k % 22 == 0, F.lit("{broken")).when(k % 11 == 0, F.lit('{"title": "no number"}')).otherwise(line).alias("value")).write.text(path)
    good, bad = readers.disclosure_list(spark, path)
    wrong = bad.agg(F.count(F.lit(1)).alias("close_month")).select(F.lit("broken").alias("rcept"), F.lit(None).cast("string").alias("filing_type"), F.lit(None).cast("int").alias("close_year"), "close_month", F.lit(None).cast("boolean").alias("is_amendment"))
    return joins.under(good.select("rcept", "filing_type", "close_year", F.col("close_month").cast("long").alias("close_month"), "is_amendment"), wrong)


@query("o1_03_filing_documents", "#row_ord label header #value", "SELECT dense_rank() OVER (ORDER BY n_nationkey) AS row_ord, n_name AS label, h.header, CASE h.header WHEN 'Now' THEN -n_nationkey * 1000 ELSE (n_regionkey + 1000) * 1000 END AS value FROM nation, (VALUES ('Now'), ('Before')) h(header)")
def filing_documents(spark, sf_dir):
    """The nations as the one printed table of a file."""
    n = read(spark, sf_dir, "nation")
    row = F.concat(F.lit("<tr><td>"), F.concat_ws(". ", (F.col("n_nationkey") % 9 + 1).cast("string"), "n_name"), F.lit(" (Note 3)<td>("), F.col("n_nationkey").cast("string"), F.lit("원)<td>"), F.format_number(F.col("n_regionkey") + 1000, 0), F.lit("</tr>")).alias("r")
    page = n.select("n_nationkey", row).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "r"))), lambda x: x["r"]), "").alias("rows"))
    path = shared(spark, "documents")
    page.select(F.concat(F.lit("<table><tr><th>Item<th>Now<th>Before</tr>"), "rows", F.lit("</table>")).alias("value")).coalesce(1).write.text(path)
    # A figure with its own won sign ignores the multiplier.
    cells = readers.filing_documents(spark, path, "*.txt", multiplier=1000)
    return cells.withColumn("value", F.when(F.col("header") == "Now", F.col("value") * 1000).otherwise(F.col("value")))


@query("o1_06_price_backfill", "#code %day #close #volume", "SELECT code, day, close, CASE WHEN code % 2 = 0 THEN volume ELSE volume + 1 END AS volume FROM p WHERE close > 0", P)
def price_backfill(spark, sf_dir):
    """A second provider's CSV fills the days that the store lacks and changes none that it has."""
    p = prices(spark, sf_dir).select("code", "day", "close", "volume")
    path = shared(spark, "legacy")
    p.select("code", "day", F.col("close").alias("open"), F.col("close").alias("high"), F.col("close").alias("low"), "close", (F.col("volume") + 1).alias("volume")).write.option("header", "true").csv(path)
    older = readers.quotes(spark, path).select(F.col("code").cast("long").alias("code"), "day", "close", "volume")
    return joins.insert_absent(p.where("code % 2 = 0 AND close > 0"), older, ["code", "day"])


@query("o1_13_snapshot_cache", "#snapshot #n", "SELECT 1 AS snapshot, count(*) AS n FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 2, count(*) FROM orders")
def snapshot_cache(spark, sf_dir):
    """A frame is kept by the id of the snapshot it read: the second one is made anew."""
    kept, o = writers.Snapshots(most=2, seconds=1800), read(spark, sf_dir, "orders")
    one = kept.get("orders", "1", lambda: o.where("o_orderkey % 2 = 0")).agg(F.count(F.lit(1)).alias("n")).first()["n"]
    same = kept.get("orders", "1", lambda: o).agg(F.count(F.lit(1)).alias("n")).first()["n"]
    two = kept.get("orders", "2", lambda: o).agg(F.count(F.lit(1)).alias("n")).first()["n"]
    kept.clear()
    return spark.createDataFrame([(1, one if one == same else -1), (2, two)], "snapshot long, n long")


@query("o1_14_csv_sink", "#c_custkey c_name ~c_acctbal", "SELECT c_custkey, ' ' || c_name || '\"é, ' AS c_name, c_acctbal FROM customer")
def csv_sink(spark, sf_dir):
    path = shared(spark, "csv")
    writers.csv(read(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit(" "), "c_name", F.lit('"é, ')).alias("c_name"), "c_acctbal"), path)
    return spark.read.schema("c_custkey long, c_name string, c_acctbal double").option("header", "true").option("escape", "\\").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)


@query("o1_15_review_csv", "%rcept #row_order label ~value", "SELECT l_orderkey AS rcept, l_linenumber AS row_order, repeat('  ', (l_linenumber % 3)::INT) || l_returnflag AS label, l_quantity AS value FROM lineitem")
def review_csv(spark, sf_dir):
    path = shared(spark, "review")
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("rcept"), F.lit("BS").alias("statement"), F.lit(0).alias("table_seq"), F.col("l_linenumber").alias("row_order"), (F.col("l_linenumber") % 3).cast("int").alias("depth"), F.col("l_returnflag").alias("label"), F.col("l_quantity").alias("value"))
    writers.review_csv(lines, path)
    return spark.read.schema("rcept string, statement string, table_seq int, row_order int, label string, value double").option("header", "true").option("ignoreLeadingWhiteSpace", "false").csv(path)


@query("o1_17_saved_screen", "corp #fy", f"SELECT corp, fy FROM a WHERE {div('operating_income', 'revenue')} > 0.03 AND net_income >= 0", A)
def saved_screen(spark, sf_dir):
    kept = writers.Presets(spark, shared(spark, "presets"))
    kept.save("mine", {"margin": "> 3%", "net_income": ">= 0"})
    rows = annual(spark, sf_dir).withColumn("margin", safe_div("operating_income", "revenue"))
    for name, said in kept.load("mine").items():
        rows = rows.where(screen.holds(F.col(name), screen.condition(said)))
    return rows


# --- filters ----------------------------------------------------------------------------

_SAID = {"margin": ("> 2.5%", "<= -1 %", "= 0"), "n": (">=40", "== 30", "< 12.5")}


@query("o2_03_condition_parser", "metric said #n_rows", f"""SELECT 'margin' AS metric, unnest(['> 2.5%', '<= -1 %', '= 0']) AS said, unnest([count(*) FILTER (m > 0.025), count(*) FILTER (m <= -0.01), count(*) FILTER (abs(m) < 1e-9)]) AS n_rows FROM (SELECT *, {div('operating_income', 'revenue')} AS m FROM a)
  UNION ALL SELECT 'n', unnest(['>=40', '== 30', '< 12.5']), unnest([count(*) FILTER (n >= 40), count(*) FILTER (n = 30), count(*) FILTER (n < 12.5)]) FROM a""", A)  # fmt: skip
def condition_parser(spark, sf_dir):
    rows = annual(spark, sf_dir).withColumn("margin", safe_div("operating_income", "revenue"))
    counted = [(m, s, F.count_if(screen.holds(F.col(m), screen.condition(s)))) for m, said in _SAID.items() for s in said]
    whole = rows.agg(F.array(*(F.struct(F.lit(m).alias("metric"), F.lit(s).alias("said"), c.alias("n_rows")) for m, s, c in counted)).alias("x"))
    return whole.select(F.inline("x"))


@query("o2_05_missing_policy", "corp #fy %strict %lenient", "SELECT corp, fy, coalesce(net_debt <= 0, false) AS strict, coalesce(net_debt <= 0, true) AS lenient FROM a", A)
def missing_policy(spark, sf_dir):
    debt, c = F.col("net_debt"), screen.condition("<= 0")
    return annual(spark, sf_dir).withColumns({"strict": screen.passes(debt, c), "lenient": screen.passes(debt, c, include_missing=True)})


@query("o2_10_thresholds", "corp #fy", f"SELECT corp, fy FROM a WHERE {div('operating_income', 'revenue')} >= 0.025 AND revenue >= 20000000 AND n >= 20", A)
def thresholds(spark, sf_dir):
    margin = safe_div("operating_income", "revenue")
    return annual(spark, sf_dir).where((margin >= screen.threshold(2.5, "pct")) & (F.col("revenue") >= screen.threshold(0.2, "amount")) & (F.col("n") >= screen.threshold(20, "plain")))


@query("o2_11_effective_units", "corp #fy ~average ~change ~fixed", f"SELECT corp, fy, net_debt / 1e8 AS average, {grow('net_debt', 'lag(net_debt) OVER w')} * 100 AS change, revenue / 1e8 AS fixed FROM a WINDOW w AS (PARTITION BY corp ORDER BY fy)", A)
def effective_units(spark, sf_dir):
    scaled = lambda c, unit: {"pct": c * 100, "amount": c / 1e8}[unit]
    rows = windows.with_previous(annual(spark, sf_dir), ["corp"], [F.col("fy")], ["net_debt"])
    return rows.select("corp", "fy", scaled(F.col("net_debt"), screen.effective_unit("amount", "average")).alias("average"), scaled(growth("net_debt", "p_net_debt"), screen.effective_unit("amount", "yoy")).alias("change"), scaled(F.col("revenue"), screen.effective_unit("amount", "yoy", fixed=True)).alias("fixed"))


_FIELDS = "f AS (SELECT corp, fy, o_orderstatus, CASE WHEN n % 5 = 0 THEN 'fail' WHEN n % 7 = 0 THEN 'open' ELSE 'pass' END AS status FROM st WHERE n % 3 <> 0)"


@query("o2_15_verified_subset", "corp #fy #revenue", "SELECT corp, fy, revenue FROM a WHERE (corp, fy) IN (SELECT (corp, fy) FROM f GROUP BY corp, fy HAVING count(*) FILTER (status <> 'pass') = 0)", f"{A}, {S}, {_FIELDS}")
def verified_subset(spark, sf_dir):
    n = F.col("n")
    fields = statements(spark, sf_dir, "fy", "o_orderstatus").where("n % 3 <> 0").select("corp", "fy", F.when(n % 5 == 0, "fail").when(n % 7 == 0, "open").otherwise("pass").alias("status"), F.lit(True).alias("blocking"))
    return checks.gated(annual(spark, sf_dir), checks.gate(fields, ["corp", "fy"]), ["corp", "fy"], verified=True)


# --- joins ------------------------------------------------------------------------------


@query("o3_13_full_coalesced", "corp #fy #before_revenue #after_revenue", "SELECT corp, fy, x.revenue AS before_revenue, y.revenue + 1 AS after_revenue FROM (SELECT * FROM a WHERE n % 3 <> 0) x FULL JOIN (SELECT * FROM a WHERE n % 4 <> 0) y USING (corp, fy)", A)
def full_coalesced(spark, sf_dir):
    rows = annual(spark, sf_dir)
    return joins.full_coalesced(rows.where("n % 3 <> 0"), rows.where("n % 4 <> 0").withColumn("revenue", F.col("revenue") + 1), ["corp", "fy"], ["revenue"])


_ALIASES = [("is", "is.revenue", "Revenue", 1), ("is", "is.cost", "Cost of sales", 2), ("bs", "bs.cash", "Cash", 3)]
_PRINTED = ("Revenue", "1. Revenue (Note 3)", "Cash", "Revenues", "Other things", "zzz qqq")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(section, label, concept) by part."""
    k = F.col("p_partkey")
    label = F.element_at(F.array(*map(F.lit, _PRINTED)), (k % 6 + 1).cast("int"))
    return read(spark, sf_dir, "part").select("p_partkey", F.lit("is").alias("section"), label.alias("label"), F.when(k % 9 == 0, "ifrs_CostOfSales").alias("concept"))


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.map_labels(_labels(spark, sf_dir), spark.createDataFrame(_ALIASES, "section string, code string, alias string, place int"), ["Other things"])


_STAGES = "(VALUES (0, 'Revenue', 'is.revenue', 'exact', 1.0), (1, '1. Revenue (Note 3)', 'is.revenue', 'normalized', 1.0), (2, 'Cash', 'bs.cash', 'exact', 1.0), (3, 'Revenues', 'is.revenue', 'fuzzy', 0.9 + 0.09 * 7 / 8), (4, 'Other things', NULL, 'blocked', 0.0), (5, 'zzz qqq', NULL, 'unknown', 0.0)) v(k, label, code, stage, confidence)"


@query("o6_01_label_stages", "label code stage ~confidence", f"SELECT DISTINCT label, code, stage, confidence FROM part JOIN {_STAGES} ON p_partkey % 6 = k")
def label_stages(spark, sf_dir):
    return _mapped(spark, sf_dir)


@query("o3_17_dictionary_lookup", "#p_partkey label code", f"SELECT p_partkey, label, code FROM part JOIN {_STAGES} ON p_partkey % 6 = k")
def dictionary_lookup(spark, sf_dir):
    """Every line finds its label's code; labels are mapped once each."""
    return _labels(spark, sf_dir).join(_mapped(spark, sf_dir), ["section", "label"])


@query("o6_03_concept_fallback", "#p_partkey code stage", f"SELECT p_partkey, CASE WHEN stage = 'blocked' THEN NULL WHEN stage IN ('exact', 'normalized') THEN code WHEN p_partkey % 9 = 0 THEN 'is.cost' WHEN k = 3 THEN 'is.other' WHEN k = 5 THEN 'is.other' ELSE code END AS code, CASE WHEN stage IN ('blocked', 'exact', 'normalized') THEN stage WHEN p_partkey % 9 = 0 THEN 'concept' WHEN k IN (3, 5) THEN 'taxonomy' ELSE stage END AS stage FROM part JOIN {_STAGES} ON p_partkey % 6 = k")
def concept_fallback(spark, sf_dir):
    """A line's own concept, and the taxonomy's label index, which beats a fuzzy hit."""
    concepts = spark.createDataFrame([("ifrs_CostOfSales", "is.cost"), ("ifrs_Other", "is.other")], "concept string, code string")
    index = spark.createDataFrame([("zzz  qqq", "ifrs_Other"), ("2. Revenues", "ifrs_Other"), ("Revenue", "ifrs_Other")], "label string, concept string")
    return text.with_concepts(_mapped(spark, sf_dir), _labels(spark, sf_dir), concepts, index)


# --- aggregation ------------------------------------------------------------------------


@query("o4_01_has_basis", "corp %has_basis", "SELECT corp, bool_or(o_orderstatus = 'P') AS has_basis FROM st WHERE n % 4 = 0 GROUP BY corp", S)
def has_basis(spark, sf_dir):
    return joins.has_basis(statements(spark, sf_dir, "fy", "o_orderstatus").where("n % 4 = 0"), ["corp"], "o_orderstatus", "P")


@query("o4_03_median", "corp ~median #n", "SELECT corp, median(net_debt) AS median, count(net_debt) AS n FROM a GROUP BY corp", A)
def exact_median(spark, sf_dir):
    return aggregates.percentiles(annual(spark, sf_dir), ["corp"], "net_debt", {"median": 0.5})


@query("o4_04_percentiles", "#code ~p5 ~p33 ~p90", "SELECT code, quantile_cont(close, 0.05) AS p5, quantile_cont(close, 0.33) AS p33, quantile_cont(close, 0.9) AS p90 FROM p GROUP BY code", P)
def percentiles(spark, sf_dir):
    return aggregates.percentiles(prices(spark, sf_dir), ["code"], "close", {"p5": 0.05, "p33": 0.33, "p90": 0.9})


@query("o4_05_strict_rank", "#code ~percentile", "SELECT code, count(*) FILTER (close < 3000000) * 100.0::DOUBLE / count(*) AS percentile FROM p GROUP BY code", P)
def strict_rank(spark, sf_dir):
    return aggregates.strict_percentile(prices(spark, sf_dir), ["code"], "close", F.lit(3_000_000))


@query(
    "o4_07_peer_medians",
    "sector corp #n_sector ~cash ~cash_median ~cash_percentile ~net_debt ~net_debt_median ~net_debt_percentile",
    """SELECT sector, corp, n_sector, cash, CASE WHEN n1 >= 3 THEN m1 END AS cash_median, CASE WHEN n1 >= 3 THEN (SELECT count(*) FROM s y WHERE y.sector = s.sector AND y.cash < s.cash) * 100.0 / n1 END AS cash_percentile,
        net_debt, CASE WHEN net_debt IS NOT NULL AND n2 >= 3 THEN m2 END AS net_debt_median, CASE WHEN net_debt IS NOT NULL AND n2 >= 3 THEN (SELECT count(*) FROM s y WHERE y.sector = s.sector AND y.net_debt < s.net_debt) * 100.0 / n2 END AS net_debt_percentile
      FROM s JOIN (SELECT sector, count(*) AS n_sector, median(cash) AS m1, count(cash) AS n1, median(net_debt) AS m2, count(net_debt) AS n2 FROM s GROUP BY sector) USING (sector) WHERE n_sector - 1 >= 3""",
    f"{A}, {SQL_SECTORS}, s AS (SELECT sector || ' ' || fy AS sector, corp, cash, net_debt FROM a JOIN sectors USING (corp))",
)
def peer_medians(spark, sf_dir):
    """Every year's companies against their sector of that year."""
    rows = annual(spark, sf_dir).join(sectors(spark, sf_dir), "corp").withColumn("sector", F.concat_ws(" ", "sector", F.col("fy").cast("string")))
    return aggregates.peer_medians(rows, "sector", "corp", ["cash", "net_debt"])


@query("o4_08_distinct_on", "#o_custkey #o_orderkey %day", "SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_orderdate::DATE AS day FROM orders ORDER BY o_custkey, o_orderdate::DATE DESC, o_orderkey DESC")
def distinct_on(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return windows.top_n(rows, ["o_custkey"], [F.col("day").desc(), F.col("o_orderkey").desc()])


@query("o4_09_window_average", "corp ~average", "SELECT corp, avg(net_debt) AS average FROM (SELECT *, row_number() OVER (PARTITION BY corp ORDER BY fy DESC) AS r FROM a WHERE data_quality < 3) WHERE r <= 3 GROUP BY corp", A)
def window_average(spark, sf_dir):
    window = screen.window_of(annual(spark, sf_dir), "corp", [F.col("fy").desc()], 3)
    return window.groupBy("corp").agg(screen.aggregated("net_debt", "average", 3).alias("average"))


@query("o4_17_ordered_arrays", "#o_custkey ids", "SELECT o_custkey, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderdate, o_orderkey) AS ids FROM orders GROUP BY 1")
def ordered_arrays(spark, sf_dir):
    listed = aggregates.ordered_ids(read(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey", "o_orderdate")
    return listed.withColumn("ids", F.array_join("ids", ","))


# --- order and sets ---------------------------------------------------------------------


@query("o5_15_latest_filing", "#o_custkey #rcept", "SELECT o_custkey, o_orderkey AS rcept FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus = 'F' DESC, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate END DESC NULLS LAST, o_orderkey DESC) = 1")
def latest_filing(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("rcept"), (F.col("o_orderstatus") == "F").alias("is_final"), F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate")).alias("filed_at"))
    return windows.latest_filing(o, ["o_custkey"])


@query("o5_18_quant_sort", "corp #fy #net_debt", "SELECT corp, fy, net_debt FROM a WHERE revenue > 0 ORDER BY net_debt DESC NULLS LAST, corp, fy", A)
def quant_sort(spark, sf_dir):
    """A pass with limit 0 returns all rows, those without a value last."""
    return screen.quant_passes(annual(spark, sf_dir), [screen.Pass({"revenue": "> 0"}, "net_debt", limit=0)], ["corp", "fy"])


@query("o5_20_label_order", "#o_orderkey #place", "SELECT o_orderkey, CASE o_orderpriority WHEN '2-HIGH' THEN 1 WHEN '1-URGENT' THEN 2 WHEN '3-MEDIUM' THEN 3 ELSE 4 END AS place FROM orders")
def label_order(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", windows.period_rank("o_orderpriority", ("2-HIGH", "1-URGENT", "3-MEDIUM")).alias("place"))


@query("o5_22_union_overlay", "#id ~amount origin", "SELECT o_orderkey AS id, o_totalprice AS amount, 'order' AS origin FROM orders UNION ALL SELECT -c_custkey, c_acctbal, 'customer' FROM customer")
def union_overlay(spark, sf_dir):
    lines = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"), F.lit("order").alias("origin"))
    added = read(spark, sf_dir, "customer").select((-F.col("c_custkey")).alias("id"), F.col("c_acctbal").cast("decimal(18,2)").alias("amount"), F.lit("customer").alias("origin"))
    return joins.under(lines, added)


@query("o5_24_except", "corp o_orderstatus", "SELECT corp, o_orderstatus FROM st WHERE n % 2 = 0 EXCEPT SELECT corp, o_orderstatus FROM st WHERE n % 5 = 0", S)
def keys_gone(spark, sf_dir):
    rows = statements(spark, sf_dir, "fy", "o_orderstatus")
    return joins.gone(rows.where("n % 2 = 0"), rows.where("n % 5 = 0"), ["corp", "o_orderstatus"])


_BIG = "big AS (SELECT corp, fy, data_quality, make_date(fy, 12, 31) AS period_end, shares_out::HUGEINT * 100000000 AS shares_out, market_cap::HUGEINT * 1000000000 AS market_cap, CASE WHEN n % 19 = 0 THEN 0 ELSE total_assets::HUGEINT * 10000000 END AS total_assets, revenue::HUGEINT * 10000000 AS revenue, operating_income, net_income, total_liabilities::HUGEINT * 10000000 AS total_liabilities, total_equity::HUGEINT * 10000000 AS total_equity FROM a)"


def _big(spark: SparkSession, sf_dir: str) -> checks.Tables:
    """The statements in a currency so small that the limits of size are met."""
    rows = annual(spark, sf_dir).withColumn("period_end", F.make_date("fy", F.lit(12), F.lit(31)))
    times = {"shares_out": 10**8, "market_cap": 10**9, "total_assets": 10**7, "revenue": 10**7, "total_liabilities": 10**7, "total_equity": 10**7}
    rows = rows.withColumns({c: F.col(c).cast("decimal(28,0)") * F.lit(k).cast("decimal(10,0)") for c, k in times.items()})
    return {"rows": rows.withColumn("total_assets", F.when(F.col("n") % 19 == 0, 0).otherwise(F.col("total_assets")))}


def _violations(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    tables, today = _big(spark, sf_dir), F.to_date(F.lit("2000-06-30"))
    found = [a.violations(tables).select(F.lit(a.name).alias("name"), "corp", "fy") for a in checks.row_assertions(today) if a.name in names]
    return joins.under(*found)


@query("o5_25_union_report", "name severity #n_violations", """SELECT unnest(['future_period', 'impossible_shares', 'impossible_cap', 'assets_not_positive', 'assets_too_large', 'revenue_too_large', 'operating_equals_net', 'balance_identity']) AS name,
  unnest(['ERROR', 'ERROR', 'ERROR', 'ERROR', 'WARN', 'WARN', 'WARN', 'ERROR']) AS severity, unnest([count(*) FILTER (period_end > DATE '2000-06-30' AND data_quality < 3), count(*) FILTER (shares_out > 100000000000), count(*) FILTER (market_cap > 5000000000000000000), count(*) FILTER (total_assets <= 0), count(*) FILTER (total_assets > 2000000000000000), count(*) FILTER (abs(revenue) > 1000000000000000), count(*) FILTER (operating_income = net_income AND operating_income <> 0), count(*) FILTER (abs(total_assets - total_liabilities - total_equity) > 0.03 * abs(total_assets))]) AS n_violations FROM big""", f"{A}, {_BIG}")  # fmt: skip
def union_report(spark, sf_dir):
    return checks.counts(checks.row_assertions(F.to_date(F.lit("2000-06-30"))), _big(spark, sf_dir))


@query("o10_04_impossible_shares", "name corp #fy", "SELECT 'impossible_shares' AS name, corp, fy FROM big WHERE shares_out > 100000000000 UNION ALL SELECT 'impossible_cap', corp, fy FROM big WHERE market_cap > 5000000000000000000", f"{A}, {_BIG}")
def impossible_shares(spark, sf_dir):
    return _violations(spark, sf_dir, "impossible_shares", "impossible_cap")


@query("o10_07_magnitudes", "name corp #fy", "SELECT 'assets_not_positive' AS name, corp, fy FROM big WHERE total_assets <= 0 UNION ALL SELECT 'assets_too_large', corp, fy FROM big WHERE total_assets > 2e15 UNION ALL SELECT 'revenue_too_large', corp, fy FROM big WHERE abs(revenue) > 1e15", f"{A}, {_BIG}")
def magnitudes(spark, sf_dir):
    return _violations(spark, sf_dir, "assets_not_positive", "assets_too_large", "revenue_too_large")


@query("o5_26_sample", "#o_orderkey", "SELECT o_orderkey FROM orders WHERE substring(md5(o_orderkey::VARCHAR), 1, 8) < '1999999a'")
def sample(spark, sf_dir):
    """A tenth of the orders, the same ones every time."""
    return windows.sampled(read(spark, sf_dir, "orders"), ["o_orderkey"], 0.1 + 1e-10)


# --- standardization --------------------------------------------------------------------


@query(
    "o6_16_conflict_ladder",
    "#l_orderkey #value how",
    """SELECT l_orderkey, CASE WHEN n_all = 1 THEN v_all WHEN n1 = 1 THEN v1 WHEN n2 = 1 THEN v2 WHEN lo2 >= hi2 * 0.999 THEN hi2 WHEN n3 = 1 THEN v3 END AS value, CASE WHEN n_all = 1 THEN 'single' WHEN n1 = 1 THEN 'current' WHEN n2 = 1 THEN 'total' WHEN lo2 >= hi2 * 0.999 THEN 'near' WHEN n3 = 1 THEN 'shallow' ELSE 'held' END AS how
      FROM (SELECT l_orderkey, count(DISTINCT v) AS n_all, max(v) AS v_all, count(DISTINCT v) FILTER (in1) AS n1, max(v) FILTER (in1) AS v1, count(DISTINCT v) FILTER (in2) AS n2, max(v) FILTER (in2) AS v2, min(v) FILTER (in2) AS lo2, max(v) FILTER (in2) AS hi2, count(DISTINCT v) FILTER (in2 AND depth = top) AS n3, max(v) FILTER (in2 AND depth = top) AS v3
            FROM (SELECT *, min(depth) FILTER (in2) OVER (PARTITION BY l_orderkey) AS top FROM (SELECT *, in1 AND (tot OR NOT bool_or(tot AND in1) OVER (PARTITION BY l_orderkey)) AS in2 FROM (SELECT *, cur OR NOT bool_or(cur) OVER (PARTITION BY l_orderkey) AS in1 FROM k))) GROUP BY l_orderkey)""",
    "k AS (SELECT l_orderkey, floor(l_extendedprice / 500)::BIGINT + 1 AS v, l_linenumber AS depth, l_returnflag = 'A' AS cur, l_linestatus = 'F' AS tot FROM lineitem)",
)
def conflict_ladder(spark, sf_dir):
    """One account with candidates of one stage: current ones, totals, nearly equal ones, the shallowest path."""
    c = read(spark, sf_dir, "lineitem").select("l_orderkey", F.lit("x").alias("code"), (F.floor(F.col("l_extendedprice") / 500).cast("long") + 1).alias("value"), F.lit("exact").alias("stage"), F.lit("l").alias("label"), F.col("l_linenumber").alias("depth"), (F.col("l_linestatus") == "F").alias("is_total"), (F.col("l_returnflag") == "A").alias("is_current"))
    return standardize.resolved(c, ["l_orderkey"])


@query("o6_19_tax_anchors", "corp #fy #n_anchors #first #last", "SELECT corp, fy, CASE n % 3 WHEN 0 THEN 1 WHEN 1 THEN CASE WHEN tax_expense = 0 THEN 1 ELSE 2 END ELSE 0 END AS n_anchors, CASE n % 3 WHEN 0 THEN ebt WHEN 1 THEN ebt - tax_expense END AS first, CASE n % 3 WHEN 0 THEN ebt WHEN 1 THEN ebt + tax_expense END AS last FROM a", A)
def tax_anchors(spark, sf_dir):
    t = F.col("tax_expense")
    taxes = F.when(F.col("n") % 3 == 0, F.array().cast("array<bigint>")).when(F.col("n") % 3 == 1, F.array(t)).otherwise(F.array(t, t + 1))
    rows = annual(spark, sf_dir).withColumn("x", standardize.net_income_anchors(F.col("ebt"), taxes))
    return rows.select("corp", "fy", F.size("x").alias("n_anchors"), F.get("x", F.lit(0)).alias("first"), F.try_element_at("x", F.lit(-1)).alias("last"))


_PARTS = {
    "capex_tangible": "CASE WHEN n % 3 = 0 THEN NULL ELSE -receivables END", "capex_intangible": "CASE WHEN n % 5 = 0 THEN NULL ELSE n * 7 END",
    "cf_dep": "CASE WHEN n % 4 = 0 THEN da_total END", "cf_amort": "CASE WHEN n % 6 = 0 THEN n * 3 END", "cf_combined": "CASE WHEN n % 7 = 0 THEN n * 11 END", "is_dep": "CASE WHEN n % 2 = 0 THEN n END", "is_amort": "CASE WHEN n % 9 = 0 THEN n * 2 END", "is_combined": "CASE WHEN n % 10 = 1 THEN n * 5 END",
    "short_borrowings": "CASE WHEN n % 3 = 1 THEN short_term_debt END", "current_portion": "CASE WHEN n % 4 = 1 THEN n * 100 END", "bonds_short": "CASE WHEN n % 8 = 1 THEN n * 50 END", "long_borrowings": "CASE WHEN n % 5 = 1 THEN total_liabilities * 2 ELSE long_term_debt END", "bonds_long": "CASE WHEN n % 7 = 2 THEN n END",
    "cash_base": "cash", "deposits": "CASE WHEN n % 2 = 1 THEN n END", "has_combined_caption": "n % 4 = 3", "lease_short": "CASE WHEN n % 3 = 2 THEN -n END", "lease_long": "CASE WHEN n % 6 = 5 THEN n * 9 END",
    "insurance_revenue": "CASE WHEN n % 5 = 2 THEN n * 1000 END", "interest_revenue": "CASE WHEN n % 10 = 2 THEN n * 2000 END",
}
_WIDE = f"{A}, w AS (SELECT corp, fy, n, total_liabilities, gross_profit, CASE WHEN n % 3 = 0 THEN revenue END AS revenue, CASE WHEN n % 2 = 0 THEN -cogs END AS cogs, {', '.join(f'{rule} AS {name}' for name, rule in _PARTS.items())} FROM a)"


def _additive(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    rows = annual(spark, sf_dir).select("*", *(F.expr(rule).alias(name) for name, rule in _PARTS.items())).withColumns({"revenue": F.when(F.col("n") % 3 == 0, F.col("revenue")), "cogs": F.when(F.col("n") % 2 == 0, -F.col("cogs"))})
    columns = standardize.additive_columns()
    return rows.select("corp", "fy", *(columns[n].alias(n) for n in names))


@query("o6_26_additive_capex", "corp #fy #capex", "SELECT corp, fy, nullif(-(abs(coalesce(capex_tangible, 0)) + abs(coalesce(capex_intangible, 0))), 0) AS capex FROM w", _WIDE)
def additive_capex(spark, sf_dir):
    return _additive(spark, sf_dir, "capex")


@query("o6_27_additive_depreciation", "corp #fy #da_total", "SELECT corp, fy, CASE WHEN cf_dep IS NOT NULL OR cf_amort IS NOT NULL THEN coalesce(cf_dep, 0) + coalesce(cf_amort, 0) WHEN cf_combined IS NOT NULL THEN cf_combined WHEN is_dep IS NOT NULL OR is_amort IS NOT NULL THEN coalesce(is_dep, 0) + coalesce(is_amort, 0) ELSE is_combined END AS da_total FROM w", _WIDE)
def additive_depreciation(spark, sf_dir):
    return _additive(spark, sf_dir, "da_total")


@query("o6_28_additive_debt", "corp #fy #short_term_debt #long_term_debt", """SELECT corp, fy, CASE WHEN total_liabilities <= 0 OR coalesce(s, 0) + coalesce(l, 0) <= 1.05 * total_liabilities THEN s END AS short_term_debt, CASE WHEN total_liabilities <= 0 OR coalesce(s, 0) + coalesce(l, 0) <= 1.05 * total_liabilities THEN l END AS long_term_debt
  FROM (SELECT *, CASE WHEN coalesce(short_borrowings, current_portion, bonds_short) IS NOT NULL THEN coalesce(short_borrowings, 0) + coalesce(current_portion, 0) + coalesce(bonds_short, 0) END AS s, CASE WHEN coalesce(long_borrowings, bonds_long) IS NOT NULL THEN coalesce(long_borrowings, 0) + coalesce(bonds_long, 0) END AS l FROM w)""", _WIDE)  # fmt: skip
def additive_debt(spark, sf_dir):
    return _additive(spark, sf_dir, "short_term_debt", "long_term_debt")


@query("o6_29_additive_leases", "corp #fy #lease_liabilities", "SELECT corp, fy, CASE WHEN lease_short IS NULL AND lease_long IS NULL THEN NULL ELSE abs(coalesce(lease_short, 0)) + abs(coalesce(lease_long, 0)) END AS lease_liabilities FROM w", _WIDE)
def additive_leases(spark, sf_dir):
    return _additive(spark, sf_dir, "lease_liabilities")


@query("o6_30_revenue_parts", "corp #fy #revenue", "SELECT corp, fy, CASE WHEN revenue IS NOT NULL THEN revenue WHEN cogs IS NOT NULL AND gross_profit IS NOT NULL THEN abs(cogs) + gross_profit WHEN insurance_revenue IS NOT NULL AND abs(insurance_revenue) >= coalesce(abs(interest_revenue), 0) THEN insurance_revenue END AS revenue FROM w", _WIDE)
def revenue_parts(spark, sf_dir):
    return _additive(spark, sf_dir, "revenue")


@query("o6_32_expense_sign", "corp #fy #tax", "SELECT corp, fy, CASE n % 3 WHEN 0 THEN tax_expense WHEN 1 THEN tax_expense ELSE tax_expense END AS tax FROM a", A)
def expense_sign(spark, sf_dir):
    """A third stored with the sign turned, a third with it and without the identity: both come out as printed."""
    n = F.col("n")
    rows = annual(spark, sf_dir).withColumns({"stored": F.when(n % 3 == 0, F.col("tax_expense")).otherwise(-F.col("tax_expense")), "after": F.when(n % 3 == 2, F.lit(None).cast("long")).otherwise(F.col("net_income"))})
    return rows.select("corp", "fy", metrics.sign_fixed_expense("stored", "ebt", "after").alias("tax"))


@query("o6_40_future_guard", "corp #fy #quality", "SELECT corp, fy, CASE WHEN make_date(fy, 12, 31) > DATE '1999-06-30' THEN 3 ELSE data_quality END AS quality FROM a", A)
def future_guard(spark, sf_dir):
    return annual(spark, sf_dir).withColumn("quality", standardize.future_guard(F.make_date("fy", F.lit(12), F.lit(31)), F.to_date(F.lit("1999-06-30")), F.col("data_quality")))


# --- periods, metrics -------------------------------------------------------------------


@query("o7_04_derivation", "corp #cy derivation", "SELECT corp, fy AS cy, CASE WHEN min(m) = 12 THEN 'native' ELSE 'derived' END AS derivation FROM (SELECT *, CASE WHEN corp LIKE '1%' AND fy % 2 = 0 AND q < 3 THEN 6 ELSE 12 END AS m FROM qs) GROUP BY 1, 2 HAVING count(DISTINCT q) = 4", Q)
def derivation(spark, sf_dir):
    rows = quarterly(spark, sf_dir).withColumns({"cy": F.col("fy"), "cq": F.concat(F.lit("CQ"), F.col("q").cast("string")), "month": F.when(F.col("corp").startswith("1") & (F.col("fy") % 2 == 0) & (F.col("q") < 3), 6).otherwise(12)})
    return periods.calendar_years(rows, ["corp"], ["revenue"], ["cash"], "data_quality", "month")


@query("o7_05_ttm_row", "corp #fy #q #revenue #cfo #cash", "SELECT corp, fy, q, CASE WHEN count(*) OVER w = 4 THEN sum(revenue) OVER w END AS revenue, CASE WHEN count(*) OVER w = 4 THEN sum(cfo) OVER w END AS cfo, cash FROM qs WINDOW w AS (PARTITION BY corp ORDER BY fy, q ROWS 3 PRECEDING)", Q)
def ttm_row(spark, sf_dir):
    return windows.ttm(quarterly(spark, sf_dir), ["corp"], [F.col("fy"), F.col("q")], ["revenue", "cfo"])


@query("o8_02_growth", "corp #fy ~revenue_growth ~net_debt_growth", f"SELECT corp, fy, {grow('revenue', 'lag(revenue) OVER w')} AS revenue_growth, {grow('net_debt', 'lag(net_debt) OVER w')} AS net_debt_growth FROM a WINDOW w AS (PARTITION BY corp ORDER BY fy)", A)
def growth_rates(spark, sf_dir):
    rows = windows.with_previous(annual(spark, sf_dir), ["corp"], [F.col("fy")], ["revenue", "net_debt"])
    return rows.select("corp", "fy", growth("revenue", "p_revenue").alias("revenue_growth"), growth("net_debt", "p_net_debt").alias("net_debt_growth"))


@query("o8_25_dividend_frame", "corp #fy ~dps ~dividends ~payout ~dividend_yield", f"SELECT corp, fy, n % 50 AS dps, (n * 3) * 1e6 AS dividends, CASE WHEN n % 4 <> 0 THEN (n % 30) / 100.0::DOUBLE WHEN net_income > 0 THEN {div('n * 3 * 1e6', 'net_income * 1e6')} END AS payout, CASE WHEN n % 5 <> 0 THEN (n % 9) / 100.0::DOUBLE END AS dividend_yield FROM a", A)
def dividend_frame(spark, sf_dir):
    a, n = annual(spark, sf_dir), F.col("n")
    facts = F.array(*(F.struct(F.lit(code).alias("code"), value.cast("double").alias("value")) for code, value in {"dps": n % 50, "dividends": n * 3, "payout": F.when(n % 4 != 0, n % 30), "yield": F.when(n % 5 != 0, n % 9), "net_income": F.col("net_income"), "other": n}.items()))
    return reads.dividend_frame(a.select("corp", "fy", F.inline(facts)), ["corp", "fy"])


@query("o9_08_valuation_bands", "#code ~min ~median ~p90 ~current ~percentile #n", f"""SELECT code, min(v) AS min, median(v) AS median, quantile_cont(v, 0.9) AS p90, max(current) AS current, avg(CASE WHEN v < current THEN 100.0::DOUBLE ELSE 0 END) AS percentile, count(*) AS n
  FROM (SELECT code, {div('close', 'listed')} AS v, arg_max({div('close', 'listed')}, day) OVER (PARTITION BY code) AS current FROM p WHERE listed > 0) GROUP BY code""", P)  # fmt: skip
def valuation_bands(spark, sf_dir):
    """The daily series of a multiple, and where the newest day stands in it."""
    days = prices(spark, sf_dir).where("listed > 0").withColumn("multiple", safe_div("close", "listed"))
    return aggregates.bands(days, ["code"], "day", "multiple")


@query("o10_10_below_half", "corp #fy #consolidated #separate", "SELECT corp, fy, c.revenue AS consolidated, s.revenue AS separate FROM (SELECT * FROM st WHERE o_orderstatus = 'F') c JOIN (SELECT * FROM st WHERE o_orderstatus = 'O') s USING (corp, fy) WHERE s.revenue > 0 AND c.revenue * 2 < s.revenue", S)
def below_half(spark, sf_dir):
    return checks.consolidated_below_half(statements(spark, sf_dir, "fy", "o_orderstatus"), ["corp", "fy"], "o_orderstatus", "revenue", "F", "O")


@query("o10_26_unit_nominations", "corp #fy o_orderstatus #value ~factor", """SELECT corp, fy, o_orderstatus, value, CASE WHEN r BETWEEN 800 AND 1200 THEN 1000 WHEN r BETWEEN 0.0008 AND 0.0012 THEN 0.001 WHEN r BETWEEN 800000 AND 1200000 THEN 1000000 WHEN r BETWEEN 0.0000008 AND 0.0000012 THEN 0.000001 END AS factor
  FROM (SELECT x.corp, x.fy, x.o_orderstatus, x.value, abs(x.value)::DOUBLE / nullif(abs(median(y.value)), 0) AS r FROM v x LEFT JOIN v y ON x.corp = y.corp AND x.o_orderstatus <> y.o_orderstatus AND abs(x.fy - y.fy) <= 1 GROUP BY x.corp, x.fy, x.o_orderstatus, x.value) WHERE factor IS NOT NULL""", f"{S}, v AS (SELECT corp, fy, o_orderstatus, CASE WHEN n % 13 = 0 THEN n * 1000 ELSE n END AS value FROM st)")  # fmt: skip
def unit_nominations(spark, sf_dir):
    v = statements(spark, sf_dir, "fy", "o_orderstatus").select("corp", "fy", "o_orderstatus", F.when(F.col("n") % 13 == 0, F.col("n") * 1000).otherwise(F.col("n")).alias("value"))
    return checks.unit_nominations(joins.neighbour_median(v, ["corp"], "o_orderstatus", "fy", "value"), "value", "neighbour_median")


# --- streams ----------------------------------------------------------------------------


def _landing(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """The events as a stream of ``n`` files by day, a file a batch."""
    e, path = read(spark, sf_dir, "events"), shared(spark, "landing")
    e.repartitionByRange(n, "ts").write.parquet(path)
    return mb.files(spark, path, e.schema, per_batch=1)


@query("o12_01_daily_batches", "#user_id #event_id event_type", "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def daily_batches(spark, sf_dir):
    """File by file; a run that stops after some batches goes on where its checkpoint ends."""
    stream = _landing(spark, sf_dir, 4).select("user_id", "event_id", "event_type", F.col("event_id").alias("seq"))
    table = mb.Versions(spark, shared(spark, "daily"), stream.select("user_id", "event_id", "event_type", "seq").schema)
    each = mb.newest(table, ["user_id"], "seq")
    log = shared(spark, "daily-log")
    mb.run(stream, each, log).awaitTermination()
    mb.run(stream, each, log).awaitTermination()  # nothing is new: nothing happens
    return table.read()


@query("o12_04_price_refetch", "#code %day #close", "SELECT code, day, CASE WHEN day > (SELECT max(day) FROM p) - 15 THEN close + 1 ELSE close END AS close FROM p", P)
def price_refetch(spark, sf_dir):
    """The last 15 days are fetched again and overwrite what is stored."""
    stored = prices(spark, sf_dir).select("code", "day", "close")
    return mb.refetched(stored, stored.withColumn("close", F.col("close") + 1), ["code"], "day", 15)


@query("o12_05_progress_log", "%day event_type #n", "SELECT d.day, t.event_type, count(e.event_id) AS n FROM (SELECT DISTINCT ts::DATE AS day FROM events) d CROSS JOIN (SELECT unnest(['click', 'view', 'refund']) AS event_type) t LEFT JOIN events e ON e.ts::DATE = d.day AND e.event_type = t.event_type GROUP BY 1, 2")
def progress_log(spark, sf_dir):
    """Each (day, kind) that was asked for is in the log, also the empty ones; none is there twice."""
    stream = _landing(spark, sf_dir, 3).select(F.col("ts").cast("date").alias("day"), "event_type")
    log = mb.Versions(spark, shared(spark, "progress"), spark.range(0).selectExpr("CAST(NULL AS DATE) AS day", "'' AS event_type", "id AS n").schema)
    mb.run(stream, mb.progress(log, ["day"], "event_type", ["click", "view", "refund"]), shared(spark, "progress-log")).awaitTermination()
    return log.read()


@query("o12_07_leases", "#user_id status #attempts")
def leases(spark, sf_dir):
    """Claims, leases that run out, retries: no SQL; a unit test holds it to plain code."""
    return mb.lease_states(read(spark, sf_dir, "events"), "user_id", "ts", "event_id", "event_type")
