"""Further queries of O2-O10 over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quantloom.functions import metrics, text
from quantloom.operators import checks, grids, periods, standardize, windows
from quantloom.plans import market, reads, screen
from quantloom.plans.catalog import div, grow, query
from quantloom.plans.fundamentals import annual, quarterly, read, sql_statements, statements
from quantloom.plans.market import SQL_PRICES as P
from quantloom.plans.market import prices

A, Q = sql_statements("a", "fy"), sql_statements("qs", "fy", "q")


@query("o2_07_tuple_in", "corp #fy #q #revenue", "SELECT corp, fy, q, revenue FROM qs WHERE (fy, q) IN ((1998, 1), (1999, 3), (2000, 2))", Q)
def tuple_in(spark, sf_dir):
    return quarterly(spark, sf_dir).where("(fy, q) IN ((1998, 1), (1999, 3), (2000, 2))")


@query("o2_09_null_safe_changes", "corp #fy #net_debt #p_net_debt", "SELECT x.corp, x.fy, x.net_debt, y.net_debt AS p_net_debt FROM a x JOIN a y ON x.corp = y.corp AND y.fy = x.fy - 1 WHERE (x.net_debt IS NULL) IS DISTINCT FROM (y.net_debt IS NULL)", A)
def null_safe_changes(spark, sf_dir):
    rows = windows.with_year_before(annual(spark, sf_dir), ["corp"], "fy", ["net_debt", "revenue"])
    return rows.where(F.col("p_revenue").isNotNull() & ~F.col("net_debt").isNull().eqNullSafe(F.col("p_net_debt").isNull()))


@query("o2_04_condition_filters", "corp #fy ~margin", f"SELECT corp, fy, {div('operating_income', 'revenue')} AS margin FROM a WHERE {div('operating_income', 'revenue')} >= 0.02 AND (interest_expense IS NULL OR interest_expense <= 900000)", A)
def condition_filters(spark, sf_dir):
    rows = annual(spark, sf_dir).withColumn("margin", F.try_divide(F.col("operating_income").cast("double"), F.col("revenue")))
    return rows.where(screen.holds(F.col("margin"), screen.condition(">= 2%")) & screen.passes(F.col("interest_expense"), screen.condition("<= 900000"), include_missing=True))


@query("o2_12_shown", "corp #fy shown_margin shown_amount", "SELECT corp, fy, CASE WHEN m IS NULL THEN '-' ELSE format('{:,.1f}', round(m * 100, 1)) END AS shown_margin, CASE WHEN net_debt IS NULL THEN '-' ELSE format('{:,.0f}', net_debt // 1000000 * 1.0) END AS shown_amount FROM (SELECT *, (n % 40 - 20) / 8.0 AS m FROM a)", A)
def shown(spark, sf_dir):
    rows = annual(spark, sf_dir).withColumn("m", (F.col("n") % 40 - 20) / 8)
    return rows.withColumns({"shown_margin": screen.shown(F.col("m"), "pct"), "shown_amount": screen.shown(F.expr("net_debt div 1000000"), "raw", 0)})


@query("o2_13_prior_tables", "#o_custkey #table_seq", "SELECT o_custkey, o_orderkey AS table_seq FROM (SELECT *, arg_min(o_orderkey % 40, o_orderkey) OVER w AS t, min(o_orderkey) OVER w AS s FROM orders WINDOW w AS (PARTITION BY o_custkey)) WHERE o_orderkey > s AND o_orderkey % 40 < t")
def prior_tables(spark, sf_dir):
    meta = read(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("table_seq"), F.concat(F.lit("제 "), (F.col("o_orderkey") % 40).cast("string"), F.lit(" 기")).alias("caption"))
    return standardize.prior_tables(meta, ["o_custkey"])


@query("o2_16_purge", "#o_orderkey", "SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 7 <> 0")
def purge(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey")
    mark = lambda d: F.when(F.col("o_orderkey") % d == 0, "old").otherwise("new")
    held = o.withColumns({"fingerprint": mark(3), "reader": mark(7)})
    return checks.purge_stale(held, o.withColumns({"fingerprint": F.lit("new"), "reader": F.lit("new")}), ["o_orderkey"], ["fingerprint", "reader"])


@query("o3_16_missing_sections", "corp #fy section", "SELECT x.corp, x.fy, s.section FROM (SELECT DISTINCT corp, fy FROM h) x JOIN (SELECT DISTINCT corp, section FROM h) s ON x.corp = s.corp WHERE (x.corp, x.fy, s.section) NOT IN (SELECT (corp, fy, section) FROM h)", f"{sql_statements('a', 'fy', 'o_orderstatus')}, h AS (SELECT corp, fy, o_orderstatus AS section FROM a WHERE n % 3 <> 0)")
def missing_sections(spark, sf_dir):
    return reads.missing_sections(statements(spark, sf_dir, "fy", "o_orderstatus").where("n % 3 <> 0").withColumnRenamed("o_orderstatus", "section"), ["corp"], "fy", "section")


@query("o5_02_period_order", "corp #fy #q #place", "SELECT corp, fy, q, row_number() OVER (PARTITION BY corp ORDER BY fy DESC, q DESC) AS place FROM qs", Q)
def period_order(spark, sf_dir):
    rows = quarterly(spark, sf_dir).withColumn("period", F.concat(F.lit("CQ"), F.col("q").cast("string")))
    return windows.top_n(rows, ["corp"], [F.col("fy").desc(), windows.period_rank("period")], 10**9, rank="place")


@query("o5_09_universe_rank", "corp #fy #market_cap #place", "SELECT corp, fy, market_cap, row_number() OVER (PARTITION BY fy ORDER BY market_cap DESC NULLS LAST, corp) AS place FROM a", A)
def universe_rank(spark, sf_dir):
    return windows.top_n(annual(spark, sf_dir), ["fy"], [F.col("market_cap").desc_nulls_last(), F.col("corp")], 10**9, rank="place")


@query("o5_16_active_events", "#user_id event_type %active", "SELECT user_id, event_type, arg_max(value >= 20, (ts, event_id)) AS active FROM events GROUP BY 1, 2")
def active_events(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("active", F.col("value") >= 20)
    return windows.latest_row(e, ["user_id", "event_type"], F.struct("ts", "event_id"), ["active"])


@query("o5_13_previous_by_place", "corp #fy #q #p_revenue", "SELECT corp, fy, q, lag(revenue, 4) OVER (PARTITION BY corp ORDER BY fy, q) AS p_revenue FROM qs", Q)
def previous_by_place(spark, sf_dir):
    return windows.with_previous(quarterly(spark, sf_dir), ["corp"], [F.col("fy"), F.col("q")], ["revenue"], 4)


@query("o5_17_screen_order", "corp #fy #net_debt", "SELECT corp, fy, net_debt FROM a ORDER BY net_debt DESC NULLS FIRST, corp, fy", A)
def screen_order(spark, sf_dir):
    return windows.ordered(annual(spark, sf_dir), "net_debt", screen=True, ties=["corp", "fy"])


@query("o6_06_units", "#o_orderkey #unit", "SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 1 WHEN 1 THEN 1000 WHEN 2 THEN 1000000 WHEN 3 THEN 100000000 WHEN 4 THEN NULL WHEN 5 THEN NULL WHEN 6 THEN 1000000000000 END AS unit FROM orders")
def units(spark, sf_dir):
    said = ("(단위 : 원)", "(단위: 천원)", "[단위：백만 원]", "(단위: 억원)", "(단위: USD 천)", "No unit here", "(단위: 조원)")
    caption = F.element_at(F.array(*map(F.lit, said)), (F.col("o_orderkey") % 7 + 1).cast("int"))
    return read(spark, sf_dir, "orders").select("o_orderkey", text.unit_multiplier(caption).alias("unit"))


def _versions(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.sum(F.floor("l_quantity").cast("long")).alias("value"))
    k = F.col("l_suppkey") + F.col("l_linenumber")
    base = lines.select("l_suppkey", F.col("l_linenumber").alias("place"), F.lit("t").alias("track"), "value", F.concat(F.lit("line "), F.col("l_linenumber").cast("string"), F.when(k % 4 == 1, " gain").otherwise("")).alias("label"), F.concat(F.lit("acct"), (F.col("l_linenumber") % 5).cast("string")).alias("code"))
    k = F.col("l_suppkey") + F.col("place")
    later = base.withColumns({"label": F.when(k % 4 == 0, F.concat("label", F.lit(" renamed"))).when(k % 4 == 1, F.regexp_replace("label", " gain", " loss")).otherwise(F.col("label")), "value": F.when(k % 4 == 1, F.col("value") + 1).otherwise(F.col("value"))})
    return base, later


@query(
    "o6_10_relabelled",
    "#l_suppkey label new_label how",
    """SELECT * FROM (SELECT o.l_suppkey, o.label, w.label AS new_label, 'position' AS how FROM o JOIN w ON o.l_suppkey = w.l_suppkey AND o.place = w.place AND o.value = w.value WHERE o.label <> w.label AND NOT EXISTS (SELECT 1 FROM o z WHERE z.l_suppkey = w.l_suppkey AND z.code = w.code AND z.value <> w.value)
       UNION ALL SELECT o.l_suppkey, o.label, w.label, 'sign word' FROM o JOIN w ON o.l_suppkey = w.l_suppkey AND o.place = w.place WHERE (o.l_suppkey + o.place) % 4 = 1)""",
    "o AS (SELECT l_suppkey, l_linenumber AS place, sum(floor(l_quantity)::BIGINT)::BIGINT AS value, 'line ' || l_linenumber || CASE WHEN (l_suppkey + l_linenumber) % 4 = 1 THEN ' gain' ELSE '' END AS label, 'acct' || (l_linenumber % 5) AS code FROM lineitem GROUP BY 1, 2), w AS (SELECT l_suppkey, place, CASE WHEN (l_suppkey + place) % 4 = 1 THEN value + 1 ELSE value END AS value, CASE WHEN (l_suppkey + place) % 4 = 0 THEN label || ' renamed' WHEN (l_suppkey + place) % 4 = 1 THEN replace(label, ' gain', ' loss') ELSE label END AS label, code FROM o)",
)
def relabelled(spark, sf_dir):
    return standardize.relabelled(*_versions(spark, sf_dir), ["l_suppkey"])


@query("o6_10_restated", "#l_suppkey #place #value #restated")
def restated(spark, sf_dir):
    """Sequence alignment has no SQL; a unit test holds it to its rule."""
    old, new = _versions(spark, sf_dir)
    new = new.withColumn("code", F.when(F.col("place") == 3, "other").otherwise(F.col("code")))
    both = old.withColumn("version", F.lit(0)).unionByName(new.withColumn("version", F.lit(1)))
    return standardize.restated(both.select("l_suppkey", "version", "place", "code", "value"), ["l_suppkey"])


@query("o6_11_withdrawn", "corp #fy basis #revenue", "SELECT corp, fy, basis, revenue FROM (SELECT corp, fy, revenue, CASE WHEN n % 2 = 0 THEN 'consolidated' ELSE 'separate' END AS basis, n FROM a) x WHERE NOT (basis = 'consolidated' AND n % 5 = 0)", A)
def withdrawn(spark, sf_dir):
    rows = annual(spark, sf_dir).withColumn("basis", F.when(F.col("n") % 2 == 0, "consolidated").otherwise("separate"))
    said = rows.select("corp", "fy", F.explode(F.array(F.lit(1), F.lit(2))).alias("seq"), "n").select("corp", "fy", "seq", F.when(F.col("seq") == 2, F.col("n") % 5 == 0).otherwise(F.lit(True)).alias("no_consolidation"))
    return standardize.without_withdrawn(rows, said, ["corp", "fy"])


@query("o6_13_cumulative_first", "#o_custkey period #l_linenumber #n", "SELECT o_custkey, period, l_linenumber, count(*) AS n FROM (SELECT o_custkey, l_linenumber, ['Q1', 'H1', 'Q3', 'FY'][quarter(o_orderdate)::INT] AS period, l_returnflag = 'A' AS cum FROM lineitem JOIN orders ON l_orderkey = o_orderkey QUALIFY NOT (quarter(o_orderdate) IN (2, 3) AND l_linenumber > 3 AND bool_or(l_returnflag = 'A') OVER (PARTITION BY o_custkey, l_linenumber, quarter(o_orderdate)) AND l_returnflag <> 'A')) GROUP BY 1, 2, 3")
def cumulative_first(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.element_at(F.array(*map(F.lit, ("Q1", "H1", "Q3", "FY"))), F.quarter("o_orderdate")).alias("period"))
    c = read(spark, sf_dir, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "period", "l_linenumber", (F.col("l_returnflag") == "A").alias("is_cumulative"))
    kept = standardize.cumulative_first(c, ["o_custkey", "l_linenumber", "period"], "period", F.col("l_linenumber") > 3)
    return kept.groupBy("o_custkey", "period", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))


@query("o6_20_operating_cash", "corp #fy #cfo_found #anchor_count", "SELECT corp, fy, CASE WHEN (SELECT count(DISTINCT v) FROM unnest(l) t(v) WHERE abs(v - cfo) <= 1 OR abs(v - cfo + n % 3) <= 1) = 1 THEN (SELECT max(v) FROM unnest(l) t(v) WHERE abs(v - cfo) <= 1 OR abs(v - cfo + n % 3) <= 1) END AS cfo_found, CASE n % 3 WHEN 0 THEN 1 WHEN 1 THEN CASE WHEN tax_expense = 0 THEN 1 ELSE 2 END ELSE 0 END AS anchor_count FROM (SELECT *, [cfo - n % 4, cfo + 5000, cfo + 1 + n % 2] AS l FROM a)", A)
def operating_cash(spark, sf_dir):
    rows = annual(spark, sf_dir)
    found = standardize.operating_cash(F.expr("array(cfo - n % 4, cfo + 5000, cfo + 1 + n % 2)"), F.col("cfo") + F.col("capex") + 70, F.col("capex"), F.lit(70), F.col("n") % 3)
    taxes = F.expr("CASE n % 3 WHEN 0 THEN cast(array() as array<bigint>) WHEN 1 THEN array(tax_expense) ELSE array(tax_expense, tax_expense + 1) END")
    return rows.withColumns({"cfo_found": found, "anchor_count": F.size(standardize.net_income_anchors(F.col("ebt"), taxes))})


@query("o6_23_basis_copies", "corp #fy basis #revenue %copied", "SELECT corp, fy, basis, revenue, false AS copied FROM s UNION ALL SELECT corp, fy, CASE basis WHEN 'consolidated' THEN 'separate' ELSE 'consolidated' END, revenue, true FROM s WHERE (corp, fy, CASE basis WHEN 'consolidated' THEN 'separate' ELSE 'consolidated' END) NOT IN (SELECT (corp, fy, basis) FROM s) AND (fy < 1998 OR printed)", f"{sql_statements('a', 'fy', 'o_orderstatus')}, s AS (SELECT corp, fy, CASE o_orderstatus WHEN 'F' THEN 'consolidated' ELSE 'separate' END AS basis, revenue, n % 2 = 0 AS printed FROM a WHERE o_orderstatus <> 'P' AND n % 3 <> 0)")
def basis_copies(spark, sf_dir):
    s = statements(spark, sf_dir, "fy", "o_orderstatus").where("o_orderstatus <> 'P' AND n % 3 <> 0").select("corp", "fy", F.when(F.col("o_orderstatus") == "F", "consolidated").otherwise("separate").alias("basis"), "revenue", (F.col("n") % 2 == 0).alias("printed"))
    return standardize.with_basis_fallback(s, ["corp", "fy"], ("consolidated", "separate"), F.col("printed"), "fy", 1998)


@query(
    "o6_25_additive",
    "corp #fy #cash #capex #da_total #short_term_debt #long_term_debt #lease_liabilities #revenue",
    """SELECT corp, fy, CASE WHEN n % 2 = 0 THEN cash + coalesce(inventory, 0) ELSE cash END AS cash, CASE WHEN abs(qty) + abs(coalesce(net_debt, 0)) > 0 THEN -(abs(qty) + abs(coalesce(net_debt, 0))) END AS capex,
       coalesce(CASE WHEN da_total IS NOT NULL OR inventory IS NOT NULL THEN coalesce(da_total, 0) + coalesce(inventory, 0) END, n * 7) AS da_total, CASE WHEN ok THEN s END AS short_term_debt, CASE WHEN ok THEN l END AS long_term_debt,
       CASE WHEN net_debt IS NOT NULL OR interest_expense IS NOT NULL THEN abs(coalesce(net_debt, 0)) + abs(coalesce(interest_expense, 0)) END AS lease_liabilities, coalesce(CASE WHEN n % 3 = 0 THEN NULL ELSE revenue END, abs(cogs) + CASE WHEN n % 6 = 0 THEN NULL ELSE gross_profit END, CASE WHEN qty * 9 >= abs(coalesce(interest_expense, 0)) THEN qty * 9 END) AS revenue
       FROM (SELECT *, coalesce(s, 0) + coalesce(l, 0) <= 1.05::DOUBLE * t AS ok FROM (SELECT *, short_term_debt + coalesce(interest_expense, 0) AS s, long_term_debt AS l, CASE WHEN n % 4 = 0 THEN short_term_debt ELSE total_liabilities END AS t FROM a))""",
    A,
)
def additive(spark, sf_dir):
    rows = annual(spark, sf_dir)
    parts = {
        "cash_base": "cash", "deposits": "inventory", "has_combined_caption": "n % 2 = 0", "capex_tangible": "qty", "capex_intangible": "net_debt", "cf_dep": "da_total", "cf_amort": "inventory", "cf_combined": "cast(NULL as bigint)",
        "is_dep": "cast(NULL as bigint)", "is_amort": "cast(NULL as bigint)", "is_combined": "n * 7", "short_borrowings": "short_term_debt", "current_portion": "interest_expense", "bonds_short": "cast(NULL as bigint)", "long_borrowings": "long_term_debt",
        "bonds_long": "cast(NULL as bigint)", "lease_short": "net_debt", "lease_long": "interest_expense", "insurance_revenue": "qty * 9", "interest_revenue": "interest_expense",
    }
    wide = rows.withColumns({k: F.expr(v) for k, v in parts.items()}).withColumns({"total_liabilities": F.expr("CASE WHEN n % 4 = 0 THEN short_term_debt ELSE total_liabilities END"), "revenue": F.expr("CASE WHEN n % 3 = 0 THEN NULL ELSE revenue END"), "gross_profit": F.expr("CASE WHEN n % 6 = 0 THEN NULL ELSE gross_profit END")})
    return wide.withColumns(standardize.additive_columns())


@query("o6_31_industry_revenue", "corp #fy #industry_revenue", "SELECT corp, fy, CASE code WHEN '65' THEN CASE WHEN n % 2 = 0 THEN coalesce(CASE WHEN n % 4 = 0 THEN qty + tax END, operating_income + abs(cash)) END WHEN '64' THEN CASE WHEN n % 2 = 1 THEN operating_income + abs(cash) END END AS industry_revenue FROM (SELECT *, CASE n % 3 WHEN 0 THEN '65' WHEN 1 THEN '64' ELSE '10' END AS code FROM a)", A)
def industry_revenue(spark, sf_dir):
    rows = annual(spark, sf_dir).withColumn("code", F.expr("CASE n % 3 WHEN 0 THEN '651' WHEN 1 THEN '64' ELSE '10' END"))
    line = lambda label, value, profile, subtotal: F.struct(F.lit(label).alias("label") if isinstance(label, str) else label.alias("label"), F.expr(value).alias("value"), F.lit(profile).alias("profile"), F.expr(subtotal).alias("is_subtotal"))
    lines = rows.select("corp", "fy", "code", F.inline(F.array(
        line(F.when(F.col("n") % 2 == 0, "Premium income").otherwise("Interest income"), "qty", "insurance", "n % 4 = 0"),
        line("other", "tax", "insurance", "n % 4 = 0"), line("operating income", "operating_income", "x", "false"), line("sga", "cash", "x", "false"),
    )))
    return standardize.industry_revenue(lines, ["corp", "fy"], "code")


@query("o6_35_debt_free", "corp #fy #net_debt", "SELECT corp, fy, coalesce(net_debt, CASE WHEN NOT (n % 4 = 0 AND qty % 2 = 1) THEN -cash END) AS net_debt FROM a", A)
def debt_free(spark, sf_dir):
    rows = annual(spark, sf_dir)
    lines = rows.select("corp", "fy", F.when(F.col("n") % 4 == 0, "Long-term borrowings").otherwise("Deposits").alias("label"), (F.col("qty") % 2).alias("value"))
    return standardize.debt_free(rows, lines, ["corp", "fy"])


@query("o6_36_unit_overrides", "corp #fy #value %overridden", "SELECT corp, fy, CASE WHEN fy = 1999 AND corp LIKE '1%' THEN round(revenue * 0.001::DOUBLE)::BIGINT ELSE revenue END AS value, fy = 1999 AND corp LIKE '1%' AS overridden FROM a", A)
def unit_overrides(spark, sf_dir):
    rows = annual(spark, sf_dir).withColumn("value", F.col("revenue"))
    fixes = rows.where("fy = 1999 AND corp LIKE '1%'").select("corp", "fy", F.lit(0.001).alias("multiplier"))
    return standardize.unit_overrides(rows, fixes, ["corp", "fy"])


@query("o6_43_note_depreciation", "#l_suppkey topic #table_seq #total", "SELECT * FROM (SELECT l_suppkey, topic, l_linenumber AS table_seq, sum(floor(l_quantity)::BIGINT)::BIGINT AS total FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN 'costs' WHEN 'N' THEN 'cash flow' ELSE 'other' END AS topic FROM lineitem) WHERE topic <> 'other' AND (l_suppkey + l_linenumber) % 3 <> 0 GROUP BY 1, 2, 3) QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY CASE topic WHEN 'cash flow' THEN 1 ELSE 2 END, abs(total) DESC, table_seq) = 1")
def note_depreciation(spark, sf_dir):
    c = read(spark, sf_dir, "lineitem").select("l_suppkey", F.when(F.col("l_returnflag") == "A", "costs").when(F.col("l_returnflag") == "N", "cash flow").otherwise("other").alias("topic"), F.col("l_linenumber").alias("table_seq"), F.floor("l_quantity").cast("long").alias("value"), F.when((F.col("l_suppkey") + F.col("l_linenumber")) % 3 == 0, "Rent").otherwise("Depreciation of plant").alias("label"))
    return standardize.note_depreciation(c, ["l_suppkey"], ["cash flow", "costs"])


@query("o6_44_period_groups", "#l_suppkey #l_linenumber #period_group #period_place", "SELECT l_suppkey, l_linenumber, g AS period_group, row_number() OVER (PARTITION BY l_suppkey, g ORDER BY l_linenumber) AS period_place FROM (SELECT *, sum(CASE WHEN coalesce(len(labels) >= 3 AND len(b) >= 3 AND len(list_intersect(labels, b)) / len(list_distinct(list_concat(labels, b)))::DOUBLE >= 0.6, false) THEN 0 ELSE 1 END) OVER (PARTITION BY l_suppkey ORDER BY l_linenumber) AS g FROM (SELECT *, lag(labels) OVER (PARTITION BY l_suppkey ORDER BY l_linenumber) AS b FROM (SELECT l_suppkey, l_linenumber, list(DISTINCT floor(l_discount * 100)::INT || l_returnflag || floor(l_quantity / 9)::INT) AS labels FROM lineitem GROUP BY 1, 2)))")
def period_groups(spark, sf_dir):
    t = read(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.collect_set(F.concat(F.floor(F.col("l_discount") * 100).cast("int").cast("string"), "l_returnflag", F.floor(F.col("l_quantity") / 9).cast("int").cast("string"))).alias("labels"))
    return standardize.period_columns(t, ["l_suppkey"], "l_linenumber")


@query("o6_45_one_offs", "#l_suppkey item #total", "WITH c AS (SELECT l_suppkey, CASE l_linestatus WHEN 'F' THEN 'impairment' ELSE 'disposal' END AS item, CASE WHEN l_returnflag = 'A' AND l_suppkey % 3 > 0 THEN 'IS' ELSE 'note' END AS source, l_linenumber AS t, floor(l_quantity)::BIGINT AS v FROM lineitem), b AS (SELECT l_suppkey, item, sum(v)::BIGINT AS total FROM c WHERE source = 'IS' GROUP BY 1, 2) SELECT * FROM b UNION ALL SELECT l_suppkey, item, total FROM (SELECT l_suppkey, item, t, sum(v)::BIGINT AS total FROM c WHERE source = 'note' GROUP BY 1, 2, 3 QUALIFY row_number() OVER (PARTITION BY l_suppkey, item ORDER BY t) = 1) WHERE (l_suppkey, item) NOT IN (SELECT (l_suppkey, item) FROM b)")
def one_offs(spark, sf_dir):
    c = read(spark, sf_dir, "lineitem").select("l_suppkey", F.when(F.col("l_linestatus") == "F", "Impairment of goodwill").otherwise("Gain on disposal").alias("label"), F.when((F.col("l_returnflag") == "A") & (F.col("l_suppkey") % 3 > 0), "IS").otherwise("note").alias("source"), F.col("l_linenumber").alias("table_seq"), F.floor("l_quantity").cast("long").alias("value"))
    return standardize.one_off_totals(c, ["l_suppkey"], {"impairment": "(?i)impairment", "disposal": "(?i)disposal"})


@query("o6_49_equity_signs", "#l_suppkey #l_linenumber #value #fixed")
def equity_signs(spark, sf_dir):
    """A search over signs: no SQL; a unit test holds it to brute force."""
    d = read(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.sum(F.floor("l_quantity").cast("long")).alias("value"))
    role = F.when(F.col("l_linenumber") == 1, "open").when(F.col("l_linenumber") == 7, "close").otherwise("move")
    return standardize.repaired_equity(d.withColumns({"role": role, "unmarked": F.col("l_linenumber") % 2 == 0}), ["l_suppkey"], "l_linenumber")


@query("o6_51_cross_filing_fill", "corp #fy statement #value", "SELECT corp, fy, statement, cogs AS value FROM (SELECT *, 'IS' AS statement FROM a) WHERE n % 3 = 0 AND n % 2 = 0 AND corp NOT LIKE '2%'", A)
def cross_filing_fill(spark, sf_dir):
    rows = annual(spark, sf_dir).withColumn("statement", F.lit("IS"))
    donors = rows.select("corp", "fy", "statement", F.col("cogs").alias("value"), (F.col("fy") + F.when(F.col("n") % 2 == 0, 1).otherwise(2)).alias("filing_year"))
    return standardize.filled_from_next(rows.where("n % 3 <> 0"), donors, ["corp"], "fy", ~F.col("corp").startswith("2"))


@query("o6_47_grid_cells", "#page_id label text", "SELECT page_id, regexp_extract(x, '>([^<]*)</a>', 1) AS label, regexp_extract(x, '>([^<]*)</a>', 1) AS text FROM (SELECT page_id, unnest(regexp_extract_all(html, '<li><a[^>]*>[^<]*</a>')) AS x FROM pages)")
def grid_cells(spark, sf_dir):
    """The pages' menus as two-column tables with a header and a total row."""
    html = F.concat(F.lit("<table><tr><th>name<th>amount</tr>"), F.array_join(F.transform(F.regexp_extract_all("html", F.lit("<li><a[^>]*>([^<]*)</a>"), F.lit(1)), lambda x: F.concat(F.lit("<tr><td>"), x, F.lit("<td>"), x, F.lit("</tr>"))), ""), F.lit("<tr><td>total<td>9</table>"))
    g = grids.grids(read(spark, sf_dir, "pages").select("page_id", html.alias("html")), "html", ["page_id"])
    return grids.grid_cells(g, ["page_id", "table_ord"], "amount")


@query("o1_09_indent_paths", "#l_orderkey #place path #depth")
def indent_paths(spark, sf_dir):
    """A stack over rows in order: no SQL; a unit test holds it to its rule. Dealt by order once, for both steps."""
    d = read(spark, sf_dir, "lineitem").repartition("l_orderkey").groupBy("l_orderkey", F.col("l_linenumber").alias("place")).agg(F.max(F.floor(F.col("l_quantity") / 13)).cast("long").alias("indent"), F.max("l_returnflag").alias("label"))
    return grids.with_paths(d, ["l_orderkey"], "place", "label", "indent")


@query("o7_10_printed_dates", "#o_orderkey printed", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE strftime(o_orderdate, '%Y.%m.%d') END AS printed FROM orders")
def printed_dates(spark, sf_dir):
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 5
    said = F.when(k == 0, F.date_format(d, "yyyy-M-d")).when(k == 1, F.date_format(d, "yyyyMMdd")).when(k == 2, F.concat(F.year(d).cast("string"), F.lit("년 "), F.month(d).cast("string"), F.lit("월 "), F.day(d).cast("string"), F.lit("일"))).when(k == 3, F.date_format(d, "yyyy. M. d.")).otherwise("no date")
    return read(spark, sf_dir, "orders").select("o_orderkey", periods.printed_date(said).alias("printed"))


@query("o7_11_tenures", "#c_custkey ~years", "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN (c_custkey % 30)::DOUBLE WHEN 1 THEN round(c_custkey % 9 + c_custkey % 12 / 12.0::DOUBLE, 2) WHEN 2 THEN round(c_custkey % 12 / 12.0::DOUBLE, 2) END AS years FROM customer")
def tenures(spark, sf_dir):
    c, k = F.col("c_custkey"), F.col("c_custkey") % 4
    s = lambda m: (c % m).cast("string")
    said = F.when(k == 0, s(30)).when(k == 1, F.concat(s(9), F.lit("년 "), s(12), F.lit("개월"))).when(k == 2, F.concat(s(12), F.lit(" months"))).otherwise("-")
    return read(spark, sf_dir, "customer").select("c_custkey", periods.tenure_years(said).alias("years"))


@query("o8_19_derived_series", "corp #fy #q ~ratio ~yoy ~ttm", f"SELECT corp, fy, q, {div('fcf', 'revenue')} AS ratio, {grow('fcf', 'lag(fcf, 4) OVER w')} AS yoy, CASE WHEN count(*) OVER v = 4 THEN sum(fcf) OVER v END AS ttm FROM qs WINDOW w AS (PARTITION BY corp ORDER BY fy, q), v AS (PARTITION BY corp ORDER BY fy, q ROWS 3 PRECEDING)", Q)
def derived_series(spark, sf_dir):
    rows, order = quarterly(spark, sf_dir), [F.col("fy"), F.col("q")]
    out = reads.derived_series(rows, ["corp"], order, "ratio", "fcf", "revenue", name="ratio")
    out = reads.derived_series(out, ["corp"], order, "yoy", "fcf", quarter=True, name="yoy")
    return reads.derived_series(out, ["corp"], order, "ttm", "fcf", name="ttm")


@query("o8_24_comparison", "corp #fy metric ~value #place %best", "SELECT corp, fy, metric, value, CASE WHEN value IS NOT NULL THEN rank() OVER (PARTITION BY fy, metric ORDER BY CASE metric WHEN 'net_debt' THEN -value ELSE value END DESC NULLS LAST) END AS place, CASE WHEN value IS NOT NULL THEN rank() OVER (PARTITION BY fy, metric ORDER BY CASE metric WHEN 'net_debt' THEN -value ELSE value END DESC NULLS LAST) = 1 END AS best FROM (SELECT corp, fy, unnest(['revenue', 'net_debt']) AS metric, unnest([revenue, net_debt]) AS value FROM a)", A)
def comparison(spark, sf_dir):
    return reads.comparison(annual(spark, sf_dir).select("corp", "fy", "revenue", "net_debt"), "corp", {"revenue": True, "net_debt": False}, ["fy"])


@query("o9_03_quarter_window", "corp #n_rows #newest_revenue", "SELECT corp, count(*) AS n_rows, max(CASE WHEN r = 1 THEN revenue END) AS newest_revenue FROM (SELECT *, row_number() OVER (PARTITION BY corp ORDER BY fy DESC, q DESC) AS r FROM qs WHERE data_quality < 3) WHERE r <= 9 GROUP BY corp", Q)
def quarter_window(spark, sf_dir):
    w = screen.window_of(quarterly(spark, sf_dir), "corp", [F.col("fy").desc(), F.col("q").desc()], 8)
    return w.groupBy("corp").agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.when(F.col("r") == 1, F.col("revenue"))).alias("newest_revenue"))


@query("o9_18_ttm_multiples", "corp #fy #q ~per ~psr", "SELECT corp, fy, q, CASE WHEN market_cap > 0 AND coalesce(nullif(cn, 0), ni) > 0 THEN market_cap::DOUBLE / coalesce(nullif(cn, 0), ni) END AS per, CASE WHEN market_cap > 0 AND rev > 0 THEN market_cap::DOUBLE / rev END AS psr FROM (SELECT *, CASE WHEN count(*) OVER w = 4 THEN sum(net_income) OVER w END AS ni, CASE WHEN count(*) OVER w = 4 THEN sum(controlling_ni) OVER w END AS cn, CASE WHEN count(*) OVER w = 4 THEN sum(revenue) OVER w END AS rev FROM qs WINDOW w AS (PARTITION BY corp ORDER BY fy, q ROWS 3 PRECEDING))", Q)
def ttm_multiples(spark, sf_dir):
    summed = windows.ttm(quarterly(spark, sf_dir), ["corp"], [F.col("fy"), F.col("q")], screen.FLOWS)
    return summed.withColumns(metrics.company_multiples())


@query("o9_09_composition", "#l_suppkey l_returnflag #v ~share", "SELECT l_suppkey, l_returnflag, v, v * 100.0::DOUBLE / sum(v) OVER (PARTITION BY l_suppkey) AS share FROM (SELECT l_suppkey, l_returnflag, floor(l_quantity)::BIGINT AS v FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_shipdate DESC, l_extendedprice DESC, l_orderkey) = 1)")
def composition(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", F.floor("l_quantity").cast("long").alias("v"), "l_shipdate", "l_extendedprice", "l_orderkey")
    return reads.composition(rows, ["l_suppkey"], [F.col("l_shipdate").desc(), F.col("l_extendedprice").desc(), F.col("l_orderkey")], "l_returnflag", "v")


@query("o9_10_amendments", "#o_custkey #fy #n_filings #newest %reflected", "SELECT o_custkey, fy, count(*) AS n_filings, max(o_orderkey) AS newest, max(o_orderkey) % 3 <> 0 AS reflected FROM (SELECT *, year(o_orderdate) AS fy FROM orders) GROUP BY 1, 2 HAVING count(*) > 1")
def amendments(spark, sf_dir):
    f = read(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("fy"), F.col("o_orderkey").alias("rcept"))
    stored = f.groupBy("o_custkey", "fy").agg(F.max("rcept").alias("m")).where("m % 3 <> 0").select("o_custkey", "fy", F.create_map(F.lit("BS"), "m", F.lit("IS"), F.col("m") - 1).alias("sources"))
    return reads.amendment_summary(f, stored, ["o_custkey", "fy"])


@query("o9_12_repair_plan", "#code %day #close #f_close ~factor", "SELECT code, day, close, close * 2 AS f_close, list_sort([2.0::DOUBLE, (close + 10)::DOUBLE / close, (raw * 2)::DOUBLE / nullif(raw, 0)])[2] AS factor FROM p WHERE volume % 5 = 0", P)
def repair_plan(spark, sf_dir):
    stored = prices(spark, sf_dir).select("code", "day", "close", F.col("close").alias("high"), F.col("raw").alias("low"), "volume")
    fresh = stored.withColumns({"close": F.when(F.col("volume") % 5 == 0, F.col("close") * 2).otherwise(F.col("close")), "high": F.col("high") + 10, "low": F.col("low") * 2})
    return market.repair_plan(stored, fresh)


@query("o9_14_debt_null_classes", "class #n", "SELECT CASE WHEN n % 5 = 0 THEN 'no line' WHEN qty % 2 = 1 THEN 'line with value' ELSE 'line without value' END AS class, count(*) AS n FROM a WHERE net_debt IS NULL GROUP BY 1", A)
def debt_null_classes(spark, sf_dir):
    rows = annual(spark, sf_dir)
    lines = rows.where("n % 5 <> 0").select("corp", "fy", F.lit("Bonds payable").alias("label"), (F.col("qty") % 2).alias("value"))
    return reads.debt_null_classes(rows, lines, ["corp", "fy"])


@query("o9_22_report_list", "#rcept #fy period file", "SELECT rcept, fy, period, CASE WHEN rcept % 4 <> 0 THEN 'f' || rcept END AS file FROM (SELECT o_orderkey AS rcept, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE year(o_orderdate) END AS fy, ['Q1', 'H1', 'Q3', 'FY'][quarter(o_orderdate)::INT] AS period FROM orders WHERE o_orderstatus = 'F') ORDER BY fy DESC NULLS LAST, CASE period WHEN 'FY' THEN 1 WHEN 'Q3' THEN 2 WHEN 'H1' THEN 3 ELSE 4 END, rcept LIMIT 100")
def report_list(spark, sf_dir):
    f = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("rcept"), F.when(F.col("o_orderkey") % 9 != 0, F.year("o_orderdate")).alias("fy"), F.element_at(F.array(*map(F.lit, ("Q1", "H1", "Q3", "FY"))), F.quarter("o_orderdate")).alias("period"), (F.col("o_orderstatus") == "F").alias("is_final"))
    files = f.where("rcept % 4 <> 0").select("rcept", F.concat(F.lit("f"), F.col("rcept").cast("string")).alias("file"))
    return reads.report_list(f, files)


@query("o9_24_share_deltas", "#event_id #delta", "SELECT event_id, CASE WHEN event_id % 4 <> 3 OR event_id % 5 <> 4 THEN coalesce(CASE WHEN event_id % 4 <> 3 THEN event_id * 2 END, 0) - coalesce(CASE WHEN event_id % 5 <> 4 THEN event_id END, 0) END AS delta FROM events")
def share_deltas(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 4 != 3, F.col("event_id") * 2).alias("issued"), F.when(F.col("event_id") % 5 != 4, F.col("event_id")).alias("retired"))
    return e.withColumn("delta", reads.share_delta(["issued"], ["retired"]))


@query("o10_02_stale_series", "%newest", "SELECT newest FROM (SELECT max(day) AS newest FROM (SELECT day FROM p GROUP BY day HAVING count(*) >= 20)) WHERE newest IS NULL OR DATE '2001-12-31' - newest > 6", P)
def stale_series(spark, sf_dir):
    return checks.stale_series(prices(spark, sf_dir), "day", F.to_date(F.lit("2001-12-31")), 20)


@query("o10_15_unit_marks", "#p_partkey", "SELECT p_partkey FROM part WHERE p_partkey % 3 = 1 OR p_partkey % 5 = 0")
def unit_marks(spark, sf_dir):
    label = F.when(F.col("p_partkey") % 3 == 1, F.concat("p_name", F.lit(" ( 백만 원 )"))).when(F.col("p_partkey") % 5 == 0, F.concat("p_name", F.lit(" 단 위 : 원"))).otherwise(F.col("p_name"))
    return checks.unit_marks(read(spark, sf_dir, "part").withColumn("label", label), "label")


@query("o10_19_self_checks", "corp #fy balance cash current gross verdict", "SELECT *, CASE WHEN list_contains([balance, cash, current, gross], 'FAIL') THEN 'suspect' WHEN list_contains([balance, cash, current, gross], 'PASS') THEN 'ok' ELSE 'na' END AS verdict FROM (SELECT corp, fy, CASE WHEN n % 4 = 0 THEN 'NA' WHEN n % 7 = 0 THEN 'FAIL' ELSE 'PASS' END AS balance, CASE WHEN n % 3 = 0 THEN 'NA' WHEN n % 5 = 0 THEN 'FAIL' ELSE 'PASS' END AS cash, 'NA' AS current, CASE WHEN n % 2 = 0 THEN 'NA' ELSE 'PASS' END AS gross FROM a)", A)
def self_checks(spark, sf_dir):
    rows = annual(spark, sf_dir).withColumns({"unit": F.lit(1000), "total_assets": F.expr("CASE WHEN n % 4 = 0 THEN NULL WHEN n % 7 = 0 THEN total_assets + 2001 ELSE total_assets + 2000 END"), "cash_open": F.col("cash"), "cash_change": F.col("capex"), "cash_close": F.expr("CASE WHEN n % 3 = 0 THEN NULL WHEN n % 5 = 0 THEN cash + capex - 9999 ELSE cash + capex END"), "noncurrent_assets": F.lit(None).cast("long"), "gross_profit": F.expr("CASE WHEN n % 2 = 0 THEN NULL ELSE revenue - abs(cogs) END")})
    return checks.self_checks(rows)


@query("o10_21_equity_cross_check", "#l_suppkey #closing %agrees", "SELECT l_suppkey, max(c) AS closing, abs(max(c) - max(t)) <= 2 AS agrees FROM (SELECT l_suppkey, CASE WHEN l_suppkey % 3 = 0 THEN l_linenumber ELSE l_suppkey * 10 END AS c, l_suppkey * 10 + l_suppkey % 4 AS t FROM lineitem) GROUP BY 1 HAVING count(DISTINCT c) = 1")
def equity_cross_check(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    sce = lines.select("l_suppkey", F.when(F.col("l_suppkey") % 3 == 0, F.col("l_linenumber").cast("long")).otherwise(F.col("l_suppkey") * 10).alias("closing"))
    bs = lines.select("l_suppkey").distinct().withColumn("total_equity", F.col("l_suppkey") * 10 + F.col("l_suppkey") % 4)
    return checks.equity_against_balance(sce, bs, ["l_suppkey"])


@query("o10_23_rounding_slack", "corp #fy #slack", "SELECT corp, fy, greatest(1, ceil(n / 2.0))::BIGINT * 1000 AS slack FROM a", A)
def rounding_slack(spark, sf_dir):
    return annual(spark, sf_dir).withColumn("slack", checks.rounding_slack(F.col("n"), F.lit(1000)))


@query("o10_27_pattern_scan", "#event_id rule evidence", "SELECT event_id, r.rule AS rule, regexp_extract(props, r.p) AS evidence FROM events, (SELECT unnest(['high', 'round']) AS rule, unnest(['9[0-9]', '[0-9]0']) AS p) r WHERE regexp_matches(props, r.p)")
def pattern_scan(spark, sf_dir):
    return checks.pattern_scan(read(spark, sf_dir, "events"), ["event_id"], "props", {"high": "9[0-9]", "round": "[0-9]0"})
