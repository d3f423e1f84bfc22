"""Queries of single operators that the composed ones use inside."""

from __future__ import annotations

from pyspark.sql import functions as F

from quantloom.functions.nullsafe import growth, mean_of, safe_div
from quantloom.operators import checks, joins, periods, standardize, windows
from quantloom.plans import market, reads, screen
from quantloom.plans.catalog import div, grow, mean2, query
from quantloom.plans.fundamentals import SQL_SECTORS, annual, quarterly, read, sectors, sql_statements
from quantloom.plans.market import SQL_PRICES as P
from quantloom.plans.market import prices

A, Q = sql_statements("a", "fy"), sql_statements("qs", "fy", "q")


@query("o1_04_clean_quotes", "#code %day #open #high #low #close #volume", "SELECT code, day, nullif(raw * (volume % 4), 0) AS open, nullif(close * (volume % 3), 0) AS high, nullif(raw, 0) AS low, close * (volume % 5) AS close, volume FROM p WHERE close * (volume % 5) > 0", P)
def clean_quotes(spark, sf_dir):
    v = F.col("volume")
    return market.clean_quotes(prices(spark, sf_dir).withColumns({"open": F.col("raw") * (v % 4), "high": F.col("close") * (v % 3), "low": F.col("raw"), "close": F.col("close") * (v % 5)}))


@query("o1_05_exchange_updates", "#code %day #raw #listed", "SELECT p.code, p.day, CASE WHEN p.volume % 2 = 0 THEN p.raw + 1 ELSE p.raw END AS raw, CASE WHEN p.volume % 2 = 0 THEN coalesce(p.volume, p.listed) ELSE p.listed END AS listed FROM p", P)
def exchange_updates(spark, sf_dir):
    p = prices(spark, sf_dir)
    incoming = p.where("volume % 2 = 0").select("code", "day", (F.col("raw") + 1).alias("raw"), F.col("volume").alias("listed"))
    return market.raw_close_updates(p, incoming, ["code", "day"])[0]


@query("o2_02_quality_filter", "corp #fy #data_quality", "SELECT corp, fy, CASE WHEN n % 13 = 0 THEN NULL ELSE data_quality END AS data_quality FROM a WHERE coalesce(CASE WHEN n % 13 = 0 THEN NULL ELSE data_quality END, 1) < 3", A)
def quality_filter(spark, sf_dir):
    rows = annual(spark, sf_dir).withColumn("data_quality", F.when(F.col("n") % 13 != 0, F.col("data_quality")))
    return rows.where(F.coalesce("data_quality", F.lit(1)) < 3)


@query("o3_01_sector_join", "corp sector #fy #revenue", "SELECT corp, sector, fy, revenue FROM a JOIN sectors USING (corp)", f"{A}, {SQL_SECTORS}")
def sector_join(spark, sf_dir):
    return annual(spark, sf_dir).join(sectors(spark, sf_dir), "corp")


@query("o3_20_common_days", "#code %day #close #other", "SELECT x.code, x.day, x.close, y.close AS other FROM p x JOIN p y ON x.day = y.day AND y.code = x.code + 1", P)
def common_days(spark, sf_dir):
    """Every stock and the next one, on the days that both have."""
    p = prices(spark, sf_dir).select("code", "day", "close")
    return p.join(p.select((F.col("code") - 1).alias("code"), "day", F.col("close").alias("other")), ["code", "day"])


@query("o4_02_count_filter", "l_returnflag #n_small #n_late", "SELECT l_returnflag, count(*) FILTER (l_quantity < 10) AS n_small, count(*) FILTER (l_shipdate >= TIMESTAMP '2000-01-01') AS n_late FROM lineitem GROUP BY 1")
def count_filter(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count_if(F.col("l_quantity") < 10).alias("n_small"), F.count_if(F.col("l_shipdate") >= F.expr("TIMESTAMP_NTZ '2000-01-01 00:00:00'")).alias("n_late"))


@query("o4_19_scope_map", "#user_id #n_scopes #n_errors", "SELECT user_id, count(DISTINCT event_type) AS n_scopes, count(*) FILTER (event_type = 'error') AS n_errors FROM events GROUP BY 1")
def scope_map(spark, sf_dir):
    counts = read(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    maps = counts.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    return maps.select("user_id", F.size("m").alias("n_scopes"), F.coalesce(F.try_element_at("m", F.lit("error")), F.lit(0)).alias("n_errors"))


@query("o4_21_bounds", "#code %first_day %last_day #low #high #n_years", "SELECT code, min(day) AS first_day, max(day) AS last_day, min(close) AS low, max(close) AS high, count(DISTINCT year(day)) AS n_years FROM p GROUP BY 1", P)
def bounds(spark, sf_dir):
    return prices(spark, sf_dir).groupBy("code").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.min("close").alias("low"), F.max("close").alias("high"), F.count_distinct(F.year("day")).alias("n_years"))


@query("o5_10_slot_sequence", "#o_custkey #o_orderkey #seq", "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate END NULLS LAST, o_orderkey) AS seq FROM orders")
def slot_sequence(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate")).alias("filed"))
    return windows.top_n(o, ["o_custkey"], [F.col("filed").asc_nulls_last(), F.col("o_orderkey")], 10**9, rank="seq")


@query("o5_19_top_peers", "corp #cap", "SELECT corp, coalesce(market_cap, 0) AS cap FROM a WHERE fy = 2000 ORDER BY coalesce(market_cap, 0) DESC, corp LIMIT 12", A)
def top_peers(spark, sf_dir):
    return annual(spark, sf_dir).where("fy = 2000").withColumn("cap", F.coalesce("market_cap", F.lit(0))).orderBy(F.col("cap").desc(), "corp").limit(12)


@query("o6_22_net_income_fallback", "corp #fy #found", "SELECT corp, fy, coalesce(CASE WHEN n % 4 < 2 THEN NULL ELSE net_income END, CASE WHEN n % 2 = 0 THEN controlling_ni + coalesce(net_debt, 0) END) AS found FROM a", A)
def net_income_fallback(spark, sf_dir):
    rows = annual(spark, sf_dir)
    return rows.withColumn("found", standardize.net_income_fallback(F.when(F.col("n") % 4 >= 2, F.col("net_income")), F.col("controlling_ni"), F.col("net_debt"), F.col("n") % 2))


@query("o6_33_separate_basis", "corp #fy #ni #grade", "SELECT corp, fy, CASE WHEN n % 2 = 0 THEN net_income ELSE controlling_ni END AS ni, CASE WHEN make_date(fy::INT, 12, 31) > DATE '2000-06-30' THEN 3 ELSE data_quality END AS grade FROM a", A)
def separate_basis(spark, sf_dir):
    """O6.33 and O6.40."""
    basis = F.when(F.col("n") % 2 == 0, "separate").otherwise("consolidated")
    end = F.make_date("fy", F.lit(12), F.lit(31))
    return annual(spark, sf_dir).withColumns({"ni": standardize.separate_net_income(basis, F.col("controlling_ni"), F.col("net_income")), "grade": standardize.future_guard(end, F.to_date(F.lit("2000-06-30")), F.col("data_quality"))})


@query("o7_09_rebalance_days", "#fy %rebalance", "SELECT DISTINCT fy, make_date(fy::INT + 1, 5, 1) AS rebalance FROM a", A)
def rebalance_days(spark, sf_dir):
    return annual(spark, sf_dir).select("fy").distinct().withColumn("rebalance", periods.rebalance_day("fy"))


@query("o8_01_null_rules", "corp #fy ~ratio ~mean ~growth", f"SELECT corp, fy, {div('cfo', 'interest_expense')} AS ratio, {mean2('inventory', 'net_debt')} AS mean, {grow('inventory', 'net_debt')} AS growth FROM a", A)
def null_rules(spark, sf_dir):
    return annual(spark, sf_dir).withColumns({"ratio": safe_div("cfo", "interest_expense"), "mean": mean_of("inventory", "net_debt"), "growth": growth("inventory", "net_debt")})


@query("o8_23_sector_keys", "#c_custkey sector_key %finance", "SELECT c_custkey, left((c_custkey * 37 % 1000 + 100)::VARCHAR, 2) AS sector_key, left((c_custkey * 37 % 1000 + 100)::VARCHAR, 2) IN ('64', '65', '66') AS finance FROM customer")
def sector_keys(spark, sf_dir):
    code = (F.col("c_custkey") * 37 % 1000 + 100).cast("string")
    return read(spark, sf_dir, "customer").select("c_custkey", reads.sector_key(code).alias("sector_key"), reads.is_finance(code).alias("finance"))


@query("o9_02_annual_window", "corp #fy #r", "SELECT corp, fy, r FROM (SELECT *, row_number() OVER (PARTITION BY corp ORDER BY fy DESC) AS r FROM a WHERE data_quality < 3 AND fy <= 1999) WHERE r <= 4", A)
def annual_window(spark, sf_dir):
    return screen.window_of(annual(spark, sf_dir).where("fy <= 1999"), "corp", [F.col("fy").desc()], 3)


@query("o9_19_series_fallback", "corp #fy basis #revenue", "SELECT corp, fy, basis, revenue FROM s JOIN (SELECT corp, bool_or(basis = 'consolidated') AS has FROM s GROUP BY corp) USING (corp) WHERE basis = CASE WHEN has THEN 'consolidated' ELSE 'separate' END", f"{A}, s AS (SELECT corp, fy, revenue, CASE WHEN n % 6 = 0 THEN 'consolidated' ELSE 'separate' END AS basis FROM a)")
def series_fallback(spark, sf_dir):
    rows = annual(spark, sf_dir).withColumn("basis", F.when(F.col("n") % 6 == 0, "consolidated").otherwise("separate"))
    return joins.chosen_basis(rows, ["corp"], "basis", "consolidated", "separate")


@query("o9_26_parity_diff", "corp #fy item ~before ~after kind", "SELECT corp, fy, item, b::DOUBLE AS before, x::DOUBLE AS after, CASE WHEN b IS NULL AND x IS NOT NULL THEN 'null_to_value' WHEN b IS NOT NULL AND x IS NULL THEN 'value_to_null' ELSE 'changed' END AS kind FROM (SELECT corp, fy, unnest(['cash', 'net_debt']) AS item, unnest([cash, net_debt]) AS b, unnest([CASE WHEN n % 5 = 0 THEN NULL ELSE cash + n % 2 * cash // 10 END, coalesce(net_debt, 7)]) AS x FROM a) WHERE (b IS NULL) <> (x IS NULL) OR abs(b - x) > 0.02::DOUBLE * greatest(abs(b), abs(x))", A)
def parity_diff(spark, sf_dir):
    before = annual(spark, sf_dir).select("corp", "fy", "cash", "net_debt", "n")
    after = before.select("corp", "fy", F.expr("CASE WHEN n % 5 = 0 THEN NULL ELSE cash + n % 2 * cash div 10 END").alias("cash"), F.coalesce("net_debt", F.lit(7)).alias("net_debt"))
    return joins.cell_diff(before, after, ["corp", "fy"], ["cash", "net_debt"], 0.02)


@query("o10_05_stale_boundaries", "#code #n", "SELECT code, count(*) AS n FROM (SELECT code, abs(x - lag(x) OVER w) > 1.5 / least(lo, lag(lo) OVER w) AS hit FROM (SELECT code, day, ln(close::DOUBLE / raw) AS x, least(close, raw)::DOUBLE AS lo FROM p WHERE close > 0 AND raw > 0 AND day > DATE '2001-11-04' - 400) WINDOW w AS (PARTITION BY code ORDER BY day)) WHERE hit GROUP BY 1", P)
def stale_boundaries(spark, sf_dir):
    recent = prices(spark, sf_dir).where("day > date_sub(DATE '2001-11-04', 400)")
    return windows.basis_steps(recent, ["code"], "day", "close", "raw").groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query("o10_08_spikes", "corp #fy %spike", "SELECT corp, fy, CASE WHEN v > 4 * l AND v > 4 * r THEN 'high' ELSE 'low' END AS spike FROM (SELECT corp, fy, abs(net_income)::DOUBLE AS v, abs(lag(net_income) OVER w) AS l, abs(lead(net_income) OVER w) AS r FROM a WINDOW w AS (PARTITION BY corp ORDER BY fy)) WHERE v > 0 AND l > 0 AND r > 0 AND ((v > 4 * l AND v > 4 * r) OR (v * 4 < l AND v * 4 < r))", A)
def yearly_spikes(spark, sf_dir):
    return windows.neighbour_spikes(annual(spark, sf_dir), ["corp"], "fy", "net_income", 4.0)


@query("o10_12_unresolved", "corp #fy #n_conflicts", "SELECT corp, fy, n % 3 AS n_conflicts FROM a WHERE n % 3 > 0", A)
def unresolved(spark, sf_dir):
    held = F.map_filter(F.create_map(F.lit("cash"), F.col("n") % 3, F.lit("revenue"), F.when(F.col("n") % 3 == 2, 1).otherwise(0)), lambda k, v: v > 0)
    return annual(spark, sf_dir).withColumn("n_conflicts", F.size(held)).where("n_conflicts > 0")


@query("o10_11_unknown_kinds", "#event_id event_type", "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('click', 'view', 'signup') OR value < 0")
def unknown_kinds(spark, sf_dir):
    return read(spark, sf_dir, "events").where(~F.col("event_type").isin("click", "view", "signup") | (F.col("value") < 0))


@query("o10_06_quarter_gaps", "corp #fy #q", "SELECT corp, fy, q FROM (SELECT *, lag(fy * 4 + q) OVER (PARTITION BY corp ORDER BY fy, q) AS b FROM qs) WHERE fy * 4 + q - b > 1", Q)
def quarter_gaps(spark, sf_dir):
    rows = quarterly(spark, sf_dir).withColumn("t", F.col("fy") * 4 + F.col("q"))
    return windows.with_previous(rows, ["corp"], [F.col("t")], ["t"]).where("t - p_t > 1")


@query("o10_09_repeats", "corp #fy #v", "SELECT corp, fy, v FROM (SELECT corp, fy, n // 40 AS v, lag(n // 40) OVER (PARTITION BY corp ORDER BY fy) AS b FROM a) WHERE v = b", A)
def repeats(spark, sf_dir):
    return checks.repeats(annual(spark, sf_dir).withColumn("v", F.expr("n div 40")), ["corp"], "fy", "v")
