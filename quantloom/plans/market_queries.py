"""Queries of O1, O3, O4, O5, O9 over daily prices, orders and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from quantloom.operators import aggregates, joins, windows
from quantloom.plans import market
from quantloom.plans.catalog import query
from quantloom.plans.fundamentals import annual, read, sql_statements, statements
from quantloom.plans.market import SQL_PRICES as P
from quantloom.plans.market import prices

#: Reports of a supplier: orders of the customer with its number, one a day.
R = "r AS (SELECT o_custkey AS code, o_orderdate::DATE AS report_day, max(floor(o_totalprice * 100)::BIGINT) AS total FROM orders GROUP BY ALL)"


def reports(spark, sf_dir):
    return read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("code"), F.col("o_orderdate").cast("date").alias("report_day")).agg(F.max(F.floor(F.col("o_totalprice") * 100).cast("long")).alias("total"))


@query("o3_03_asof", "#code %day #close %report_day #total", "SELECT p.code, day, close, report_day, total FROM p ASOF LEFT JOIN r ON p.code = r.code AND p.day >= r.report_day", f"{P}, {R}")
def asof(spark, sf_dir):
    return joins.asof(prices(spark, sf_dir), reports(spark, sf_dir), ["code"], "day", "report_day", ["total"], slice_by=F.year("__t"))


@query("o3_04_step_value", "#code %day #total", "SELECT p.code, day, s.total FROM p LEFT JOIN s ON p.code = s.code AND day >= valid_from AND day < valid_to", f"{P}, {R}, s AS (SELECT code, total, CASE WHEN row_number() OVER w = 1 THEN DATE '1900-01-01' ELSE report_day END AS valid_from, coalesce(lead(report_day) OVER w, DATE '9999-12-31') AS valid_to FROM r WINDOW w AS (PARTITION BY code ORDER BY report_day))")
def step_value(spark, sf_dir):
    return joins.step_value(prices(spark, sf_dir), reports(spark, sf_dir), ["code"], "day", "report_day", ["total"])


@query("o3_05_asof_within", "#code %day %report_day #total", "SELECT p.code, day, CASE WHEN day - report_day <= 30 THEN report_day END AS report_day, CASE WHEN day - report_day <= 30 THEN total END AS total FROM p ASOF LEFT JOIN r ON p.code = r.code AND p.day > r.report_day", f"{P}, {R}")
def asof_within(spark, sf_dir):
    return joins.asof_within(prices(spark, sf_dir), reports(spark, sf_dir), ["code"], "day", "report_day", ["total"], 30)


@query("o3_06_nearest_date", "#code %report_day #total %day #close", "SELECT r.code, report_day, total, day, close FROM r LEFT JOIN p ON p.code = r.code AND abs(day - report_day) <= 7 QUALIFY row_number() OVER (PARTITION BY r.code, report_day ORDER BY abs(day - report_day), day) = 1", f"{P}, {R}")
def nearest_date(spark, sf_dir):
    return joins.nearest_date(reports(spark, sf_dir), prices(spark, sf_dir), ["code"], "report_day", "day", "close")


@query("o3_07_snapshot", "#code #close", "SELECT code, arg_max(close, day) AS close FROM p WHERE close > 0 AND day BETWEEN DATE '1998-06-10' AND DATE '1998-06-30' GROUP BY code", P)
def snapshot(spark, sf_dir):
    return joins.snapshot(prices(spark, sf_dir), "code", "day", "close", F.to_date(F.lit("1998-06-30")))


@query("o3_02_latest_row", "#s_suppkey %day #close #volume", "SELECT s_suppkey, day, close, volume FROM supplier LEFT JOIN (SELECT * FROM p WHERE listed IS NOT NULL QUALIFY row_number() OVER (PARTITION BY code ORDER BY day DESC) = 1) ON s_suppkey = code", P)
def latest_row(spark, sf_dir):
    newest = windows.latest_row(prices(spark, sf_dir).where("listed IS NOT NULL"), ["code"], F.col("day"), ["day", "close", "volume"])
    return read(spark, sf_dir, "supplier").join(newest, F.col("s_suppkey") == F.col("code"), "left")


B = sql_statements("a", "fy", "o_orderstatus")


def by_status(spark, sf_dir):
    return statements(spark, sf_dir, "fy", "o_orderstatus")


@query("o2_08_basis_fallback", "corp #fy o_orderstatus #revenue", "SELECT corp, fy, o_orderstatus, revenue FROM (SELECT * FROM a WHERE (n + fy) % 3 <> 0) JOIN (SELECT corp, fy, bool_or(o_orderstatus = 'F') AS has FROM a WHERE (n + fy) % 3 <> 0 GROUP BY corp, fy) USING (corp, fy) WHERE o_orderstatus = CASE WHEN has THEN 'F' ELSE 'O' END", B)
def basis(spark, sf_dir):
    return joins.chosen_basis(by_status(spark, sf_dir).where("(n + fy) % 3 <> 0"), ["corp", "fy"], "o_orderstatus", "F", "O")


@query(
    "o2_01_correction_overlay",
    "#id status #value",
    """SELECT o.o_orderkey AS id, o_orderstatus AS status, CASE WHEN kind = 'value' THEN value ELSE floor(o_totalprice * 100)::BIGINT END AS value FROM orders o LEFT JOIN (SELECT * FROM fx WHERE kind IN ('value', 'drop')) f ON o_orderkey = line_id WHERE kind IS DISTINCT FROM 'drop'
       UNION ALL SELECT -line_id, fill->>'$.status', (fill->>'$.value')::BIGINT FROM fx WHERE kind = 'fill'""",
    """fx AS (SELECT event_id AS line_id, ['value', 'drop', 'fill'][(event_id % 3 + 1)::INT] AS kind, floor(value * 100)::BIGINT AS value, CASE WHEN event_id % 3 = 2 THEN ('{"status":"' || event_type || '","value":' || (event_id * 7) || '}')::JSON END AS fill FROM events WHERE event_id % 5 = 0)""",
)
def overlay(spark, sf_dir):
    lines = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.floor(F.col("o_totalprice") * 100).cast("long").alias("value"))
    k = F.col("event_id") % 3
    fill = F.when(k == 2, F.concat(F.lit('{"status":"'), "event_type", F.lit('","value":'), (F.col("event_id") * 7).cast("string"), F.lit("}")))
    fixes = read(spark, sf_dir, "events").where("event_id % 5 = 0").select(F.col("event_id").alias("line_id"), F.when(k == 0, "value").when(k == 1, "drop").otherwise("fill").alias("kind"), F.floor(F.col("value") * 100).cast("long").alias("value"), fill.alias("fill"))
    return joins.overlay(lines, fixes, "status string, value long")


@query(
    "o1_07_upsert",
    "#code %day #close #listed",
    "SELECT coalesce(o.code, n.code) AS code, coalesce(o.day, n.day) AS day, coalesce(n.close, o.close) AS close, coalesce(n.listed, o.listed) AS listed FROM (SELECT * FROM p WHERE day(day) % 2 = 0) o FULL JOIN (SELECT code, day, close + 1 AS close, listed FROM p WHERE day(day) % 3 = 0) n ON o.code = n.code AND o.day = n.day",
    P,
)
def upsert(spark, sf_dir):
    p = prices(spark, sf_dir).select("code", "day", "close", "listed")
    return joins.upsert(p.where("day(day) % 2 = 0"), p.where("day(day) % 3 = 0").withColumn("close", F.col("close") + 1), ["code", "day"], ["listed"])


@query("o1_08_insert_absent", "#code %day #close", "SELECT code, day, close FROM p WHERE day(day) % 2 = 0 UNION ALL SELECT code, day, close + 1 FROM p WHERE day(day) % 3 = 0 AND day(day) % 2 <> 0", P)
def insert_absent(spark, sf_dir):
    p = prices(spark, sf_dir).select("code", "day", "close")
    return joins.insert_absent(p.where("day(day) % 2 = 0"), p.where("day(day) % 3 = 0").withColumn("close", F.col("close") + 1), ["code", "day"])


@query("o1_12_replace_units", "corp #fy o_orderstatus #revenue", "SELECT corp, fy, o_orderstatus, revenue FROM a WHERE NOT (fy = 1998 OR (fy = 1999 AND o_orderstatus = 'P')) UNION ALL SELECT corp, fy, o_orderstatus, revenue * 2 FROM a WHERE fy = 1998 AND o_orderstatus <> 'O'", B)
def replace_units(spark, sf_dir):
    a = by_status(spark, sf_dir).select("corp", "fy", "o_orderstatus", "revenue")
    units = a.where("fy = 1998 OR (fy = 1999 AND o_orderstatus = 'P')").select("corp", "fy", "o_orderstatus")
    return joins.replace_units(a, a.where("fy = 1998 AND o_orderstatus <> 'O'").withColumn("revenue", F.col("revenue") * 2), units, ["corp", "fy", "o_orderstatus"])


@query("o3_10_neighbour_median", "corp #fy o_orderstatus #revenue ~neighbour_median #n_neighbours", "SELECT x.corp, x.fy, x.o_orderstatus, x.revenue, median(y.revenue) AS neighbour_median, count(y.revenue) AS n_neighbours FROM a x LEFT JOIN a y ON x.corp = y.corp AND x.o_orderstatus <> y.o_orderstatus AND abs(x.fy - y.fy) <= 1 GROUP BY ALL", B)
def neighbour_median(spark, sf_dir):
    return joins.neighbour_median(by_status(spark, sf_dir), ["corp"], "o_orderstatus", "fy", "revenue")


_CELLS = ("revenue", "interest_expense", "net_debt", "cash")


@query(
    "o9_16_cell_diff",
    "corp #fy item ~before ~after kind",
    f"""SELECT * FROM (SELECT coalesce(b.corp, x.corp) AS corp, coalesce(b.fy, x.fy) AS fy, coalesce(b.col, x.col) AS item, b.v::DOUBLE AS before, x.v::DOUBLE AS after,
        CASE WHEN b.corp IS NULL THEN 'added' WHEN x.corp IS NULL THEN 'removed' WHEN b.v IS NULL AND x.v IS NOT NULL THEN 'null_to_value' WHEN b.v IS NOT NULL AND x.v IS NULL THEN 'value_to_null' WHEN abs(b.v - x.v) > 0.25 * greatest(abs(b.v), abs(x.v)) THEN 'changed' END AS kind
      FROM (SELECT corp, fy, unnest({list(_CELLS)}) AS col, unnest([{', '.join(_CELLS)}]) AS v FROM a WHERE o_orderstatus = 'F') b FULL JOIN (SELECT corp, fy, unnest({list(_CELLS)}) AS col, unnest([{', '.join(_CELLS)}]) AS v FROM a WHERE o_orderstatus = 'O') x ON b.corp = x.corp AND b.fy = x.fy AND b.col = x.col) WHERE kind IS NOT NULL""",
    B,
)
def cell_diff(spark, sf_dir):
    a = by_status(spark, sf_dir)
    return joins.cell_diff(a.where("o_orderstatus = 'F'"), a.where("o_orderstatus = 'O'"), ["corp", "fy"], _CELLS, 0.25)


@query(
    "o3_18_reconcile",
    "#l_partkey l_returnflag #n_source #n_stored status",
    """SELECT coalesce(s.l_partkey, t.l_partkey) AS l_partkey, coalesce(s.l_returnflag, t.l_returnflag) AS l_returnflag, len(sv) AS n_source, len(tv) AS n_stored,
         CASE WHEN tv IS NULL THEN 'missing' WHEN sv IS NULL THEN 'extra' WHEN len(list_filter(sv, lambda u: len(list_filter(tv, lambda w: abs(u - w) <= 2)) > 0)) > 0 THEN 'match' ELSE 'value_diff' END AS status
       FROM (SELECT l_partkey, l_returnflag, list(DISTINCT floor(l_quantity)::BIGINT) AS sv FROM lineitem WHERE l_linenumber <= 2 GROUP BY ALL) s FULL JOIN (SELECT l_partkey, l_returnflag, list(DISTINCT floor(l_quantity)::BIGINT) AS tv FROM lineitem WHERE l_linenumber = 3 GROUP BY ALL) t ON s.l_partkey = t.l_partkey AND s.l_returnflag = t.l_returnflag""",
)
def reconcile(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", "l_linenumber", F.floor("l_quantity").alias("v"))
    out = joins.reconcile(lines.where("l_linenumber <= 2"), lines.where("l_linenumber = 3"), ["l_partkey", "l_returnflag"], "v", 2)
    n = lambda c: F.when(F.col(c).isNotNull(), F.size(c))
    return out.withColumns({"n_source": n("source_values"), "n_stored": n("stored_values")})


@query("o3_11_semi_join", "#c_custkey", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def semi(spark, sf_dir):
    return read(spark, sf_dir, "customer").join(read(spark, sf_dir, "orders").where("o_totalprice > 400000"), F.col("o_custkey") == F.col("c_custkey"), "left_semi")


@query("o3_12_anti_join", "#c_custkey", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def anti(spark, sf_dir):
    return read(spark, sf_dir, "customer").join(read(spark, sf_dir, "orders").where("o_totalprice > 400000"), F.col("o_custkey") == F.col("c_custkey"), "left_anti")


@query("o3_09_basis_pairs", "corp #fy #f_revenue #o_revenue", "SELECT x.corp, x.fy, x.revenue AS f_revenue, y.revenue AS o_revenue FROM a x JOIN a y USING (corp, fy) WHERE x.o_orderstatus = 'F' AND y.o_orderstatus = 'O' AND x.revenue < y.revenue * 0.5::DOUBLE", B)
def basis_pairs(spark, sf_dir):
    a = by_status(spark, sf_dir)
    side = lambda s, name: a.where(F.col("o_orderstatus") == s).select("corp", "fy", F.col("revenue").alias(name))
    return side("F", "f_revenue").join(side("O", "o_revenue"), ["corp", "fy"]).where(F.col("f_revenue") < F.col("o_revenue") * 0.5)


@query("o3_14_behind_newest", "#code %last_day #behind", "SELECT code, max(day) AS last_day, (SELECT max(day) FROM p) - max(day) AS behind FROM p GROUP BY code HAVING (SELECT max(day) FROM p) - max(day) > 2", P)
def behind(spark, sf_dir):
    last = prices(spark, sf_dir).groupBy("code").agg(F.max("day").alias("last_day"))
    newest = last.agg(F.max("last_day").alias("newest"))  # one row
    return last.crossJoin(F.broadcast(newest)).withColumn("behind", F.datediff("newest", "last_day")).where("behind > 2")


@query("o3_15_json_expand", "#event_id key #value", "SELECT event_id, k AS key, (props::JSON->>k)::BIGINT AS value FROM (SELECT *, unnest(json_keys(props::JSON)) AS k FROM events)")
def json_expand(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", F.explode(F.from_json("props", "map<string,long>")))


@query("o3_19_outer_merge", "#year #n_orders #n_lines", "SELECT coalesce(x.y, z.y) AS year, n_orders, n_lines FROM (SELECT year(o_orderdate) AS y, count(*) AS n_orders FROM orders WHERE year(o_orderdate) <> 1996 GROUP BY 1) x FULL JOIN (SELECT year(l_shipdate) AS y, count(*) AS n_lines FROM lineitem WHERE year(l_shipdate) <> 1999 GROUP BY 1) z ON x.y = z.y")
def outer_merge(spark, sf_dir):
    o = read(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n_orders")).where("year <> 1996")
    return o.join(read(spark, sf_dir, "lineitem").groupBy(F.year("l_shipdate").alias("year")).agg(F.count(F.lit(1)).alias("n_lines")).where("year <> 1999"), "year", "full")


@query("o4_06_bands", "#code ~min ~p10 ~p25 ~median ~p75 ~p90 ~max ~current #n ~percentile", "SELECT code, min(close) AS min, quantile_cont(close, 0.1) AS p10, quantile_cont(close, 0.25) AS p25, median(close) AS median, quantile_cont(close, 0.75) AS p75, quantile_cont(close, 0.9) AS p90, max(close) AS max, max(current) AS current, count(*) AS n, avg(CASE WHEN close < current THEN 100.0::DOUBLE ELSE 0 END) AS percentile FROM p JOIN (SELECT code, arg_max(close, day) AS current FROM p GROUP BY code) USING (code) GROUP BY code", P)
def bands(spark, sf_dir):
    return aggregates.bands(prices(spark, sf_dir), ["code"], "day", "close")


@query(
    "o4_11_beta",
    "#code #n_days ~beta",
    """SELECT code, count(*) AS n_days, CASE WHEN count(*) < 60 OR covar_samp(rs, ri) / var_samp(CASE WHEN rs IS NOT NULL THEN ri END) IS NULL THEN 1.0::DOUBLE ELSE greatest(0.3::DOUBLE, least(3.0::DOUBLE, covar_samp(rs, ri) / var_samp(CASE WHEN rs IS NOT NULL THEN ri END))) END AS beta
       FROM (SELECT code, close::DOUBLE / lag(close) OVER w - 1 AS rs, idx::DOUBLE / lag(idx) OVER w - 1 AS ri FROM p JOIN (SELECT day, (sum(close) // count(*))::BIGINT AS idx FROM p GROUP BY day) USING (day) WINDOW w AS (PARTITION BY code ORDER BY day)) GROUP BY code""",
    P,
)
def beta(spark, sf_dir):
    p = prices(spark, sf_dir)
    return aggregates.beta(p, p.groupBy("day").agg(F.expr("sum(close) div count(*)").alias("idx_close")).withColumnRenamed("idx_close", "close"), ["code"], "day", "close")


@query("o4_22_weekly", "#code %bucket #open #high #low #close #volume", "SELECT code, bucket, arg_min(raw, day) AS open, max(close) AS high, min(raw) AS low, arg_max(close, day) AS close, sum(volume) AS volume FROM (SELECT *, CASE WHEN count(*) OVER (PARTITION BY code) > 450 THEN day + ((7 - isodow(day)) % 7)::INT ELSE day END AS bucket FROM p) GROUP BY code, bucket", P)
def weekly(spark, sf_dir):
    p = prices(spark, sf_dir).withColumns({"open": F.col("raw"), "high": F.col("close"), "low": F.col("raw")})
    return aggregates.weekly(p, ["code"], "day", "open", "high", "low", "close", "volume", above=450)


@query("o5_04_basis_steps", "#code %day ~step ~bound", "SELECT * FROM (SELECT code, day, x - lag(x) OVER w AS step, 1.5 / least(lo, lag(lo) OVER w) AS bound FROM (SELECT code, day, ln(close::DOUBLE / raw) AS x, least(close, raw)::DOUBLE AS lo FROM p WHERE close > 0 AND raw > 0) WINDOW w AS (PARTITION BY code ORDER BY day)) WHERE abs(step) > bound AND abs(step) > 0.08", P)
def basis_steps(spark, sf_dir):
    return windows.basis_steps(prices(spark, sf_dir), ["code"], "day", "close", "raw").where("abs(step) > 0.08")


@query("o5_05_halts", "#code %day #close", "SELECT code, day, close FROM (SELECT *, lag(close) OVER w AS b, lead(close) OVER w AS x FROM p WINDOW w AS (PARTITION BY code ORDER BY day)) WHERE volume % 7 = 0 AND close <> b AND close <> x", P)
def halts(spark, sf_dir):
    return windows.halts_off_price(prices(spark, sf_dir).withColumn("volume", F.col("volume") % 7), ["code"], "day", "close", "volume")


@query("o5_06_intervals", "#code %valid_from %valid_to #total", "SELECT code, total, CASE WHEN row_number() OVER w = 1 THEN DATE '1900-01-01' ELSE report_day END AS valid_from, coalesce(lead(report_day) OVER w, DATE '9999-12-31') AS valid_to FROM r WINDOW w AS (PARTITION BY code ORDER BY report_day)", R)
def intervals(spark, sf_dir):
    return windows.intervals(reports(spark, sf_dir), ["code"], "report_day")


@query("o5_07_rank_min", "#s_suppkey ~s_acctbal #place", "SELECT s_suppkey, x AS s_acctbal, CASE WHEN x IS NOT NULL THEN rank() OVER (ORDER BY x DESC NULLS LAST) END AS place FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE floor(s_acctbal / 500) END AS x FROM supplier)")
def rank_min(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 4 != 0, F.floor(F.col("s_acctbal") / 500)).alias("s_acctbal"))
    return windows.rank_min(s, "s_acctbal", "place")


@query("o5_11_running_sum", "#code %report_day #total #confirmed", "SELECT code, report_day, total, sum(CASE WHEN total % 2 = 0 THEN total END) OVER (PARTITION BY code ORDER BY report_day) AS confirmed FROM r", R)
def running_sum(spark, sf_dir):
    return windows.running_sum(reports(spark, sf_dir), ["code"], ["report_day"], F.when(F.col("total") % 2 == 0, F.col("total")), "confirmed")


@query("o5_01_top_n", "#code %report_day #total #rank", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY report_day DESC) AS rank FROM r) WHERE rank <= 3", R)
def top_n(spark, sf_dir):
    return windows.top_n(reports(spark, sf_dir), ["code"], [F.col("report_day").desc()], 3, rank="rank")


@query("o5_21_median_of_three", "#code %day #mid", "SELECT code, day, list_sort([close, raw, volume * 10000])[2] AS mid FROM p", P)
def median_of_three(spark, sf_dir):
    return prices(spark, sf_dir).withColumn("mid", windows.median_of_three(F.col("close"), F.col("raw"), F.col("volume") * 10000))


@query("o5_23_set_operations", "#code %part", "SELECT code, 'union' AS part FROM (SELECT l_suppkey AS code FROM lineitem WHERE l_quantity > 49 UNION SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) UNION ALL SELECT code, 'except' FROM (SELECT s_suppkey AS code FROM supplier EXCEPT SELECT l_suppkey FROM lineitem WHERE l_quantity > 49 AND l_discount > 0.09)")
def set_operations(spark, sf_dir):
    lines, suppliers = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "supplier")
    union = lines.where("l_quantity > 49").select(F.col("l_suppkey").alias("code")).union(suppliers.where("s_acctbal < 0").select("s_suppkey")).distinct()
    gone = suppliers.select(F.col("s_suppkey").alias("code")).subtract(lines.where("l_quantity > 49 AND l_discount > 0.09").select("l_suppkey"))
    return union.withColumn("part", F.lit("union")).unionByName(gone.withColumn("part", F.lit("except")))


@query("o4_12_yearly_total", "#code #year #total #unit", "SELECT code, year, total, unit FROM (SELECT code, year(report_day) AS year, sum(total) AS total, CASE WHEN count(DISTINCT total % 3) = 1 THEN max(total % 3) END AS unit, count(*) OVER (PARTITION BY code) AS y FROM r GROUP BY 1, 2) WHERE y >= 2", R)
def yearly_total(spark, sf_dir):
    r = reports(spark, sf_dir).withColumns({"year": F.year("report_day"), "unit_of": F.col("total") % 3})
    return aggregates.yearly_total(r, ["code"], "year", "total", "unit_of")


@query("o4_13_share_of_total", "corp ~share", "SELECT corp, sum(CASE WHEN o_orderstatus = 'F' THEN revenue END)::DOUBLE / nullif(sum(CASE WHEN o_orderstatus IN ('F', 'O') THEN revenue END)::DOUBLE, 0) * 100 AS share FROM a GROUP BY corp", B)
def share_of_total(spark, sf_dir):
    return aggregates.part_of_total(by_status(spark, sf_dir), ["corp"], "o_orderstatus", "F", ["F", "O"], "revenue")


@query("o4_14_best_table", "#l_suppkey #l_linenumber #n_items", "SELECT * FROM (SELECT l_suppkey, l_linenumber, count(DISTINCT l_partkey) AS n_items FROM lineitem GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n_items DESC, l_linenumber) = 1")
def best_table(spark, sf_dir):
    return aggregates.best_table(read(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_linenumber", "l_partkey")


@query("o4_15_dilution", "#user_id #day #issued #potential #n_events kinds", "SELECT user_id, day(ts) AS day, sum(CASE WHEN event_type IN ('click', 'view') THEN floor(value)::BIGINT ELSE 0 END) AS issued, sum(CASE WHEN event_type IN ('click', 'view') THEN 0 ELSE floor(value)::BIGINT END) AS potential, count(*) AS n_events, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds FROM events GROUP BY 1, 2")
def dilution(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("user_id", F.dayofmonth("ts").alias("day"), "event_type", F.floor("value").cast("long").alias("delta"))
    return aggregates.dilution(e, ["user_id"], "day", "event_type", "delta", ["click", "view"])


@query("o4_16_potential_dilution", "#user_id ~potential_pct", "SELECT user_id, CASE WHEN count(*) FILTER (ts >= TIMESTAMP '2024-01-30') > 0 THEN sum(CASE WHEN ts >= TIMESTAMP '2024-01-30' THEN floor(value)::BIGINT END)::DOUBLE / nullif(max(user_id * 10), 0) END * 100 AS potential_pct FROM events GROUP BY user_id")
def potential_dilution(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("delta", F.floor("value").cast("long"))
    return aggregates.potential_dilution(e, ["user_id"], "ts", "delta", F.col("user_id") * 10, F.expr("TIMESTAMP_NTZ '2024-01-30 00:00:00'"))


@query("o4_18_content_hash", "#user_id content_hash #n_lines", "SELECT user_id, md5(string_agg(line, chr(10) ORDER BY line)) AS content_hash, count(*) AS n_lines FROM (SELECT user_id, event_type || ':' || event_id || ':' || props AS line FROM events) GROUP BY user_id")
def content_hash(spark, sf_dir):
    return aggregates.content_hash(read(spark, sf_dir, "events"), ["user_id"], F.concat_ws(":", "event_type", F.col("event_id").cast("string"), "props"))


@query("o4_24_largest_abs", "corp #value", f"SELECT corp, arg_max(fcf, abs(fcf)) AS value FROM a GROUP BY corp", sql_statements("a", "fy"))
def largest_abs(spark, sf_dir):
    return aggregates.largest_abs(annual(spark, sf_dir), ["corp"], "fcf")


@query("o4_25_same_sign_sum", "corp #value #n", "SELECT corp, CASE WHEN min(sign(net_income)) * max(sign(net_income)) >= 0 THEN sum(net_income) END AS value, count(*) AS n FROM a GROUP BY corp", sql_statements("a", "fy"))
def same_sign_sum(spark, sf_dir):
    return aggregates.same_sign_sum(annual(spark, sf_dir), ["corp"], "net_income")


@query("o4_23_status_tally", "corp #open #done #other", "SELECT c_nationkey || '-' || c_mktsegment AS corp, count(*) FILTER (o_orderstatus = 'O') AS open, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) FILTER (o_orderstatus NOT IN ('O', 'F')) AS other FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def status_tally(spark, sf_dir):
    joined = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy(F.concat_ws("-", "c_nationkey", "c_mktsegment").alias("corp")).agg(F.count_if(F.col("o_orderstatus") == "O").alias("open"), F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.count_if(~F.col("o_orderstatus").isin("O", "F")).alias("other"))


@query("o4_20_having", "#l_orderkey #l_linenumber #n", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 2")
def having(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).where("n > 2")


@query("o9_11_market_cap", "#code %day #market_cap", "SELECT p.code, p.day, raw * round_even(coalesce(listed, CASE WHEN p.day - k.day <= 30 THEN k.carried END) * coalesce(f.ratio, 1.0::DOUBLE), 0)::BIGINT AS market_cap FROM p ASOF LEFT JOIN (SELECT code, day, listed AS carried FROM p WHERE listed IS NOT NULL) k ON p.code = k.code AND p.day > k.day LEFT JOIN f ON p.code = f.code AND p.day >= valid_from AND p.day < valid_to", f"{P}, {R}, f AS (SELECT code, (total % 50 + 50) / 100.0::DOUBLE AS ratio, CASE WHEN row_number() OVER w = 1 THEN DATE '1900-01-01' ELSE report_day END AS valid_from, coalesce(lead(report_day) OVER w, DATE '9999-12-31') AS valid_to FROM r WHERE code % 2 = 0 WINDOW w AS (PARTITION BY code ORDER BY report_day))")
def market_cap(spark, sf_dir):
    floats = reports(spark, sf_dir).where("code % 2 = 0").select("code", F.col("report_day").alias("from_day"), ((F.col("total") % 50 + 50) / 100.0).alias("ratio"))
    return market.market_cap(prices(spark, sf_dir), floats)


@query("o9_15_price_breaks", "#code %day ~jump kind", "SELECT code, day, jump, CASE WHEN abs(rj) <= 0.305 THEN 'adjustment' WHEN sign(rj) = sign(jump) THEN 'real' ELSE 'mixed' END AS kind FROM (SELECT code, day, close::DOUBLE / nullif(lag(close) OVER w, 0) - 1 AS jump, raw::DOUBLE / nullif(lag(raw) OVER w, 0) - 1 AS rj FROM p WINDOW w AS (PARTITION BY code ORDER BY day)) WHERE abs(jump) > 0.305 AND rj IS NOT NULL", P)
def price_breaks(spark, sf_dir):
    return market.price_breaks(prices(spark, sf_dir))


@query(
    "o9_06_back_test",
    "#year #n_selected #n_universe ~port_1 ~bench_1 ~port_3 ~bench_3",
    """SELECT year, count(*) FILTER (sel) AS n_selected, count(*) AS n_universe, avg(CASE WHEN sel THEN h1::DOUBLE / h0 - 1 END) AS port_1, avg(h1::DOUBLE / h0 - 1) AS bench_1, avg(CASE WHEN sel THEN h3::DOUBLE / h0 - 1 END) AS port_3, avg(h3::DOUBLE / h0 - 1) AS bench_3
       FROM (SELECT year, code, code % 3 = year % 3 AS sel, max(CASE WHEN h = 0 THEN c END) AS h0, max(CASE WHEN h = 1 THEN c END) AS h1, max(CASE WHEN h = 3 THEN c END) AS h3
             FROM (SELECT y.year, h, code, arg_max(close, day) AS c FROM (SELECT unnest([1995, 1996, 1997]) AS year) y, (SELECT unnest([0, 1, 3]) AS h), p WHERE day <= make_date(y.year + 1 + h, 5, 1) AND day >= make_date(y.year + 1 + h, 5, 1) - 20 AND close > 0 GROUP BY 1, 2, 3) GROUP BY 1, 2) WHERE h0 IS NOT NULL GROUP BY year""",
    P,
)
def back_test(spark, sf_dir):
    p = prices(spark, sf_dir)
    universe = p.select("code").distinct().withColumn("year", F.explode(F.array(*map(F.lit, (1995, 1996, 1997)))))
    return market.back_test(universe.where("code % 3 = year % 3"), universe, p, (1995, 1996, 1997), (1, 3))


@query("o9_13_freshness", "item %last_day #n_rows %stale", "SELECT 'orders' AS item, max(o_orderdate)::DATE AS last_day, count(*) AS n_rows, DATE '2001-08-04' - max(o_orderdate)::DATE > 4 AS stale FROM orders UNION ALL SELECT 'lines', max(l_shipdate)::DATE, count(*), DATE '2001-08-04' - max(l_shipdate)::DATE > 4 FROM lineitem UNION ALL SELECT 'events', max(ts)::DATE, count(*), DATE '2001-08-04' - max(ts)::DATE > 4 FROM events")
def freshness(spark, sf_dir):
    return market.freshness({"orders": read(spark, sf_dir, "orders").select("o_orderdate"), "lines": read(spark, sf_dir, "lineitem").select("l_shipdate"), "events": read(spark, sf_dir, "events").select("ts")}, F.to_date(F.lit("2001-08-04")))


@query(
    "o9_17_delisting",
    "#code status action",
    """SELECT code, CASE WHEN action LIKE 'confirm%' THEN 'delisted' WHEN action = 'candidate' THEN 'candidate' WHEN action = 'reinstate' THEN 'listed' ELSE status END AS status, action FROM (
         SELECT code, status, CASE WHEN wish = 'confirm_registry' AND row_number() OVER (PARTITION BY wish ORDER BY code) > 20 THEN 'hold' WHEN wish = 'confirm_absence' AND row_number() OVER (PARTITION BY wish ORDER BY code) > 5 THEN 'hold' ELSE wish END AS action FROM (
           SELECT *, CASE WHEN on_ AND status IN ('candidate', 'delisted') THEN 'reinstate' WHEN on_ OR status = 'delisted' THEN 'keep' WHEN reg THEN 'confirm_registry' WHEN status = 'listed' THEN 'candidate' WHEN DATE '2000-06-01' - since >= 14 AND code % 2 = 0 THEN 'confirm_absence' ELSE 'hold' END AS wish FROM (
             SELECT c_custkey AS code, ['listed', 'candidate', 'delisted'][(c_custkey % 3 + 1)::INT] AS status, DATE '2000-05-01' + (c_custkey % 40)::INT AS since, c_custkey % 5 <> 0 AS on_, c_custkey % 60 = 35 AS reg FROM customer)))""",
)
def delisting(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("code"))
    state = c.withColumns({"status": F.when(F.col("code") % 3 == 0, "listed").when(F.col("code") % 3 == 1, "candidate").otherwise("delisted"), "since": F.date_add(F.to_date(F.lit("2000-05-01")), (F.col("code") % 40).cast("int")), "signal": F.col("code") % 2 == 0})
    return market.delisting(state, c.where("code % 5 <> 0"), c.where("code % 60 = 35"), F.to_date(F.lit("2000-06-01")), F.lit(True))
