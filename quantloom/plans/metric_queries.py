"""Queries of O8, O9.1-O9.8 and O5 over company statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.functions import metrics
from quantloom.functions.nullsafe import cagr, filled, growth, turn
from quantloom.operators import aggregates, windows
from quantloom.plans import screen
from quantloom.plans.catalog import div, either, grow, mean2, pos, query
from quantloom.plans.fundamentals import SQL_SECTORS, annual, quarterly, sectors, sql_statements

A, Q = sql_statements("a", "fy"), sql_statements("qs", "fy", "q")
_PAIR = "revenue operating_income net_income controlling_ni total_assets total_equity gross_profit total_liabilities current_assets current_liabilities shares_out".split()
#: Annual rows with the row before by position.
PAIRED = f"{A}, w AS (SELECT *, {', '.join(f'lag({c}) OVER (PARTITION BY corp ORDER BY fy) AS p_{c}' for c in _PAIR)} FROM a)"


def sql_ratios(source: str = "w") -> str:
    rate = f"(CASE WHEN ebt > 0 THEN {div('tax_expense', 'ebt')} END)"
    nopat = f"trunc(operating_income::DOUBLE * (1 - CASE WHEN {rate} IS NOT NULL AND {rate} <> 0 THEN {rate} ELSE 0.22 END))::BIGINT"
    eq, ta = mean2("total_equity", "p_total_equity"), mean2("total_assets", "p_total_assets")
    days = lambda part, whole: f"(coalesce({part}, 0)::DOUBLE * 365 / nullif({whole}::DOUBLE, 0))"
    dso, dio, dpo = days("receivables", "revenue"), days("inventory", "cogs"), days("trade_payables", "cogs")
    return f"""SELECT *, {div('gross_profit', 'revenue')} AS gross_margin, {div('operating_income', 'revenue')} AS op_margin, {div('net_income', 'revenue')} AS net_margin, {div('ebitda', 'revenue')} AS ebitda_margin,
      {div('net_income', eq)} AS roe, {div('net_income', ta)} AS roa, {div('revenue', ta)} AS asset_turnover, {rate} AS effective_tax_rate, {nopat} AS nopat,
      total_equity + coalesce(net_debt, 0) AS invested_capital, {div(nopat, 'total_equity + coalesce(net_debt, 0)')} AS roic, {div('total_liabilities', 'total_equity')} AS debt_ratio,
      {div('current_assets', 'current_liabilities')} AS current_ratio, {div('operating_income', 'abs(interest_expense)')} AS interest_coverage, {pos('net_debt', 'ebitda')} AS net_debt_ebitda,
      {div('abs(capex)', 'revenue')} AS capex_to_revenue, {div('abs(capex)', 'da_total')} AS capex_to_dep, {div('fcf', 'revenue')} AS fcf_to_revenue, {div('cfo', 'net_income')} AS cfo_to_ni,
      {div('net_income - cfo', 'total_assets')} AS accrual_ratio, {dso} AS dso, {dio} AS dio, {dpo} AS dpo, {dso} + {dio} - {dpo} AS ccc,
      {grow('revenue', 'p_revenue')} AS revenue_growth, {grow('operating_income', 'p_operating_income')} AS op_income_growth, {grow('net_income', 'p_net_income')} AS net_income_growth, {grow('total_assets', 'p_total_assets')} AS asset_growth
      FROM {source}"""


def _ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return screen.with_ratios(annual(spark, sf_dir), ["corp"], [F.col("fy")])


@query("o8_04_ratios", "corp #fy ~gross_margin ~op_margin ~net_margin ~ebitda_margin ~roe ~roa ~asset_turnover ~effective_tax_rate #nopat #invested_capital ~roic ~debt_ratio ~current_ratio ~interest_coverage ~net_debt_ebitda ~capex_to_revenue ~capex_to_dep ~fcf_to_revenue ~cfo_to_ni ~accrual_ratio ~dso ~dio ~dpo ~ccc ~revenue_growth ~op_income_growth ~net_income_growth ~asset_growth", sql_ratios(), PAIRED)
def ratios(spark, sf_dir):
    return _ratios(spark, sf_dir)


def sql_multiples(cap: str = "market_cap") -> str:
    over = lambda a, b: f"(CASE WHEN {a} <> 0 THEN {pos(a, b)} END)"
    ev = f"(coalesce({cap}, 0) + coalesce(net_debt, 0))"
    return f"{over(cap, 'net_income')} AS per, {over(cap, 'total_equity')} AS pbr, {over(ev, 'ebitda')} AS ev_ebitda, {over(cap, 'revenue')} AS psr, {over(cap, 'cfo')} AS pcr"


@query("o8_07_screen_multiples", "corp #fy ~per ~pbr ~ev_ebitda ~psr ~pcr", f"SELECT corp, fy, {sql_multiples()} FROM a", A)
def screen_multiples(spark, sf_dir):
    return annual(spark, sf_dir).withColumns(metrics.screen_multiples())


_CAP = "(CASE WHEN market_cap > 0 THEN market_cap END)"
_EV = f"nullif({_CAP} + coalesce(net_debt, 0), 0)"


@query(
    "o8_08_company_multiples",
    "corp #fy #ev ~per ~pbr ~psr ~pcr ~ev_ebitda ~ev_ebit ~ev_fcf",
    f"""SELECT corp, fy, {_CAP} + coalesce(net_debt, 0) AS ev, {pos(_CAP, either('controlling_ni', 'net_income'))} AS per, {pos(_CAP, either('controlling_equity', 'total_equity'))} AS pbr, {pos(_CAP, 'revenue')} AS psr,
      {pos(_CAP, 'cfo')} AS pcr, {pos(_EV, 'ebitda')} AS ev_ebitda, {pos(_EV, 'operating_income')} AS ev_ebit, {pos(_EV, 'fcf')} AS ev_fcf FROM a""",
    A,
)
def company_multiples(spark, sf_dir):
    return annual(spark, sf_dir).withColumns(metrics.company_multiples())


@query(
    "o8_09_daily_multiples",
    "corp #fy ~per ~pbr ~psr ~ev_ebitda ~eps ~bps ~dps ~dividend_yield",
    f"""SELECT corp, fy, {pos('market_cap', 'coalesce(controlling_ni, net_income)')} AS per, {pos('market_cap', 'coalesce(controlling_equity, total_equity)')} AS pbr, {pos('market_cap', 'revenue')} AS psr,
      {pos('market_cap + coalesce(net_debt, 0)', 'ebitda')} AS ev_ebitda, {div('coalesce(controlling_ni, net_income)', 'shares_out')} AS eps, {div('coalesce(controlling_equity, total_equity)', 'shares_out')} AS bps,
      {div('abs(dividends_paid)', 'shares_out')} AS dps, {div('abs(dividends_paid)', 'market_cap')} AS dividend_yield FROM a""",
    A,
)
def daily_multiples(spark, sf_dir):
    return annual(spark, sf_dir).withColumns(metrics.daily_multiples())


_NI, _EQ = either("controlling_ni", "net_income"), either("controlling_equity", "total_equity")
_PNI = either("p_controlling_ni", "p_net_income")
_EPS, _BPS = f"(nullif({_NI}, 0)::DOUBLE / nullif(shares_out, 0))", f"(nullif({_EQ}, 0)::DOUBLE / nullif(shares_out, 0))"
_NIGROW = f"(CASE WHEN {_NI} > 0 AND {_PNI} > 0 THEN ({_NI} - {_PNI})::DOUBLE / {_PNI} END)"
SQL_MASTERS = f"""SELECT *, {_EPS} AS eps, {_BPS} AS bps, CASE WHEN {_EPS} > 0 AND {_BPS} > 0 THEN sqrt(22.5 * {_EPS} * {_BPS}) END AS graham_number,
  CASE WHEN {_EPS} > 0 AND {_BPS} > 0 AND price > 0 THEN sqrt(22.5 * {_EPS} * {_BPS}) / price - 1 END AS graham_upside,
  (current_assets - total_liabilities)::DOUBLE / nullif(shares_out, 0) AS ncav_per_share, CASE WHEN price > 0 THEN (current_assets - total_liabilities)::DOUBLE / nullif(shares_out, 0) / price END AS ncav_to_price,
  CASE WHEN {_NI} > 0 AND {_EQ} > 0 AND market_cap <> 0 THEN (market_cap::DOUBLE / {_NI}) * (market_cap::DOUBLE / {_EQ}) END AS per_pbr,
  {pos('operating_income', 'nullif(market_cap, 0) + coalesce(net_debt, 0)')} AS earnings_yield, {pos('operating_income', 'current_assets - current_liabilities + ppe')} AS return_on_capital,
  CASE WHEN {_NIGROW} > 0 AND market_cap <> 0 THEN (market_cap::DOUBLE / {_NI}) / ({_NIGROW} * 100) END AS peg, {pos('gross_profit', 'revenue')} - {pos('p_gross_profit', 'p_revenue')} AS gross_margin_delta,
  {pos('net_income', 'total_equity')} AS dupont_roe, {pos('net_income', 'revenue')} AS dupont_net_margin, {pos('nullif(revenue, 0)', 'total_assets')} AS dupont_asset_turnover, {pos('nullif(total_assets, 0)', 'total_equity')} AS dupont_leverage FROM w"""


@query("o8_10_masters", "corp #fy ~eps ~bps ~graham_number ~graham_upside ~ncav_per_share ~ncav_to_price ~per_pbr ~earnings_yield ~return_on_capital ~peg ~gross_margin_delta ~dupont_roe ~dupont_net_margin ~dupont_asset_turnover ~dupont_leverage", SQL_MASTERS, PAIRED)
def masters(spark, sf_dir):
    return _ratios(spark, sf_dir).withColumns(metrics.masters())


def _sql_f_score() -> str:
    ta = mean2("total_assets", "p_total_assets")
    pair = lambda a, b, op: f"({div(a, b)} {op} {div('p_' + a, 'p_' + b)})"
    tests = [f"({div('net_income', ta)} > 0)", "(cfo > 0)", "(cfo > net_income)", f"({div('net_income', ta)} > {div('p_net_income', 'p_total_assets')})", pair("total_liabilities", "total_equity", "<"), pair("current_assets", "current_liabilities", ">"), "(shares_out <= p_shares_out)", pair("gross_profit", "revenue", ">"), f"({div('revenue', ta)} > {div('p_revenue', 'p_total_assets')})"]
    return f"SELECT corp, fy, CASE WHEN {' + '.join(f'({t} IS NOT NULL)::INT' for t in tests)} >= 5 THEN {' + '.join(f'coalesce({t}::INT, 0)' for t in tests)} END AS f_score FROM w"


@query("o8_12_f_score", "corp #fy #f_score", _sql_f_score(), PAIRED)
def f_score(spark, sf_dir):
    return _ratios(spark, sf_dir).withColumn("f_score", metrics.f_score())


@query("o8_13_owner_earnings", "corp #fy #owner_earnings #growth_capex", "SELECT corp, fy, net_income + coalesce(da_total, 0) - least(abs(coalesce(capex, 0)), coalesce(da_total, 0)) AS owner_earnings, abs(coalesce(capex, 0)) - least(abs(coalesce(capex, 0)), coalesce(da_total, 0)) AS growth_capex FROM a", A)
def owner_earnings(spark, sf_dir):
    kept = F.least(F.abs(filled("capex")), filled("da_total"))
    return annual(spark, sf_dir).withColumns({"owner_earnings": metrics.owner_earnings(), "growth_capex": F.abs(filled("capex")) - kept})


_DEBT = "(abs(coalesce(short_term_debt, 0)) + abs(coalesce(long_term_debt, 0)))::DOUBLE"
_COST = f"greatest(0.02::DOUBLE, least(0.12::DOUBLE, CASE WHEN {_DEBT} > 0 THEN abs(coalesce(interest_expense, 0))::DOUBLE / {_DEBT} ELSE 0.045::DOUBLE END))"
_TAX = "CASE WHEN ebt > 0 AND tax_expense > 0 THEN least(tax_expense::DOUBLE / ebt, 0.35::DOUBLE) ELSE 0.22::DOUBLE END"
_WCAP = "coalesce(market_cap, 0)::DOUBLE"
SQL_WACC = f"""(CASE WHEN {_WCAP} > 0 AND {_DEBT} > 0 THEN {_WCAP} / ({_WCAP} + {_DEBT}) ELSE 0.85 END * (0.035::DOUBLE + 1.2::DOUBLE * 0.055::DOUBLE)
  + CASE WHEN {_WCAP} > 0 AND {_DEBT} > 0 THEN {_DEBT} / ({_WCAP} + {_DEBT}) ELSE 0.15 END * {_COST} * (1 - {_TAX}))"""


@query("o8_14_wacc", "corp #fy ~wacc", f"SELECT corp, fy, {SQL_WACC} AS wacc FROM a", A)
def wacc(spark, sf_dir):
    return annual(spark, sf_dir).withColumn("wacc", metrics.wacc(F.lit(1.2)))


def _newest_lists(df: DataFrame) -> DataFrame:
    history = F.reverse(F.array_sort(F.collect_list(F.struct("fy", "fcf", "cfo"))))
    newest = F.max_by(F.struct(*(c for c in df.columns if c != "corp")), "fy")
    return df.groupBy("corp").agg(history.alias("__h"), newest.alias("__n")).select("corp", "__n.*", F.col("__h.fcf").alias("fcfs"), F.col("__h.cfo").alias("cfos"))


_FCFG = """CASE WHEN f[6] > 0 AND f[1] > 0 THEN greatest(-0.1::DOUBLE, least(0.2::DOUBLE, pow(f[1]::DOUBLE / f[6], 1.0 / 5) - 1))
  WHEN f[4] > 0 AND f[1] > 0 THEN greatest(-0.1::DOUBLE, least(0.2::DOUBLE, pow(f[1]::DOUBLE / f[4], 1.0 / 3) - 1))
  WHEN c[1] <> 0 AND c[2] > 0 THEN greatest(-0.1::DOUBLE, least(0.1::DOUBLE, (c[1]::DOUBLE / c[2] - 1) * 0.5)) ELSE 0.05::DOUBLE END"""
_LISTS = f"{A}, l AS (SELECT corp, max_by(fy, fy) AS fy, list(fcf ORDER BY fy DESC) AS f, list(cfo ORDER BY fy DESC) AS c FROM a GROUP BY corp)"


@query("o8_15_fcf_growth", "corp ~fcf_growth", f"SELECT corp, {_FCFG} AS fcf_growth FROM l", _LISTS)
def fcf_growth(spark, sf_dir):
    return _newest_lists(annual(spark, sf_dir)).withColumn("fcf_growth", metrics.fcf_growth(F.col("fcfs"), F.col("cfos")))


@query(
    "o8_16_dcf",
    "corp #base #pv_sum #terminal_value",
    """SELECT corp, base, list_sum(list_transform(range(1, 11), lambda k: trunc(trunc(base * pow(1 + g, k)) / pow(1.09, k))))::BIGINT AS pv_sum,
         trunc(trunc(base * pow(1 + g, 10)) * 1.02::DOUBLE / (0.09::DOUBLE - 0.02::DOUBLE))::BIGINT AS terminal_value
       FROM (SELECT corp, fcf::DOUBLE AS base, round(g, 4) AS g FROM (SELECT corp, f[1] AS fcf, """ + _FCFG + """ AS g FROM l)) WHERE base > 0""",
    _LISTS,
)
def dcf(spark, sf_dir):
    rows = _newest_lists(annual(spark, sf_dir)).where("fcf > 0").withColumn("g", F.round(metrics.fcf_growth(F.col("fcfs"), F.col("cfos")), 4))
    parts = metrics.dcf(F.col("fcf").cast("double"), F.col("g"), F.lit(0.09))
    return rows.withColumns(parts).withColumn("base", F.col("fcf"))


@query("o6_37_quality_grade", "corp #fy #grade", "SELECT corp, fy, CASE WHEN total_assets <= 0 THEN 3 WHEN abs(total_assets - total_liabilities - total_equity) / total_assets::DOUBLE > 0.05 THEN 3 WHEN abs(total_assets - total_liabilities - total_equity) / total_assets::DOUBLE > 0.01 THEN 2 WHEN abs(revenue - cogs - gross_profit)::DOUBLE / nullif(abs(revenue), 0) > 0.05 THEN 2 ELSE 1 END AS grade FROM (SELECT * REPLACE (CASE WHEN n % 4 = 0 THEN total_equity - total_assets // 30 WHEN n % 7 = 0 THEN total_equity + total_assets // 10 ELSE total_equity END AS total_equity, CASE WHEN n % 5 = 0 THEN gross_profit // 2 ELSE gross_profit END AS gross_profit) FROM a)", A)
def quality_grade(spark, sf_dir):
    bent = annual(spark, sf_dir).withColumns({"total_equity": F.expr("CASE WHEN n % 4 = 0 THEN total_equity - total_assets div 30 WHEN n % 7 = 0 THEN total_equity + total_assets div 10 ELSE total_equity END"), "gross_profit": F.expr("CASE WHEN n % 5 = 0 THEN gross_profit div 2 ELSE gross_profit END")})
    return bent.withColumn("grade", metrics.quality_grade())


@query(
    "o8_05_window_aggregates",
    "corp #n_periods ~avg_roe ~yoy_revenue ~cagr_revenue %transition",
    f"""SELECT corp, least(count(*), 3) AS n_periods, avg(CASE WHEN r <= 3 THEN roe END) AS avg_roe, {grow('max(CASE WHEN r = 1 THEN revenue END)', 'max(CASE WHEN r = 2 THEN revenue END)')} AS yoy_revenue,
      CASE WHEN max(CASE WHEN r = 1 THEN revenue END) > 0 AND arg_max(revenue, r) FILTER (r BETWEEN 2 AND 3 AND revenue IS NOT NULL) > 0 THEN pow(max(CASE WHEN r = 1 THEN revenue END)::DOUBLE / arg_max(revenue, r) FILTER (r BETWEEN 2 AND 3 AND revenue IS NOT NULL), 1.0 / (max(CASE WHEN r BETWEEN 2 AND 3 AND revenue IS NOT NULL THEN r END) - 1)) - 1 END AS cagr_revenue,
      CASE WHEN max(CASE WHEN r = 2 THEN net_income END) < 0 AND max(CASE WHEN r = 1 THEN net_income END) >= 0 THEN 'turnaround' WHEN max(CASE WHEN r = 1 THEN net_income END) < 0 AND max(CASE WHEN r = 2 THEN net_income END) >= 0 THEN 'downturn' END AS transition
      FROM r GROUP BY corp""",
    f"{PAIRED.replace('FROM a)', 'FROM (SELECT * FROM a WHERE data_quality < 3 QUALIFY row_number() OVER (PARTITION BY corp ORDER BY fy DESC) <= 4))')}, r AS (SELECT *, row_number() OVER (PARTITION BY corp ORDER BY fy DESC) AS r FROM ({sql_ratios()}))",
)
def window_aggregates(spark, sf_dir):
    w = screen.with_ratios(screen.window_of(annual(spark, sf_dir), "corp", [F.col("fy").desc()], 3), ["corp"], [F.col("fy")])
    return w.groupBy("corp").agg(F.least(F.count(F.lit(1)), F.lit(3)).alias("n_periods"), screen.aggregated("roe", "average", 3).alias("avg_roe"), screen.aggregated("revenue", "yoy", 3).alias("yoy_revenue"), screen.aggregated("revenue", "cagr", 3).alias("cagr_revenue"), screen.transition("net_income", 3).alias("transition"))


_MULT = f"{PAIRED.replace('FROM a)', 'FROM (SELECT * FROM a WHERE data_quality < 3 QUALIFY row_number() OVER (PARTITION BY corp ORDER BY fy DESC) <= 2))')}"
_NEWEST = f"(SELECT * FROM ({sql_ratios()}) QUALIFY row_number() OVER (PARTITION BY corp ORDER BY fy DESC) = 1)"


@query(
    "o9_01_screen",
    "corp #fy ~op_margin ~roe ~per ~pbr #market_cap",
    f"SELECT *, {sql_multiples()} FROM {_NEWEST} WHERE gross_margin >= 0.3 AND debt_ratio < 1.0 ORDER BY roe DESC NULLS FIRST, corp LIMIT 40",
    _MULT,
)
def screen_query(spark, sf_dir):
    return screen.screen(annual(spark, sf_dir), "corp", {"gross_margin": ">= 30%", "debt_ratio": "< 1"}, "roe", limit=40)


_BASE = f"""b AS (SELECT x.*, n.market_cap, n.earnings_yield, n.return_on_capital, n.graham_number, n.peg, n.per, n.pbr FROM
  (SELECT corp, least(count(*), 3) AS n_periods, avg(CASE WHEN r <= 3 THEN op_margin END) AS op_margin, avg(CASE WHEN r <= 3 THEN roe END) AS roe, avg(CASE WHEN r <= 3 THEN debt_ratio END) AS debt_ratio FROM r GROUP BY corp) x
  JOIN (SELECT *, {sql_multiples()} FROM ({SQL_MASTERS.replace('FROM w', "FROM (SELECT *, row_number() OVER (PARTITION BY corp ORDER BY fy DESC) AS r FROM w)")}) WHERE r = 1) n USING (corp))"""
_RANKED = "m AS (SELECT *, rank() OVER (ORDER BY r1 + r2) AS magic_rank FROM (SELECT *, rank() OVER (ORDER BY earnings_yield DESC) AS r1, rank() OVER (ORDER BY return_on_capital DESC) AS r2 FROM b WHERE earnings_yield IS NOT NULL AND return_on_capital IS NOT NULL))"
_WINDOW3 = f"{PAIRED.replace('FROM a)', 'FROM (SELECT * FROM a WHERE data_quality < 3 QUALIFY row_number() OVER (PARTITION BY corp ORDER BY fy DESC) <= 4))')}, r AS (SELECT *, row_number() OVER (PARTITION BY corp ORDER BY fy DESC) AS r FROM ({sql_ratios()})), {_BASE}, {_RANKED}"


def _base(spark, sf_dir):
    return screen.base_frame(annual(spark, sf_dir), "corp", [F.col("fy").desc()], [F.col("fy")], 3, "average")


@query("o9_04_base_frame", "corp #n_periods ~op_margin ~roe ~debt_ratio ~per ~pbr ~earnings_yield ~return_on_capital #magic_rank", "SELECT b.*, m.magic_rank FROM b LEFT JOIN m USING (corp)", _WINDOW3)
def base_frame(spark, sf_dir):
    return _base(spark, sf_dir)


@query("o8_11_magic_rank", "corp #magic_rank ~earnings_yield ~return_on_capital", "SELECT * FROM m WHERE magic_rank <= 25", _WINDOW3)
def magic(spark, sf_dir):
    return _base(spark, sf_dir).where("magic_rank <= 25")


@query(
    "o9_05_quant_passes",
    "corp ~roe ~debt_ratio ~per",
    "SELECT * FROM (SELECT * FROM (SELECT * FROM b WHERE op_margin > -0.5 ORDER BY roe DESC NULLS LAST, corp LIMIT 60) WHERE debt_ratio < 0.9 ORDER BY debt_ratio ASC NULLS LAST, corp LIMIT 30) WHERE per IS NULL OR per <= 500 ORDER BY roe DESC NULLS LAST, corp LIMIT 20",
    _WINDOW3,
)
def quant(spark, sf_dir):
    stages = [screen.Pass({"op_margin": "> -50%"}, "roe", limit=60), screen.Pass({"debt_ratio": "< 0.9"}, "debt_ratio", True, 30), screen.Pass({"per": "<= 500"}, "roe", limit=20)]
    return screen.quant_passes(_base(spark, sf_dir), stages, ["corp"], include_missing=True)


@query(
    "o9_07_peer_medians",
    "sector corp #n_sector ~op_margin ~op_margin_median ~op_margin_percentile ~current_ratio ~current_ratio_median ~current_ratio_percentile",
    """SELECT sector, corp, n_sector, op_margin, CASE WHEN op_margin IS NOT NULL AND n1 >= 3 THEN m1 END AS op_margin_median,
        CASE WHEN op_margin IS NOT NULL AND n1 >= 3 THEN (SELECT count(*) FROM s y WHERE y.sector = s.sector AND y.op_margin < s.op_margin) * 100.0 / n1 END AS op_margin_percentile,
        current_ratio, CASE WHEN current_ratio IS NOT NULL AND n2 >= 3 THEN m2 END AS current_ratio_median,
        CASE WHEN current_ratio IS NOT NULL AND n2 >= 3 THEN (SELECT count(*) FROM s y WHERE y.sector = s.sector AND y.current_ratio < s.current_ratio) * 100.0 / n2 END AS current_ratio_percentile
      FROM s JOIN (SELECT sector, count(*) AS n_sector, median(op_margin) AS m1, count(op_margin) AS n1, median(current_ratio) AS m2, count(current_ratio) AS n2 FROM s GROUP BY sector) USING (sector) WHERE n_sector - 1 >= 3""",
    f"{PAIRED}, {SQL_SECTORS}, s AS (SELECT sector || ' ' || x.fy AS sector, x.* EXCLUDE (fy) FROM ({sql_ratios()}) x JOIN sectors USING (corp))",
)
def peers(spark, sf_dir):
    rows = _ratios(spark, sf_dir).join(sectors(spark, sf_dir), "corp").withColumn("sector", F.concat_ws(" ", "sector", F.col("fy").cast("string")))
    return aggregates.peer_medians(rows, "sector", "corp", ["op_margin", "current_ratio"])


@query("o8_06_turns", "corp #fy %turn", "SELECT corp, fy, CASE WHEN p_net_income < 0 AND net_income >= 0 THEN 'turnaround' ELSE 'downturn' END AS turn FROM w WHERE (p_net_income < 0 AND net_income >= 0) OR (net_income < 0 AND p_net_income >= 0)", PAIRED)
def turns(spark, sf_dir):
    return _ratios(spark, sf_dir).withColumn("turn", turn("net_income", "p_net_income")).where("turn IS NOT NULL")


@query("o5_12_streak", "corp #years", "SELECT corp, count(*) FILTER (broken = 0) AS years FROM (SELECT corp, sum(CASE WHEN net_income > 0 THEN 0 ELSE 1 END) OVER (PARTITION BY corp ORDER BY fy DESC ROWS UNBOUNDED PRECEDING) AS broken FROM a) GROUP BY corp", A)
def streak(spark, sf_dir):
    return windows.streak(annual(spark, sf_dir), ["corp"], [F.col("fy").desc()], F.col("net_income") > 0, "years")


@query("o5_14_ttm", "corp #fy #q #revenue #interest_expense #total_assets", "SELECT corp, fy, q, CASE WHEN count(*) OVER w = 4 THEN sum(revenue) OVER w END AS revenue, CASE WHEN count(*) OVER w = 4 THEN sum(interest_expense) OVER w END AS interest_expense, total_assets FROM qs WINDOW w AS (PARTITION BY corp ORDER BY fy, q ROWS 3 PRECEDING)", Q)
def ttm(spark, sf_dir):
    return windows.ttm(quarterly(spark, sf_dir), ["corp"], [F.col("fy"), F.col("q")], ["revenue", "interest_expense"])


@query("o5_03_spikes", "corp #fy #q #fcf %spike", "SELECT corp, fy, q, fcf, CASE WHEN abs(fcf) > 3.0 * l AND abs(fcf) > 3.0 * r THEN 'high' ELSE 'low' END AS spike FROM (SELECT *, abs(lag(fcf) OVER w) AS l, abs(lead(fcf) OVER w) AS r FROM qs WINDOW w AS (PARTITION BY corp ORDER BY fy * 10 + q)) WHERE abs(fcf) > 0 AND l > 0 AND r > 0 AND ((abs(fcf) > 3.0 * l AND abs(fcf) > 3.0 * r) OR (abs(fcf) * 3.0 < l AND abs(fcf) * 3.0 < r))", Q)
def spikes(spark, sf_dir):
    return windows.neighbour_spikes(quarterly(spark, sf_dir).withColumn("t", F.col("fy") * 10 + F.col("q")), ["corp"], "t", "fcf", 3.0)


@query("o3_08_year_before", "corp #fy #revenue #p_revenue ~growth", f"SELECT x.corp, x.fy, x.revenue, y.revenue AS p_revenue, {grow('x.revenue', 'y.revenue')} AS growth FROM h x LEFT JOIN h y ON x.corp = y.corp AND y.fy = x.fy - 1", f"{A}, h AS (SELECT * FROM a WHERE (fy + n) % 4 <> 0)")
def year_before(spark, sf_dir):
    holes = annual(spark, sf_dir).where("(fy + n) % 4 <> 0")
    return windows.with_year_before(holes, ["corp"], "fy", ["revenue"]).withColumn("growth", growth("revenue", "p_revenue"))


@query("o4_10_roic_spread", "corp ~mean ~deviation #n", f"SELECT corp, CASE WHEN count(roic) >= 2 THEN avg(roic) END AS mean, CASE WHEN count(roic) >= 2 THEN stddev_samp(roic) END AS deviation, count(roic) AS n FROM ({sql_ratios()}) GROUP BY corp", PAIRED)
def roic_spread(spark, sf_dir):
    return aggregates.mean_and_deviation(_ratios(spark, sf_dir), ["corp"], "roic")


@query("o8_03_cagr", "corp ~cagr", "SELECT corp, CASE WHEN arg_min(revenue, fy) > 0 AND arg_max(revenue, fy) > 0 AND max(fy) > min(fy) THEN pow(arg_max(revenue, fy)::DOUBLE / arg_min(revenue, fy), 1.0 / (max(fy) - min(fy))) - 1 END AS cagr FROM a GROUP BY corp", A)
def cagr_query(spark, sf_dir):
    return annual(spark, sf_dir).groupBy("corp").agg(F.min_by("revenue", "fy").alias("s"), F.max_by("revenue", "fy").alias("e"), (F.max("fy") - F.min("fy")).cast("double").alias("y")).withColumn("cagr", cagr("s", "e", F.col("y")))
