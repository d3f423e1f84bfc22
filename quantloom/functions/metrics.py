"""O8: ratios, multiples, scores and valuations as columns over a row and the row before it.

Builders take column names as they stand in the fundamentals frame; ``p_`` marks the previous
period's columns (attached by ``windows.with_previous``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantloom.functions.nullsafe import cagr, clamp, col, filled, first_nonzero, growth, mean_of, num, over_positive, safe_div, truncated

DEFAULT_TAX = 0.22
RISK_FREE, EQUITY_PREMIUM = 0.035, 0.055
DEBT_COST_RANGE, DEBT_COST_DEFAULT = (0.02, 0.12), 0.045
GROWTH_RANGE, CFO_GROWTH_CAP, GROWTH_DEFAULT = (-0.10, 0.20), 0.10, 0.05
DEFAULT_WEIGHTS = (0.85, 0.15)
F_SCORE_LEAST = 5


def ratios(prev: str = "p_") -> dict[str, Column]:
    """O8.4: 29 ratios. ``prev`` is the prefix of the previous period, "" for none."""
    before = (lambda c: F.col(prev + c)) if prev else (lambda c: F.lit(None).cast("double"))
    rate = F.when(num("ebt") > 0, safe_div("tax_expense", "ebt"))
    # A rate of 0 falls back like a missing one.
    nopat = F.when(F.col("operating_income").isNotNull(), truncated(num("operating_income") * (1 - first_nonzero(rate, F.lit(DEFAULT_TAX)))))
    invested = F.when(F.col("operating_income").isNotNull(), filled("total_equity") + filled("net_debt"))
    equity, assets = mean_of("total_equity", before("total_equity")), mean_of("total_assets", before("total_assets"))
    days = lambda part, whole: F.when(num(whole) != 0, filled(num(part)) * 365 / F.nullif(num(whole), F.lit(0.0)))
    dso, dio, dpo = days("receivables", "revenue"), days("inventory", "cogs"), days("trade_payables", "cogs")
    capex = F.abs(num("capex"))
    return {
        "gross_margin": safe_div("gross_profit", "revenue"),
        "op_margin": safe_div("operating_income", "revenue"),
        "net_margin": safe_div("net_income", "revenue"),
        "ebitda_margin": safe_div("ebitda", "revenue"),
        "roe": safe_div("net_income", equity),
        "roa": safe_div("net_income", assets),
        "asset_turnover": safe_div("revenue", assets),
        "effective_tax_rate": rate,
        "nopat": nopat,
        "invested_capital": invested,
        "roic": safe_div(nopat, invested),
        "debt_ratio": safe_div("total_liabilities", "total_equity"),
        "current_ratio": safe_div("current_assets", "current_liabilities"),
        "interest_coverage": safe_div("operating_income", F.abs(num("interest_expense"))),
        "net_debt_ebitda": over_positive("net_debt", "ebitda"),
        "capex_to_revenue": safe_div(capex, "revenue"),
        "capex_to_dep": safe_div(capex, "da_total"),
        "free_cash_flow": F.col("fcf"),
        "fcf_to_revenue": safe_div("fcf", "revenue"),
        "cfo_to_ni": safe_div("cfo", "net_income"),
        "accrual_ratio": safe_div(num("net_income") - num("cfo"), "total_assets"),
        "dso": dso,
        "dio": dio,
        "dpo": dpo,
        "ccc": dso + dio - dpo,
        "revenue_growth": growth("revenue", before("revenue")),
        "op_income_growth": growth("operating_income", before("operating_income")),
        "net_income_growth": growth("net_income", before("net_income")),
        "asset_growth": growth("total_assets", before("total_assets")),
    }


def screen_multiples(cap: str = "market_cap") -> dict[str, Column]:
    """O8.7: NULL unless the denominator is above 0 and the numerator is not 0. EV without a cap is the net debt."""
    ev = filled(num(cap)) + filled(num("net_debt"))
    over = lambda a, b: F.when((a.isNotNull()) & (a != 0), over_positive(a, b))
    return {
        "per": over(num(cap), "net_income"),
        "pbr": over(num(cap), "total_equity"),
        "ev_ebitda": over(ev, "ebitda"),
        "psr": over(num(cap), "revenue"),
        "pcr": over(num(cap), "cfo"),
    }


def company_multiples(cap: str = "market_cap") -> dict[str, Column]:
    """O8.8: controlling figures first, 0 falls through to the total; all NULL without a cap above 0."""
    c = F.when(num(cap) > 0, num(cap))
    ev = c + filled(num("net_debt"))
    live = F.when(ev != 0, ev)
    return {
        "ev": ev,
        "per": over_positive(c, first_nonzero("controlling_ni", "net_income")),
        "pbr": over_positive(c, first_nonzero("controlling_equity", "total_equity")),
        "psr": over_positive(c, "revenue"),
        "pcr": over_positive(c, "cfo"),
        "ev_ebitda": over_positive(live, "ebitda"),
        "ev_ebit": over_positive(live, "operating_income"),
        "ev_fcf": over_positive(live, "fcf"),
    }


def daily_multiples(cap: str = "market_cap") -> dict[str, Column]:
    """O8.9: the daily view coalesces, so a controlling figure of 0 stays 0 and gives NULL."""
    ni, eq = F.coalesce("controlling_ni", "net_income"), F.coalesce("controlling_equity", "total_equity")
    return {
        "per": over_positive(cap, ni),
        "pbr": over_positive(cap, eq),
        "psr": over_positive(cap, "revenue"),
        "ev_ebitda": over_positive(num(cap) + filled(num("net_debt")), "ebitda"),
        "eps": safe_div(ni, "shares_out"),
        "bps": safe_div(eq, "shares_out"),
        "dps": safe_div(F.abs(num("dividends_paid")), "shares_out"),
        "dividend_yield": safe_div(F.abs(num("dividends_paid")), cap),
    }


def masters(cap: str = "market_cap", price: str = "price", prev: str = "p_") -> dict[str, Column]:
    """O8.10: Graham, Greenblatt, Lynch, Fisher and DuPont figures."""
    ni, eq = first_nonzero("controlling_ni", "net_income"), first_nonzero("controlling_equity", "total_equity")
    shares = F.when(num("shares_out") != 0, num("shares_out"))
    live = lambda c: F.when(num(c) != 0, num(c))
    eps, bps = live(ni) / shares, live(eq) / shares
    graham = F.when((eps > 0) & (bps > 0), F.sqrt(22.5 * eps * bps))
    paid = F.when(num(price) > 0, num(price))
    ncav = (num("current_assets") - num("total_liabilities")) / shares
    cap_ = live(cap)
    ev = cap_ + filled(num("net_debt"))
    per, pbr = over_positive(cap_, ni), over_positive(cap_, eq)
    invested = num("current_assets") - num("current_liabilities") + num("ppe")
    ni_before = first_nonzero(prev + "controlling_ni", prev + "net_income")
    grown = F.when((num(ni) > 0) & (num(ni_before) > 0), (num(ni) - num(ni_before)) / F.nullif(num(ni_before), F.lit(0.0)))
    margin = over_positive("gross_profit", "revenue")
    margin_before = over_positive(prev + "gross_profit", prev + "revenue")
    total = F.coalesce(F.col("net_income"), ni)
    return {
        "eps": eps,
        "bps": bps,
        "graham_number": graham,
        "graham_upside": graham / paid - 1,
        "ncav_per_share": ncav,
        "ncav_to_price": ncav / paid,
        "per_pbr": F.when(eps.isNotNull() & bps.isNotNull(), per * pbr),
        "earnings_yield": over_positive("operating_income", ev),
        "return_on_capital": over_positive("operating_income", invested),
        "peg": F.when(eps.isNotNull() & (grown > 0), per / F.nullif(grown * 100, F.lit(0.0))),
        "gross_margin_delta": margin - margin_before,
        "dupont_roe": over_positive(total, "total_equity"),
        "dupont_net_margin": over_positive(total, "revenue"),
        "dupont_asset_turnover": over_positive(live("revenue"), "total_assets"),
        "dupont_leverage": over_positive(live("total_assets"), "total_equity"),
    }


def f_score(prev: str = "p_") -> Column:
    """O8.12: nine tests of 0 or 1, each only if computable; NULL with fewer than 5.

    The previous period's return on assets and turnover use its own assets, not an average.
    """
    before = lambda c: F.col(prev + c)
    assets = mean_of("total_assets", before("total_assets"))
    roa, roa_before = safe_div("net_income", assets), safe_div(before("net_income"), before("total_assets"))
    pairs = lambda a, b: (safe_div(a, b), safe_div(before(a), before(b)))
    debt, debt_before = pairs("total_liabilities", "total_equity")
    current, current_before = pairs("current_assets", "current_liabilities")
    gross, gross_before = pairs("gross_profit", "revenue")
    turnover, turnover_before = safe_div("revenue", assets), safe_div(before("revenue"), before("total_assets"))
    shares = F.col("shares_out") <= before("shares_out")
    tests = [roa > 0, num("cfo") > 0, num("cfo") > num("net_income"), roa > roa_before, debt < debt_before, current > current_before, shares, gross > gross_before, turnover > turnover_before]
    passed = sum((filled(t.cast("int")) for t in tests[1:]), filled(tests[0].cast("int")))
    known = sum((t.isNotNull().cast("int") for t in tests[1:]), tests[0].isNotNull().cast("int"))
    return F.when(known >= F_SCORE_LEAST, passed)


def owner_earnings() -> Column:
    """O8.13: earnings plus depreciation less the capex that only replaces it."""
    da = filled("da_total")
    return F.col("net_income") + da - F.least(F.abs(filled("capex")), da)


def wacc(beta: Column, cap: str = "market_cap", risk_free: float = RISK_FREE, premium: float = EQUITY_PREMIUM) -> Column:
    """O8.14."""
    debt = F.abs(filled(num("short_term_debt"))) + F.abs(filled(num("long_term_debt")))
    cost = clamp(F.when(debt > 0, F.abs(filled(num("interest_expense"))) / F.nullif(debt, F.lit(0.0))).otherwise(F.lit(DEBT_COST_DEFAULT)), *DEBT_COST_RANGE)
    tax = F.when((num("ebt") > 0) & (num("tax_expense") > 0), F.least(num("tax_expense") / F.nullif(num("ebt"), F.lit(0.0)), F.lit(0.35))).otherwise(F.lit(DEFAULT_TAX))
    own = filled(num(cap))
    both = F.nullif(own + debt, F.lit(0.0))
    weighed = (own > 0) & (debt > 0)
    equity_part = F.when(weighed, own / both).otherwise(F.lit(DEFAULT_WEIGHTS[0]))
    debt_part = F.when(weighed, debt / both).otherwise(F.lit(DEFAULT_WEIGHTS[1]))
    return equity_part * (F.lit(risk_free) + beta * premium) + debt_part * cost * (1 - tax)


def fcf_growth(fcf: Column, cfo: Column) -> Column:
    """O8.15: ``fcf`` and ``cfo`` are arrays, newest first. 5-year, else 3-year rate, else half of the growth of cfo, else 5 %."""
    at = lambda a, k: F.try_element_at(a, F.lit(k + 1))
    rate = lambda years: cagr(at(fcf, years), at(fcf, 0), years)
    now, before = num(at(cfo, 0)), num(at(cfo, 1))
    half = F.when((now != 0) & (before > 0), clamp((now / F.nullif(before, F.lit(0.0)) - 1) * 0.5, GROWTH_RANGE[0], CFO_GROWTH_CAP))
    return F.coalesce(clamp(rate(5), *GROWTH_RANGE), clamp(rate(3), *GROWTH_RANGE), half, F.lit(GROWTH_DEFAULT))


def dcf(base: Column, rate: Column, discount: Column, terminal: float = 0.02, years: int = 10) -> dict[str, Column]:
    """O8.16: whole-number cash flows and present values for each year, Gordon terminal value.

    A terminal growth that the discount rate doesn't exceed is lowered to 1 % below it.
    """
    ends = F.when(discount <= terminal, discount - 0.01).otherwise(F.lit(terminal))
    flow = lambda n: truncated(base * F.pow(1 + rate, n))
    years_ = F.sequence(F.lit(1), F.lit(years))
    present = F.aggregate(years_, F.lit(0).cast("long"), lambda acc, n: acc + truncated(flow(n) / F.pow(1 + discount, n)))
    last = truncated(flow(F.lit(years)) * (1 + ends) / F.nullif(discount - ends, F.lit(0.0)))
    return {"pv_sum": present, "terminal_value": last, "terminal_pv": truncated(last / F.pow(1 + discount, F.lit(years)))}


def sign_fixed_expense(expense: str, before: str, after: str) -> Column:
    """O6.32: a non-negative expense; whether it was stored with its sign is proved by before - expense = after."""
    e, b, a = num(expense), num(before), num(after)
    slack = F.greatest(F.lit(1000.0), F.abs(b) / 100000)
    plain, flipped = F.abs(b - e - a) <= slack, F.abs(b + e - a) <= slack
    return F.when(flipped & ~F.coalesce(plain, F.lit(False)), -col(expense)).when(~F.coalesce(plain, F.lit(False)) & (e < 0), -col(expense)).otherwise(col(expense))


def quality_grade() -> Column:
    """O6.37: 3 for assets at or below 0 or a balance gap over 5 %, 2 over 1 % or a gross profit gap over 5 % of revenue, else 1."""
    assets = num("total_assets")
    gap = F.when(assets > 0, F.abs(assets - num("total_liabilities") - num("total_equity")) / F.nullif(assets, F.lit(0.0)))
    profit_gap = safe_div(F.abs(num("revenue") - num("cogs") - num("gross_profit")), F.abs(num("revenue")))
    return F.when(assets <= 0, 3).when(gap > 0.05, 3).when(gap > 0.01, 2).when(profit_gap > 0.05, 2).otherwise(1)


def with_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.withColumns(columns)
