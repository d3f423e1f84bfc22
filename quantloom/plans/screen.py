"""O9.1-O9.5, O9.7, O9.18: screens. One lazy plan from statements to the ranked result."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantloom.functions import metrics
from quantloom.functions.nullsafe import cagr, growth, turn
from quantloom.operators.windows import Keys, ordered, top_n, ttm, with_previous

_CONDITION = re.compile(r"\s*(>=|<=|>|<|==|=)\s*(-?\d+(?:\.\d+)?)\s*(%?)\s*")
_OPS = {">=": "gte", "<=": "lte", ">": "gt", "<": "lt", "==": "eq", "=": "eq"}
WINDOW_METRICS = ("gross_margin", "op_margin", "net_margin", "roe", "roa", "roic", "debt_ratio", "current_ratio", "revenue_growth", "op_income_growth", "net_income_growth")
FLOWS = ("revenue", "cogs", "gross_profit", "operating_income", "ebt", "tax_expense", "net_income", "controlling_ni", "ebitda", "cfo", "capex", "fcf", "da_total", "interest_expense", "dividends_paid")


@dataclass(frozen=True)
class Condition:
    op: str
    value: float


def condition(text: str) -> Condition:
    """O2.3: 'op number %?'; a percentage is divided by 100."""
    m = _CONDITION.fullmatch(text)
    if not m:
        raise ValueError(f"not a condition: {text!r}; wanted an operator (>=, <=, >, <, =), a number and perhaps %")
    return Condition(_OPS[m[1]], float(m[2]) / (100 if m[3] else 1))


def holds(value: Column, c: Condition) -> Column:
    """O2.4: equality within 1e-9; NULL and NaN fail."""
    v = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    test = {"gt": v > c.value, "gte": v >= c.value, "lt": v < c.value, "lte": v <= c.value, "eq": F.abs(v - c.value) < 1e-9}[c.op]
    return F.coalesce(test, F.lit(False))


def passes(value: Column, c: Condition, include_missing: bool = False) -> Column:
    """O2.5: a missing value passes only this filter, and only if asked for."""
    v = value.cast("double")
    return F.when(v.isNull() | F.isnan(v), F.lit(include_missing)).otherwise(holds(value, c))


def threshold(shown: float, unit: str) -> float:
    """O2.10: what the user typed to the stored value: percent to fraction, hundred millions to raw."""
    return shown / 100 if unit == "pct" else shown * 1e8 if unit == "amount" else shown


def effective_unit(unit: str, method: str, fixed: bool = False) -> str:
    """O2.11: growth methods are percentages, multiples and ranks keep their unit."""
    return unit if fixed or method == "average" else "pct"


def shown(value: Column, unit: str, places: int = 1) -> Column:
    """O2.12: a dash for NULL, else scaled by unit."""
    scaled = {"pct": value * 100, "amount": value / 1e8}.get(unit, value)
    return F.when(value.isNull(), F.lit("-")).otherwise(F.format_number(scaled.cast("double"), places))


def with_ratios(rows: DataFrame, keys: Keys, newest_last: Sequence[Column]) -> DataFrame:
    """O8.4 on every row, with the row before by position."""
    used = ("revenue", "operating_income", "net_income", "controlling_ni", "total_assets", "total_equity", "gross_profit", "total_liabilities", "current_assets", "current_liabilities", "shares_out")
    paired = with_previous(rows, keys, newest_last, used)
    return paired.withColumns(metrics.ratios())


def window_of(rows: DataFrame, key: str, newest_first: Sequence[Column], n: int) -> DataFrame:
    """O9.2, O9.3, O2.2: usable rows (quality below 3), the newest ``n`` + 1 of each company, numbered from 1."""
    return top_n(rows.where(F.coalesce("data_quality", F.lit(1)) < 3), [key], newest_first, n + 1, rank="r")


def aggregated(metric: str, method: str, n: int, quarter: bool = False) -> Column:
    """O8.5 over rows numbered ``r`` from the newest."""
    step = per_year = 4 if quarter else 1
    at = lambda k: F.max(F.when(F.col("r") == k, F.col(metric)))
    if method == "average":
        return F.avg(F.when(F.col("r") <= n, F.col(metric)))
    if method == "yoy":
        return growth(at(1), F.when(F.lit(n > step), at(1 + step)))
    if method == "qoq":
        return growth(at(1), F.when(F.lit(n > 1), at(2)))
    if method == "cagr":
        old = F.col(metric).isNotNull() & (F.col("r") > 1) & (F.col("r") <= n)
        place = F.max(F.when(old, F.col("r")))
        return cagr(F.max_by(metric, F.when(old, F.col("r"))), at(1), (place - 1) / per_year)
    raise ValueError(f"unknown method {method!r}")


def transition(metric: str, n: int, step: int = 1) -> Column:
    """O8.6 for the compared periods."""
    at = lambda k: F.max(F.when((F.col("r") == k) & (F.lit(k) <= n), F.col(metric)))
    return turn(at(1), at(1 + step))


def base_frame(rows: DataFrame, key: str, newest_first: Sequence[Column], newest_last: Sequence[Column], n: int, method: str, wanted: Keys = WINDOW_METRICS, quarter: bool = False) -> DataFrame:
    """O9.4: one row per company: aggregated metrics, multiples and master figures of the newest row, magic rank.

    Two shuffles by company at most, and both have the same key: one for the window, reused by
    the aggregation.
    """
    window = with_ratios(window_of(rows, key, newest_first, n), [key], newest_last)
    if quarter:
        summed = ttm(window.select("*"), [key], newest_last, FLOWS)
        newest = summed.where("r = 1")
    else:
        newest = window.where("r = 1")
    figures = newest.select(key, "market_cap", *(c.alias(k) for k, c in metrics.screen_multiples().items()), *(c.alias(k) for k, c in metrics.masters().items() if k in ("earnings_yield", "return_on_capital", "graham_number", "peg")))
    table = window.groupBy(key).agg(F.least(F.count(F.lit(1)), F.lit(n)).cast("int").alias("n_periods"), *(aggregated(m, method, n, quarter).alias(m) for m in wanted), transition("net_income", n, 4 if quarter else 1).alias("ni_transition"))
    return magic_rank(table.join(figures, key))


def magic_rank(frame: DataFrame) -> DataFrame:
    """O8.11: rank by yield plus rank by return on capital, both needed, ranked again, smallest first.

    The frame has a row per company, of which any market has some thousands, so it is ordered as a
    whole, in one pass; for ranks over more rows than that there is ``windows.rank_min``.
    """
    both = F.col("earnings_yield").isNotNull() & F.col("return_on_capital").isNotNull()
    place = lambda c: F.when(both, F.rank().over(Window.orderBy(F.when(both, F.col(c)).desc_nulls_last())))
    summed = frame.withColumn("__sum", place("earnings_yield") + place("return_on_capital"))
    return summed.withColumn("magic_rank", F.when(F.col("__sum").isNotNull(), F.rank().over(Window.orderBy(F.col("__sum").asc_nulls_last())))).drop("__sum")


@dataclass(frozen=True)
class Pass:
    """One stage of a screen: filters, then sort, then limit (0: all)."""

    filters: dict[str, str]
    sort_by: str | None = None
    ascending: bool = False
    limit: int = 0


def quant_passes(frame: DataFrame, stages: Sequence[Pass], ties: Keys, include_missing: bool = False) -> DataFrame:
    """O9.5: filter, sort and limit, one stage after the other; a limit comes before the next filter."""
    out = frame
    for stage in stages:
        for metric, text in stage.filters.items():
            out = out.where(passes(F.col(metric), condition(text), include_missing))
        if stage.sort_by:
            out = ordered(out, stage.sort_by, not stage.ascending, ties=ties)
        if stage.limit:
            out = out.limit(stage.limit)
    return out


def screen(rows: DataFrame, key: str, filters: dict[str, str], sort_by: str, descending: bool = True, limit: int = 50, least_cap: float | None = None) -> DataFrame:
    """O9.1: ratios and multiples of each company's newest year, filtered, sorted as O5.17, cut."""
    newest = with_ratios(window_of(rows, key, [F.col("fy").desc()], 1), [key], [F.col("fy")]).where("r = 1").drop("r")
    frame = newest.withColumns({k: c for k, c in metrics.screen_multiples().items()})
    for metric, text in filters.items():
        frame = frame.where(holds(F.col(metric), condition(text)))
    if least_cap is not None:
        frame = frame.where(F.col("market_cap") >= least_cap)
    return ordered(frame, sort_by, descending, screen=True, ties=[key]).limit(limit)
