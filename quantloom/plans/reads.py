"""O3.16, O8.19, O8.24, O9.9, O9.10, O9.14, O9.22, O9.24: composed reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantloom.functions.nullsafe import growth, num, safe_div
from quantloom.operators.windows import Keys, over, period_rank, rank_min

DERIVED = ("ratio", "diff", "pershare", "yoy", "ttm")


def derived_series(rows: DataFrame, keys: Keys, order: list[Column], op: str, a: str, b: str | None = None, quarter: bool = False, name: str = "value") -> DataFrame:
    """O8.19, D21: {op, a, b} over a company's rows; a message for what can't be."""
    if op not in DERIVED:
        raise ValueError(f"unknown operation {op!r}; wanted one of {', '.join(DERIVED)}")
    if op in ("ratio", "diff") and b is None:
        raise ValueError(f"{op} needs two series")
    w = over(keys, *order)
    last4 = w.rowsBetween(-3, 0)
    value = {
        "ratio": lambda: safe_div(a, b),
        "diff": lambda: num(a) - num(b),
        "pershare": lambda: safe_div(a, "shares_out"),
        "yoy": lambda: growth(a, F.lag(a, 4 if quarter else 1).over(w)),
        "ttm": lambda: F.when(F.count(F.lit(1)).over(last4) == 4, F.sum(a).over(last4)).cast("double"),
    }[op]()
    return rows.withColumn(name, value)


def comparison(rows: DataFrame, key: str, metrics: dict[str, bool], within: Keys = ()) -> DataFrame:
    """O8.24: companies side by side, each group of ``within`` on its own: (within, metric, key, value, place, best); ``metrics``: whether more is better."""
    long = rows.unpivot([*within, key], list(metrics), "metric", "value")
    more = F.col("metric").isin([m for m, up in metrics.items() if up])
    signed = long.withColumn("__s", F.when(more, F.col("value")).otherwise(-F.col("value")))
    return rank_min(signed, "__s", "place", [*within, "metric"]).withColumn("best", F.col("place") == 1).drop("__s")


def missing_sections(rows: DataFrame, keys: Keys, sibling: str, section: str) -> DataFrame:
    """O3.16: (keys, sibling, section) that another sibling of the keys has and this one lacks."""
    have = rows.select(*keys, sibling, section).distinct()
    wanted = have.select(*keys, sibling).distinct().join(have.select(*keys, section).distinct(), list(keys))
    return wanted.join(have, [*keys, sibling, section], "left_anti")


def composition(rows: DataFrame, keys: Keys, order: list[Column], segment: str, value: str) -> DataFrame:
    """O9.9: newest row of each segment, and its share of the sum, times 100."""
    newest = rows.withColumn("__r", F.row_number().over(over([*keys, segment], *order))).where("__r = 1").drop("__r")
    total = newest.groupBy(*keys).agg(F.sum(value).alias("__t"))
    return newest.join(total, list(keys)).withColumn("share", safe_div(value, "__t") * 100).drop("__t")


def amendment_summary(filings: DataFrame, stored: DataFrame, keys: Keys) -> DataFrame:
    """O9.10: periods with amendments, and whether the stored row's sources name the newest one."""
    amended = filings.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_filings"), F.max("rcept").alias("newest")).where(F.col("n_filings") > 1)
    used = stored.select(*keys, F.explode("sources").alias("statement", "newest")).select(*keys, "newest").distinct().withColumn("reflected", F.lit(True))
    return amended.join(used, [*keys, "newest"], "left").withColumn("reflected", F.coalesce("reflected", F.lit(False)))


def debt_null_classes(rows: DataFrame, lines: DataFrame, keys: Keys) -> DataFrame:
    """O9.14: why net debt is NULL: named debt lines with values, named lines that are 0 or blank, or none."""
    named = lines.where(F.col("label").rlike("(?i)borrow|bond|debt|loan"))
    seen = named.groupBy(*keys).agg(F.bool_or(F.coalesce(F.col("value"), F.lit(0)) != 0).alias("__valued"))
    out = rows.where(F.col("net_debt").isNull()).join(seen, list(keys), "left")
    return out.groupBy(F.when(F.col("__valued"), "line with value").when(F.col("__valued").isNotNull(), "line without value").otherwise("no line").alias("class")).agg(F.count(F.lit(1)).alias("n"))


def report_list(filings: DataFrame, files: DataFrame, limit: int = 100) -> DataFrame:
    """O9.22: final periodic filings with their file, year DESC NULLS LAST, then FY, Q3, H1, Q1."""
    return filings.where("is_final").join(files, "rcept", "left").orderBy(F.col("fy").desc_nulls_last(), period_rank("period", ("FY", "Q3", "H1", "Q1")), "rcept").limit(limit)


def share_delta(added: list[str], removed: list[str]) -> Column:
    """O9.24: signed sum of the fields that are there; NULL if none is."""
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in added), F.lit(0)) - sum((F.coalesce(F.col(c), F.lit(0)) for c in removed), F.lit(0))
    return F.when(F.coalesce(*added, *removed).isNotNull(), total)


def sector_key(code: Column) -> Column:
    """O8.23: the first two characters of an industry code."""
    return F.substring(code, 1, 2)


def is_finance(code: Column) -> Column:
    return sector_key(code).isin("64", "65", "66")


#: O8.25: what a printed unit is multiplied by.
SCALES = {"percent": 0.01, "million": 1e6, "thousand": 1e3, "plain": 1.0}


def extended_frame(facts: DataFrame, keys: Keys, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """O8.25: extended facts (keys, code, value) as one row a key; ``columns``: name -> (code, unit), scaled to plain numbers."""
    return facts.groupBy(*keys).agg(*(F.max(F.when(F.col("code") == code, num("value") * SCALES[unit])).alias(name) for name, (code, unit) in columns.items()))


def dividend_frame(facts: DataFrame, keys: Keys) -> DataFrame:
    """O8.25: dividends a share and in all, payout and yield as fractions, and the payout that follows from the total where none is printed."""
    wide = extended_frame(facts, keys, {"dps": ("dps", "plain"), "dividends": ("dividends", "million"), "payout": ("payout", "percent"), "dividend_yield": ("yield", "percent"), "net_income": ("net_income", "million")})
    return wide.withColumn("payout", F.coalesce("payout", F.when(F.col("net_income") > 0, safe_div("dividends", "net_income")))).drop("net_income")
