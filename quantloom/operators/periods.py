"""O7: fiscal and calendar periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantloom.functions.nullsafe import col, growth
from quantloom.operators.windows import Keys, over

#: Which cumulative period a quarter is, and which it is the difference to.
STEPS = {1: ("Q1", None), 2: ("H1", "Q1"), 3: ("Q3", "H1"), 4: ("FY", "Q3")}


def discrete_quarters(df: DataFrame, keys: Keys, year: str, period: str, flows: Keys, stocks: Keys, quality: str) -> DataFrame:
    """O7.1: single quarters from cumulative periods, by one pivot: rows are aggregated, not joined.

    A quarter needs its own row and the one it is the difference to; a flow is NULL if either
    value is; stocks are those at the end. Rows without any flow go. Quality is 2 at least if a
    flow that is there at the end is lost.
    """
    values = [*flows, *stocks, quality]
    at = lambda p: F.max_by(F.struct(F.lit(True).alias("has"), *values), F.when(F.col(period) == p, F.lit(1)))
    wide = df.groupBy(*keys, year).agg(*(at(p).alias(f"__{p}") for p, _ in STEPS.values()))
    parts = []
    for q, (end, before) in STEPS.items():
        e = F.col(f"__{end}")
        b = F.col(f"__{before}") if before else None
        flow = {f: e[f] if b is None else e[f] - b[f] for f in flows}
        lost = F.lit(False) if b is None else F.greatest(*(e[f].isNotNull() & b[f].isNull() for f in flows), F.lit(False))
        whole = e["has"].isNotNull() if b is None else e["has"].isNotNull() & b["has"].isNotNull()
        any_flow = F.coalesce(*(v.isNotNull().cast("int") * F.when(v.isNotNull(), 1) for v in flow.values())).isNotNull()
        worst = e[quality] if b is None else F.greatest(e[quality], b[quality])
        row = F.struct(F.lit(q).alias("quarter"), *(v.alias(f) for f, v in flow.items()), *(e[s].alias(s) for s in stocks), F.when(lost, F.greatest(worst, F.lit(2))).otherwise(worst).alias(quality))
        parts.append(F.when(whole & any_flow, row))
    return wide.select(*keys, year, F.explode(F.array_compact(F.array(*parts))).alias("r")).select(*keys, year, "r.*")


def calendar_quarter(period_end: Column | str) -> Column:
    """O7.2: CQ1 to CQ4 for ends in month 3, 6, 9 or 12; NULL for other months."""
    m = F.month(col(period_end))
    return F.when(m % 3 == 0, F.concat(F.lit("CQ"), (m / 3).cast("int").cast("string")))


def calendar_quarters(df: DataFrame, keys: Keys, period_end: str, year: str, quarter: str, today: Column) -> DataFrame:
    """O7.2, R5: quarters by calendar slot; other months and future ends go; the last (year, quarter) wins a slot."""
    slotted = df.withColumns({"cq": calendar_quarter(period_end), "cy": F.year(period_end)}).where(F.col("cq").isNotNull() & (F.col(period_end) <= today))
    w = over([*keys, "cy", "cq"], F.col(year).desc(), F.col(quarter).desc())
    return slotted.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def calendar_years(quarters: DataFrame, keys: Keys, flows: Keys, stocks: Keys, quality: str, fiscal_month: str | None = None) -> DataFrame:
    """O7.3, O7.4: years that have all four quarters. A flow is the sum if no quarter is NULL; stocks are CQ4's; quality the worst."""
    all_four = F.count_distinct("cq") == 4
    out = quarters.groupBy(*keys, "cy").agg(
        all_four.alias("__all"),
        *(F.when(F.count(f) == 4, F.sum(f)).alias(f) for f in flows),
        *(F.max_by(s, F.when(F.col("cq") == "CQ4", F.lit(1))).alias(s) for s in stocks),
        F.max(quality).alias(quality),
        *([F.when(F.min(fiscal_month).eqNullSafe(F.lit(12)) & (F.max(fiscal_month) == 12), "native").otherwise("derived").alias("derivation")] if fiscal_month else []),
    )
    return out.where("__all").drop("__all")


def period_changes(df: DataFrame, keys: Keys, year: str, quarter: str, values: Keys) -> DataFrame:
    """O7.6: against the quarter before and the same quarter of the year before, by calendar key."""
    index = (F.col(year) * 4 + F.col(quarter)).alias("__i")
    base = df.withColumn("__i", index)
    back = lambda n, p: base.select(*keys, (F.col("__i") + n).alias("__i"), *(F.col(v).alias(f"{p}_{v}") for v in values))
    out = base.join(back(1, "q"), [*keys, "__i"], "left").join(back(4, "y"), [*keys, "__i"], "left")
    return out.select(*df.columns, *(c for v in values for c in ((F.col(v) - F.col(f"q_{v}")).alias(f"{v}_qoq_diff"), growth(v, f"q_{v}").alias(f"{v}_qoq"), (F.col(v) - F.col(f"y_{v}")).alias(f"{v}_yoy_diff"), growth(v, f"y_{v}").alias(f"{v}_yoy"))))


def missing_periods(companies: DataFrame, have: DataFrame, key: str, period_end: str, today: Column, first_year: int, last_year: int, lag_days: int = 15) -> DataFrame:
    """O7.7: the latest quarter end whose deadline (45 days, 90 at the year's end) and ``lag_days`` have passed, where a company lacks it."""
    spark = companies.sparkSession
    ends = spark.range(first_year, last_year + 1).select(F.explode(F.array(*(F.last_day(F.make_date(F.col("id").cast("int"), F.lit(m), F.lit(1))) for m in (3, 6, 9, 12)))).alias("due_end"))
    due = ends.where(F.date_add("due_end", F.when(F.month("due_end") == 12, 90).otherwise(45) + lag_days) < today).agg(F.max("due_end").alias("due_end"))
    # One row: the latest due period end.
    wanted = companies.select(key).crossJoin(F.broadcast(due))
    return wanted.join(have.select(key, F.col(period_end).alias("due_end")).distinct(), [key, "due_end"], "left_anti")


def trading_days(days: DataFrame, day: str, holidays: DataFrame) -> DataFrame:
    """O7.8: whether a day is neither a weekend nor a holiday; an empty calendar leaves weekdays open."""
    closed = holidays.select(F.col(holidays.columns[0]).alias("__h")).distinct()
    out = days.join(closed, F.col(day) == F.col("__h"), "left")
    return out.withColumn("is_open", F.col("__h").isNull() & (F.weekday(F.col(day).cast("date")) < 5)).drop("__h")


def rebalance_day(year: Column | str) -> Column:
    """O7.9: the first of May of the next year."""
    return F.make_date((col(year) + 1).cast("int"), F.lit(5), F.lit(1))


def printed_date(text: Column | str) -> Column:
    """O7.10: yyyy.mm.dd from 'yyyy년 m월 d일', 'yyyy-m-d', 'yyyy.m.d', 'yyyy/m/d' or 'yyyymmdd'; else NULL."""
    t = col(text)
    spaced = r"(\d{4})\s*[년./-]\s*(\d{1,2})\s*[월./-]\s*(\d{1,2})"
    solid = r"(?<!\d)(\d{4})(\d{2})(\d{2})(?!\d)"
    joined = lambda p: F.concat_ws(".", F.regexp_extract(t, p, 1), F.lpad(F.regexp_extract(t, p, 2), 2, "0"), F.lpad(F.regexp_extract(t, p, 3), 2, "0"))
    return F.when(t.rlike(spaced), joined(spaced)).when(t.rlike(solid), joined(solid))


def tenure_years(text: Column | str) -> Column:
    """O7.11: a plain number of years, or N years and M months (as M / 12), to two places; else NULL."""
    t = F.trim(col(text))
    years, months = F.regexp_extract(t, r"(\d+)\s*(?:년|years?)", 1), F.regexp_extract(t, r"(\d+)\s*(?:개월|월|months?)", 1)
    some = (years != "") | (months != "")
    n = lambda c: F.coalesce(F.try_to_number(F.nullif(c, F.lit("")), F.lit("999999")).cast("double"), F.lit(0.0))
    return F.when(t.rlike(r"^\d+(\.\d+)?$"), F.round(t.try_cast("double"), 2)).when(some, F.round(n(years) + n(months) / 12, 2))


def available(filings: DataFrame, keys: Keys, filed: str, as_of: Column) -> DataFrame:
    """O7.12: when each (company, period) could first be known, for those known at ``as_of``."""
    return filings.groupBy(*keys).agg(F.min(filed).alias("available_at")).where(F.col("available_at") <= as_of)


def fiscal_position(close_year: Column, close_month: Column, fiscal_month: Column) -> tuple[Column, Column]:
    """O6.42: (fiscal year, period) of a closing month, given the month the fiscal year ends in."""
    into = F.pmod(close_month - fiscal_month, F.lit(12))
    year = F.when(close_month > fiscal_month, close_year + 1).otherwise(close_year)
    period = F.when(into == 0, "FY").when(into == 3, "Q1").when(into == 6, "H1").when(into == 9, "Q3")
    return year, period


def period_end(filed_end: Column, fiscal_year: Column, period: Column, fiscal_month: Column) -> Column:
    """O6.39: the filing's own date, else the month's end counted back from the fiscal year's end, else NULL."""
    back = F.when(period == "FY", 0).when(period == "Q3", 3).when(period == "H1", 6).when(period == "Q1", 9)
    end = F.last_day(F.add_months(F.make_date(fiscal_year.cast("int"), fiscal_month.cast("int"), F.lit(1)), -back))
    return F.coalesce(filed_end, end)
