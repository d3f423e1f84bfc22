"""O4: aggregations. All reduce map-side; none gathers a group's rows into one list unless the list is the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantloom.functions.nullsafe import num, safe_div
from quantloom.operators.windows import Keys, over

BAND_POINTS = {"p10": 0.10, "p25": 0.25, "median": 0.50, "p75": 0.75, "p90": 0.90}


def bands(df: DataFrame, keys: Keys, day: str, value: str) -> DataFrame:
    """O4.3, O4.4, O4.6, O9.8: exact percentiles with linear interpolation, extremes, the newest value and its strict rank."""
    v = num(value)
    known = df.where(v.isNotNull()).withColumn("__v", v)
    stats = known.groupBy(*keys).agg(F.min("__v").alias("min"), *(F.percentile("__v", p).alias(n) for n, p in BAND_POINTS.items()), F.max("__v").alias("max"), F.max_by("__v", F.struct(day, "__v")).alias("current"), F.count("__v").alias("n"))
    below = strict_percentile(known.join(stats.select(*keys, "current"), list(keys)), keys, "__v", F.col("current"))
    return stats.join(below, list(keys))


def strict_percentile(df: DataFrame, keys: Keys, value: str, target: Column, name: str = "percentile") -> DataFrame:
    """O4.5: share of values strictly below the target, times 100 (not percent_rank, which divides by n - 1)."""
    return df.groupBy(*keys).agg(F.avg(F.when(F.col(value) < target, 100.0).otherwise(0.0)).alias(name))


def peer_medians(df: DataFrame, sector: str, key: str, metrics: Keys, least: int = 3) -> DataFrame:
    """O4.7, O9.7: each row against its sector: median and strict percentile by metric.

    A sector needs ``least`` companies besides the target; a metric with fewer than ``least``
    values, or a NULL target, has no median.
    """
    # All three windows have the sector as key: one shuffle.
    whole = Window.partitionBy(sector)
    out = df.select(sector, key, *metrics).withColumns({"n_sector": F.count(F.lit(1)).over(whole)} | {f"__m_{m}": F.median(m).over(whole) for m in metrics} | {f"__n_{m}": F.count(m).over(whole) for m in metrics})
    out = out.where(F.col("n_sector") - 1 >= least)
    ok = lambda m: F.col(m).isNotNull() & (F.col(f"__n_{m}") >= least)
    below = lambda m: (F.rank().over(over([sector], F.col(m).asc_nulls_last())) - 1) * 100.0 / F.nullif(F.col(f"__n_{m}"), F.lit(0))
    return out.select(sector, key, "n_sector", *(c for m in metrics for c in (F.col(m), F.when(ok(m), F.col(f"__m_{m}")).alias(f"{m}_median"), F.when(ok(m), below(m)).alias(f"{m}_percentile"))))


def beta(stock: DataFrame, index: DataFrame, keys: Keys, day: str, price: str, least: int = 60, low: float = 0.3, high: float = 3.0, default: float = 1.0) -> DataFrame:
    """O4.11, O3.20: covariance of daily returns over common days by the index's variance, clamped; ``default`` below ``least`` days."""
    common = stock.select(*keys, day, num(price).alias("__s")).join(index.select(day, num(price).alias("__i")), day)
    w = over(keys, day)
    change = lambda c: F.try_divide(F.col(c), F.lag(c).over(w)) - 1
    moves = common.withColumns({"__rs": change("__s"), "__ri": change("__i")})
    raw = F.try_divide(F.covar_samp("__rs", "__ri"), F.var_samp(F.when(F.col("__rs").isNotNull(), F.col("__ri"))))
    out = moves.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_days"), raw.alias("__b"))
    return out.select(*keys, "n_days", F.when((F.col("n_days") < least) | F.col("__b").isNull(), F.lit(default)).otherwise(F.greatest(F.lit(low), F.least(F.lit(high), F.col("__b")))).alias("beta"))


def weekly(df: DataFrame, keys: Keys, day: str, o: str, h: str, lo: str, c: str, v: str, above: int = 1500) -> DataFrame:
    """O4.22: first, max, min, last and sum per week that ends on Sunday; weeks without a close go.

    Keys with ``above`` rows or fewer stay daily (their rows keep their own day).
    """
    sized = df.join(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")), list(keys))
    date = F.col(day).cast("date")
    bucket = F.when(F.col("__n") > above, F.next_day(F.date_sub(date, 1), "Sun")).otherwise(date)
    first = lambda x: F.min_by(x, F.when(F.col(x).isNotNull(), F.col(day)))
    last = lambda x: F.max_by(x, F.when(F.col(x).isNotNull(), F.col(day)))
    return sized.withColumn("bucket", bucket).groupBy(*keys, "bucket").agg(first(o).alias("open"), F.max(h).alias("high"), F.min(lo).alias("low"), last(c).alias("close"), F.sum(v).alias("volume")).where(F.col("close").isNotNull())


def yearly_total(df: DataFrame, keys: Keys, year: str, value: str, unit: str, least_years: int = 2) -> DataFrame:
    """O4.12: totals by year; the unit only if it is single; keys with fewer than ``least_years`` years go."""
    out = df.groupBy(*keys, year).agg(F.sum(value).alias("total"), F.when(F.count_distinct(unit) == 1, F.max(unit)).alias("unit"))
    years = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return out.withColumn("__years", years).where(F.col("__years") >= least_years).drop("__years")


def part_of_total(df: DataFrame, keys: Keys, kind: str, part: str, whole: Keys, value: str) -> DataFrame:
    """O4.13: the share of one kind in the sum over ``whole`` kinds, times 100."""
    return df.groupBy(*keys).agg((safe_div(F.sum(F.when(F.col(kind) == part, F.col(value))), F.sum(F.when(F.col(kind).isin(*whole), F.col(value)))) * 100).alias("share"))


def best_table(df: DataFrame, keys: Keys, table: str, item: str) -> DataFrame:
    """O4.14: per key the table with most distinct items; the first by number if several have as many."""
    counted = df.groupBy(*keys, table).agg(F.count_distinct(item).alias("n_items"))
    return counted.groupBy(*keys).agg(F.max_by(F.struct(table, "n_items"), F.struct("n_items", -F.col(table))).alias("b")).select(*keys, "b.*")


def dilution(df: DataFrame, keys: Keys, year: str, kind: str, delta: str, issued: Keys) -> DataFrame:
    """O4.15: issued and potential shares by year, how many events and of what kinds."""
    return df.groupBy(*keys, year).agg(
        F.sum(F.when(F.col(kind).isin(*issued), F.col(delta)).otherwise(0)).alias("issued"),
        F.sum(F.when(F.col(kind).isin(*issued), 0).otherwise(F.col(delta))).alias("potential"),
        F.count(F.lit(1)).alias("n_events"),
        F.array_join(F.array_sort(F.collect_set(kind)), ",").alias("kinds"),
    )


def potential_dilution(df: DataFrame, keys: Keys, day: str, delta: str, shares: Column, since: Column) -> DataFrame:
    """O4.16: potential shares since a day by current shares, times 100; NULL without an event."""
    seen = F.col(day) >= since
    return df.groupBy(*keys).agg((F.when(F.count_if(seen) > 0, safe_div(F.sum(F.when(seen, F.col(delta))), F.max(shares))) * 100).alias("potential_pct"))


def content_hash(df: DataFrame, keys: Keys, line: Column, name: str = "content_hash") -> DataFrame:
    """O4.17-O4.19, O10.28: md5 over a key's lines in sorted order. NULL lines are left out."""
    return df.groupBy(*keys).agg(F.md5(F.array_join(F.array_sort(F.collect_list(line)), "\n")).alias(name), F.count(F.lit(1)).alias("n_lines"))


def largest_abs(df: DataFrame, keys: Keys, value: str) -> DataFrame:
    """O4.24: the signed value with the largest size, the positive one of two."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(F.abs(num(value)), value)).alias("value"))


def same_sign_sum(df: DataFrame, keys: Keys, value: str) -> DataFrame:
    """O4.25: repeats of a contra line are summed unless their signs are mixed; then NULL."""
    return df.groupBy(*keys).agg(F.when(F.min(F.sign(value)) * F.max(F.sign(value)) >= 0, F.sum(value)).alias("value"), F.count(F.lit(1)).alias("n"))


def mean_and_deviation(df: DataFrame, keys: Keys, value: str, least: int = 2) -> DataFrame:
    """O4.9, O4.10: mean and sample deviation of at least ``least`` values that are not NULL."""
    enough = F.count(value) >= least
    return df.groupBy(*keys).agg(F.when(enough, F.avg(value)).alias("mean"), F.when(enough, F.stddev_samp(value)).alias("deviation"), F.count(value).alias("n"))


def percentiles(df: DataFrame, keys: Keys, value: str, points: dict[str, float]) -> DataFrame:
    """O4.3, O4.4: exact percentiles with linear interpolation; 0.5 is the median."""
    return df.groupBy(*keys).agg(*(F.percentile(num(value), p).alias(n) for n, p in points.items()), F.count(value).alias("n"))


def ordered_ids(df: DataFrame, keys: Keys, item: str, order: str, name: str = "ids") -> DataFrame:
    """O4.17: a key's items in order, ties by the item itself; NULL items are left out."""
    pairs = F.array_sort(F.collect_list(F.when(F.col(item).isNotNull(), F.struct(order, item))))
    return df.groupBy(*keys).agg(F.transform(pairs, lambda p: p[item]).alias(name))
