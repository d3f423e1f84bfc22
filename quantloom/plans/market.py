"""O9.6, O9.11-O9.13, O9.15, O9.17: plans over daily prices and listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantloom.functions.nullsafe import num, safe_div
from quantloom.operators.joins import asof_within, snapshot, step_value
from quantloom.operators.periods import rebalance_day
from quantloom.operators.windows import Keys, median_of_three, over, top_n
from quantloom.plans.fundamentals import read


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in daily series: code, day, close, raw, volume, listed. A supplier is a stock."""
    cents = lambda e: F.floor(e * 100).cast("long")
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("code"), F.col("l_shipdate").cast("date").alias("day"), "l_extendedprice", "l_discount", "l_quantity")
    return lines.groupBy("code", "day").agg(
        F.expr("sum(cast(floor(l_extendedprice * 100) as long)) div count(*)").alias("close"),
        F.sum(cents(F.col("l_extendedprice") * (1 - F.col("l_discount")))).alias("__raw"),
        F.sum(F.floor("l_quantity").cast("long")).alias("volume"),
        F.count(F.lit(1)).alias("__n"),
    ).select("code", "day", "close", F.expr("__raw div __n").alias("raw"), "volume", F.expr("CASE WHEN volume % 3 = 0 THEN volume * 100 END").alias("listed"))


SQL_PRICES = """p AS (SELECT l_suppkey AS code, l_shipdate::DATE AS day, (sum(floor(l_extendedprice * 100)::BIGINT) // count(*))::BIGINT AS close, (sum(floor(l_extendedprice * (1 - l_discount) * 100)::BIGINT) // count(*))::BIGINT AS raw,
  sum(floor(l_quantity)::BIGINT)::BIGINT AS volume, CASE WHEN sum(floor(l_quantity)::BIGINT) % 3 = 0 THEN (sum(floor(l_quantity)::BIGINT) * 100)::BIGINT END AS listed FROM lineitem GROUP BY ALL)"""


def clean_quotes(quotes: DataFrame) -> DataFrame:
    """O1.4: rows with a close at or below 0 go; open, high and low of 0 are NULL; volume 0 stays."""
    return quotes.where(F.col("close") > 0).withColumns({c: F.when(F.col(c) != 0, F.col(c)) for c in ("open", "high", "low")})


def market_cap(days: DataFrame, floats: DataFrame, key: str = "code", carry_days: int = 30) -> DataFrame:
    """O9.11: raw close x round(listed shares x float ratio).

    Missing listed shares are carried for ``carry_days``; the float ratio is a step function
    whose first step reaches back; without one it is 1.
    """
    known = days.where(F.col("listed").isNotNull()).select(key, F.col("day").alias("listed_day"), F.col("listed").alias("carried"))
    out = asof_within(days, known, [key], "day", "listed_day", ["carried"], carry_days)
    out = step_value(out, floats, [key], "day", "from_day", ["ratio"])
    shares = F.coalesce("listed", "carried")
    return out.withColumn("market_cap", F.col("raw") * F.bround(shares * F.coalesce("ratio", F.lit(1.0))).cast("long")).drop("listed_day", "valid_from")


def price_breaks(days: DataFrame, key: str = "code", limit: float = 0.305) -> DataFrame:
    """O9.15: moves over the daily limit, with what the raw price says about them."""
    w = over([key], "day")
    moved = days.withColumns({"before": F.lag("close").over(w), "raw_before": F.lag("raw").over(w)}).where((F.col("before") > 0) & (F.col("raw_before") > 0))
    jump = num("close") / F.nullif(num("before"), F.lit(0.0)) - 1
    raw_jump = num("raw") / F.nullif(num("raw_before"), F.lit(0.0)) - 1
    kind = F.when(F.abs(raw_jump) <= limit, "adjustment").when(F.sign(raw_jump) == F.sign(jump), "real").otherwise("mixed")
    return moved.withColumns({"jump": jump, "kind": kind}).where(F.abs("jump") > limit)


def back_test(selected: DataFrame, universe: DataFrame, quotes: DataFrame, years: Sequence[int], horizons: Sequence[int] = (1, 3, 5)) -> DataFrame:
    """O9.6: cohorts of (year, code), as-of prices on the first of May of the next year, forward returns against the universe.

    Price return only, and companies without a later price drop out of a horizon, as in the
    original (R14). The as-of prices are one aggregation per target day over 20 days of quotes:
    target days are exploded onto quotes, at most years x (1 + horizons) days.
    """
    spark = quotes.sparkSession
    targets = spark.range(min(years), max(years) + 1).where(F.col("id").isin(*years)).select(F.col("id").cast("int").alias("year"), F.explode(F.array(*map(F.lit, (0, *horizons)))).alias("horizon")).withColumn("target", F.add_months(rebalance_day("year"), F.col("horizon") * 12))
    # A row per cohort and horizon: bounded by the years asked for.
    days = F.broadcast(targets)
    seen = quotes.where(F.col("close") > 0).join(days, (F.col("day") <= F.col("target")) & (F.col("day") >= F.date_sub("target", 20)))
    at = seen.groupBy("year", "horizon", "code").agg(F.max_by("close", "day").alias("close"))
    wide = at.groupBy("year", "code").agg(*(F.max(F.when(F.col("horizon") == h, F.col("close"))).alias(f"h{h}") for h in (0, *horizons))).where("h0 IS NOT NULL")
    chosen = wide.join(universe.select("year", "code").distinct(), ["year", "code"]).join(selected.select("year", "code").distinct().withColumn("picked", F.lit(True)), ["year", "code"], "left")
    back = lambda h: num(f"h{h}") / F.nullif(num("h0"), F.lit(0.0)) - 1
    return chosen.groupBy("year").agg(F.count_if("picked").alias("n_selected"), F.count(F.lit(1)).alias("n_universe"), *(c for h in horizons for c in (F.avg(F.when(F.col("picked"), back(h))).alias(f"port_{h}"), F.avg(back(h)).alias(f"bench_{h}"))))


def cohort_means(cohorts: DataFrame, horizons: Sequence[int] = (1, 3, 5)) -> DataFrame:
    """O9.6: means over the cohorts that have a value, by horizon."""
    parts = F.array(*(F.struct(F.lit(h).alias("horizon"), F.col(f"port_{h}").alias("port"), F.col(f"bench_{h}").alias("bench")) for h in horizons))
    return cohorts.select(F.inline(parts)).groupBy("horizon").agg(F.avg("port").alias("port"), F.avg("bench").alias("bench"), F.count("port").alias("n_cohorts"))


def repair_plan(stored: DataFrame, fresh: DataFrame, key: str = "code") -> DataFrame:
    """O9.12: days whose stored close differs from a fresh adjusted history, with the factor to apply.

    The factor is the median of close, high and low ratios; a stock is accepted if the rewritten
    series has no more breaks at its edge than before.
    """
    both = stored.join(fresh.select(key, "day", *(F.col(c).alias(f"f_{c}") for c in ("close", "high", "low"))), [key, "day"])
    factor = median_of_three(*(safe_div(f"f_{c}", c) for c in ("close", "high", "low")))
    return both.where(F.col("f_close") != F.col("close")).select(key, "day", "close", "f_close", factor.alias("factor"))


def freshness(sources: dict[str, DataFrame], today: Column, stale_days: int = 4) -> DataFrame:
    """O9.13, O5.25: a row per item: last success and whether it is older than ``stale_days``. Each frame: one day column."""
    rows = None
    for name, df in sources.items():
        one = df.agg(F.max(df.columns[0]).cast("date").alias("last_day"), F.count(F.lit(1)).alias("n_rows")).withColumn("item", F.lit(name))
        rows = one if rows is None else rows.unionByName(one)
    return rows.select("item", "last_day", "n_rows", (F.datediff(today, F.col("last_day")) > stale_days).alias("stale"))


def delisting(state: DataFrame, listed: DataFrame, registry: DataFrame, today: Column, trusted: Column, max_share: float = 0.02, by_registry: int = 20, by_absence: int = 5, wait_days: int = 14) -> DataFrame:
    """O9.17: next state of each company: (code, status, since, signal) with ``action``.

    An untrusted source changes nothing. The registry of delistings is ignored if it names more
    than ``max_share`` of all companies. A company listed again is reinstated; registry evidence
    confirms at once, at most ``by_registry`` a day; else absence makes a candidate, which is
    confirmed after ``wait_days`` (ten business days) with a second signal, at most
    ``by_absence`` a day. The daily limits take the smallest codes first; the rest hold.
    """
    on = state.join(listed.select("code").distinct().withColumn("__on", F.lit(True)), "code", "left").join(registry.select("code").distinct().withColumn("__reg", F.lit(True)), "code", "left")
    share = on.agg(F.avg(F.coalesce(F.col("__reg").cast("int"), F.lit(0))).alias("__share"))
    rows = on.crossJoin(F.broadcast(share)).withColumns({"__on": F.coalesce("__on", F.lit(False)), "__reg": F.coalesce("__reg", F.lit(False)) & (F.col("__share") <= max_share)})
    aged = F.datediff(today, F.col("since")) >= wait_days
    wish = (
        F.when(~trusted, "skip")
        .when(F.col("__on") & F.col("status").isin("candidate", "delisted"), "reinstate")
        .when(F.col("__on"), "keep")
        .when(F.col("status") == "delisted", "keep")
        .when(F.col("__reg"), "confirm_registry")
        .when(F.col("status") == "listed", "candidate")
        .when(aged & F.col("signal"), "confirm_absence")
        .otherwise("hold")
    )
    wished = rows.withColumn("__wish", wish)
    # Only wishes that are limited are numbered, so the windows hold few rows.
    limited = wished.where(F.col("__wish").startswith("confirm"))
    place = F.row_number().over(Window.partitionBy("__wish").orderBy("code"))
    granted = limited.select("code", "__wish", place.alias("__place")).where(F.col("__place") <= F.when(F.col("__wish") == "confirm_registry", by_registry).otherwise(by_absence)).select("code", F.lit(True).alias("__granted"))
    action = F.when(F.col("__wish").startswith("confirm") & F.col("__granted").isNull(), "hold").otherwise(F.col("__wish"))
    status = F.when(F.col("action").startswith("confirm"), "delisted").when(F.col("action") == "candidate", "candidate").when(F.col("action") == "reinstate", "listed").otherwise(F.col("status"))
    out = wished.join(granted, "code", "left").withColumn("action", action)
    return out.select("code", status.alias("status"), F.when(F.col("action").isin("candidate", "reinstate") | F.col("action").startswith("confirm"), today).otherwise(F.col("since")).alias("since"), "action")


def raw_close_updates(stored: DataFrame, incoming: DataFrame, keys: Keys) -> tuple[DataFrame, DataFrame]:
    """O1.5: exchange data updates rows that exist; (updated rows, one row with the number of others)."""
    new = incoming.select(*keys, *(F.col(c).alias(f"__{c}") for c in ("raw", "listed")))
    updated = stored.join(new, list(keys), "left").withColumns({c: F.coalesce(f"__{c}", c) for c in ("raw", "listed")}).select(*stored.columns)
    return updated, incoming.join(stored.select(*keys), list(keys), "left_anti").agg(F.count(F.lit(1)).alias("n_unknown"))


__all__ = ["SQL_PRICES", "back_test", "clean_quotes", "cohort_means", "delisting", "freshness", "market_cap", "price_breaks", "prices", "raw_close_updates", "repair_plan", "snapshot", "top_n"]
