"""O5: ordered operators. Every order is total: ties are broken by the columns named."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from quantloom.functions.nullsafe import col, num

Keys = Sequence[str]
#: Slices of a rank over all rows; their edges and sums are RANK_SLICES rows.
RANK_SLICES = 64
#: Newest first within a year.
PERIOD_ORDER = ("FY", "CQ4", "Q3", "CQ3", "H1", "CQ2", "Q1", "CQ1")


def over(keys: Keys, *order: Column | str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def period_rank(period: Column | str, names: Keys = PERIOD_ORDER) -> Column:
    """O5.2, O5.20: place of a period's name in ``names``; unknown ones come last."""
    at = F.array_position(F.array(*map(F.lit, names)), col(period))
    return F.when(at > 0, at).otherwise(F.lit(len(names) + 1))


def top_n(df: DataFrame, keys: Keys, order: Sequence[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """O4.8, O5.1, O5.8-O5.10: the first ``n`` rows of each key; Spark prunes before the shuffle."""
    name = rank or "__rank"
    out = df.withColumn(name, F.row_number().over(over(keys, *order))).where(F.col(name) <= n)
    return out if rank else out.drop(name)


def latest_row(df: DataFrame, keys: Keys, order: Column, columns: Keys) -> DataFrame:
    """O3.2, O5.16: the columns of each key's newest row by aggregation, without sorting a key's rows."""
    newest = F.max_by(F.struct(*columns), order)
    return df.groupBy(*keys).agg(newest.alias("__row")).select(*keys, "__row.*")


def with_previous(df: DataFrame, keys: Keys, order: Sequence[Column], columns: Keys, step: int = 1, prefix: str = "p_") -> DataFrame:
    """O5.13: columns of the row ``step`` places before, by position and not by calendar."""
    w = over(keys, *order)
    return df.withColumns({prefix + c: F.lag(c, step).over(w) for c in columns})


def with_year_before(df: DataFrame, keys: Keys, year: str, columns: Keys, prefix: str = "p_", years: int = 1) -> DataFrame:
    """O3.8: columns of the calendar year before; NULL where that year is missing."""
    before = df.select(*keys, (F.col(year) + years).alias(year), *(F.col(c).alias(prefix + c) for c in columns))
    return df.join(before, [*keys, year], "left")


def neighbour_spikes(df: DataFrame, keys: Keys, order: str, value: str, times: float = 100.0) -> DataFrame:
    """O5.3, O10.8: rows whose size is more than ``times`` that of both neighbours, or less than a ``times``-th."""
    w = over(keys, order)
    here, left, right = F.abs(num(value)), F.abs(num(F.lag(value).over(w))), F.abs(num(F.lead(value).over(w)))
    both = df.withColumns({"__here": here, "__left": left, "__right": right}).where("__here > 0 AND __left > 0 AND __right > 0")
    high = (F.col("__here") > F.col("__left") * times) & (F.col("__here") > F.col("__right") * times)
    low = (F.col("__here") * times < F.col("__left")) & (F.col("__here") * times < F.col("__right"))
    return both.where(high | low).withColumn("spike", F.when(high, "high").otherwise("low")).drop("__here", "__left", "__right")


def basis_steps(df: DataFrame, keys: Keys, order: str, adjusted: str, raw: str, noise: float = 1.5) -> DataFrame:
    """O5.4, O10.5: days where the ratio of adjusted to raw price jumps by more than rounding can explain."""
    w = over(keys, order)
    ratio = F.ln(num(adjusted) / F.nullif(num(raw), F.lit(0.0)))
    low = F.least(num(adjusted), num(raw))
    return (
        df.where((num(adjusted) > 0) & (num(raw) > 0))
        .withColumns({"__ratio": ratio, "__low": low})
        .withColumns({"step": F.col("__ratio") - F.lag("__ratio").over(w), "bound": noise / F.least(F.col("__low"), F.lag("__low").over(w))})
        .where(F.abs("step") > F.col("bound"))
        .drop("__ratio", "__low")
    )


def halts_off_price(df: DataFrame, keys: Keys, order: str, close: str, volume: str) -> DataFrame:
    """O5.5: days without volume whose close equals neither neighbour's."""
    w = over(keys, order)
    marked = df.withColumns({"__before": F.lag(close).over(w), "__after": F.lead(close).over(w)})
    off = (F.col(volume) == 0) & (F.col(close) != F.col("__before")) & (F.col(close) != F.col("__after"))
    return marked.where(off).drop("__before", "__after")


def intervals(df: DataFrame, keys: Keys, start: str, first: str = "1900-01-01", last: str = "9999-12-31") -> DataFrame:
    """O5.6, O3.4: [valid_from, valid_to) of a step function; the first step reaches back to ``first``."""
    w = over(keys, start)
    begin = F.when(F.row_number().over(w) == 1, F.to_date(F.lit(first))).otherwise(F.col(start).cast("date"))
    end = F.coalesce(F.lead(F.col(start).cast("date")).over(w), F.to_date(F.lit(last)))
    return df.withColumns({"valid_from": begin, "valid_to": end})


def rank_min(df: DataFrame, value: str, name: str, keys: Keys = (), descending: bool = True) -> DataFrame:
    """O5.7: 1 + the number of strictly better values; NULL and NaN get no rank.

    Without ``keys`` equal values are counted first and ranks are joined back by value. The
    distinct values are ranked within ``RANK_SLICES`` slices of equal hash-sampled size, and the slices' sums
    are carried on, so that no task orders all values.
    """
    v = num(value)
    known = F.when(v.isNotNull() & ~F.isnan(v), v)
    if keys:
        order = known.desc_nulls_last() if descending else known.asc_nulls_last()
        return df.withColumn(name, F.when(known.isNotNull(), F.rank().over(over(keys, order))))
    counts = df.where(known.isNotNull()).groupBy(known.alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    order = F.col("__v").desc() if descending else F.col("__v").asc()
    edges = counts.agg(F.percentile_approx("__v", [k / RANK_SLICES for k in range(1, RANK_SLICES)]).alias("__edges"))
    # One row: the edges of the slices. Equal values are in one slice, whatever the edges are.
    sliced = counts.crossJoin(F.broadcast(edges)).withColumn("__slice", F.size(F.filter("__edges", lambda e: e < F.col("__v")))).drop("__edges")
    sums = sliced.groupBy("__slice").agg(F.sum("__n").alias("__all"))
    slices = F.col("__slice").desc() if descending else F.col("__slice").asc()
    carried = sums.withColumn("__carry", F.coalesce(F.sum("__all").over(Window.orderBy(slices).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__all")
    before = F.coalesce(F.sum("__n").over(over(["__slice"], order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = sliced.withColumn("__before", before).join(F.broadcast(carried), "__slice").select("__v", (F.col("__before") + F.col("__carry") + 1).cast("int").alias(name))
    return df.withColumn("__own", known).join(ranks, F.col("__own") == F.col("__v"), "left").drop("__own", "__v")


def running_sum(df: DataFrame, keys: Keys, order: Sequence[Column | str], value: Column, name: str) -> DataFrame:
    """O5.11."""
    return df.withColumn(name, F.sum(value).over(over(keys, *order).rowsBetween(Window.unboundedPreceding, 0)))


def streak(df: DataFrame, keys: Keys, newest_first: Sequence[Column], holds: Column, name: str) -> DataFrame:
    """O5.12: how many rows from the newest on ``holds`` is true without a break; NULL breaks."""
    broken = F.sum(F.when(F.coalesce(holds, F.lit(False)), 0).otherwise(1)).over(over(keys, *newest_first).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("__broken", broken).groupBy(*keys).agg(F.count_if(F.col("__broken") == 0).cast("int").alias(name))


def ttm(df: DataFrame, keys: Keys, oldest_first: Sequence[Column | str], flows: Keys, n: int = 4) -> DataFrame:
    """O5.14, O7.5: sum over ``n`` rows of what is not NULL; NULL with fewer rows. Other columns stay those of the newest row."""
    w = over(keys, *oldest_first).rowsBetween(-(n - 1), 0)
    full = F.count(F.lit(1)).over(w) == n
    return df.withColumns({c: F.when(full, F.sum(c).over(w)) for c in flows})


def ordered(df: DataFrame, by: str, descending: bool = True, screen: bool = False, ties: Keys = ()) -> DataFrame:
    """O5.17 (``screen``): NULLs first when descending and last when ascending; O5.18: NULLs last both ways."""
    c = F.col(by)
    if descending:
        order = c.desc_nulls_first() if screen else c.desc_nulls_last()
    else:
        order = c.asc_nulls_last()
    return df.orderBy(order, *ties)


def median_of_three(a: Column, b: Column, c: Column) -> Column:
    """O5.21."""
    return F.get(F.sort_array(F.array(a, b, c)), F.lit(1))


def latest_filing(df: DataFrame, keys: Keys, is_final: str = "is_final", filed_at: str = "filed_at", filing: str = "rcept") -> DataFrame:
    """O5.15: of a key's filings the final one, of several the one filed last (unknown times last), then the largest number."""
    return top_n(df, keys, [F.col(is_final).desc(), F.col(filed_at).desc_nulls_last(), F.col(filing).desc()])


def sampled(df: DataFrame, keys: Keys, share: float) -> DataFrame:
    """O5.26: about ``share`` of the rows, for diagnosis: those whose keys' md5 begins low, the same ones every time."""
    if not 0 <= share <= 1:
        raise ValueError("a share is between 0 and 1")
    bound = f"{min(int(share * 16**8), 16**8 - 1):08x}"
    low = F.substring(F.md5(F.concat_ws("|", *(F.col(k).cast("string") for k in keys))), 1, 8) < bound
    return df if share == 1 else df.where(low)
