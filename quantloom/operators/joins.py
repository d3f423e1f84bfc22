"""O1.7-O1.12, O2.1, O3: joins that Spark has no operator for, as plans it can run at any size.

As-of joins are a union and one window, never a range join: each side is shuffled once by key.
``slice_by`` cuts long keys into time slices (a carry of one row per key and slice passes the
last value on), so that a key with a third of all rows is no single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantloom.operators.windows import Keys, intervals, top_n


def asof(left: DataFrame, right: DataFrame, keys: Keys, left_time: str, right_time: str, values: Keys, ties: Sequence[Column] = (), strict: bool = False, slice_by: Column | None = None, forward: bool = False) -> DataFrame:
    """O3.3: each left row with ``values`` and ``right_time`` of the newest right row at or before its time.

    ``ties``: order, best first, among right rows of equal time. ``strict``: before the time
    only. ``forward``: the oldest row at or after instead. Left rows without a match stay.
    Every name of ``values`` and ``right_time`` must be absent from the left.
    """
    held = F.struct(F.col(right_time).alias(right_time), *(F.col(v) for v in values))
    best = top_n(right.where(F.col(right_time).isNotNull()), [*keys, right_time], list(ties) or [F.struct(*values)], 1)
    at_right = best.select(*keys, F.col(right_time).alias("__t"), F.lit(1).alias("__side"), held.alias("__held"), F.lit(None).cast(left.select(F.struct(*left.columns).alias("x")).schema["x"].dataType).alias("__row"))
    at_left = left.select(*keys, F.col(left_time).alias("__t"), F.lit(0 if strict else 2).alias("__side"), F.lit(None).cast(at_right.schema["__held"].dataType).alias("__held"), F.struct(*left.columns).alias("__row"))
    both = at_right.unionByName(at_left)
    time_order = [F.col("__t").desc(), F.col("__side")] if forward else [F.col("__t"), F.col("__side")]
    if slice_by is None:
        w = Window.partitionBy(*keys).orderBy(*time_order).rowsBetween(Window.unboundedPreceding, 0)
        found = both.withColumn("__held", F.last("__held", True).over(w))
    else:
        both = both.withColumn("__slice", slice_by)
        w = Window.partitionBy(*keys, "__slice").orderBy(*time_order).rowsBetween(Window.unboundedPreceding, 0)
        edge = F.min_by if forward else F.max_by
        carried = both.groupBy(*keys, "__slice").agg(edge("__held", F.when(F.col("__held").isNotNull(), F.col("__t"))).alias("__last"))
        slices = Window.partitionBy(*keys).orderBy(F.col("__slice").desc() if forward else F.col("__slice")).rowsBetween(Window.unboundedPreceding, -1)
        carried = carried.withColumn("__carry", F.last("__last", True).over(slices)).drop("__last")
        found = both.withColumn("__held", F.last("__held", True).over(w)).join(carried, [*keys, "__slice"], "left").withColumn("__held", F.coalesce("__held", "__carry"))
    return found.where(F.col("__side") != 1).select("__row.*", *(F.col("__held")[c].alias(c) for c in (right_time, *values)))


def by_year() -> Column:
    """Slices of a year for ``asof``: a key's rows of one year are one task's."""
    return F.year("__t")


def asof_within(left: DataFrame, right: DataFrame, keys: Keys, left_time: str, right_time: str, values: Keys, days: int, slice_by: Column | None = None) -> DataFrame:
    """O3.5: the newest right row strictly before and at most ``days`` back; NULL beyond. By default keys are cut into years."""
    found = asof(left, right, keys, left_time, right_time, values, strict=True, slice_by=by_year() if slice_by is None else slice_by)
    near = F.datediff(F.col(left_time).cast("date"), F.col(right_time).cast("date")) <= days
    return found.withColumns({c: F.when(near, F.col(c)) for c in (right_time, *values)})


def nearest_date(left: DataFrame, right: DataFrame, keys: Keys, left_time: str, right_time: str, value: str, days: int = 7, slice_by: Column | None = None) -> DataFrame:
    """O3.6: the right row with the smallest gap within ``days``, the earlier one if two are as near. By default keys are cut into years."""
    slice_by = by_year() if slice_by is None else slice_by
    back = asof(left, right, keys, left_time, right_time, [value], slice_by=slice_by).withColumnsRenamed({right_time: "__t0", value: "__v0"})
    ahead = asof(back, right, keys, left_time, right_time, [value], forward=True, slice_by=slice_by).withColumnsRenamed({right_time: "__t1", value: "__v1"})
    gap = lambda t: F.abs(F.datediff(F.col(left_time).cast("date"), F.col(t).cast("date")))
    ok0, ok1 = F.coalesce(gap("__t0") <= days, F.lit(False)), F.coalesce(gap("__t1") <= days, F.lit(False))
    first = ok0 & (~ok1 | (gap("__t0") <= gap("__t1")))
    pick = lambda a, b: F.when(first, F.col(a)).when(ok1, F.col(b))
    return ahead.withColumns({right_time: pick("__t0", "__t1"), value: pick("__v0", "__v1")}).drop("__t0", "__t1", "__v0", "__v1")


def step_value(left: DataFrame, steps: DataFrame, keys: Keys, left_time: str, start: str, values: Keys, slice_by: Column | None = None) -> DataFrame:
    """O3.4: the value of a step function whose first step reaches back to 1900, at each left row's time. By default keys are cut into years."""
    opened = intervals(steps, keys, start).select(*keys, F.col("valid_from").cast("timestamp_ntz").alias("valid_from"), *values)
    return asof(left, opened, keys, left_time, "valid_from", values, slice_by=by_year() if slice_by is None else slice_by)


def snapshot(prices: DataFrame, key: str, day: str, close: str, at: Column, days: int = 20) -> DataFrame:
    """O3.7: each key's newest close above 0 within ``days`` up to ``at``."""
    seen = prices.where((F.col(close) > 0) & (F.col(day).cast("date") <= at) & (F.col(day).cast("date") >= F.date_sub(at, days)))
    return seen.groupBy(key).agg(F.max_by(close, day).alias(close))


def chosen_basis(df: DataFrame, keys: Keys, basis: str, wanted: str, other: str) -> DataFrame:
    """O2.8, O4.1, O9.19: a key's rows of the wanted basis if it has any, else of the other; never mixed."""
    has = df.groupBy(*keys).agg(F.bool_or(F.col(basis) == wanted).alias("__has"))
    return df.join(has, list(keys)).where(F.col(basis) == F.when(F.col("__has"), F.lit(wanted)).otherwise(F.lit(other))).drop("__has")


def overlay(lines: DataFrame, fixes: DataFrame, fill_schema: str, key: str = "id", value: str = "value") -> DataFrame:
    """O2.1: corrections by line id. ``fixes``: (line_id, kind, value, fill).

    kind 'value' replaces the value, 'drop' removes the line, 'fill' adds a line whose fields
    are read from the JSON text ``fill`` and whose id is the negated line_id. Both branches have
    the same types, so that filters reach the scan of either.
    """
    cell = fixes.where(F.col("kind").isin("value", "drop")).select(F.col("line_id").alias(key), F.col("kind").alias("__kind"), F.col("value").alias("__value"))
    fixed = lines.join(cell, key, "left").where(~F.col("__kind").eqNullSafe("drop")).withColumn(value, F.when(F.col("__kind") == "value", F.col("__value")).otherwise(F.col(value))).select(*lines.columns)
    read = F.from_json("fill", fill_schema)
    added = fixes.where(F.col("kind") == "fill").withColumn("__f", read).select(*((-F.col("line_id")).cast(lines.schema[c].dataType).alias(c) if c == key else F.col("__f")[c].cast(lines.schema[c].dataType).alias(c) for c in lines.columns))
    return fixed.unionByName(added)


def upsert(old: DataFrame, new: DataFrame, keys: Keys, keep_when_null: Keys = ()) -> DataFrame:
    """O1.7: insert or overwrite by key; columns of ``keep_when_null`` change only to a value that is not NULL."""
    columns = old.columns
    both = old.withColumn("__v", F.lit(0)).unionByName(new.select(*columns).withColumn("__v", F.lit(1)))
    rest = [c for c in columns if c not in keys]
    newest = [F.max_by(F.col(c), F.when(F.col(c).isNotNull() if c in keep_when_null else F.lit(True), F.col("__v"))).alias(c) for c in rest]
    return both.groupBy(*keys).agg(*newest).select(*columns)


def insert_absent(old: DataFrame, new: DataFrame, keys: Keys) -> DataFrame:
    """O1.8: rows of ``new`` whose key ``old`` doesn't have, one a key, beside ``old``."""
    fresh = new.join(old.select(*keys), list(keys), "left_anti").dropDuplicates(list(keys))
    return old.unionByName(fresh.select(*old.columns))


def replace_units(old: DataFrame, new: DataFrame, units: DataFrame, keys: Keys) -> DataFrame:
    """O1.12: delete the rows of ``units`` (also of those without new rows), then insert."""
    return old.join(units.select(*keys).distinct(), list(keys), "left_anti").unionByName(new.select(*old.columns))


def neighbour_median(df: DataFrame, keys: Keys, own: str, year: str, value: str, span: int = 1) -> DataFrame:
    """O3.10, O10.26: median of a key's values in other filings at most ``span`` years away.

    A row is copied to each year in its span and met by equality, not by range.
    """
    near = df.select(*keys, F.col(own).alias("__own"), F.explode(F.sequence(F.col(year) - span, F.col(year) + span)).alias(year), F.col(value).alias("__value"))
    other = F.when(F.col("__own") != F.col(own), F.col("__value"))
    rows = df.join(near, [*keys, year], "left")
    return rows.groupBy(*keys, own, year, value).agg(F.median(other).alias("neighbour_median"), F.count(other).alias("n_neighbours"))


def cell_diff(before: DataFrame, after: DataFrame, keys: Keys, columns: Keys, tolerance: float = 0.0) -> DataFrame:
    """O3.13, O9.16, O9.26: (keys, item, before, after, kind) of every cell that changed.

    kind: added, removed, null_to_value, value_to_null, changed (relative difference over
    ``tolerance``). Rows with equal keys must be one on each side.
    """
    long = lambda df, name: df.select(*keys, F.explode(F.array(*(F.struct(F.lit(c).alias("item"), F.col(c).cast("double").alias(name)) for c in columns))).alias("c")).select(*keys, "c.*", F.lit(True).alias(f"has_{name}"))
    both = long(before, "before").join(long(after, "after"), [*keys, "item"], "full")
    b, a = F.col("before"), F.col("after")
    kind = (
        F.when(F.col("has_before").isNull(), "added")
        .when(F.col("has_after").isNull(), "removed")
        .when(b.isNull() & a.isNotNull(), "null_to_value")
        .when(b.isNotNull() & a.isNull(), "value_to_null")
        .when(F.abs(a - b) > tolerance * F.greatest(F.abs(a), F.abs(b)), "changed")
    )
    return both.withColumn("kind", kind).where(F.col("kind").isNotNull()).drop("has_before", "has_after")


def reconcile(source: DataFrame, stored: DataFrame, keys: Keys, value: str, slack: int = 0) -> DataFrame:
    """O3.18: per key, source lines against the set of stored candidates.

    match: some stored candidate agrees with some source value; value_diff: both sides have
    values but none agree; missing: only the source has the key; extra: only the store has it.
    """
    own = source.groupBy(*keys).agg(F.array_sort(F.collect_set(value)).alias("source_values"))
    held = stored.groupBy(*keys).agg(F.array_sort(F.collect_set(value)).alias("stored_values"))
    agree = F.exists("source_values", lambda s: F.exists("stored_values", lambda t: F.abs(s - t) <= slack))
    status = F.when(F.col("stored_values").isNull(), "missing").when(F.col("source_values").isNull(), "extra").when(agree, "match").otherwise("value_diff")
    return own.join(held, list(keys), "full").withColumn("status", status)


def full_coalesced(before: DataFrame, after: DataFrame, keys: Keys, columns: Keys) -> DataFrame:
    """O3.13: both snapshots side by side, keys from whichever side has the row."""
    side = lambda df, name: df.select(*keys, *(F.col(c).alias(f"{name}_{c}") for c in columns))
    return side(before, "before").join(side(after, "after"), list(keys), "full")


def has_basis(df: DataFrame, keys: Keys, basis: str, wanted: str) -> DataFrame:
    """O4.1: whether a key has any row of the wanted basis."""
    return df.groupBy(*keys).agg(F.coalesce(F.bool_or(F.col(basis) == wanted), F.lit(False)).alias("has_basis"))


def gone(before: DataFrame, after: DataFrame, keys: Keys) -> DataFrame:
    """O5.24: keys that were there before and are not any more, once each, NULL a key like others."""
    return before.select(*keys).subtract(after.select(*keys))


def under(*branches: DataFrame) -> DataFrame:
    """O5.22: the branches one under the other, with the names and types of the first, so that filters reach each scan."""
    first = branches[0]
    out = first
    for b in branches[1:]:
        out = out.unionAll(b.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in first.schema)))
    return out
