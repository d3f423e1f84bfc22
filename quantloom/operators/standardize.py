"""O6.7-O6.51: from printed cells to one standardized row.

Rules are functions DataFrame -> DataFrame, applied in order. What has to look at a whole chain
of filings in order is expressed by ordered aggregation; the searches over signs are pandas
functions over one statement each, whose size does not follow the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.functions.nullsafe import filled, num
from quantloom.operators.windows import Keys, over, top_n

#: Stage priority in conflicts (O6.15).
STAGE_ORDER = {"exact": 3.0, "normalized": 2.0, "guard": 2.0, "taxonomy": 1.5, "fuzzy": 1.0, "structural": 1.0}
NEAR = 0.001


def chain(filings: DataFrame, keys: Keys) -> DataFrame:
    """O6.7: filings of a period in order, numbered from 1; of several closing dates only the latest counts (or none given)."""
    newest = Window.partitionBy(*keys)
    kept = filings.withColumn("__last", F.max("period_end").over(newest)).where(F.col("period_end").isNull() | (F.col("period_end") == F.col("__last"))).drop("__last")
    return kept.withColumn("seq", F.row_number().over(over(keys, F.col("filed_at").asc_nulls_first(), "rcept")))


def merged(cells: DataFrame, unit: Keys, cell: Keys, value: str, seq: str = "seq", track: str | None = None) -> DataFrame:
    """O6.8, O6.9: the newest filing's value of each cell, the chain of filings that changed it, and whether it was amended.

    ``cells`` has a row per filing and cell. With ``track``, a later filing of another track
    replaces all cells of the statement (the last of ``unit``'s columns) that it covers.
    """
    rows = cells
    if track:
        # The newest track switch of each unit: earlier rows of other tracks are out.
        marks = rows.groupBy(*unit, seq).agg(F.max(track).alias("__track"))
        w = over(unit, seq)
        switches = marks.withColumn("__switch", F.when(F.lag("__track").over(w) != F.col("__track"), F.col(seq)))
        start = switches.groupBy(*unit).agg(F.max("__switch").alias("__from"))
        rows = rows.join(start, list(unit)).where(F.col("__from").isNull() | (F.col(seq) >= F.col("__from"))).drop("__from")
    w = over([*unit, *cell], seq)
    changed = F.lag(value).over(w).isNull() | ~F.lag(value).over(w).eqNullSafe(F.col(value))
    steps = rows.withColumns({"__changed": changed, "__nth": F.row_number().over(w)})
    return steps.groupBy(*unit, *cell).agg(
        F.max_by(value, seq).alias(value),
        F.array_sort(F.collect_list(F.when(F.col("__changed") & (F.col("__nth") > 1), F.col(seq)))).alias("amend_chain"),
    ).withColumn("amended", F.size("amend_chain") > 0)


def without_withdrawn(cells: DataFrame, filings: DataFrame, keys: Keys) -> DataFrame:
    """O6.11: if the last filing declares that it has no consolidation, consolidated cells go."""
    last = filings.groupBy(*keys).agg(F.max_by("no_consolidation", "seq").alias("__none"))
    return cells.join(last, list(keys), "left").where(~((F.col("basis") == "consolidated") & F.coalesce("__none", F.lit(False)))).drop("__none")


def without_unfilled(cells: DataFrame, keys: Keys, least: int = 8) -> DataFrame:
    """O6.12: a balance sheet of ``least`` rows or more that are all 0 goes, with every all-zero statement of its basis."""
    sums = cells.groupBy(*keys, "basis", "statement").agg(F.count(F.lit(1)).alias("n"), F.max(F.abs("value")).alias("most"))
    empty = sums.where(F.coalesce("most", F.lit(0)) == 0)
    blank = empty.where((F.col("statement") == "BS") & (F.col("n") >= least)).select(*keys, "basis")
    return cells.join(empty.join(blank, [*keys, "basis"], "left_semi").select(*keys, "basis", "statement"), [*keys, "basis", "statement"], "left_anti")


def cumulative_first(cells: DataFrame, keys: Keys, period: str, flow: Column) -> DataFrame:
    """O6.13: in H1 and Q3 a flow's cumulative cells displace the others."""
    w = Window.partitionBy(*keys)
    has = F.max(F.col("is_cumulative").cast("int")).over(w) == 1
    drop = F.col(period).isin("H1", "Q3") & flow & has & ~F.col("is_cumulative")
    return cells.withColumn("__drop", F.coalesce(drop, F.lit(False))).where(~F.col("__drop")).drop("__drop")


def without_reprints(cells: DataFrame, keys: Keys, last_year: int = 2012, shared: int = 10) -> DataFrame:
    """O6.14: an interim cumulative table that shares ``shared`` or more (label, value) pairs with another interim period of its year is a reprint.

    Both sides are distinct, and they meet by equality of label and value within a company and year.
    """
    pairs = cells.where(F.col("period").isin("Q1", "H1", "Q3") & (F.col("fy") <= last_year) & F.col("is_cumulative")).select(*keys, "fy", "period", "statement", "table_seq", "label", "value").distinct()
    other = pairs.select(*keys, "fy", F.col("period").alias("__p"), "statement", "label", "value").distinct()
    hits = pairs.join(other, [*keys, "fy", "statement", "label", "value"]).where(F.col("period") != F.col("__p"))
    stale = hits.groupBy(*keys, "fy", "period", "statement", "table_seq", "__p").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= shared).select(*keys, "fy", "period", "statement", "table_seq").distinct()
    return cells.join(stale, [*keys, "fy", "period", "statement", "table_seq"], "left_anti")


def resolved(candidates: DataFrame, keys: Keys, additive: Sequence[str] = (), held: Sequence[str] = ()) -> DataFrame:
    """O6.15, O6.16: one value for each canonical account of ``keys``, or NULL with the reason.

    ``candidates``: code, value, stage, label, depth (of its path), is_total, is_current. Order:
    additive codes are summed over distinct (label, size); codes of ``held`` give NULL on any
    disagreement; one value; one value at the best stage; then, among those of the best stage,
    current ones before others, totals, values that agree within 0.1 % and in sign (the larger
    one), without zeros, the shallowest path; else NULL.
    """
    group = [*keys, "code"]
    rank = F.create_map(*(x for k, v in STAGE_ORDER.items() for x in (F.lit(k), F.lit(v))))
    rows = candidates.where(F.col("value").isNotNull()).withColumn("__stage", F.coalesce(F.element_at(rank, F.col("stage")), F.lit(0.0)))
    kept = F.array_distinct(F.collect_list(F.struct("__stage", "value", "label", "depth", "is_total", "is_current")))
    grouped = rows.groupBy(*group).agg(kept.alias("c"))
    c = F.col("c")
    values = lambda a: F.array_distinct(F.transform(a, lambda x: x["value"]))
    only = lambda a: F.when(F.size(values(a)) == 1, F.get(values(a), F.lit(0)))
    best = F.filter(c, lambda x: x["__stage"] == F.array_max(F.transform(c, lambda y: y["__stage"])))
    narrowed = lambda a, test: F.when(F.exists(a, test), F.filter(a, test)).otherwise(a)
    steps = grouped.withColumns({"b": best}).withColumn("s1", narrowed(F.col("b"), lambda x: x["is_current"])).withColumn("s2", narrowed(F.col("s1"), lambda x: x["is_total"]))
    size = lambda a: F.transform(values(a), F.abs)
    top = F.array_max(size(F.col("s2")))
    near = (F.array_min(size(F.col("s2"))) >= top * (1 - NEAR)) & F.forall(values(F.col("s2")), lambda v: F.sign(v) == F.sign(F.get(values(F.col("s2")), F.lit(0))))
    nearly = F.when(near, F.get(F.filter(values(F.col("s2")), lambda v: F.abs(v) == top), F.lit(0)))
    nonzero = F.filter(F.col("s2"), lambda x: x["value"] != 0)
    shallow = F.filter(nonzero, lambda x: x["depth"] == F.array_min(F.transform(nonzero, lambda y: y["depth"])))
    summed = F.aggregate(F.array_distinct(F.transform(c, lambda x: F.struct(x["label"].alias("l"), F.abs(x["value"]).alias("v")))), F.lit(0).cast("long"), lambda acc, x: acc + x["v"])
    is_sum, is_held = F.col("code").isin(*additive) if additive else F.lit(False), F.col("code").isin(*held) if held else F.lit(False)
    ladder = [("single", only(c)), ("stage", only(F.col("b"))), ("current", only(F.col("s1"))), ("total", only(F.col("s2"))), ("near", nearly), ("nonzero", only(nonzero)), ("shallow", only(shallow))]
    value = F.when(is_sum, summed).when(is_held, only(c)).otherwise(F.coalesce(*(v for _, v in ladder)))
    how = F.when(is_sum, "sum").when(is_held, F.when(only(c).isNotNull(), "single").otherwise("held"))
    for name, v in ladder:
        how = how.when(v.isNotNull(), name)
    return steps.select(*group, value.alias("value"), how.otherwise("held").alias("how"), F.size(values(c)).alias("n_values"))


def revenue_by_identity(rows: DataFrame, slack: int = 2) -> DataFrame:
    """O6.17: ``candidates`` (array) holds other revenue values of the table; exactly one that closes value - |cogs| = gross profit replaces it."""
    closes = F.array_distinct(F.filter("candidates", lambda v: F.abs(v - F.abs("cogs") - F.col("gross_profit")) <= slack))
    own = F.abs(F.col("revenue") - F.abs("cogs") - F.col("gross_profit")) <= slack
    fix = ~F.coalesce(own, F.lit(False)) & (F.size(closes) == 1)
    return rows.withColumn("revenue", F.when(fix, F.get(closes, F.lit(0))).otherwise(F.col("revenue")))


def attribution(rows: DataFrame) -> DataFrame:
    """O6.18: the only (controlling, noncontrolling or 0) pair of the candidate arrays that sums to net income, exactly or else within 2; NULL if several do."""
    pairs = F.flatten(F.transform("controlling", lambda a: F.transform(F.array_union(F.col("noncontrolling"), F.array(F.lit(0).cast("long"))), lambda b: F.struct(a.alias("c"), b.alias("n")))))
    fits = lambda slack: F.array_distinct(F.filter(pairs, lambda p: F.abs(p["c"] + p["n"] - F.col("net_income")) <= slack))
    exact, near = fits(0), fits(2)
    only = F.when(F.size(exact) == 1, F.get(exact, F.lit(0))).when((F.size(exact) == 0) & (F.size(near) == 1), F.get(near, F.lit(0)))
    return rows.withColumns({"controlling_ni": only["c"], "noncontrolling_ni": only["n"]})


def net_income_anchors(ebt: Column, taxes: Column) -> Column:
    """O6.19: {EBT} without a tax, {EBT - t, EBT + t} with one, nothing with several."""
    return F.when(F.size(taxes) == 0, F.array(ebt)).when(F.size(taxes) == 1, F.array_distinct(F.array(ebt - F.get(taxes, F.lit(0)), ebt + F.get(taxes, F.lit(0))))).otherwise(F.array().cast("array<bigint>"))


def operating_cash(candidates: Column, change: Column, investing: Column, financing: Column, fx: Column, slack: int = 1) -> Column:
    """O6.20: the only candidate that closes the cash identity, with or without the exchange effect."""
    target = change - investing - financing
    fits = F.array_distinct(F.filter(candidates, lambda v: (F.abs(v - target) <= slack) | (F.abs(v - target + F.coalesce(fx, F.lit(0))) <= slack)))
    return F.when(F.size(fits) == 1, F.get(fits, F.lit(0)))


def signed_tax(ebt: Column, tax: Column, net: Column, slack: int = 2) -> Column:
    """O6.21: the tax with the sign that closes EBT - tax = net income, if only one does."""
    plain, flipped = F.abs(ebt - tax - net) <= slack, F.abs(ebt + tax - net) <= slack
    return F.when(flipped & ~plain, -tax).otherwise(tax)


def net_income_fallback(net: Column, controlling: Column, noncontrolling: Column, n_candidates: Column) -> Column:
    """O6.22: controlling + noncontrolling (0) only if net income has no candidate at all."""
    return F.coalesce(net, F.when(n_candidates == 0, controlling + F.coalesce(noncontrolling, F.lit(0))))


def with_basis_fallback(rows: DataFrame, keys: Keys, wanted: Sequence[str], printed: Column, year: str = "fy", until: int = 2015) -> DataFrame:
    """O6.23: a basis without rows copies the other one's: always before ``until``, later only with printed evidence."""
    have = rows.select(*keys, "basis").distinct()
    other = F.when(F.col("basis") == wanted[0], wanted[1]).otherwise(wanted[0])
    copies = rows.withColumn("basis", other).join(have, [*keys, "basis"], "left_anti").where((F.col(year) < until) | F.coalesce(printed, F.lit(False)))
    return rows.withColumn("copied", F.lit(False)).unionByName(copies.withColumn("copied", F.lit(True)))


def to_columns(facts: DataFrame, keys: Keys, columns: dict[str, Sequence[str]]) -> DataFrame:
    """O6.24: canonical accounts to wide columns; of several accounts the first with a value wins. One aggregation, no pivot job."""
    code = lambda c: F.max(F.when(F.col("code") == c, F.col("value")))
    return facts.groupBy(*keys).agg(*(F.coalesce(*map(code, codes)).alias(name) for name, codes in columns.items()))


def additive_columns() -> dict[str, Column]:
    """O6.25-O6.30 over a wide row; NULL parts count as 0, and no part at all gives NULL."""
    part = lambda *names: F.when(F.coalesce(*names).isNotNull(), sum((filled(n) for n in names[1:]), filled(names[0])))
    capex = F.abs(filled("capex_tangible")) + F.abs(filled("capex_intangible"))
    da = lambda p: F.coalesce(part(f"{p}_dep", f"{p}_amort"), F.col(f"{p}_combined"))
    debt = part("short_borrowings", "current_portion", "bonds_short")
    long = part("long_borrowings", "bonds_long")
    fits = F.coalesce((num("total_liabilities") <= 0) | (filled(debt) + filled(long) <= 1.05 * num("total_liabilities")), F.lit(True))
    return {
        "cash": F.when(F.col("has_combined_caption"), F.col("cash_base") + filled("deposits")).otherwise(F.col("cash_base")),
        "capex": F.when(capex > 0, -capex),
        "da_total": F.coalesce(da("cf"), da("is")),
        "short_term_debt": F.when(fits, debt),
        "long_term_debt": F.when(fits, long),
        "lease_liabilities": F.when(F.coalesce("lease_short", "lease_long").isNotNull(), F.abs(filled("lease_short")) + F.abs(filled("lease_long"))),
        "revenue": F.coalesce(F.col("revenue"), F.abs("cogs") + F.col("gross_profit"), F.when(F.abs("insurance_revenue") >= F.abs(filled("interest_revenue")), F.col("insurance_revenue"))),
    }


#: O6.31: subtotals that make up revenue where an industry prints none, and the label that proves the profile.
INDUSTRIES = {"65": ("insurance", "premium"), "64": ("bank", "interest income"), "66": ("securities", "fee income")}


def industry_revenue(lines: DataFrame, keys: Keys, sector: str) -> DataFrame:
    """O6.31: by sector prefix and signature label, the sum of the profile's subtotals, else operating income + |SG&A|."""
    out = lines.groupBy(*keys, sector).agg(*(F.bool_or(F.lower("label").contains(sign)).alias(f"__has_{k}") for k, (_, sign) in INDUSTRIES.items()), *(F.sum(F.when((F.col("profile") == name) & F.col("is_subtotal"), F.col("value"))).alias(f"__sum_{k}") for k, (name, _) in INDUSTRIES.items()), F.max(F.when(F.col("label") == "operating income", F.col("value"))).alias("__op"), F.max(F.when(F.col("label") == "sga", F.col("value"))).alias("__sga"))
    chosen = F.lit(None).cast("long")
    for k in INDUSTRIES:
        chosen = F.when((F.substring(sector, 1, 2) == k) & F.col(f"__has_{k}"), F.coalesce(F.col(f"__sum_{k}"), F.col("__op") + F.abs("__sga"))).otherwise(chosen)
    return out.select(*keys, chosen.alias("industry_revenue"))


def separate_net_income(basis: Column, controlling: Column, net: Column) -> Column:
    """O6.33: on the separate basis the controlling figure is net income."""
    return F.when(basis == "separate", net).otherwise(controlling)


def derived() -> dict[str, Column]:
    """O6.34: EBITDA needs depreciation above 0; net debt needs cash and one kind of debt."""
    return {
        "ebitda": F.when(F.col("da_total") > 0, F.col("operating_income") + F.col("da_total")),
        "fcf": F.col("cfo") - F.abs("capex"),
        "net_debt": F.when(F.coalesce("short_term_debt", "long_term_debt").isNotNull(), filled("short_term_debt") + filled("long_term_debt") - F.col("cash")),
    }


def debt_free(rows: DataFrame, lines: DataFrame, keys: Keys, pattern: str = r"(?i)borrow|debenture|bond|loan payable") -> DataFrame:
    """O6.35: net debt is -cash where nothing on the balance sheet or in notes is named like debt."""
    named = lines.where(F.col("label").rlike(pattern) & (filled("value") != 0)).select(*keys).distinct().withColumn("__debt", F.lit(True))
    out = rows.join(named, list(keys), "left")
    return out.withColumn("net_debt", F.coalesce("net_debt", F.when(F.col("__debt").isNull(), -F.col("cash")))).drop("__debt")


def unit_overrides(rows: DataFrame, overrides: DataFrame, keys: Keys) -> DataFrame:
    """O6.36: curated multipliers per cell, last of all; rounded half away from zero, with a mark."""
    out = rows.join(overrides.select(*keys, "multiplier"), list(keys), "left")
    return out.withColumns({"overridden": F.col("multiplier").isNotNull(), "value": F.coalesce(F.round(F.col("value") * F.col("multiplier")).cast("long"), F.col("value"))}).drop("multiplier")


def cross_year_grade(rows: DataFrame, keys: Keys, year: str, value: str, quality: str, floor: int = 10**9) -> DataFrame:
    """O6.38, R4: against the median of the *earlier* usable years: over 200 times or under a 200th is 3, 30 times 2. Medians below ``floor`` judge nothing."""
    w = over(keys, year).rowsBetween(Window.unboundedPreceding, -1)
    median = F.percentile(F.when((F.col(quality) < 3), F.abs(num(value))), 0.5).over(w)
    out = rows.withColumn("__m", median)
    ratio = F.when(F.col("__m") >= floor, F.abs(num(value)) / F.nullif(F.col("__m"), F.lit(0.0)))
    grade = F.when((ratio > 200) | (ratio < 1 / 200), 3).when(ratio > 30, 2).otherwise(1)
    return out.withColumn("cross_grade", F.greatest(F.col(quality), grade)).drop("__m")


def future_guard(period_end: Column, today: Column, quality: Column) -> Column:
    """O6.40."""
    return F.when(period_end > today, 3).otherwise(quality)


def share_count(rows: DataFrame, shares: DataFrame, keys: Keys, filing: str = "rcept") -> DataFrame:
    """O6.41: the filing's own share count, else the newest one of the same keys that has one."""
    own = shares.where(F.col("shares").isNotNull())
    newest = own.groupBy(*keys).agg(F.max_by("shares", filing).alias("__newest"))
    same = own.select(filing, F.col("shares").alias("__same")).dropDuplicates([filing])
    return rows.join(same, filing, "left").join(newest, list(keys), "left").withColumn("shares_out", F.coalesce("__same", "__newest")).drop("__same", "__newest")


def note_depreciation(cells: DataFrame, keys: Keys, topics: Sequence[str]) -> DataFrame:
    """O6.43: sums per table over depreciation labels, the first topic in order that has one, its largest table."""
    place = F.array_position(F.array(*map(F.lit, topics)), F.col("topic"))
    sums = cells.where((place > 0) & F.col("label").rlike("(?i)depreciation|amorti[sz]ation")).groupBy(*keys, "topic", "table_seq").agg(F.sum("value").alias("total"))
    w = over(keys, place, F.abs("total").desc(), "table_seq")
    return sums.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def one_off_totals(cells: DataFrame, keys: Keys, patterns: dict[str, str]) -> DataFrame:
    """O6.45: sizes of matching lines of the income statement; notes only for items it lacks, and of them the first table."""
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(list(patterns.items())):
        kind = F.when(F.col("label").rlike(pattern), name).otherwise(kind)
    rows = cells.withColumn("item", kind).where("item IS NOT NULL")
    body = rows.where("source = 'IS'").groupBy(*keys, "item").agg(F.sum(F.abs("value")).alias("total"))
    notes = rows.where("source = 'note'").groupBy(*keys, "item", "table_seq").agg(F.sum(F.abs("value")).alias("total"))
    first = top_n(notes, [*keys, "item"], [F.col("table_seq")]).drop("table_seq")
    return body.unionByName(first.join(body, [*keys, "item"], "left_anti"))


def merged_metrics(rows: DataFrame, keys: Keys, item: Keys, order: str, value: str) -> DataFrame:
    """O6.46: items are told apart by their occurrence within a filing; a later filing overrides, what it lacks stays."""
    nth = F.row_number().over(over([*keys, *item, "seq"], order))
    return rows.withColumn("occurrence", nth).groupBy(*keys, *item, "occurrence").agg(F.max_by(value, "seq").alias(value), F.max("seq").alias("seq"))


def source_tiers(html: DataFrame, pdf: DataFrame, keys: Keys, slack: float = 0.001) -> DataFrame:
    """O6.48: T1 the totals of both sources agree, T2 neither has any, T3 they differ or only one has them; which one to adopt."""
    total = lambda df, name: df.groupBy(*keys).agg(F.sum("value").alias(name), F.count("value").alias(f"n_{name}"))
    both = total(html, "html").join(total(pdf, "pdf"), list(keys), "full")
    h, p = F.col("html"), F.col("pdf")
    same = F.abs(h - p) <= slack * F.greatest(F.abs(h), F.abs(p))
    tier = F.when(h.isNull() & p.isNull(), "T2").when(F.coalesce(same, F.lit(False)), "T1").otherwise("T3")
    return both.withColumn("tier", tier).withColumn("adopt", F.when(F.col("tier") == "T1", F.when(F.col("n_html") >= F.col("n_pdf"), "html").otherwise("pdf")).when((F.col("tier") == "T3") & p.isNull(), "html").when((F.col("tier") == "T3") & h.isNull(), "pdf"))


def solved_signs(opening: int, moves: list[int], closing: int, free: list[bool], limit: int = 12) -> list[int] | None:
    """O6.49: the only choice of signs for the free moves that makes opening + moves = closing; None if none or several do, or over ``limit`` are free."""
    places = [k for k, f in enumerate(free) if f and moves[k]]
    if len(places) > limit:
        return None
    found = None
    for signs in product((1, -1), repeat=len(places)):
        tried = list(moves)
        for k, s in zip(places, signs, strict=True):
            tried[k] = s * abs(moves[k])
        if opening + sum(tried) == closing:
            if found is not None:
                return None
            found = tried
    return found


def repaired_equity(cells: DataFrame, keys: Keys, order: str) -> DataFrame:
    """O6.49 per equity column: rows of role open, move or close in order; ``unmarked`` moves may change sign."""
    schema = T.StructType([*cells.schema.fields, T.StructField("fixed", T.LongType())])

    def repair(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        pdf["fixed"] = pdf["value"]
        start = None
        rows = list(pdf.index)
        for at, index in enumerate(rows):
            role = pdf.at[index, "role"]
            if role == "open":
                start = at
            elif role == "close" and start is not None:
                inner = rows[start + 1 : at]
                moves = [int(pdf.at[k, "value"]) for k in inner]
                found = solved_signs(int(pdf.at[rows[start], "value"]), moves, int(pdf.at[index, "value"]), [bool(pdf.at[k, "unmarked"]) for k in inner])
                for k, v in zip(inner, found or moves, strict=True):
                    pdf.at[k, "fixed"] = v
                start = None
        return pdf

    return cells.groupBy(*keys).applyInPandas(repair, schema)


def outflow_signs(sections: DataFrame) -> DataFrame:
    """O6.50: whether the positive children of an outflow section change sign.

    A row per section: ``total`` of its children, their number and how many are positive,
    ``header`` (its own printed amount), ``activity`` and ``inflow`` (the parent's total and the
    sibling inflow section), ``unit``. They flip if header = -sum, header = +sum or activity =
    inflow - sum holds and no identity supports the printed signs; within max(1000, unit x n).
    """
    slack = F.greatest(F.lit(1000), F.col("unit") * F.col("n"))
    near = lambda a, b: F.coalesce(F.abs(a - b) <= slack, F.lit(False))
    s, h, t, i = F.col("total"), F.col("header"), F.col("activity"), F.col("inflow")
    minus, plus = near(t, i - s), near(t, i + s)
    outward = ((h < 0) & near(s, -h)) | ((h > 0) & near(s, h)) | (minus & ~plus)
    printed = ((h < 0) & near(s, h)) | (plus & ~minus)
    return sections.withColumn("flip", F.coalesce(outward, F.lit(False)) & ~F.coalesce(printed, F.lit(False)) & (F.col("n_positive") > 0))


def filled_from_next(have: DataFrame, comparatives: DataFrame, keys: Keys, year: str, listed: Column) -> DataFrame:
    """O6.51: statements that are missing, from the comparative column of the next year's filing of listed companies."""
    donor = comparatives.where(listed & (F.col("filing_year") == F.col(year) + 1))
    return donor.join(have.select(*keys, year, "statement").distinct(), [*keys, year, "statement"], "left_anti")


def period_columns(tables: DataFrame, keys: Keys, order: str, least: int = 3, alike: float = 0.6) -> DataFrame:
    """O6.44: neighbouring tables whose label sets overlap (Jaccard) are one table's periods in order: group and place of each."""
    w = over(keys, order)
    before = F.lag("labels").over(w)
    both, any_ = F.size(F.array_intersect("labels", before)), F.size(F.array_union("labels", before))
    same = (F.size("labels") >= least) & (F.size(before) >= least) & (both / F.nullif(any_, F.lit(0)) >= alike)
    start = F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)
    grouped = tables.withColumn("__start", start).withColumn("period_group", F.sum("__start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.withColumn("period_place", F.row_number().over(over([*keys, "period_group"], order))).drop("__start")


def prior_tables(meta: DataFrame, keys: Keys) -> DataFrame:
    """O2.13: tables after the first whose printed term number is below the first one's."""
    term = F.regexp_extract(F.col("caption"), "제\\s*([0-9]+)\\s*기", 1).try_cast("int")
    numbered = meta.withColumn("__term", term)
    first = numbered.groupBy(*keys).agg(F.min_by(F.struct("__term", "table_seq"), "table_seq").alias("__f"))
    return numbered.join(first, list(keys)).where((F.col("table_seq") > F.col("__f.table_seq")) & (F.col("__term") < F.col("__f.__term"))).drop("__f", "__term")


#: O6.10c: words that only say which sign a line may have.
SIGN_WORDS = r"(?i)\s*\((?:loss|decrease|outflow|손실|감소|유출)\)|\b(?:gain|loss|increase|decrease)\b|(?:이익|손실|증가|감소)(?=\s|$)"


def relabelled(old: DataFrame, new: DataFrame, keys: Keys) -> DataFrame:
    """O6.10a, c: cells of ``old`` that the later filing prints under another label: (keys, label, new_label, how).

    position: same place, amount and track, another label, whose account the old filing doesn't
    print with another value; sign word: labels that differ by sign words only, one on each side,
    with values of one sign. Both sides have label, code, place, track, value.
    """
    a = old.select(*keys, "place", "track", "value", F.col("label").alias("label"))
    b = new.select(*keys, "place", "track", "value", F.col("label").alias("new_label"), "code")
    moved = a.join(b, [*keys, "place", "track", "value"]).where(F.col("label") != F.col("new_label"))
    printed = old.select(*keys, "code", F.col("value").alias("__other"))
    clash = moved.join(printed, [*keys, "code"]).where(F.col("__other") != F.col("value")).select(*keys, "place").distinct()
    by_place = moved.join(clash, [*keys, "place"], "left_anti").select(*keys, "label", "new_label", F.lit("position").alias("how"))
    bare = lambda c: F.trim(F.regexp_replace(c, SIGN_WORDS, ""))
    single = lambda df, name: df.groupBy(*keys, bare("label").alias("__bare")).agg(F.count(F.lit(1)).alias("__n"), F.max("label").alias(name), F.max("value").alias(f"__v_{name}")).where("__n = 1").drop("__n")
    by_word = single(old, "label").join(single(new, "new_label"), [*keys, "__bare"]).where((F.col("label") != F.col("new_label")) & (F.sign("__v_label") == F.sign("__v_new_label"))).select(*keys, "label", "new_label", F.lit("sign word").alias("how"))
    return by_place.unionByName(by_word.join(by_place.select(*keys, "label"), [*keys, "label"], "left_anti"))


def aligned_restatements(old: list[tuple[str, int]], new: list[tuple[str, int]], least: int = 5, share: float = 0.5, run: int = 3) -> dict[int, int]:
    """O6.10b: (account, value) sequences aligned by their longest common parts: old place -> new value of replaced runs.

    Needs ``least`` rows, ``share`` of them equal, and runs of at most ``run`` rows of equal length.
    """
    from difflib import SequenceMatcher

    if min(len(old), len(new)) < least:
        return {}
    match = SequenceMatcher(None, [a for a, _ in old], [a for a, _ in new], autojunk=False)
    steps = match.get_opcodes()
    if sum(j - i for tag, i, j, _, _ in steps if tag == "equal") < share * max(len(old), len(new)):
        return {}
    return {i + k: new[m + k][1] for tag, i, j, m, n in steps if tag == "replace" and j - i == n - m <= run for k in range(j - i)}


def restated(cells: DataFrame, keys: Keys) -> DataFrame:
    """O6.10b per statement: ``cells`` holds the old and new filing (``version`` 0 and 1) with place, code and value; gives the old cells with the value they take."""
    schema = T.StructType([*cells.schema.fields, T.StructField("restated", T.LongType())])

    def align(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["version", "place"])
        old, new = pdf[pdf["version"] == 0].copy(), pdf[pdf["version"] == 1]
        taken = aligned_restatements(list(zip(old["code"], old["value"], strict=True)), list(zip(new["code"], new["value"], strict=True)))
        old["restated"] = [taken.get(k, v) for k, v in enumerate(old["value"])]
        return old

    return cells.groupBy(*keys).applyInPandas(align, schema)
