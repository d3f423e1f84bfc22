"""O10: assertions and audits. An assertion is a frame of violations; the runner counts them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.functions.nullsafe import num
from quantloom.operators.windows import Keys, over

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Assertion:
    name: str
    severity: str  # ERROR or WARN
    violations: Callable[[Tables], DataFrame]


def run(spark: SparkSession, assertions: Sequence[Assertion], tables: Tables) -> tuple[DataFrame, bool | None]:
    """(name, severity, status, n, reason) of each. Over all: False if an ERROR check has violations, None if one could not run, else True.

    A check whose tables are missing is SKIP, one that fails while it runs is BROKEN; both keep the
    reason. Only counts come to the driver.
    """
    out = []
    for a in assertions:
        try:
            n = a.violations(tables).count()
            out.append((a.name, a.severity, "PASS" if n == 0 else "FAIL", n, None))
        except KeyError as e:
            out.append((a.name, a.severity, "SKIP", None, f"no table {e}"))
        except Exception as e:  # noqa: BLE001  a broken check must not hide the others
            out.append((a.name, a.severity, "BROKEN", None, f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"[:500]))
    states = {status for _, severity, status, _, _ in out if severity == "ERROR"}
    ok = False if "FAIL" in states else None if states & {"SKIP", "BROKEN"} else True
    return spark.createDataFrame(out, "name string, severity string, status string, n long, reason string"), ok


def counts(assertions: Sequence[Assertion], tables: Tables) -> DataFrame:
    """(name, severity, n_violations) as one lazy plan."""
    rows = None
    for a in assertions:
        one = a.violations(tables).agg(F.count(F.lit(1)).alias("n_violations")).select(F.lit(a.name).alias("name"), F.lit(a.severity).alias("severity"), "n_violations")
        rows = one if rows is None else rows.unionByName(one)
    return rows


def row_assertions(today: Column) -> list[Assertion]:
    """O10.1, O10.4, O10.7, O10.9, O10.11: rules on single rows of ``rows``."""
    where = lambda name, severity, rule: Assertion(name, severity, lambda t: t["rows"].where(rule))
    return [
        where("future_period", "ERROR", (F.col("period_end") > today) & (F.col("data_quality") < 3)),
        where("impossible_shares", "ERROR", F.col("shares_out") > 10**11),
        where("impossible_cap", "ERROR", F.col("market_cap") > 5 * 10**18),
        where("assets_not_positive", "ERROR", F.col("total_assets") <= 0),
        where("assets_too_large", "WARN", F.col("total_assets") > 2 * 10**15),
        where("revenue_too_large", "WARN", F.abs("revenue") > 10**15),
        where("operating_equals_net", "WARN", (F.col("operating_income") == F.col("net_income")) & (F.col("operating_income") != 0)),
        where("balance_identity", "ERROR", F.abs(num("total_assets") - num("total_liabilities") - num("total_equity")) > 0.03 * F.abs(num("total_assets"))),
    ]


def stale_series(days: DataFrame, day: str, today: Column, least_rows: int = 100, days_back: int = 6) -> DataFrame:
    """O10.2: a row if the newest day with ``least_rows`` rows is older than ``days_back`` days."""
    full = days.groupBy(F.col(day).alias("day")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_rows)
    return full.agg(F.max("day").alias("newest")).where(F.col("newest").isNull() | (F.datediff(today, F.col("newest")) > days_back))


def orphans(rows: DataFrame, parents: DataFrame, keys: Keys) -> DataFrame:
    """O10.3, O10.16, O10.25: rows without a parent."""
    return rows.join(parents.select(*keys).distinct(), list(keys), "left_anti")


def incomplete_years(quarters: DataFrame, years: DataFrame, keys: Keys) -> DataFrame:
    """O10.3: calendar years that don't have four quarters."""
    held = quarters.groupBy(*keys, "cy").agg(F.count_distinct("cq").alias("n"))
    return years.join(held, [*keys, "cy"], "left").where(F.coalesce("n", F.lit(0)) < 4)


def attribution_excess(rows: DataFrame, share: float = 0.02, fixed: int = 10**6) -> DataFrame:
    """O10.13: the controlling part exceeds net income by more than 2 % and a million."""
    return rows.where(F.abs(F.col("controlling_ni")) > F.abs(F.col("net_income")) * (1 + share) + fixed)


def repeated_quarters(rows: DataFrame, keys: Keys, year: str, values: Keys) -> DataFrame:
    """O10.14: the first quarters of two neighbouring years are equal in every value, NULLs included."""
    later = rows.select(*keys, (F.col(year) - 1).alias(year), *(F.col(v).alias(f"__{v}") for v in values))
    same = F.lit(True)
    for v in values:
        same = same & F.col(v).eqNullSafe(F.col(f"__{v}"))
    return rows.join(later, [*keys, year]).where(same & F.col(values[0]).isNotNull()).drop(*(f"__{v}" for v in values))


def unit_marks(lines: DataFrame, label: str) -> DataFrame:
    """O10.15: column labels that still carry a unit."""
    return lines.where(F.regexp_replace(label, r"\s+", "").rlike("단위[:：]|[(](?:천|백만|억)?원[)]"))


def duplicates(rows: DataFrame, keys: Keys, live: Column) -> DataFrame:
    """O10.16, O4.20: keys with several rows of which at least one is live."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.bool_or(live).alias("any_live")).where((F.col("n") > 1) & F.col("any_live"))


def identities(rows: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """O10.17: the four printed identities: whether each holds within 0.5 %, NULL where a part is missing."""
    near = lambda a, b: F.abs(num(a) - b) <= tolerance * F.greatest(F.abs(num(a)), F.abs(b), F.lit(1.0))
    return rows.withColumns({
        "assets_ok": near("total_assets", num("total_liabilities") + num("total_equity")),
        "gross_ok": near("gross_profit", num("revenue") - num("cogs")),
        "operating_ok": near("operating_income", num("gross_profit") - num("sga")),
        "net_ok": near("net_income", num("ebt") - num("tax_expense")),
    })


def equity_breaks(rows: DataFrame, keys: Keys, year: str, times: float = 10.0) -> DataFrame:
    """O10.18: equity changes its sign or its size tenfold from the year before."""
    before = rows.select(*keys, (F.col(year) + 1).alias(year), F.col("total_equity").alias("p_total_equity"))
    a, b = num("total_equity"), num("p_total_equity")
    flip = F.sign(a) * F.sign(b) < 0
    jump = (b != 0) & ((F.abs(a) > times * F.abs(b)) | (F.abs(a) * times < F.abs(b)))
    return rows.join(before, [*keys, year]).where(flip | jump).withColumn("kind", F.when(flip, "sign").otherwise("jump"))


def self_checks(sums: DataFrame) -> DataFrame:
    """O10.19: PASS, FAIL or NA of each check of a statement; suspect if a blocking one fails, na if none has a result.

    A row per statement with its printed totals and ``unit``; tolerance is two display units.
    """
    slack = F.col("unit") * 2
    state = lambda ok: F.when(ok.isNull(), "NA").when(ok, "PASS").otherwise("FAIL")
    checks = {
        "balance": F.abs(F.col("total_assets") - F.col("total_liabilities") - F.col("total_equity")) <= slack,
        "cash": F.abs(F.col("cash_close") - F.col("cash_open") - F.col("cash_change")) <= slack,
        "current": F.abs(F.col("current_assets") + F.col("noncurrent_assets") - F.col("total_assets")) <= slack,
        "gross": F.abs(F.col("revenue") - F.abs("cogs") - F.col("gross_profit")) <= slack,
    }
    out = sums.withColumns({k: state(v) for k, v in checks.items()})
    any_fail = F.array_contains(F.array(*checks), "FAIL")
    any_pass = F.array_contains(F.array(*checks), "PASS")
    return out.withColumn("verdict", F.when(any_fail, "suspect").when(any_pass, "ok").otherwise("na"))


def anomaly(printed: Column, stored: Column) -> Column:
    """O10.20: SIGN, DIGIT_TRUNC (stored digits start the printed ones), DIGIT_EXTRA (the reverse) or OTHER; NULL if equal."""
    p, s = F.abs(printed).cast("string"), F.abs(stored).cast("string")
    return F.when(printed == stored, None).when(printed == -stored, "SIGN").when(p.startswith(s), "DIGIT_TRUNC").when(s.startswith(p), "DIGIT_EXTRA").when(printed.isNotNull() & stored.isNotNull(), "OTHER")


def equity_against_balance(sce: DataFrame, bs: DataFrame, keys: Keys, slack: int = 2) -> DataFrame:
    """O10.21: closing equity of the changes in equity against the balance sheet; several different closings exclude the statement."""
    closing = sce.groupBy(*keys).agg(F.count_distinct("closing").alias("n"), F.max("closing").alias("closing"))
    return closing.where("n = 1").join(bs, list(keys)).withColumn("agrees", F.abs(F.col("closing") - F.col("total_equity")) <= slack)


def roll_forward(cells: DataFrame, keys: Keys) -> DataFrame:
    """O10.22: opening + moves = closing for each column, subtotals left out; what explains a gap: sign, shift or nothing.

    sign: turning one move round closes the gap; shift: the gap is one move that was left out or counted twice.
    """
    move = F.when((F.col("role") == "move") & ~F.col("is_subtotal"), F.col("value"))
    out = cells.groupBy(*keys).agg(F.sum(F.when(F.col("role") == "open", F.col("value"))).alias("opening"), F.sum(move).alias("moves"), F.sum(F.when(F.col("role") == "close", F.col("value"))).alias("closing"), F.collect_set(move).alias("__each"))
    gap = F.col("opening") + F.coalesce("moves", F.lit(0)) - F.col("closing")
    why = F.when(gap == 0, "closed").when(F.array_contains("__each", (gap / 2).cast("long")) & (gap % 2 == 0), "sign").when(F.array_contains("__each", gap) | F.array_contains("__each", -gap), "shift").otherwise("open")
    return out.withColumns({"gap": gap, "why": why}).drop("__each")


def rounding_slack(n: Column, unit: Column) -> Column:
    """O10.23: half a unit for each of n rounded parts, one unit at least."""
    return F.greatest(F.lit(1), F.ceil(n / 2)).cast("long") * unit


def gate(fields: DataFrame, keys: Keys) -> DataFrame:
    """O10.24: pass if all fields pass; fail_a if a blocking one fails, fail_b if another does, else pending."""
    bad = lambda blocking: F.count_if((F.col("status") == "fail") & (F.col("blocking") == blocking)) > 0
    return fields.groupBy(*keys).agg(F.when(bad(True), "fail_a").when(bad(False), "fail_b").when(F.count_if(F.col("status") != "pass") == 0, "pass").otherwise("pending").alias("gate"), F.count(F.lit(1)).alias("n_fields"))


def gated(rows: DataFrame, audits: DataFrame, keys: Keys, verified: bool = False) -> DataFrame:
    """O2.14, O2.15: rows whose audit isn't fail_a, unaudited ones too; ``verified``: only those that pass."""
    out = rows.join(audits.select(*keys, "gate"), list(keys), "left")
    return out.where(F.col("gate") == "pass") if verified else out.where(F.coalesce("gate", F.lit("none")) != "fail_a")


def changed_scopes(before: DataFrame, after: DataFrame, keys: Keys, scope: str, digest: str) -> DataFrame:
    """O10.28, O12.6: scopes whose content hash appeared, went or changed."""
    b, a = before.select(*keys, scope, F.col(digest).alias("__b")), after.select(*keys, scope, F.col(digest).alias("__a"))
    both = b.join(a, [*keys, scope], "full").where(~F.col("__a").eqNullSafe(F.col("__b")))
    return both.select(*keys, scope, F.when(F.col("__b").isNull(), "added").when(F.col("__a").isNull(), "removed").otherwise("changed").alias("change"))


def slot_status(issues: DataFrame, keys: Keys) -> DataFrame:
    """O10.29: open if anything is open, done if all is done, else waiting."""
    return issues.groupBy(*keys).agg(F.count_if(F.col("state") == "open").alias("n_open"), F.count_if(F.col("state") == "done").alias("n_done"), F.count(F.lit(1)).alias("n")).withColumn("status", F.when(F.col("n_open") > 0, "open").when(F.col("n_done") == F.col("n"), "done").otherwise("waiting"))


def pattern_scan(rows: DataFrame, keys: Keys, text: str, rules: dict[str, str]) -> DataFrame:
    """O10.27: (keys, rule, evidence) for each rule a text matches; evidence is the first match."""
    found = F.array(*(F.when(F.col(text).rlike(p), F.struct(F.lit(n).alias("rule"), F.regexp_substr(text, F.lit(p)).alias("evidence"))) for n, p in rules.items()))
    return rows.select(*keys, F.inline(F.array_compact(found)))


def purge_stale(rows: DataFrame, current: DataFrame, keys: Keys, marks: Keys) -> DataFrame:
    """O2.16: rows whose fingerprint or reader version is no longer current go."""
    return rows.join(current.select(*keys, *marks), [*keys, *marks], "left_semi")


def repeats(rows: DataFrame, keys: Keys, order: str, value: str) -> DataFrame:
    """Rows that repeat the value before them in order."""
    w = over(keys, order)
    return rows.withColumn("__b", F.lag(value).over(w)).where(F.col(value).eqNullSafe(F.col("__b")) & F.col(value).isNotNull()).drop("__b")


def consolidated_below_half(rows: DataFrame, keys: Keys, basis: str, value: str, consolidated: str, separate: str) -> DataFrame:
    """O10.10: keys whose consolidated value is below half of the separate one, which is above 0."""
    of = lambda name: F.max(F.when(F.col(basis) == name, F.col(value)))
    both = rows.groupBy(*keys).agg(of(consolidated).alias("consolidated"), of(separate).alias("separate"))
    return both.where((F.col("separate") > 0) & (F.col("consolidated") * 2 < F.col("separate")))


def unit_nominations(rows: DataFrame, value: str, median: str, times: Sequence[int] = (1000, 1000000), slack: float = 0.2) -> DataFrame:
    """O10.26: rows whose value is about 1,000 or 1,000,000 times the neighbours' median, or a part of it: (..., factor)."""
    ratio = F.abs(num(value)) / F.nullif(F.abs(num(median)), F.lit(0.0))
    factor = F.lit(None).cast("double")
    for t in times:
        for f in (float(t), 1.0 / t):
            factor = F.when((ratio >= f * (1 - slack)) & (ratio <= f * (1 + slack)), F.lit(f)).otherwise(factor)
    return rows.withColumn("factor", factor).where(F.col("factor").isNotNull())
