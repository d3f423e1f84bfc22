"""Edge cases on hand-made frames: NULL, zero, single rows, ties, holes."""

import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F

from quantloom.functions import metrics, nullsafe
from quantloom.operators import aggregates, checks, grids, joins, periods, standardize, windows
from quantloom.plans import market, reads, screen

D = datetime.date


def rows(df):
    return [tuple(r) for r in df.collect()]


def value(spark, column, ddl="x int", data=((1,),)):
    return spark.createDataFrame(data, ddl).select(column).first()[0]


def test_null_rules(spark):
    n = F.lit(None).cast("double")
    one = lambda c: value(spark, c)
    assert one(nullsafe.safe_div(F.lit(1), F.lit(0))) is None and one(nullsafe.safe_div(n, F.lit(2))) is None
    assert one(nullsafe.growth(F.lit(5), F.lit(-10))) == 1.5 and one(nullsafe.growth(F.lit(5), F.lit(0))) is None
    assert one(nullsafe.cagr(F.lit(-1), F.lit(4), 2)) is None and one(nullsafe.cagr(F.lit(1), F.lit(4), 2)) == 1.0
    assert one(nullsafe.mean_of(n, F.lit(3.0))) == 3.0 and one(nullsafe.mean_of(n, n)) is None
    assert one(nullsafe.first_nonzero(F.lit(0), F.lit(7))) == 7 and one(nullsafe.first_nonzero(F.lit(0), F.lit(None).cast("int"))) is None
    assert one(nullsafe.turn(F.lit(0), F.lit(-1))) == "turnaround" and one(nullsafe.turn(F.lit(-1), F.lit(0))) == "downturn" and one(nullsafe.turn(n, F.lit(-1))) is None
    assert one(nullsafe.truncated(F.lit(-1.9))) == -1


ITEMS = "revenue cogs gross_profit operating_income ebitda net_income ebt tax_expense interest_expense cfo capex da_total fcf total_assets current_assets current_liabilities total_liabilities total_equity controlling_equity receivables inventory trade_payables cash net_debt shares_out".split()


def statement(spark, **held):
    ddl = ", ".join(f"{c} long, p_{c} long" for c in ITEMS)
    return spark.createDataFrame([tuple(v for c in ITEMS for v in (held.get(c), held.get("p_" + c)))], ddl)


def test_ratios(spark):
    r = statement(spark, revenue=1000, gross_profit=300, operating_income=100, net_income=60, ebt=80, tax_expense=0, total_equity=500, p_total_equity=300, total_assets=900, capex=-50, da_total=0, interest_expense=0, cogs=700, p_revenue=800).select(*(c.alias(k) for k, c in metrics.ratios().items())).first()
    assert r.roe == 60 / 400 and r.roa == 60 / 900 and r.effective_tax_rate == 0 and r.nopat == 78  # a rate of 0 falls back to 22 %
    assert r.invested_capital == 500 and r.interest_coverage is None and r.capex_to_dep is None and r.dso == 0 and r.ccc == 0 and r.revenue_growth == 0.25
    assert all(v is None for v in statement(spark).select(*(c.alias(k) for k, c in metrics.ratios().items())).first())


def test_f_score_needs_five(spark):
    assert statement(spark, cfo=5, net_income=3, total_assets=10).select(metrics.f_score()).first()[0] is None
    full = {c: 10 for c in ITEMS} | {"p_" + c: 9 for c in ITEMS}
    assert statement(spark, **full).select(metrics.f_score()).first()[0] is not None


def test_conditions():
    assert screen.condition(">= 15%") == screen.Condition("gte", 0.15) and screen.condition("=3") == screen.Condition("eq", 3.0)
    for bad in ("15", "> x", "> 5 %%", ""):
        with pytest.raises(ValueError):
            screen.condition(bad)
    assert screen.threshold(15, "pct") == 0.15 and screen.threshold(2, "amount") == 2e8 and screen.effective_unit("x", "yoy") == "pct"


def test_missing_policy(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (1.0,)], "v double")
    c = screen.condition("> 0")
    assert [r[0] for r in df.select(screen.holds(F.col("v"), c)).collect()] == [False, False, True]
    assert [r[0] for r in df.select(screen.passes(F.col("v"), c, True)).collect()] == [True, True, True]


def test_order_of_nulls(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 9)], "k int, v int")
    order = lambda **a: [r.k for r in windows.ordered(df, "v", ties=["k"], **a).collect()]
    assert order(screen=True) == [2, 3, 1] and order() == [3, 1, 2] and order(descending=False) == [1, 3, 2]


def test_ranks_with_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 3.0), ("c", 1.0), ("d", None), ("e", float("nan"))], "k string, v double")
    assert {r.k: r.p for r in windows.rank_min(df, "v", "p").collect()} == {"a": 1, "b": 1, "c": 3, "d": None, "e": None}
    assert {r.k: r.p for r in windows.rank_min(df.withColumn("g", F.lit(1)), "v", "p", ["g"], False).collect()} == {"a": 2, "b": 2, "c": 1, "d": None, "e": None}


def test_positions_and_years_differ(spark):
    df = spark.createDataFrame([("c", 2020, 1), ("c", 2022, 3)], "k string, y int, v int")
    assert rows(windows.with_previous(df, ["k"], [F.col("y")], ["v"]).orderBy("y").select("p_v")) == [(None,), (1,)]
    assert rows(windows.with_year_before(df, ["k"], "y", ["v"]).orderBy("y").select("p_v")) == [(None,), (None,)]


def test_ttm_needs_four(spark):
    df = spark.createDataFrame([("c", q, None if q == 2 else q, 10 * q) for q in range(1, 6)], "k string, q int, f int, s int")
    assert rows(windows.ttm(df, ["k"], ["q"], ["f"]).orderBy("q").select("f", "s")) == [(None, 10), (None, 20), (None, 30), (8, 40), (12, 50)]


def asof_by_hand(left, right, strict=False):
    out = []
    for k, t in left:
        seen = [(rt, v) for rk, rt, v in right if rk == k and rt is not None and (rt < t if strict else rt <= t)]
        out.append((k, t, *(max(seen) if seen else (None, None))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("sliced", [False, True])
def test_asof(spark, strict, sliced):
    random.seed(7)
    day = lambda: D(2020, 1, 1) + datetime.timedelta(random.randrange(900))
    left = [(random.choice("ab" if random.random() < 0.9 else "c"), day()) for _ in range(150)]
    right = list({(k, d): (k, d, i) for i, (k, d) in enumerate((random.choice("ab"), day()) for _ in range(40))}.values()) + [("a", None, 5)]
    out = joins.asof(spark.createDataFrame(left, "k string, t date"), spark.createDataFrame(right, "k string, rt date, v int"), ["k"], "t", "rt", ["v"], strict=strict, slice_by=F.year("__t") if sliced else None)
    assert sorted(rows(out), key=repr) == asof_by_hand(left, right, strict)


def test_nearest_date_ties_go_back(spark):
    left = spark.createDataFrame([("a", D(2020, 1, 10)), ("a", D(2021, 1, 1)), ("b", D(2020, 1, 1))], "k string, t date")
    right = spark.createDataFrame([("a", D(2020, 1, 8), 1), ("a", D(2020, 1, 12), 2), ("a", D(2021, 1, 7), 3)], "k string, d date, v int")
    assert sorted(rows(joins.nearest_date(left, right, ["k"], "t", "d", "v").select("k", "t", "v")), key=repr) == [("a", D(2020, 1, 10), 1), ("a", D(2021, 1, 1), 3), ("b", D(2020, 1, 1), None)]


def test_upsert_keeps_on_null(spark):
    old = spark.createDataFrame([(1, 10, 100), (2, 20, 200)], "k int, a int, b int")
    new = spark.createDataFrame([(1, None, None), (3, 30, 300)], "k int, a int, b int")
    assert sorted(rows(joins.upsert(old, new, ["k"], ["b"]))) == [(1, None, 100), (2, 20, 200), (3, 30, 300)]
    assert sorted(rows(joins.insert_absent(old, new, ["k"]))) == [(1, 10, 100), (2, 20, 200), (3, 30, 300)]


def test_weeks_end_on_sunday(spark):
    days = [("a", D(2024, 1, 1) + datetime.timedelta(k), k + 1, k + 2, k, None if k == 6 else k + 1, 10) for k in range(9)]
    out = aggregates.weekly(spark.createDataFrame(days, "k string, d date, o int, h int, l int, c int, v int"), ["k"], "d", "o", "h", "l", "c", "v", above=3)
    assert sorted(rows(out)) == [("a", D(2024, 1, 7), 1, 8, 0, 6, 70), ("a", D(2024, 1, 14), 8, 10, 7, 9, 20)]


def test_discrete_quarters(spark):
    """as_filed_5q: a missing half year, a lost flow, a year with one row."""
    data = [("c", 2023, "Q1", 10, 1, 1), ("c", 2023, "Q3", 45, 3, 1), ("c", 2023, "FY", 70, 4, 1), ("c", 2024, "Q1", None, 5, 1), ("c", 2024, "H1", 30, 6, 1), ("d", 2024, "FY", 9, 9, 3)]
    df = spark.createDataFrame(data, "k string, fy int, period string, f long, s long, q int")
    assert sorted(rows(periods.discrete_quarters(df, ["k"], "fy", "period", ["f"], ["s"], "q"))) == [("c", 2023, 1, 10, 1, 1), ("c", 2023, 4, 25, 4, 1)]
    two = df.withColumn("g", F.lit(1).cast("long") * F.col("s"))
    out = {(r.fy, r.quarter): (r.f, r.g, r.q) for r in periods.discrete_quarters(two, ["k"], "fy", "period", ["f", "g"], ["s"], "q").collect()}
    assert out[2024, 2] == (None, 1, 2)


def test_texts_of_time(spark):
    one = lambda c, s: value(spark, c, "s string", ((s,),))
    assert one(periods.printed_date("s"), "2023년 1월 5일") == "2023.01.05" and one(periods.printed_date("s"), "none") is None and one(periods.printed_date("s"), "20230105") == "2023.01.05"
    assert one(periods.tenure_years("s"), "3년 6개월") == 3.5 and one(periods.tenure_years("s"), "7") == 7 and one(periods.tenure_years("s"), "-") is None
    assert value(spark, periods.rebalance_day(F.lit(2020))) == D(2021, 5, 1)


def candidate(code, v, stage="exact", label="l", depth=1, total=False, current=False):
    return ("u", code, v, stage, label, depth, total, current)


def test_conflicts(spark):
    """One conflict of each kind."""
    data = [
        candidate("one", 5), candidate("stage", 5), candidate("stage", 6, "fuzzy"), candidate("current", 5, current=True), candidate("current", 7), candidate("total", 5, total=True), candidate("total", 7),
        candidate("near", 100000), candidate("near", 100050), candidate("zero", 0), candidate("zero", 8), candidate("path", 5, depth=1), candidate("path", 9, depth=2), candidate("held", 5), candidate("held", 9),
        candidate("sum", -5, label="a"), candidate("sum", 7, label="b"), candidate("sum", 7, label="b"), candidate("pair", 5), candidate("pair", 6, "fuzzy"), candidate("signs", 100), candidate("signs", -100),
    ]
    df = spark.createDataFrame(data, "u string, code string, value long, stage string, label string, depth int, is_total boolean, is_current boolean")
    got = {r.code: (r.value, r.how) for r in standardize.resolved(df, ["u"], ["sum"], ["pair"]).collect()}
    assert got == {"one": (5, "single"), "stage": (5, "stage"), "current": (5, "current"), "total": (5, "total"), "near": (100050, "near"), "zero": (8, "nonzero"), "path": (5, "shallow"), "held": (None, "held"), "sum": (12, "sum"), "pair": (None, "held"), "signs": (None, "held")}


def test_sign_search():
    random.seed(1)
    for _ in range(200):
        moves = [random.randint(-9, 9) for _ in range(5)]
        free = [random.random() < 0.6 for _ in moves]
        close = 20 + sum(random.choice((1, -1)) * abs(m) if f else m for m, f in zip(moves, free, strict=True))
        fits = {t for t in itertools.product(*(((abs(m), -abs(m)) if f and m else (m,)) for m, f in zip(moves, free, strict=True))) if 20 + sum(t) == close}
        got = standardize.solved_signs(20, moves, close, free)
        assert got == (list(next(iter(fits))) if len(fits) == 1 else None)
    assert standardize.solved_signs(0, [1] * 13, 13, [True] * 13) is None


def test_equity_repair(spark):
    data = [("a", 1, "open", 10, False), ("a", 2, "move", 4, True), ("a", 3, "move", 3, False), ("a", 4, "close", 9, False), ("a", 5, "move", 2, True)]
    out = standardize.repaired_equity(spark.createDataFrame(data, "k string, o int, role string, value long, unmarked boolean"), ["k"], "o")
    assert [r.fixed for r in out.orderBy("o").collect()] == [10, -4, 3, 9, 2]


def test_restatements():
    old = [("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 5)]
    assert standardize.aligned_restatements(old, [("a", 1), ("x", 9), ("c", 3), ("d", 4), ("e", 5)]) == {1: 9}
    assert standardize.aligned_restatements(old[:4], old[:4]) == {} and standardize.aligned_restatements(old, [(c + "!", v) for c, v in old]) == {}


def test_amendments(spark):
    """amend_chain: equal, changed, new and untouched cells over three filings."""
    data = [("u", "a", 1, 10), ("u", "a", 2, 10), ("u", "a", 3, 12), ("u", "b", 1, 5), ("u", "c", 2, 7), ("u", "d", 1, None), ("u", "d", 3, 4)]
    out = {r.cell: (r.value, list(r.amend_chain), r.amended) for r in standardize.merged(spark.createDataFrame(data, "u string, cell string, seq int, value long"), ["u"], ["cell"], "value").collect()}
    assert out == {"a": (12, [3], True), "b": (5, [], False), "c": (7, [], False), "d": (4, [3], True)}


def test_spans_fill_the_grid():
    assert grids.tables_of("<table><tr><th rowspan=2>a<th colspan=2>b</tr><tr><td>c<td>d</tr><tr><td>e</table>") == [[["a", "b", "b"], ["a", "c", "d"], ["e", "", ""]]]
    assert grids.tables_of(None) == [] and grids.tables_of("<table></table>") == [[]]
    assert grids.expanded([[("x", 3, 1), ("y", 1, 1)], [("z", 2, 2)], []]) == [["x", "y", ""], ["x", "z", "z"], ["x", "z", "z"]]


def test_paths(spark):
    data = [("t", k, label, indent) for k, (label, indent) in enumerate([("A", 0), ("B", 2), ("C", 4), ("D", 2), ("E", 0), ("F", 0)])]
    df = spark.createDataFrame(data, "t string, o int, label string, indent int")
    assert [(r.path, r.depth) for r in grids.with_paths(df, ["t"], "o", "label", "indent").orderBy("o").collect()] == [("", 0), ("A", 1), ("A>B", 2), ("A", 1), ("", 0), ("", 0)]
    assert [r.r for r in df.withColumn("r", grids.node_role(["t"], "o", "indent")).orderBy("o").collect()] == ["P", "P", "S", "S", "F", "S"]


def test_paths_of_many_tables_in_one_pass(spark):
    """No Python call a table; stacks go over batches; null labels and null keys are rows like others."""
    rng = random.Random(8)
    data = [(t or None, k, rng.choice(("A", "B", "C", None)), rng.choice((0, 1, 2, 3, None))) for t in range(40) for k in range(rng.choice((1, 5, 30)))]
    wanted, stack = [], []
    for t, k, label, indent in data:
        stack = stack if k else []
        while stack and None not in (indent, stack[-1][0]) and stack[-1][0] >= indent:
            stack.pop()
        wanted.append((t or 0, k, ">".join(n for _, n in stack), len(stack)))
        stack.append((indent, label or ""))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = grids.with_paths(spark.createDataFrame(data, "t int, o int, label string, indent int").repartition(3), ["t"], "o", "label", "indent")
        assert sorted((r.t or 0, r.o, r.path, r.depth) for r in got.collect()) == wanted
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got.columns == ["t", "o", "label", "indent", "path", "depth"] and "FlatMapGroups" not in got._jdf.queryExecution().executedPlan().toString()


def test_assertion_runner(spark):
    df = spark.createDataFrame([(1,), (-1,)], "x int")
    tests = [checks.Assertion("bad", "ERROR", lambda t: t["r"].where("x < 0")), checks.Assertion("ok", "WARN", lambda t: t["r"].where("x > 5")), checks.Assertion("broken", "ERROR", lambda t: t["none"])]
    out, ok = checks.run(spark, tests, {"r": df})
    assert ok is False and [tuple(r) for r in out.collect()] == [("bad", "ERROR", "FAIL", 1, None), ("ok", "WARN", "PASS", 0, None), ("broken", "ERROR", "SKIP", None, "no table 'none'")]
    crash = checks.Assertion("crash", "ERROR", lambda t: t["r"].where("no_such_column > 1"))
    out, ok = checks.run(spark, [tests[1], crash], {"r": df})
    assert ok is None and out.where("status = 'BROKEN'").first().reason.startswith("AnalysisException")
    assert checks.run(spark, [tests[1]], {"r": df})[1] is True


def test_quotes_and_registry(spark):
    q = spark.createDataFrame([("a", 0, 5, 5, 5, 0), ("b", 0, 0, 3, 0, 0)], "code string, open long, high long, low long, close long, volume long")
    assert rows(market.clean_quotes(q)) == [("a", None, 5, 5, 5, 0)]
    state = spark.createDataFrame([("a", "listed", D(2020, 1, 1), True), ("b", "delisted", D(2020, 1, 1), True)], "code string, status string, since date, signal boolean")
    on = state.where("code = 'b'")
    out = {r.code: (r.status, r.action) for r in market.delisting(state, on, on.where("false"), F.lit(D(2020, 6, 1)), F.lit(True)).collect()}
    assert out == {"a": ("candidate", "candidate"), "b": ("listed", "reinstate")}
    assert {r.action for r in market.delisting(state, on, on, F.lit(D(2020, 6, 1)), F.lit(False)).collect()} == {"skip"}


def test_derived_messages(spark):
    df = spark.createDataFrame([(1, 2)], "k int, a int")
    with pytest.raises(ValueError):
        reads.derived_series(df, ["k"], [F.col("k")], "ratio", "a")
    with pytest.raises(ValueError):
        reads.derived_series(df, ["k"], [F.col("k")], "cube", "a")


def test_leases(spark):
    """Against plain code, in time order whatever the order of rows."""
    import random

    from quantloom.streaming import micro_batches as mb

    random.seed(4)
    events = [(k % 7, 1000 * 3600 * random.randint(0, 60), k, random.choice(["view", "view", "purchase", "error", "click", "other"])) for k in range(300)]
    df = spark.createDataFrame(events, "slot int, ms long, seq long, kind string").selectExpr("slot", "timestamp_millis(ms) AS at", "seq", "kind").repartition(5)
    got = {r.slot: (r.status, r.attempts) for r in mb.lease_states(df, "slot", "at", "seq", "kind").collect()}
    for slot in range(7):
        status, attempts, until = "pending", 0, 0
        for _, ms, _, kind in sorted((e for e in events if e[0] == slot), key=lambda e: (e[1], e[2])):
            hours = ms / 3600_000
            if status == "leased" and hours > until:
                status = "pending" if attempts < 3 else "dead"
            if (status, kind) == ("pending", "view"):
                status, attempts, until = "leased", attempts + 1, hours + 6
            elif (status, kind) == ("leased", "click"):
                until = hours + 6
            elif (status, kind) == ("leased", "purchase"):
                status = "done"
            elif (status, kind) == ("leased", "error"):
                status = "pending" if attempts < 3 else "dead"
        assert got[slot] == (status, attempts)


def test_long_spans_are_kept():
    html = "<table>" + "<tr><td rowspan=2000>a<td>0</tr>" + "".join(f"<tr><td>{k}</tr>" for k in range(1, 2500)) + "</table>"
    (grid,) = grids.tables_of(html)
    assert len(grid) == 2500 and grid[1999] == ["a", "1999"] and grid[2000] == ["2000", ""]
    assert len(grids.tables_of("<table><tr><td colspan=5000>x</table>")[0][0]) == 1000


def test_ranks_in_slices(spark):
    values = [None, float("nan"), 3.0, 3.0, -1.0, 7.5, 0.0] * 3 + [float(k) for k in range(300)]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double")
    known = [v for v in values if v is not None and v == v]
    for down in (True, False):
        got = {r.k: r.place for r in windows.rank_min(df, "v", "place", descending=down).collect()}
        assert got == {k: 1 + sum((x > v) if down else (x < v) for x in known) if v is not None and v == v else None for k, v in enumerate(values)}


def test_snapshots_have_a_cap_and_an_age(spark):
    from quantloom.sources import writers

    now = [0.0]
    kept = writers.Snapshots(most=2, seconds=10, clock=lambda: now[0])
    a = kept.get("a", "1", lambda: spark.range(1))
    kept.get("b", "1", lambda: spark.range(2))
    assert kept.get("a", "1", lambda: spark.range(9)) is a
    kept.get("c", "1", lambda: spark.range(3))  # "b" was used longest ago
    assert set(kept._held) == {"a", "c"}
    now[0] = 11.0
    assert kept.get("a", "1", lambda: spark.range(9)) is not a
    kept.clear()
