"""Sources, sinks and streams."""


from pyspark.sql import functions as F

from quantloom import schemas
from quantloom.sources import readers, writers
from quantloom.streaming import micro_batches as mb

SF = "/root/testdata/sf0.001"


def test_sources(spark, tmp_path):
    (tmp_path / "list.json").write_text('{"rcept": "1", "corp_code": "c", "title": "[정정]분기보고서 (2023.09)", "filed_at": "2023-11-14 10:00:00"}\nbroken\n')
    good, bad = readers.disclosure_list(spark, f"file://{tmp_path}/list.json")
    r = good.collect()
    assert [x.line for x in bad.collect()] == ["broken"]
    assert [(x.rcept, x.filing_type, x.close_year, x.close_month, x.is_amendment) for x in r] == [("1", "Q", 2023, 9, True)]
    (tmp_path / "q.csv").write_text("code,day,open,high,low,close,volume\na,2024-01-02,0,5,4,5,0\nb,2024-01-02,1,1,1,0,9\n")
    assert [tuple(x)[2:] for x in readers.quotes(spark, f"file://{tmp_path}/q.csv").collect()] == [(None, 5, 4, 5, 0)]
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "f.html").write_text("<table><tr><th>Item<th>Now</tr><tr><td>1. Cash (Note 3)<td>(1,234)</tr></table>")
    c = readers.filing_documents(spark, f"file://{docs}").collect()
    assert [(x.label, x.header, x.value) for x in c] == [("Cash", "Now", -1234)]


def test_sinks(spark, tmp_path):
    at = f"file://{tmp_path}/t"
    writers.overwrite_partitions(spark.createDataFrame([(2020, 1), (2021, 2)], "fy int, v int"), at, ["fy"])
    writers.overwrite_partitions(spark.createDataFrame([(2021, 9)], "fy int, v int"), at, ["fy"])
    assert sorted((r.fy, r.v) for r in spark.read.parquet(at).collect()) == [(2020, 1), (2021, 9)]
    presets = writers.Presets(spark, f"file://{tmp_path}/presets")
    presets.save("mine", {"roe": "> 10%"})
    assert presets.load("mine") == {"roe": "> 10%"}
    writers.csv(spark.createDataFrame([("é", 1)], "a string, b int"), f"file://{tmp_path}/csv")
    assert spark.read.option("header", "true").csv(f"file://{tmp_path}/csv").first().a == "é"
    lines = spark.createDataFrame([("1", "BS", 0, 1, 1, "Cash", 5)], "rcept string, statement string, table_seq int, row_order int, depth int, label string, value long")
    writers.review_csv(lines, f"file://{tmp_path}/review")
    assert spark.read.option("header", "true").option("ignoreLeadingWhiteSpace", "false").csv(f"file://{tmp_path}/review").first().label == "  Cash"
    kept = writers.Snapshots()
    first = kept.get("a", "1", lambda: spark.range(1))
    assert kept.get("a", "1", lambda: None) is first and kept.get("a", "2", lambda: spark.range(2)).count() == 2


def test_declared_schemas():
    assert "revenue" in schemas.STANDARD.names and schemas.LINES["value"].dataType.simpleString() == "bigint"


def feed(spark, folder, rows, n):
    spark.createDataFrame(rows, "k string, seq long, v long").coalesce(1).write.mode("append").parquet(f"file://{folder}/in")


def test_upsert_stream_resumes_and_repeats(spark, tmp_path):
    schema = "k string, seq long, v long"
    table = mb.Versions(spark, f"file://{tmp_path}/table", spark.createDataFrame([], "k string, v long").schema)
    run = lambda: mb.run(mb.files(spark, f"file://{tmp_path}/in", schema).select("k", "seq", "v"), mb.upserting(table, ["k"], ["v"]), f"file://{tmp_path}/log").awaitTermination()
    feed(spark, tmp_path, [("a", 1, 10), ("a", 2, 11), ("b", 1, 20)], 1)
    run()
    assert sorted(map(tuple, table.read().collect())) == [("a", 11), ("b", 20)]
    feed(spark, tmp_path, [("b", 5, None), ("c", 1, 30)], 2)
    run()
    run()  # nothing new
    assert sorted(map(tuple, table.read().collect())) == [("a", 11), ("b", 20), ("c", 30)]
    again = spark.createDataFrame([("b", 5, None), ("c", 1, 30)], schema)
    mb.upserting(table, ["k"], ["v"])(again, 1)  # the same batch once more
    assert table.read().count() == 3


def test_changes_are_logged_once(spark, tmp_path):
    hashes = mb.Versions(spark, f"file://{tmp_path}/h", spark.createDataFrame([], "k string, scope string, content_hash string").schema)
    log = mb.Versions(spark, f"file://{tmp_path}/c", spark.createDataFrame([], "k string, scope string, change string, batch long").schema)
    each = mb.capturing(hashes, log, ["k"], "scope", F.col("line"))
    make = lambda *r: spark.createDataFrame(r, "k string, scope string, line string")
    each(make(("a", "BS", "x"), ("a", "IS", "y")), 0)
    each(make(("a", "BS", "x"), ("a", "IS", "z")), 1)
    assert sorted((r.scope, r.change, r.batch) for r in log.read().collect()) == [("BS", "added", 0), ("IS", "added", 0), ("IS", "changed", 1)]


def test_event_time(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    stream = mb.files(spark, SF, events.schema, glob="events.parquet")

    def collected(df, mode, name):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"file://{tmp_path}/{name}").trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.table(name).collect()

    sliding = collected(mb.windowed(stream, "ts", "2 hours", "1 hour"), "complete", "sliding")
    assert sum(r.n for r in sliding) == 2 * events.count()
    assert len(collected(mb.without_repeats(stream, "ts", ["user_id"], "60 days"), "append", "firsts")) == events.select("user_id").distinct().count()
    states = {r.key: r.status for r in collected(mb.slot_states(stream, "user_id"), "update", "states")}
    wanted = {}
    for r in events.orderBy("event_id").collect():
        wanted[str(r.user_id)] = {"purchase": "passed", "error": "pending"}.get(r.event_type, wanted.get(str(r.user_id), "pending"))
    assert states == wanted
