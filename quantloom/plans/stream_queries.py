"""Queries of O12 and the event-time extension, each run to its end on the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.plans.catalog import query
from quantloom.plans.fundamentals import read
from quantloom.plans.tables import shared
from quantloom.streaming import micro_batches as mb


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = read(spark, sf_dir, "events").schema
    return mb.files(spark, sf_dir, schema, glob="events.parquet")


@query("x_tumbling_windows", "%window_start event_type #n", "SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def tumbling(spark, sf_dir):
    """Extension: hourly counts; batch and stream share the plan."""
    return mb.windowed(read(spark, sf_dir, "events"), "ts", "1 hour", keys=["event_type"])


@query("x_session_windows", "#user_id %session_start #n", "SELECT user_id, strftime(min(ts), '%Y-%m-%d %H') AS session_start, count(*) AS n FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 6 HOUR THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))) GROUP BY user_id, s")
def session(spark, sf_dir):
    """Extension: sessions that end after 6 hours of silence."""
    return mb.sessions(read(spark, sf_dir, "events"), "ts", "user_id", "6 hours").withColumn("session_start", F.date_format("session_start", "yyyy-MM-dd HH"))


@query("o12_03_stream_upsert", "#user_id #event_id event_type", "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def stream_upsert(spark, sf_dir):
    stream = _stream(spark, sf_dir).select("user_id", "event_id", "event_type", F.col("event_id").alias("seq"))
    table = mb.Versions(spark, shared(spark, "upsert"), stream.select("user_id", "event_id", "event_type").schema)
    keep = mb.upserting(table, ["user_id"])
    mb.run(stream, keep, shared(spark, "upsert-log")).awaitTermination()
    return table.read()


@query("o12_06_change_capture", "#user_id event_type content_hash", "SELECT user_id, event_type, md5(string_agg(event_id::VARCHAR, chr(10) ORDER BY event_id::VARCHAR)) AS content_hash FROM events GROUP BY 1, 2")
def change_capture(spark, sf_dir):
    stream = _stream(spark, sf_dir)
    hashes = mb.Versions(spark, shared(spark, "hashes"), spark.range(0).selectExpr("id AS user_id", "'' AS event_type", "'' AS content_hash").schema)
    changes = mb.Versions(spark, shared(spark, "changes"), spark.range(0).selectExpr("id AS user_id", "'' AS event_type", "'' AS change", "id AS batch").schema)
    mb.run(stream, mb.capturing(hashes, changes, ["user_id"], "event_type", F.col("event_id").cast("string")), shared(spark, "capture-log")).awaitTermination()
    return hashes.read()


@query("o12_02_late_rebuild", "corp_id #n #total", "SELECT (user_id % 10)::VARCHAR AS corp_id, count(*) AS n, sum(floor(value)::BIGINT) AS total FROM events GROUP BY 1")
def late_rebuild(spark, sf_dir):
    unit = F.concat(F.lit(""), (F.col("user_id") % 10).cast("string")).alias("corp_id")
    source = lambda: read(spark, sf_dir, "events").select(unit, F.floor("value").cast("long").alias("value"))
    build = lambda df: df.groupBy("corp_id").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    table = mb.Versions(spark, shared(spark, "rebuild"), build(source()).schema)
    mb.run(_stream(spark, sf_dir).select(unit), mb.rebuilding(source, build, table, ["corp_id"]), shared(spark, "rebuild-log")).awaitTermination()
    return table.read()
