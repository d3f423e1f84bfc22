"""O12: what arrives over time, as Structured Streaming.

Every sink is idempotent by batch id: a batch that runs again after a failure writes the same
folder again. State is Parquet in versions (``v=<batch>``); a reader takes the newest one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quantloom.operators.aggregates import content_hash
from quantloom.operators.checks import changed_scopes
from quantloom.operators.joins import replace_units, upsert


def files(spark: SparkSession, path: str, schema: T.StructType | str, per_batch: int | None = None, glob: str | None = None) -> DataFrame:
    """O12.1: files of a landing folder as a stream."""
    reader = spark.readStream.schema(schema)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


class Versions:
    """A table whose newest version is complete; each batch writes the next one."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _folders(self) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(at):
            return []
        done = lambda p: fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))
        return sorted(int(s.getPath().getName()[2:]) for s in fs.listStatus(at) if s.getPath().getName().startswith("v=") and done(s.getPath()))

    def read(self, before: int | None = None) -> DataFrame:
        held = [v for v in self._folders() if before is None or v < before]
        if not held:
            return self.spark.createDataFrame(self.spark.sparkContext.emptyRDD(), self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v={held[-1]}")

    def write(self, df: DataFrame, version: int) -> None:
        df.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/v={version}")


def run(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """O12.1, O12.3, O12.5: everything that is there now, in batches, resuming where the checkpoint ends."""
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upserting(table: Versions, keys: Sequence[str], keep_when_null: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """O12.3, O12.4: newest row by key, batch by batch. Within a batch the largest ``seq`` wins where there is one."""

    def each(batch: DataFrame, number: int) -> None:
        new = batch
        if "seq" in batch.columns:
            rest = [c for c in batch.columns if c not in keys]
            new = batch.groupBy(*keys).agg(F.max_by(F.struct(*rest), "seq").alias("__r")).select(*keys, "__r.*")
        table.write(upsert(table.read(before=number), new, keys, keep_when_null), number)

    return each


def newest(table: Versions, keys: Sequence[str], seq: str) -> Callable[[DataFrame, int], None]:
    """O12.1: the row with the largest ``seq`` by key over all batches, whatever order they come in."""

    def each(batch: DataFrame, number: int) -> None:
        both = table.read(before=number).unionByName(batch.select(*table.schema.names))
        rest = [c for c in table.schema.names if c not in keys]
        table.write(both.groupBy(*keys).agg(F.max_by(F.struct(*rest), seq).alias("__r")).select(*keys, "__r.*"), number)

    return each


def refetched(stored: DataFrame, fetched: DataFrame, keys: Sequence[str], day: str, days: int = 15) -> DataFrame:
    """O12.4: what was fetched for the last ``days`` days overwrites what is stored; older days stay as they are."""
    last = stored.agg(F.max(day).alias("__last"))  # one row
    recent = fetched.crossJoin(F.broadcast(last)).where(F.col(day) > F.date_sub("__last", days)).drop("__last")
    return upsert(stored, recent, [*keys, day])


def progress(log: Versions, keys: Sequence[str], kind: str, kinds: Sequence[str], name: str = "n") -> Callable[[DataFrame, int], None]:
    """O12.5: a row for each of ``keys`` that a batch has and each of ``kinds``, with how many rows came so far, 0 included."""

    def each(batch: DataFrame, number: int) -> None:
        asked = batch.select(*keys).distinct().withColumn(kind, F.explode(F.array(*map(F.lit, kinds))))
        seen = batch.groupBy(*keys, kind).agg(F.count(F.lit(1)).alias(name))
        now = asked.join(seen, [*keys, kind], "left").select(*keys, kind, F.coalesce(name, F.lit(0)).alias(name))
        log.write(log.read(before=number).unionByName(now).groupBy(*keys, kind).agg(F.sum(name).alias(name)), number)

    return each


#: What an event does to a slot: claims it, ends its work well or badly, or says that it is still being worked on.
LEASE_EVENTS = {"view": "claim", "purchase": "done", "error": "fail", "click": "alive"}


def lease_step(status: str, attempts: int, until: float, what: str | None, at: float, lease: float = 6 * 3600.0, most: int = 3) -> tuple[str, int, float]:
    """O12.7: pending -> leased -> done, or after ``most`` failed or run-out attempts -> dead.

    A lease that has run out before the event makes the slot pending again (a failed attempt). A claim
    takes a pending slot only; a sign of life prolongs a lease; done and dead are final.
    """
    if status == "leased" and at > until:
        status = "dead" if attempts >= most else "pending"
    if status == "pending" and what == "claim":
        return "leased", attempts + 1, at + lease
    if status == "leased" and what == "alive":
        return "leased", attempts, at + lease
    if status == "leased" and what == "done":
        return "done", attempts, until
    if status == "leased" and what == "fail":
        return ("dead" if attempts >= most else "pending"), attempts, until
    return status, attempts, until


_LEASED = T.StructType([T.StructField("status", T.StringType()), T.StructField("attempts", T.LongType())])


def lease_states(events: DataFrame, key: str, time: str, seq: str, kind: str) -> DataFrame:
    """O12.7: (key, status, attempts) of each slot after its events in order; batch or, in ``foreachBatch``, over the log so far.

    The events of a slot are read in order one by one, whatever Arrow batches they come in.
    """
    schema = T.StructType([events.schema[key], *_LEASED.fields])
    rows = events.select(key, F.unix_micros(F.col(time).cast("timestamp")).alias("__at"), seq, kind)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, state = None, ("pending", 0, 0.0)
        out: list[tuple] = []
        for pdf in batches:
            for slot, at, what in zip(pdf[key], pdf["__at"], pdf[kind], strict=True):
                if slot != own:
                    if own is not None:
                        out.append((own, *state[:2]))
                    own, state = slot, ("pending", 0, 0.0)
                state = lease_step(*state, LEASE_EVENTS.get(what), at / 1e6)
            yield pd.DataFrame(out, columns=schema.names)
            out = []
        if own is not None:
            yield pd.DataFrame([(own, *state[:2])], columns=schema.names)

    return rows.where(F.col(key).isNotNull()).repartition(key).sortWithinPartitions(key, "__at", seq).mapInPandas(walk, schema)


def rebuilding(source: Callable[[], DataFrame], build: Callable[[DataFrame], DataFrame], table: Versions, keys: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """O12.2: late arrivals: the units that a batch touches are built anew from all of ``source``; no watermark."""

    def each(batch: DataFrame, number: int) -> None:
        units = batch.select(*keys).distinct()
        fresh = build(source().join(units, list(keys), "left_semi"))
        table.write(replace_units(table.read(before=number), fresh, units, keys), number)

    return each


def capturing(hashes: Versions, changes: Versions, keys: Sequence[str], scope: str, line: Column) -> Callable[[DataFrame, int], None]:
    """O12.6: one hash of each touched (keys, scope) per batch; equal hashes change nothing, others are logged with the batch."""

    def each(batch: DataFrame, number: int) -> None:
        after = content_hash(batch, [*keys, scope], line).select(*keys, scope, "content_hash")
        held = hashes.read(before=number)
        touched = held.join(after.select(*keys, scope), [*keys, scope], "left_semi")
        changed = changed_scopes(touched, after, keys, scope, "content_hash").withColumn("batch", F.lit(number).cast("long"))
        changes.write(changes.read(before=number).unionByName(changed.select(*changes.schema.names)), number)
        hashes.write(upsert(held, after, [*keys, scope]), number)

    return each


def _timed(df: DataFrame, time: str) -> DataFrame:
    """Watermarks need timestamps with a zone; local ones are read in the session's."""
    return df.withColumn(time, F.col(time).cast("timestamp"))


def without_repeats(stream: DataFrame, time: str, keys: Sequence[str], lateness: str = "15 days") -> DataFrame:
    """O12.4: the first row of each key within the re-fetch window."""
    return _timed(stream, time).withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(keys))


# --- extension: event-time windows, which the original has none of ----------------------


def windowed(events: DataFrame, time: str, size: str, slide: str | None = None, keys: Sequence[str] = (), lateness: str = "10 minutes") -> DataFrame:
    """Tumbling (or, with ``slide``, sliding) counts and sums; rows later than ``lateness`` go."""
    at = F.window(time, size, slide) if slide else F.window(time, size)
    out = _timed(events, time).withWatermark(time, lateness).groupBy(at.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total"))
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n", "total")


def sessions(events: DataFrame, time: str, key: str, gap: str = "30 minutes", lateness: str = "10 minutes") -> DataFrame:
    out = _timed(events, time).withWatermark(time, lateness).groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return out.select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


_PASSED = T.StructType([T.StructField("key", T.StringType()), T.StructField("status", T.StringType()), T.StructField("n_seen", T.LongType())])


def slot_states(stream: DataFrame, key: str, passed: str = "purchase", reset: str = "error") -> DataFrame:
    """O12.7 in small: a slot passes on one event and returns to pending on another; a row per batch and touched slot."""

    def step(name: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        status, n = state.get if state.exists else ("pending", 0)
        for pdf in batches:
            for kind in pdf.sort_values("event_id")["event_type"]:
                n += 1
                status = "passed" if kind == passed else "pending" if kind == reset else status
        state.update((status, n))
        yield pd.DataFrame({"key": [str(name[0])], "status": [status], "n_seen": [n]})

    return stream.groupBy(key).applyInPandasWithState(step, _PASSED, "status string, n long", "update", GroupStateTimeout.NoTimeout)
