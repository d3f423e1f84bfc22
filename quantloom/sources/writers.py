"""O1.7, O1.12-O1.17: sinks."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """O1.12: replaces the partitions that ``df`` has and leaves the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def csv(df: DataFrame, path: str) -> None:
    """O1.14: UTF-8 CSV with a header, written in parallel (one file a partition)."""
    df.write.mode("overwrite").option("header", "true").option("encoding", "UTF-8").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)


def review_csv(lines: DataFrame, path: str) -> None:
    """O1.15: printed rows in order, labels indented by depth under their filing."""
    shown = F.concat(F.repeat(F.lit("  "), F.col("depth")), F.col("label"))
    csv(lines.repartitionByRange("rcept").sortWithinPartitions("rcept", "table_seq", "row_order").select("rcept", "statement", "table_seq", "row_order", shown.alias("label"), "value"), path)


def bucketed(df: DataFrame, table: str, key: str = "corp", buckets: int = 512) -> None:
    """A table whose later joins and windows by ``key`` need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)


class Presets:
    """O1.17: named screens, a small JSON text a name, in a folder that all nodes see."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str) -> str:
        if not re.fullmatch(r"[\w -]{1,80}", name):
            raise ValueError(f"not a preset name: {name!r}")
        return f"{self.folder}/{name}"

    def save(self, name: str, preset: dict) -> None:
        self.spark.createDataFrame([(json.dumps(preset, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(self._path(name))

    def load(self, name: str) -> dict:
        return json.loads(self.spark.read.text(self._path(name)).first()[0])


class Snapshots:
    """O1.13: frames kept by the id of the snapshot they read; a new id drops the old ones.

    ``most`` frames are kept at once, those used last; a frame older than ``seconds`` is made anew.
    """

    def __init__(self, most: int = 32, seconds: float = 1800, clock: Callable[[], float] = time.monotonic):
        self.most, self.seconds, self.clock = most, seconds, clock
        self._held: dict[str, tuple[str, float, DataFrame]] = {}

    def get(self, name: str, snapshot: str, make: Callable[[], DataFrame]) -> DataFrame:
        held, now = self._held.pop(name, None), self.clock()
        if held and (held[0] != snapshot or now - held[1] > self.seconds):
            held[2].unpersist()
            held = None
        if not held:
            held = (snapshot, now, make().persist())
        self._held[name] = held  # the last one used comes last
        while len(self._held) > self.most:
            self._held.pop(next(iter(self._held)))[2].unpersist()
        return held[2]

    def clear(self) -> None:
        while self._held:
            self._held.popitem()[1][2].unpersist()
