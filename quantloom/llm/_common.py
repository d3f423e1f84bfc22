"""What the training-data operators share: scratch tables, raw Arrow text, row ids, joins on hot keys.

Intermediate tables go to the folder the cluster names in ``spark.checkpoint.dir`` (all
executors and the driver see it), in a folder of the application, which :func:`release` deletes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Hashable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, ``[\x20\x09-\x0D]``.
WHITE = b" \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session; a default under /tmp in local mode only (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    found = found or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file:///tmp/quantloom-shared"
    return found.rstrip("/")


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/quantloom/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Delete the application's intermediate tables. Results that were not written yet are lost."""
    delete(spark, _own_dir(spark))


def saved(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows a Python worker takes apart at once. Spark bounds an Arrow batch in bytes; this bounds its copies.
BATCH_ROWS = 1000
Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def small(work: Work, rows: int = BATCH_ROWS) -> Work:
    """``work`` on slices of ``rows`` rows at most."""

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return work(b.slice(k, rows) for b in batches for k in range(0, max(1, b.num_rows), rows))

    return sliced


#: A key with more than this part of all rows is hot, so there are HOT_PART hot keys at most.
HOT_PART = 4096
#: Rows of a table that Spark may broadcast unasked. Its own estimate is of compressed files and leaves out
#: explodes, so that a table of some hundred thousand rows can take all of the driver's heap.
SENT_MOST = 100_000


def shuffled(table: DataFrame, rows: int | None = None) -> DataFrame:
    """``table`` as a join's side that is sorted and merged, never broadcast, unless it has SENT_MOST of ``rows`` at most."""
    return table if rows is not None and rows <= SENT_MOST else table.hint("merge")


def joined(rows: DataFrame, table: DataFrame, keys: Sequence[str], n: str, total: int, few: int = 0) -> DataFrame:
    """``rows``, ``total`` in all, inner joined to ``table``, which has each key once and in ``n`` how many rows hold it.

    Hot keys, of which there are HOT_PART at most, are broadcast, so that their rows stay where
    they are; the rest are shuffled. Column ``n`` is left out. Both inputs are read twice: save
    them first. Up to ``few`` rows in all are no load for one task and just joined.
    """
    keys = list(keys)
    if total <= few:
        return rows.join(shuffled(table.drop(n), total), keys)
    hot = table.where(F.col(n) > max(1, total // HOT_PART)).drop(n).limit(HOT_PART)
    cold = table.where(F.col(n) <= max(1, total // HOT_PART)).drop(n)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(hot), keys).unionByName(rest.join(shuffled(cold, total), keys))


def raw(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    return column.cast(pa.large_binary() if wide else pa.binary()).to_pylist()


def table_batch(schema: pa.Schema, columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def row_base() -> int:
    """First row number of this task: (partition id) << 33, as Spark's own row ids."""
    from pyspark import TaskContext

    context = TaskContext.get()
    return (context.partitionId() if context else 0) << 33


_sole: dict[Hashable, object] = {}


def sole(key: Hashable, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept by this worker process until another key is asked for: models take tens of MB each."""
    if key not in _sole:
        _sole.clear()
        _sole[key] = make()
    return _sole[key]


def partitions_for(n: int, per_partition: int, least: int = 1) -> int:
    return max(least, -(-n // per_partition))


def ids_by_chunk(ids: list[int], token_bytes: np.ndarray, chunk_bytes: list[int]) -> list[bytes]:
    """Ids of chunks encoded as one text, cut at the chunks' ends (little-endian unsigned 32-bit).

    ``token_bytes`` has the bytes each id stands for; every chunk ends where a token does.
    """
    own = np.array(ids, "<u4")
    ends = np.searchsorted(np.cumsum(token_bytes[own]), np.cumsum(chunk_bytes)) + 1
    flat, cuts = own.tobytes(), (4 * ends).tolist()
    if cuts and cuts[-1] != len(flat):
        raise ValueError("a token crosses the end of a chunk")
    return [flat[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]
