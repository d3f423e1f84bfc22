"""Exact deduplication by Grace hashing.

Records are partitioned by a hash of their content until each bucket fits in memory; an
open-addressing table per bucket then groups records by comparing complete contents.

1. One pass over the documents. Each task keeps a bounded open-addressing table of the
   contents it has met, so a content leaves the task once per flush, with its count: a group
   of copies that holds a third of all rows is summed before any shuffle.
2. The recursion is planned on metadata (digest, length) alone: buckets over ``bucket_bytes``
   are split again with another hash until each fits. Contents then move once, to their
   final bucket.
3. Each bucket is streamed through its table, and the verdict returns to the documents by
   the row number of their representative.

Defined cases: a null text counts as empty; empty texts form one group; a null id sorts after
all ids; of repeated identical rows exactly one stays; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantloom.llm._common import WHITE, partitions_for, raw, row_base, saved, small, table_batch

#: A task's table is flushed when it holds this many bytes of content.
FLUSH_BYTES = 24 << 20
#: Contents of one bucket, which are in memory together.
BUCKET_BYTES = 48 << 20
_NO_ID = (1 << 63) - 1


class ContentTable:
    """Open addressing with linear probing; equal means equal in every byte."""

    def __init__(self, size: int = 1024):
        self.contents: list[bytes] = []
        self.hashes: list[int] = []
        self._slots = array("q", [-1]) * size
        self.bytes = 0

    def locate(self, h: int, content: bytes) -> tuple[int, bool]:
        """Index of ``content``, and whether it is new."""
        slots, mask = self._slots, len(self._slots) - 1
        at = h & mask
        while (k := slots[at]) >= 0:
            if self.hashes[k] == h and self.contents[k] == content:
                return k, False
            at = (at + 1) & mask
        slots[at] = k = len(self.contents)
        self.contents.append(content)
        self.hashes.append(h)
        self.bytes += len(content)
        if 2 * len(self.contents) > len(slots):
            self._grow()
        return k, True

    def _grow(self) -> None:
        self._slots = slots = array("q", [-1]) * (2 * len(self._slots))
        mask = len(slots) - 1
        for k, h in enumerate(self.hashes):
            at = h & mask
            while slots[at] >= 0:
                at = (at + 1) & mask
            slots[at] = k


_LINKS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("digest", pa.binary()), ("rep", pa.int64()), ("content", pa.binary()), ("n_bytes", pa.int64()), ("size", pa.int64()), ("best_n", pa.int64()), ("best_id", pa.int64()), ("best_row", pa.int64())])
_LINKS_DDL = "row long, doc_id long, digest binary, rep long, content binary, n_bytes long, size long, best_n long, best_id long, best_row long"
_VERDICTS = pa.schema([("rep", pa.int64()), ("keep_id", pa.int64()), ("keep_row", pa.int64()), ("group_size", pa.int64())])
_VERDICTS_DDL = "rep long, keep_id long, keep_row long, group_size long"


def _rank(n: int, doc: int | None, row: int) -> tuple[int, int, int]:
    """Smallest is best: most code points, smallest id, first row."""
    return (-n, _NO_ID if doc is None else doc, row)


def _local_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (doc_id, text, n_chars) -> a link per row; representatives carry content and sums."""
    row = row_base()
    links: list[list] = []
    table, reps, sums = ContentTable(), [], []

    def flush() -> pa.RecordBatch:
        for k, at in enumerate(reps):
            (n, _, best_row), best_id, size = sums[k]
            links[at][4:] = [table.contents[k], len(table.contents[k]), size, -n, best_id, best_row]
        return table_batch(_LINKS, [list(c) for c in zip(*links, strict=True)])

    for batch in batches:
        ids, lengths = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for doc, text, n in zip(ids, raw(batch.column(1)), lengths, strict=True):
            content = (text or b"").translate(None, WHITE)
            digest = hashlib.sha256(content).digest()
            k, new = table.locate(int.from_bytes(digest[:8], "little") >> 1, content)
            rank = _rank(n or 0, doc, row)
            if new:
                reps.append(len(links))
                sums.append([rank, doc, 1])
            else:
                own = sums[k]
                own[2] += 1
                if rank < own[0]:
                    own[:2] = [rank, doc]
            links.append([row, doc, digest, links[reps[k]][0] if not new else row, None, None, None, None, None, None])
            row += 1
            if table.bytes > FLUSH_BYTES or len(links) >= 50_000:
                yield flush()
                links, table, reps, sums = [], ContentTable(), [], []
    if links:
        yield flush()


def _bucket_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Representatives sorted by bucket -> a verdict for each; one table at a time."""
    path, table, classes, members = None, ContentTable(), [], []

    def verdicts() -> Iterator[pa.RecordBatch]:
        for at in range(0, len(members), 50_000):
            part = members[at : at + 50_000]
            own = [classes[k] for _, k in part]
            yield table_batch(_VERDICTS, [[m for m, _ in part], [c[1] for c in own], [c[0][2] for c in own], [c[2] for c in own]])

    for batch in batches:
        for p, rep, digest, content, size, n, doc, row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if p != path:
                yield from verdicts()
                path, table, classes, members = p, ContentTable(), [], []
            k, new = table.locate(int.from_bytes(digest[8:16], "little") >> 1, content)
            rank = _rank(n, doc, row)
            if new:
                classes.append([rank, doc, size])
            else:
                own = classes[k]
                own[2] += size
                if rank < own[0]:
                    own[:2] = [rank, doc]
            members.append((rep, k))
    yield from verdicts()


def _planned(reps: DataFrame, bucket_bytes: int) -> tuple[DataFrame, int]:
    """``reps`` with the path of its bucket, and the number of first-level buckets.

    A level splits every bucket that is over ``bucket_bytes`` and holds two contents or more,
    by a hash seeded with the level; one content alone can't be split and needs no more room.
    """
    sized = reps.groupBy("digest").agg(F.max("n_bytes").alias("n_bytes"))
    total = reps.agg(F.sum("n_bytes")).first()[0] or 0
    first = partitions_for(total, bucket_bytes // 3)
    path = F.pmod(F.xxhash64("digest"), F.lit(first)).cast("string")
    plan, level = sized.withColumn("path", path), 0
    while True:
        over = plan.groupBy("path").agg(F.sum("n_bytes").alias("held"), F.count(F.lit(1)).alias("n")).where((F.col("held") > bucket_bytes) & (F.col("n") > 1))
        if over.isEmpty():
            break
        level += 1
        fan_out = F.ceil(F.col("held") * 2 / bucket_bytes)
        split = F.concat_ws("/", "path", F.pmod(F.xxhash64("digest", F.lit(level)), fan_out).cast("string"))
        plan = saved(plan.join(over.select("path", "held"), "path", "left").withColumn("path", F.when(F.col("held").isNull(), F.col("path")).otherwise(split)).select("digest", "n_bytes", "path"), "grace-plan")
    return (reps.withColumn("path", path) if not level else reps.join(plan.select("digest", "path"), "digest")), first


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.length(text_col).cast("long").alias("n"))
    links = saved(rows.mapInArrow(small(_local_groups), _LINKS_DDL), "grace-links")
    reps = links.where(F.col("content").isNotNull())
    planned, first = _planned(reps, bucket_bytes)
    buckets = planned.select("path", "rep", "digest", "content", "size", "best_n", "best_id", "best_row").repartition(first, "path").sortWithinPartitions("path")
    verdicts = buckets.mapInArrow(_bucket_tables, _VERDICTS_DDL)
    return links.select("row", "doc_id", "digest", "rep").join(verdicts, "rep").select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
