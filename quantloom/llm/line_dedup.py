"""Reversible incremental line deduplication.

A line's key is the line without ASCII white space at its ends and with A-Z lower-cased. Keys
of ``MIN_POINTS`` code points or more are counted by the documents that hold them. The state is

* ``postings``: (digest, h, doc_id), a row per key and document, and the ids deleted since;
* ``refs``: (shard, digest, n_docs, last_doc), the exact reference counts;
* ``filters``: (shard, place, blob), cuckoo filters of each shard's live keys.

Each is a list of versions of Parquet tables: a change writes what it changes as one more version,
refs and filters in folders by shard, and touches no other shard. After ``VERSIONS`` changes they
are merged into one, with twice as many shards for twice as many keys, so that shards stay small.

Filters decide before the exact table is read. An insertion asks the filters of the shards it
touches; keys they don't know are new and written without a look-up, and only the others are
joined with the exact counts of these shards. Cuckoo filters can forget: deleting a document
lowers its keys' counts, and at zero takes the fingerprint out, so inserting and deleting
documents in any order gives the state of building from what is left. A shard whose filter is
full gets one more beside it.

Counts are summed in every task before keys move, and keys that very many documents hold are
joined by broadcast (``_common.joined``): a line that a third of all documents share is no single task.

Defined cases: a null or empty text is one empty line; very long texts are split whole; rows that
repeat a doc_id count as one document; a null id counts as one document that is older than all
others; of equal lines in the kept document all stay; an empty table gives no rows; further columns
pass through :meth:`LineIndex.apply`, but for n_lines, n_dropped, kept_sha256 and kept_text, which
it replaces, and the names __key, __id, __drop and __text, which it uses. Ids are whole numbers.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.llm._common import WHITE, joined, partitions_for, raw, saved, scratch_path, small, table_batch

MIN_POINTS, MIN_DOCS = 20, 3
#: Keys a shard holds when it is built; twice as many make it split.
SHARD_KEYS = 250_000
#: Versions of the state that are read together.
VERSIONS = 8
NULL_ID = -(1 << 63)


class CuckooFilter:
    """16-bit fingerprints, four to a bucket; holds one copy per inserted key, so it can delete."""

    SLOTS, KICKS = 4, 400

    def __init__(self, keys: int = 64, cells: array | None = None):
        n = 1 << max(4, (max(keys, 1) * 5 // 4 // self.SLOTS).bit_length())
        self.cells = cells if cells is not None else array("H", [0]) * (n * self.SLOTS)
        self._mask = len(self.cells) // self.SLOTS - 1

    def _places(self, h: int) -> tuple[int, int, int]:
        mark = (h >> 48) or 1
        one = h & self._mask
        return mark, one, self._other(one, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & self._mask

    def __contains__(self, h: int) -> bool:
        mark, one, two = self._places(h)
        cells = self.cells
        return mark in cells[4 * one : 4 * one + 4] or mark in cells[4 * two : 4 * two + 4]

    def _put(self, bucket: int, mark: int) -> bool:
        cells = self.cells
        for at in range(4 * bucket, 4 * bucket + 4):
            if not cells[at]:
                cells[at] = mark
                return True
        return False

    def insert(self, h: int) -> bool:
        """False if the filter is too full; it is then unchanged."""
        mark, one, two = self._places(h)
        if self._put(one, mark) or self._put(two, mark):
            return True
        bucket, moved = two, []
        for k in range(self.KICKS):
            at = 4 * bucket + k % 4
            moved.append((at, self.cells[at]))
            self.cells[at], mark = mark, self.cells[at]
            bucket = self._other(bucket, mark)
            if self._put(bucket, mark):
                return True
        for at, before in reversed(moved):
            self.cells[at] = before
        return False

    def remove(self, h: int) -> bool:
        mark, one, two = self._places(h)
        for bucket in (one, two):
            for at in range(4 * bucket, 4 * bucket + 4):
                if self.cells[at] == mark:
                    self.cells[at] = 0
                    return True
        return False

    def to_bytes(self) -> bytes:
        return self.cells.tobytes()

    @classmethod
    def from_bytes(cls, blob: bytes) -> CuckooFilter:
        cells = array("H")
        cells.frombytes(blob)
        return cls(cells=cells)


def _hash(digest: bytes) -> int:
    return int.from_bytes(digest[8:16], "little")


class Filters:
    """A shard's filters; the last one takes new keys."""

    def __init__(self, keys: int = SHARD_KEYS, held: list[CuckooFilter] | None = None):
        self.keys, self.held = keys, held or []

    def __contains__(self, digest: bytes) -> bool:
        h = _hash(digest)
        return any(h in f for f in self.held)

    def insert(self, digest: bytes) -> None:
        if not self.held or not self.held[-1].insert(_hash(digest)):
            self.held.append(CuckooFilter(self.keys))
            self.held[-1].insert(_hash(digest))

    def remove(self, digest: bytes) -> bool:
        h = _hash(digest)
        return any(f.remove(h) for f in self.held)


def line_key(line: bytes) -> bytes:
    return line.strip(WHITE).lower()


def _digests(text: bytes | None) -> list[bytes | None]:
    """For each line the digest of its key, None if the key is too short."""
    out = []
    for line in (text or b"").split(b"\n"):
        key = line.strip(WHITE).lower()
        long = len(key) >= MIN_POINTS and (len(key) >= 4 * MIN_POINTS or key.isascii() or len(key.decode()) >= MIN_POINTS)
        out.append(hashlib.blake2b(key, digest_size=16).digest() if long else None)
    return out


_POSTINGS = pa.schema([("digest", pa.binary()), ("h", pa.int32()), ("doc_id", pa.int64())])
_POSTINGS_DDL = "digest binary, h int, doc_id long"
_REFS_DDL = "digest binary, n_docs long, last_doc long, shard int"
_FILTERS = pa.schema([("place", pa.int32()), ("blob", pa.binary()), ("shard", pa.int32())])
_FILTERS_DDL = "place int, blob binary, shard int"
_ASKED = pa.schema([("digest", pa.binary()), ("known", pa.bool_())])
_ASKED_DDL = "digest binary, known boolean"
#: What a row is, in the order in which a shard's rows are read.
_FILTER, _REMOVE, _INSERT, _ASK = range(4)


def _post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, ids = [], []
        for doc, text in zip(batch.column(0).to_pylist(), raw(batch.column(1)), strict=True):
            own = {*_digests(text)} - {None}
            keys += own
            ids += [NULL_ID if doc is None else doc] * len(own)
        yield table_batch(_POSTINGS, [keys, [int.from_bytes(k[:4], "little") >> 1 for k in keys], ids])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Filters, Iterator[tuple[int, bytes]]]]:
    """Rows (shard, kind, place, digest, blob) sorted by the first three -> each shard with its filters and its other rows."""
    from itertools import chain, groupby

    rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    for shard, own in groupby(rows, lambda r: r[0]):
        held, following = [], iter(())
        for r in own:
            if r[1] != _FILTER:
                following = chain([r], own)
                break
            held.append(CuckooFilter.from_bytes(r[4]))
        yield shard, Filters(held=held), ((kind, digest) for _, kind, _, digest, _ in following)


def _renew(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The filters after the shard's removals and insertions."""
    for shard, filters, rows in _shards(batches):
        for kind, digest in rows:
            (filters.remove if kind == _REMOVE else filters.insert)(digest)
        for k, f in enumerate(filters.held):
            yield table_batch(_FILTERS, [[k], [f.to_bytes()], [shard]])


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether the shard's filters know each digest."""
    for _, filters, rows in _shards(batches):
        digests: list[bytes] = []
        for _, digest in rows:
            digests.append(digest)
            if len(digests) == 10_000:
                yield table_batch(_ASKED, [digests, [d in filters for d in digests]])
                digests = []
        yield table_batch(_ASKED, [digests, [d in filters for d in digests]])


_CUT_TYPES = "long", "long", "string", "string"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_lines, n_dropped, sums, kept = [], [], [], []
        for text, drop in zip(raw(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            text = text or b""
            n = text.count(b"\n") + 1
            gone = 0
            if drop:
                drop = set(drop)
                lines = [x for x, d in zip(text.split(b"\n"), _digests(text), strict=True) if d not in drop]
                gone = n - len(lines)
                text = b"\n".join(lines)
            n_lines.append(n)
            n_dropped.append(gone)
            sums.append(hashlib.sha256(text).hexdigest())
            kept.append(text.decode())
        added = [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(sums, pa.string()), pa.array(kept, pa.string())]
        yield pa.RecordBatch.from_arrays([*batch.columns[2:], *added], names=[*batch.schema.names[2:], "n_lines", "n_dropped", "kept_sha256", "kept_text"])


class LineIndex:
    """The state of a corpus; ``insert`` and ``delete`` return the next state, which shares what they didn't change."""

    def __init__(self, spark: SparkSession, n_shards: int = 1, version: int = 0, postings: tuple = (), gone: tuple = (), refs: tuple = (), filters: tuple = ()):
        self.spark, self.n_shards, self.version = spark, n_shards, version
        self._postings, self._gone, self._refs, self._filters = postings, gone, refs, filters

    # --- reading ------------------------------------------------------------------------

    def _read(self, versions: tuple, ddl: str, shards: list[int] | None = None) -> DataFrame:
        """The versions one under the other, with their number; of ``shards`` only their folders are read."""
        out = None
        for number, path in versions:
            df = self.spark.read.schema(ddl).parquet(path)
            if shards is not None:
                df = df.where(F.col("shard").isin(shards))
            df = df.withColumn("version", F.lit(number))
            out = df if out is None else out.unionByName(df)
        return self.spark.createDataFrame([], f"{ddl}, version int") if out is None else out

    @property
    def postings(self) -> DataFrame:
        """(digest, h, doc_id) of the documents that weren't deleted after they were inserted."""
        held = self._read(self._postings, _POSTINGS_DDL)
        if self._gone:
            gone = self._read(self._gone, "doc_id long").groupBy("doc_id").agg(F.max("version").alias("until"))
            held = held.join(gone.withColumnRenamed("doc_id", "__gone"), (F.col("doc_id") == F.col("__gone")) & (F.col("version") < F.col("until")), "left_anti")
        return held.drop("version")

    def _counts(self, shards: list[int] | None = None) -> DataFrame:
        held = self._read(self._refs, _REFS_DDL, shards)
        if len(self._refs) > 1:
            held = held.groupBy("shard", "digest").agg(F.max_by(F.struct("n_docs", "last_doc"), "version").alias("r")).select("digest", "r.*", "shard")
        return held.where("n_docs > 0").select("shard", "digest", "n_docs", "last_doc")

    @property
    def refs(self) -> DataFrame:
        return self._counts()

    def _filter_rows(self, shards: list[int] | None = None) -> DataFrame:
        held = self._read(self._filters, _FILTERS_DDL, shards)
        if len(self._filters) > 1:
            newest = held.groupBy("shard").agg(F.max("version").alias("version"))
            held = held.join(newest, ["shard", "version"], "left_semi")
        return held.select("shard", "place", "blob")

    @property
    def filters(self) -> DataFrame:
        return self._filter_rows()

    # --- writing ------------------------------------------------------------------------

    def _shard(self, h: str = "h"):
        return F.pmod(F.col(h), F.lit(self.n_shards)).cast("int").alias("shard")

    def _written(self, df: DataFrame, name: str) -> str:
        path = scratch_path(self.spark, name)
        df.write.partitionBy("shard").parquet(path)
        return path

    def _in_shards(self, work, ddl: str, changes: DataFrame, shards: list[int] | None) -> DataFrame:
        """``work`` on each shard's filters and then its rows of ``changes`` (shard, kind, digest)."""
        rows = changes.select("shard", "kind", F.lit(0).alias("place"), "digest", F.lit(None).cast("binary").alias("blob"))
        if self._filters:
            rows = rows.unionByName(self._filter_rows(shards).select("shard", F.lit(_FILTER).alias("kind"), "place", F.lit(None).cast("binary").alias("digest"), "blob"))
        n = self.n_shards if shards is None else max(1, len(shards))
        return rows.repartition(n, "shard").sortWithinPartitions("shard", "kind", "place").mapInArrow(work, ddl)

    @staticmethod
    def _posted(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        return rows.mapInArrow(small(_post), _POSTINGS_DDL).dropDuplicates(["digest", "doc_id"])

    @classmethod
    def build(cls, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        spark = docs.sparkSession
        path = scratch_path(spark, "line-postings")
        saved(cls._posted(docs, id_col, text_col), "line-postings", path)
        return cls(spark, postings=((0, path),))._merged()

    def _merged(self) -> LineIndex:
        """One version of everything, with as many shards as the keys need."""
        postings = self._postings
        if len(postings) > 1 or self._gone:
            path = scratch_path(self.spark, "line-postings")
            postings = ((self.version, path),)
            saved(self.postings, "line-postings", path)
        out = LineIndex(self.spark, 1, self.version, postings)
        counted = saved(out.postings.groupBy("digest", "h").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc")), "line-counts")
        out.n_shards = partitions_for(counted.count(), SHARD_KEYS)
        refs = counted.select("digest", "n_docs", "last_doc", out._shard()).repartition(out.n_shards, "shard")
        out._refs = ((self.version, out._written(refs, "line-refs")),)
        keys = out.refs.select("shard", F.lit(_INSERT).alias("kind"), "digest")
        out._filters = ((self.version, out._written(out._in_shards(_renew, _FILTERS_DDL, keys, None), "line-filters")),)
        return out

    def _changed(self, changed: DataFrame, shards: list[int], postings: tuple, gone: tuple) -> LineIndex:
        """The next version: ``changed`` has (shard, digest, n_docs, last_doc, kind) of the keys whose counts changed."""
        number = self.version + 1
        changed = saved(changed, "line-changed")
        refs = (number, self._written(changed.select("digest", "n_docs", "last_doc", "shard").repartition(max(1, len(shards)), "shard"), "line-refs"))
        moves = changed.where("kind IS NOT NULL").select("shard", "kind", "digest")
        touched = sorted(r["shard"] for r in moves.select("shard").distinct().collect())  # a row per shard
        filters = self._filters
        if touched:
            filters += ((number, self._written(self._in_shards(_renew, _FILTERS_DDL, moves, touched), "line-filters")),)
        out = LineIndex(self.spark, self.n_shards, number, postings, gone, (*self._refs, refs), filters)
        grown = out.n_shards * SHARD_KEYS * 2
        if len(out._refs) > VERSIONS or self._keys_at_most() + changed.where(F.col("kind") == _INSERT).count() > grown:
            return out._merged()
        return out

    def _keys_at_most(self) -> int:
        """Rows of all versions of the counts: no fewer than there are keys. Parquet's footers tell."""
        return self._read(self._refs, _REFS_DDL).count()

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        """Documents whose postings are already there change nothing."""
        new = saved(self._posted(docs, id_col, text_col), "line-new")
        ids = new.select("doc_id").distinct()
        held = ids.join(self._read(self._postings, _POSTINGS_DDL).select("doc_id"), "doc_id", "left_semi")
        if not held.isEmpty():  # only then postings are compared
            new = saved(new.join(self.postings.join(held, "doc_id", "left_semi"), ["digest", "doc_id"], "left_anti"), "line-new")
        counts = saved(new.groupBy("digest", "h").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last")).select("digest", "n", "last", self._shard()), "line-sums")
        shards = sorted(r["shard"] for r in counts.select("shard").distinct().collect())  # a row per shard
        if not shards:
            return self
        known = self._in_shards(_ask, _ASKED_DDL, counts.select("shard", F.lit(_ASK).alias("kind"), "digest"), shards).where("known").select("digest")
        # The exact counts are read for keys that a filter knows, and only of their shards.
        looked = self._counts(shards).drop("shard").join(known, "digest", "left_semi")
        own = F.coalesce("n_docs", F.lit(0))
        changed = counts.join(looked, "digest", "left").select("shard", "digest", (own + F.col("n")).alias("n_docs"), F.greatest("last", "last_doc").alias("last_doc"), F.when(own == 0, F.lit(_INSERT)).alias("kind"))
        path = scratch_path(self.spark, "line-postings")
        saved(new.select("digest", "h", "doc_id"), "line-postings", path)
        return self._changed(changed, shards, (*self._postings, (self.version + 1, path)), self._gone)

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> LineIndex:
        """Forget the documents of ``ids``; unknown ids change nothing. Postings are scanned once, and what changes is written."""
        path = scratch_path(self.spark, "line-gone")
        gone_ids = saved(ids.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc_id")).distinct(), "line-gone", path)
        held = self.postings
        counts = held.join(gone_ids, "doc_id", "left_semi").groupBy("digest", "h").agg(F.count(F.lit(1)).alias("n")).select("digest", "n", self._shard())
        counts = saved(counts, "line-sums")
        shards = sorted(r["shard"] for r in counts.select("shard").distinct().collect())  # a row per shard
        if not shards:
            return self
        left = held.join(gone_ids, "doc_id", "left_anti").join(counts.select("digest"), "digest", "left_semi").groupBy("digest").agg(F.max("doc_id").alias("last_doc"))
        now = self._counts(shards).drop("shard", "last_doc").join(counts, "digest").join(left, "digest", "left")
        changed = now.select("shard", "digest", (F.col("n_docs") - F.col("n")).alias("n_docs"), "last_doc", F.when(F.col("n_docs") <= F.col("n"), F.lit(_REMOVE)).alias("kind"))
        return self._changed(changed, shards, self._postings, (*self._gone, (self.version + 1, path)))

    # --- applying -----------------------------------------------------------------------

    def dropped(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """(digest, n_docs, last_doc) of the keys that lose their lines everywhere but in last_doc."""
        return self.refs.where(F.col("n_docs") >= min_docs).select("digest", "n_docs", "last_doc")

    def apply(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
        """``docs``, all of them indexed, with n_lines, n_dropped, kept_sha256 and kept_text."""
        postings = self.postings.select("digest", "doc_id")
        hits = joined(postings, self.dropped(min_docs), ["digest"], "n_docs", postings.count()).where(F.col("doc_id") != F.col("last_doc"))
        drops = hits.groupBy("doc_id").agg(F.collect_list("digest").alias("__drop")).withColumnRenamed("doc_id", "__id")
        rest = [c for c in docs.columns if c not in {"n_lines", "n_dropped", "kept_sha256", "kept_text"}]
        rows = docs.withColumn("__key", F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID))).join(drops, F.col("__key") == F.col("__id"), "left")
        rows = rows.select(F.col(text_col).alias("__text"), "__drop", *[F.col(c) for c in rest if c != text_col])
        kept = [docs.schema[c] for c in rest if c != text_col]
        schema = T.StructType([*kept, *(T.StructField(n, T.LongType() if t == "long" else T.StringType()) for n, t in zip(("n_lines", "n_dropped", "kept_sha256", "kept_text"), _CUT_TYPES, strict=True))])
        return rows.mapInArrow(small(_cut), schema)
