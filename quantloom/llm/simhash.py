"""SimHash near-duplicates by multi-index hashing.

Fingerprints: A-Z lower-cased, words are runs of non-white ASCII, shingles are ``words``
consecutive words joined by a space (repeats count; a shorter text is one shingle), hashed with
XXH64, seed 42; a bit is set if more than half of the hashes have it.

Search: 64 bits are cut into two segments of 32. Fingerprints that differ in at most ``RADIUS``
(2) bits differ in at most one bit within one segment. Each distinct fingerprint is stored in a
table under both segments and looks up, per segment, the ball of radius one around it. Of two
segments that differ in one bit, exactly one has a 0 there, so only flips from 0 to 1 are
enumerated: each link is met from one side. Matches are verified on all 64 bits within the join.

A half that more than ``HALF_MOST`` distinct fingerprints share isn't joined on: each of these
looks up, as a whole, every fingerprint within the radius whose half differs by one bit at most.

Copies share a fingerprint and take part once. Links between distinct fingerprints are joined
to components by alternating large-star and small-star steps, whose edges stay distributed.
Fingerprints and nodes that very many rows hold are joined by broadcast (``_common.joined``); tables
that grow with the input are never broadcast.

Defined cases: a null text counts as empty; a text without words has fingerprint zero and is
linked like any other; very long texts are hashed whole; a null id never is a component's id
unless it stands alone; repeated rows each get their row; an empty table gives no rows; further
columns are ignored by :func:`near_groups` and kept by :func:`keep_firsts`. Ids are whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.llm._common import delete, joined, raw, saved, scratch_path, shuffled, small

WORDS, RADIUS, SEED = 3, 2, 42
HALF_MOST = 4096
#: Links that one task can take.
FEW = 1_000_000
#: Hashes whose bits are counted at once.
_BLOCK = 1 << 16


def shingle_hashes(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Hashes of the shingles in order, repeats included; none for a text without words."""
    found = (text or b"").lower().split()
    joined, digest = b" ".join(found), xxhash.xxh64_intdigest
    if len(found) <= words:
        return np.array([digest(joined, SEED)] if found else [], dtype="<u8")
    ends = (np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1).tolist()
    starts = [0, *(e + 1 for e in ends[: len(found) - words])]
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :], strict=True)], dtype="<u8")


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of these hashes; zero for none."""
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), _BLOCK):
        part = hashes[k : k + _BLOCK]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * counts > len(hashes)).astype(np.uint8), bitorder="little").view("<u8")[0])


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    return majority(shingle_hashes(text, words))


def _printer(words: int):
    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, words) for t in raw(batch.column(0))], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(fps)], names=[*batch.schema.names[1:], "fp"])

    return prints


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, *more: str) -> DataFrame:
    """(doc_id, columns of ``more``, fp), a row per row."""
    rows = docs.select(F.col(text_col).alias("__text"), F.col(id_col).cast("long").alias("doc_id"), *more)
    schema = T.StructType([*rows.schema.fields[1:], T.StructField("fp", T.LongType())])
    return rows.mapInArrow(small(_printer(words)), schema)


def _masks(part: int, radius: int) -> list[int]:
    """Signed words of ``radius`` bits at most, with one bit at most in the half ``part``."""
    own, other = (range(0, 32), range(32, 64)) if part == 0 else (range(32, 64), range(0, 32))
    found = []
    for n in range(1, radius + 1):
        found += [sum(1 << b for b in bits) for bits in combinations(other, n)]
        found += [1 << b | sum(1 << c for c in bits) for b in own for bits in combinations(other, n - 1)]
    return [m - (1 << 64) if m >> 63 else m for m in found]


def links(fps: DataFrame, radius: int = RADIUS, half_most: int = HALF_MOST) -> DataFrame:
    """``fps``: distinct fp -> (a, b), a < b, each pair at ``radius`` bits or fewer once."""
    if not 0 <= radius <= 3:
        raise ValueError("two segments with balls of radius one find up to 3 differing bits")
    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32)
    segments = F.array(*(F.struct(F.lit(k).alias("part"), s.alias("seg")) for k, s in enumerate((low, high))))
    stored = fps.select("fp", F.explode(segments).alias("s")).select("s.part", "s.seg", F.col("fp").alias("stored"))
    flips = F.expr("filter(transform(sequence(0, 31), i -> seg | shiftleft(1L, i)), x -> x != seg)")
    balls = stored.select("part", F.col("stored").alias("asked"), F.explode(F.concat(F.array("seg"), flips)).alias("seg"))
    crowded = stored.groupBy("part", "seg").count().where(F.col("count") > half_most).select("part", "seg")
    crowded = saved(crowded, "simhash-crowded")
    some = not crowded.isEmpty()
    if some:
        held = stored.join(crowded, ["part", "seg"], "left_semi")
        stored = stored.join(crowded, ["part", "seg"], "left_anti")
    met = stored.join(shuffled(balls), ["part", "seg"]).where((F.col("stored") != F.col("asked")) & (F.bit_count(F.col("stored").bitwiseXOR(F.col("asked"))) <= radius))
    if some:
        for part in (0, 1):
            masks = _masks(part, radius) or [0]
            near = held.where(F.col("part") == part).select("part", "seg", "stored", F.explode(F.array(*map(F.lit, masks))).alias("m"))
            whole = near.select("part", "seg", "stored", F.col("stored").bitwiseXOR(F.col("m")).alias("asked"))
            met = met.unionByName(whole.join(shuffled(fps.select(F.col("fp").alias("asked"))), "asked").where(F.col("stored") != F.col("asked")))
    return met.select(F.least("stored", "asked").alias("a"), F.greatest("stored", "asked").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, root) with the smallest node of each component as root.

    Large-star: of each node's neighbours, the larger ones are tied to the smallest; small-star:
    the smaller ones are. Both keep the components and end in stars. Each round is written to
    the shared folder; the driver sees only a count and a checksum.
    """
    spark = edges.sparkSession
    path = scratch_path(spark, "links")
    edges = saved(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "links", path)
    mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    while True:
        total = mark[0]
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = joined(both.where(F.col("v") > F.col("u")), least, ["u"], "n", total, FEW).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        tied = joined(large, least, ["u"], "n", total, FEW).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        before, old = mark, path
        path = scratch_path(spark, "links")
        edges = saved(tied.distinct(), "links", path)
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        delete(spark, old)
        if before == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _grouped(prints: DataFrame, radius: int) -> tuple[DataFrame, int]:
    """(fp, root, component_id, n) of each distinct fingerprint in ``prints`` (doc_id, fp), and the number of rows."""
    distinct = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")), "simhash-distinct")
    total, nodes = distinct.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    roots = components(links(distinct.select("fp"), radius))
    rooted = saved(distinct.join(shuffled(roots, nodes), distinct["fp"] == roots["node"], "left").select("fp", "first_id", "n", F.coalesce("root", "fp").alias("root")), "simhash-rooted")
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("__n"))
    return saved(joined(rooted, smallest, ["root"], "__n", nodes).select("fp", "root", "component_id", "n"), "simhash-groups"), total


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    prints = saved(fingerprints(docs, id_col, text_col, words), "simhash")
    groups, total = _grouped(prints, radius)
    return joined(prints, groups.drop("root"), ["fp"], "n", total).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_firsts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each group: of those with the smallest id (null last) the first text.

    Rows are told apart by id and text: rows that share an id but belong to different groups
    both stay, and of rows that agree in both one stays.
    """
    digest = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    prints = saved(fingerprints(docs.withColumn("__key", digest), id_col, text_col, words, "__key"), "simhash")
    groups, _ = _grouped(prints, radius)
    own = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.col("__key").alias("key"))
    firsts = prints.groupBy("fp").agg(F.min(own).alias("own")).join(shuffled(groups), "fp").groupBy("root").agg(F.min("own").alias("own"))
    firsts = firsts.select(F.col("own.doc_id").alias("__id"), F.col("own.key").alias("__first"))
    kept = docs.withColumn("__key", digest).join(shuffled(firsts), F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__first")), "left_semi")
    repeated = not prints.groupBy("doc_id", "__key").count().where("count > 1").isEmpty()
    return (kept.dropDuplicates([id_col, "__key"]) if repeated else kept).drop("__key")
