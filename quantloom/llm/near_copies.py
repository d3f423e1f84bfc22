"""Near copies of whole texts: Jaccard similarity of five-word shingles, found by SimHash and MinHash bands.

Shingles: A-Z lower-cased, words are runs of non-white ASCII, shingles are ``WORDS`` consecutive
words joined by a space, each counted once; a shorter text is one shingle. Two texts are near
copies if their sets of shingles agree by ``SHARE`` (0.8) or more; groups are the components of
these links.

Search: operator 7 (``simhash``) makes fingerprints of the same shingles, repeats included, joins those
that differ in ``RADIUS`` bits or fewer by multi-index hashing and forms their components. Near copies at
0.8 differ in more bits than balls can reach, so each text is also in ``BANDS`` bands of ``ROWS`` MinHash
values; a group of fingerprints is one more band of its members. Two texts at similarity s share a band
with probability 1 - (1 - s^ROWS)^BANDS or more, which is 0.999997 at 0.8. Of the pairs that share a band,
those of whose BANDS * ROWS values fewer than ``MARKS_LEAST`` agree (in their last 8 bits) are out: at 0.8,
77 of 96 agree in the mean and fewer than 58 with a probability of some 3e-6. The rest are verified on
the shingles themselves, so no wrong link is made.

A band that many texts share isn't paired off: its members are first compared with its smallest
member and with the one in its middle, and the components of these links are formed. Then only bands that still
have several components are looked at, and only across components, since a link within one changes
nothing. Bands of ``CROWD`` members or fewer are paired off. Members of larger ones, such as texts with
one long passage in common, meet by their rarest shingles instead: two sets of n and m shingles that
agree by SHARE have one in common among the n - ceil(SHARE n) + 1 and m - ceil(SHARE m) + 1 that come
first in any one order, here from the rarest to the most frequent of these texts. The result has the
components of all pairs that share a band.

Texts with the same words are one node and take part once. Shingles are kept only of texts that
share a band. Nodes that very many rows hold are joined by broadcast (``_common.joined``).

Defined cases: a null text counts as empty; texts without words are copies of each other; very long
texts are taken whole; rows that share an id but hold different texts are told apart by the text;
repeated rows stay once; of a group the row with the smallest id stays (null last), then the
smallest digest; an empty table gives no rows; further columns pass through, but for __key, which
is used here. Ids are whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantloom.llm import simhash
from quantloom.llm._common import joined, raw, saved, shuffled, small
from quantloom.llm.simhash import FEW, components

WORDS, SEED = 5, 42
#: Differing bits of fingerprints that operator 7's two segments find.
RADIUS = 2
BANDS, ROWS = 24, 4
#: SHARE as a fraction of whole numbers: 4 of 5.
SHARE = (4, 5)
MARKS_LEAST = 58
#: Members of a band that are paired off at most, if they aren't in one component yet.
CROWD = 8
_MIXERS = np.random.default_rng(SEED).integers(1, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64)
_ADDED, _FACTORS = _MIXERS[0], _MIXERS[1] | np.uint64(1)
_BAND_FACTORS = np.random.default_rng(SEED + 1).integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
#: Shingles hashed by all functions at once.
_BLOCK = 1 << 12


def shingles(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles; none for a text without words."""
    return np.unique(simhash.shingle_hashes(text, words))


def bands(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One number a band, and the last 8 bits of each MinHash value; none without shingles."""
    if not len(hashes):
        return hashes, np.zeros(0, np.int8)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(hashes), _BLOCK):
        mixed = (hashes[k : k + _BLOCK, None] ^ _ADDED) * _FACTORS
        least = np.minimum(least, (mixed ^ mixed >> np.uint64(32)).min(axis=0))
    folded = (least.reshape(BANDS, ROWS) * _BAND_FACTORS).sum(axis=1, dtype=np.uint64)
    return (folded ^ folded >> np.uint64(29)) * _BAND_FACTORS[:, 0], least.astype(np.uint8).view(np.int8)


_NODES = pa.schema([("key", pa.string()), ("doc_id", pa.int64()), ("digest", pa.string()), ("node", pa.binary()), ("bands", pa.list_(pa.int64())), ("marks", pa.list_(pa.int8())), ("fp", pa.int64())])
_NODES_DDL = "key string, doc_id long, digest string, node binary, bands array<long>, marks array<tinyint>, fp long"
_SETS = pa.schema([("node", pa.binary()), ("shingles", pa.list_(pa.int64()))])


def _lists(parts: list[np.ndarray], kind: type) -> pa.Array:
    flat = np.concatenate([*parts, np.zeros(0, parts[0].dtype if parts else kind)]).view(kind)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(flat))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = raw(batch.column(3))
        nodes = [hashlib.md5(b" ".join((t or b"").lower().split())).digest() for t in texts]
        found, fps = [], []
        for t in texts:
            hashes = simhash.shingle_hashes(t, WORDS)
            found.append(bands(np.unique(hashes)))
            fps.append(simhash.majority(hashes))
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), batch.column(1), batch.column(2).cast(pa.string()), pa.array(nodes, pa.binary()), _lists([b for b, _ in found], np.int64), _lists([m for _, m in found], np.int8), pa.array(np.array(fps, np.uint64).view(np.int64))], schema=_NODES)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), _lists([shingles(t) for t in raw(batch.column(1))], np.int64)], names=["node", "shingles"])


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, doc_id, digest, text): the key tells rows apart by id and text."""
    return docs.select(_key(id_col, text_col).alias("key"), F.col(id_col).cast("long").alias("doc_id"), _digest(text_col).alias("digest"), F.col(text_col).alias("text"))


def _digest(text_col: str) -> Column:
    return F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))


def _key(id_col: str, text_col: str) -> Column:
    return F.concat(F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")), F.lit(":"), _digest(text_col))


def alike(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``pairs`` (a, b) of ``nodes`` (node, marks) that agree in MARKS_LEAST marks or more."""
    side = lambda name: nodes.select(F.col("node").alias(name), F.col("marks").alias(f"of_{name}"))
    same = F.aggregate(F.zip_with("of_a", "of_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    return pairs.join(side("b"), "b").join(side("a"), "a").where(same >= MARKS_LEAST).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) whose ``sets`` (node, shingles) agree by SHARE or more."""
    part, whole = SHARE
    side = lambda name: sets.select(F.col("node").alias(name), F.col("shingles").alias(f"of_{name}"))
    n, m = F.size("of_a"), F.size("of_b")
    fit = pairs.join(side("b"), "b").join(side("a"), "a").where(whole * F.least(n, m) >= part * F.greatest(n, m))
    both = F.size(F.array_intersect("of_a", "of_b"))
    return fit.where((part + whole) * both >= part * (n + m)).select("a", "b")


def by_fingerprint(nodes: DataFrame) -> DataFrame:
    """``nodes`` (node, fp) -> (node, band): operator 7's groups of fingerprints within ``RADIUS`` bits, of two nodes or more."""
    own = saved(nodes.groupBy("fp").agg(F.count(F.lit(1)).alias("n")), "near-fps")
    roots = components(simhash.links(own.select("fp"), RADIUS))
    rooted = saved(own.join(shuffled(roots), own["fp"] == roots["node"], "left").select("fp", "n", F.coalesce("root", "fp").alias("band")), "near-fp-roots")
    several = rooted.groupBy("band").agg(F.sum("n").alias("size")).where("size > 1").select("band")
    held = rooted.join(shuffled(several), "band").select("fp", "band", "n")
    total = own.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return joined(nodes.select("node", "fp"), saved(held, "near-fp-groups"), ["fp"], "n", total).select("node", "band")


def _groups(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """``nodes`` (node, first, bands, marks, fp) of ``rows`` (key, text), a row per key -> (node, root) of those that are linked to others."""
    members = nodes.select("node", F.explode("bands").alias("band")).unionByName(by_fingerprint(nodes.where(F.size("bands") > 0))).repartition("band")
    shared = members.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("size")).where("low <> high")
    close = saved(members.join(shared, "band"), "near-close")
    # Copies of one text keep most of its values, so the text in the middle of a group shares the most bands with others.
    middles = close.groupBy("node").agg(F.sum("size").alias("score"))
    middles = close.select("band", "node").join(middles, "node").groupBy("band").agg(F.max_by("node", F.struct("score", "node")).alias("mid"))
    close = saved(close.select("band", "node", "low").join(middles, "band"), "near-close")
    wanted = saved(nodes.join(close.select("node").distinct(), "node", "left_semi").select("node", "first.key", "marks"), "near-wanted")
    found = rows.select("key", "text").join(wanted.select("key", "node"), "key").select("node", "text")
    sets = saved(found.mapInArrow(small(_sets), "node binary, shingles array<long>"), "near-sets")

    ends = close.select(F.explode(F.array("low", "mid")).alias("a"), F.col("node").alias("b")).where("a <> b").distinct()
    links = saved(verified(alike(ends, wanted), sets), "near-links")
    roots = components(links)

    placed = close.join(roots, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root"))
    sizes = placed.groupBy("band", "root").count()
    mixed = sizes.groupBy("band").agg(F.max_by("root", "count").alias("top"), F.count(F.lit(1)).alias("n"), F.sum("count").alias("members")).where("n > 1").drop("n")
    placed = saved(placed.join(mixed, "band"), "near-mixed")
    paired = placed.where(F.col("members") <= CROWD)
    # each pair across components once: from the member outside the largest, or from the smaller of two outside
    left = paired.where("root <> top").select("band", F.col("node").alias("a"), F.col("root").alias("root_a"))
    right = paired.select("band", F.col("node").alias("b"), F.col("root").alias("root_b"), "top")
    across = left.join(right, "band").where("root_a <> root_b AND (root_b = top OR a < b)").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    crowd = placed.where(F.col("members") > CROWD).select("node", "root").distinct()
    across = across.unionByName(by_rarest(sets.join(crowd, "node"))).distinct()
    tried = ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = saved(verified(alike(across.join(tried, ["a", "b"], "left_anti"), wanted), sets), "near-links")
    return roots if more.isEmpty() else components(links.unionByName(more))


def by_rarest(sets: DataFrame) -> DataFrame:
    """``sets`` (node, shingles, root) -> pairs (a, b), a < b, of different roots that have one of their first shingles in common."""
    part, whole = SHARE
    sets = sets.withColumn("n", F.size("shingles"))
    each = saved(sets.select("node", "root", "n", F.explode("shingles").alias("s")), "near-shingles")
    often = each.groupBy("s").agg(F.count(F.lit(1)).alias("often"))
    # in one text alone, a shingle meets none: it takes its place in the order, but isn't looked up
    ordered = each.join(often.where("often > 1"), "s", "left").groupBy("node", "root", "n").agg(F.count_if(F.col("often").isNull()).alias("alone"), F.array_sort(F.collect_list(F.when(F.col("often").isNotNull(), F.struct("often", "s")))).alias("shared"))
    first = F.col("n") - F.expr(f"int(ceil({part} * n / {whole}d))") + 1
    keys = ordered.select("node", "root", "n", "alone", F.posexplode(F.slice("shared", F.lit(1), F.greatest(first - F.col("alone"), F.lit(0)).cast("int"))).alias("at", "k"))
    keys = keys.select("node", "root", "n", (F.col("alone") + F.col("at") + 1).alias("at"), "k.s")
    several = keys.groupBy("s").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("s")
    keys = saved(keys.join(several, "s", "left_semi"), "near-rarest")
    # With a set that is no smaller, more has to be common: fewer first shingles do for the smaller of two.
    most = lambda n, m: F.col(n) + 1 - F.expr(f"int(ceil({part} * ({n} + {m}) / {part + whole}d))")
    one, two = (keys.select("s", *(F.col(c).alias(f"{c}_{side}") for c in ("node", "root", "n", "at"))) for side in "ab")
    two = two.where(F.col("at_b") <= most("n_b", "n_b"))
    larger = (F.col("n_a") > F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("node_a") < F.col("node_b")))
    met = one.join(two, "s").where(larger & (F.col("root_a") != F.col("root_b")) & (whole * F.col("n_b") >= part * F.col("n_a")) & (F.col("at_a") <= most("n_a", "n_b")) & (F.col("at_b") <= most("n_b", "n_a")))
    return met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))


def keep_firsts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near copies: that with the smallest id, once."""
    rows = _rows(docs, id_col, text_col)
    sketches = saved(rows.mapInArrow(small(_sketches), _NODES_DDL), "near-sketches")
    repeated = not sketches.groupBy("key").count().where("count > 1").isEmpty()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest", "key")).alias("first")
    nodes = saved(sketches.groupBy("node").agg(first, F.count(F.lit(1)).alias("n"), F.first("bands").alias("bands"), F.first("marks").alias("marks"), F.first("fp").alias("fp")), "near-nodes")
    roots = _groups(nodes, rows.dropDuplicates(["key"]) if repeated else rows)
    rooted = saved(nodes.join(roots, "node", "left").select("node", "first", "n", F.coalesce("root", "node").alias("root")), "near-rooted")
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("__n"))
    total, n_nodes = rooted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    kept = saved(joined(rooted.select("node", "n", "root"), firsts, ["root"], "__n", n_nodes, FEW).select("node", "n", F.col("first.key").alias("kept")), "near-kept")
    drops = joined(sketches.select("key", "node"), kept, ["node"], "n", total).where("key <> kept").select(F.col("key").alias("__key")).distinct()
    left = docs.withColumn("__key", _key(id_col, text_col)).join(saved(drops, "near-drops"), "__key", "left_anti")
    return (left.dropDuplicates(["__key"]) if repeated else left).drop("__key")
