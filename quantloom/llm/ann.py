"""Approximate nearest neighbours with randomly rotated one-bit codes.

Index. Vectors are scaled to length one and turned by a random rotation (seeded QR of a Gaussian
matrix). A sample of ``FIT_ROWS`` distinct vectors at most gives the centres of about sqrt(n)
cells. Every distinct vector x is stored once, in the cell of its nearest centre c, as the packed
signs of its residual x - c = r o (8 to a byte) and the scalars r, f = <s, o> and <o, c>, where s
is the sign vector over sqrt(d).

Search. A query q of length one looks at the codes in its ``probes`` nearest cells only. With
t = q - c, <s, t> / f estimates <o, t>, and so <x, q> = <c, q> + r (<o, c> + <o, t>) is known up to
r |t| EPS sqrt((1 - f^2) / (f^2 (d - 1))) but with a probability that EPS makes tiny (published
analysis of such codes). Where |t| > 1, <s, q> / f estimates <o, q> instead, with |q| = 1 in the
bound. The sums are taken from tables, an entry for each byte of the code. Codes whose upper
bound reaches neither the k-th best score within the sample nor the k-th largest lower bound in
the cell are out; the rest are reranked on the original vectors, which lie beside the codes, in
double precision, and k + 1 a cell and query leave it.

``probes`` is the smallest number of cells that hold a share ``TARGET`` of the true neighbours of
up to ``FIT_QUERIES`` queries within the sample, measured by brute force when the index is fitted.

What is shuffled grows with the table: keys, codes and vectors when the index is written, codes
and vectors again when it is searched, and a query's vector for each cell it probes. Equal
vectors are one in all of this, as rows and as queries: the k + 1 smallest ids of each (with how
often they occur) stand for all of them, exactly, since their scores are equal. Large cells are
cut into blocks.

Defined cases: vectors that are null, of length zero, of another dimension than the most common
one, or hold a null, NaN or infinite component, and rows with a null id, take no part, as queries
or as candidates; equal scores go to the smaller id; a query is not its own candidate, rows
repeating its id included; a row that is repeated counts as often as it occurs as a candidate and
once as a query, and several vectors under one query id are ranked together; an empty table
gives no rows; further columns are ignored. Ids are whole numbers.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantloom.llm._common import joined, saved, small

K, EPS, SEED = 5, 3.0, 20
FIT_ROWS, FIT_QUERIES, TARGET = 10_000, 512, 0.99
ROW_BLOCK, QUERY_BLOCK = 8192, 1024
_ROUNDS = 8
#: +1 or -1 for each bit (from the highest) of each byte.
_SIGNS = (np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).T.astype(np.float32) * 2) - 1


@functools.lru_cache(maxsize=4)
def rotation(d: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


@dataclass
class Codes:
    """Packed signs of residuals, and their scalars."""

    bits: np.ndarray
    length: np.ndarray
    share: np.ndarray
    along: np.ndarray


def encode(x: np.ndarray, center: np.ndarray) -> Codes:
    """Codes of turned vectors of length one, relative to ``center`` (one for all, or a row each)."""
    residual = x - center
    length = np.sqrt((residual * residual).sum(axis=1))
    o = residual / np.where(length > 0, length, 1)[:, None]
    return Codes(np.packbits(o > 0, axis=1), length, np.abs(o).sum(axis=1) / math.sqrt(x.shape[1]), (o * center).sum(axis=1))


def estimates(codes: Codes, center: np.ndarray, queries: np.ndarray, eps: float = EPS) -> tuple[np.ndarray, np.ndarray]:
    """(queries x codes) estimated inner products of turned queries with coded vectors, and their error bounds."""
    d = queries.shape[1]
    t = np.zeros((len(queries), 8 * codes.bits.shape[1]), np.float32)
    t[:, :d] = queries - center
    whole = np.linalg.norm(t, axis=1) > np.linalg.norm(queries, axis=1)
    t[whole, :d] = queries[whole]
    by_byte = t.reshape(len(queries), -1, 8) @ _SIGNS
    signs = np.zeros((len(queries), len(codes.bits)), np.float32)
    for j in range(codes.bits.shape[1]):
        signs += by_byte[:, j].take(codes.bits[:, j], axis=1)
    f = np.maximum(codes.share, 1e-9)
    found = (queries @ center)[:, None] + codes.length * (np.where(whole[:, None], 0, codes.along) + signs / (math.sqrt(d) * f))
    wide = eps * codes.length * np.sqrt(np.maximum(0, 1 - f * f) / (f * f * max(d - 1, 1)))
    return found, np.linalg.norm(t, axis=1)[:, None] * wide + 1e-5


def cosines(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Of each row with its query (or one query for all), in double precision, summed component by component, so equal vectors get equal scores."""
    queries = np.atleast_2d(queries)
    dot, own, other = np.zeros(len(rows)), np.zeros(len(rows)), np.zeros(len(queries))
    for j in range(rows.shape[1]):
        dot += rows[:, j] * queries[:, j]
        own += rows[:, j] * rows[:, j]
        other += queries[:, j] * queries[:, j]
    return dot / (np.sqrt(own) * np.sqrt(other))


@dataclass
class Index:
    """What is fitted: the sample and the centres in the turned space, and how many cells a query looks at."""

    d: int
    seed: int
    sample: np.ndarray
    centers: np.ndarray
    probes: int

    def turned(self, vectors: np.ndarray) -> np.ndarray:
        return unit(vectors) @ rotation(self.d, self.seed)

    def least(self, x: np.ndarray, k: int) -> np.ndarray:
        """A lower bound of the k-th best score of each query: the next one after it in the sample, since one may be its own."""
        if len(self.sample) <= k:
            return np.full(len(x), -np.inf)
        return -np.partition(-(x.astype(np.float32) @ self.sample.T), k, axis=1)[:, k].astype(np.float64) - 1e-5

    def cells(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([(x[at : at + 4096] @ self.centers.T).argmax(axis=1) for at in range(0, len(x), 4096)] or [np.zeros(0, np.int64)])


def fit(sample: np.ndarray, n: int, queries: np.ndarray | None = None, k: int = K, target: float = TARGET, seed: int = SEED) -> Index:
    """Centres by spherical k-means of ``sample``, for ``n`` vectors; probes measured on ``queries`` (row numbers of the sample)."""
    d = sample.shape[1]
    index = Index(d, seed, np.zeros((0, d), np.float32), np.zeros((1, d)), 1)
    x = index.turned(sample)
    index.sample = x.astype(np.float32)
    n_cells = max(1, min(round(math.sqrt(n)), len(x) // 8))
    index.centers = x[np.random.default_rng(seed).permutation(len(x))[:n_cells]]
    for _ in range(_ROUNDS):
        own = index.cells(x)
        sums = np.zeros_like(index.centers)
        np.add.at(sums, own, x)
        norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        index.centers = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), index.centers)
    own = index.cells(x)
    asked = np.arange(len(x)) if queries is None or not len(queries) else queries
    asked = asked[:: max(1, -(-len(asked) // FIT_QUERIES))]
    places = []
    for q in asked.tolist():
        score = x @ x[q]
        score[q] = -np.inf
        near = np.argpartition(-score, min(k, len(x) - 1))[:k] if len(x) > k else np.delete(np.arange(len(x)), q)
        place = np.empty(n_cells, np.int64)
        place[np.argsort(-(index.centers @ x[q]), kind="stable")] = np.arange(n_cells)
        places.append(place[own[near]])
    flat = np.sort(np.concatenate(places)) if places else np.zeros(0, np.int64)
    index.probes = int(flat[min(len(flat) - 1, math.ceil(target * len(flat)) - 1)]) + 1 if len(flat) else 1
    return index


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), dtype=np.float64).reshape(len(flat), -1)


_CODES = "vec_id long, h1 long, h2 long, cell int, bits binary, length double, share double, along double, embedding array<double>"
_ROUTES = "q1 long, q2 long, cell int, least double, asked array<double>"
_SCORES = "q1 long, q2 long, h1 long, h2 long, score double"


def _coder(shared):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = index.turned(_matrix(batch["embedding"]))
            cell = index.cells(x)
            own = encode(x, index.centers[cell])
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["h1"], batch["h2"], pa.array(cell, pa.int32()), pa.array([r.tobytes() for r in own.bits], pa.binary()), pa.array(own.length), pa.array(own.share), pa.array(own.along), batch["embedding"]], names=["vec_id", "h1", "h2", "cell", "bits", "length", "share", "along", "embedding"])

    return code


def _router(shared, k: int):
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                x = index.turned(_matrix(part["embedding"]))
                near = np.argsort(-(x @ index.centers.T), axis=1, kind="stable")[:, : index.probes]
                n = near.shape[1]
                repeat = np.repeat(np.arange(len(x)), n)
                least = index.least(x, k)[repeat]
                yield pa.RecordBatch.from_arrays([part["h1"].take(pa.array(repeat)), part["h2"].take(pa.array(repeat)), pa.array(near.ravel(), pa.int32()), pa.array(least), part["embedding"].take(pa.array(repeat))], names=["q1", "q2", "cell", "least", "asked"])

    return route


def _searcher(shared, k: int, eps: float):
    def search(key: tuple, queries: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = []
        if queries.num_rows and rows.num_rows:
            center, vectors, asked = shared.value.centers[key[0].as_py()], _matrix(rows["embedding"]), _matrix(queries["asked"])
            number = lambda name: rows[name].to_numpy()
            bits = np.frombuffer(b"".join(rows["bits"].to_pylist()), np.uint8).reshape(rows.num_rows, -1)
            codes = Codes(bits, number("length"), number("share"), number("along"))
            h1, h2, ids = number("h1"), number("h2"), number("vec_id")
            q1, q2, known = (queries[c].to_numpy() for c in ("q1", "q2", "least"))
            turned = shared.value.turned(asked)
            step = max(1, (1 << 20) // len(ids))
            for at in range(0, len(q1), step):
                part = slice(at, at + step)
                found, error = estimates(codes, center, turned[part], eps)
                own = (h1 == q1[part, None]) & (h2 == q2[part, None])
                low = np.where(own, -np.inf, found - error)
                least = np.maximum(known[part], np.partition(low, -k, axis=1)[:, -k] if len(ids) > k else -np.inf)
                q, near = np.nonzero(own | (found + error >= least[:, None]))
                score = np.concatenate([cosines(vectors[near[j : j + 8192]], asked[part][q[j : j + 8192]]) for j in range(0, len(q), 8192)] or [np.zeros(0)])
                # The best k + 1 of each query, and its own vector, which other ids may have, too.
                order = np.lexsort((ids[near], -score, ~own[q, near], q))
                q, near, score = q[order], near[order], score[order]
                place = np.arange(len(q)) - np.searchsorted(q, q)
                best = place <= k + 1
                q, near = q[best], near[best]
                out.append([q1[part][q], q2[part][q], h1[near], h2[near], score[best]])
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 4 + [np.zeros(0)]
        return pa.table(dict(zip(("q1", "q2", "h1", "h2", "score"), columns, strict=True)))

    return search


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, and not all zero."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda v: v != 0)


def _fitted(rows: DataFrame, ids: DataFrame, nodes: DataFrame, k: int, fit_rows: int, target: float) -> Index | None:
    """The index of a sample of distinct vectors, chosen by their hash; all of them if they are few."""
    n = nodes.count()
    if not n:
        return None
    own = nodes.where(F.pmod(F.xxhash64("h1"), F.lit(-(-n // fit_rows))) == 0).select("h1", "h2", F.col("rep").alias("vec_id")).limit(2 * fit_rows)
    asked = ids.where("is_query").select("h1", "h2").distinct().withColumn("asked", F.lit(True))
    keys = ["h1", "h2", "vec_id"]
    # ``own`` has 2 * fit_rows rows at most.
    picked = rows.drop("is_query").join(F.broadcast(own), keys).groupBy(*keys).agg(F.first("embedding").alias("embedding"))
    held = picked.join(asked, ["h1", "h2"], "left").select("h1", "h2", "embedding", F.coalesce("asked", F.lit(False)).alias("asked")).toArrow()
    order = np.lexsort((held["h2"].to_numpy(), held["h1"].to_numpy()))
    queries = np.flatnonzero(held["asked"].to_numpy(zero_copy_only=False)[order])
    return fit(_matrix(held["embedding"])[order], n, queries, k, target) if len(order) else None


def nearest(
    vectors: DataFrame, is_query: Column, k: int = K, eps: float = EPS, id_col: str = "vec_id", vector_col: str = "embedding",
    row_block: int = ROW_BLOCK, query_block: int = QUERY_BLOCK, fit_rows: int = FIT_ROWS, target: float = TARGET,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of each row that ``is_query`` marks."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = rows.where(F.coalesce(usable(F.col("embedding")), F.lit(False)) & F.col("vec_id").isNotNull())
    common = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    rows = rows.where(F.size("embedding") == (common[0]["d"] if common else 0)).withColumns({"h1": F.xxhash64("embedding"), "h2": F.xxhash64(F.lit(1), "embedding")})
    keys, query = ["vec_id", "h1", "h2"], ["q1", "q2"]

    # Ids by vector; of each vector the k + 1 smallest ids, with how often they occur (k times is enough).
    ids = saved(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.bool_or("is_query").alias("is_query")), "ann-ids")
    first = Window.partitionBy("h1", "h2").orderBy("vec_id")
    few = ids.withColumn("__r", F.row_number().over(first)).where(F.col("__r") <= k + 1)
    nodes = few.groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.array_sort(F.collect_list(F.struct("vec_id", F.least("n", F.lit(k)).cast("int").alias("n")))).alias("ids"))
    nodes = saved(nodes, "ann-nodes")
    index = _fitted(rows, ids, nodes, k, fit_rows, target)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(index)  # a centre a cell: bounded by fit_rows

    coded = rows.select("vec_id", "h1", "h2", "embedding").mapInArrow(small(_coder(shared)), _CODES)
    codes = saved(coded.join(nodes.select("h1", "h2", F.col("rep").alias("vec_id")), keys, "left_semi").dropDuplicates(keys), "ann-codes")
    asked = rows.where("is_query").groupBy("h1", "h2").agg(F.first("embedding").alias("embedding"))
    asked = saved(asked, "ann-queries")
    routes = saved(asked.mapInArrow(small(_router(shared, k)), _ROUTES), "ann-routes")

    # A row per cell, of which there are as many as centres.
    sizes = codes.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / row_block).cast("int").alias("rbs")).join(routes.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / query_block).cast("int").alias("qbs")), "cell")
    sizes = F.broadcast(saved(sizes, "ann-cells"))
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    stored = codes.join(sizes, "cell").withColumn("rb", F.pmod(F.xxhash64("h1"), "rbs").cast("int")).withColumn("qb", upto("qbs")).drop("rbs", "qbs")
    probing = routes.join(sizes, "cell").withColumn("qb", F.pmod(F.xxhash64("q1"), "qbs").cast("int")).withColumn("rb", upto("rbs")).drop("rbs", "qbs")
    block = ["cell", "rb", "qb"]
    scores = probing.groupBy(*block).cogroup(stored.groupBy(*block)).applyInArrow(_searcher(shared, k, eps), _SCORES)

    # Of each query vector the k + 1 best ids, so that k are left without the query's own.
    each = scores.join(nodes.select("h1", "h2", F.explode("ids").alias("i")), ["h1", "h2"]).select(*query, "score", "i.vec_id", "i.n")
    by_id = each.groupBy(*query, "vec_id").agg(F.max("score").alias("score"), F.collect_list(F.struct("score", "n")).alias("entries"))
    order = Window.partitionBy(*query).orderBy(F.desc("score"), "vec_id")
    listed = by_id.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= k + 1).groupBy(*query).agg(F.collect_list(F.struct("vec_id", "entries")).alias("found"))
    queries = ids.where("is_query").select(F.col("h1").alias("q1"), F.col("h2").alias("q2"), F.col("vec_id").alias("query_id"))
    lists = saved(listed.join(queries.groupBy(*query).agg(F.count(F.lit(1)).alias("__n")), query), "ann-lists")
    found = joined(queries, lists, query, "__n", lists.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0])
    found = found.select("query_id", F.explode("found").alias("f")).where(F.col("query_id") != F.col("f.vec_id")).select("query_id", "f.vec_id", F.inline("f.entries"))
    found = found.select("query_id", "vec_id", "score", F.explode(F.sequence(F.lit(1), "n")).alias("__copy"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
