"""Exact dedup, line dedup and SimHash against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from quantloom.llm import exact_dedup, line_dedup, simhash

from .cases import ROWS, documents, empty

WHITE = re.compile(r"[\x20\x09-\x0D]")


def brute_exact(rows):
    groups = defaultdict(list)
    for k, (doc, text, *_) in enumerate(rows):
        groups[WHITE.sub("", text or "")].append((-len(text or ""), doc, k))
    out = []
    for norm, members in groups.items():
        best = min(members)
        for m in members:
            out.append((m[1], best[1], len(members), m[2] == best[2], hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0], r[3]))


@pytest.mark.parametrize("bucket_bytes", [1 << 20, 600])
def test_exact_groups(spark, bucket_bytes):
    got = sorted((tuple(r) for r in exact_dedup.exact_groups(documents(spark, True).repartition(3), bucket_bytes=bucket_bytes).collect()), key=lambda r: (r[0], r[3]))
    assert got == brute_exact(ROWS)


def test_exact_on_nothing(spark):
    assert exact_dedup.exact_groups(empty(spark)).count() == 0


def test_content_table_compares_contents():
    table = exact_dedup.ContentTable(8)
    places = [table.locate(5, str(k).encode()) for k in range(100)]  # one hash for all
    assert [p for p, new in places] == list(range(100)) and all(new for _, new in places)
    assert table.locate(5, b"42") == (42, False)


def brute_lines(rows, min_docs=3):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    holders = defaultdict(set)
    for doc, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(doc)
    out = []
    for doc, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def applied(index, df):
    return sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in index.apply(df).collect())


def test_lines(spark):
    df = documents(spark, True)
    index = line_dedup.LineIndex.build(df)
    out = index.apply(df)
    assert applied(index, df) == brute_lines(ROWS)
    assert "kept_text" in out.columns and "score" in out.columns
    none = empty(spark)
    assert line_dedup.LineIndex.build(none).apply(none).count() == 0


def state(index):
    return sorted((bytes(r.digest), r.n_docs, r.last_doc) for r in index.refs.collect())


def test_lines_are_reversible(spark):
    rows = [(k, f"{'common line of all documents here'}\nline of a few documents number {k % 3}\nown line of document number {k}", "en") for k in range(12)]
    make = lambda part: spark.createDataFrame(part, "doc_id long, text string, lang string")
    whole = line_dedup.LineIndex.build(make(rows))
    grown = line_dedup.LineIndex.build(make(rows[:5])).insert(make(rows[4:]))
    assert state(grown) == state(whole)
    shrunk = whole.delete(make(rows[9:]))
    assert state(shrunk) == state(line_dedup.LineIndex.build(make(rows[:9])))
    assert state(shrunk.insert(make(rows[9:]))) == state(whole)
    left = make(rows[:9])
    assert applied(shrunk, left) == brute_lines(rows[:9])


def test_cuckoo_filter():
    random.seed(1)
    keys = [random.getrandbits(64) for _ in range(5000)]
    f = line_dedup.CuckooFilter(len(keys))
    assert all(f.insert(k) for k in keys) and all(k in f for k in keys)
    assert sum(random.getrandbits(64) in f for _ in range(20000)) < 20
    for k in keys[:2500]:
        assert f.remove(k)
    assert all(k in line_dedup.CuckooFilter.from_bytes(f.to_bytes()) for k in keys[2500:])
    many = line_dedup.Filters(64)
    digests = [hashlib.md5(str(k).encode()).digest() for k in range(3000)]
    for d in digests:
        many.insert(d)
    assert len(many.held) > 1 and all(d in many for d in digests)
    for d in digests[:1500]:
        assert many.remove(d)
    assert all(d in many for d in digests[1500:]) and sum(d in many for d in digests[:1500]) < 15


def test_filters_know_the_live_keys(spark):
    make = lambda ids: spark.createDataFrame([(k, f"a line of document number {k}\nthe common line of all of them") for k in ids], "doc_id long, text string")
    index = line_dedup.LineIndex.build(make(range(20))).insert(make(range(20, 30))).delete(make(range(10)))
    held = {r.shard: [] for r in index.filters.collect()}
    for r in index.filters.collect():
        held[r.shard].append(line_dedup.CuckooFilter.from_bytes(bytes(r.blob)))
    live = [bytes(r.digest) for r in index.refs.collect()]
    assert len(live) == 21 and all(any(line_dedup._hash(d) in f for f in held[0]) for d in live)
    assert sum(sum(map(bool, f.cells)) for f in held[0]) == 21  # what was deleted is forgotten


def test_shards_grow_and_changes_touch_their_shards_only(spark, monkeypatch):
    """Twenty times the first size, version upon version; exact look-ups are for keys that a filter knows."""
    import os

    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 100)
    rows = [(k, "\n".join(f"line number {j} of document {k}" for j in range(9)) + f"\na line of every third document {k % 3}", "en") for k in range(260)]
    make = lambda part: spark.createDataFrame(part, "doc_id long, text string, lang string")
    index, parts = line_dedup.LineIndex.build(make(rows[:20])), []
    assert index.n_shards == 2
    for at in range(20, 260, 80):
        index = index.insert(make(rows[at : at + 80]))
        parts.append(index.n_shards)
    assert parts[-1] >= 8 and index.filters.count() >= index.n_shards
    assert max(r["count"] for r in index.refs.groupBy("shard").count().collect()) < 400
    assert state(index) == state(line_dedup.LineIndex.build(make(rows)))
    # one document more: new folders for the shards of its keys alone
    new = index.insert(make([(1000, "one single new line of its own\na line of every third document 1", "en")]))
    (_, path), = set(new._refs) - set(index._refs)
    assert len([d for d in os.listdir(path.removeprefix("file:")) if d.startswith("shard=")]) <= 2
    assert new._refs[:-1] == index._refs and new._postings[:-1] == index._postings
    monkeypatch.setattr(line_dedup, "VERSIONS", 4)
    for _ in range(2):  # deleted and inserted again, over the number of versions
        new = new.delete(make(rows[5:6])).insert(make(rows[5:6]))
    whole = line_dedup.LineIndex.build(make([*rows, (1000, "one single new line of its own\na line of every third document 1", "en")]))
    assert state(new) == state(whole) and len(new._refs) <= line_dedup.VERSIONS
    assert applied(new, make(rows)) == applied(whole, make(rows)) == brute_lines([*rows, (1000, "one single new line of its own\na line of every third document 1")])[:-1]


def brute_print(text, words=3):
    found = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) if w]
    if not found:
        return 0
    shingles = [" ".join(found[k : k + words]) for k in range(len(found) - words + 1)] or [" ".join(found)]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, radius):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in ids:
        for j in ids:
            if i < j and bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def test_fingerprints():
    for _, text, _ in ROWS:
        assert simhash.fingerprint((text or "").encode()) == brute_print(text)


def test_near_groups(spark):
    random.seed(3)
    base = " ".join(random.choice("red green blue fast slow big small warm cold".split()) for _ in range(300))
    rows = [r for k, r in enumerate(ROWS) if k < 12] + [(100 + k, base + " tail" * (k % 4) + f" x{k % 7}", "en") for k in range(40)]
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in simhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    prints = {doc: brute_print(text) for doc, text, _ in rows}
    assert {d: p for d, (p, _) in got.items()} == prints
    assert {d: c for d, (_, c) in got.items()} == brute_components(prints, 2)
    assert simhash.near_groups(empty(spark)).count() == 0
    kept = simhash.keep_firsts(documents(spark, True)).collect()
    assert len([r for r in kept if r.doc_id == 12]) == 1 and {r.doc_id for r in kept} >= {1, 4, 6} and 7 not in {r.doc_id for r in kept}


def test_links_find_all_pairs(spark):
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = set()
    for s in seeds.tolist():
        fps.add(s)
        for _ in range(12):
            x = s
            for b in rng.choice(64, rng.integers(1, 5), replace=False).tolist():
                x ^= 1 << b
            fps.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    for radius in (0, 2, 3):
        got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), radius).collect()}
        wanted = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= radius}
        assert got == wanted
        crowded = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), radius, half_most=2).collect()}
        assert crowded == wanted
    # many fingerprints that share a half
    half = [(7 << 32) + k for k in range(200)]
    got = simhash.links(spark.createDataFrame([(x,) for x in half], "fp long"), 2, half_most=50).count()
    assert got == sum(bin(a ^ b).count("1") <= 2 for a in half for b in half if a < b)
    # a chain longer than any radius is one component
    chain = [(1 << k) - 1 for k in range(60)]
    edges = spark.createDataFrame([(a, b) for a, b in zip(chain, chain[1:])], "a long, b long")
    assert {r.root for r in simhash.components(edges).collect()} == {0}

def test_near_firsts_lose_no_group(spark):
    """Rows are told apart by id and text: repeated and null ids lose nothing."""
    words = lambda k: " ".join(f"w{k}x{j}" for j in range(40))
    rows = [(None, words(1)), (None, words(2)), (5, words(3)), (5, words(4)), (5, words(4)), (6, words(4)), (None, words(3)), (1, ""), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r.doc_id, r.text) for r in simhash.keep_firsts(df).collect()), key=repr)
    assert kept == sorted([(None, words(1)), (None, words(2)), (5, words(3)), (5, words(4)), (1, "")], key=repr)


def test_hot_keys_join_like_others(spark, monkeypatch):
    from quantloom.llm import _common

    monkeypatch.setattr(_common, "HOT_PART", 4)
    rows = spark.createDataFrame([(k % 3 if k < 90 else k, k) for k in range(100)], "key long, row long")
    table = rows.groupBy("key").count().withColumnRenamed("count", "n")
    got = _common.joined(rows, table.selectExpr("key", "n", "key * 10 AS ten"), ["key"], "n", 100)
    assert sorted((r.key, r.row, r.ten) for r in got.collect()) == sorted((r.key, r.row, r.key * 10) for r in rows.collect()) and got.columns == ["key", "row", "ten"]


def test_growing_tables_are_not_broadcast(spark):
    """By Spark's own estimate, that of the compressed file, the balls of some 300,000 fingerprints were sent to the driver."""
    from quantloom.llm._common import SENT_MOST, joined, saved

    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    fps = saved(spark.range(1000).selectExpr("xxhash64(id) AS fp"), "test-fps")
    assert "BroadcastHashJoin" not in plan(simhash.links(fps)) and "SortMergeJoin" in plan(simhash.links(fps))
    rows, table = fps.selectExpr("fp % 7 AS k"), saved(spark.range(7).selectExpr("id AS k", "1L AS n"), "test-table")
    assert "BroadcastHashJoin" in plan(joined(rows, table, ["k"], "n", SENT_MOST, 1 << 20))
    assert "BroadcastHashJoin" not in plan(joined(rows, table, ["k"], "n", SENT_MOST + 1, 1 << 20))
    assert "SortMergeJoin" in plan(joined(rows, table, ["k"], "n", SENT_MOST + 1))
