"""The near-dedup stage against brute-force Jaccard of five-word shingles."""

import random
import re

import pytest

import corpus_pipeline
from quantloom.llm import near_copies


def brute_shingles(text, words=5):
    found = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) if w]
    return {" ".join(found[k : k + words]) for k in range(max(1, len(found) - words + 1))} if found else set()


def brute_firsts(rows):
    """(id, text) of the smallest id of each component at Jaccard >= 0.8; copies of one text are one."""
    sets = [brute_shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if 5 * len(a & b) >= 4 * len(a | b):
                root[find(i)] = find(j)
    groups = {}
    for i, row in enumerate(rows):
        groups.setdefault(find(i), []).append(row)
    return sorted(min(g) for g in groups.values())


def edited(words, n, rng):
    out = list(words)
    for k in rng.sample(range(len(out)), n):
        out[k] = f"edit{rng.random()}"
    return out


def corpus():
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for base in range(12):
        words = rng.choices(vocabulary, k=rng.choice([40, 120, 400]))
        for n in (0, 0, 1, 1, 2, 3, 4, 6, 9):
            rows.append((len(rows), " ".join(edited(words, n, rng))))
    chain = rng.choices(vocabulary, k=200)  # neighbours are near copies, the ends aren't
    for k in range(0, 120, 8):
        rows.append((len(rows), " ".join(chain[k:] + rng.choices(vocabulary, k=k))))
    for k in range(60):  # a large group: copies of one text, each with an edit of its own
        rows.append((len(rows), " ".join(edited(chain, 1 + k % 3, rng))))
    return rows + [(len(rows) + k, t) for k, t in enumerate(["", None, " \n", "one two", "One  TWO", "one two three", "a b c d e f", "a b c d e f"])]


def kept(spark, rows, stage=near_copies.keep_firsts):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(((r.doc_id, r.text) for r in stage(docs).collect()), key=lambda r: (r[0], r[1] or ""))


def test_stage_agrees_with_brute_force(spark):
    rows = corpus()
    random.Random(1).shuffle(rows)
    wanted = [r[0] for r in brute_firsts([(d, t or "") for d, t in rows])]
    assert [d for d, _ in kept(spark, rows, lambda docs: corpus_pipeline.drop_near_copies(spark, docs, ""))] == wanted
    assert len(wanted) < len(rows) / 2


@pytest.mark.parametrize("members", [2, 40])
def test_one_id_with_two_texts(spark, members):
    first = " ".join(f"x{k}" for k in range(60))
    other = " ".join(f"y{k}" for k in range(60))
    rows = [(5, first), (5, other), (5, other), (3, first + " end")] + [(10 + k, other + f" end{k}") for k in range(members)]
    assert kept(spark, rows) == [(3, first + " end"), (5, other)]


def test_texts_with_one_passage(spark, monkeypatch):
    """A crowd that shares a band without being alike, with some near copies in it, is not paired off."""
    rng = random.Random(3)
    passage = [f"p{k}" for k in range(60)]
    rows = [(k, " ".join(passage + [f"own{k}x{j}" for j in range(14)])) for k in range(300)]
    rows += [(300 + k, rows[7 * k][1] + " end") for k in range(20)]
    rows += [(400 + k, " ".join(edited(passage + [f"own{k}x{j}" for j in range(14)], 2, rng))) for k in range(20)]
    seen, own = [], near_copies.alike
    monkeypatch.setattr(near_copies, "alike", lambda pairs, nodes: seen.append(pairs.count()) or own(pairs, nodes))
    assert kept(spark, rows) == brute_firsts(rows)
    assert max(seen) < 10_000  # of 57,000 pairs


def test_nothing(spark):
    assert kept(spark, []) == []


def test_threshold_is_exact(spark):
    words = [f"v{k}" for k in range(40)]
    for drop in range(4, 12):
        pair = [(1, " ".join(words)), (2, " ".join(words[drop:]))]
        assert [d for d, _ in kept(spark, pair)] == [d for d, _ in brute_firsts(pair)]


def test_groups_of_fingerprints_are_searched(spark):
    """Near copies that share no band, but whose fingerprints operator 7 links, are found; unlike texts stay apart."""
    from quantloom.llm import simhash
    from quantloom.llm._common import saved, small

    base = " ".join(f"u{k}" for k in range(3000))
    texts = [base, base + " end", " ".join(f"z{k}" for k in range(50))]
    prints = [simhash.fingerprint(t.encode(), near_copies.WORDS) for t in texts]
    assert 0 < (prints[0] ^ prints[1]).bit_count() <= near_copies.RADIUS < (prints[0] ^ prints[2]).bit_count()
    rows = near_copies._rows(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text")
    sketches = saved(rows.mapInArrow(small(near_copies._sketches), near_copies._NODES_DDL), "test-sketches")
    assert [r.fp % (1 << 64) for r in sketches.orderBy("doc_id").collect()] == prints
    nodes = saved(sketches.selectExpr("node", "struct(key) AS first", "array(xxhash64(node)) AS bands", "marks", "fp"), "test-nodes")
    roots = near_copies._groups(nodes, rows).collect()
    own = {bytes(r.node) for r in sketches.where("doc_id < 2").collect()}
    assert {bytes(r.node) for r in roots} <= own and {bytes(r.root) for r in roots} == {min(own)}
