"""SentencePiece parity, packing and the pipeline."""

import hashlib
import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from quantloom.llm import packing, queries, sentencepiece_codec

from .cases import ROWS, documents, empty

BPE_MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))
BYTE_BPE = str(public_tokenizers.path("byte_bpe_50k.json"))
EDGE = ["", " ", "  ", "a  b", " a", "a \n b", "\n\n x", "x\x1c y", "<s> x </s>", "<unk>", "<0x41>", "a  b", "▁▁ x▁y", "漢字 かな 🙂 é", "     lots      of  " + " " * 40 + "z", "tab\tx", " " * 16 + "x" + " " * 17, "it's  'll ok, don't. x", "x2, y_ z_, a1. ²b ª,"]
texts = st.lists(st.one_of(st.text(max_size=30), st.text("ab \n▁.,<>é", max_size=30), st.sampled_from(EDGE)), max_size=5)


def field(number, value):
    def varint(n):
        out = b""
        while True:
            out += bytes([n & 127 | (128 if n > 127 else 0)])
            n >>= 7
            if not n:
                return out

    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def unigram_model(fallback, squeeze, prefix=True):
    """A model written by hand, not trained."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + ([(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] if fallback else [])
    words = {"▁": -3.0, "a": -4.0, "b": -4.1, "ab": -5.0, "▁a": -4.5, "▁ab": -5.2, "aba": -6.0, "▁the": -5.1, "the": -6.3, "t": -7.0, "h": -7.1, "e": -7.2, "▁▁": -6.5, ".": -5.5, "é": -8.0, "ba▁": -6.6}
    pieces += [(p, s, 1) for p, s in words.items()]
    out = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, t)) for p, s, t in pieces)
    out += field(2, field(3, 1) + field(4, len(pieces)) + field(35, int(fallback)) + field(40, 0) + field(41, 1) + field(42, 2) + field(43, (1 << 64) - 1))
    return out + field(3, field(1, b"identity") + field(2, b"") + field(3, int(prefix)) + field(4, int(squeeze)) + field(5, 1))


@settings(max_examples=150, deadline=None)
@given(texts)
def test_bpe_parity(batch):
    assert sentencepiece_codec.mismatches(BPE_MODEL, [t.replace("\0", "") for t in batch]) == []


@pytest.mark.parametrize("fallback", [True, False])
@pytest.mark.parametrize("squeeze", [True, False])
def test_unigram_parity(tmp_path, fallback, squeeze):
    path = tmp_path / "m.model"
    path.write_bytes(unigram_model(fallback, squeeze))
    own, other = sentencepiece_codec.Codec(str(path)), sentencepiece.SentencePieceProcessor(model_proto=path.read_bytes())
    random.seed(0)
    batch = EDGE[:8] + ["".join(random.choices("abthe. é" if fallback else "abthe. éxy", k=random.randint(0, 25))) for _ in range(300)]
    for text, ids in zip(batch, own.encode_batch(batch), strict=True):
        wanted = other.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == wanted, text
        if fallback:
            assert own.decode(ids) == other.decode(wanted)


def test_bad_models(tmp_path):
    with pytest.raises(ValueError):
        sentencepiece_codec.parse(field(2, field(3, 3)))
    with pytest.raises(ValueError):
        sentencepiece_codec.parse(unigram_model(True, True)[:-3])


def test_decoding_agrees_with_the_library():
    own = sentencepiece_codec.codec(BPE_MODEL)
    for ids in own.encode_batch([t or "" for _, t, _ in ROWS] + EDGE):
        assert own.decode(ids) == own.decode_with_library(ids)


def test_code(spark):
    rows = {r.doc_id: r for r in sentencepiece_codec.code(documents(spark, True), BPE_MODEL).collect()}
    other = sentencepiece.SentencePieceProcessor(model_file=BPE_MODEL)
    for doc, text, _ in ROWS:
        wanted = other.encode(text or "")
        assert np.frombuffer(rows[doc].ids, "<u4").tolist() == wanted and rows[doc].n_ids == len(wanted)
        assert rows[doc].decoded == other.decode(wanted) and rows[doc].round_trip
    assert sentencepiece_codec.code(empty(spark), BPE_MODEL).count() == 0


@settings(max_examples=200, deadline=None)
@given(texts)
def test_chunked_ids_are_the_tokenizers(batch):
    own = packing.encoder(BYTE_BPE)
    for text, ids in zip(batch, own.encode(batch), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


def test_texts_apart_lie_among_others(monkeypatch):
    monkeypatch.setattr(packing, "GATHERED", 5)
    own = packing.ChunkEncoder(BYTE_BPE)
    batch = ["", " ", "a ", " a", "one two, three.", "a  b", "x<|endoftext|> y", "<|endoftext|>", "a\n b\n", "one two, three.", "b ", "wo.\nTo be!!", "\u3000 c", "d" * 50, "12 % 3", "a <|endoftext|> "]
    for texts_ in (batch, batch[::-1], pa.array(batch), pa.array(batch).slice(3, 9)):
        plain = texts_ if isinstance(texts_, list) else texts_.to_pylist()
        for text, ids in zip(plain, own.encode(texts_), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids
    assert list(own.encode([])) == []


def test_remembering_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 40)
    own = packing.ChunkEncoder(BYTE_BPE)
    random.seed(2)
    for _ in range(30):
        batch = [" ".join("".join(random.choices("abcde,.", k=5)) for _ in range(30)) for _ in range(3)]
        for text, ids in zip(batch, own.encode(batch), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids
        assert len(own._inner) < 40 + 400


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 1024), st.integers(1, 5000), max_size=60))
def test_plans_fill_windows(counts):
    made = packing.plan(counts)
    covered, used, tiers = defaultdict(list), defaultdict(list), {}
    for length, a, b, first, per, offset, tier in made.slots:
        covered[length].append((a, b))
        assert (b - a) % per == 0
        for w in range(first, first + (b - a) // per):
            used[w].append((offset, per * length))
            tiers[w] = tier
    for length, a, b, _ in made.fillers:
        covered[length].append((a, b))
    for length, n in counts.items():  # every rank once
        at = 0
        for a, b in sorted(covered[length]):
            assert a == at
            at = b
        assert at == n
    spread, end = sum((b - a) * length for length, a, b, _ in made.fillers), 0
    tokens = dict.fromkeys(range(made.windows), 0)
    for w, parts in used.items():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        tokens[w] = at
    assert set(used) == set(tokens) and max(tokens.values(), default=0) <= packing.WINDOW
    for place, gap, first, offset, _ in made.tape:
        assert place == end and tokens[first] == offset == packing.WINDOW - gap
        n = 0
        while first + n in used and tokens[first + n] == offset and used[first + n] == used[first]:
            n += 1
        following = [p for p, *_ in made.tape if p > place]
        n = (min(following) - place) // gap if following else n
        for w in range(first, first + n):
            tokens[w] += max(0, min(gap, spread - end))
            end += gap
    assert spread <= end
    # hardly any padding: less than a window, and gaps that are too small to fill
    assert sum(packing.WINDOW - t for t in tokens.values()) < packing.WINDOW + packing.LEAST_GAP * made.windows
    # a step has as many windows and tokens as any other, and of each tier as many
    steps = max(1, made.windows // 7)
    of_steps = defaultdict(lambda: defaultdict(int))
    for w, t in tiers.items():
        of_steps[w % steps][t] += 1
        of_steps[w % steps]["tokens"] += tokens[w]
    for t in {*tiers.values()}:
        n = [of_steps[k][t] for k in range(steps)]
        assert max(n) - min(n) <= 1
    if steps > 1:
        n = [of_steps[k]["tokens"] for k in range(steps)]
        assert max(n) - min(n) <= 3 * packing.WINDOW + 40 * packing.LEAST_GAP


def test_tiers_are_packed_then_filled():
    made = packing.plan({600: 10, 300: 9, 100: 30, 40: 100, 1024: 3})
    tier = {}
    for length, _, _, first, per, offset, t in made.slots:
        tier.setdefault(first, []).append((offset, length, per, t))
    assert all(t == 1024 for parts in tier.values() for _, length, _, t in parts if length > 512)
    # gaps of the long windows hold pieces of the shorter tiers
    long = [sorted(parts) for parts in tier.values() if min(parts)[1] == 600]
    assert long and all(len(parts) > 1 and all(p[3] == 1024 for p in parts) for parts in long)
    assert packing.plan({}) == packing.Plan([], [], [], 0)
    assert packing.cuts(1024) == [1024] and packing.cuts(2500) == [1024, 1024, 452] and packing.cuts(700) == [700]


def test_cuts_close_gaps(spark):
    """Documents of one length: a third of the windows is taken apart, and every piece is whole or cut at a gap's end."""
    text = "word " * 599  # 600 ids with the end id
    docs = spark.range(300).selectExpr("IF(id < 100, NULL, id % 7) AS doc_id", f"'{text.strip()}' AS text")
    rows = packing.pack(docs, BYTE_BPE).collect()
    n = rows[0].doc_tokens
    tokens = defaultdict(int)
    for r in rows:
        tokens[r.sequence_id] += r.length
    assert sum(tokens.values()) == 300 * n and len(tokens) == -(-300 * n // 1024)
    assert sum(r.start == 0 and r.length == n for r in rows) >= 120 and len(rows) <= 300 + len(tokens)


def check_packed(rows, docs, end_id=0):
    own = packing.encoder(BYTE_BPE)
    ids = defaultdict(list)
    for doc, text in docs:
        ids[doc].append(np.array(own.tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id], "<u4"))
    seen, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        own_ids = ids[r.doc_id][0]
        assert r.doc_tokens == len(own_ids) and r.ids_crc32 == zlib.crc32(own_ids[r.start : r.start + r.length].tobytes())
        seen[r.doc_id] += range(r.start, r.start + r.length)
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc, copies in ids.items():
        assert sorted(seen[doc]) == sorted(list(range(len(copies[0]))) * len(copies))
    padding = total = 0
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
        total += end
        padding += 0 if end & (end - 1) == 0 else 1024 - end
    return padding, total


def test_pack(spark):
    rows = packing.pack(documents(spark, True).repartition(3), BYTE_BPE).collect()
    check_packed(rows, [(d, t) for d, t, _ in ROWS])
    assert packing.pack(empty(spark), BYTE_BPE).count() == 0
    with_ids = packing.pack(documents(spark), BYTE_BPE, with_ids=True).first()
    assert zlib.crc32(with_ids.ids) == with_ids.ids_crc32


def test_packing_of_the_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.op6_packing(spark, sf).collect()
    padding, total = check_packed(rows, docs)
    assert padding < 0.01 * total and len(rows) < 1.25 * sum(len(packing.cuts(n)) for n in {(r.doc_id, r.doc_tokens): r.doc_tokens for r in rows}.values())
    per_step = defaultdict(set)
    for r in rows:
        per_step[r.step_group].add(r.sequence_id)
    assert max(map(len, per_step.values())) <= packing.STEP_WINDOWS


def test_pipeline(spark):
    """Each stage on what the one before kept, against plain code."""
    from quantloom.llm import simhash

    from .test_dedup import brute_components, brute_lines, brute_print
    from .test_search_and_secrets import brute

    docs = spark.createDataFrame([(d, t, lang, "src0", len(t or "")) for d, t, lang in ROWS if d != 12] + [(13, "another text with a secret=abcdefgh12 in it\n", "en", "src1", 44)], "doc_id long, text string, lang string, source string, n_chars long")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], "").cache())
        if name != "packing":
            assert frames[-1].columns == docs.columns
    texts_of = [{r.doc_id: r.text for r in f.select("doc_id", "text").collect()} for f in frames[:-1]]
    assert set(texts_of[1]) == {d for d, t in texts_of[0].items() if t and any(c.isalpha() for c in t)}
    wanted = {d: (n, k) for d, _, n, k in brute_lines([(d, t) for d, t in texts_of[1].items()])}
    assert {d: hashlib.sha256(t.encode()).hexdigest() for d, t in texts_of[2].items()} == {d: k for d, (_, k) in wanted.items()}
    groups = brute_components({d: brute_print(t) for d, t in texts_of[2].items()}, simhash.RADIUS)
    assert set(texts_of[3]) == set(groups.values())
    for d, t in texts_of[3].items():
        assert (texts_of[4][d] == t) == (brute(t) == "") and brute(texts_of[4][d]) == ""
    assert all(r.n_chars == len(r.text) for r in frames[4].collect())
    check_packed(frames[5].collect(), list(texts_of[4].items()))


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "line dedup", "near dedup", "secret scan", "packing"]
