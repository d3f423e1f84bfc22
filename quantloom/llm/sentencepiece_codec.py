"""SentencePiece encoding and decoding on the tokenizers library.

The model file (a protobuf) is parsed here: pieces with scores and types, the trainer's model
type and byte fallback, and the normaliser. From them are rebuilt

* the normaliser: precompiled character map, extra white space, dummy prefix, metaspace marker;
* the model: unigram from pieces and scores, or BPE, whose merges are all splits of a piece into
  two pieces, in the order of the merged piece's score; both with byte fallback;
* user-defined pieces, which are cut out first, longest match, and never merged;
* the decoder: pieces, bytes, metaspace and dummy prefix.

Where no piece has the metaspace marker after another character, no merge crosses from a word
to the marker, so normalised texts are cut there; ids of words are remembered, and the library
encodes new words in batches on several threads. :func:`mismatches` compares with the
SentencePiece library itself.

Defined cases: a null text counts as empty and has no ids; very long texts are encoded whole;
repeated rows each get their row; an empty table gives no rows; unknown characters without byte
fallback become one unknown id for a run of them.
"""

from __future__ import annotations

import functools
import heapq
import os
import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantloom.llm._common import ids_by_chunk, small, table_batch

SPACE = "▁"
THREADS = 2
REMEMBERED = 300_000
# Fixed values of the format: piece types and model types.
NORMAL, UNK, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message: varints as int, the rest as bytes."""
    at, end = 0, len(data)

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            if b < 128:
                return out
            shift += 7

    while at < end:
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        n = {1: 8, 5: 4}[kind] if kind != 2 else varint()
        if at + n > end:
            raise ValueError("the model file is cut short")
        yield key >> 3, data[at : at + n]
        at += n


@dataclass
class Spec:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    suffix_space: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True


def parse(data: bytes) -> Spec:
    spec = Spec()
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            spec.pieces.append((piece, score, kind))
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    spec.model_type = v
                elif n == 24:
                    spec.suffix_space = bool(v)
                elif n == 35:
                    spec.byte_fallback = bool(v)
        elif number == 3:
            for n, v in _fields(value):
                if n == 2:
                    spec.charsmap = v
                elif n in (3, 4, 5):
                    setattr(spec, {3: "dummy_prefix", 4: "squeeze", 5: "escape"}[n], bool(v))
    if spec.model_type not in (UNIGRAM, BPE):
        raise ValueError(f"model type {spec.model_type} is neither unigram nor BPE")
    if spec.suffix_space:
        raise ValueError("white space as a suffix is not supported")
    return spec


class Codec:
    def __init__(self, path: str, threads: int = THREADS):
        # Threads of the library's batches: an executor's share of cores, not the machine's.
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true" if threads > 1 else "false")
        with open(path, "rb") as f:
            self.spec = spec = parse(f.read())
        from tokenizers import Tokenizer, decoders, normalizers

        steps: list = [normalizers.Precompiled(spec.charsmap)] if spec.charsmap else []
        if spec.squeeze:
            from tokenizers import Regex

            steps += [normalizers.Replace(Regex(r"\A +| +\z"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
        if spec.escape:
            steps.append(normalizers.Replace(" ", SPACE))
        if spec.dummy_prefix:
            steps.append(normalizers.Prepend(SPACE if spec.escape else " "))
        self.normalizer = normalizers.Sequence(steps)
        self.plain = not spec.charsmap and not spec.squeeze and spec.escape and spec.dummy_prefix
        self.names = [p for p, _, _ in spec.pieces]
        self.tokenizer = Tokenizer(self._model())
        strip = [decoders.Strip(" ", 1, 0)] if spec.dummy_prefix else []
        self.tokenizer.decoder = decoders.Sequence([decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse(), *strip])
        self.ids = {p: k for k, p in enumerate(self.names)}
        user = sorted((p for p, _, t in spec.pieces if t == USER), key=len, reverse=True)
        self._user = re.compile("|".join(map(re.escape, user))) if user else None
        usable = [p for p, _, t in spec.pieces if t in (NORMAL, USER)]
        self.by_word = spec.escape and not any(SPACE in p.lstrip(SPACE) for p in usable)
        self._known: dict[str, bytes] = {}
        self._scores = {p: s for p, s, t in spec.pieces if t == NORMAL}
        # The library ranks merges strictly; SentencePiece takes equal scores from the left. Words that hold such pieces are merged here.
        shared = {s for s, n in Counter(self._scores.values()).items() if n > 1}
        tied = [p for p, s in self._scores.items() if s in shared and len(p) > 1] if spec.model_type == BPE else []
        self._tied = re.compile("|".join(map(re.escape, sorted(tied, key=len)))) if tied else None
        self._token_bytes = np.array([1 if t == BYTE else len(p.encode()) for p, _, t in spec.pieces], np.int64)
        # Encoding words as one text needs the bytes of each id, and no piece across words.
        self._joined = self.by_word and spec.model_type == BPE and spec.byte_fallback
        self._bytes = [b"" if t == CONTROL else bytes([int(p[3:5], 16)]) if t == BYTE else " ⁇ ".encode() if t == UNK else p.replace(SPACE, " ").encode() for p, _, t in spec.pieces]

    def _model(self):
        from tokenizers import models

        spec = self.spec
        unk = next((k for k, (_, _, t) in enumerate(spec.pieces) if t == UNK), None)
        if spec.model_type == UNIGRAM:
            live = [s for _, s, t in spec.pieces if t == NORMAL]
            top, low = max(live, default=0.0), min(live, default=0.0)
            # Control and unused pieces never match; a user-defined piece beats any way round it.
            score = {NORMAL: lambda p, s: s, USER: lambda p, s: len(p) * top - 0.1}
            vocab = [(p if t in (NORMAL, USER) or t in (UNK, BYTE) else f"\0{k}", score.get(t, lambda p, s: low - 1e4)(p, s)) for k, (p, s, t) in enumerate(spec.pieces)]
            return models.Unigram(vocab, unk, spec.byte_fallback)
        vocab = {(p if t != CONTROL and t != UNUSED else f"\0{k}"): k for k, (p, _, t) in enumerate(spec.pieces)}
        usable = {p: s for p, s, t in spec.pieces if t == NORMAL}
        merges = []
        for piece, score in usable.items():
            splits = [(piece[:k], piece[k:]) for k in range(1, len(piece)) if piece[:k] in usable and piece[k:] in usable]
            merges += [(-score, vocab[a], vocab[b], a, b) for a, b in splits]
        merges.sort()
        return models.BPE(vocab, [(a, b) for *_, a, b in merges], unk_token=spec.pieces[unk][0] if unk is not None else None, fuse_unk=True, byte_fallback=spec.byte_fallback)

    def normalized(self, text: str) -> str:
        if not text:
            return ""
        return SPACE + text.replace(" ", SPACE) if self.plain else self.normalizer.normalize_str(text)

    def _words(self, text: str) -> list[str]:
        """Parts of a normalised text that are encoded apart; user-defined pieces are parts."""
        if self.by_word and text[:1] == SPACE and SPACE * 2 not in text and not self._user_in(text):
            return [SPACE + w for w in text[1:].split(SPACE)]
        parts: list[str] = []
        at = 0
        for m in self._user.finditer(text) if self._user else ():
            parts += self._free(text[at : m.start()])
            parts.append(m[0])
            at = m.end()
        return parts + self._free(text[at:])

    def _user_in(self, text: str) -> bool:
        return self._user is not None and self._user.search(text) is not None

    def _free(self, text: str) -> list[str]:
        if not text:
            return []
        return re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", text) if self.by_word else [text]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit bytes."""
        split = [self._words(self.normalized(t)) for t in texts]
        wanted = set().union(*split) if split else set()
        new = [w for w in wanted if w not in self._known]
        if len(self._known) + len(new) > REMEMBERED:
            self._known.clear()
            new = list(wanted)
        user = {p for p, _, t in self.spec.pieces if t == USER}
        self._known |= {w: struct.pack("<I", self.ids[w]) for w in new if w in user}
        tied = {w for w in new if self._tied and w not in user and self._tied.search(w)}
        self._known |= {w: self._merged(w) for w in tied}
        free = [w for w in new if w not in user and w not in tied]
        whole = [w for w in free if self._joined and w[:1] == SPACE]
        apart = [w for w in free if not self._joined or w[:1] != SPACE]
        if whole:
            groups = [whole[at : at + 2_000] for at in range(0, len(whole), 2_000)]
            for part, e in zip(groups, self.tokenizer.encode_batch_fast(["".join(g) for g in groups], add_special_tokens=False), strict=True):
                self._known.update(zip(part, ids_by_chunk(e.ids, self._token_bytes, [len(w.encode()) for w in part]), strict=True))
        for at in range(0, len(apart), 20_000):
            part = apart[at : at + 20_000]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self._known[w] = np.array(e.ids, "<u4").tobytes()
        get = self._known.__getitem__
        out = [b"".join(map(get, words)) for words in split]
        return out if self.spec.byte_fallback else [self._fused(x) for x in out]

    def _merged(self, word: str) -> bytes:
        """BPE as SentencePiece does it: the highest score first, equal ones from the left."""
        symbols: list[str] = list(word)
        before, after = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
        queue: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0 and (piece := symbols[left] + symbols[right]) in self._scores:
                heapq.heappush(queue, (-self._scores[piece], left, right, piece))

        for k in range(len(symbols) - 1):
            offer(k, k + 1)
        while queue:
            _, left, right, piece = heapq.heappop(queue)
            if not symbols[left] or not symbols[right] or symbols[left] + symbols[right] != piece:
                continue
            symbols[left], symbols[right] = piece, ""
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        unk = next((k for k, (_, _, t) in enumerate(self.spec.pieces) if t == UNK), 0)
        out: list[int] = []
        for x in filter(None, symbols):
            if x in self._scores:
                out.append(self.ids[x])
            elif self.spec.byte_fallback:
                out += [self.ids[f"<0x{b:02X}>"] for b in x.encode()]
            else:
                out.append(unk)
        return np.array(out, "<u4").tobytes()

    def _fused(self, ids: bytes) -> bytes:
        """Runs of the unknown id become one, across words too."""
        unk = next((k for k, (_, _, t) in enumerate(self.spec.pieces) if t == UNK), -1)
        own = np.frombuffer(ids, "<u4")
        keep = np.ones(len(own), bool)
        keep[1:] = ~((own[1:] == unk) & (own[:-1] == unk))
        return own[keep].tobytes()

    def decode(self, ids: bytes) -> str:
        text = b"".join(map(self._bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        if self.spec.dummy_prefix and text[:1] == b" ":
            text = text[1:]
        return text.decode("utf-8", "replace")

    def decode_with_library(self, ids: bytes) -> str:
        return self.tokenizer.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)


@functools.lru_cache(maxsize=2)
def codec(path: str, threads: int = THREADS) -> Codec:
    return Codec(path, threads)


def mismatches(path: str, texts: list[str]) -> list[str]:
    """Texts whose ids or decoded text differ from the SentencePiece library's."""
    import sentencepiece

    own, other = codec(path), sentencepiece.SentencePieceProcessor(model_file=path)
    found = []
    for text, ids in zip(texts, own.encode_batch(texts), strict=True):
        wanted = other.encode(text)
        if np.frombuffer(ids, "<u4").tolist() != wanted or own.decode(ids) != other.decode(wanted):
            found.append(text)
    return found


_OUT = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("n_ids", pa.int64()), ("ids_crc32", pa.int64()), ("decoded", pa.string()), ("round_trip", pa.bool_())])


def _coder(path: str, threads: int, keep: bool):
    schema = _OUT if keep else pa.schema([f for f in _OUT if f.name not in ("ids", "decoded")])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, threads)
        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and size < 4 << 20:
                    size += len(texts[end])
                    end += 1
                part = texts[at:end]
                coded = own.encode_batch(part)
                decoded = [own.decode(x) for x in coded]
                wanted = part if own.plain else [_surface(own, t) for t in part]
                columns = {"doc_id": docs[at:end], "ids": coded, "n_ids": [len(x) // 4 for x in coded], "ids_crc32": [zlib.crc32(x) for x in coded], "decoded": decoded, "round_trip": [a == b for a, b in zip(decoded, wanted, strict=True)]}
                yield table_batch(schema, [columns[f.name] for f in schema])
                at = end

    return code


def _surface(own: Codec, text: str) -> str:
    """What decoding should give: the normalised text without marker and dummy prefix."""
    out = own.normalized(text).replace(SPACE, " ")
    return out[1:] if own.spec.dummy_prefix and out[:1] == " " else out


def code(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", threads: int = THREADS, keep: bool = True) -> DataFrame:
    """One row per document: doc_id, [ids,] n_ids, ids_crc32, [decoded,] round_trip."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ddl = "doc_id long, ids binary, n_ids long, ids_crc32 long, decoded string, round_trip boolean" if keep else "doc_id long, n_ids long, ids_crc32 long, round_trip boolean"
    return rows.mapInArrow(small(_coder(model, threads, keep)), ddl)
