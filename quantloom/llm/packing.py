"""Hierarchical multi-length packing of token ids into sequences of at most 1,024.

Whole windows are cut off a document's ids (with the end id) only where it is longer than one;
what is left is one piece, routed to the tier of the smallest context size that holds it.

* Tiers are packed one after the other, the longest first, best fit among the tier's own windows.
* Before the next tier is packed, gaps of the tier's windows are filled from the shorter tiers,
  longest pieces first. What is left of a shorter tier is then packed as that tier's own.
* At last the emptiest windows are taken apart, and their pieces are laid one after the other
  over all gaps that are left and cut where a gap ends. Only these pieces are cut, and hardly any
  padding is left.

A piece has one of 1,024 lengths, so the plan is made from a histogram of that size: slots (length,
ranks, windows, offset), and for pieces that are cut, their place on the tape of gaps. A piece's
rank within its length is its row number within (length, salt) plus the count of the salts before;
no length is ever gathered in one task, however many documents have it. Salts go by row number, so
that repeated or null ids are spread like others.

Windows are numbered by tier and then by how full they are, and step groups take every n-th window,
so that a step has of each tier as many windows as any other, give or take one, and of tokens, too.

Tokens: texts are cut at spaces that follow a non-space, where the byte-level pattern always
ends a word; ids of these chunks are remembered, and the tokenizer encodes new chunks only.

Defined cases: a null text counts as empty and is the end id alone; very long texts are encoded
whole; repeated rows are packed once each; an empty table gives no rows; further columns are
ignored, whatever their names. Ids are whole numbers. A special token's string in a text is that
token, as the tokenizer has it.
"""

from __future__ import annotations

import operator
import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantloom.llm._common import BATCH_ROWS, ids_by_chunk, partitions_for, row_base, saved, small, sole, table_batch

WINDOW, TIERS = 1024, (1024, 512, 256, 128, 64)
#: Smaller gaps aren't worth a cut.
LEAST_GAP = 4
STEP_WINDOWS = 256
END_ID = 0
#: A generation of chunks with more than this many is the old one of two when the next part begins (about 30 MB each).
REMEMBERED = 150_000
#: Bytes of text that are encoded together: a chunk that occurs again among them is looked at once.
PART = 12 << 20
#: Rows of a slice, of which parts are made.
SLICE_ROWS = 10_000
#: Chunks whose ids are laid side by side at once.
GATHERED = 500_000
#: Salts: pieces in one (length, salt) are this many on average at most, even if all have one length.
SALT_PIECES, LEAST_SALTS = 50_000, 4

_BREAK = re.compile(r"(?<=\S) ")
#: Between a letter and a run of these a word ends.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class ChunkEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._token_bytes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, k in self.tokenizer.get_vocab().items():
            self._token_bytes[k] = len(token)  # byte-level: a character of a token is a byte
        self._inner: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._first: dict[str, bytes] = {}

    def _remember(self, chunks: list[str]) -> None:
        """Have the ids of all ``chunks``, each after a space, in the young generation."""
        if len(self._inner) > REMEMBERED:
            self._inner, self._old = {}, self._inner
        known, old = self._inner, self._old
        fresh = [c for c in chunks if c not in known]
        if old:
            again = [c for c in fresh if c in old]
            known.update(zip(again, map(old.__getitem__, again), strict=True))
            fresh = [c for c in fresh if c not in old]
        new, plain, marked, stems = [], [], [], []
        for c in fresh:
            if c.isalpha():
                plain.append(c)
            elif (word := c.rstrip(_MARKS)).isalpha():
                marked.append(c)
                stems.append(word)
            else:
                new.append(c)
        tails = [c[len(w) :] for c, w in zip(marked, stems, strict=True)]
        self._alone(set(tails))
        self._together(plain)
        self._together([w for w in dict.fromkeys(stems) if w not in known and not self._kept(w)])
        self._together(new)
        known.update(zip(marked, map(operator.add, map(known.__getitem__, stems), map(self._first.__getitem__, tails)), strict=True))

    def _kept(self, word: str) -> bool:
        if ids := self._old.get(word):
            self._inner[word] = ids
        return bool(ids)

    def _together(self, chunks: list[str]) -> None:
        """Encode chunks as one text: with a space before each they stay apart."""
        for at in range(0, len(chunks), 20_000):
            part = chunks[at : at + 20_000]
            ids = self.tokenizer.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)[0].ids
            self._inner.update(zip(part, ids_by_chunk(ids, self._token_bytes, [len(c.encode()) + 1 for c in part]), strict=True))

    def _alone(self, chunks: set[str]) -> None:
        if len(self._first) > REMEMBERED // 8:
            self._first.clear()
        new = [c for c in chunks if c not in self._first]
        for c, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True):
            self._first[c] = np.array(e.ids, "<u4").tobytes()

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str] | pa.Array) -> Iterator[bytes]:
        """In even parts of PART bytes at most (or a text), so that what is new is encoded in batches and what is held is bounded."""
        column = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
        ends, first = np.cumsum(sizes), 0
        total = int(sizes.sum())
        each = total // max(1, -(-total // PART)) + 1
        while first < len(column):
            done = ends[first] - sizes[first]
            end = max(first + 1, int(np.searchsorted(ends, done + each, "right")))
            yield from self._encode(column.slice(first, end - first))
            first = end

    def _encode(self, texts: pa.LargeStringArray) -> Iterator[bytes]:
        split = pc.split_pattern(texts, " ")
        sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        coded = split.flatten().dictionary_encode()
        at, chunks = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        last = pc.utf8_slice_codeunits(coded.dictionary, -1).dictionary_encode()
        unlike = np.array([not c or c.isspace() for c in last.dictionary.to_pylist()], bool)[last.indices.to_numpy()]
        del split, coded, last

        # Texts apart: those with a special token are encoded whole, those with white space before a space are split elsewhere.
        special = np.zeros(len(texts), bool)
        for s in self.special:
            special |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        unsafe = np.logical_or.reduceat(unlike[at], ends - sizes) & ~special
        own = {k: _BREAK.split(texts[k].as_py()) for k in np.flatnonzero(unsafe).tolist()}

        first = {k: chunks[at[ends[k] - sizes[k]]] for k in np.flatnonzero(~(special | unsafe)).tolist()} | {k: parts[0] for k, parts in own.items()}
        # Only texts apart hold these chunks; they aren't looked up.
        wrong = np.flatnonzero(unlike).tolist()
        if special.any():
            wrong += [k for k, c in enumerate(chunks) if any(s in c for s in self.special)]
        for k in wrong:
            chunks[k] = ""
        whole = [c for c in chunks if c]
        self._remember(whole + list(set().union(*(parts[1:] for parts in own.values())).difference(whole)))
        self._alone(set(first.values()))
        del whole
        known = self._inner
        flat = [known[c] if c else b"" for c in chunks]
        width = np.fromiter(map(len, flat), np.int64, len(flat)) // 4
        begin = np.cumsum(width) - width
        ids = np.frombuffer(b"".join(flat), "<u4")
        del flat

        k = 0
        while k < len(texts):
            if special[k] or unsafe[k]:
                yield self.whole(texts[k].as_py()) if special[k] else self._first[own[k][0]] + b"".join(map(known.__getitem__, own[k][1:]))
                k += 1
                continue
            # Some texts together, without their first chunks, whose ids are other ones.
            low = ends[k] - sizes[k]
            stop = max(k + 1, int(np.searchsorted(ends, low + GATHERED, "right")))
            apart = np.flatnonzero(special[k:stop] | unsafe[k:stop])
            stop = k + int(apart[0]) if len(apart) else stop
            here = at[low : ends[stop - 1]]
            n = width[here]
            upto = np.cumsum(n)
            out = ids[np.repeat(begin[here] - upto + n, n) + np.arange(upto[-1])]
            for j in range(k, stop):
                yield self._first[first[j]] + out[upto[ends[j] - sizes[j] - low] : upto[ends[j] - 1 - low]].tobytes()
            k = stop
        # What came once isn't remembered.
        for k in np.flatnonzero(np.bincount(at, minlength=len(chunks)) == 1).tolist():
            known.pop(chunks[k], None)

    def rest(self) -> None:
        """Between tasks: keep one generation of chunks, in a table of its size."""
        self._inner, self._old = dict(self._inner), {}
        pa.default_memory_pool().release_unused()


def encoder(path: str) -> ChunkEncoder:
    return sole(("chunks", path), lambda: ChunkEncoder(path))


def cuts(n: int) -> list[int]:
    """Piece lengths of a document of ``n`` ids."""
    full, rest = divmod(n, WINDOW)
    return [WINDOW] * full + ([rest] if rest else [])


def tier_of(length: int) -> int:
    return next(t for t in reversed(TIERS) if length <= t)


_CUT = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])
_CUT_DDL = "row long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


def _cutter(path: str, end_id: int, with_ids: bool):
    tail = int(end_id).to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, row = encoder(path), row_base()
        for batch in batches:
            columns: list[list] = [[] for _ in _CUT]
            for doc, ids in zip(batch.column(0).to_pylist(), own.encode(batch.column(1).fill_null("")), strict=True):
                view, start = memoryview(ids + tail), 0
                n = len(view) // 4
                for length in cuts(n):
                    part = view[4 * start : 4 * (start + length)]
                    # A whole window's ids aren't needed again, unless they are asked for.
                    for c, x in zip(columns, (row, doc, start, length, zlib.crc32(part), n, bytes(part) if with_ids or length < WINDOW else None), strict=True):
                        c.append(x)
                    start += length
                    row += 1
                if len(columns[0]) >= BATCH_ROWS:
                    yield table_batch(_CUT, columns)
                    columns = [[] for _ in _CUT]
            yield table_batch(_CUT, columns)
        own.rest()

    return cut


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """A row per piece with its ids (little-endian unsigned 32-bit); those of whole windows only ``with_ids``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(small(_cutter(tokenizer, end_id, with_ids), SLICE_ROWS), _CUT_DDL)


@dataclass(order=True)
class _Windows:
    """``n`` windows of equal contents: (length, pieces a window, first rank) one after the other."""

    gap: int
    n: int
    tier: int
    contents: list[tuple[int, int, int]] = field(default_factory=list)

    def split(self, n: int) -> _Windows:
        """Take the last ``n`` windows off."""
        kept = self.n - n
        off = _Windows(self.gap, n, self.tier, [(length, per, rank + kept * per) for length, per, rank in self.contents])
        self.n = kept
        return off


@dataclass
class Plan:
    """Slots: (length, first rank, end rank, first window, copies a window, offset, tier).

    Fillers: (length, first rank, end rank, place on the tape). Tape: (place, gap, first window,
    offset, tier) of windows with equal gaps, whose gaps lie one after the other.
    """

    slots: list[tuple[int, int, int, int, int, int, int]]
    fillers: list[tuple[int, int, int, int]]
    tape: list[tuple[int, int, int, int, int]]
    windows: int


class _Tier:
    """Windows of one tier that still have gaps, by gap."""

    def __init__(self):
        self.gaps: list[int] = []
        self.open: dict[int, list[_Windows]] = {}
        self.full: list[_Windows] = []

    def add(self, w: _Windows) -> None:
        if not w.gap:
            self.full.append(w)
        else:
            if not self.open.get(w.gap):
                insort(self.gaps, w.gap)
            self.open.setdefault(w.gap, []).append(w)

    def fit(self, length: int) -> _Windows | None:
        """Windows with the smallest gap that holds ``length``, taken out."""
        k = bisect_left(self.gaps, length)
        if k == len(self.gaps):
            return None
        held = self.open[self.gaps[k]]
        found = held.pop()
        if not held:
            del self.gaps[k]
        return found

    def place(self, length: int, left: int, rank: int, tier: int | None) -> int:
        """Best fit of ``left`` pieces; with ``tier`` new windows are opened. How many were placed."""
        placed = 0
        while placed < left:
            w = self.fit(length)
            if w is None:
                if tier is None:
                    break
                w = _Windows(WINDOW, -(-(left - placed) // (WINDOW // length)), tier)
            per = min(w.gap // length, left - placed)
            take = min(w.n, (left - placed) // per)
            if take < w.n:
                self.add(w.split(w.n - take))
            w.contents.append((length, per, rank + placed))
            w.gap -= per * length
            placed += take * per
            self.add(w)
        return placed

    def all(self) -> list[_Windows]:
        return self.full + [w for held in self.open.values() for w in held]


def plan(counts: dict[int, int]) -> Plan:
    """``counts``: pieces of each length. The size of the plan depends on the number of lengths only."""
    ranks, left = dict.fromkeys(counts, 0), dict(counts)
    lengths = sorted(counts, reverse=True)
    windows: list[_Windows] = []
    for tier in TIERS:
        own = _Tier()
        for length in lengths:
            routed = tier_of(length)
            if routed <= tier and left[length]:
                n = own.place(length, left[length], ranks[length], tier if routed == tier else None)
                ranks[length] += n
                left[length] -= n
        windows += own.all()

    # Each window that is taken apart brings its contents and its gap: a window in all.
    windows.sort(key=lambda w: w.gap)
    apart = sum(w.gap * w.n for w in windows if w.gap >= LEAST_GAP) // WINDOW
    loose: list[tuple[int, int, int]] = []
    while apart:
        w = windows.pop()
        if w.n > apart:
            off = w.split(apart)
            windows.append(w)
            w = off
        apart -= w.n
        loose += [(length, rank, rank + w.n * per) for length, per, rank in w.contents]
    fillers, at = [], 0
    for length, rank, end in sorted(loose, reverse=True):
        fillers.append((length, rank, end, at))
        at += (end - rank) * length

    # The widest gaps come first on the tape; what it covers is full and numbered before the rest of its tier.
    covered, place = {}, 0
    for w in sorted((w for w in windows if w.gap >= LEAST_GAP), key=lambda w: -w.gap):
        covered[id(w)] = place
        place += w.gap * w.n
    gap = lambda w: 0 if id(w) in covered and covered[id(w)] + w.gap * w.n <= at else w.gap
    slots, tape, first = [], [], 0
    for w in sorted(windows, key=lambda w: (-w.tier, gap(w))):
        offset = 0
        for length, per, rank in w.contents:
            slots.append((length, rank, rank + w.n * per, first, per, offset, w.tier))
            offset += per * length
        if id(w) in covered:
            tape.append((covered[id(w)], w.gap, first, offset, w.tier))
        first += w.n
    return Plan(sorted(slots), fillers, sorted(tape), first)


_OUT = pa.schema([*(f for f in _CUT if f.name not in ("row", "ids")), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int32()), ("step_group", pa.int64())])
_OUT_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"
_RANKS = 1 << 40


def _placer(made: Plan, steps: int, with_ids: bool):
    schema = _OUT.append(pa.field("ids", pa.binary())) if with_ids else _OUT
    slots = np.array(made.slots or [(0,) * 7], np.int64)
    keys = slots[:, 0] * _RANKS + slots[:, 1]
    fillers = np.array(sorted(made.fillers) or [(0,) * 4], np.int64)
    filler_keys = fillers[:, 0] * _RANKS + fillers[:, 1]
    tape = np.array(made.tape or [(0, 1, 0, 0, 0)], np.int64)

    def whole(batch: pa.RecordBatch, rank: np.ndarray, length: np.ndarray, slot: np.ndarray) -> pa.RecordBatch:
        own = slots[slot]
        within = rank - own[:, 1]
        sequence = own[:, 3] + within // own[:, 4]
        added = [pa.array(sequence), pa.array(own[:, 5] + within % own[:, 4] * length), pa.array(own[:, 6].astype(np.int32)), pa.array(sequence % steps)]
        return pa.RecordBatch.from_arrays([*(batch[f.name] for f in _OUT if f.name in batch.schema.names), *added, *([batch["ids"]] if with_ids else [])], schema=schema)

    def parts(batch: pa.RecordBatch, rank: np.ndarray) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in schema]
        for r, k in zip(batch.to_pylist(), rank.tolist(), strict=True):
            length, since, _, at = fillers[np.searchsorted(filler_keys, r["length"] * _RANKS + k, "right") - 1].tolist()
            at += (k - since) * length
            view, done = memoryview(r["ids"]), 0
            while done < length:
                place, gap, first, offset, tier = tape[np.searchsorted(tape[:, 0], at, "right") - 1].tolist()
                window, within = divmod(at - place, gap)
                n = min(length - done, gap - within)
                part = view[4 * done : 4 * (done + n)]
                row = [r["doc_id"], r["start"] + done, n, zlib.crc32(part), r["doc_tokens"], first + window, offset + within, tier, (first + window) % steps, *([bytes(part)] if with_ids else [])]
                for c, x in zip(columns, row, strict=True):
                    c.append(x)
                done, at = done + n, at + n
        return table_batch(schema, columns)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank, length = batch["rank"].to_numpy(), batch["length"].to_numpy()
            slot = np.maximum(np.searchsorted(keys, length * _RANKS + rank, "right") - 1, 0)
            fits = (slots[slot, 0] == length) & (rank < slots[slot, 2])
            at, rest = np.flatnonzero(fits), np.flatnonzero(~fits)
            yield whole(batch.take(pa.array(at)), rank[at], length[at], slot[at])
            if len(rest):
                yield parts(batch.take(pa.array(rest)), rank[rest])

    return place


def packed(cut: DataFrame, with_ids: bool = False) -> DataFrame:
    """``cut`` (from :func:`pieces`, saved) with sequence_id, offset, tier and step_group, a row per final piece."""
    salts = partitions_for(cut.count(), SALT_PIECES, LEAST_SALTS)
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int"))
    sums = saved(salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")), "piece-sums")
    made = plan({r["length"]: r["n"] for r in sums.groupBy("length").agg(F.sum("n").alias("n")).collect()})  # a row per length
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    if not with_ids:  # ids go along only with lengths of which some pieces are cut
        salted = salted.withColumn("ids", F.when(F.col("length").isin(sorted({f[0] for f in made.fillers})), F.col("ids")))
    own = Window.partitionBy("length", "salt").orderBy("row")
    ranked = salted.withColumn("own", F.row_number().over(own) - 1).join(starts, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("own"))
    given = ranked.select(*(f.name for f in _CUT if f.name != "row"), "rank")
    return given.mapInArrow(_placer(made, partitions_for(made.windows, STEP_WINDOWS), with_ids), _OUT_DDL + (", ids binary" if with_ids else ""))


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    return packed(saved(pieces(docs, tokenizer, id_col, text_col, end_id, with_ids), "pieces"), with_ids)
