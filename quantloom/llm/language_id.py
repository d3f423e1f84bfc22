"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text recognises every substring of it. A text
is parsed greedily into longest matches against each automaton; the language that needs the
fewest phrases, normalised by text length and by the automaton's size, wins:
``cost = phrases * log2(training characters) / characters``.

An automaton's edges lie in one open-addressing table, (state, character) -> state, so its size
follows the training text and not the alphabet. Texts are parsed side by side in lanes of
``BLOCK`` characters, each as if a phrase began with it. Then each lane is parsed again from the
state in which the lane before ended, until both parses begin a phrase at the same place, from
where they are one; a lane in which that doesn't happen passes its own end state on. The phrases
are those of the whole text.

Characters are lower-cased; runs of non-letters count as one space; a letter that a language's
training text doesn't have is a phrase by itself there. Training text: ``TRAIN_DOCS`` whole
documents a language at most (a parameter of :func:`learn`), those with the smallest hash of
their id; rows that repeat id and text count as one.

Defined cases: a text that is null or has no letter is ``und`` with score 0; of languages with
equal cost the first by name wins; with one language learned the score is 1; without any, all
texts are ``und``; very long texts are parsed whole; repeated rows each get their row; an empty
table gives no rows; columns named lang_pred and score are replaced, others pass through. Ids of
any type will do. The score is second best cost / (best + second best), between 0.5 and 1.
"""

from __future__ import annotations

import functools
import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quantloom.llm._common import small, sole, table_batch

TRAIN_DOCS = 40
BLOCK = 512
#: Characters that are laid out in lanes at once; a longer text is laid out alone.
SLAB = 1 << 20
UNKNOWN = "und"
_SPACE, _STRANGE, _FIRST = 0, 1, 2


class SuffixAutomaton:
    """States as dictionaries; every path from state 0 spells a substring."""

    def __init__(self, codes: list[int]):
        self.edges: list[dict[int, int]] = [{}]
        links, lengths, last = [-1], [0], 0
        for c in codes:
            at = len(self.edges)
            self.edges.append({})
            lengths.append(lengths[last] + 1)
            links.append(0)
            p = last
            while p >= 0 and c not in self.edges[p]:
                self.edges[p][c] = at
                p = links[p]
            if p >= 0:
                q = self.edges[p][c]
                if lengths[q] == lengths[p] + 1:
                    links[at] = q
                else:
                    twin = len(self.edges)
                    self.edges.append(dict(self.edges[q]))
                    lengths.append(lengths[p] + 1)
                    links.append(links[q])
                    while p >= 0 and self.edges[p].get(c) == q:
                        self.edges[p][c] = twin
                        p = links[p]
                    links[q] = links[at] = twin
            last = at


class Edges:
    """An automaton's edges by open addressing. State ``start`` has none: there a phrase begins.

    States are numbered in steps of ``width``, so that state + character is an edge's key.
    """

    _FACTOR = np.uint64(0x9E3779B97F4A7C15)
    #: Lanes up to which the lanes are walked one by one.
    FEW = 32

    def __init__(self, automaton: SuffixAutomaton, width: int):
        states = automaton.edges
        self.start = len(states) * width
        n = sum(map(len, states))
        keys = np.fromiter((s * width + c for s, own in enumerate(states) for c in own), np.int64, n)
        to = np.fromiter((t * width for own in states for t in own.values()), np.int64, n)
        first_edges = states[0]
        states.clear()  # its dictionaries take more than the table
        bits = max(4, (2 * n).bit_length())
        self._mask, self._shift = (1 << bits) - 1, np.uint64(64 - bits)
        self._keys, self._to = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        left, slots = np.arange(n), self._slots(keys)
        while len(left):
            free = self._keys[slots] < 0
            taken, first = np.unique(slots[free], return_index=True)
            placed = np.flatnonzero(free)[first]
            self._keys[taken], self._to[taken] = keys[left[placed]], to[left[placed]]
            rest = np.ones(len(left), bool)
            rest[placed] = False
            left, slots = left[rest], (slots[rest] + 1) & self._mask
        #: Where a phrase that begins with a character leads; ``start`` if no training text has it.
        self.root = np.full(width, self.start, np.int64)
        for c, t in first_edges.items():
            self.root[c] = t * width

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * self._FACTOR) >> self._shift).view(np.int64)

    def step(self, states: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and whether a phrase begins with the character."""
        keys = states + codes
        slots = self._slots(keys)
        found = self._keys.take(slots)
        missed = found != keys
        going = np.flatnonzero(missed)
        going = going[found[going] >= 0]
        while len(going):
            slots[going] = own = (slots[going] + 1) & self._mask
            found = self._keys.take(own)
            same = found == keys[going]
            missed[going[same]] = False
            going = going[~same & (found >= 0)]
        out = self._to.take(slots)
        out[missed] = self.root.take(codes[missed])
        return out, missed

    def walk(self, state: int, codes: list[int], marks: np.ndarray) -> tuple[int, bool]:
        """One lane, from ``state`` until a phrase begins where ``marks`` has one: the last state, and whether it met one."""
        keys, to, root, mask = memoryview(self._keys), memoryview(self._to), memoryview(self.root), self._mask
        factor, shift, all_bits = int(self._FACTOR), int(self._shift), (1 << 64) - 1
        for t, c in enumerate(codes):
            key = state + c
            slot = (key * factor & all_bits) >> shift
            while (k := keys[slot]) != key and k >= 0:
                slot = (slot + 1) & mask
            if k == key:
                state, marks[t] = to[slot], False
            else:
                if marks[t]:
                    return state, True
                state, marks[t] = root[c], True
        return state, False

    def begins(self, whole: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Of each character of the texts, which lie side by side, whether a phrase begins with it."""
        lanes = -(-sizes // BLOCK)
        within = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        begin = np.repeat(np.cumsum(sizes) - sizes, lanes) + within * BLOCK
        length = np.minimum(BLOCK, np.repeat(sizes, lanes) - within * BLOCK)
        marks = np.zeros(len(whole), bool)
        ends = np.full(len(begin), self.start, np.int64)

        order = np.argsort(-length, kind="stable")
        at, state = begin[order], np.full(len(order), self.start, np.int64)
        alive = np.searchsorted(-length[order], -np.arange(BLOCK), side="left")
        for t in range(BLOCK):
            k = alive[t]
            if not k:
                break
            state[:k], marks[at[:k] + t] = self.step(state[:k], whole[at[:k] + t])
        ends[order] = state

        # Lanes that follow another of their text, from where that one ended.
        lane = np.flatnonzero(within > 0)
        while len(lane):
            state, open_ = ends[lane - 1], np.arange(len(lane))
            done = np.zeros(len(lane), bool)
            for t in range(BLOCK):
                open_ = open_[length[lane[open_]] > t]
                if len(open_) <= self.FEW:
                    for k in open_.tolist():
                        own = slice(begin[lane[k]] + t, begin[lane[k]] + length[lane[k]])
                        state[k], done[k] = self.walk(int(state[k]), whole[own].tolist(), marks[own])
                    break
                here = begin[lane[open_]] + t
                state[open_], begun = self.step(state[open_], whole[here])
                met = begun & marks[here]
                marks[here] = begun
                done[open_[met]] = True
                open_ = open_[~met]
            # Lanes without a common place: what they end in goes on to the next lane.
            ends[lane[~done]] = state[~done]
            after = lane[~done] + 1
            after = after[after < len(begin)]
            lane = after[within[after] > 0]
        return marks


class Model:
    """Built once per worker process from the training texts, which are all that is shipped."""

    def __init__(self, texts: tuple[tuple[str, str], ...]):
        self.languages = [name for name, _ in texts]
        letters = np.unique(np.concatenate([_lowered(t) for _, t in texts] or [np.zeros(0, np.uint32)]))
        letters = letters[letters > 0]
        self.width = len(letters) + _FIRST
        self._codes = np.full(sys.maxunicode + 1, _STRANGE, np.uint32)
        self._codes[0] = _SPACE
        self._codes[letters] = np.arange(len(letters)) + _FIRST
        self._edges, weights = [], []
        for _, text in texts:
            trained = self.codes(text).tolist()
            self._edges.append(Edges(SuffixAutomaton(trained), self.width))
            weights.append(math.log2(max(2, len(trained))))
        self._weights = np.array(weights)

    def codes(self, text: str) -> np.ndarray:
        own = self._codes[_lowered(text)]
        keep = own != _SPACE
        keep[1:] |= own[:-1] != _SPACE
        return own[keep]

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """(languages, texts) numbers of phrases."""
        whole = np.concatenate([*texts, np.zeros(0, np.uint32)]).astype(np.int64)
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes)
        out = np.zeros((len(self.languages), len(texts)), np.int64)
        for i, edges in enumerate(self._edges):
            total = np.concatenate([[0], np.cumsum(edges.begins(whole, sizes))])
            out[i] = total[ends] - total[ends - sizes]
        return out

    def judge(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        held: list[np.ndarray] = []
        size = 0
        for k, text in enumerate(texts):
            held.append(self.codes(text or ""))
            size += len(held[-1])
            if size >= SLAB or k == len(texts) - 1:
                yield from self._verdicts(held)
                held, size = [], 0

    def _verdicts(self, texts: list[np.ndarray]) -> Iterator[tuple[str, float]]:
        lettered = [bool((t != _SPACE).any()) for t in texts]
        if not self.languages:
            yield from [(UNKNOWN, 0.0)] * len(texts)
            return
        cost = self.phrases(texts) * self._weights[:, None] / np.maximum(1, [len(t) for t in texts])
        order = np.argsort(cost, axis=0, kind="stable")
        best = np.take_along_axis(cost, order[:1], 0)[0]
        second = np.take_along_axis(cost, order[1:2], 0)[0] if len(self.languages) > 1 else np.full(len(texts), np.inf)
        for k, ok in enumerate(lettered):
            if not ok:
                yield UNKNOWN, 0.0
            else:
                yield self.languages[order[0, k]], 1.0 if math.isinf(second[k]) else float(second[k] / (best[k] + second[k]))


@functools.lru_cache(maxsize=1)
def _lower_points() -> np.ndarray:
    """Of each code point its lower-case letter (itself where that is more than one), 0 if it is none."""
    out = np.zeros(sys.maxunicode + 1, np.uint32)
    for point in range(sys.maxunicode + 1):
        c = chr(point)
        if c.isalpha():
            low = c.lower()
            out[point] = ord(low) if len(low) == 1 else point
    return out


def _lowered(text: str) -> np.ndarray:
    return _lower_points()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def model_of(texts: tuple[tuple[str, str], ...]) -> Model:
    return sole(("languages", texts), lambda: Model(texts))


def learn(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs: int = TRAIN_DOCS) -> tuple[tuple[str, str], ...]:
    """(language, training text), sorted; at most ``docs`` whole documents of each language."""
    usable = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    keys = ["lang", "h", "d"]
    rows = usable.select(F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col)).alias("h"), F.xxhash64(text_col).alias("d"), F.col(text_col).alias("text"))
    # Spark keeps the first rows of each language in every task before it shuffles them.
    first = Window.partitionBy("lang").orderBy("h", "d")
    picked = rows.select(*keys).distinct().withColumn("__r", F.row_number().over(first)).where(F.col("__r") <= docs)
    # A row per language and document: ``docs`` a language.
    held = rows.join(F.broadcast(picked), keys).groupBy(*keys).agg(F.first("text").alias("text")).collect()
    texts: dict[str, list[str]] = {}
    for r in sorted(held, key=lambda r: (r["lang"], r["h"], r["d"])):
        texts.setdefault(r["lang"], []).append(r["text"])
    return tuple((lang, " ".join(parts)) for lang, parts in sorted(texts.items()))


_OUT = pa.schema([("lang_pred", pa.string()), ("score", pa.float64())])


def predict(docs: DataFrame, learned: tuple[tuple[str, str], ...], text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (which replace columns of these names)."""
    rest = [c for c in docs.columns if c not in {"lang_pred", "score"}]
    at = rest.index(text_col)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(learned)
        for batch in batches:
            found = list(model.judge(batch.column(at).to_pylist()))
            added = table_batch(_OUT, [[x for x, _ in found], [s for _, s in found]])
            yield pa.RecordBatch.from_arrays([*batch.columns, *added.columns], names=[*batch.schema.names, *_OUT.names])

    schema = T.StructType([*(docs.schema[c] for c in rest), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.select(*rest).mapInArrow(small(judged), schema)
