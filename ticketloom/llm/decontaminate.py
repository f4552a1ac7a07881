"""Benchmark decontamination with a generalised suffix automaton over the words of the test items.

The automaton recognises every run of words of every item. Documents stream through it word by word; the length of the
longest run of item words that ends at a word is tracked, and a window (13 words, or a whole shorter item) that ends
there marks its words as hit.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.blocks import Words, blocks, byte_table, keep_columns, utf8

WINDOW = 13
#: Benchmark text that is held in one automaton; larger benchmarks are searched one automaton after the other.
PART_BYTES = 32 << 20
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
MEMBER = byte_table(lambda b: b >= 128 or 48 <= b <= 57 or 97 <= b <= 122)


def normalised_words(texts: pa.Array) -> Words:
    """Words after lower-casing A-Z: runs of a-z, 0-9 and everything outside ASCII."""
    raw, offsets = utf8(texts)
    return Words(LOWER[raw], offsets, MEMBER)


@dataclass
class Automaton:
    """States hold the longest run they stand for, their suffix link and their next states by word."""

    window: int = WINDOW
    length: list[int] = field(default_factory=lambda: [0])
    link: list[int] = field(default_factory=lambda: [-1])
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    #: Items whose window of full width ends in a state, and shorter items that a state stands for.
    windows: dict[int, set] = field(default_factory=dict)
    short: dict[int, tuple[int, set]] = field(default_factory=dict)
    vocabulary: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    shortest: int = WINDOW

    def _new(self, length: int, link: int, step: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.step.append(step)
        return len(self.length) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        """A state for the runs of ``q`` that are not longer than those of ``p`` plus a word."""
        clone = self._new(self.length[p] + 1, self.link[q], dict(self.step[q]))
        self.link[q] = clone
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: int) -> int:
        q = self.step[last].get(word)
        if q is not None:  # an earlier item has this run already
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, word)
        state, p = self._new(self.length[last] + 1, 0, {}), last
        while p >= 0 and word not in self.step[p]:
            self.step[p][word] = state
            p = self.link[p]
        if p >= 0:
            q = self.step[p][word]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
        return state

    def window_state(self, state: int) -> int:
        """The state of the last ``window`` words of a match that is at least as long."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    @classmethod
    def build(cls, items: Sequence[tuple[object, np.ndarray]], window: int = WINDOW) -> Automaton:
        """``items``: an id and the word hashes of each item."""
        self = cls(window)
        items = [(i, h) for i, h in items if len(h)]
        if not items:
            return self
        self.vocabulary = np.unique(np.concatenate([h for _, h in items]))
        coded = [(i, np.searchsorted(self.vocabulary, h).tolist()) for i, h in items]
        for _, words in coded:
            last = 0
            for w in words:
                last = self._extend(last, w)
        self.shortest = min(window, *(len(words) for _, words in coded))
        for item, words in coded:
            state = 0
            for k, w in enumerate(words, 1):
                state = self.step[state][w]
                if k >= window:
                    self.windows.setdefault(self.window_state(state), set()).add(item)
            if len(words) < window:
                while self.length[self.link[state]] >= len(words):
                    state = self.link[state]
                self.short.setdefault(state, (len(words), set()))[1].add(item)
        return self

    def stream(self, words: list[int], hits: list[tuple[int, int]], items: set, offset: int) -> int:
        """Feed words; add hit windows (as word ranges from ``offset``) and their items; return the longest match."""
        state = matched = longest = 0
        length, link, step, window, short = self.length, self.link, self.step, self.window, self.short
        for i, w in enumerate(words, offset + 1):
            while state and w not in step[state]:
                state = link[state]
                matched = length[state]
            if w in step[state]:
                state = step[state][w]
                matched += 1
            longest = max(longest, matched)
            if matched >= window:
                hits.append((i - window, i))
                items |= self.windows[self.window_state(state)]
            if short:
                s = state
                while s > 0:
                    found = short.get(s)
                    if found and found[0] <= matched:
                        hits.append((i - found[0], i))
                        items |= found[1]
                    s = link[s]
        return longest

    def search(self, words: Words) -> list[tuple[list[tuple[int, int]], set, int]]:
        """Hit windows, items and longest match of each text. Only stretches of item words can hold a window."""
        out: list = [([], set(), 0) for _ in range(words.texts)]
        if not len(self.vocabulary) or not len(words.starts):
            return out
        code = np.minimum(np.searchsorted(self.vocabulary, words.hashes), len(self.vocabulary) - 1)
        known = self.vocabulary[code] == words.hashes
        edge = np.zeros(len(known) + 1, bool)
        edge[words.bounds] = True
        first = known.copy()
        first[1:] &= ~known[:-1] | edge[1:-1]
        last = known.copy()
        last[:-1] &= ~known[1:] | edge[1:-1]
        begins, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        long = ends - begins >= self.shortest
        for b, e in zip(begins[long].tolist(), ends[long].tolist()):
            t = int(words.text[b])
            hits, items, most = out[t]
            most = max(most, self.stream(code[b:e].tolist(), hits, items, b - int(words.bounds[t])))
            out[t] = (hits, items, most)
        return out


def merged(ranges: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open ranges."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def automata(benchmark: DataFrame, item: str, text: str, window: int, part_bytes: int) -> list[Automaton]:
    """One automaton for each ``part_bytes`` of item texts; a part is bounded, so it may pass through the driver."""
    total = benchmark.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    parts = -(-total // part_bytes) or 1
    out = []
    for p in range(parts):
        rows = benchmark.where(F.col(text).isNotNull())
        if parts > 1:
            rows = rows.where(F.pmod(F.xxhash64(F.col(text)), F.lit(parts)) == p)
        rows = rows.select(F.col(item).cast("string"), F.col(text)).collect()
        words = normalised_words(pa.array([r[1] for r in rows], pa.string()))
        hashes = [words.hashes[a:b] for a, b in zip(words.bounds[:-1], words.bounds[1:])]
        out.append(Automaton.build([(r[0], h) for r, h in zip(rows, hashes)], window))
    return out


MADE = "n_words long, n_hit long, longest_match long, items array<string>, spans array<struct<start: int, end: int>>"
_PAIR = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def find_overlap(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    columns: Sequence[str] | None = None,
    window: int = WINDOW,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Add ``n_words, n_hit, longest_match, items`` (ids as sorted strings) and ``spans`` (words, half-open) to ``columns``.

    Nothing is shuffled: the automata are shipped to the tasks and the documents stream through them. A null or empty
    text has no words; an item without words is never found; an item with a null id marks words but is not listed;
    repeated items count once. A computed column replaces an input column of the same name.
    """
    made = ["n_words", "n_hit", "longest_match", "items", "spans"]
    carried = [c for c in (df.columns if columns is None else columns) if c not in made]
    out = df.select(*carried, F.col(text).alias("__text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*carried).schema)
    parts = automata(benchmark, item, item_text, window, part_bytes)
    for n, automaton in enumerate(parts, 1):
        shared = df.sparkSession.sparkContext.broadcast(automaton)
        out = _searched(out, shared, carried, kinds, first=n == 1, last=n == len(parts))
    return out


def _searched(df: DataFrame, shared, carried: list[str], kinds: str, first: bool, last: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "__text"):
            words = normalised_words(batch.column("__text"))
            rows = []
            before = [None] * batch.num_rows if first else batch.select(["longest_match", "items", "spans"]).to_pylist()
            for (hits, items, longest), old in zip(shared.value.search(words), before):
                if old:
                    hits = hits + [(s["start"], s["end"]) for s in old["spans"]]
                    items, longest = items | set(old["items"]), max(longest, old["longest_match"])
                spans = merged(hits)
                rows.append((sum(b - a for a, b in spans), longest, sorted(i for i in items if i is not None),
                             [{"start": a, "end": b} for a, b in spans]))
            n_hit, longest, items, spans = zip(*rows)
            yield keep_columns(
                batch, carried if last else [*carried, "__text"],
                n_words=pa.array(words.counts), n_hit=pa.array(n_hit, pa.int64()),
                longest_match=pa.array(longest, pa.int64()), items=pa.array(items, pa.list_(pa.string())),
                spans=pa.array(spans, _PAIR),
            )

    schema = ", ".join([x for x in (kinds, None if last else "__text string", MADE) if x])
    return df.mapInArrow(run, schema)


def contaminated(n_words: str = "n_words", n_hit: str = "n_hit"):
    """At least a twentieth of the words lies in windows of test items."""
    return (F.col(n_hit) > 0) & (F.col(n_hit) * 20 >= F.col(n_words))


def without_spans(df: DataFrame, text: str = "text", spans: str = "spans", longer_than: int = 0) -> DataFrame:
    """Cut hit spans of more than ``longer_than`` words out of the texts, from the first to the last byte of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text):
            words = normalised_words(batch.column(text))
            raw, offsets = utf8(batch.column(text))
            out = []
            for t, (old, found) in enumerate(zip(batch.column(text).to_pylist(), batch.column(spans).to_pylist())):
                cuts = [s for s in found or () if s["end"] - s["start"] > longer_than]
                if not cuts:
                    out.append(old)
                    continue
                pieces, at, base = [], offsets[t], words.bounds[t]
                for s in cuts:
                    pieces.append(raw[at : words.starts[base + s["start"]]])
                    at = words.ends[base + s["end"] - 1]
                out.append(np.concatenate([*pieces, raw[at : offsets[t + 1]]]).tobytes().decode("utf-8", "replace"))
            yield batch.set_column(batch.schema.get_field_index(text), text, pa.array(out, pa.string()))

    return df.mapInArrow(run, df.schema)
