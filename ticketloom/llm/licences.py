"""Licence scan: Dice coefficient of word bigrams between parts of a text and licence templates.

Parts are the whole text, its paragraphs (parted by lines without a word) and its lines. Texts are normalised to
lower-case words of a-z and 0-9 and everything outside ASCII. Two parts with x and y distinct bigrams have a Dice
coefficient of at most 2 min(x, y) / (x + y), so a template is compared only with parts whose size lies within bounds
that follow from the threshold, and a part without any bigram of a template is never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.blocks import Words, blocks, keep_columns
from ticketloom.llm.decontaminate import normalised_words
from ticketloom.llm.licence_texts import TEMPLATES

THRESHOLD = 0.85


class Templates:
    """Distinct bigrams of every template, and which templates hold a bigram."""

    def __init__(self, templates: Sequence[tuple[str, str]], threshold: float) -> None:
        self.names = [name for name, _ in templates]
        words = normalised_words(pa.array([text for _, text in templates], pa.string()))
        at, hashes = words.windows(2)
        pairs = np.unique(np.stack([hashes, words.text[at].astype(np.uint64)], 1), axis=0) if len(at) else np.zeros((0, 2), np.uint64)
        self.vocabulary = np.unique(pairs[:, 0])
        self.holders: dict[int, list[int]] = {}
        for h, k in pairs.tolist():
            self.holders.setdefault(h, []).append(k)
        self.sizes = np.bincount(pairs[:, 1].astype(np.int64), minlength=len(self.names))
        self.threshold = threshold
        reach = (2 - threshold) / threshold
        used = self.sizes[self.sizes > 0]
        self.least = int(np.ceil(used.min() / reach - 1e-9)) if len(used) else 1
        self.most = int(used.max() * reach + 1e-9) if len(used) else 0

    def best(self, hashes: np.ndarray) -> list[tuple[int, float]]:
        """Templates that reach the threshold for a part with the given bigrams (repeats allowed)."""
        mine = np.unique(hashes)
        x = len(mine)
        if not self.least <= x <= self.most:
            return []
        common: dict[int, int] = {}
        for h in mine[np.isin(mine, self.vocabulary, assume_unique=True)].tolist():
            for k in self.holders[h]:
                common[k] = common.get(k, 0) + 1
        out = []
        for k, n in common.items():
            y = int(self.sizes[k])
            if 2 * min(x, y) >= self.threshold * (x + y) and 2 * n >= self.threshold * (x + y):
                out.append((k, 2 * n / (x + y)))
        return out


def parts(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Word ranges of all lines, paragraphs and whole texts that have at least two words, each once."""
    raw, offsets = words.raw, words.offsets
    line_starts = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(raw == 10) + 1]))
    first = np.searchsorted(words.starts, line_starts)
    last = np.append(first[1:], len(words.starts))
    empty = first == last
    # a paragraph opens at the first line with a word after a text's start or an empty line
    opens = ~empty & (np.append(True, empty[:-1]) | np.isin(line_starts, offsets[:-1]))
    closes_at = np.flatnonzero(opens)
    para_first = first[closes_at]
    owner = words.text[para_first] if len(para_first) else np.zeros(0, np.int64)
    para_last = np.minimum(np.append(para_first[1:], len(words.starts)), words.bounds[owner + 1])
    begin = np.concatenate([first, para_first, words.bounds[:-1]])
    end = np.concatenate([np.minimum(last, _text_end(words, first)), para_last, words.bounds[1:]])
    ranges = np.unique(np.stack([begin, end], 1)[end - begin >= 2], axis=0)
    return ranges[:, 0], ranges[:, 1]


def _text_end(words: Words, first: np.ndarray) -> np.ndarray:
    """Last word range end of the text each word is in."""
    if not len(words.starts):
        return first
    inside = np.minimum(first, len(words.starts) - 1)
    return words.bounds[words.text[inside] + 1]


def scan(
    df: DataFrame, text: str = "text", columns: Sequence[str] | None = None,
    templates: Sequence[tuple[str, str]] = tuple(TEMPLATES), threshold: float = THRESHOLD,
) -> DataFrame:
    """Add ``licences`` (template names, sorted), ``best`` and ``dice`` (the highest coefficient) to ``columns``.

    A text that reaches the threshold of no template has an empty list, a null and a zero; so have null and empty texts.
    Equal coefficients go to the first template by name. The bigrams of all templates travel with the task, the texts
    stay where they are. A computed column replaces an input column of the same name.
    """
    carried = [c for c in (df.columns if columns is None else columns) if c not in ("licences", "best", "dice")]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*carried).schema)
    known = Templates(templates, threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "__text"):
            found: list[dict[str, float]] = [{} for _ in range(batch.num_rows)]
            words = normalised_words(batch.column("__text"))
            at, hashes = words.windows(2)
            hit = at[np.isin(hashes, known.vocabulary)]
            if len(hit):
                begin, end = parts(words)
                # bigrams of a part begin at all of its words but the last
                held = np.searchsorted(hit, end - 1) > np.searchsorted(hit, begin)
                wide = end - begin > known.least
                for b, e in zip(begin[held & wide].tolist(), end[held & wide].tolist()):
                    mine = hashes[np.searchsorted(at, b) : np.searchsorted(at, e - 1)]
                    for k, value in known.best(mine):
                        own = found[int(words.text[b])]
                        own[known.names[k]] = max(value, own.get(known.names[k], 0.0))
            top = [min(f, key=lambda n: (-f[n], n)) if f else None for f in found]
            yield keep_columns(
                batch, carried, licences=pa.array([sorted(f) for f in found], pa.list_(pa.string())),
                best=pa.array(top, pa.string()), dice=pa.array([f[t] if t else 0.0 for f, t in zip(found, top)]),
            )

    made = "licences array<string>, best string, dice double"
    return df.select(*carried, F.col(text).alias("__text")).mapInArrow(run, ", ".join([x for x in (kinds, made) if x]))
