"""Quality rules as a short-circuit cascade.

A rule is a test on measures of a text. Its cost and its share of rejected texts are estimated on a sample; rules run in
the order of rejections per second, and a text that one rule rejects is not measured for the rules behind it. The
verdict is the same in every order: a text is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.blocks import (
    BYTE_HASH, GOLDEN, PRINTED, Words, blocks, byte_table, keep_columns, mix, per_text, span_hashes, utf8,
)

SYMBOLS = byte_table(lambda b: b in b"#*$%&|<>")
Block = tuple[np.ndarray, np.ndarray]
Values = dict[str, np.ndarray]


def _word_measures(block: Block) -> Values:
    raw, offsets = block
    words = Words(raw, offsets, hashed=False)
    return {"n_words": words.counts, "word_chars": per_text(PRINTED[raw] & ((raw & 0xC0) != 0x80), offsets)}


def _symbol_measures(block: Block) -> Values:
    return {"n_symbols": per_text(SYMBOLS[block[0]], block[1])}


def _distinct(keys: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """Distinct keys of each text."""
    _, first = np.unique(mix(keys + text.astype(np.uint64) * GOLDEN), return_index=True)
    return np.bincount(text[first], minlength=texts)


def _line_measures(block: Block) -> Values:
    raw, offsets = block
    texts = len(offsets) - 1
    breaks = np.flatnonzero(raw == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([offsets[1:], breaks]))
    text = np.repeat(np.arange(texts), 1 + np.diff(np.searchsorted(breaks, offsets)))
    printed = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(PRINTED[raw], out=printed[1:])
    full = printed[ends] > printed[starts]
    starts, ends, text = starts[full], ends[full], text[full]
    lines = np.bincount(text, minlength=texts)
    return {"n_lines": lines, "n_dup_lines": lines - _distinct(span_hashes(BYTE_HASH[raw], starts, ends), text, texts)}


def _repeat_measures(block: Block, width: int = 5) -> Values:
    words = Words(*block)
    at, hashes = words.windows(width)
    _, inverse, counts = np.unique(
        mix(hashes + words.text[at].astype(np.uint64) * GOLDEN), return_inverse=True, return_counts=True
    )
    repeated = at[counts[inverse] > 1]
    depth = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(depth, repeated, 1)
    np.add.at(depth, repeated + width, -1)
    return {"n_repeat_words": per_text(np.cumsum(depth[:-1]) > 0, words.bounds)}


MEASURES: dict[str, Callable[[Block], Values]] = {
    "n_words": _word_measures,
    "word_chars": _word_measures,
    "n_symbols": _symbol_measures,
    "n_lines": _line_measures,
    "n_dup_lines": _line_measures,
    "n_repeat_words": _repeat_measures,
}


@dataclass(frozen=True)
class Rule:
    """``rejects`` maps the arrays of the measures in ``uses`` to true where a text is to go."""

    name: str
    uses: tuple[str, ...]
    rejects: Callable[..., np.ndarray]


RULES = (
    Rule("few_words", ("n_words",), lambda n: n < 10),
    Rule("repetition", ("n_repeat_words", "n_words"), lambda r, n: 100 * r > 20 * n),
    Rule("word_length", ("word_chars", "n_words"), lambda c, n: (c < 2 * n) | (c > 20 * n)),
    Rule("symbols", ("n_symbols", "n_words"), lambda s, n: 10 * s > n),
    Rule("duplicate_lines", ("n_dup_lines", "n_lines"), lambda d, n: 10 * d > 3 * n),
)


class _Measured:
    """Measures of one block, worked out only for the texts that ask for them."""

    def __init__(self, texts: pa.Array) -> None:
        self.texts, self.n = texts, len(texts)
        self.values: Values = {}
        self.known: dict[Callable, np.ndarray] = {}

    def need(self, names: Sequence[str], rows: np.ndarray) -> None:
        for make in dict.fromkeys(MEASURES[n] for n in names):
            known = self.known.setdefault(make, np.zeros(self.n, bool))
            missing = rows & ~known
            if not missing.any():
                continue
            part = self.texts if missing.all() else self.texts.filter(pa.array(missing))
            for name, values in make(utf8(part)).items():
                self.values.setdefault(name, np.zeros(self.n, np.int64))[missing] = values
            known |= missing

    def rejected(self, rule: Rule, rows: np.ndarray) -> np.ndarray:
        self.need(rule.uses, rows)
        return rows & rule.rejects(*(self.values[n] for n in rule.uses))


@dataclass(frozen=True)
class Estimate:
    rule: str
    seconds: float
    rejected: float

    @property
    def gain(self) -> float:
        return self.rejected / max(self.seconds, 1e-12)


def estimate(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = 2000) -> list[Estimate]:
    """Seconds per text and share of rejected texts of every rule, each on its own, over about ``sample_rows`` texts.

    The sample only decides the order of the rules. An empty table gives zeros.
    """
    total = df.count()
    share = min(1.0, sample_rows / total) if total else 1.0
    chosen = df.select(text) if share == 1.0 else df.where(
        F.pmod(F.xxhash64(F.col(text)), F.lit(1_000_000)) < int(share * 1_000_000) + 1
    ).select(text)

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text):
            everything = np.ones(batch.num_rows, bool)
            rows = []
            for rule in rules:
                start = time.perf_counter()
                gone = int(_Measured(batch.column(text)).rejected(rule, everything).sum())
                rows.append((rule.name, time.perf_counter() - start, gone, batch.num_rows))
            names, seconds, gone, seen = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(seconds), pa.array(gone, pa.int64()), pa.array(seen, pa.int64())],
                names=["rule", "seconds", "gone", "seen"],
            )

    profiled = chosen.mapInArrow(profile, "rule string, seconds double, gone long, seen long")
    found = {r.rule: r for r in profiled.groupBy("rule").agg(*(F.sum(c).alias(c) for c in ("seconds", "gone", "seen"))).collect()}
    return [
        Estimate(r.name, found[r.name].seconds / found[r.name].seen, found[r.name].gone / found[r.name].seen)
        if r.name in found else Estimate(r.name, 0.0, 0.0)
        for r in rules
    ]


def ordered(rules: Sequence[Rule], estimates: Sequence[Estimate]) -> list[Rule]:
    """Most rejections per second first; equal gains by name."""
    gain = {e.rule: e.gain for e in estimates}
    return sorted(rules, key=lambda r: (-gain[r.name], r.name))


def cascade(
    df: DataFrame,
    text: str = "text",
    columns: Sequence[str] | None = None,
    rules: Sequence[Rule] = RULES,
    measures: Sequence[str] = (),
    sample_rows: int = 2000,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``kept``, ``rejected_by`` and ``rules_run`` to the given ``columns`` (all by default).

    ``measures`` are added for every row, kept or not. ``rejected_by`` and ``rules_run`` depend on the order that the
    sample suggests (or on ``order``, a list of rule names); ``kept`` does not. A null or empty text has no words and
    is measured as such. A computed column replaces an input column of the same name.
    """
    if order is None:
        rules = ordered(rules, estimate(df, text, rules, sample_rows))
    else:
        by_name = {r.name: r for r in rules}
        rules = [by_name[n] for n in order]
    made = [*measures, "kept", "rejected_by", "rules_run"]
    carried = [c for c in (df.columns if columns is None else columns) if c not in made]
    inner = df.select(*carried, F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "__text"):
            block = _Measured(batch.column("__text"))
            alive = np.ones(batch.num_rows, bool)
            by = np.zeros(batch.num_rows, np.int64)
            run_on = np.zeros(batch.num_rows, np.int32)
            for k, rule in enumerate(rules, 1):
                if not alive.any():
                    break
                run_on += alive
                gone = block.rejected(rule, alive)
                by[gone] = k
                alive &= ~gone
            block.need(measures, np.ones(batch.num_rows, bool))
            names = pa.array([None, *(r.name for r in rules)], pa.string())
            yield keep_columns(
                batch, carried, **{m: pa.array(block.values[m]) for m in measures},
                kept=pa.array(alive), rejected_by=names.take(pa.array(by)), rules_run=pa.array(run_on),
            )

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*carried).schema]
    schema = ", ".join([*kinds, *(f"{m} long" for m in measures), "kept boolean, rejected_by string, rules_run int"])
    return inner.mapInArrow(run, schema)
