"""Language ID by words first, backing off to ever shorter character n-grams.

A word of the model scores its log frequency in every language. A word outside it scores the mean log frequency of its
longest n-grams that the model has: those of five characters, else of four, down to single letters. The scores of all
words of a text are added, whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.blocks import Words, blocks, code_points, keep_columns, mix, utf8
from ticketloom.operators.arrow_blocks import array

UNDETERMINED = "und"
#: Bounds of the model: texts to learn from, words, and n-grams of each length. They bound what is learned, not what is
#: predicted: a word that is not among the most frequent ones is scored by its n-grams.
LEARN_TEXTS = 20_000
MODEL_WORDS = 150_000
MODEL_GRAMS = 60_000
LONGEST_GRAM = 5
SMOOTHING = 0.5
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def letter_words(texts: pa.Array) -> tuple[Words, np.ndarray]:
    """Runs of letters of the lower-cased texts, and their code points."""
    texts = texts.fill_null("") if texts.null_count else texts
    points, offsets = code_points(*utf8(pc.utf8_lower(texts)))
    return Words(points, offsets, letters()), points


def grams(words: Words, chosen: np.ndarray, size: int, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of the chosen words, and the position (in ``chosen``) of the word each is from.

    A word is read with a mark before and behind it, so that starts and ends of words are n-grams of their own; a word
    shorter than an n-gram has none.
    """
    starts, lengths = words.starts[chosen], words.ends[chosen] - words.starts[chosen]
    marked = lengths + (2 if size > 1 else 0)
    n = np.maximum(marked - size + 1, 0)
    owner = np.repeat(np.arange(len(chosen)), n)
    inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    out = np.full(len(owner), size, np.uint64)
    for k in range(size):
        at = inner + k - (1 if size > 1 else 0)
        outside = (at < 0) | (at >= lengths[owner])
        value = points[np.where(outside, 0, starts[owner] + at)].astype(np.uint64) + np.uint64(1)
        value[outside] = 0
        out = mix(out ^ value) if k % 2 else out * np.uint64(0x9E3779B97F4A7C15) + value
    return owner, mix(out)


@dataclass
class Model:
    """Languages, and for every n (0: words) the sorted hashes with their log frequencies by language."""

    languages: list[str]
    tables: dict[int, tuple[np.ndarray, np.ndarray]]

    def _find(self, size: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, _ = self.tables[size]
        if not len(keys):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return at, keys[at] == hashes

    def word_scores(self, words: Words, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A row of scores for each distinct word of a block, and the row of every word."""
        unique, first, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
        scores = np.zeros((len(unique), len(self.languages)))
        at, known = self._find(0, unique)
        scores[known] = self.tables[0][1][at[known]]
        open_ = np.flatnonzero(~known)
        for size in range(LONGEST_GRAM, 0, -1):
            if not len(open_):
                break
            owner, hashes = grams(words, first[open_], size, points)
            at, known = self._find(size, hashes)
            owner, at = owner[known], at[known]
            if not len(owner):
                continue
            counts = np.bincount(owner, minlength=len(open_))
            for k in range(len(self.languages)):
                total = np.bincount(owner, self.tables[size][1][at, k], minlength=len(open_))
                scores[open_, k] += total / np.maximum(counts, 1)
            open_ = open_[counts == 0]
        return scores, inverse

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        words, points = letter_words(texts)
        scores, row = self.word_scores(words, points)
        total = np.empty((words.texts, len(self.languages)))
        for k in range(len(self.languages)):
            total[:, k] = np.bincount(words.text, scores[row, k], minlength=words.texts)
        best = total.argmax(1)
        share = 1.0 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        none = words.counts == 0
        names = np.array(self.languages, object)[best]
        names[none] = UNDETERMINED
        share[none] = 0.0
        return names.tolist(), share


def learned_texts(rows: DataFrame, texts: int) -> DataFrame:
    """Distinct texts ``t, l``: about ``texts`` in all, the same number at most for each language, chosen by a hash.

    A language with fewer texts than its share is learned whole, however large the others are, and copies count once.
    """
    found = F.approx_count_distinct(F.xxhash64("t"), 0.02)
    sizes = {r.l: r.n for r in rows.groupBy("l").agg(found.alias("n")).collect()}  # a row per language
    if not sizes:
        return rows
    share = max(1, texts // len(sizes))
    # a tenth more, so that the error of the estimate leaves no text out of a language that fits
    bound = F.element_at(F.create_map(*[F.lit(x) for l, n in sizes.items() for x in (l, min(1 << 30, int(1.1 * share / max(1, n) * (1 << 30))))]), F.col("l"))
    return rows.where(F.pmod(F.xxhash64("t", "l"), F.lit(1 << 30)) < bound).distinct()


def fit(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    learn_texts: int = LEARN_TEXTS,
    model_words: int = MODEL_WORDS,
    model_grams: int = MODEL_GRAMS,
) -> Model:
    """Learn from at most about ``learn_texts`` distinct texts, each language from an equal share of them at most.

    Counts are combined in Spark; only the most frequent words and n-grams of each language reach the driver, an equal
    share of the bounds for each. Rows with a null text or language are not learned from. Without any row the model
    knows no language.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("t"), F.col(lang).alias("l"))
    rows = learned_texts(rows, learn_texts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "t", 2 << 20):
            for lang_ in pc.unique(batch.column("l")).to_pylist():
                words, points = letter_words(batch.column("t").filter(pc.equal(batch.column("l"), lang_)))
                unique, first, counts = np.unique(words.hashes, return_index=True, return_counts=True)
                found = [(0, unique, counts)]
                for size in range(1, LONGEST_GRAM + 1):
                    owner, hashes = grams(words, first, size, points)
                    keys, inverse = np.unique(hashes, return_inverse=True)
                    found.append((size, keys, np.bincount(inverse, counts[owner], len(keys)).astype(np.int64)))
                for size, keys, n in found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang_] * len(keys), pa.string()), pa.array(np.full(len(keys), size, np.int32)),
                         pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))],
                        names=["lang", "size", "hash", "n"],
                    )

    counts = rows.mapInArrow(count, "lang string, size int, hash long, n long").groupBy("size", "hash", "lang").agg(F.sum("n").alias("n"))
    counts.persist()  # read several times, then given back: the pipeline's next stages need the disk
    totals = counts.groupBy("lang", "size").agg(F.sum("n").alias("n")).collect()
    languages = sorted({r["lang"] for r in totals})
    names = len(languages)
    sizes = counts.groupBy("lang", "size", "n").agg(F.count("*").alias("k")).orderBy("lang", "size", F.desc("n")).collect()
    # of the entries at the level where a share ends, a part is taken by hash
    taken: dict[tuple[str, int], int] = {}
    level: dict[tuple[str, int], tuple[int, int]] = {}
    for r in sizes:
        part, share = (r["lang"], r["size"]), max(1, (model_words if r["size"] == 0 else model_grams) // names)
        left = share - taken.get(part, 0)
        taken[part] = taken.get(part, 0) + r["k"]
        if left > 0:
            level[part] = (r["n"], 1 << 20 if r["k"] <= left else (left << 20) // r["k"])
    kept = None
    if level:
        at = F.element_at(F.create_map(*[x for (l, size), (n, part) in level.items() for x in (
            F.lit(f"{size} {l}"), F.struct(F.lit(n).alias("n"), F.lit(part).alias("part")))]), F.concat_ws(" ", F.col("size").cast("string"), "lang"))
        often = counts.where((F.col("n") > at["n"]) | ((F.col("n") == at["n"]) & (F.pmod("hash", F.lit(1 << 20)) < at["part"])))
        often = often.select("size", "hash").distinct()
        chosen = counts.join(often, ["size", "hash"], "left_semi")  # a row per language of at most as many entries as the model has
        # plain numbers in columns: rows with a map each would be many times as large on the driver
        code = F.element_at(F.create_map(*[F.lit(x) for k, l in enumerate(languages) for x in (l, k)]), F.col("lang"))
        kept = chosen.select(F.col("size").cast("byte").alias("size"), "hash", code.cast("int").alias("lang"), "n").toArrow()
    counts.unpersist()
    seen = {(r["lang"], r["size"]): r["n"] for r in totals}
    size_, hash_, lang_, n_ = (np.zeros(0, np.int64) if kept is None else array(kept.column(c)) for c in ("size", "hash", "lang", "n"))
    tables = {}
    for size in range(LONGEST_GRAM + 1):
        mine = size_ == size
        keys, row = np.unique(hash_[mine].view(np.uint64), return_inverse=True)
        table = np.zeros((len(keys), len(languages)))
        table[row, lang_[mine]] = n_[mine]
        total = np.array([seen.get((x, size), 0) for x in languages], float)
        # what a language lacks costs the same in all of them, whatever the size of their samples
        tables[size] = (keys, np.log(table / np.maximum(total, 1) + SMOOTHING / max(1.0, total.max(initial=0))))
    return Model(languages, tables)


def predict(df: DataFrame, model: Model, text: str = "text", columns: Sequence[str] | None = None) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (the share of the best language, 0 to 1) to ``columns`` (all by default).

    A null text, and one without a letter, is ``und`` with score 0, and so is every text if the model knows no language.
    Equal scores go to the first language by name. A computed column replaces an input column of the same name.
    """
    carried = [c for c in (df.columns if columns is None else columns) if c not in ("lang_pred", "score")]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*carried).schema)
    read = text if text in carried else "__text"  # a text that is carried along goes to Python once
    inner = df.select(*carried, *([] if read == text else [F.col(text).alias(read)]))
    if not model.languages:
        return inner.select(*carried).withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)})
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, read):
            names, share = shared.value.predict(batch.column(read))
            yield keep_columns(batch, carried, lang_pred=pa.array(names, pa.string()), score=pa.array(share))

    return inner.mapInArrow(run, ", ".join([x for x in (kinds, "lang_pred string, score double") if x]))


def held_out(doc_id: Column) -> Column:
    """A quarter of the documents, by the checksum of their id; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
