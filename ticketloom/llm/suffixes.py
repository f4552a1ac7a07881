"""Exact removal of repeated byte strings by suffix arrays, built with the difference-cover algorithm.

A byte goes if a string of ``SPAN`` bytes over it also starts in a document with a smaller id. The texts are far too
long for one suffix array, and most of them repeat nothing, so the work is cut by content:

1. Every string of ``SPAN`` bytes has an anchor, the least-hashed ``MARK``-gram in it. Blocks of texts send the hashes of
   their anchors to hash buckets; an anchor that two documents hold is marked. Strings whose anchor is not marked occur
   in one document only and are settled.
2. Neighbouring strings with the same (shorter, ``JOIN``-gram) anchor make a phrase. Phrases go to the bucket of their
   anchor, each content once per block, so that all copies of a string meet in one bucket whatever surrounds them.
3. A bucket builds the suffix array of its distinct phrases: sorted triples at the positions of the difference cover
   {1, 2} modulo 3, recursion on their names, the remaining suffixes merged in. Adjacent suffixes that agree in their
   first ``SPAN`` bytes are one string; the smallest document that holds it goes back to the blocks.
4. The blocks cut what a smaller document holds.

Hashes only decide what is compared with what; that two strings are equal is decided on their bytes, apart from whole
phrases, whose copies are recognised by 64-bit fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.blocks import _POWERS, BYTE_HASH, GOLDEN, mix, utf8
from ticketloom.runtime import cut

SPAN = 50
MARK, JOIN = 24, 12
#: Text in a block; a longer text is a block of its own.
BLOCK = 4 << 20
#: Strings looked at together inside a block.
PIECE = 1 << 18
#: Anchors and phrase bytes that a bucket should hold.
BUCKET_ANCHORS, BUCKET_BYTES = 1 << 20, 1 << 21
LOW = np.uint64((1 << 24) - 1)
WIDE = 1 << 21
NAME_TABLE = 1 << 22


def _sorted_names(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the tuples, and their dense names from 1 in that order; ties have the same name."""
    if max((int(c.max(initial=0)) for c in columns)) < WIDE:
        key = columns[0]
        for c in columns[1:]:
            key = key * WIDE + c
        order = np.argsort(key)
        key = key[order]
        new = key[1:] != key[:-1]
    else:
        order = np.lexsort(columns[::-1])
        new = np.zeros(max(0, len(order) - 1), bool)
        for c in columns:
            new |= c[order][1:] != c[order][:-1]
    return order, np.cumsum(np.r_[True, new])[: len(order)]


def _triple_names(first: np.ndarray, second: np.ndarray, third: np.ndarray) -> tuple[np.ndarray | None, np.ndarray]:
    """Order of the triples if it had to be found, and the name of each one; few symbols are named from a table."""
    base = int(first.max(initial=0)) + 1
    base = max(base, int(second.max(initial=0)) + 1, int(third.max(initial=0)) + 1)
    if base > 1 << 16:
        dense, size = (first, second, third), base
    else:
        there = np.zeros(base, bool)
        for c in (first, second, third):
            there[c] = True
        rank = np.cumsum(there) - 1
        dense, size = (rank[first], rank[second], rank[third]), int(rank[-1]) + 1
    if size**3 <= NAME_TABLE:
        key = (dense[0] * size + dense[1]) * size + dense[2]
        there = np.zeros(size**3, bool)
        there[key] = True
        return None, np.cumsum(there)[key]
    order, named = _sorted_names(*dense)
    names = np.empty(len(order), np.int64)
    names[order] = named
    return order, names


def suffix_array(symbols: np.ndarray, span: int | None = None) -> np.ndarray:
    """Starts of the suffixes of ``symbols`` (from 1, below 2**31) in order; with ``span``, of their first ``span`` symbols at least.

    The recursion ends when the names of the sampled triples are unique or cover ``span`` symbols.
    """
    n = len(symbols)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: symbols[i:].tolist()), np.int64)
    s = np.zeros(n + 3, np.int64)
    s[:n] = symbols
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)  # n % 3 == 1: an empty suffix ends the first row
    sample = np.r_[ones, twos]
    order, names = _triple_names(s[sample], s[sample + 1], s[sample + 2])
    if names.max() < len(sample) and (span is None or span > 3):
        order = suffix_array(names, None if span is None else -(-span // 3))
        names[order] = np.arange(1, len(sample) + 1)
    elif order is None:
        order = np.argsort(names)
    rank = np.zeros(n + 3, np.int64)
    rank[sample] = names
    by_rank = sample[order]
    by_rank = by_rank[by_rank < n]
    rest = np.arange(0, n, 3)
    rest = rest[_sorted_names(s[rest], rank[rest + 1])[0]]
    # a remaining suffix meets those at 1 mod 3 by one symbol and a rank, those at 2 mod 3 by two symbols and a rank
    one, two = by_rank[by_rank % 3 == 1], by_rank[by_rank % 3 == 2]
    less = _count_less((s[one], rank[one + 1]), (s[rest], rank[rest + 1]))
    less += _count_less((s[two], s[two + 1], rank[two + 2]), (s[rest], s[rest + 1], rank[rest + 2]))
    out = np.empty(n, np.int64)
    place = np.maximum.accumulate(less) + np.arange(len(rest))
    taken = np.zeros(n, bool)
    taken[place] = True
    out[place] = rest
    out[~taken] = by_rank
    return out


def _count_less(sorted_columns: tuple[np.ndarray, ...], columns: tuple[np.ndarray, ...]) -> np.ndarray:
    """How many of the sorted tuples are less than each of the others."""
    largest = max(int(c.max(initial=0)) for c in (*sorted_columns, *columns))
    if largest >= WIDE and len(columns) == 3:  # three columns no longer fit into 64 bits: name the first two
        both = [np.r_[a, b] for a, b in zip(sorted_columns[:2], columns[:2])]
        order, named = _sorted_names(*both)
        names = np.empty(len(order), np.int64)
        names[order] = named
        k = len(sorted_columns[0])
        return _count_less((names[:k], sorted_columns[2]), (names[k:], columns[2]))
    width = max(WIDE, largest + 1)

    def key(parts: tuple[np.ndarray, ...]) -> np.ndarray:
        out = parts[0]
        for p in parts[1:]:
            out = out * width + p
        return out

    return np.searchsorted(key(sorted_columns), key(columns), "left")


def repeated_strings(symbols: np.ndarray, wanted: np.ndarray, span: int = SPAN) -> np.ndarray:
    """Class of the ``span`` symbols at every wanted start, by adjacent suffixes; equal strings have the same class."""
    mark = np.zeros(len(symbols) + 1, bool)
    mark[wanted] = True
    order = suffix_array(symbols, span)
    order = order[mark[order]]
    same = np.ones(max(0, len(order) - 1), bool)
    # seven symbols, bytes or a separator, fit into a word with nine bits for each
    one = np.r_[symbols.astype(np.uint64), np.zeros(8, np.uint64)]
    two = (one[:-1] << np.uint64(9)) | one[1:]
    four = (two[:-2] << np.uint64(18)) | two[2:]
    words = (four[:-4] << np.uint64(27)) | (two[4 : len(four)] << np.uint64(9)) | one[6 : len(four) + 2]
    for at in [*range(0, span - 7, 7), span - 7]:
        w = words[order + at]
        same &= w[1:] == w[:-1]
    found = np.empty(len(symbols) + 1, np.int64)
    found[order] = np.cumsum(np.r_[True, ~same])[: len(order)] - 1
    return found[wanted]


def anchor_runs(raw: np.ndarray, offsets: np.ndarray, gram: int, use: np.ndarray | None = None, span: int = SPAN):
    """First and last start of every run of strings with the same anchor, the anchor's hash, and the run's fingerprint.

    Strings lie within one text; texts not in ``use`` have none. A run ends with its piece, which changes nothing for
    the strings in it.
    """
    reach = span - gram + 1
    text = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    if use is not None:
        text[~use[text]] = -1
    out: list[tuple[np.ndarray, ...]] = []
    for base in range(0, len(raw) - span + 1, PIECE):
        stop = min(len(raw) - span + 1, base + PIECE)
        piece, n = raw[base : stop + span - 1], stop - base
        up, down = _POWERS.get(len(piece))
        total = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(BYTE_HASH[piece] * up[: len(piece)], out=total[1:])
        grams = mix((total[gram:] - total[:-gram]) * down[: len(total) - gram])
        least = (grams & ~LOW) | np.arange(len(grams), dtype=np.uint64)
        width = 1
        while width * 2 <= reach:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = reach - width
        least = np.minimum(least[: len(least) - rest], least[rest:])[:n]
        place = (least & LOW).astype(np.int64)
        here = text[base:stop]
        good = (here == text[base + span - 1 : stop + span - 1]) & (here >= 0)
        turn = np.r_[True, (place[1:] != place[:-1]) | ~good[:-1] | ~good[1:]]
        first = np.flatnonzero(turn & good)
        last = np.flatnonzero(np.r_[turn[1:], True] & good)
        ends = last + span
        prints = mix((total[ends] - total[first]) * down[first] + (ends - first).astype(np.uint64) * GOLDEN)
        out.append((first + base, last + base, grams[place[first]], prints))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def slices(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all the ranges, one behind the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class Block:
    """Texts that are kept together: ids, bytes and bounds."""

    def __init__(self, ids: np.ndarray, null: np.ndarray, offsets: np.ndarray, raw: np.ndarray) -> None:
        self.ids, self.null, self.offsets, self.raw = ids, null, offsets, raw

    @classmethod
    def read(cls, batch: pa.RecordBatch, row: int) -> "Block":
        ids = batch.column("ids")[row].values
        lengths = batch.column("lengths")[row].values.to_numpy()
        offsets = np.r_[0, np.cumsum(lengths)]
        data = batch.column("data")[row].as_buffer()
        raw = pa.decompress(data, decompressed_size=int(offsets[-1]), codec="zstd") if offsets[-1] else b""
        return cls(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), offsets, np.frombuffer(raw, np.uint8))

    def anchors(self):
        return anchor_runs(self.raw, self.offsets, MARK, ~self.null)

    def phrases(self, marks: pa.ListScalar, width: int) -> "Phrases":
        return Phrases(self, np.concatenate([thick(x.as_buffer(), width) for x in marks.values]), width)


class Phrases:
    """Phrases of the strings of a block whose anchors are marked, in the stretches of the block that hold such strings."""

    def __init__(self, block: Block, marks: np.ndarray, width: int) -> None:
        first, last, hashes, _ = block.anchors()
        marks = np.sort(marks)
        short = record(hashes, width)
        at = np.minimum(np.searchsorted(marks, short), max(0, len(marks) - 1))
        hit = marks[at] == short if len(marks) else np.zeros(len(short), bool)
        first, last = first[hit], last[hit]
        joined = np.r_[False, first[1:] == last[:-1] + 1][: len(first)]  # neighbours in one text, or a text would end between
        begins, ends = first[~joined], last[np.r_[~joined[1:], True][: len(first)]] + SPAN
        self.raw = block.raw[slices(begins, ends - begins)]
        offsets = np.r_[0, np.cumsum(ends - begins)]
        self.first, self.last, self.hashes, prints = anchor_runs(self.raw, offsets, JOIN)
        stretch = np.searchsorted(offsets, self.first, "right") - 1
        self.start = self.first - offsets[stretch] + begins[stretch]
        self.doc = block.ids[np.searchsorted(block.offsets, self.start, "right") - 1]
        self.prints, self.sample, self.which = np.unique(prints, return_index=True, return_inverse=True)


def record(hashes: np.ndarray, width: int) -> np.ndarray:
    """The leading bits of anchors' hashes by which they are marked; they and a flag fill ``width`` bytes."""
    return hashes >> np.uint64(65 - 8 * width)


def record_width(total: int) -> int:
    """Bytes that keep chance matches between the anchors of ``total`` bytes of text below one in a thousand."""
    return min(8, -(-(max(1, total // 8).bit_length() + 11) // 8))


def thin(values: np.ndarray, width: int) -> bytes:
    """Values below ``256 ** width`` in that many bytes each."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def thick(data, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def grouped(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by bucket, the buckets that occur, and where each begins and ends in that order."""
    order = np.argsort(bucket, kind="stable")
    used, begins = np.unique(bucket[order], return_index=True)
    return order, used, np.r_[begins, len(order)]


def packed(df: DataFrame, doc: str, text: str) -> DataFrame:
    """Texts in compressed blocks of about ``BLOCK`` bytes: ``block, ids, lengths, size, data``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, size = TaskContext.get().partitionId() << 32, [], 0

        def table() -> pa.RecordBatch:
            nonlocal block, size
            ids = pa.concat_arrays([b.column("id") for b in held])
            parts = [utf8(b.column("text")) for b in held]
            lengths = np.concatenate([np.diff(at) for _, at in parts])
            raw = np.concatenate([r for r, _ in parts])
            made = pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                 pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(lengths)),
                 pa.array([len(raw)], pa.int64()), pa.array([pa.compress(raw.tobytes(), codec="zstd", asbytes=True)], pa.binary())],
                names=["block", "ids", "lengths", "size", "data"],
            )
            block, size = block + 1, 0
            held.clear()
            return made

        for batch in batches:
            lengths = np.diff(utf8(batch.column("text"))[1])
            start = 0
            while start < batch.num_rows:
                stop = start + max(1, int(np.searchsorted(np.cumsum(lengths[start:]), BLOCK - size, "right")))
                held.append(batch.slice(start, stop - start))
                size += int(lengths[start:stop].sum())
                start = stop
                if size >= BLOCK or stop < batch.num_rows:
                    yield table()
        if held:
            yield table()

    rows = df.select(F.col(doc).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "block long, ids array<long>, lengths array<long>, size long, data binary")


def marked(blocks: DataFrame, buckets: int, width: int) -> DataFrame:
    """``block, marks``: leading hash bits of the anchors of a block that occur in another document as well."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block.read(batch, row)
                first, _, hashes, _ = block.anchors()
                own = record(hashes, width)
                doc = np.searchsorted(block.offsets, first, "right") - 1
                order = np.lexsort((doc, own))
                own, doc = own[order], doc[order]
                new = np.r_[True, own[1:] != own[:-1]][: len(own)]
                often = np.zeros(len(own), bool)
                often[:-1] = ~new[1:] & (doc[1:] != doc[:-1])
                group = np.cumsum(new) - 1
                twice = np.bincount(group[often], minlength=int(new.sum())) > 0
                own = own[new]
                order, used, bounds = grouped((own % np.uint64(buckets)).astype(np.int64))
                values = (own[order] << np.uint64(1)) | twice[order].astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int64()), pa.array(np.full(len(used), batch.column("block")[row].as_py()), pa.int64()),
                     pa.array([thin(values[i:j], width) for i, j in zip(bounds[:-1], bounds[1:])], pa.binary())],
                    names=["bucket", "block", "data"],
                )

    def meet(table: pa.Table) -> pa.Table:
        parts = [thick(x.as_buffer(), width) for x in table.column("data")]
        sizes = [len(p) for p in parts]
        values = np.concatenate(parts)
        _, which, times = np.unique(values >> np.uint64(1), return_inverse=True, return_counts=True)
        good = times > 1
        good[which[(values & np.uint64(1)) > 0]] = True
        keep = good[which]
        out = [(b, thin(v[k] >> np.uint64(1), width)) for b, v, k in zip(
            table.column("block").to_pylist(), parts, np.split(keep, np.cumsum(sizes)[:-1])) if k.any()]
        return pa.table({"block": pa.array([b for b, _ in out], pa.int64()), "marks": pa.array([m for _, m in out], pa.binary())})

    sent = blocks.mapInArrow(send, "bucket long, block long, data binary")
    return sent.groupBy("bucket").applyInArrow(meet, "block long, marks binary")


def _arrays(column: pa.ChunkedArray | pa.Array, kind) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in column]


def sent_phrases(blocks: DataFrame, marks: DataFrame, buckets: int, width: int) -> DataFrame:
    """Distinct phrases of every block by the bucket of their anchor, with the least and largest document that hold them."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                own = Block.read(batch, row).phrases(batch.column("marks")[row], width)
                if not len(own.prints):
                    continue
                count = len(own.prints)
                low, high = np.full(count, np.iinfo(np.int64).max), np.full(count, np.iinfo(np.int64).min)
                np.minimum.at(low, own.which, own.doc)
                np.maximum.at(high, own.which, own.doc)
                strings = (own.last - own.first + 1)[own.sample]
                order, used, bounds = grouped((own.hashes[own.sample] % np.uint64(buckets)).astype(np.int64))
                rows = []
                for i, j in zip(bounds[:-1], bounds[1:]):
                    pick = order[i:j]
                    body = own.raw[slices(own.first[own.sample[pick]], strings[pick] + SPAN - 1)]
                    rows.append((pick.astype(np.uint32).tobytes(), own.prints[pick].tobytes(), low[pick].tobytes(),
                                 high[pick].tobytes(), strings[pick].astype(np.uint8).tobytes(), body.tobytes()))
                names = ["phrase", "prints", "low", "high", "strings", "body"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int64()), pa.array(np.full(len(used), batch.column("block")[row].as_py()), pa.int64()),
                     *(pa.array(list(x), pa.binary()) for x in zip(*rows))],
                    names=["bucket", "block", *names],
                )

    found = blocks.join(marks.groupBy("block").agg(F.collect_list("marks").alias("marks")), "block")
    schema = "bucket long, block long, phrase binary, prints binary, low binary, high binary, strings binary, body binary"
    return found.mapInArrow(send, schema)


def settle_bucket(table: pa.Table) -> pa.Table:
    """For the phrases of each block: runs of strings that a smaller document than their largest one holds."""
    prints, low, high = (_arrays(table.column(c), k) for c, k in (("prints", np.uint64), ("low", np.int64), ("high", np.int64)))
    sizes = [len(p) for p in prints]
    prints, low, high = map(np.concatenate, (prints, low, high))
    strings = np.concatenate(_arrays(table.column("strings"), np.uint8)).astype(np.int64)
    phrase = np.concatenate(_arrays(table.column("phrase"), np.uint32))
    body = np.concatenate(_arrays(table.column("body"), np.uint8))
    at = np.cumsum(strings + SPAN - 1) - (strings + SPAN - 1)
    _, sample, which = np.unique(prints, return_index=True, return_inverse=True)
    least = np.full(len(sample), np.iinfo(np.int64).max)
    np.minimum.at(least, which, low)
    lengths = strings[sample] + SPAN - 1
    begins = np.cumsum(lengths + 1) - (lengths + 1)  # a separator behind every phrase
    symbols = np.ones(int((lengths + 1).sum()), np.int64)
    symbols[slices(begins, lengths)] = body[slices(at[sample], lengths)].astype(np.int64) + 2
    kind = repeated_strings(symbols, slices(begins, strings[sample]))
    holder = np.full(int(kind.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(holder, kind, np.repeat(least, strings[sample]))
    firsts = np.cumsum(strings[sample]) - strings[sample]
    told = holder[kind[slices(firsts[which], strings)]]
    entry = np.repeat(np.arange(len(prints)), strings)
    place = slices(np.zeros(len(strings), np.int64), strings)
    good = told < high[entry]
    told, entry, place = told[good], entry[good], place[good]
    new = np.r_[True, (entry[1:] != entry[:-1]) | (place[1:] != place[:-1] + 1) | (told[1:] != told[:-1])][: len(told)]
    starts = np.flatnonzero(new)
    counts = np.diff(np.r_[starts, len(told)])
    entry, place, told = entry[starts], place[starts], told[starts]
    block = np.repeat(np.arange(len(sizes)), sizes)[entry]
    bounds = np.searchsorted(block, np.arange(len(sizes) + 1))
    rows = [
        (b, phrase[entry[i:j]].tobytes(), place[i:j].astype(np.uint8).tobytes(), counts[i:j].astype(np.uint8).tobytes(), told[i:j].tobytes())
        for b, i, j in zip(table.column("block").to_pylist(), bounds[:-1], bounds[1:]) if j > i
    ]
    names = ["phrase", "place", "strings", "holder"]
    return pa.table({"block": pa.array([r[0] for r in rows], pa.int64()),
                     **{n: pa.array([r[k + 1] for r in rows], pa.binary()) for k, n in enumerate(names)}})


def removed_bytes(block: Block, own: Phrases, phrase: np.ndarray, place: np.ndarray, strings: np.ndarray, holder: np.ndarray):
    """Truth of every byte of a block: does a string over it start in a document smaller than its own?"""
    order = np.argsort(phrase, kind="stable")
    phrase, place, strings, holder = phrase[order], place[order].astype(np.int64), strings[order].astype(np.int64), holder[order]
    low, high = np.searchsorted(phrase, own.which, "left"), np.searchsorted(phrase, own.which, "right")
    told = slices(low, high - low)
    run = np.repeat(np.arange(len(own.which)), high - low)
    good = holder[told] < own.doc[run]
    told, run = told[good], run[good]
    start = own.start[run] + place[told]
    stop = start + strings[told] - 1 + SPAN
    change = np.bincount(start, minlength=len(block.raw) + 1) - np.bincount(stop, minlength=len(block.raw) + 1)
    return np.cumsum(change)[: len(block.raw)] > 0


MADE = "n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def deduplicated(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc, n_bytes, n_removed, spans`` (half-open byte ranges that go) and ``kept`` (the bytes that stay) of every row.

    Document ids are integers. Texts are their UTF-8 bytes, a null is empty; texts of fewer than ``SPAN`` bytes lose
    nothing. Rows with the same id have no order, so they cut nothing from each other; rows without an id neither lose
    bytes nor cut others. Other columns are left behind, so their names cannot clash. An empty table stays empty.
    """
    blocks = cut(packed(df, doc, text))
    total = blocks.agg(F.sum("size")).first()[0] or 0
    width = record_width(total)
    marks = cut(marked(blocks, max(1, total // (BUCKET_ANCHORS * (MARK // 2))), width))
    phrases = sent_phrases(blocks, marks, max(1, total // BUCKET_BYTES), width)
    schema = "block long, phrase binary, place binary, strings binary, holder binary"
    told = cut(phrases.groupBy("bucket").applyInArrow(settle_bucket, schema))
    own = marks.groupBy("block").agg(F.collect_list("marks").alias("marks"))
    answer = F.struct("phrase", "place", "strings", "holder")
    gone = told.groupBy("block").agg(F.collect_list(answer).alias("gone")).join(own, "block")
    return _cut_out(blocks.join(gone, "block", "left"), doc, width)


def _cut_out(rows: DataFrame, doc: str, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block.read(batch, row)
                gone = np.zeros(len(block.raw), bool)
                if batch.column("gone")[row].is_valid:
                    told = batch.column("gone")[row].values.flatten()
                    columns = [np.concatenate(_arrays(c, k)) for c, k in zip(told, (np.uint32, np.uint8, np.uint8, np.int64))]
                    gone = removed_bytes(block, block.phrases(batch.column("marks")[row], width), *columns)
                yield from _documents(block, gone, doc)

    schema = f"`{doc}` long, {MADE}"
    return rows.select("ids", "lengths", "data", "gone", "marks").mapInArrow(run, schema)


def _documents(block: Block, gone: np.ndarray, doc: str) -> Iterator[pa.RecordBatch]:
    """Rows of the texts of a block."""
    edge = np.zeros(len(gone) + 1, bool)
    edge[block.offsets] = True
    before = np.r_[False, gone[:-1]][: len(gone)]
    after = np.r_[gone[1:], False][: len(gone)]
    starts = np.flatnonzero(gone & (~before | edge[:-1]))
    ends = np.flatnonzero(gone & (~after | edge[1:])) + 1
    text = np.searchsorted(block.offsets, starts, "right") - 1
    bounds = np.searchsorted(text, np.arange(len(block.ids) + 1)).astype(np.int32)
    total = np.r_[0, np.cumsum(gone)]
    removed = total[block.offsets[1:]] - total[block.offsets[:-1]]
    lengths = np.diff(block.offsets)
    kept_at = np.r_[0, np.cumsum(lengths - removed)]
    kept = pa.Array.from_buffers(pa.large_binary(), len(block.ids), [None, pa.py_buffer(kept_at.astype(np.int64)), pa.py_buffer(block.raw[~gone].tobytes())])
    base = block.offsets[text]
    pairs = pa.StructArray.from_arrays([pa.array(starts - base), pa.array(ends - base)], names=["start", "end"])
    yield pa.RecordBatch.from_arrays(
        [pa.array(block.ids, pa.int64(), mask=block.null), pa.array(lengths, pa.int64()), pa.array(removed, pa.int64()),
         pa.ListArray.from_arrays(pa.array(bounds), pairs), kept.cast(pa.binary())],
        names=[doc, "n_bytes", "n_removed", "spans", "kept"],
    )
