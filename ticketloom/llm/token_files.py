"""Token ids of documents in Simple-8b files.

Texts are encoded with a public tokenizer, an end id closes each document, and the ids are written in ascending order of
the document id. A folder holds files whose names ascend with the ids; a file is a run of frames, a frame is

    magic "S8BF" | documents u32 | ids u64 | blocks u32 | words u64
    document ids i64 | id is null u8 | ids of each document u64 | first word of each block u64 | words u64 | newline

with little-endian numbers. Files are written by Spark's own text writer (one frame per line), so the write is committed
like any other table, on any file system that Spark reaches, and lost tasks are repeated.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm import simple8b
from ticketloom.llm.blocks import BYTE_HASH, blocks, byte_table, span_hashes, utf8

#: Text that is encoded at a time.
BATCH_BYTES = 2 << 20
MAGIC = b"S8BF"
HEADER = np.dtype([("magic", "S4"), ("documents", "<u4"), ("ids", "<u8"), ("blocks", "<u4"), ("words", "<u8")])
#: Pieces of text that a task remembers with their ids; beyond that the memory starts afresh.
REMEMBERED = 1_000_000
LONGEST_PIECE = 64
MARK = byte_table(lambda b: b in b".,;:!?")
LETTER = byte_table(lambda b: 65 <= b <= 90 or 97 <= b <= 122)


class PieceEncoder:
    """The ids a byte-level tokenizer gives to texts, worked out once for each distinct piece.

    The tokenizer's own splitting always breaks before a single space or line break that stands between printed
    characters, and between an ASCII letter and a mark such as a comma, so texts are cut there. Cut pieces with no other
    white space are remembered by hash; the rest (starts of texts, runs of white space, very long pieces) goes through
    the tokenizer as it is. So does a stretch around an added token's content, which the library takes out of the text
    before any splitting; with ``plain_specials``, special tokens are plain characters instead.
    """

    def __init__(self, definition: str, remembered: int = REMEMBERED, plain_specials: bool = True) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        if plain_specials:
            self.tokenizer.encode_special_tokens = True
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content.encode() for t in added if t.content and not (plain_specials and t.special)]
        self.joinable = not any(min(x) <= 32 for x in self.added)
        self.remembered = remembered
        self.known = {}
        tokens = self.tokenizer.get_vocab(with_added_tokens=False)
        self.opening = np.zeros(max(tokens.values(), default=0) + 2, bool)
        for token, i in tokens.items():
            self.opening[i] = token[0] in "ĠĊ"  # how the vocabulary writes a space and a line break
        self._forget()

    def _forget(self) -> None:
        """Start afresh with the pieces that came up in more than one block."""
        kept = np.flatnonzero(self.again[: len(self.known)]) if self.known else np.zeros(0, np.int64)
        if len(kept) > self.remembered // 2:
            kept = kept[:0]
        hashes = np.fromiter(self.known, np.uint64, len(self.known))[kept].tolist() if len(kept) else []
        sizes = self.sizes[kept] if len(kept) else np.zeros(0, np.int64)
        run = np.repeat(np.cumsum(sizes) - sizes, sizes)
        ids = self.ids[np.repeat(self.starts[kept], sizes) + np.arange(len(run)) - run] if len(kept) else np.zeros(0, np.uint32)
        self.known: dict[int, int] = {}
        self.starts, self.sizes = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.seen, self.again = np.zeros(1 << 16, bool), np.zeros(1 << 16, bool)
        self.ids, self.used = np.zeros(1 << 18, np.uint32), 0
        self._store(hashes, sizes, ids)

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each hash, -1 if it is not known."""
        return np.fromiter(map(self.known.get, hashes.tolist(), repeat(-1)), np.int64, len(hashes))

    def _store(self, hashes: list[int], sizes: np.ndarray, ids: np.ndarray) -> None:
        n, m = len(self.known), len(hashes)
        while n + m > len(self.starts):
            for name in ("starts", "sizes", "seen", "again"):
                setattr(self, name, np.resize(getattr(self, name), 2 * len(self.starts) if name == "starts" else len(self.starts)))
        self.seen[n : n + m] = self.again[n : n + m] = False
        self._room(len(ids))
        self.starts[n : n + m] = self.used + np.cumsum(sizes) - sizes
        self.sizes[n : n + m] = sizes
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.known.update(zip(hashes, range(n, n + m)))

    def _room(self, n: int) -> None:
        while self.used + n > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def _cuts(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of pieces, and whether each begins at a safe break."""
        blank = (raw == 32) | (raw == 10)
        safe = np.zeros(len(raw), bool)
        if len(raw) > 2:
            prev, after = raw[:-2], raw[2:]
            # the first byte of a white-space character outside ASCII is C2, E1, E2 or E3
            odd = np.zeros(len(raw) + 2, bool)
            lead = (raw == 0xC2) | ((raw >= 0xE1) & (raw <= 0xE3))
            odd[1:-1] = lead
            back = odd[: len(raw)] | np.concatenate([[False], odd[: len(raw) - 1]])
            ends_odd = back[:-2] | lead[:-2]
            safe[1:-1] = blank[1:-1] & (prev > 32) & (prev != 127) & (after > 32) & (after != 127) & ~lead[2:] & ~ends_odd
            safe[1:-1] |= MARK[raw[1:-1]] & LETTER[prev]
        edge = np.zeros(len(raw) + 1, bool)
        edge[offsets] = True
        safe &= ~edge[:-1] & ~edge[1:]
        starts = np.flatnonzero(safe | edge[:-1])
        return starts, safe[starts]

    def _added(self, raw: np.ndarray) -> np.ndarray:
        """First and last byte of every place that reads like an added token."""
        content, out = raw.tobytes() if self.added else b"", []
        for token in self.added:
            at = content.find(token)
            while at >= 0:
                out.append((at, at + len(token) - 1))
                at = content.find(token, at + 1)
        return np.array(sorted(out), np.int64).reshape(-1, 2)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts behind each other, and how many each text has."""
        if len(self.known) > self.remembered:
            self._forget()
        raw, offsets = utf8(texts)
        starts, safe = self._cuts(raw, offsets)
        added = self._added(raw)
        if len(added):
            # no cut inside an added token or beside it
            near = np.zeros(len(raw) + 3, np.int64)
            np.add.at(near, np.maximum(added[:, 0] - 1, 0), 1)
            np.add.at(near, added[:, 1] + 3, -1)
            keep = ~safe | (np.cumsum(near)[starts] == 0)
            starts, safe = starts[keep], safe[keep]
            safe[np.searchsorted(starts, added[:, 0], "right") - 1] = False
        ends = np.append(starts[1:], len(raw))
        blanks = np.zeros(len(raw) + 1, np.int64)
        np.cumsum(raw <= 32, out=blanks[1:])
        opened = raw[starts] <= 32
        usual = safe & (blanks[ends] - blanks[starts] == opened) & (ends - starts <= LONGEST_PIECE)
        hashes = span_hashes(BYTE_HASH[raw], starts, ends)
        unique, where, inverse = np.unique(hashes[usual], return_index=True, return_inverse=True)
        slots = self._slots(unique)
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            first = np.flatnonzero(usual)[where[missing]]
            blank = opened[first] & self.joinable
            pieces = [raw[a:b].tobytes() for a, b in zip(starts[first].tolist(), ends[first].tolist())]
            # pieces that open with a blank are worked out as one text and parted where a token opens with one
            ids = np.array(self._plain([b"".join(compress(pieces, blank)).decode("utf-8", "replace")])[0], np.uint32)
            begins = np.flatnonzero(self.opening[ids])
            if len(begins) != blank.sum():  # some token opens with a blank inside a piece
                blank, ids, begins = np.zeros(len(pieces), bool), ids[:0], begins[:0]
            each = self._plain([x.decode("utf-8", "replace") for x in compress(pieces, ~blank)])
            order = np.concatenate([missing[blank], missing[~blank]])
            counts = np.concatenate([np.diff(np.append(begins, len(ids))), np.array([len(x) for x in each], np.int64)])
            self._store(unique[order].tolist(), counts, np.concatenate([ids, np.array([i for x in each for i in x], np.uint32)]))
            slots[order] = np.arange(len(self.known) - len(order), len(self.known))
        self.again[slots] |= self.seen[slots]
        self.seen[slots] = True
        slots = slots[inverse]
        sizes = np.zeros(len(starts), np.int64)
        sizes[usual] = self.sizes[slots]
        others = np.flatnonzero(~usual)
        rest = self._plain([raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(starts[others], ends[others])])
        sizes[others] = [len(x) for x in rest]
        first = np.zeros(len(starts), np.int64)
        first[usual] = self.starts[slots]
        first[others] = self.used + np.cumsum(sizes[others]) - sizes[others]
        self._room(int(sizes[others].sum()))  # the rest stands behind the remembered ids until the next call
        self.ids[self.used : self.used + int(sizes[others].sum())] = np.array([i for x in rest for i in x], np.uint32)
        place = np.cumsum(sizes) - sizes
        source = np.repeat((first - place).astype(np.int32), sizes)
        source += np.arange(len(source), dtype=np.int32)
        out = self.ids[source]
        total = np.append(np.cumsum(sizes) - sizes, sizes.sum())
        bounds = total[np.searchsorted(starts, offsets)]
        return out, np.diff(bounds)


def frame(doc_ids: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> bytes:
    words, offsets = simple8b.encode(ids)
    head = np.array([(MAGIC, len(sizes), len(ids), len(offsets), len(words))], HEADER)
    nulls = doc_ids.is_null().to_numpy(zero_copy_only=False)
    keys = doc_ids.fill_null(0).to_numpy(zero_copy_only=False)
    return b"".join([
        head.tobytes(), keys.astype("<i8").tobytes(), nulls.astype("u1").tobytes(), sizes.astype("<u8").tobytes(),
        offsets.astype("<u8").tobytes(), words.astype("<u8").tobytes(),
    ])


def frames(content: memoryview) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Document ids, their nulls, ids per document and all ids of every frame of a file."""
    at = 0

    def part(kind: str, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(content, kind, n, at)
        at += out.nbytes
        return out

    while at < len(content):
        head = part(HEADER, 1)[0]
        if head["magic"] != MAGIC:
            raise ValueError(f"no frame at byte {at - HEADER.itemsize}")
        docs, n = int(head["documents"]), int(head["ids"])
        keys, nulls, sizes = part("<i8", docs), part("u1", docs), part("<u8", docs).astype(np.int64)
        offsets, words = part("<u8", int(head["blocks"])).astype(np.int64), part("<u8", int(head["words"]))
        at += 1  # the newline
        yield keys, nulls, sizes, simple8b.decode(words, offsets, n)


_ENCODERS: dict[tuple[int, bool], PieceEncoder] = {}


def write_tokens(
    df: DataFrame, path: str, tokenizer_file: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 2,
    plain_specials: bool = True,
) -> None:
    """Encode every text and write the ids in ascending order of ``doc_id`` (a long; nulls first, ties by text).

    A special token's content in a text is plain characters, or without ``plain_specials`` that token, as the library has it.
    A null text is empty. The documents are dealt out by ranges of id and text, so no repeated id needs a task to itself.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())
    ranges = df.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    ranges = ranges.withColumn("tie", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    ranges = ranges.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").drop("tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        definition = shared.value
        key = hash(definition), plain_specials
        encoder = _ENCODERS.get(key) or _ENCODERS.setdefault(key, PieceEncoder(definition, plain_specials=plain_specials))
        for batch in blocks(batches, "text", BATCH_BYTES):
            ids, sizes = encoder.encode(batch.column("text"))
            closed = np.full(len(ids) + len(sizes), end_id, np.uint32)
            closed[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes)] = ids
            yield pa.RecordBatch.from_arrays(
                [pa.array([frame(batch.column("id"), closed, sizes + 1)], pa.binary())], names=["frame"]
            )

    ranges.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("value")).write.text(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``file, doc_id, start, n_tokens, ids`` of every document; ``start`` counts the ids of the file before it."""
    return _read(spark, path, "ids array<long>", lambda ids: pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64())))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Like ``read_tokens``, with ``ids_crc32`` of the ids as little-endian unsigned 32-bit numbers in place of them."""
    return _read(spark, path, "ids_crc32 long", lambda ids: pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()))


def _read(spark: SparkSession, path: str, column: str, made) -> DataFrame:
    name = column.split()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content")):
                start = 0
                for keys, nulls, sizes, ids in frames(memoryview(content.as_buffer())):
                    ends = np.cumsum(sizes)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([file.as_py()] * len(keys)), pa.array(keys, mask=nulls.astype(bool)),
                            pa.array(start + ends - sizes), pa.array(sizes),
                            made([ids[a:b] for a, b in zip(ends - sizes, ends)]),
                        ],
                        names=["file", "doc_id", "start", "n_tokens", name],
                    )
                    start += int(ends[-1]) if len(ends) else 0

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(run, f"file string, doc_id long, start long, n_tokens long, {column}")


def with_global_start(documents: DataFrame) -> DataFrame:
    """Make ``start`` count the ids of all documents before, over all files in the order of their names.

    Files are few and their totals are summed before they meet, so the running sum over files is one small task.
    """
    totals = documents.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    order = F.expr("sum(total) OVER (ORDER BY file) - total")
    return documents.join(totals.select("file", order.alias("before")), "file").withColumn("start", F.col("start") + F.col("before")).drop("before", "file")
