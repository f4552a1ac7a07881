"""Numeric views of texts inside a task: UTF-8 bytes, words and their hashes.

Every kernel of this subpackage works on one block of texts at a time. A block ends at ``BLOCK_BYTES``, so the memory of
a task follows the block (or one very long text), never the partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

BLOCK_BYTES = 1 << 20
#: Rows in an Arrow batch between Spark and Python: texts are long, and both sides hold whole batches.
BATCH_ROWS = 2000
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x2545F4914F6CDD1D
SPACES = b" \t\n\x0b\x0c\r"


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Lower the session's rows per Arrow batch to ``BATCH_ROWS`` if it allows more."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    return spark


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_table(members: Callable[[int], bool]) -> np.ndarray:
    """Truth table over the 256 byte values."""
    return np.array([members(b) for b in range(256)])


PRINTED = byte_table(lambda b: b not in SPACES)
BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)


class _Powers:
    """Powers of the hash base and of its inverse modulo 2**64, grown on demand up to the longest block seen."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = (n >> 18) + 1 << 18

            def powers(base: int) -> np.ndarray:
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                return np.cumprod(steps, dtype=np.uint64)

            self.up, self.down = powers(BASE), powers(pow(BASE, -1, 1 << 64))
        return self.up, self.down


_POWERS = _Powers()


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    n = len(column)
    _, offsets, data = column.buffers()
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def blocks(batches: Iterable[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of at most ``limit`` text bytes (a longer text is a slice of its own)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = batch.column(column).cast(pa.large_binary())
        ends = np.cumsum(np.nan_to_num(pc.binary_length(lengths).to_numpy(zero_copy_only=False)))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span ``values[start:end]`` of 64-bit values; equal spans have equal hashes."""
    up, down = _POWERS.get(len(values))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * GOLDEN)


class Words:
    """Words of a block: byte spans, the text each lies in, how many each text has, and their hashes."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, member: np.ndarray = PRINTED, hashed: bool = True) -> None:
        """``raw`` holds bytes or code points, ``member`` tells which of them belong to words."""
        inside = member[raw]
        self.raw, self.offsets, self.texts = raw, offsets, len(offsets) - 1
        edge = np.zeros(len(raw) + 1, bool)
        edge[offsets] = True
        first = inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:-1]
        last = inside.copy()
        if len(raw):
            last[:-1] &= ~inside[1:] | edge[1:-1]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.bounds)
        self.text = np.repeat(np.arange(self.texts), self.counts)
        if hashed:
            values = BYTE_HASH[raw] if raw.dtype == np.uint8 else mix((raw.astype(np.uint64) + np.uint64(1)) * GOLDEN)
            self.hashes = span_hashes(values, self.starts, self.ends)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of ``width`` words within one text."""
        n = len(self.starts) - width + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.text[:n] == self.text[width - 1 :])
        out = np.zeros(len(at), np.uint64)
        for k in range(width):
            out = out * np.uint64(BASE) + self.hashes[at + k]
        return at, mix(out)


def code_points(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, with the offsets of the texts among them; broken bytes count one each."""
    try:
        points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le", "surrogatepass"), np.uint32)
        at = np.zeros(len(raw) + 1, np.int64)
        np.cumsum((raw & 0xC0) != 0x80, out=at[1:])
        return points, at[offsets]
    except UnicodeDecodeError:
        texts = [raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
        sizes = np.cumsum([0, *map(len, texts)])
        return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), sizes


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of a per-byte (or per-word) value within each text."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def keep_columns(batch: pa.RecordBatch, names: Iterable[str], **made: pa.Array) -> pa.RecordBatch:
    """The named columns of a batch with computed ones behind them."""
    return pa.RecordBatch.from_arrays(
        [*(batch.column(n) for n in names), *made.values()], names=[*names, *made]
    )


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
