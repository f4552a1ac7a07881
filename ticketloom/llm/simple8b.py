"""Simple-8b: word-aligned coding of ids, many to a 64-bit word.

The upper four bits of a word select how many values of how many bits its lower sixty bits hold. Selector 0 is the
escape: the next word is one value as it is. Values are coded in blocks of ``BLOCK`` that start on a word of their own,
so that a decoder can begin at any block and unpack all words of one selector at once.
"""

from __future__ import annotations

import numpy as np

BLOCK = 512
#: Values per word and bits per value of selectors 1 to 15 (fixed values of the format).
PACKING = [
    (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20),
    (2, 30), (1, 60),
]
_TAIL = max(n for n, _ in PACKING)
_COUNTS = np.array([1, *(n for n, _ in PACKING)])
_WIDTHS = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


def _choices(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At every place, how many values a word that begins there takes, and its selector."""
    if len(values) and values.max() < len(_WIDTHS):
        width = _WIDTHS[values]
    else:
        width = np.frexp(values.astype(np.float64))[1].astype(np.uint8)  # never below the true number of bits
    n = len(width)
    widest = {1: np.concatenate([width, np.full(_TAIL, 255, np.uint8)])}
    while max(widest) * 2 <= _TAIL:
        k = max(widest)
        widest[2 * k] = np.maximum(widest[k], np.append(widest[k][k:], np.full(k, 255, np.uint8)))
    chosen = np.zeros(n, np.uint8)
    for selector in range(len(PACKING), 0, -1):  # the last that fits takes the most
        count, bits = PACKING[selector - 1]
        k = 1 << (count.bit_length() - 1)
        fits = np.maximum(widest[k][:n], widest[k][count - k :][:n]) <= bits
        np.copyto(chosen, selector, where=fits)
    return _COUNTS[chosen], chosen


def encode(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Words and, for each block of values, the index of its first word.

    Every word takes as many values as fit. All blocks are packed in step: one pass of the loop makes one word of each.
    """
    values = np.asarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rows = -(-n // block)
    padded = np.zeros((rows, block + _TAIL), np.uint64)
    flat = np.zeros(rows * block, np.uint64)
    flat[:n] = values
    padded[:, :block] = flat.reshape(rows, block)
    padded = padded.reshape(-1)
    take, chosen = _choices(padded)
    ends = np.minimum((np.arange(rows) + 1) * block, n) - np.arange(rows) * block
    stride = block + _TAIL
    live, at = np.arange(rows), np.zeros(rows, np.int64)
    made: list[np.ndarray] = []
    while len(live):
        where = live * stride + at
        made.append(where)
        at = at + take[where]
        more = at < ends[live]
        live, at = live[more], at[more]
    begins = np.zeros(len(padded), bool)
    for where in made:
        begins[where] = True
    where = np.flatnonzero(begins)
    owner = where // stride
    selectors = chosen[where]
    size = 1 + (selectors == 0)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    for selector, (count, bits) in enumerate(PACKING, 1):
        mine = selectors == selector
        if mine.any():
            packed = np.full(int(mine.sum()), selector << 60, np.uint64)
            for k in range(count if bits else 0):
                packed |= padded[where[mine] + k] << np.uint64(k * bits)
            words[place[mine]] = packed
    words[place[selectors == 0] + 1] = padded[where[selectors == 0]]
    first = np.searchsorted(owner, np.arange(rows))
    return words, place[first]


def decode(words: np.ndarray, offsets: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ``n`` values that ``encode`` was given; selectors are unpacked together, over all blocks."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    words = np.asarray(words, np.uint64)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    header = np.ones(len(words), bool)
    for k in np.flatnonzero(selectors == 0):  # a raw word is no header, whatever its upper bits say
        if header[k]:
            header[k + 1] = False
    counts = _COUNTS[selectors] * header
    owner = np.searchsorted(offsets, np.arange(len(words)), "right") - 1
    before = np.cumsum(counts) - counts
    start = before - before[offsets][owner] + owner * block
    limit = np.minimum((owner + 1) * block, n)
    for selector, (count, bits) in enumerate(PACKING, 1):
        mine = np.flatnonzero(header & (selectors == selector))
        mask = np.uint64((1 << bits) - 1)
        for k in range(count if bits and len(mine) else 0):
            at = start[mine] + k
            ok = at < limit[mine]
            out[at[ok]] = (words[mine[ok]] >> np.uint64(k * bits)) & mask
    raw = np.flatnonzero(header & (selectors == 0))
    out[start[raw]] = words[raw + 1]
    return out
