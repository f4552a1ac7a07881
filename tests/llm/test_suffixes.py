"""Suffix arrays and repeated strings against sorting and sets."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ticketloom.llm import suffixes
from ticketloom.llm.queries import QUERIES
from ticketloom.llm.suffixes import anchor_runs, record_width, repeated_strings, suffix_array, thick, thin

KINDS = "doc_id long, text string"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=80), st.sampled_from([None, 1, 4, 9, 50]))
def test_suffix_array(symbols, span):
    got = suffix_array(np.array(symbols, np.int64), span).tolist()
    assert sorted(got) == list(range(len(symbols)))
    heads = [symbols[i : i + (span or len(symbols))] for i in got]
    assert heads == sorted(heads)


def test_suffix_array_of_long_repeats_and_wide_symbols():
    rng = np.random.default_rng(3)
    for symbols in (np.ones(5000, np.int64), np.tile([1, 2, 1], 900), rng.integers(1, 1 << 31, 3000), np.r_[rng.integers(1, 4, 999)].repeat(3)):
        names = np.unique(symbols, return_inverse=True)[1]
        want = sorted(range(len(symbols)), key=lambda i: names[i:].tolist())
        assert suffix_array(np.asarray(symbols, np.int64)).tolist() == want


def test_repeated_strings():
    rng = random.Random(2)
    text = [rng.choice([2, 3]) for _ in range(3000)]
    text = text[:400] + [1] + text[100:600] + [1] + text + [2] * 200
    wanted = np.arange(len(text) - 50)
    got = repeated_strings(np.array(text, np.int64), wanted).tolist()
    seen = {}
    for i, k in enumerate(got):
        assert seen.setdefault(tuple(text[i : i + 50]), k) == k
    assert len(set(seen.values())) == len(seen)


def test_anchors_depend_on_the_string_alone(monkeypatch):
    rng = random.Random(4)
    base = bytes(rng.choice(b"abcde ") for _ in range(900))
    texts = [base, b"", b"zz" + base[100:700] + b"qq" * 40, base[:49], b"x" * 500]
    for piece in (1 << 18, 64):
        monkeypatch.setattr(suffixes, "PIECE", piece)
        raw = np.frombuffer(b"".join(texts), np.uint8)
        first, last, hashes, _ = anchor_runs(raw, np.cumsum([0, *map(len, texts)]), 24)
        owner, at = {}, 0
        for i, j, h in zip(first.tolist(), last.tolist(), hashes.tolist()):
            for k in range(i, j + 1):
                assert owner.setdefault(raw[k : k + 50].tobytes(), h) == h
                at += 1
        assert at == sum(max(0, len(t) - 49) for t in texts)


@pytest.mark.parametrize("width", [3, 5, 8])
def test_thin_values(width):
    values = np.array([0, 1, 255, (1 << 8 * width) - 1], np.uint64)
    assert thick(thin(values, width), width).tolist() == values.tolist()
    assert record_width(1 << 30) == 5 and record_width(10**14) == 7


def brute(rows):
    """Rows of the query from (doc_id, text) tuples."""
    least = {}
    raws = [(d, (t or "").encode()) for d, t in rows]
    for d, raw in raws:
        for i in range(len(raw) - 49 if d is not None else 0):
            s = raw[i : i + 50]
            least[s] = min(d, least.get(s, d))
    out = []
    for d, raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - 49 if d is not None else 0):
            if least[raw[i : i + 50]] < d:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def table(seed=1):
    rng = random.Random(seed)
    words = ["the", "of", "über", "naïve", "cat", "dog", "sat", "on", "mat", "\n", "a", "zeta"]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randrange(5, 90))) for _ in range(12)]
    rows = []
    for d in range(160):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60)))
                 for _ in range(rng.randrange(0, 6))]
        rows.append((rng.randrange(300), " | ".join(parts)))
    long = " ".join(str(rng.random()) for _ in range(8000))
    rows += [(7, "y" * 5000), (8, "y" * 300), (9, "y" * 49), (10, None), (11, ""), (None, passages[0] * 2), (None, "y" * 90), (12, long),
             (400, "new " + long[1000:90_000] + " end"), (400, "new " + long[1000:90_000] + " end"), (13, "é" * 60), (14, "x" + "é" * 60)]
    return rows + [(500 + k, rows[3][1] or passages[0]) for k in range(40)]


@pytest.mark.parametrize("block", [3000, 1 << 22])
def test_query_equals_sets_of_strings(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(suffixes, "BLOCK", block)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 20_000)
    monkeypatch.setattr(suffixes, "BUCKET_ANCHORS", 500)
    frame = spark.createDataFrame(table(), KINDS).withColumn("kept", F.lit("mine")).withColumn("n_bytes", F.lit("mine"))
    frame.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_suffix_dedup"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=str) == brute(table())


def test_spans_cut_the_text(spark):
    rows = spark.createDataFrame(table(2), KINDS)
    for r in suffixes.deduplicated(rows).collect():
        assert r.n_bytes - len(r.kept) == r.n_removed == sum(s.end - s.start for s in r.spans)
        assert all(s.end - s.start >= 50 for s in r.spans)
