"""Ranked search against scoring every document, on odd tables and with blocks of a few documents."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from ticketloom.llm import lexical
from ticketloom.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    held = [(d, terms(t)) for d, t in docs]
    held = [(d, w, {x: w.count(x) for x in set(w)}) for d, w in held if w]
    n, total = len(held), sum(len(w) for _, w, _ in held)
    out = []
    for item, text in items:
        scored = []
        for d, w, tf in held:
            score, m = 0, 10 + 90 * len(w) * n // total
            for t in set(terms(text)) & set(tf):
                df = sum(t in x for *_, x in held)
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def tables(seed=3):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("", "x", "é", "7")] + ["The", "THE", "über"]
    odds = [3 ** -(k / 6) for k in range(len(words))]

    def text(n):
        return " ".join(rng.choices(words, odds, k=n)).replace(" ", rng.choice([" ", "-", "\n"]))

    docs = [(d, text(rng.randrange(1, 50))) for d in range(150)]
    docs += [(900 + k, docs[4][1]) for k in range(30)]  # a group of copies: equal scores
    docs += [(4, docs[4][1]), (None, docs[4][1]), (None, None), (950, None), (951, ""), (952, " -!"), (953, "long " + text(4000))]
    items = [(k, text(rng.randrange(1, 25))) for k in range(12)] + [(90, None), (91, ""), (92, "nothing-known"), (3, docs[4][1]), (None, "the ax")]
    return docs, items


@pytest.mark.parametrize("postings", [40, 1 << 20])
@pytest.mark.parametrize("part_bytes", [60, 1 << 20])
def test_search_equals_scoring_everything(spark, postings, part_bytes):
    docs, items = tables()
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("mine")).repartition(3)
    asked = spark.createDataFrame(items[:6] + items[-3:] if part_bytes == 60 else items, "item_id long, text string").withColumn("rank", F.lit("mine"))
    got = lexical.search(frame, asked, part_bytes=part_bytes, postings=postings)
    want = brute(docs, [tuple(r)[:2] for r in asked.select("item_id", "text").collect()])
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_blocks_end_before_their_lists_do():
    """A document that stands out ends the search early, and equal scores do not."""
    import numpy as np

    docs = 5000
    doc = np.repeat(np.arange(docs), 2)
    term = np.tile([0, 1], docs)
    impact = np.where(doc == 77, 10_000, 1 + (doc * 7919) % 100)
    lists = lexical.ImpactLists(term, doc, impact, 2, docs)
    best = lexical.Best(1).block(np.arange(docs), np.zeros(docs, bool))
    assert lists.search(np.array([0, 1]), best) < 200
    assert best.ids.tolist() == [77] and best.scores.tolist() == [20_000]
    flat = lexical.ImpactLists(term, doc, np.ones_like(doc), 2, docs)
    best = lexical.Best(3).block(np.arange(docs)[::-1], np.zeros(docs, bool))
    flat.search(np.array([0, 1]), best)
    assert best.ids.tolist() == [0, 1, 2]


def test_no_documents_or_items(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.search(empty, items).count() == 0
    assert lexical.search(empty.unionByName(spark.createDataFrame([(1, "a")], empty.schema)), items.limit(0)).count() == 0
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    assert QUERIES["op11_lexical_search"](spark, str(tmp_path)).columns == ["item_id", "rank", "doc_id", "score"]
