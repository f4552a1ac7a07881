"""Ranked lexical search by the Best Position Algorithm over impact lists.

Documents are indexed once per part of the items: their lengths, and how often each term of the items occurs in them.
The index is searched in blocks of documents. In a block every term has an impact list (documents by falling impact);
an item reads its lists in parallel, looks each new document up directly in all of them, and remembers which positions
of each list have been seen either way. The documents that are left lie behind the contiguous seen positions of every
list, so the impacts there add up to a bound for all of them; the block ends when that bound is strictly below the
k-th score found so far. A task carries its k best documents of each item from block to block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.llm.blocks import Words, blocks, byte_table, utf8
from ticketloom.runtime import cut

TERM = byte_table(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)
#: Text of the items whose terms are broadcast together; more items are searched in several passes.
ITEM_BYTES = 4 << 20
#: Index entries in a block of a search task.
POSTINGS = 1 << 20
FIRST_STEP = 64
TOTALS = -1


def terms_of(column: pa.Array) -> Words:
    raw, offsets = utf8(column)
    return Words(LOWER[raw], offsets, TERM)


def weight(documents: int, df: int) -> int:
    """Weight of a term that ``df`` of the documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def item_parts(items: DataFrame, item: str, text: str, part_bytes: int) -> Iterator[list[tuple]]:
    """Items with a text in lists of at most ``part_bytes`` (a longer one alone); only one list is held at a time."""
    part, size = [], 0
    for row in items.where(F.length(text) > 0).select(item, text).toLocalIterator():
        n = len(row[1].encode("utf-8", "replace"))
        if part and size + n > part_bytes:
            yield part
            part, size = [], 0
        part.append((row[0], row[1]))
        size += n
    if part:
        yield part


def indexed(documents: DataFrame, doc: str, text: str, vocabulary) -> DataFrame:
    """``doc_id, n, terms, tfs`` of every document with a term; ``terms`` are places in the sorted vocabulary of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in blocks(batches, "text"):
            words = terms_of(batch.column("text"))
            at = np.minimum(np.searchsorted(known, words.hashes), len(known) - 1)
            hit = known[at] == words.hashes
            keys, tfs = np.unique(words.text[hit].astype(np.int64) * len(known) + at[hit], return_counts=True)
            ends = np.searchsorted(keys, np.arange(1, words.texts + 1) * len(known))
            offsets = pa.array(np.r_[0, ends].astype(np.int32))
            table = pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(words.counts.astype(np.int64)),
                    pa.ListArray.from_arrays(offsets, pa.array((keys % len(known)).astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(tfs.astype(np.int64))),
                ],
                names=["doc_id", "n", "terms", "tfs"],
            )
            yield table.filter(pa.array(words.counts > 0))

    rows = documents.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


def statistics(index: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents, their terms with repeats, and the documents that hold each of ``size`` terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total, held = 0, 0, np.zeros(size, np.int64)
        for batch in batches:
            rows += batch.num_rows
            total += int(batch.column("n").to_numpy().sum())
            held += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[TOTALS, used]), pa.array(np.r_[rows, held[used]]), pa.array(np.r_[total, held[used] * 0])],
            names=["term", "n", "total"],
        )

    counted = index.select("n", "terms").mapInArrow(run, "term long, n long, total long").groupBy("term")
    held, rows, total = np.zeros(size, np.int64), 0, 0
    for r in counted.agg(F.sum("n").alias("n"), F.sum("total").alias("total")).toLocalIterator():  # a row per item term
        if r.term == TOTALS:
            rows, total = r.n, r.total
        else:
            held[r.term] = r.n
    return rows, total, held


class ImpactLists:
    """The impact lists of one block of documents, readable in order and by (term, document)."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, size: int, docs: int) -> None:
        """Entries come by document, then term."""
        by_doc = np.argsort(term, kind="stable")
        sorted_term = term[by_doc]
        self.docs, self.starts = docs, np.searchsorted(sorted_term, np.arange(size + 1))
        self.keys, self.key_impact = sorted_term.astype(np.int64) * docs + doc[by_doc], impact[by_doc]
        order = np.lexsort((-self.key_impact, sorted_term))
        self.doc, self.impact = doc[by_doc][order], self.key_impact[order]
        self.key_place = np.empty(len(order), np.int64)
        self.key_place[order] = np.arange(len(order)) - self.starts[sorted_term[order]]

    def search(self, lists: np.ndarray, best: "Best") -> int:
        """Offer ``best`` every document of the block that may belong to it; returns how many were looked up."""
        lists = lists[self.starts[lists + 1] > self.starts[lists]]
        starts, lengths = self.starts[lists], self.starts[lists + 1] - self.starts[lists]
        seen_at = np.r_[0, np.cumsum(lengths + 1)]  # a place past the end of each list stays unseen
        seen = np.zeros(seen_at[-1], bool)
        done = np.zeros(self.docs, bool)
        front = np.zeros(len(lists), np.int64)
        depth, step, looked = 0, FIRST_STEP, 0
        while len(lists):
            impacts = np.where(front < lengths, self.impact[np.minimum(starts + front, starts + lengths - 1)], 0)
            bound = int(impacts.sum())
            if bound <= 0 or bound < best.floor():
                break
            docs = np.unique(np.concatenate([
                self.doc[s + depth : s + min(depth + step, n)] for s, n in zip(starts.tolist(), lengths.tolist()) if n > depth
            ]))
            docs = docs[~done[docs]]
            done[docs] = True
            looked += len(docs)
            keys = (lists[:, None] * self.docs + docs[None, :]).ravel()
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = np.flatnonzero(self.keys[at] == keys)
            at, which = at[hit], hit // max(1, len(docs))
            seen[seen_at[which] + self.key_place[at]] = True
            scores = np.zeros(len(docs), np.int64)
            np.add.at(scores, hit % max(1, len(docs)), self.key_impact[at])
            best.offer(scores, docs)
            depth, step = depth + step, step * 2
            for k, (a, b) in enumerate(zip(seen_at[:-1].tolist(), seen_at[1:].tolist())):
                front[k] += np.argmin(seen[a + front[k] : b])
        return looked


class Best:
    """The ``k`` best (score, document) of one item; equal scores by ascending document, nulls last."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.scores, self.ids, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def floor(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else 0

    def block(self, ids: np.ndarray, null: np.ndarray) -> "Best":
        """Offers that follow are places among these documents."""
        self.block_ids, self.block_null = ids, null
        return self

    def offer(self, scores: np.ndarray, docs: np.ndarray) -> None:
        good = np.flatnonzero((scores > 0) & (scores >= self.floor()))
        if not len(good):
            return
        scores = np.r_[self.scores, scores[good]]
        ids, null = np.r_[self.ids, self.block_ids[docs[good]]], np.r_[self.null, self.block_null[docs[good]]]
        order = np.lexsort((ids, null, -scores))[: self.k]
        self.scores, self.ids, self.null = scores[order], ids[order], null[order]


def index_blocks(batches: Iterator[pa.RecordBatch], postings: int) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            piece = batch.slice(start, 256)
            held.append(piece)
            size += len(piece.column("terms").flatten())
            if size >= postings:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def best_of_part(index: DataFrame, terms: list[np.ndarray], size: int, k: int, postings: int) -> DataFrame:
    """``item`` (place in ``terms``), ``doc_id``, ``score``: the best ``k`` of each task."""
    documents, total, held = statistics(index, size)
    weights = np.array([weight(documents, int(n)) if n else 0 for n in held], np.int64)
    wanted = [t[weights[t] > 0] for t in terms]
    shared = index.sparkSession.sparkContext.broadcast((weights, wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, wanted = shared.value
        best = [Best(k) for _ in wanted]
        for table in index_blocks(batches, postings):
            table = table.combine_chunks()
            ids, null = table.column("doc_id").fill_null(0).to_numpy(), table.column("doc_id").is_null().to_numpy()
            n = table.column("n").to_numpy()
            lists = table.column("terms").combine_chunks()
            doc = np.repeat(np.arange(len(n)), lists.value_lengths().to_numpy())
            term = lists.flatten().to_numpy().astype(np.int64)
            tf = table.column("tfs").combine_chunks().flatten().to_numpy()
            m = 10 + 90 * n * documents // total
            impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
            found = ImpactLists(term, doc, impact, len(weights), len(n))
            for item, own in enumerate(wanted):
                found.search(own, best[item].block(ids, null))
        for item, b in enumerate(best):
            if len(b.scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(b.scores), pa.int64()), pa.array(b.ids, pa.int64(), mask=b.null), pa.array(b.scores)],
                    names=["item", "doc_id", "score"],
                )

    return index.mapInArrow(run, "item long, doc_id long, score long")


def search(
    documents: DataFrame,
    items: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    k: int = 10,
    part_bytes: int = ITEM_BYTES,
    postings: int = POSTINGS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents with the highest scores above 0 for every item.

    Document ids are integers. Equal scores rank by ascending id, a null id after all others. Null and empty texts have
    no terms: such documents are never found and not counted, such items have no rows. A repeated document ranks once
    for each row; a repeated item has its rows once for each of its rows. Other columns of either table are ignored, so
    their names cannot clash. Terms are compared by 64-bit hashes. Without documents or items the result is empty.
    """
    spark = documents.sparkSession
    kind = items.schema[item].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for part in item_parts(items, item, item_text, part_bytes):
        words = terms_of(pa.array([t for _, t in part], pa.string()))
        vocabulary = np.unique(words.hashes)
        if not len(vocabulary):
            continue
        index = cut(indexed(documents, doc, text, spark.sparkContext.broadcast(vocabulary)))
        terms = [np.unique(np.searchsorted(vocabulary, words.hashes[a:b])) for a, b in zip(words.bounds[:-1], words.bounds[1:])]
        rows = best_of_part(index, terms, len(vocabulary), k, postings)
        names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(part)], f"item long, item_id {kind}")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        out = out.unionByName(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return out
