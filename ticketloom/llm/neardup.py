"""Near-duplicates by BagMinHash signatures of word-shingle multisets.

The similarity of two texts is the weighted Jaccard measure of their multisets of five-word shingles: the sum of the
smaller counts over the sum of the larger ones. For every shingle, Poisson processes of points run over the dyadic bands
(0,1], (1,2], (2,4], ... of its count; a band is split in halves when a point comes up in it, down to unit intervals,
and halves above the count are left out. So two texts see the same points wherever both counts reach. Every point falls
on one signature component, which keeps the earliest; two signatures agree at a component with the probability of the
similarity.

Bands of the signature give candidates, whole texts are compared, and groups are the connected components of the links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.llm.blocks import BLOCK_BYTES, GOLDEN, Words, blocks, keep_columns, mix, utf8
from ticketloom.operators.graphs import components
from ticketloom.runtime import cut

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 32
ROWS = 6
#: Members of a bucket that the others may meet, round by round; pairs that no round settles are all formed after them.
HUBS = (1, 8)
#: Components of the finer signatures that rule pairs out, one bit each (two texts differ in half of those that disagree),
#: and how far below the threshold a pair must seem: four standard deviations.
FINE = 2048
MARGIN = 0.055
#: Bits of the filter that spares the move of texts without a candidate; its size does not depend on the data.
FILTER_BITS = 1 << 24  # three bytes


def shingles(texts: pa.Array, width: int = SHINGLE) -> tuple[Words, np.ndarray, np.ndarray]:
    """Text and hash of every shingle; a text of fewer words, but not none, is one shingle."""
    words = Words(*utf8(texts))
    at, hashes = words.windows(width)
    owner = words.text[at]
    small = np.flatnonzero((words.counts > 0) & (words.counts < width))
    extra = np.zeros(len(small), np.uint64)
    for k in range(width):
        here = words.counts[small] > k
        extra[here] = mix(extra[here] + words.hashes[words.bounds[small[here]] + k])
    return words, np.concatenate([owner, small]), np.concatenate([hashes, extra])


def _uniform(state: np.ndarray, draw: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """The given draw of each random stream: its bits, and a value in (0, 1]."""
    bits = mix(state + np.asarray(draw, np.uint64) * GOLDEN)
    return bits, ((bits >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def signatures(text: np.ndarray, shingle: np.ndarray, count: np.ndarray, texts: int, size: int) -> np.ndarray:
    """BagMinHash signatures (``texts`` x ``size``) of multisets given as (text, shingle, count); empty ones are zeros.

    All texts advance together. Points later than a time that fills nearly every signature are not made; a text with an
    empty component left is done again with twice that time, which changes no component that was filled.
    """
    out = np.zeros((texts, size), np.uint64)
    weight = np.bincount(text, count, texts)
    limit = (np.log(size) + 4.0) / np.maximum(weight, 1)
    open_ = weight > 0
    while open_.any():
        mine = open_[text]
        found, full = _signed(text[mine], shingle[mine], count[mine], texts, size, limit)
        done = open_ & full
        out[done] = found[done]
        open_ &= ~full
        limit *= 2
    return out


def _signed(text, shingle, count, texts, size, limit):
    best = np.full(texts * size, np.inf)
    times, places, marks = [], [], []

    def node(parent: np.ndarray, low: np.ndarray, span: np.ndarray) -> np.ndarray:
        return mix(parent ^ (low * np.uint64(2) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93) ^ (span << np.uint64(40)))

    one = np.ones(len(text), np.uint64)
    rows, low, span = [np.arange(len(text))], [one * np.uint64(0)], [one]
    edge = 1
    while len(rows[-1]) and (above := rows[-1][count[rows[-1]] > edge]).size:
        rows.append(above)
        low.append(np.full(len(above), edge, np.uint64))
        span.append(np.full(len(above), edge, np.uint64))
        edge *= 2
    row, low, span = np.concatenate(rows), np.concatenate(low), np.concatenate(span)
    state = node(shingle[row], low, span)
    draw = np.ones(len(row), np.uint64)
    _, u = _uniform(state, 0)
    time = -np.log(u) / (size * span.astype(np.float64))
    while True:
        live = time <= limit[text[row]]
        if not live.all():
            row, low, span, state, draw, time = (x[live] for x in (row, low, span, state, draw, time))
        if not len(row):
            break
        unit = span == 1
        bits, _ = _uniform(state, draw)
        place = text[row[unit]] * size + ((bits[unit] >> np.uint64(20)) % np.uint64(size)).astype(np.int64)
        np.minimum.at(best, place, time[unit])
        times.append(time[unit])
        places.append(place)
        marks.append(bits[unit])
        _, u = _uniform(state, draw + np.uint64(1))
        wait = -np.log(u) / size
        split = ~unit
        if not split.any():
            time, draw = time + wait, draw + np.uint64(2)
            continue
        # the point of a wide interval belongs to one half; the other half's first point comes later
        half, left, owner = span[split] // np.uint64(2), low[split], row[split]
        right = left + half
        to_right = (bits[split] >> np.uint64(63)).astype(bool)
        later = time[split] + wait[split] / half.astype(np.float64)
        reach = count[owner] > right.astype(np.int64)
        kid_row = np.concatenate([owner, owner[reach]])
        kid_low = np.concatenate([left, right[reach]])
        kid_span = np.concatenate([half, half[reach]])
        kid_time = np.concatenate([np.where(to_right, later, time[split]), np.where(to_right, time[split], later)[reach]])
        row = np.concatenate([row[unit], kid_row])
        low = np.concatenate([low[unit], kid_low])
        span = np.concatenate([span[unit], kid_span])
        state = np.concatenate([state[unit], node(shingle[kid_row], kid_low, kid_span)])
        draw = np.concatenate([draw[unit] + np.uint64(2), np.ones(len(kid_row), np.uint64)])
        time = np.concatenate([time[unit] + wait[unit], kid_time])
    found = np.zeros(texts * size, np.uint64)
    for time, place, mark in zip(times, places, marks):
        first = time == best[place]
        found[place[first]] = mark[first] | np.uint64(1)
    return found.reshape(texts, size), np.isfinite(best).reshape(texts, size).all(1)


def multisets(texts: pa.Array, width: int = SHINGLE) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text with their counts: words of the block, text, shingle, count."""
    words, owner, hashes = shingles(texts, width)
    key = mix(hashes + owner.astype(np.uint64) * GOLDEN)
    _, first, count = np.unique(key, return_index=True, return_counts=True)
    return words, owner[first], hashes[first], count


def sketch(df: DataFrame, text: str, columns: Sequence[str], width: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``columns`` with ``key`` (128-bit digest of the word sequence, null if none), ``weight`` and ``bands``."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*columns).schema)
    size = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = np.arange(bands, dtype=np.uint64) * GOLDEN
        for batch in blocks(batches, "__text", BLOCK_BYTES // 2):
            words, owner, shingle, count = multisets(batch.column("__text"), width)
            full = words.counts > 0
            sig = signatures(owner, shingle, count, words.texts, size)
            band = np.zeros((words.texts, bands), np.uint64) + salt
            for k in range(rows):
                band = mix(band ^ sig[:, k::rows])
            digests = _digests(words)
            offsets = np.append(0, np.cumsum(full))
            lists = pa.ListArray.from_arrays(pa.array(offsets * bands, pa.int32()), pa.array(band[full].view(np.int64).reshape(-1)))
            yield keep_columns(
                batch, columns, key=pa.array(digests, pa.binary()),
                weight=pa.array(np.bincount(owner, count, words.texts).astype(np.int64)), bands=lists,
            )

    schema = "key binary, weight long, bands array<long>"
    return df.select(*columns, F.col(text).alias("__text")).mapInArrow(run, ", ".join([x for x in (kinds, schema) if x]))


def _bits(texts: DataFrame, width: int) -> DataFrame:
    """``key`` and ``bits``: one bit of every component of a finer signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text", BLOCK_BYTES // 8):  # a text has ten times as many points as in the sketch
            words, owner, shingle, count = multisets(batch.column("text"), width)
            sig = signatures(owner, shingle, count, words.texts, FINE)
            packed = np.packbits((sig >> np.uint64(3) & np.uint64(1)).astype(np.uint8), axis=1).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(words.texts + 1) * (FINE // 64), pa.int32()), pa.array(packed.reshape(-1)))
            yield keep_columns(batch, ["key"], bits=lists)

    return texts.select("key", "text").mapInArrow(run, "key binary, bits array<long>")


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two multisets given as sorted distinct shingles with counts."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    return float(both / (a[1].sum() + b[1].sum() - both)) if len(a[0]) or len(b[0]) else 1.0


def verified(pairs: DataFrame, texts: DataFrame, threshold: float = SIMILARITY, width: int = SHINGLE) -> DataFrame:
    """Those pairs (``a``, ``b``, keys of ``texts``) whose whole texts are at least as similar as ``threshold``."""
    left = texts.select(F.col("key").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("key").alias("b"), F.col("text").alias("right"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sets(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
            column = column.dictionary_encode()
            words, owner, shingle, count = multisets(column.dictionary, width)
            order = np.lexsort((shingle, owner))
            shingle, count = shingle[order], count[order]
            ends = np.searchsorted(owner[order], np.arange(words.texts + 1))
            parts = [(shingle[a:b], count[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            return [parts[k] for k in column.indices.to_pylist()]

        for batch in batches:
            for block in blocks([batch], "right"):
                for part in blocks([block], "left"):
                    pairs_ = zip(sets(part.column("left")), sets(part.column("right")))
                    value = np.array([similarity(x, y) for x, y in pairs_])
                    yield keep_columns(part, ["a", "b"], similarity=pa.array(value)).filter(pa.array(value >= threshold))

    return both.select("a", "b", "left", "right").mapInArrow(run, "a binary, b binary, similarity double")


def _labelled(keys: DataFrame, links: DataFrame) -> DataFrame:
    """``key, component`` of all keys."""
    found = components(links.select("a", "b"), [], "a", "b").select(F.col("node").alias("key"), "component")
    return keys.join(found, "key", "left").withColumn("component", F.coalesce("component", "key"))


@dataclass(frozen=True)
class Groups:
    """``rows``: doc_id and key of every row; ``nodes``: key, smallest id (least), component and number of links."""

    rows: DataFrame
    nodes: DataFrame


def find_groups(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = SIMILARITY,
    width: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
    partners: int = 4,
) -> Groups:
    """Groups of texts with links of at least ``threshold`` between them.

    Texts with the same words are one node. Two nodes are candidates if a band of their signatures agrees (at a
    similarity of 0.8 one pair in 17,000 is missed). In a few rounds every node meets some partners: the members of its
    buckets that most others meet, of these the ones it shares most buckets with, as long as they belong to another
    component. Then the texts in buckets whose members are still in several components get finer signatures, and such a
    bucket yields its pairs across components that these don't rule out (``MARGIN`` below the threshold); pairs within a
    component can't change a group and are never formed. So the number of links counts those that were looked at, at
    least one for every text that joined a group.
    """
    source = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sketched = cut(sketch(source, "text", ["doc_id"], width, bands, rows))
    named = sketched.where("key IS NOT NULL")
    nodes = cut(
        named.groupBy("key").agg(
            F.min("weight").alias("weight"), F.first("bands").alias("bands"), F.min("doc_id").alias("least"),
        )
    )
    slots = nodes.select("key", F.explode("bands").alias("band"))
    sizes = slots.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    shared = cut(slots.join(sizes, "band"))
    central = shared.groupBy("key").agg(F.sum("n").alias("met"))
    members = cut(shared.join(central, "key").select("band", "key", "met"))
    wanted = cut(central.select("key"))
    texts = cut(_texts(source, wanted))
    labels = wanted.withColumn("component", F.col("key"))
    links = tried = None
    for hubs in HUBS:
        # of every bucket that several components share, each member may meet the members that most others meet
        mixed = members.join(labels, "key")
        open_ = mixed.groupBy("band").agg(F.min("component").alias("c"), F.max("component").alias("d")).where("c <> d").select("band")
        mixed = cut(mixed.join(open_, "band"))
        order = Window.partitionBy("band").orderBy(F.desc("met"), "key")
        top = mixed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= hubs)
        top = top.select("band", F.col("key").alias("hub"), F.col("component").alias("hub_component"))
        met = mixed.join(top, "band").where("component <> hub_component").groupBy("key", "hub").agg(F.count("*").alias("n"))
        if tried is not None:
            both = tried.select(F.col("a").alias("key"), F.col("b").alias("hub"))
            met = met.join(both.unionByName(both.select(F.col("hub").alias("key"), F.col("key").alias("hub"))), ["key", "hub"], "left_anti")
        best = met.groupBy("key").agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "hub")), False), 1, partners).alias("best"))
        pairs = cut(best.select("key", F.explode("best").alias("p")).select(
            F.least("key", "p.hub").alias("a"), F.greatest("key", "p.hub").alias("b")).distinct())
        found = verified(pairs, texts, threshold, width)
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = cut(found if links is None else links.unionByName(found))
        labels = cut(_labelled(wanted, links))
    mixed = members.join(labels, "key")
    open_ = mixed.groupBy("band").agg(F.min("component").alias("c"), F.max("component").alias("d")).where("c <> d").select("band")
    rest = cut(mixed.join(open_, "band").select("band", "key", "component"))
    fine = cut(_bits(texts.join(rest.select("key").distinct(), "key", "left_semi"), width))
    rest = rest.join(nodes.select("key", "weight", "bands"), "key").join(fine, "key")
    other = rest.select(*(F.col(c).alias(f"{c}_2") for c in rest.columns))
    first_common = F.filter(F.zip_with("bands", "bands_2", lambda p, q: F.when(p == q, p)), lambda v: v.isNotNull())[0]
    apart = F.aggregate(F.zip_with("bits", "bits_2", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, v: s + v)
    across = rest.join(
        other,
        (F.col("band") == F.col("band_2")) & (F.col("key") < F.col("key_2")) & (F.col("component") != F.col("component_2"))
        & (F.col("weight") >= threshold * F.col("weight_2")) & (F.col("weight_2") >= threshold * F.col("weight"))
        & (first_common == F.col("band")) & (apart <= int(FINE * (1 - threshold + MARGIN) / 2)),
    ).select(F.col("key").alias("a"), F.col("key_2").alias("b"))
    more = verified(across.join(tried, ["a", "b"], "left_anti"), texts, threshold, width)
    links = cut(links.unionByName(more))
    degree = links.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key").agg(F.count("*").alias("n_links"))
    placed = (
        nodes.select("key", "least").join(_labelled(wanted, links), "key", "left").join(degree, "key", "left")
        .select("key", "least", F.coalesce("component", "key").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
    return Groups(sketched.select("doc_id", "key"), cut(placed))


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **parameters) -> DataFrame:
    """``doc_id, class_id, n_links`` for every row: the smallest id of its group, and the links found at its text.

    A row with a null text, or a text without words, is a group of its own, under its own id. Rows with the same words
    are one group whatever their ids; other columns are not looked at. An empty table gives an empty result.
    ``parameters`` are those of ``find_groups``.
    """
    groups = find_groups(df, doc_id, text, **parameters)
    classes = groups.nodes.groupBy("component").agg(F.min("least").alias("class_id"))
    named = groups.nodes.join(classes, "component").select("key", "class_id", "n_links")
    out = groups.rows.join(named, "key", "left")
    own = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return out.select("doc_id", own.alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def deduplicated(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **parameters) -> DataFrame:
    """One row of each group, that with the smallest id (a null id comes last), with all its columns.

    Rows without words are all kept. Equal rows of a task are put together before they move, so many copies of a text
    don't meet in one place.
    """
    nodes = find_groups(df, doc_id, text, **parameters).nodes
    first = nodes.groupBy("component").agg(F.min(F.struct(F.col("least").isNull(), "least", "key")).alias("r")).select("r.key")
    row = F.struct(F.col(doc_id).isNull().alias("__last"), F.col(doc_id).alias("__id"), *(F.col(c).alias(f"__{k}") for k, c in enumerate(df.columns)))
    keyed = _keyed(df, text)
    one = keyed.where("__key IS NOT NULL").groupBy("__key").agg(F.min(row).alias("r")).join(first.withColumnRenamed("key", "__key"), "__key", "left_semi")
    one = one.select(*(F.col(f"r.__{k}").alias(c) for k, c in enumerate(df.columns)))
    return one.unionByName(keyed.where("__key IS NULL").select(df.columns))


def _keyed(df: DataFrame, text: str) -> DataFrame:
    """All columns, with the digest of the word sequence as ``__key``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text):
            yield keep_columns(batch, df_columns, __key=pa.array(_digests(Words(*utf8(batch.column(text)))), pa.binary()))

    df_columns = df.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{kinds}, __key binary")


def _digests(words: Words) -> list[bytes | None]:
    """Digest of each text's word sequence; none for a text without words."""
    bounds = words.bounds.tolist()
    return [
        hashlib.blake2b(words.hashes[a:b].tobytes(), digest_size=16).digest() if b > a else None
        for a, b in zip(bounds[:-1], bounds[1:])
    ]


def _filter(wanted: DataFrame) -> np.ndarray:
    """Bit map over the first three bytes of the wanted keys, two megabytes whatever their number."""
    slot = F.conv(F.hex(F.substring("key", 1, 3)), 16, 10).cast("long") + 1
    parts = wanted.groupBy(F.bitmap_bucket_number(slot).alias("n")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    out = np.zeros((FILTER_BITS >> 15, 1 << 12), np.uint8)
    for r in parts.collect():
        out[r["n"] - 1] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(-1)


def _texts(source: DataFrame, wanted: DataFrame) -> DataFrame:
    """One text for each wanted key.

    A task sends each key once, so many copies of a text don't meet in one place. Most texts whose key isn't wanted are
    held back by a filter of fixed size; the join then leaves out the rest.
    """
    shared = source.sparkSession.sparkContext.broadcast(_filter(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes | None] = {None}
        bits = shared.value
        for batch in blocks(batches, "text"):
            new = []
            digests = _digests(Words(*utf8(batch.column("text"))))
            for d in digests:
                slot = int.from_bytes(d[:3], "big") if d else 0
                new.append(d not in sent and bool(bits[slot >> 3] >> (slot & 7) & 1))
                if new[-1]:
                    sent.add(d)
            yield keep_columns(batch, ["text"], key=pa.array(digests, pa.binary())).filter(pa.array(new))

    keyed = source.select("text").mapInArrow(run, "text string, key binary")
    return keyed.join(wanted, "key").groupBy("key").agg(F.first("text").alias("text"))
