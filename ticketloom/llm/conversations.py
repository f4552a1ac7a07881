"""Conversation repair: the cheapest edits that turn a conversation into ``(s?(ua)+)?``, by rank-convergent Viterbi.

A conversation becomes chunks of row codes in order; a long one, or one that lies across two partitions, has several.
Costs run backwards. Every chunk starts from a speculative vector of costs to the end (one for each state of the
pattern); fix-up passes hand the vector before a chunk to the chunk in front of it, which reruns until its vector
differs from the one it had only by a constant. What is then left of the differences is added up along the chunks. The
edits are traced forwards from these costs, the least letter first wherever several edits are cheapest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.runtime import cut

CHUNK = 1 << 16
KEEP, REROLE, DELETE, INSERT, TRUNCATED_LEFT = 0, 3, 4, 3, 3
SPACE = " \t\n\x0b\x0c\r"
#: Faults of a row, in the order in which the first one counts.
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
#: States: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua"
LEGAL = {(0, 1), (1, 2), (2, 1)}
#: Costs to the end behind the last row, and the inserts that they stand for.
END = (0, 2 * INSERT, INSERT, 0)
END_EDITS = ("", "II", "I", "")
ROW_KEYS = ["_turn", "_role", "_digest"]


@lru_cache(maxsize=1 << 14)
def step(after: tuple[int, ...], code: int) -> tuple[tuple[int, ...], int, tuple[tuple[str, int], ...]]:
    """One row backwards: costs before it (less the first one), that first one, and the edits and next state by state."""
    initial, fault = divmod(code, 4)
    left = TRUNCATED_LEFT if fault == TRUNCATED else 0
    ways: list[dict[str, tuple[int, int]]] = []
    for state in range(4):
        ways.append({"D": (DELETE + after[state], state)})
        if fault in (BLANK, DUPLICATE):
            continue
        ways[state]["R"] = (REROLE + left + after[NEXT[state]], NEXT[state])
        kept = SYSTEM if state == START and initial == 0 else NEXT[state] if initial == NEXT[state] - 1 else None
        if kept is not None:
            ways[state]["K"] = (KEEP + left + after[kept], kept)
    costs = [min(c for c, _ in w.values()) for w in ways]
    for _ in range(2):  # inserts in front of the row; more than two never pay
        costs = [min(c, INSERT + costs[NEXT[s]]) for s, c in enumerate(costs)]
    for s in range(4):
        ways[s]["I"] = (INSERT + costs[NEXT[s]], NEXT[s])

    def edits(state: int) -> tuple[str, int]:
        letter = min(k for k, (c, _) in ways[state].items() if c == costs[state])
        if letter != "I":
            return letter, ways[state][letter][1]
        rest, end = edits(NEXT[state])
        return letter + rest, end

    return tuple(c - costs[0] for c in costs), costs[0], tuple(edits(s) for s in range(4))


def backward(codes: bytes, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs before the first row of a chunk."""
    base, after = after[0], tuple(c - after[0] for c in after)
    for code in reversed(codes):
        after, more, _ = step(after, code)
        base += more
    return tuple(base + c for c in after)


def rerun(codes: bytes, old: tuple[int, ...], before: tuple[int, ...], new: tuple[int, ...]) -> tuple[int, ...]:
    """``backward(codes, new)``, given ``before = backward(codes, old)``: stops where both runs differ by a constant."""
    base, shift = new[0], old[0]
    old, new = tuple(c - old[0] for c in old), tuple(c - new[0] for c in new)
    for code in reversed(codes):
        if old == new:
            return tuple(c + base - shift for c in before)
        old, more, _ = step(old, code)
        shift += more
        new, more, _ = step(new, code)
        base += more
    return tuple(base + c for c in new)


def trace(codes: bytes, after: tuple[int, ...], entry: int | None = None) -> tuple[list[int], str]:
    """Exit state for every entry state of a chunk, and the edits from ``entry``."""
    after, made = tuple(c - after[0] for c in after), []
    for code in reversed(codes):
        after, _, ways = step(after, code)
        made.append(ways)
    exits, letters = list(range(4)), []
    if entry is None:
        for ways in reversed(made):
            exits = [ways[s][1] for s in exits]
        return exits, ""
    for ways in reversed(made):
        edit, entry = ways[entry]
        letters.append(edit)
    return [entry], "".join(letters)


def counts(codes: bytes) -> dict[str, int]:
    """Faulty rows by their first fault, and neighbours with roles that may not follow each other."""
    faults = [0] * 4
    for c in codes:
        faults[c & 3] += 1
    illegal = sum((a >> 2, b >> 2) not in LEGAL for a, b in zip(codes, codes[1:]))
    return {"blank": faults[BLANK], "duplicate": faults[DUPLICATE], "truncated": faults[TRUNCATED], "illegal": illegal}


def prepared(df: DataFrame, conv: str, turn: str, role: str, text: str, copies: str | None) -> DataFrame:
    """Rows under internal names with nulls filled; ``_copies`` says how often a row stands there."""
    said = F.coalesce(F.col(text), F.lit(" "))
    return df.select(
        F.col(conv).alias("_conv"), F.col(turn).cast("long").alias("_turn"), F.coalesce(F.col(role), F.lit(" ")).alias("_role"),
        said.alias("_text"), F.sha2(said.cast("binary"), 256).alias("_digest"),
        (F.col(copies).cast("long") if copies else F.lit(1).cast("long")).alias("_copies"),
    )


def _code(earlier: Column) -> Column:
    initial = F.substring("_role", 1, 1)
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = (
        F.when(F.col("_end") == "", BLANK).when(earlier, DUPLICATE)
        .when(~F.col("_end").isin(".", "!", "?"), TRUNCATED).otherwise(FINE)
    )
    return place * 4 + fault


def coded(rows: DataFrame) -> DataFrame:
    """A row per distinct row of a conversation, with the code of its first copy; texts stay behind."""
    end = F.right(F.rtrim("_text", F.lit(SPACE)), F.lit(1))
    kinds = (
        rows.select("_conv", *ROW_KEYS, "_copies", end.alias("_end"))
        .groupBy("_conv", *ROW_KEYS, "_end").agg(F.sum("_copies").alias("_copies"))
    )
    when = F.struct(F.col("_turn").isNotNull(), F.col("_turn"))
    first = kinds.groupBy(F.col("_conv").alias("_c"), F.col("_role").alias("_r"), F.col("_digest").alias("_d")).agg(
        F.min(when).alias("_first")
    )
    same = F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_role") == F.col("_r")) & (F.col("_digest") == F.col("_d"))
    return kinds.join(first, same).select("_conv", *ROW_KEYS, "_copies", _code(F.col("_first") < when).alias("_code"))


def chunks(rows: DataFrame, limit: int = CHUNK) -> DataFrame:
    """``_conv, _seq, _codes, _whole``: row codes in order; ``_whole`` marks chunks that surely hold all of a conversation.

    Rows are sorted over all partitions, so a conversation with a third of all rows is many chunks in many tasks.
    """
    sorted_rows = coded(rows).repartitionByRange("_conv", *ROW_KEYS).sortWithinPartitions("_conv", *ROW_KEYS)
    sorted_rows = sorted_rows.select("_conv", "_code", "_copies", F.spark_partition_id().cast("long").alias("_part"))
    kind = rows.schema["_conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        state = {"conv": None, "codes": bytearray(), "seq": 0, "pieces": 0, "first": True, "open": False}

        def close(last: bool, split: bool) -> None:
            """A conversation at either end of a partition may go on in the next one."""
            whole = not (state["first"] or last or split or state["pieces"])
            out.append((state["conv"], (state["part"] << 32) + state["seq"], bytes(state["codes"]), whole))
            state["seq"] += 1
            state["pieces"] += split
            state["codes"] = bytearray()

        def end(last: bool) -> None:
            if state["codes"]:
                close(last, False)
            state.update(pieces=0, first=False)

        def table() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], kind_of[0]), pa.array([r[1] for r in out], pa.int64()),
                 pa.array([r[2] for r in out], pa.binary()), pa.array([r[3] for r in out], pa.bool_())],
                names=["_conv", "_seq", "_codes", "_whole"],
            )
            out.clear()
            return made

        kind_of = [pa.null()]
        for batch in batches:
            kind_of[0] = batch.schema.field("_conv").type
            for conv, code, copies, part in zip(*(batch.column(c).to_pylist() for c in ("_conv", "_code", "_copies", "_part"))):
                if not state["open"] or conv != state["conv"]:
                    if state["open"]:
                        end(False)
                    state.update(conv=conv, open=True, part=part)
                again = code if code & 3 == BLANK else code - (code & 3) + DUPLICATE
                state["codes"].append(code)
                copies -= 1
                while copies or len(state["codes"]) >= limit:
                    n = min(copies, limit - len(state["codes"]))
                    state["codes"] += bytes([again]) * n
                    copies -= n
                    if len(state["codes"]) >= limit:
                        close(False, True)
                        if len(out) >= 64:
                            yield table()
                    if not copies:
                        break
            if sum(len(r[2]) for r in out) >= limit:
                yield table()
        if state["open"]:
            end(True)
            yield table()

    return sorted_rows.mapInArrow(run, f"_conv {kind}, _seq long, _codes binary, _whole boolean")


REPORT = "blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_COUNTS = ["blank", "duplicate", "truncated", "illegal"]


def _judged(df: DataFrame, made: str, judge, *needed: str) -> DataFrame:
    """``_conv, _seq`` and what ``judge`` makes of the named columns of every chunk."""
    kind = df.schema["_conv"].dataType.simpleString()
    schema = f"_conv {kind}, _seq long, {made}"
    names = [x.split(" ")[0] for x in made.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge(*r) for r in zip(*(batch.column(c).to_pylist() for c in needed))]
            kinds = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "int": pa.int32()}
            arrays = [pa.array([r[k] for r in rows], kinds[x.split(" ")[1]]) for k, x in enumerate(made.split(", "))]
            yield pa.RecordBatch.from_arrays([batch.column("_conv"), batch.column("_seq"), *arrays], names=["_conv", "_seq", *names])

    return df.select("_conv", "_seq", *needed).mapInArrow(run, schema)


def _one(codes: bytes) -> tuple:
    """Report of a conversation of one chunk."""
    (state,), audit = trace(codes, END, START)
    return (*counts(codes).values(), backward(codes, END)[START], audit + END_EDITS[state])


def _same_chunk() -> Column:
    return F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_seq") == F.col("_s"))


def settled(parts: DataFrame) -> DataFrame:
    """Chunks with ``_after`` and ``_before``, cost vectors that fit to each other up to constants."""
    along = Window.partitionBy("_conv").orderBy("_seq")
    first = _judged(parts, "_before array<long>", lambda codes: (list(backward(codes, END)),), "_codes")
    now = cut(first.withColumn("_after", F.array(*(F.lit(c).cast("long") for c in END))))
    while True:
        seen = now.withColumn("_true", F.lead("_before").over(along))
        parallel = F.forall(F.zip_with("_true", "_after", lambda a, b: a - b), lambda d: d == F.col("_true")[0] - F.col("_after")[0])
        wrong = cut(seen.where(F.col("_true").isNotNull() & ~parallel))
        if wrong.isEmpty():
            return now
        names = wrong.select(F.col("_conv").alias("_c"), F.col("_seq").alias("_s"), "_after", "_before", "_true")
        again = _judged(
            parts.join(names, _same_chunk()), "_before array<long>, _after array<long>",
            lambda codes, old, before, new: (list(rerun(codes, tuple(old), tuple(before), tuple(new))), new),
            "_codes", "_after", "_before", "_true",
        )
        kept = now.join(names.select("_c", "_s"), _same_chunk(), "left_anti")
        now = cut(kept.unionByName(again))


def _entries(maps: DataFrame) -> DataFrame:
    """Entry state of every chunk, and the pair of roles over its front; a row per chunk streams through."""
    kind = maps.schema["_conv"].dataType.simpleString()
    rows = maps.repartition("_conv").sortWithinPartitions("_conv", "_seq")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple | None = None
        for batch in batches:
            entries, broken = [], []
            for conv, exits, first, last in zip(*(batch.column(c).to_pylist() for c in ("_conv", "_exits", "_first", "_last"))):
                new = before is None or before[0] != conv
                entry = START if new else before[1]
                entries.append(entry)
                broken.append(0 if new else int((before[2], first) not in LEGAL))
                before = (conv, exits[entry], last)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_conv"), batch.column("_seq"), pa.array(entries, pa.int32()), pa.array(broken, pa.int64())],
                names=["_conv", "_seq", "_entry", "_broken"],
            )

    return rows.mapInArrow(run, f"_conv {kind}, _seq long, _entry int, _broken long")


def stitched(parts: DataFrame) -> DataFrame:
    """Report of conversations of one or more chunks."""
    vectors = settled(parts)
    along = Window.partitionBy("_conv").orderBy("_seq")
    vectors = cut(vectors.withColumn("_true", F.lead("_before").over(along)).withColumn("_lead", F.lag("_seq").over(along)))
    names = vectors.select(F.col("_conv").alias("_c"), F.col("_seq").alias("_s"), "_after", "_before", "_true", "_lead")
    whole = parts.join(names, _same_chunk())
    maps = _judged(
        whole, "_exits array<long>, _first long, _last long",
        lambda codes, after: (trace(codes, tuple(after))[0], codes[0] >> 2, codes[-1] >> 2), "_codes", "_after",
    )
    entries = _entries(maps).select(F.col("_conv").alias("_c"), F.col("_seq").alias("_s"), "_entry", "_broken")

    def judge(codes: bytes, after: list, before: list, true: list | None, lead: int | None, entry: int, broken: int) -> tuple:
        (state,), audit = trace(codes, tuple(after), entry)
        n = counts(codes)
        n["illegal"] += broken
        cost = (before[START] if lead is None else 0) + (true[START] - after[START] if true else 0)
        return (*n.values(), cost, audit + ("" if true else END_EDITS[state]))

    pieces = _judged(
        whole.drop("_c", "_s").join(entries, _same_chunk()), REPORT, judge,
        "_codes", "_after", "_before", "_true", "_lead", "_entry", "_broken",
    )
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("_seq", "audit"))), lambda x: x["audit"])
    return pieces.groupBy("_conv").agg(*(F.sum(c).alias(c) for c in [*_COUNTS, "cost"]), F.array_join(ordered, "").alias("audit"))


def audits(rows: DataFrame, limit: int = CHUNK) -> DataFrame:
    """``_conv``, the counts of ``counts``, ``cost`` and ``audit`` of every conversation of ``prepared`` rows."""
    parts = cut(chunks(rows, limit))
    alone = _judged(parts.where("_whole"), REPORT, _one, "_codes").drop("_seq")
    return alone.unionByName(stitched(parts.where("not _whole").drop("_whole")))


def gaps(rows: DataFrame) -> DataFrame:
    """``_conv`` and the turns missing between its first and last one."""
    found = rows.groupBy("_conv").agg(F.min("_turn").alias("a"), F.max("_turn").alias("b"), F.count_distinct("_turn").alias("n"))
    return found.select("_conv", F.coalesce(F.col("b") - F.col("a") + 1 - F.col("n"), F.lit(0)).alias("gaps"))


def repaired(rows: DataFrame, report: DataFrame) -> DataFrame:
    """Rows after the edits: ``_conv, place, edit, turn, role, text``.

    The rows of a conversation follow each other in one partition, in order. Deleted rows are left out; inserted ones
    have an empty text and no turn. Rows stream past their audit, so memory does not grow with a conversation.
    """
    kind = rows.schema["_conv"].dataType.simpleString()
    told = report.select("_conv", F.lit(None).cast("long").alias("_turn"), F.lit("").alias("_role"), F.lit("").alias("_digest"),
                         F.lit("").alias("_text"), F.lit(0).cast("long").alias("_copies"), "audit")
    both = rows.withColumn("audit", F.lit(None).cast("string")).unionByName(told)
    both = both.withColumn("_body", F.col("audit").isNull())
    placed = both.repartition("_conv").sortWithinPartitions("_conv", "_body", *ROW_KEYS)
    schema = f"_conv {kind}, place long, edit string, turn long, role string, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        audit, at, state, place, conv = "", 0, START, 0, None

        def put(edit: str, turn, role: str, text: str) -> None:
            nonlocal place, state
            out.append((conv, place, edit, turn, role, text))
            place += 1

        def inserts() -> None:
            nonlocal at, state
            while audit[at : at + 1] == "I":
                state = NEXT[state]
                put("I", None, ROLES[state], "")
                at += 1

        kind_of = pa.null()
        for batch in batches:
            kind_of = batch.schema.field("_conv").type
            columns = (batch.column(c).to_pylist() for c in ("_conv", "_turn", "_role", "_text", "_copies", "audit"))
            for conv_, turn, role, text, copies, own in zip(*columns):
                if own is not None:
                    conv, audit, at, state, place = conv_, own, 0, START, 0
                    inserts()
                    continue
                for _ in range(copies):
                    letter = audit[at]
                    at += 1
                    if letter != "D":
                        state = SYSTEM if letter == "K" and state == START and role[:1] == "s" else NEXT[state]
                        put(letter, turn, role if letter == "K" else ROLES[state], text)
                    inserts()
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], kind_of), pa.array([r[1] for r in out], pa.int64()),
                 pa.array([r[2] for r in out], pa.string()), pa.array([r[3] for r in out], pa.int64()),
                 pa.array([r[4] for r in out], pa.string()), pa.array([r[5] for r in out], pa.string())],
                names=["_conv", "place", "edit", "turn", "role", "text"],
            )
            out.clear()

    return placed.mapInArrow(run, schema)


def digests(edited: DataFrame) -> DataFrame:
    """``_conv`` and the SHA-256 of its ``role:text`` lines; takes the rows as ``repaired`` leaves them."""
    kind = edited.schema["_conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, conv, kind_of, done = None, None, pa.null(), []

        def table() -> pa.RecordBatch:
            made = [pa.array([d[0] for d in done], kind_of), pa.array([d[1] for d in done], pa.string())]
            done.clear()
            return pa.RecordBatch.from_arrays(made, names=["_conv", "repaired_sha256"])

        for batch in batches:
            kind_of = batch.schema.field("_conv").type
            for own, place, role, text in zip(*(batch.column(c).to_pylist() for c in ("_conv", "place", "role", "text"))):
                if place == 0:
                    if state is not None:
                        done.append((conv, state.hexdigest()))
                    state, conv = hashlib.sha256(), own
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            if done:
                yield table()
        if state is not None:
            done.append((conv, state.hexdigest()))
            yield table()

    return edited.mapInArrow(run, f"_conv {kind}, repaired_sha256 string")


def repair(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    copies: str | None = None,
    limit: int = CHUNK,
) -> tuple[DataFrame, DataFrame]:
    """Report per conversation (``conv, gaps, blank, duplicate, truncated, illegal, cost, audit``) and the repaired rows.

    Rows stand in order of turn, nulls first; rows of one turn by role, then by the digest of their text. ``copies`` may
    say how often a row stands there. A null role or text is one space, rows without a conversation id are one
    conversation. Empty texts are blank faults, texts are read to their last character, a repeated row is a duplicate.
    Other columns are ignored, so their names cannot clash. Without rows both frames are empty.
    """
    rows = prepared(df, conv, turn, role, text, copies)
    found = cut(audits(rows, limit))
    missing = gaps(rows).select(F.col("_conv").alias("_c"), "gaps")
    report = found.join(missing, F.col("_conv").eqNullSafe(F.col("_c"))).select(
        F.col("_conv").alias(conv), "gaps", *_COUNTS, "cost", "audit"
    )
    return report, repaired(rows, found)


def damaged(df: DataFrame) -> DataFrame:
    """``conversations`` with planted faults: rows dropped, emptied, stripped of ends, doubled (``copies``), made user's."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    fate = F.crc32(key.cast("binary")) % 20
    said = F.coalesce(F.col("text"), F.lit(" "))
    return df.select("conv_id", "turn", "role", said.alias("text"), fate.alias("fate")).where("fate <> 0").select(
        "conv_id", "turn",
        F.when(F.col("fate") == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("fate") == 3, 2).otherwise(1).alias("copies"),
    )
