"""Conversation repair against a search over all edits, and the same with chunks of a few rows."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from ticketloom.llm import conversations
from ticketloom.llm.conversations import END, END_EDITS, START, backward, rerun, trace
from ticketloom.llm.queries import QUERIES

KINDS = "conv_id long, turn long, role string, text string"
SHAPE = re.compile(r"(s?(ua)+)?")


def cheapest(rows):
    """(cost, audit) by best-first search; rows are (role, text, fault)."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, roles = heapq.heappop(heap)
        if (at, roles[-1:]) in done or not any(SHAPE.fullmatch(roles + end) for end in ("", "a", "ua")):
            continue
        done.add((at, roles[-1:]))
        if at == len(rows) and SHAPE.fullmatch(roles):
            return cost, audit
        for new in "ua":
            heapq.heappush(heap, (cost + 3, audit + "I", at, roles + new))
        if at < len(rows):
            role, _, fault = rows[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, roles))
            if fault not in ("blank", "duplicate"):
                left = 3 * (fault == "truncated")
                heapq.heappush(heap, (cost + left, audit + "K", at + 1, roles + (role[:1] or "?")))
                for new in "ua":
                    heapq.heappush(heap, (cost + left + 3, audit + "R", at + 1, roles + new))
    raise AssertionError


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        printed = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not printed else "duplicate" if (role, text) in seen else "" if printed[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def applied(rows, audit):
    at, roles, out = 0, "", []
    for letter in audit:
        want = "assistant" if roles[-1:] == "u" else "user"
        if letter == "I":
            out.append((want, ""))
        else:
            role, text, _ = rows[at]
            at += 1
            if letter == "D":
                continue
            out.append((role if letter == "K" else want, text))
        roles += out[-1][0][0]
    return "\n".join(f"{a}:{b}" for a, b in out)


def brute(table):
    """The query's rows from (conv_id, turn, role, text) tuples."""
    out = []
    for conv in {r[0] for r in table}:
        rows = []
        for c, turn, role, text in table:
            if c != conv:
                continue
            name = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
            fate = zlib.crc32(name.encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            role = "user" if fate == 4 else role
            rows += [(turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        turns = {r[0] for r in rows if r[0] is not None}
        judged = faults([r[1:] for r in rows])
        cost, audit = cheapest(judged)
        initials = [r[0][:1] for r in judged]
        out.append((
            conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(sum(f == kind for *_, f in judged) for kind in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256(applied(judged, audit).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def odd_table(seed=5, conversations=60):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "u"]
    texts = ["Yes.", "No!", "why", " \n", "", None, "Ende. ", "é…", "a\tb?", "x" * 30_000 + "."]
    table = []
    for c in range(conversations):
        good = rng.random() < 0.3
        for t in range(rng.randrange(0, 8)):
            role = ("user", "assistant")[t % 2] if good else rng.choice(roles)
            turn = None if rng.random() < 0.05 else t + (rng.random() < 0.1)
            table.append((c if rng.random() < 0.97 else None, turn, role, rng.choice(texts)))
    return table + [table[0], table[0]]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    top = str(tmp_path_factory.mktemp("talks"))
    frame = spark.createDataFrame(odd_table(), KINDS)
    frame.withColumn("cost", F.lit(1)).withColumn("audit", F.lit("mine")).write.parquet(f"{top}/conversations.parquet")
    return top


def test_query_equals_search_over_edits(spark, folder):
    got = QUERIES["op13_repair_conversations"](spark, folder)
    assert sorted(map(tuple, got.collect()), key=str) == brute(odd_table())


@pytest.mark.parametrize("limit", [1, 3])
def test_chunks_do_not_change_the_repair(spark, folder, limit):
    rows = conversations.prepared(spark.read.parquet(f"{folder}/conversations.parquet"), "conv_id", "turn", "role", "text", None)
    want = {tuple(r) for r in conversations.audits(rows).collect()}
    assert {tuple(r) for r in conversations.audits(rows, limit).collect()} == want


def test_costs_of_a_long_conversation_settle(spark):
    """One conversation of 30,000 rows in chunks of 1,000, most of them unknown roles, which never converge by themselves."""
    rows = spark.range(30_000).select(
        F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 5 == 0, "user").otherwise("tool").alias("role"), F.concat("id", F.lit(".")).alias("text"),
    )
    report, edited = conversations.repair(rows, limit=1000)
    got = report.first()
    codes = bytes(4 if i % 5 == 0 else 12 for i in range(30_000))
    (state,), audit = trace(codes, END, START)
    assert (got.cost, got.audit) == (backward(codes, END)[START], audit + END_EDITS[state])
    assert edited.count() == 30_000 + got.audit.count("I") - got.audit.count("D")


def test_a_row_repeated_without_end(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a.", 200_000), (1, 1, "assistant", "b.", 1)], KINDS + ", copies int")
    report, edited = conversations.repair(rows, copies="copies", limit=4096)
    got = report.first()
    assert (got.duplicate, got.cost, got.audit) == (199_999, 4 * 199_999, "K" + "D" * 199_999 + "K")
    assert edited.count() == 2


def test_no_conversations(spark, tmp_path):
    spark.createDataFrame([], KINDS).write.parquet(f"{tmp_path}/conversations.parquet")
    assert QUERIES["op13_repair_conversations"](spark, str(tmp_path)).count() == 0


def test_rerun_equals_a_whole_run():
    rng = random.Random(1)
    for _ in range(300):
        codes = bytes(rng.randrange(16) for _ in range(rng.randrange(1, 40)))
        old, new = (tuple(rng.randrange(9) for _ in range(4)) for _ in range(2))
        assert rerun(codes, old, backward(codes, old), new) == backward(codes, new)
