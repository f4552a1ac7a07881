"""Secret scan with built-in functions only.

Known forms are found by pattern. Beyond them, long tokens are scored by two character Markov models, one of random
strings and one of ordinary words and identifiers: a token is a secret if its log-likelihood ratio is over a threshold.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Base patterns in the order in which kinds are listed (fixed values); letters of the keywords in either case.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")
KEYWORDS = ("password", "passwd", "secret", "token", "api")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
LEAST_CHARS = 20
CANDIDATE = r"[A-Za-z0-9+/_=.-]{%d,}"
IDENTIFIER = r"[A-Za-z0-9_.-]{6,}"
SPAN = "array<struct<start: int, rank: int, kind: string, end: int>>"
MATCH = "array<struct<start: int, end: int, token: string>>"
#: Matches whose places are added up together.
RUN = 256
#: Bounds of the training sample: documents read, and random strings made.
LEARN_TEXTS = 10_000
RANDOM_STRINGS = 4_000
SMOOTHING = 0.5
THRESHOLD = 10.0


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratio of every pair of neighbouring characters, row by row of ``ALPHABET``."""

    ratios: tuple[float, ...]


def _none(kind: str = SPAN) -> Column:
    return F.array().cast(kind)


def _found(pieces: Column, matches: Column) -> Column:
    """Start, end and string of all matches, from the text between them; positions are code points.

    The running position goes through runs of ``RUN`` matches, so that the work is linear in their number.
    """
    sizes = F.zip_with(F.slice(pieces, 1, F.size(matches)), matches, lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("token")))
    runs = F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(matches) / RUN).cast("int") - 1), lambda k: F.slice(sizes, k * RUN + 1, F.lit(RUN))
    )

    def one(state: Column, part: Column) -> Column:
        begin = state["at"] + part["gap"]
        end = begin + F.length(part["token"])
        span = F.struct(begin.alias("start"), end.alias("end"), part["token"].alias("token"))
        return F.struct(end.alias("at"), F.array_append(state["found"], span).alias("found"))

    def run(state: Column, parts: Column) -> Column:
        done = F.aggregate(parts, F.struct(state["at"].alias("at"), _none(MATCH).alias("found")), one)
        return F.struct(done["at"].alias("at"), F.array_append(state["found"], done["found"]).alias("found"))

    start = F.struct(F.lit(0).alias("at"), _none(f"array<{MATCH}>").alias("found"))
    return F.aggregate(runs, start, run, lambda s: F.flatten(s["found"]))


def with_matches(df: DataFrame, text: str, out: str, pattern: str, worth: Column) -> DataFrame:
    """Add the leftmost non-overlapping matches with their places; only texts that pass ``worth`` are searched."""
    matches = F.when(worth, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    df = df.withColumn("__matches", matches)
    found = _found(F.split(F.col(text), pattern, -1), F.col("__matches"))
    return df.withColumn(out, F.when(F.size("__matches") > 0, found).otherwise(_none(MATCH))).drop("__matches")


def spans(matches: str, kind: str, keep) -> Column:
    """Spans of the matches that pass ``keep``, a test of the matched string."""
    rank = F.lit(KINDS.index(kind))
    return F.transform(F.filter(matches, lambda m: keep(m["token"])), lambda m: F.struct(
        m["start"].alias("start"), rank.alias("rank"), F.lit(kind).alias("kind"), m["end"].alias("end")))


def with_spans(df: DataFrame, text: str, out: str, pattern: str, kind: str, worth: Column, keep=lambda m: F.lit(True)) -> DataFrame:
    """Add the spans of the matches that pass ``keep``."""
    df = with_matches(df, text, "__found", pattern, worth)
    return df.withColumn(out, spans("__found", kind, keep)).drop("__found")


def base_spans(df: DataFrame, text: str) -> DataFrame:
    """Add ``assign, access, hex``: spans of the known forms in the (non-null) text."""
    lowered = F.lower(F.col(text))
    worth = F.lit(False)
    for word in KEYWORDS:
        worth = worth | F.contains(lowered, F.lit(word))
    df = with_spans(df, text, "assign", ASSIGN, "assign", worth, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6)
    df = with_spans(df, text, "access", ACCESS, "access", F.contains(F.col(text), F.lit("AKIA")), lambda m: F.length(m) >= 20)
    return with_spans(df, text, "hex", HEX, "hex", F.col(text).rlike(HEX))


def pair_index(token: Column, i: Column) -> Column:
    """Place of the pair of characters at ``i`` (from 1) in the table of ratios, from 1."""
    def at(k: Column) -> Column:
        return F.instr(F.lit(ALPHABET), F.substring(token, k, F.lit(1)))

    return (at(i) - 1) * len(ALPHABET) + at(i + 1)


def ratio(token: Column, model: Model) -> Column:
    """Log-likelihood ratio of a token of at least two characters of the alphabet."""
    table = F.split(F.lit(",".join(map(repr, model.ratios))), ",").cast("array<double>")  # one constant
    pairs = F.sequence(F.lit(1), F.length(token) - 1)
    return F.aggregate(pairs, F.lit(0.0), lambda s, i: s + F.element_at(table, pair_index(token, i)))


def random_strings(spark: SparkSession, n: int = RANDOM_STRINGS) -> DataFrame:
    """Labelled random strings: digests of the numbers 0 .. n-1 in base 64, hexadecimal and upper case base 36."""
    digest = F.sha2(F.col("id").cast("string").cast("binary"), 256)
    upper = F.upper(F.regexp_replace(F.base64(F.unhex(digest)), "[+/=]", ""))
    return spark.range(n).select(F.explode(F.array(F.base64(F.unhex(digest)), digest, upper)).alias("token"))


def sample(df: DataFrame, text: str, rows: int) -> DataFrame:
    """About ``rows`` rows by a hash of the text; all if there are no more."""
    total = df.count()
    return df if total <= rows else df.where(F.pmod(F.xxhash64(text), F.lit(1 << 30)) < int(rows / total * (1 << 30)))


def fit(documents: DataFrame, text: str = "text", learn_texts: int = LEARN_TEXTS, random_rows: int = RANDOM_STRINGS) -> Model:
    """Models from labelled samples: values in known forms and random strings against the other words of documents.

    At most about ``learn_texts`` documents (by a hash of the text) are learned from; only counts of character pairs, of
    which there are at most twice the square of the alphabet, reach the driver.
    """
    rows = sample(documents.select(F.col(text).alias("t")).where("t IS NOT NULL"), "t", learn_texts)
    value = F.regexp_extract_all("t", F.lit(ASSIGN), F.lit(2))
    known = F.concat(F.filter(value, lambda v: F.length(v) >= 16), F.regexp_extract_all("t", F.lit(HEX), F.lit(0)))
    secret = rows.select(F.explode(known).alias("token")).unionByName(random_strings(documents.sparkSession, random_rows))
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace("t", ASSIGN, " "), ACCESS, " "), HEX, " ")
    plain = rows.select(F.explode(F.regexp_extract_all(rest, F.lit(IDENTIFIER), F.lit(0))).alias("token"))
    tokens = secret.withColumn("random", F.lit(True)).unionByName(plain.withColumn("random", F.lit(False)))
    pairs = tokens.where(F.length("token") > 1).select(
        "random", F.explode(F.transform(F.sequence(F.lit(1), F.length("token") - 1), lambda i: pair_index(F.col("token"), i))).alias("pair")
    )
    size = len(ALPHABET)
    counts = {True: [0] * (size * size), False: [0] * (size * size)}
    for r in pairs.groupBy("random", "pair").count().collect():
        counts[r["random"]][r["pair"] - 1] = r["count"]

    def log_share(table: list[int], pair: int) -> float:
        first = pair // size * size
        return math.log((table[pair] + SMOOTHING) / (sum(table[first : first + size]) + SMOOTHING * size))

    return Model(tuple(log_share(counts[True], p) - log_share(counts[False], p) for p in range(size * size)))


def scan(
    df: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD, least_chars: int = LEAST_CHARS
) -> DataFrame:
    """Add ``assign, access, hex, markov`` to all columns: spans of each kind (start, rank of the kind, kind, end).

    ``markov`` spans are tokens of at least ``least_chars`` characters that score over ``threshold`` and touch no span of
    the known forms. Positions are code points of the whole text, ends exclusive. A null or empty text has no spans.
    Columns with one of the four names are replaced.
    """
    rows = df.drop(*KINDS).withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    pattern = CANDIDATE % least_chars
    rows = with_matches(base_spans(rows, "__text"), "__text", "__long", pattern, F.col("__text").rlike(pattern))
    base = F.concat("assign", "access", "hex")

    def free(span: Column) -> Column:
        return ~F.exists(base, lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))

    random = F.filter("__long", lambda m: ratio(m["token"], model) > threshold)
    rows = rows.withColumn("__long", F.when(F.size("__long") > 0, F.filter(random, free)).otherwise(_none(MATCH)))
    return rows.withColumn("markov", spans("__long", "markov", lambda m: F.lit(True))).drop("__text", "__long")


def listed(*spans: str) -> Column:
    """All spans by start, then kind, as ``kind:start:end`` joined by commas."""
    ordered = F.array_sort(F.concat(*spans))
    return F.array_join(
        F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
