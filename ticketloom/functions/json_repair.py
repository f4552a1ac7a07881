"""Reading JSON text columns that may be quoted twice, cut off or malformed.

``repair`` is a staged column program: every stage rewrites the text with built-in functions, the first stage whose
result parses wins and is named in ``repair_stage``. Nothing leaves the JVM and no row is dropped.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Neighbouring tokens (s: string, w: other scalar) between which the structural stage and the comma stage
# put a missing comma, and the patterns of the last stages.
STRUCTURAL_PAIRS = ("}{", "s{", "}s", "][", "]{", "}[")
COMMA_PAIRS = STRUCTURAL_PAIRS + ("ss", "]s", "s[", "ws", "sw")
TOPIC_PATTERN = r'"([^"]+)":\s*\{\s*"topic":\s*"([^"]*)"(?:[^}]*)"description":\s*"([^"]*)"'
PAIR_PATTERN = r'"([^"]+)":\s*"([^"]+)"'
STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
BLANK = r" \t\n\x0B\f\r"  # written out, because a class that names \s is slower
WORD = rf'[^{BLANK}"{{}}\[\],:]++'
TOKENS = {"s": STRING, "w": WORD, **{c: re.escape(c) for c in "{}[],:"}}
BARE_KEY = r"[a-zA-Z0-9_]++[\u2028\u2029]?+(?=\s*+:)"
QUOTE = "\u0001"  # stands for quotes that bound no string of the text, which has lost its control characters by then
# up to the next quote that opens no string; behind such a quote an escaped one opens none either and is not tried
UP_TO_LOOSE_QUOTE = rf'\G((?!^)[^"\\]*+(?:\\(?!").[^"\\]*+)*+\\|(?:[^"]++|{STRING})*+)"'
END_DATE_PATTERN = r'"end_date\\?":\s*\\?"([^"\\]+)'


def is_json(text: Column) -> Column:
    """Whether the whole text is one document; the parser alone would accept anything after a first one."""
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1  # first: it costs less where it fails
    return F.coalesce(alone, F.lit(False)) & F.try_parse_json(text).isNotNull()


def unquote(text: Column) -> Column:
    """Undo one level of quoting around a JSON document."""
    quoted = F.startswith(text, F.lit('"')) & F.endswith(text, F.lit('"')) & (F.length(text) >= 2)
    inner = F.replace(F.substring(text, F.lit(2), F.length(text) - 2), F.lit('\\"'), F.lit('"'))
    return F.when(quoted, inner).otherwise(text)


def run_end(details: Column) -> Column:
    """``end_date`` of a run record: plain JSON, JSON in quotes, or a pattern as the last resort."""
    found = F.coalesce(
        F.get_json_object(details, "$.end_date"),
        F.get_json_object(unquote(details), "$.end_date"),
        F.regexp_extract(details, END_DATE_PATTERN, 1),
    )
    return F.when(found != "", found)


def _skeleton(bare: Column) -> Column:
    """Brackets outside strings of a text without escapes, less those that close each other within three levels."""
    pair = r"\{\}|\[\]"
    for _ in range(2):
        pair = rf"\{{(?:{pair})*+\}}|\[(?:{pair})*+\]"
    return F.regexp_replace(F.regexp_replace(bare, r'(?:[^{}\[\]"]++|"[^"]*+(?:"|$))++', ""), pair, "")


def _close(text: Column, bare: Column, skeleton: Column) -> Column:
    """Close an open string and every open bracket, innermost first."""
    open_string = (F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))) % 2 == 1

    def step(stack: Column, c: Column) -> Column:
        top = F.right(stack, F.lit(1))
        matches = ((c == "}") & (top == "{")) | ((c == "]") & (top == "["))
        return (
            F.when(c.isin("{", "["), F.concat(stack, c))
            .when(matches, F.substring(stack, F.lit(1), F.length(stack) - 1))
            .otherwise(stack)
        )

    left_open = F.aggregate(F.split(skeleton, ""), F.lit(""), step)
    closing = F.when(skeleton == "", "").otherwise(F.translate(F.reverse(left_open), "{[", "}]"))
    return F.concat(text, F.when(open_string, '"').otherwise(""), closing)


def _keyed(text: Column) -> Column:
    """Write ``QUOTE`` for quotes that open no string, and around bare keys; what carries it belongs to a word."""
    loose = F.regexp_replace(text, UP_TO_LOOSE_QUOTE, f"$1{QUOTE}")
    others = rf'{STRING}|[{{}}\[\],:{QUOTE}]|(?!{BARE_KEY})[^{BLANK}"{{}}\[\],:{QUOTE}]++'
    return F.regexp_replace(loose, rf"\G((?:\s*+(?:{others}))*+\s*+)({BARE_KEY})", f"$1{QUOTE}$2{QUOTE}")


def _separated(keyed: Column, pairs: tuple[str, ...]) -> Column:
    """Add missing commas, leave out trailing ones and blanks between tokens, and write plain quotes again.

    Strings are tokens as a whole (s), brackets and separators are their own kind, else w; nothing inside a string is
    touched. Every match goes from the last place of a comma to the next one, so a text is read once.
    """
    follow = {k: "|".join(TOKENS[after] for after in TOKENS if k + after in pairs) for k in TOKENS}
    quiet = "".join(TOKENS[k] for k in "{}[],:" if not follow[k])  # no comma is missing behind these, nor behind blanks
    loud = "".join(TOKENS[k] for k in "{}[],:" if follow[k])
    run = rf"[{BLANK}{quiet}]++" if follow["w"] else rf'[^"{loud}]++'
    apart = "|".join(rf"{TOKENS[k]}(?!\s*+(?:{follow[k]}))" for k in TOKENS if follow[k])
    commas = F.regexp_replace(keyed, rf"\G((?:{run}|{apart})*+(?:{STRING}|[{loud}]|{WORD}))", "$1,")
    kept = rf'(?:[^{BLANK}",]++|{STRING}|,(?!\s*+[}}\]]))++'
    return F.replace(F.regexp_replace(commas, rf"({kept})|\s++|,", "$1"), F.lit(QUOTE), F.lit('"'))


def _entries(keys: Column, values: Column) -> Column:
    """JSON object from parallel arrays; the last value of a repeated key counts."""
    body = F.transform(
        F.array_distinct(keys),
        lambda k: F.concat(
            F.lit('"'),
            k,
            F.lit('":'),
            F.element_at(values, (F.size(keys) - F.array_position(F.reverse(keys), k) + 1).cast("int")),
        ),
    )
    return F.when(F.size(keys) > 0, F.concat(F.lit("{"), F.array_join(body, ","), F.lit("}")))


def _groups(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def _top_level_objects(text: Column) -> Column:
    """Complete objects at nesting depth zero, in order."""
    pieces = F.regexp_extract_all(text, F.lit(r"[^{}]*[{}]"), F.lit(0))
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("buf"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, piece: Column) -> Column:
        opens = F.endswith(piece, F.lit("{"))
        depth = F.when(opens, acc["depth"] + 1).otherwise(F.greatest(acc["depth"] - 1, F.lit(0)))
        buf = F.when(opens & (acc["depth"] == 0), F.lit("{")).otherwise(F.concat(acc["buf"], piece))
        done = ~opens & (acc["depth"] == 1)
        return F.struct(
            depth.alias("depth"),
            F.when(done, F.lit("")).otherwise(buf).alias("buf"),
            F.when(done, F.array_append(acc["out"], buf)).otherwise(acc["out"]).alias("out"),
        )

    return F.aggregate(pieces, start, step)["out"]


def repair(df: DataFrame, column: str, out: str = "repaired") -> DataFrame:
    """Add the repaired document and ``repair_stage`` (``none`` where the text was fine already)."""
    raw = F.col(column)
    c3 = F.col("_s3")
    topics = _entries(
        _groups(c3, TOPIC_PATTERN, 1),
        F.transform(
            F.arrays_zip(_groups(c3, TOPIC_PATTERN, 2).alias("t"), _groups(c3, TOPIC_PATTERN, 3).alias("d")),
            lambda e: F.concat(
                F.lit('{"topic":'), _quoted(e["t"]), F.lit(',"description":'), _quoted(e["d"]), F.lit("}")
            ),
        ),
    )
    objects = F.filter(_top_level_objects(c3), is_json)
    bodies = F.filter(
        F.transform(objects, lambda o: F.trim(F.substring(o, F.lit(2), F.length(o) - 2))), lambda b: b != ""
    )
    merged = F.when(F.size(bodies) > 0, F.concat(F.lit("{"), F.array_join(bodies, ","), F.lit("}")))
    pairs = _entries(_groups(c3, PAIR_PATTERN, 1), F.transform(_groups(c3, PAIR_PATTERN, 2), _quoted))
    stages = (
        ("none", raw),
        ("closed", _close(F.col("_s0"), F.col("_bare"), F.col("_skeleton"))),
        ("printable", F.regexp_replace("_s1", r"[^\P{C}\n\r\t]", "")),
        ("structure", _separated(F.col("_keyed"), STRUCTURAL_PAIRS)),
        ("commas", _separated(F.col("_keyed"), COMMA_PAIRS)),
        ("outer_object", F.regexp_extract("_s3", r"(?s)(\{.*\})", 1)),
        ("topics", topics),
        ("objects", merged),
        ("pairs", pairs),
    )
    read_twice = {
        "closed": {"_bare": F.regexp_replace("_s0", r"\\.", ""), "_skeleton": _skeleton(F.col("_bare"))},
        "structure": {"_keyed": _keyed(F.col("_s2"))},
    }
    # a row that parses leaves the ladder: later rewrites are only worked out for rows still broken, and only parsed
    # where they changed the text
    staged = df.withColumn("repair_stage", F.lit(None).cast("string")).withColumn(out, F.lit(None).cast("string"))
    for i, (name, rewritten) in enumerate(stages):
        broken = F.col("repair_stage").isNull()
        changed = F.lit(True) if i == 0 else F.coalesce(F.col(f"_s{i}") != F.col(f"_s{min(i - 1, 3)}"), F.lit(False))
        now = broken & changed & F.coalesce(is_json(F.col(f"_s{i}")), F.lit(False))
        for helper, value in read_twice.get(name, {}).items():
            staged = staged.withColumn(helper, F.when(broken, value))
        staged = (
            staged.withColumn(f"_s{i}", F.when(broken, rewritten))
            .withColumn("_now", now)
            .withColumn(out, F.when(F.col("_now"), F.col(f"_s{i}")).otherwise(F.col(out)))
            .withColumn("repair_stage", F.when(F.col("_now"), name).otherwise(F.col("repair_stage")))
        )
    return (
        staged.withColumn("repair_stage", F.coalesce("repair_stage", F.lit("lost")))
        .withColumn(out, F.coalesce(out, F.lit("{}")))
        .drop("_now", "_bare", "_skeleton", "_keyed", *[f"_s{i}" for i in range(len(stages))])
    )


def missing_keys(document: Column, keys: list[str]) -> Column:
    """Required top-level keys that the document lacks."""
    present = F.coalesce(F.json_object_keys(document), F.array().cast("array<string>"))
    return F.array_except(F.array(*[F.lit(k) for k in keys]), present)


def validate(document: Column, keys: list[str]) -> Column:
    """Message of the required-key check."""
    empty = document.isNull() | (F.coalesce(F.size(F.json_object_keys(document)), F.lit(0)) <= 0)
    lacking = missing_keys(document, keys)
    return (
        F.when(empty, "Empty JSON response")
        .when(F.size(lacking) > 0, F.concat(F.lit("Missing required keys: "), F.array_join(lacking, ", ")))
        .otherwise("Valid JSON")
    )
