"""Text, date and JSON functions on hand-made edge rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ticketloom.functions import dates, json_repair, providers, text
from ticketloom.operators import preparation

GOLDEN = [
    ("INC001234", "SharePoint site not loading properly. Users unable to access documents.", "SharePoint access issue", "SharePoint Online"),
    ("EMPTY", None, "  ", None),
    ("MAIL", "Ask bob.smith@example.org or see https://example.org/a?b=1 now!!!!", "x", "Payroll - PROD"),
    ("ACCENT", "Émile's naïve café\t日本語 😀 #1", None, "Web_Shop TEST"),
]


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, t {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("t"))).collect()]


@pytest.fixture(scope="module")
def golden(spark):
    rows = [(n, datetime(2024, 1, 1), d, s, b) for n, d, s, b in GOLDEN]
    return spark.createDataFrame(
        rows, "number string, sys_created_on timestamp, description string, short_description string, business_service string"
    )


def test_combined_text(golden):
    got = {r.number: (r.combined_text, r.is_placeholder) for r in preparation.with_combined_text(golden).collect()}
    assert got["INC001234"][0] == (
        "SharePoint site not loading properly. Users unable to access documents. | SharePoint access issue | SharePoint Online"
    )
    assert got["EMPTY"] == ("No description available", True)
    assert got["MAIL"] == ("Ask or see now... | x | Payroll", False)
    assert got["ACCENT"][0] == "Émile s naïve café 日本語    1 | WebShop"


def test_missing_column_is_an_error(golden):
    with pytest.raises(ValueError, match="description"):
        preparation.with_combined_text(golden.drop("description"))


def test_length_filter_keeps_ten_and_cuts(spark):
    df = spark.createDataFrame([("a" * n,) for n in (9, 10, 11, 40)] + [(None,)], "t string")
    got = sorted(r.t for r in preparation.clean_and_filter(df, "t", max_length=20).collect())
    assert got == sorted(["a" * 10, "a" * 11, "a" * 20 + "..."])


def test_services(spark):
    values = ["Payroll - PROD", "Web_Shop TEST", "A-B C", None, "Mail - UAT", "X_QA"]
    assert column(spark, values, text.clean_service) == ["Payroll", "WebShop", "AB C", "", "Mail UAT", "XQA"]
    assert column(spark, values, text.normalize_service) == ["Payroll", "Web Shop TEST", "A B C", "", "Mail", "X"]


def test_words_tokens_and_chunks(spark):
    assert column(spark, ["a b  c", "", None], text.word_count) == [3, 0, None]
    assert column(spark, ["One a two_3 é étà"], text.tokens) == [["one", "two_3", "étà"]]
    assert column(spark, ["abcdefg", ""], lambda c: text.chunks(c, 3)) == [["abc", "def", "g"], [""]]
    assert column(spark, ["", "abcd", None], text.estimate_tokens) == [0, 2, 0]


def test_embedding_checks(spark):
    df = spark.createDataFrame([("  ",), ("x" * 50,), ("hello world",), (None,)], "t string")
    got = [(r.status, r.prepared) for r in preparation.embedding_input(df, "t", 10).collect()]
    assert got == [("empty", None), ("long", "x" * 50), ("valid", "hello world"), ("empty", None)]
    assert column(spark, ["", "short", "x" * 99, "good enough"], lambda c: preparation.strict_reason(c, 20)) == [
        "empty", "too_short", "too_long", None
    ]


def test_timestamps(spark):
    values = ["2024-01-02T03:04:05", "2024-01-02 03:04:05 UTC", "2024-01-02T03:04:05.25", "02/01/2024", ""]
    full = datetime(2024, 1, 2, 3, 4, 5)
    assert column(spark, values, dates.parse_timestamp) == [full, full, full.replace(microsecond=250000), None, None]


def test_windows(spark):
    one = spark.range(1)
    now, last = F.lit(datetime(2024, 1, 1, 12)), F.lit(datetime(2024, 1, 1, 9))
    none = F.lit(None).cast("timestamp")
    w = one.select(dates.hourly_window(last, now).alias("a"), dates.hourly_window(none, now).alias("b"),
                   dates.back_fill_window(None, "2024-01-01", none, now).alias("c")).first()
    assert tuple(w.a) == (datetime(2024, 1, 1, 9), datetime(2024, 1, 1, 10))
    assert tuple(w.b) == (datetime(2024, 1, 1, 11), datetime(2024, 1, 1, 12))
    assert tuple(w.c) == (datetime(2024, 1, 1, 11), datetime(2024, 1, 2))


def test_json_repair(spark):
    cases = [
        ('{"a": 1}', "none", '{"a": 1}'),
        ('{"a": {"b": "open', "closed", '{"a": {"b": "open"}}'),
        ('{a: 1, "b": [1, 2,],}', "structure", '{"a": 1, "b": [1, 2]}'),
        ('{"a": "x" "b": 2}', "commas", '{"a": "x","b": 2}'),
        ('Sure! {"a": 1} bye', "outer_object", '{"a": 1}'),
        ('{"1": {"topic": "T", "x": ?, "description": "D"}, "2": {"topic": "U", "description": "E"} ?', "topics", None),
        ('x {"a": 1} , {"b": {"c": 2}} y }', "objects", None),
        ('{"k": "v", ?, "k": "w", "z": "q"', "pairs", None),
        ("nothing", "lost", "{}"),
        ('{"a": "", "b": "x" "c": 1}', "commas", '{"a": "", "b": "x", "c": 1}'),
        ('{"a": "p, q: r] {" "c": 1}', "commas", '{"a": "p, q: r] {", "c": 1}'),
        ('{"a": [1, "x" "y,}" ["z" 2] ], b: true "d": null}', "commas", '{"a": [1, "x", "y,}", ["z", 2]], "b": true, "d": null}'),
        ('{"a": "q\\" : {", "b": [{"c": 1} {"d": 2}]', "structure", '{"a": "q\\" : {", "b": [{"c": 1}, {"d": 2}]}'),
        (None, "lost", "{}"),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, t string")
    got = json_repair.repair(df, "t").orderBy("i").collect()
    import json

    for row, (_, stage, want) in zip(got, cases):
        assert row.repair_stage == stage, row
        if want is not None:
            assert json.loads(row.repaired) == json.loads(want)
    assert json.loads(got[5].repaired) == {"1": {"topic": "T", "description": "D"}, "2": {"topic": "U", "description": "E"}}
    assert json.loads(got[6].repaired) == {"a": 1, "b": {"c": 2}}
    assert json.loads(got[7].repaired) == {"k": "w", "z": "q"}


def rewritten(text, pairs):
    """Plain model of the token stages: commas between ``pairs``, none before a closing bracket, quotes around keys."""
    import re

    tokens = re.findall(r'"[^"\\]*(?:\\.[^"\\]*)*"|[{}\[\],:]|[^\s"{}\[\],:]+|"', text)
    kinds = [t if t in "{}[],:" else "s" if len(t) > 1 and t[0] == t[-1] == '"' else "w" for t in tokens]
    out = []
    for t, kind, before, after in zip(tokens, kinds, [",", *kinds], [*kinds[1:], ","]):
        key = kind == "w" and after == ":" and re.fullmatch("[a-zA-Z0-9_]+", t)
        body = f'"{t}"' if key else "" if kind == "," and after in "}]" else t
        out.append("," * (before + kind in pairs) + body)
    return "".join(out)


def test_json_token_stages_without_arrays(spark):
    """The token stages agree with a plain model and make no array of the tokens: it took half of the time."""
    import random

    pieces = ['{', '}', '[', ']', ',', ':', '"', ' ', '\n', '\\', '\\"', '"x"', 'k: ', 'b1 :', '1', 'true', '?', '""', '"} {"', '$1']
    dice = random.Random(14)
    texts = ["".join(dice.choices(pieces, k=dice.randint(0, 20))) for _ in range(3000)] + ["", " ", '"', '\\"']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for pairs in (json_repair.STRUCTURAL_PAIRS, json_repair.COMMA_PAIRS):
        got = df.select("t", json_repair._separated(json_repair._keyed(F.col("t")), pairs).alias("r")).collect()
        assert [r for r in got if r.r != rewritten(r.t, pairs)] == []
    plan = json_repair.repair(df, "t")._jdf.queryExecution().optimizedPlan().toString()
    ladder = [line for line in plan.splitlines() if "AS _s3" in line or "AS _s4" in line]
    assert len(ladder) == 2 and not any("lambda" in line for line in ladder)
    assert "arrays_zip(slice" not in plan


def test_json_repair_reads_quotes_that_open_nothing_once(spark):
    """Escaped quotes outside any string: none may look for its end through the rest of the text."""
    import time

    text = "{" + '\\"a\\": 1, ' * 60000 + "} {"
    start = time.perf_counter()
    df = spark.createDataFrame([(text,)], "t string").select(json_repair._separated(json_repair._keyed(F.col("t")), ("}{",)).alias("r"))
    assert df.select(F.length("r")).first()[0] == 1 + 60000 * 8 - 1 + 3
    assert time.perf_counter() - start < 15


def test_required_keys(spark):
    values = ['{"a": 1, "b": 2}', '{"a": 1}', "{}", None]
    assert column(spark, values, lambda c: json_repair.validate(c, ["a", "b"])) == [
        "Valid JSON", "Missing required keys: b", "Empty JSON response", "Empty JSON response"
    ]


def test_provider_failures_stay_single(spark):
    def provider(texts):
        if any("bad" in t for t in texts):
            raise ValueError("Rate limit 429")
        return [[float(len(t)), 1.0] for t in texts]

    df = spark.createDataFrame([(i, "bad row" if i == 7 else f"fine row {i}") for i in range(20)] + [(99, None)], "number int, s string")
    rows = {r.number: r for r in providers.embed(df, "s", provider, batch=8, attempts=1).collect()}
    assert len(rows) == 21
    assert rows[7].embedding is None and rows[7].embedding_status == "failed" and rows[7].error_class == "RATE_LIMIT"
    assert rows[3].embedding == [10.0, 1.0] and rows[99].embedding_status == "empty"
    assert sum(r.embedding is not None for r in rows.values()) == 19


def test_summaries_fall_back(spark):
    def provider(texts):
        if "word" in texts[0]:
            return ['"a summary"' for _ in texts]
        raise RuntimeError("timeout")

    df = spark.createDataFrame([(1, "word " * 40), (2, "other " * 40), (3, "tiny")], "i int, t string")
    rows = {r.i: r for r in providers.summarize(df, "t", provider, batch=1, attempts=1).collect()}
    assert rows[1].combined_incidents_summary == "a summary"
    assert rows[2].summary_source == "provider_failed" and rows[2].combined_incidents_summary == "other " * 40
    assert rows[3].summary_source == "short_text"


def test_built_in_summary_is_short(views):
    rows = providers.summarize(views.incidents, "description")
    assert rows.where(text.word_count(F.col("combined_incidents_summary")) > 30).where("summary_source = 'built_in'").isEmpty()


def test_words_of_a_batch_are_not_all_in_python_at_once():
    """A batch of ten thousand texts: Python's memory follows some of them; nulls and empty texts keep their places."""
    import tracemalloc

    import pyarrow as pa

    leading = []
    made = F.arrow_udf
    try:
        F.arrow_udf = lambda kind: lambda f: leading.append(f) or made(kind)(f)
        text.leading_words(F.lit("a"), 2)
    except AssertionError:  # no session is needed for the function itself
        pass
    finally:
        F.arrow_udf = made
    rows = [[f"w{i}_{k}" for k in range(100)] + [f"w{i}_7"] for i in range(10_000)]
    rows[3], rows[5] = None, []
    words = pa.array(rows, pa.list_(pa.string())).slice(1)
    del rows
    tracemalloc.start()
    got = leading[0](words).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got[0] == "w1_7 w1_0" and got[2] is None and got[4] == "" and got[-1] == "w9999_7 w9999_0"
    assert peak < 20 << 20
