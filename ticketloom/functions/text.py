"""Text preparation as Column expressions. All of them run JVM-side; none needs a Python worker."""

from __future__ import annotations

from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns, limits and literals that decide the results.
URL = r"https?://[!$-_a-z]+"
EMAIL = r"(?U)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
EMAIL_IN_SUMMARY = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
BLANK = r"\s\x0b\x1c-\x1f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACES = rf"[{BLANK}]+"
OUTER_SPACES = rf"^[{BLANK}]+|[{BLANK}]+$"
SPECIAL = rf"[^\p{{L}}\p{{N}}_{BLANK}.,!?;:-]"
PUNCTUATION_RUN = r"[.!?]{3,}"
LINE_BREAKS = r"[\n\r\t]+"
NON_PRINTABLE = r"\p{C}"
ENVIRONMENT_INFIX = r"(?U)\s*-\s*(PROD|TEST|DEV)(\s|$)"
ENVIRONMENT_WORDS = ("PROD", "TEST", "DEV")
ENVIRONMENT_SUFFIX = r"(?U)\s*[-_]\s*(PROD|DEV|TEST|UAT|QA)$"
TOKEN = r"[\p{L}\p{N}_]{2,}"
FENCE = r"^```(?:json)?|```$"
PLACEHOLDER = "No description available"
PART_SEPARATOR = " | "
MIN_LENGTH = 10
CHUNK_CHARS = 50_000
EMBEDDING_TOKENS = 8191
STRICT_EMBEDDING_TOKENS = 8192
EMBEDDING_CHARS = 8000
SHORT_DESCRIPTION = 300
SUMMARY_SKIP_CHARS = 100
SUMMARY_WORDS = 30
SUMMARY_TEXTS = 256
CENTER_PREFIX = "BT-TC-"

_ERROR_RULES = (
    # First rule that matches wins.
    ("RATE_LIMIT", ("rate limit", "429")),
    ("TIMEOUT", ("timeout",)),
    ("TOKEN_LIMIT", ("token", "context length")),
    ("VALIDATION_ERROR", ("empty", "null", "short")),
    ("BATCH_ERROR", ("batch",)),
    ("AUTH_ERROR", ("authentication", "401")),
    ("CONNECTION_ERROR", ("connection",)),
    ("SERVICE_UNAVAILABLE", ("service unavailable", "503")),
)
OTHER_ERROR = "API_ERROR"


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.regexp_replace(text, OUTER_SPACES, "")


def deep_clean(
    text: Column, remove_urls: bool = True, remove_emails: bool = True, normalize_whitespace: bool = True
) -> Column:
    """Full cleaning. The order of the steps matters; blanks made by the fourth step are kept."""
    # plain searches for what every match contains spare most rows the two costly patterns
    if remove_urls:
        text = F.when(F.contains(text, F.lit("http")), F.regexp_replace(text, URL, "")).otherwise(text)
    if remove_emails:
        text = F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, EMAIL, "")).otherwise(text)
    if normalize_whitespace:
        text = F.regexp_replace(text, SPACES, " ")
    text = F.regexp_replace(text, SPECIAL, " ")
    text = F.regexp_replace(text, PUNCTUATION_RUN, "...")
    return F.trim(text) if normalize_whitespace else strip(text)


def fast_clean(text: Column) -> Column:
    """Light cleaning for scoring: collapse white space."""
    return F.trim(F.regexp_replace(text, SPACES, " "))


def summary_clean(text: Column) -> Column:
    """Cleaning ahead of summarisation: line breaks and runs of blanks become one blank, control characters go."""
    flat = F.regexp_replace(F.regexp_replace(text, LINE_BREAKS, " "), SPACES, " ")
    return F.trim(F.regexp_replace(F.coalesce(flat, F.lit("")), NON_PRINTABLE, ""))


def clean_service(name: Column) -> Column:
    """Service name without environment suffix and joining characters."""
    out = F.regexp_replace(strip(name), ENVIRONMENT_INFIX, " ")
    for word in ENVIRONMENT_WORDS:
        out = F.regexp_replace(out, rf"(?U)\s+{word}$", " ")
    out = F.regexp_replace(F.regexp_replace(out, r"[-_+]", ""), SPACES, " ")
    return F.coalesce(F.trim(out), F.lit(""))


def normalize_service(name: Column) -> Column:
    """Service name with the environment suffix cut and joining characters turned into blanks."""
    out = F.regexp_replace(name, ENVIRONMENT_SUFFIX, "")
    out = F.regexp_replace(F.regexp_replace(out, r"[-_]+", " "), SPACES, " ")
    return F.coalesce(F.trim(out), F.lit(""))


def combine_parts(*parts: Column) -> Column:
    """Join the non-empty cleaned parts; a row without any gets the placeholder literal."""
    kept = F.filter(F.array(*parts), lambda p: p.isNotNull() & (F.length(F.trim(p)) > 0))
    return F.when(F.size(kept) > 0, F.array_join(kept, PART_SEPARATOR)).otherwise(F.lit(PLACEHOLDER))


def combine_incident(description: Column, short_description: Column, service: Column) -> Column:
    return combine_parts(deep_clean(description), deep_clean(short_description), clean_service(service))


def safe_text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def estimate_tokens(text: Column) -> Column:
    """About four characters per token, plus one as margin; nothing for empty text."""
    n = F.length(text)
    return F.when(F.coalesce(n, F.lit(0)) == 0, F.lit(0)).otherwise(F.floor(n / 4) + 1).cast("long")


def estimate_tokens_plain(text: Column) -> Column:
    return F.floor(F.coalesce(F.length(text), F.lit(0)) / 4).cast("long")


def truncate(text: Column, limit: int, suffix: str = "...") -> Column:
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit(suffix))).otherwise(text)


def short_dash_service(short: Column, service: Column) -> Column:
    return F.trim(F.concat(short, F.lit(" - "), service))


def append_if_missing(summary: Column, service: Column) -> Column:
    """Name the affected service at the end unless the summary mentions it already."""
    present = F.contains(F.lower(summary), F.lower(service)) | (service == "")
    return F.when(~present, F.concat(summary, F.lit(" - "), service)).otherwise(summary)


def strip_quotes(text: Column) -> Column:
    return F.regexp_replace(text, r"""^["']+|["']+$""", "")


def leading_words(text: Column, limit: int = SUMMARY_WORDS) -> Column:
    """Built-in summary of the whole text: its most frequent words, the earlier one first where they are equally frequent.

    Words become Python objects for some texts at a time, however many texts a batch has.
    """

    @F.arrow_udf("string")
    def leading(words: pa.Array) -> pa.Array:
        out = []
        for at in range(0, len(words), SUMMARY_TEXTS):
            part = words.slice(at, SUMMARY_TEXTS)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False)).tolist()
            flat = part.flatten().to_numpy(zero_copy_only=False).tolist()
            for valid, lo, hi in zip(part.is_valid().to_pylist(), [0, *ends], ends):
                out.append(" ".join(x for x, _ in Counter(flat[lo:hi]).most_common(limit)) if valid else None)
        return pa.array(out, pa.string())

    return leading(F.filter(F.split(text, SPACES), lambda w: w != ""))


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, SPACES), lambda w: w != "")).cast("long")


def classify_error(message: Column) -> Column:
    low = F.lower(message)

    def any_of(needles: tuple[str, ...]) -> Column:
        return reduce(lambda a, b: a | b, [F.contains(low, F.lit(n)) for n in needles])

    out = None
    for name, needles in _ERROR_RULES:
        out = F.when(any_of(needles), name) if out is None else out.when(any_of(needles), name)
    return out.otherwise(OTHER_ERROR)


def center_slug(name: Column) -> Column:
    """Slug used in artefact paths."""
    out = F.replace(F.lower(name), F.lit(" "), F.lit("-"))
    return F.replace(F.replace(out, F.lit(","), F.lit("")), F.lit("&"), F.lit("and"))


def center_slug_plain(name: Column) -> Column:
    return F.translate(F.lower(name), " _", "--")


def versioned_name(*parts: Column | str) -> Column:
    return F.concat_ws("_", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def artefact_path(kind: str, version: Column, digest: Column, center: Column) -> Column:
    return F.format_string(f"models/%s/%s/{kind}_%s", center_slug(center), version, digest)


def table_reference(ref: Column, default_catalog: str, default_schema: str = "default") -> Column:
    """Split a dotted table name into catalog, schema and table, with defaults for missing parts."""
    parts = F.split(ref, r"\.")
    n = F.size(parts)
    return F.struct(
        F.when(n == 3, parts[0]).otherwise(F.lit(default_catalog)).alias("catalog"),
        F.when(n == 3, parts[1]).when(n == 2, parts[0]).otherwise(F.lit(default_schema)).alias("schema"),
        F.when(n == 3, F.get(parts, F.lit(2))).when(n == 2, F.get(parts, F.lit(1))).otherwise(parts[0]).alias("table"),
    )


def contains_ignore_case(text: Column, needle: str | Column) -> Column:
    needle = F.lit(needle) if isinstance(needle, str) else needle
    return F.coalesce(F.contains(F.lower(text), F.lower(needle)), F.lit(False))


def chunks(text: Column, size: int = CHUNK_CHARS) -> Column:
    """Whole text as an array of pieces of ``size`` characters."""
    last = F.greatest(F.ceil(F.length(text) / size).cast("int") - 1, F.lit(0))
    return F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.substring(text, i * size + 1, F.lit(size)),
    )


def fill_template(template: str, **values: Column) -> Column:
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value)
    return out


def bullet_list(samples: Column) -> Column:
    return F.array_join(F.transform(samples, lambda s: F.concat(F.lit("- "), s)), "\n")


def strip_fence(reply: Column) -> Column:
    return strip(F.regexp_replace(strip(reply), FENCE, ""))


def tokens(text: Column) -> Column:
    """Lower-cased words of two or more characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
