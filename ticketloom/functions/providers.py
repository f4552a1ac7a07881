"""Pluggable text summaries and embeddings.

Without a provider the summary is the most frequent words of the text, the vector a hashed bag of all its words of
unit length. A provider is a callable on a list of texts; it is called on Arrow batches in the tasks, and a
batch it refuses is halved until the rows that fail stand alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.functions import text

DEFAULT_DIMENSIONS = 256
Provider = Callable[[list[str]], Sequence]


def _call(provider: Provider, texts: list[str], attempts: int) -> list[tuple[object, str | None]]:
    """Results and error messages of one batch."""
    error: Exception | None = None
    for _ in range(attempts):
        try:
            results = list(provider(texts))
            if len(results) != len(texts):
                raise ValueError(f"batch of {len(texts)} texts gave {len(results)} results")
            return [(r, None) for r in results]
        except Exception as caught:  # a provider may fail in any way; the row keeps the message
            error = caught
    if len(texts) == 1:
        return [(None, str(error))]
    half = len(texts) // 2
    return _call(provider, texts[:half], attempts) + _call(provider, texts[half:], attempts)


def weighted_mean(vectors_: list[Sequence[float]], weights: list[int]) -> list[float]:
    """Mean vector of the pieces of a text, by their lengths."""
    return np.average(np.asarray(vectors_, float), axis=0, weights=weights).tolist()


def _apply(
    df: DataFrame, column: str, provider: Provider, out: str, kind: T.DataType, batch: int, attempts: int,
    piece_chars: int | None = None, merge: Callable[[list, list[int]], object] | None = None,
):
    """Call the provider on every text; a text longer than ``piece_chars`` goes in pieces whose results are merged."""
    schema = T.StructType([*df.schema.fields, T.StructField(out, kind), T.StructField("error_message", T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            wanted = frame[column].notna()
            owners: list[int] = []
            pieces: list[str] = []
            for row, text_ in zip(np.flatnonzero(wanted), frame.loc[wanted, column]):
                step = piece_chars or max(len(text_), 1)
                mine = [text_[i : i + step] for i in range(0, max(len(text_), 1), step)]
                pieces += mine
                owners += [row] * len(mine)
            answers: list[tuple[object, str | None]] = []
            for i in range(0, len(pieces), batch):
                answers.extend(_call(provider, pieces[i : i + batch], attempts))
            values: list[object] = [None] * len(frame)
            messages: list[str | None] = [None] * len(frame)
            parts: dict[int, list[tuple[object, int]]] = {}
            for row, piece, (value, message) in zip(owners, pieces, answers):
                parts.setdefault(row, []).append((value, len(piece)))
                messages[row] = messages[row] or message
            for row, found in parts.items():
                if messages[row] is None:
                    values[row] = found[0][0] if len(found) == 1 else merge(*map(list, zip(*found)))
            frame[out] = pd.Series(values, index=frame.index, dtype=object)
            frame["error_message"] = pd.Series(messages, index=frame.index, dtype=object)
            yield frame

    return df.mapInPandas(run, schema)


def hashed_words(df: DataFrame, column: str, out: str = "embedding", dims: int = DEFAULT_DIMENSIONS) -> DataFrame:
    """Unit-length hashed bag of words."""
    words = df.withColumn("_words", F.coalesce(text.tokens(F.col(column)), F.array().cast("array<string>")))
    counted = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dims).transform(words)
    scaled = Normalizer(inputCol="_counts", outputCol="_unit", p=2.0).transform(counted)
    return scaled.withColumn(out, vector_to_array("_unit")).drop("_words", "_counts", "_unit")


def embed(
    df: DataFrame,
    column: str = "combined_incidents_summary",
    provider: Provider | None = None,
    dims: int = DEFAULT_DIMENSIONS,
    batch: int = 50,
    attempts: int = 3,
    zero_on_failure: bool = False,
    out: str = "embedding",
) -> DataFrame:
    """Add a vector, ``embedding_status`` and ``error_class``. Rows stay tied to their key; none is dropped.

    The whole text counts: one that is too long for a provider is embedded in pieces, and its vector is their mean by
    length. A text with a failed piece has failed.
    """
    from ticketloom.operators.preparation import embedding_input

    staged = embedding_input(df, column)
    if provider is None:
        done = hashed_words(staged, "prepared", out, dims).withColumn("error_message", F.lit(None).cast("string"))
        done = done.withColumn(out, F.when(F.col("status") != "empty", F.col(out)))
    else:
        kind = T.ArrayType(T.DoubleType(), containsNull=False)
        done = _apply(staged, "prepared", provider, out, kind, batch, attempts, 4 * text.EMBEDDING_TOKENS, weighted_mean)
    failed = F.col("error_message").isNotNull()
    vector: Column = F.col(out)
    if zero_on_failure:
        vector = F.coalesce(vector, F.array_repeat(F.lit(0.0), dims))
    return (
        done.withColumn("embedding_status", F.when(failed, "failed").otherwise(F.col("status")))
        .withColumn("error_class", F.when(failed, text.classify_error(F.col("error_message"))))
        .withColumn(out, vector)
        .withColumn("error_message", F.when(failed, F.col("error_message")))
        .drop("status", "prepared")
    )


def summarize(
    df: DataFrame,
    column: str,
    provider: Provider | None = None,
    out: str = "combined_incidents_summary",
    batch: int = 10,
    attempts: int = 3,
) -> DataFrame:
    """Add a summary; short texts are their own summary, and a failed call leaves the text itself."""
    source = F.col(column)
    is_short = F.length(source) < text.SUMMARY_SKIP_CHARS
    if provider is None:
        return df.withColumn(out, F.when(is_short, source).otherwise(text.leading_words(F.when(~is_short, source)))).withColumn(
            "summary_source", F.when(is_short, "short_text").otherwise("built_in")
        )
    staged = df.withColumn("_input", F.when(~is_short, source))
    done = _apply(staged, "_input", provider, "_summary", T.StringType(), batch, attempts)
    return (
        done.withColumn(out, F.coalesce(text.strip_quotes(F.col("_summary")), source))
        .withColumn(
            "summary_source",
            F.when(is_short, "short_text")
            .when(F.col("error_message").isNotNull(), "provider_failed")
            .otherwise("summarize"),
        )
        .drop("_input", "_summary", "error_message")
    )
