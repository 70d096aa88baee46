"""Chunks of long content for extraction."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Content below THRESHOLD is one chunk; else chunks of SIZE characters that overlap by OVERLAP (fixed values).
THRESHOLD, SIZE, OVERLAP = 80_000, 40_000, 500
SEPARATORS = ("\n\n", "\n", " ")


def spans_of(text: str, start: int, end: int, size: int, level: int = 0) -> Iterator[tuple[int, int]]:
    """Parts of text[start:end] of at most ``size``, separators kept at their
    ends; a stretch without any separator stays whole, however long."""
    if end - start <= size or level == len(SEPARATORS):
        yield start, end
        return
    sep, at = SEPARATORS[level], start
    while at < end:
        found = text.find(sep, at, end)
        stop = end if found < 0 else found + len(sep)
        yield from spans_of(text, at, stop, size, level + 1)
        at = stop


def chunk(text: str, threshold: int = THRESHOLD, size: int = SIZE, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """(start, end) of the chunks, which cover the text in order. Each after the
    first begins with whole parts of the one before, of at most ``overlap``
    characters together."""
    if len(text) < threshold:
        return [(0, len(text))]
    out: list[tuple[int, int]] = []
    parts: list[tuple[int, int]] = []
    for a, b in spans_of(text, 0, len(text), size):
        if parts and b - parts[0][0] > size:
            out.append((parts[0][0], parts[-1][1]))
            while parts and (parts[-1][1] - parts[0][0] > overlap or b - parts[0][0] > size):
                parts.pop(0)
        parts.append((a, b))
    out.append((parts[0][0], parts[-1][1]))
    return out


def chunked(rows: DataFrame, key: str, text: str, threshold: int = THRESHOLD, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """(key, chunk_no from 0, start, chunk) of each row. Shorter content stays in
    the JVM as one chunk; null content has none; repeated rows give repeats."""
    own = rows.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t IS NOT NULL")
    kind = own.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k, t in zip(b["k"], b["t"]):
                cs = chunk(t, threshold, size, overlap)
                yield pd.DataFrame({"k": [k] * len(cs), "chunk_no": pd.Series(range(len(cs)), dtype="int32"), "start": pd.Series([a for a, _ in cs], dtype="int32"), "chunk": [t[a:z] for a, z in cs]})

    short = own.where(F.length("t") < threshold).select("k", F.lit(0).alias("chunk_no"), F.lit(0).alias("start"), F.col("t").alias("chunk"))
    return short.unionByName(own.where(F.length("t") >= threshold).mapInPandas(run, f"k {kind}, chunk_no int, start int, chunk string")).withColumnRenamed("k", key)
