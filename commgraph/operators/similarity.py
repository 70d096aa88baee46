"""Greedy fuzzy deduplication within groups, and line differences."""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OVER, AT_LEAST = 0.85, 0.9


def ratio_over(a: str, b: str, least: float, strict: bool) -> bool:
    """Whether the matching ratio passes ``least``; cheap upper bounds first, which lose nothing."""
    n = len(a) + len(b)
    if n and 2 * min(len(a), len(b)) / n < least:
        return False
    m = difflib.SequenceMatcher(None, a, b)
    if m.quick_ratio() < least:
        return False
    r = m.ratio()
    return r > least if strict else r >= least


def keep_first(texts: list[str], least: float = OVER) -> list[bool]:
    """In order: a text goes if it is more than ``least`` like one that was kept."""
    kept: list[str] = []
    out = []
    for t in texts:
        ok = not any(ratio_over(t, k, least, True) for k in kept)
        out.append(ok)
        if ok:
            kept.append(t)
    return out


def keep_longest(texts: list[str], least: float = AT_LEAST) -> list[str]:
    """Longest first: a text goes if it stands in one that was kept or is at
    least ``least`` like it. Ties of length in text order."""
    kept: list[str] = []
    for t in sorted(set(texts), key=lambda t: (-len(t), t)):
        if not any(t in k or ratio_over(t, k, least, False) for k in kept):
            kept.append(t)
    return kept


def dedup_passages(rows: DataFrame, keys: list[str], order: str, text: str, least: float = OVER) -> DataFrame:
    """The passages kept of each group of ``keys``, in order; groups are those of
    one speaker and entity in one communication, which a document bounds. Null
    texts are dropped."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keys, order, text).schema)

    def greedy(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([order, text])
        return pdf[keep_first(list(pdf[text]), least)]

    own = rows.select(*keys, order, text).where(F.col(text).isNotNull()).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    # a passage alone in its group stays in the JVM; the rest is already brought together
    alone = own.where("_n = 1").drop("_n")
    return alone.unionByName(own.where("_n > 1").drop("_n").groupBy(*keys).applyInPandas(greedy, schema))


def distinct_passages(rows: DataFrame, key: str, texts: str) -> DataFrame:
    """(key, passage, place): of each row's list, those that :func:`keep_longest`
    keeps, longest first. Null and empty lists give none; null items are dropped."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(k, t, n) for k, ts in zip(b["k"], b["ts"]) for n, t in enumerate(keep_longest([t for t in ts if t is not None]))]
            yield pd.DataFrame({key: [o[0] for o in out], "passage": pd.Series([o[1] for o in out], dtype=object), "place": pd.Series([o[2] for o in out], dtype="int32")})

    own = rows.select(F.col(key).alias("k"), F.col(texts).alias("ts")).where(F.size(texts) > 0)
    return own.mapInPandas(run, f"{key} {kind}, passage string, place int")


def added_lines(old: str, new: str) -> list[str]:
    """Lines that ``new`` adds to ``old``."""
    return [line[2:] for line in difflib.Differ().compare(old.splitlines(), new.splitlines()) if line.startswith("+ ")]


def line_delta(old: Column, new: Column) -> Column:
    """The lines that ``new`` adds to ``old``, as a list; null counts as empty."""

    @F.pandas_udf("array<string>")
    def delta(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([added_lines(x or "", y or "") for x, y in zip(a, b)], dtype=object)

    return delta(F.coalesce(old, F.lit("")), F.coalesce(new, F.lit("")))
