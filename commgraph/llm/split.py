"""Splitting oversized texts at natural boundaries.

A text over the limit is taken apart along a hierarchy of separators: sections
(two or more blank lines), paragraphs (a blank line), lines, sentences, words
and, only for a stretch of more than the limit without any white space, single
characters. The recursion is over the levels: as many whole sections as fit are
packed into a piece; only where not even one more ends within the limit is the
next one taken apart into paragraphs, and so on down. Each next piece
begins with the last ``overlap`` characters of the one before, so that piece
k+1 without its overlap continues exactly where piece k ends and the whole text
can be put together again. The overlap shrinks only where the next unbroken
stretch would not fit beside it, and is 0 after a cut of an unbroken stretch
only if the limit leaves no room.

Characters are Unicode code points. White space is space, tab, carriage return
and line feed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commgraph.llm.frames import frame

LIMIT, OVERLAP = 4000, 200

#: Ends of natural units, from the largest to the smallest: the end of a match is where a cut may fall.
SEPARATORS = (
    ("section", re.compile(r"(?:(?:\r\n|\n|\r)[ \t]*){3,}")),
    ("paragraph", re.compile(r"(?:(?:\r\n|\n|\r)[ \t]*){2,}")),
    ("line", re.compile(r"\r\n|\n|\r")),
    ("sentence", re.compile(r"[.!?…。！？]+[\"'”’»)\]]*[ \t\r\n]+")),
    ("word", re.compile(r"[ \t\r\n]+")),
)
STRETCH = re.compile(r"[^ \t\r\n]+")


def packed(text: str, low: int, high: int, level: int = 0) -> tuple[int, str]:
    """Where a piece that may end in (low, high] ends, and at what kind of unit:
    after the last unit of this level that fits, else, where the next one is too
    large, after the last part of it that fits one level down. ``forced`` at
    ``high`` where no white space stands in the whole reach."""
    if level == len(SEPARATORS):
        return high, "forced"
    name, pattern = SEPARATORS[level]
    last = max((m.end() for m in pattern.finditer(text, low, high)), default=low)
    return (last, name) if last > low else packed(text, low, high, level + 1)


def pieces(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> Iterator[tuple[int, int, int, str]]:
    """(start, end, overlap with the piece before, kind of the cut at end).

    The last piece's cut is ``end``; a text within the limit is one such piece,
    an empty one too.
    """
    n, done, keep = len(text), 0, 0
    if not 0 <= overlap < limit:
        raise ValueError("0 <= overlap < limit")
    while True:
        # the unbroken stretch after ``done`` decides how much overlap fits
        if done and keep and done + (limit - keep) < n:
            m = STRETCH.match(text, done, done + limit + 1)
            ahead = (m.end() - done) if m else 0
            if ahead <= limit:
                # room for the stretch and one white space after it where there is one
                keep = max(0, min(keep, limit - ahead - (1 if done + ahead < n and ahead < limit else 0)))
        start = done - keep
        if n - start <= limit:
            yield start, n, keep, "end"
            return
        high = start + limit
        if high - 1 > done and text[high - 1 : high + 1] == "\r\n":
            high -= 1  # one line end, not to be torn
        end, kind = packed(text, done, high)
        if kind == "forced" and (m := STRETCH.match(text, done)) and m.end() - done <= limit:
            # a stretch that just fits: it ends where white space begins
            end, kind = m.end(), "word"
        yield start, end, keep, kind
        done, keep = end, min(overlap, end)


def longest_stretch(text: str) -> int:
    return max((m.end() - m.start() for m in STRETCH.finditer(text)), default=0)


def split_oversized(df: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """One row per piece: (key, piece_no, n_pieces, start, overlap, cut, piece).

    ``piece_no`` counts from 1. ``cut`` is the kind of boundary at the end of
    the piece. Texts within the limit come out unchanged as one piece and never
    leave the JVM; only longer ones go to Python, one row at a time, so a very
    long text needs memory for itself alone. Null text gives one row with a
    null piece, so that no record is lost; empty text one empty piece. Repeated
    rows give repeated pieces. Other columns of ``df`` are left out.
    """
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    short = rows.where(F.col("text").isNull() | (F.length("text") <= limit)).select(
        "key", F.lit(1).alias("piece_no"), F.lit(1).alias("n_pieces"), F.lit(0).cast("long").alias("start"), F.lit(0).alias("overlap"), F.lit("end").alias("cut"), F.col("text").alias("piece")
    )

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k, t in zip(b["key"], b["text"]):
                ps = list(pieces(t, limit, overlap))
                for at in range(0, len(ps), 2000):
                    some = ps[at : at + 2000]
                    yield frame(
                        key=[k] * len(some),
                        piece_no=list(range(at + 1, at + len(some) + 1)),
                        n_pieces=[len(ps)] * len(some),
                        start=[p[0] for p in some],
                        overlap=[p[2] for p in some],
                        cut=[p[3] for p in some],
                        piece=[t[p[0] : p[1]] for p in some],
                    )

    kind = rows.schema["key"].dataType.simpleString()
    long = rows.where(F.length("text") > limit).mapInPandas(cut_up, f"key {kind}, piece_no int, n_pieces int, start long, overlap int, cut string, piece string")
    return short.unionByName(long).withColumnRenamed("key", key)


def cut_kinds(df: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(key, cut) of each key with an oversized text, once however often its row
    repeats: ``forced`` if some piece had to end inside an unbroken stretch."""
    return (
        split_oversized(df.where(F.length(text) > limit), key, text, limit, overlap)
        .groupBy(key)
        .agg(F.max(F.when(F.col("cut") == "forced", 1).otherwise(0)).alias("f"))
        .select(key, F.when(F.col("f") == 1, "forced").otherwise("boundary").alias("cut"))
    )


def put_together(df: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(key, n_chars, <text>_md5, fits, laps): each text as its pieces make it again,
    overlaps left out, whether all pieces keep to the limit, and whether each
    begins with no more than ``overlap`` characters of the one before. ``df`` has
    one row per text; two texts of one key are told apart by their digest."""
    named = df.select(F.struct(F.col(key).alias("k"), F.md5(F.col(text).cast("binary")).alias("d")).alias("k"), F.col(text).alias("t"))
    part = F.struct("piece_no", F.expr("substring(piece, overlap + 1)").alias("own"))
    return (
        split_oversized(named, "k", "t", limit, overlap)
        .groupBy("k")
        .agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda p: p["own"]), "").alias("t"),
            F.bool_and(F.coalesce(F.length("piece"), F.lit(0)) <= limit).alias("fits"),
            F.bool_and(F.col("overlap").between(0, overlap)).alias("laps"),
            F.max("piece").isNull().alias("none"),
        )
        .select(F.col("k.k").alias(key), F.when(F.col("none"), 0).otherwise(F.length("t")).cast("long").alias("n_chars"), F.when(~F.col("none"), F.md5(F.col("t").cast("binary"))).alias(f"{text}_md5"), "fits", "laps")
    )
