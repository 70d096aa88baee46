"""Column expressions on text; all stay in the JVM."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def slugify(text: Column | str, limit: int | None = None) -> Column:
    """Lower case words joined by hyphens; cut to ``limit`` last, so a hyphen may end it."""
    s = F.regexp_replace(F.lower(F.trim(_col(text))), r"(?U)[^\w\s-]", "")
    s = F.regexp_replace(F.regexp_replace(s, r"(?U)[-\s]+", "-"), "^-+|-+$", "")
    return F.substring(s, 1, limit) if limit else s


def word_count(text: Column | str) -> Column:
    """Words between white space; empty text has 0, null gives null."""
    t = F.regexp_replace(_col(text), r"(?U)^\s+|\s+$", "")
    return F.when(t == "", 0).otherwise(F.size(F.split(t, r"(?U)\s+"))) * F.when(t.isNotNull(), 1)


def is_blank(text: Column | str) -> Column:
    return F.coalesce(F.regexp_replace(_col(text), r"(?U)\s+", "") == "", F.lit(True))


def first_nonblank(*texts: Column | str) -> Column:
    """The first text that isn't blank, else null."""
    return F.coalesce(*[F.when(~is_blank(t), _col(t)) for t in texts])


def first_tokens(text: Column | str, n: int) -> Column:
    """The first ``n`` words and punctuation marks, joined by spaces."""
    return F.array_join(F.slice(F.regexp_extract_all(_col(text), F.lit(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"), F.lit(0)), 1, n), " ")


#: Blocks a sample of a page leaves out (fixed values).
NOT_SAMPLED = ("head", "script", "style", "nav", "footer")


def without_blocks(source: Column | str) -> Column:
    """A page's source without the blocks above, up to each one's end."""
    out = _col(source)
    for tag in NOT_SAMPLED:
        out = F.regexp_replace(out, rf"(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>", "")
    return out


def middle_sample(text: Column | str, most: int = 30_000) -> Column:
    """From a quarter of the text on, ``most`` characters or up to three quarters."""
    t = _col(text)
    n = F.length(t)
    a = F.floor(n * 0.25).cast("int")
    b = F.least(a + F.lit(most), F.floor(n * 0.75).cast("int"))
    return F.substring(t, a + 1, b - a)


def sentences(text: Column | str) -> Column:
    return F.filter(F.split(_col(text), r"(?<=[.!?])\s+"), lambda s: s != "")


def embedding(text: Column, dims: int = 256) -> Column:
    """A unit vector of hashed words, the default where no model is given; its
    table of hashes is made once a worker. Empty and null text have a zero vector."""

    @F.pandas_udf("array<double>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, int] = {}
        for s in batches:
            out = []
            for t in s:
                v = np.zeros(dims)
                for w in (t or "").lower().split():
                    v[known.setdefault(w, zlib.crc32(w.encode("utf-8", "surrogatepass")) % dims)] += 1
                n = np.linalg.norm(v)
                out.append(v / n if n else v)
            if len(known) > 500_000:
                known.clear()
            yield pd.Series(out)

    return embed(F.coalesce(text, F.lit("")))
