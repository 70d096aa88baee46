"""Counting the tokens of a public tokenizer.

The vocabulary file's path is a parameter; files stay where they are installed.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

VOCABULARY = os.environ.get("COMMGRAPH_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: How the vocabulary of byte-level BPE was made to split text (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words whose counts a worker keeps.
KEPT = 400_000
EDGE = re.compile(r"^\s|\s$")


@lru_cache(maxsize=2)
def counter(path: str) -> Callable[[str], int]:
    """Tokens of a text, by byte-level BPE ranks in ``path``.

    The pattern never joins what stands on both sides of a single space between
    two other characters, so a text is the sum of its words, and words recur.
    """
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    coding = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    class Known(dict):
        def __missing__(self, word: str) -> int:
            n = len(coding.encode_ordinary(" " + word))
            if len(self) < KEPT and len(word) < 64:
                self[word] = n
            return n

    known = Known()

    def count(text: str) -> int:
        parts = text.split(" ")
        if len(parts) > 1:
            first, rest = parts[0], parts[1:]
            # other white space beside a space binds differently: such a text is coded whole
            if first and not EDGE.search(first) and "" not in parts and not any(map(odd, rest)):
                return len(coding.encode_ordinary(first)) + sum(map(known.__getitem__, rest))
        return len(coding.encode_ordinary(text))

    def odd(word: str) -> bool:
        return word[0].isspace() or word[-1].isspace()

    return count


def token_count(text: Column | str, vocabulary: str = VOCABULARY) -> Column:
    """Number of tokens of a text; null has 0. Whole texts are counted."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        n = counter(vocabulary)
        for s in batches:
            yield pd.Series([n(t) if isinstance(t, str) else 0 for t in s], dtype="int64")

    return count(F.col(text) if isinstance(text, str) else text)
