"""Retries, and faults that stay with the row or group they come from."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from typing import TypeVar

import pandas as pd
from pyspark.sql import DataFrame

from commgraph.config import RetryPolicy

T = TypeVar("T")


def retry(work: Callable[[], T], policy: RetryPolicy, sleep: Callable[[float], None] = time.sleep) -> T:
    """``work()``, tried again after a delay with jitter as often as the policy
    says; the last error is raised."""
    for n in range(policy.retries + 1):
        try:
            return work()
        except Exception:
            if n == policy.retries:
                raise
            sleep(policy.delay * (1 + policy.jitter * random.random()))
    raise AssertionError


def isolated(rows: DataFrame, keep: list[str], output: str, work: Callable[[dict], dict], policy: RetryPolicy = RetryPolicy(0, 0.0)) -> DataFrame:
    """``keep``, the columns ``output`` that ``work`` gives for each row, and
    ``error_message``: a row that fails after all retries has null outputs and
    its error, the others go on. ``output`` is a schema like ``a int, b string``."""
    kept = rows.select(*keep).schema
    names = [p.split()[0] for p in output.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.to_dict("records"):
                try:
                    got = retry(lambda r=r: work(r), policy)
                    out.append([*(got[n] for n in names), None])
                except Exception as e:
                    out.append([*(None for _ in names), f"{type(e).__name__}: {e}"])
            made = pd.DataFrame(out, columns=[*names, "error_message"], index=b.index, dtype=object)
            yield pd.concat([b[keep], made], axis=1)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return rows.mapInPandas(run, f"{schema}, {output}, error_message string")
