"""A stage of the pipeline as a transformation of DataFrames with a log of its own."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commgraph.vocab import STAGES


@dataclass(frozen=True)
class Stage:
    """``transform`` maps items to items with ``error_message``, null where it went
    well. :meth:`run` gives its output and the log rows the state is folded from."""

    name: str
    transform: Callable[[DataFrame], DataFrame]

    def __post_init__(self) -> None:
        if self.name not in STAGES:
            raise ValueError(f"unknown stage {self.name}")

    def run(self, items: DataFrame, key: str, seq: str) -> tuple[DataFrame, DataFrame]:
        """(rows that went well, (article_id, stage, seq, status, error_message) of all)."""
        done = self.transform(items)
        failed = F.col("error_message").isNotNull()
        log = done.select(F.col(key).alias("article_id"), F.lit(self.name).alias("stage"), F.col(seq).alias("seq"), F.when(failed, "FAILED").otherwise("COMPLETED").alias("status"), "error_message")
        return done.where(~failed).drop("error_message"), log


def guard(rows: DataFrame, allowed: list[str]) -> DataFrame:
    """``rows`` as they are; columns a table doesn't have are refused."""
    unknown = sorted(set(rows.columns) - set(allowed))
    if unknown:
        raise ValueError(f"unknown columns: {unknown}")
    return rows
