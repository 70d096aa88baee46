"""All named queries of the core, with the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from commgraph.plans import hotkeys, knowledge, scalars, stages

MODULES = (hotkeys, scalars, knowledge, stages)
FLAGSHIP = "ref_Q3_Q12_sentiment_over_time"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: q for m in MODULES for k, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.ORACLE.items()}
