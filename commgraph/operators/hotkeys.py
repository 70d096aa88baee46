"""Per-key results where a few keys hold most of the rows.

Every result is built from algebraic aggregates, so that each task folds its
rows into a hash table of key states first (Spark's partial aggregation, which
spills to a sort when the table outgrows its memory) and only those compact
states are shuffled: a key with a billion rows sends one state per task. Exact
distinct counts are taken in two such steps, over (key, value) and then over
key, so that the values of a hot key are spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_counts(df: DataFrame, key: str, n: str = "n_rows") -> DataFrame:
    """Rows of each key, null included as a key of its own.

    An empty table gives no rows. Repeated rows count as often as they stand.
    """
    return df.groupBy(F.col(key)).agg(F.count(F.lit(1)).alias(n))


def key_profile(
    df: DataFrame,
    key: str,
    distinct: Sequence[str] = (),
    measures: dict[str, Column] | None = None,
    n: str = "n_rows",
) -> DataFrame:
    """One row per non-null key: rows, exact distinct counts and ``measures``.

    ``distinct`` names columns; column c gives ``n_<c>``, the number of its
    non-null values. ``measures`` maps output names to algebraic aggregate
    expressions (sum, count, min, max). Columns of ``df`` that aren't named do
    not matter, whatever they are called. No rows in, no rows out.

    The distinct columns are unpivoted in one pass, so that the table is read
    and shuffled once for all of them.
    """
    measures = measures or {}
    rows = df.where(F.col(key).isNotNull())
    base = rows.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias(n), *[m.alias(a) for a, m in measures.items()])
    if distinct:
        pairs = (
            rows.select(
                F.col(key).alias("k"),
                F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(distinct)])).alias("p"),
            )
            .where("p.v IS NOT NULL")
            .groupBy("k", "p.i", "p.v")
            .agg(F.count(F.lit(1)).alias("m"))
        )
        counts = pairs.groupBy("k").agg(*[F.count(F.when(F.col("i") == i, 1)).alias(f"n_{c}") for i, c in enumerate(distinct)])
        base = base.join(counts, "k", "left").na.fill(0, [f"n_{c}" for c in distinct])
    return base.withColumnRenamed("k", key)


def heavy_keys(counts: DataFrame, key: str, by: str, n: str, share: float) -> DataFrame:
    """Non-null keys that hold at least ``share`` of the rows of their ``by``.

    ``counts`` is the union of :func:`key_counts` of several relations, tagged
    in ``by``. The totals come from the same partial states, null key counted
    in, and have one row per relation: that is what bounds the broadcast.
    """
    totals = counts.groupBy(by).agg(F.sum(n).alias("_total"))
    return counts.join(F.broadcast(totals), by).where(F.col(key).isNotNull() & (F.col(n) >= F.col("_total") * F.lit(share) - F.lit(1e-9))).drop("_total")
