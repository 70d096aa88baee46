"""Pipeline state: an append-only log folded to stage rows, and those to states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commgraph.vocab import STAGES


def stage_order(stage: Column) -> Column:
    o = F.lit(None).cast("int")
    for k, s in enumerate(STAGES):
        o = F.when(stage == s, k).otherwise(o)
    return o


def stage_at(order: Column) -> Column:
    return F.when(order.isNotNull(), F.element_at(F.array(*[F.lit(s) for s in STAGES]), F.coalesce(order, F.lit(0)) + 1))


def next_stage(latest: Column, filtered: Column) -> Column:
    o = stage_order(latest)
    return F.when(filtered | (o >= len(STAGES) - 1), F.lit(None)).otherwise(stage_at(o + 1))


def fold_log(log: DataFrame, article: str = "article_id", stage: str = "stage", seq: str = "seq") -> DataFrame:
    """One row per (article, stage) from log rows (status, error_message,
    completed_at, processing_time, file_path, metadata as JSON text): status and
    error of the last row, failures counted, the last values that aren't null of
    the rest, metadata merged key by key with later values winning.

    ``seq`` orders rows and is unique within a key. Rows replayed whole change
    nothing but the count of failures, so a log is deduplicated by seq first.
    """
    rows = log.dropDuplicates([article, stage, seq])

    def last(c: str) -> Column:
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.col(seq))).alias(c)

    # metadata is merged entry by entry, so a key with a long log is spread over all tasks
    entries = rows.where("metadata IS NOT NULL").select(article, stage, seq, F.explode_outer(F.from_json("metadata", "map<string,string>")).alias("_k", "_v"))
    merged = (
        entries.groupBy(article, stage, "_k")
        .agg(F.max_by("_v", seq).alias("_v"))
        .groupBy(article, stage)
        .agg(F.map_from_entries(F.collect_list(F.when(F.col("_k").isNotNull(), F.struct("_k", "_v")))).alias("metadata"))
    )
    folded = rows.groupBy(article, stage).agg(
        F.max_by("status", seq).alias("status"),
        F.max_by("error_message", seq).alias("error_message"),
        F.sum(F.when(F.col("status") == "FAILED", 1).otherwise(0)).alias("retry_count"),
        last("completed_at"),
        last("processing_time"),
        last("file_path"),
    )
    return folded.join(merged, [article, stage], "left")


def article_fields(stage_rows: DataFrame, articles: DataFrame, key: str, fields: list[str], article: str = "article_id") -> DataFrame:
    """Stage rows with the fields of their article, null where it isn't known. Of
    several rows of an article the one with the least fields stands."""
    own = articles.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(article)).agg(F.min(F.struct(*fields)).alias("_f"))
    return stage_rows.join(own, article, "left").select(*stage_rows.columns, *[F.col(f"_f.{f}").alias(f) for f in fields])


def rebuild_states(stage_rows: DataFrame, article: str = "article_id") -> DataFrame:
    """One state per article: the highest stage done (gaps allowed), the stage
    after it (none after FILTERED), the error of the highest stage that failed,
    total time and retries. One aggregation, whatever the number of articles."""
    done = F.col("status").isin("COMPLETED", "FILTERED")
    o = stage_order(F.col("stage"))
    s = stage_rows.withColumn("o", o).groupBy(article).agg(
        F.max(F.when(done, F.col("o"))).alias("latest"),
        F.max(F.when(F.col("status") == "FILTERED", 1).otherwise(0)).alias("filtered"),
        F.max_by("error_message", F.when(F.col("status") == "FAILED", F.col("o"))).alias("error_message"),
        F.round(F.sum("processing_time"), 2).alias("t"),
        F.sum("retry_count").alias("retry_count"),
    )
    latest = stage_at(F.col("latest"))
    return s.select(
        article,
        latest.alias("latest_completed_stage"),
        F.when(F.col("latest").isNotNull(), next_stage(latest, F.col("filtered") == 1)).alias("next_stage"),
        (F.col("filtered") == 1).alias("is_filtered"),
        "error_message",
        F.when(F.col("t") != 0, F.col("t")).alias("processing_time_seconds"),
        "retry_count",
    )


def ready_for(states: DataFrame, stage: str) -> DataFrame:
    return states.where(F.col("next_stage") == stage)


def last_rows(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key, by ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")
