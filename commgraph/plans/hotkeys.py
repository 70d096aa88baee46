"""Problem 1: exact results per speaker where a few speakers hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commgraph.operators.hotkeys import heavy_keys, key_counts, key_profile
from commgraph.runtime import table

RELATIONS = ("claims", "node_topic")
SHARE = 0.03


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = None
    for r in RELATIONS:
        own = key_counts(table(spark, sf_dir, r), "speaker").withColumn("relation", F.lit(r))
        counts = own if counts is None else counts.unionByName(own)
    return heavy_keys(counts, "speaker", "relation", "n_rows", SHARE).select("relation", "speaker")


def p1_claims_by_speaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_profile(
        table(spark, sf_dir, "claims"),
        "speaker",
        distinct=("topic", "entity_name", "comm_id"),
        measures={
            "n_positive": F.sum(F.when(F.col("sentiment") == "positive", 1).otherwise(0)),
            "n_negative": F.sum(F.when(F.col("sentiment") == "negative", 1).otherwise(0)),
            "n_passages": F.sum(F.coalesce(F.when(F.col("passages").isNotNull(), F.size("passages")), F.lit(0))),
            "first_claim": F.min("claim_id"),
            "last_claim": F.max("claim_id"),
        },
    )


def p1_topics_by_speaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_profile(
        table(spark, sf_dir, "node_topic"),
        "speaker",
        distinct=("topic", "topic_id"),
        measures={"n_summaries": F.sum(F.when(F.length("topic_summary") > 0, 1).otherwise(0))},
    )


QUERIES = {f.__name__: f for f in (p1_found, p1_claims_by_speaker, p1_topics_by_speaker)}
ORACLE = {
    "p1_found": """
        SELECT relation, speaker FROM (
            SELECT 'claims' AS relation, speaker, count(*) AS n, (SELECT count(*) FROM claims) AS total FROM claims GROUP BY speaker
            UNION ALL
            SELECT 'node_topic', speaker, count(*), (SELECT count(*) FROM node_topic) FROM node_topic GROUP BY speaker)
        WHERE speaker IS NOT NULL AND n * 100 >= total * 3""",
    "p1_claims_by_speaker": """
        SELECT speaker, count(*) AS n_rows, count(DISTINCT topic) AS n_topic, count(DISTINCT entity_name) AS n_entity_name,
               count(DISTINCT comm_id) AS n_comm_id,
               sum(CASE WHEN sentiment = 'positive' THEN 1 ELSE 0 END)::BIGINT AS n_positive,
               sum(CASE WHEN sentiment = 'negative' THEN 1 ELSE 0 END)::BIGINT AS n_negative,
               sum(coalesce(len(passages), 0))::BIGINT AS n_passages, min(claim_id) AS first_claim, max(claim_id) AS last_claim
        FROM claims WHERE speaker IS NOT NULL GROUP BY speaker""",
    "p1_topics_by_speaker": """
        SELECT speaker, count(*) AS n_rows, count(DISTINCT topic) AS n_topic, count(DISTINCT topic_id) AS n_topic_id,
               sum(CASE WHEN length(topic_summary) > 0 THEN 1 ELSE 0 END)::BIGINT AS n_summaries
        FROM node_topic WHERE speaker IS NOT NULL GROUP BY speaker""",
}
