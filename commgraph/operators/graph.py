"""Nodes and edges of the communication graph, built idempotently from stage tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commgraph.operators.state import last_rows


def speaker_nodes(registry: DataFrame) -> DataFrame:
    """One node per display name; of several rows the greatest profile stands."""
    r = registry.select(F.col("display_name").alias("speaker_id"), F.col("display_name").alias("name"), "role", "organization", "industry", "region").where("speaker_id IS NOT NULL")
    return last_rows(r, ["speaker_id"], [F.desc("role"), F.desc("organization"), F.desc("industry"), F.desc("region")])


def communication_nodes(items: DataFrame) -> DataFrame:
    """One node per id with its nine properties and its name, the title; unknown
    titles and dates say so, a missing address is empty. Of several rows of an
    id the greatest stands."""
    def known(c: str, default: str):
        return F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(default)).alias(c)

    own = items.where("id IS NOT NULL").select(
        "id", known("title", "Unknown"), known("content_type", "other"), known("content_date", "Unknown"), F.coalesce("source_url", F.lit("")).alias("source_url"), F.coalesce("full_text", F.lit("")).alias("full_text"),
        F.coalesce("word_count", F.lit(0)).alias("word_count"), F.coalesce("was_summarized", F.lit(False)).alias("was_summarized"), F.coalesce("compression_ratio", F.lit(1.0)).alias("compression_ratio"),
    )
    props = [c for c in own.columns if c != "id"]
    return own.groupBy("id").agg(F.max(F.struct(*props)).alias("n")).select("id", F.col("n.title").alias("name"), *[f"n.{c}" for c in props])


def broken_constraints(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(label, n_nodes, n_broken) of each node table: keys that are null or come more than once."""
    out = None
    for label, (nodes, key) in tables.items():
        by = nodes.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        own = by.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_nodes"), F.count(F.when((F.col("n") > 1) | F.col("k").isNull(), 1)).alias("n_broken")).select(F.lit(label).alias("label"), "n_nodes", "n_broken")
        out = own if out is None else out.unionByName(own)
    return out


def load_counters(items: DataFrame, registry: DataFrame, claims: DataFrame) -> DataFrame:
    """(kind, touched, n): how often a load merges or creates each kind of node
    and edge, a communication once for each of its speakers, and how many there are."""
    pair = items.select(F.col("id").alias("c"), F.explode("matched_speakers").alias("s")).distinct().join(registry.select(F.col("display_name").alias("s")).distinct(), "s", "left_semi")
    c = claims.where("comm_id IS NOT NULL AND speaker IS NOT NULL AND topic IS NOT NULL").select("claim_id", "comm_id", "speaker", "topic", "entity_name").distinct()
    topic = F.struct("comm_id", "speaker", "topic")
    both = topic.isNotNull() & F.col("entity_name").isNotNull()
    p = pair.agg(F.count(F.lit(1)).alias("p"), F.countDistinct("s").alias("s"), F.countDistinct("c").alias("c"))
    t = c.agg(
        F.countDistinct(topic).alias("t"), F.countDistinct(F.when(both, F.struct(topic, "entity_name"))).alias("te"), F.countDistinct("entity_name").alias("e"),
        F.count(F.when(both, 1)).alias("k"), F.countDistinct(F.when(both, F.struct("entity_name", "claim_id"))).alias("ek"),
    )
    from_pairs = [("Speaker", "p", "s"), ("Communication", "p", "c"), ("DELIVERED", "p", "p")]
    from_claims = [("Topic", "t", "t"), ("HAS_TOPIC", "t", "t"), ("Entity", "te", "e"), ("HAS_ENTITY", "te", "te"), ("Claim", "k", "k"), ("HAS_CLAIM", "k", "ek")]

    def rows(counts: DataFrame, kinds: list[tuple[str, str, str]]) -> DataFrame:
        return counts.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(x).alias("touched"), F.col(y).alias("n")) for k, x, y in kinds])).alias("x")).select("x.*")

    return rows(p, from_pairs).unionByName(rows(t, from_claims))


def topic_nodes(claims: DataFrame, summaries: DataFrame) -> DataFrame:
    """(topic_id, comm_id, speaker, topic, n_claims, topic_summary): one per
    communication, speaker and topic of the claims; without a summary of its own
    the first claim's, cut to 500 characters."""
    c = claims.where("comm_id IS NOT NULL AND speaker IS NOT NULL AND topic IS NOT NULL").withColumn("topic_id", F.concat_ws("__", "comm_id", "speaker", "topic"))
    t = c.groupBy("topic_id", "comm_id", "speaker", "topic").agg(F.countDistinct("claim_id").alias("n_claims"), F.min(F.struct("claim_id", "summary")).alias("f"))
    s = summaries.groupBy("topic_id").agg(F.max(F.when(F.col("topic_summary") != "", F.col("topic_summary"))).alias("own"))
    return t.join(s, "topic_id", "left").select("topic_id", "comm_id", "speaker", "topic", "n_claims", F.coalesce("own", F.substring("f.summary", 1, 500)).alias("topic_summary"))


def entity_nodes(claims: DataFrame) -> DataFrame:
    """One node per entity name, case kept; the type of its last claim."""
    return claims.where("entity_name IS NOT NULL").groupBy("entity_name").agg(F.max_by("entity_type", F.when(F.col("entity_type").isNotNull(), F.col("claim_id"))).alias("entity_type"), F.countDistinct("claim_id").alias("n_claims"))


def claim_nodes(claims: DataFrame) -> DataFrame:
    """One node per claim, keyed by its content, so that loading it again adds none."""
    key = F.sha2(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("comm_id", "speaker", "topic", "entity_name", "claim_label", "claim_id")]), 256)
    return claims.select(key.alias("claim_key"), "claim_id", F.col("claim_label").alias("name"), "speaker", "topic", "sentiment", "summary").dropDuplicates(["claim_key"])


def edges(items: DataFrame, registry: DataFrame, claims: DataFrame) -> DataFrame:
    """(src, rel, dst) of the four relationships, each once."""
    matched = items.select(F.col("id").alias("dst"), F.explode("matched_speakers").alias("src"))
    delivered = matched.join(registry.select(F.col("display_name").alias("src")).distinct(), "src", "left_semi").select("src", F.lit("DELIVERED").alias("rel"), "dst")
    c = claims.where("comm_id IS NOT NULL AND speaker IS NOT NULL AND topic IS NOT NULL").withColumn("topic_id", F.concat_ws("__", "comm_id", "speaker", "topic"))
    has_topic = c.select(F.col("comm_id").alias("src"), F.lit("HAS_TOPIC").alias("rel"), F.col("topic_id").alias("dst"))
    has_entity = c.where("entity_name IS NOT NULL").select(F.col("topic_id").alias("src"), F.lit("HAS_ENTITY").alias("rel"), F.col("entity_name").alias("dst"))
    has_claim = c.where("entity_name IS NOT NULL").select(F.col("entity_name").alias("src"), F.lit("HAS_CLAIM").alias("rel"), F.col("claim_id").cast("string").alias("dst"))
    return delivered.unionByName(has_topic).unionByName(has_entity).unionByName(has_claim).distinct()


def violations(claims: DataFrame, topics: tuple, types: tuple, sentiments: tuple) -> DataFrame:
    """(claim_id, violations): what each claim breaks of the schema's rules."""
    words = F.size(F.split(F.trim("claim_label"), r"\s+"))
    rules = {
        "label_length": ~F.length("claim_label").between(2, 50),
        "label_words": words > 3,
        "topic": ~F.col("topic").isin(*topics),
        "entity_type": ~F.col("entity_type").isin(*types),
        "sentiment": ~F.col("sentiment").isin(*sentiments),
        "no_passages": F.coalesce(F.size("passages"), F.lit(0)) < 1,
        "entity_name": ~F.length("entity_name").between(1, 200),
    }
    return claims.select("claim_id", F.array_compact(F.array(*[F.when(F.coalesce(r, F.lit(True)), F.lit(k)) for k, r in rules.items()])).alias("violations"))
