"""State folding, extraction, the graph and the questions asked of it, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from commgraph import annotate
from commgraph.operators import graph as G
from commgraph.operators import similarity, state, summarize
from commgraph.runtime import table
from commgraph.streaming import incremental
from commgraph.vocab import ENTITY_TYPES, SENTIMENTS, TOPICS

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return keep


# --- pipeline state, from the event stream read as a log ------------------------------------

LOG = """log AS (SELECT user_id AS article_id, ['discover', 'scrape', 'filter', 'summarize', 'extract', 'categorize', 'graph'][event_id % (user_id % 7 + 1) + 1] AS stage, event_id % (user_id % 7 + 1) AS o,
        event_id AS seq, CASE WHEN event_type = 'error' THEN 'FAILED' WHEN event_id % (user_id % 7 + 1) = 2 AND value < 5 THEN 'FILTERED' ELSE 'COMPLETED' END AS status,
        CASE WHEN event_type = 'error' THEN 'error ' || event_id END AS error_message, CASE WHEN event_type != 'error' THEN ts::VARCHAR END AS completed_at, CASE WHEN event_type != 'error' THEN value END AS processing_time
        FROM events)"""
FOLD = """fold AS (SELECT article_id, stage, o, arg_max(status, seq) AS status, arg_max(coalesce(error_message, ''), seq) AS err, sum(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END)::BIGINT AS retry_count,
         arg_max(processing_time, seq) FILTER (WHERE processing_time IS NOT NULL) AS processing_time FROM log GROUP BY article_id, stage, o)"""


def log_rows(events: DataFrame) -> DataFrame:
    """Events, a table or a stream, as a log: all of each article's events, spread over the stages it reaches."""
    o = (F.col("event_id") % (F.col("user_id") % 7 + 1)).cast("int")
    failed = F.col("event_type") == "error"
    return events.select(
        F.col("user_id").alias("article_id"), state.stage_at(o).alias("stage"), F.col("event_id").alias("seq"), F.when(failed, "FAILED").when((o == 2) & (F.col("value") < 5), "FILTERED").otherwise("COMPLETED").alias("status"),
        F.when(failed, F.concat(F.lit("error "), F.col("event_id"))).alias("error_message"), F.when(~failed, F.col("ts").cast("string")).alias("completed_at"), F.when(~failed, F.col("value")).alias("processing_time"),
        F.lit(None).cast("string").alias("file_path"), F.col("props").alias("metadata"),
    )


def stage_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_rows(table(spark, sf_dir, "events"))


@query(f"WITH {LOG}, {FOLD} SELECT article_id, stage, status, nullif(err, '') AS error_message, retry_count, round(processing_time, 4) AS processing_time FROM fold")
def ref_A6_S9_stage_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.fold_log(stage_log(spark, sf_dir)).select("article_id", "stage", "status", "error_message", "retry_count", F.round("processing_time", 4).alias("processing_time"))


@query(f"""
    WITH {LOG}, {FOLD},
    a AS (SELECT article_id, max(CASE WHEN status IN ('COMPLETED', 'FILTERED') THEN o END) AS latest, bool_or(status = 'FILTERED') AS is_filtered, arg_max(err, o) FILTER (WHERE status = 'FAILED') AS err, round(sum(processing_time), 2) AS t, sum(retry_count)::BIGINT AS retry_count FROM fold GROUP BY article_id)
    SELECT article_id, {(names := "['discover','scrape','filter','summarize','extract','categorize','graph']")}[latest + 1] AS latest_completed_stage, CASE WHEN is_filtered OR latest >= 6 OR latest IS NULL THEN NULL ELSE {names}[latest + 2] END AS next_stage,
           is_filtered, err AS error_message, CASE WHEN t != 0 THEN t END AS processing_time_seconds, retry_count FROM a""")
def ref_A7_P13_S6_S7_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.rebuild_states(state.fold_log(stage_log(spark, sf_dir)))


@query(f"""
    WITH {LOG}, {FOLD}, a AS (SELECT article_id, max(CASE WHEN status IN ('COMPLETED', 'FILTERED') THEN o END) AS latest, bool_or(status = 'FILTERED') AS f FROM fold GROUP BY article_id)
    SELECT article_id FROM a WHERE NOT f AND latest = 3""")
def ref_F4_R1_ready_for_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.ready_for(state.rebuild_states(state.fold_log(stage_log(spark, sf_dir))), "extract").select("article_id")


@query(f"WITH {LOG}, {FOLD} SELECT article_id, stage, status, nullif(err, '') AS error_message, retry_count, round(processing_time, 4) AS processing_time FROM fold")
def ref_R2_state_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fold as keyed streaming state, read to its end; the last emission of each key stands."""
    log = log_rows(incremental.stream_table(spark, f"{sf_dir}/events.parquet"))
    out = incremental.drain(incremental.fold_stream(log), "update", ["article_id", "stage"])
    return out.select("article_id", "stage", "status", "error_message", "retry_count", F.round("processing_time", 4).alias("processing_time"))


@query("SELECT DISTINCT url FROM discovered WHERE url IS NOT NULL")
def ref_R3_stream_new_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.drain(incremental.new_articles(incremental.stream_table(spark, f"{sf_dir}/discovered.parquet").where("url IS NOT NULL").select("url")))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def ref_R_stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.drain(incremental.counts(incremental.stream_table(spark, f"{sf_dir}/events.parquet"), "event_type"), "complete")


@query("SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def ref_R_windowed_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").cast("timestamp").alias("window_start"), "event_type", "n")


# --- extraction and categorization ---------------------------------------------------------


@query("""
    WITH w AS (SELECT comm_id, count(DISTINCT speaker || '|' || entity) AS attributed FROM whitelist WHERE speaker IS NOT NULL AND entity IS NOT NULL GROUP BY comm_id),
         p AS (SELECT comm_id, count(DISTINCT speaker || '|' || entity) AS extracted, count(DISTINCT passage_id) AS n_passages FROM passages WHERE speaker IS NOT NULL AND entity IS NOT NULL GROUP BY comm_id)
    SELECT w.comm_id, attributed, coalesce(extracted, 0) AS extracted, coalesce(n_passages, 0) AS n_passages FROM w LEFT JOIN p USING (comm_id)""")
def ref_A3_extraction_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    def pairs(name: str, alias: str, *more) -> DataFrame:
        return table(spark, sf_dir, name).where("speaker IS NOT NULL AND entity IS NOT NULL").groupBy("comm_id").agg(F.countDistinct("speaker", "entity").alias(alias), *more)

    return pairs("whitelist", "attributed").join(pairs("passages", "extracted", F.countDistinct("passage_id").alias("n_passages")), "comm_id", "left").na.fill(0, ["extracted", "n_passages"])


@query("""
    WITH c AS (SELECT DISTINCT claim_id, comm_id, speaker, topic, entity_name, entity_type FROM claims WHERE speaker IS NOT NULL),
         e AS (SELECT comm_id, speaker, topic, entity_name, min(claim_id) AS p, arg_min(entity_type, claim_id) AS t, count(*) AS n FROM c GROUP BY ALL)
    SELECT comm_id, speaker, topic, string_agg(entity_name || ':' || t || ':' || n, '; ' ORDER BY p) AS entities FROM e GROUP BY comm_id, speaker, topic""".replace("GROUP BY ALL)", "GROUP BY comm_id, speaker, topic, entity_name)"))
def ref_A4_A5_topic_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims by speaker and topic, entities in the order first met, with the type first met."""
    c = table(spark, sf_dir, "claims").where("speaker IS NOT NULL").select("claim_id", "comm_id", "speaker", "topic", "entity_name", "entity_type").distinct()
    e = c.groupBy("comm_id", "speaker", "topic", "entity_name").agg(F.min(F.struct("claim_id", "entity_type")).alias("f"), F.count(F.lit(1)).alias("n"))
    item = F.struct(F.col("f.claim_id").alias("p"), F.concat_ws(":", "entity_name", "f.entity_type", "n").alias("t"))
    return e.groupBy("comm_id", "speaker", "topic").agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["t"]), "; ").alias("entities"))


@query("""
    WITH p AS (SELECT DISTINCT passage_id, comm_id, verbatim FROM passages),
         n AS (SELECT comm_id, passage_id, verbatim, row_number() OVER (PARTITION BY comm_id ORDER BY passage_id) - 1 AS k FROM p),
         c AS (SELECT DISTINCT claim_id, comm_id, claim_id % 4 AS i FROM claims)
    SELECT c.claim_id, md5(n.verbatim) AS passage_md5 FROM c JOIN n ON n.comm_id = c.comm_id AND n.k = c.i""")
def ref_J7_W6_passage_gather(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "passages").select("passage_id", "comm_id", "verbatim").distinct()
    n = p.withColumn("k", F.row_number().over(Window.partitionBy("comm_id").orderBy("passage_id")) - 1)
    c = table(spark, sf_dir, "claims").select("claim_id", "comm_id").distinct().withColumn("k", (F.col("claim_id") % 4).cast("int"))
    return c.join(n, ["comm_id", "k"]).select("claim_id", F.md5(F.col("verbatim").cast("binary")).alias("passage_md5"))


@query()
def ref_X1_fuzzy_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "passages").where("speaker IS NOT NULL AND entity IS NOT NULL")
    return similarity.dedup_passages(p, ["comm_id", "speaker", "entity"], "passage_id", "verbatim").select("comm_id", "speaker", "entity", "passage_id")


@query()
def ref_X2_T4_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each claim's passages, longest first, without those that stand in or are like one kept."""
    c = table(spark, sf_dir, "claims").select("claim_id", "passages").distinct()
    return similarity.distinct_passages(c, "claim_id", "passages")


@query("SELECT comm_id, lower(entity_name) AS entity, count(DISTINCT entity_name) AS spellings FROM claims WHERE entity_name IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT entity_name) > 1")
def ref_X7_V5_entity_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "claims").where("entity_name IS NOT NULL").groupBy("comm_id", F.lower("entity_name").alias("entity")).agg(F.countDistinct("entity_name").alias("spellings")).where("spellings > 1")


@query("SELECT type, sum(i)::BIGINT AS input_tokens, sum(o)::BIGINT AS output_tokens FROM (SELECT event_type AS type, CASE WHEN event_id % 3 = 0 AND event_id % 50 != 0 THEN event_id % 50 ELSE event_id % 40 END AS i, CASE WHEN event_id % 4 = 0 THEN 0 ELSE event_id % 30 END AS o FROM events) GROUP BY type")
def ref_P21_A8_token_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage under either of its two names, zero counting as missing, summed."""
    e = F.col("event_id")
    u = table(spark, sf_dir, "events").select(F.col("event_type").alias("type"), F.when(e % 3 == 0, e % 50).otherwise(0).alias("input_tokens"), (e % 40).alias("prompt_tokens"), F.when(e % 4 == 0, 0).otherwise(e % 30).alias("output_tokens"))
    used = F.coalesce(F.nullif("input_tokens", F.lit(0)), F.col("prompt_tokens"), F.lit(0))
    return u.groupBy("type").agg(F.sum(used).alias("input_tokens"), F.sum(F.coalesce("output_tokens", F.lit(0))).alias("output_tokens"))


@query("SELECT comm_id, speaker, entity, ord, reason FROM (SELECT *, row_number() OVER (PARTITION BY comm_id, speaker, entity ORDER BY ord DESC, reason DESC NULLS LAST) AS k FROM whitelist WHERE speaker IS NOT NULL AND entity IS NOT NULL) WHERE k = 1")
def ref_X6_J3_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = table(spark, sf_dir, "whitelist").where("speaker IS NOT NULL AND entity IS NOT NULL")
    return state.last_rows(w, ["comm_id", "speaker", "entity"], [F.desc("ord"), F.desc_nulls_last("reason")]).select("comm_id", "speaker", "entity", "ord", "reason")


SENT = """s AS (SELECT label AS doc, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS idx, embedding::DOUBLE[] AS vec, vec_id % 40 + 5 AS words FROM embeddings),
    q AS (SELECT doc, quantile_cont(words, 0.9) AS q FROM s GROUP BY doc),
    w AS (SELECT s.doc, idx, vec, words, CASE WHEN q > 0 THEN least(words / q, 1.0) ELSE 1.0 END AS l FROM s JOIN q USING (doc)),
    m AS (SELECT a.doc, a.idx, b.idx AS j, list_cosine_similarity(a.vec, b.vec) * a.l AS m FROM w a JOIN w b ON a.doc = b.doc),
    g AS (SELECT doc, idx, median(m) AS g, coalesce(avg(m) FILTER (WHERE abs(idx - j) BETWEEN 1 AND 3), 0) AS n FROM m GROUP BY doc, idx),
    c AS (SELECT doc, idx, 0.7 * (g - min(g) OVER (PARTITION BY doc)) / (max(g) OVER (PARTITION BY doc) - min(g) OVER (PARTITION BY doc) + 1e-8) + 0.3 * (n - min(n) OVER (PARTITION BY doc)) / (max(n) OVER (PARTITION BY doc) - min(n) OVER (PARTITION BY doc) + 1e-8) AS score FROM g)"""


def sentence_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("label").alias("doc"), (F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1).alias("idx"), F.col("embedding").alias("vec"), (F.col("vec_id") % 40 + 5).alias("words"))


@query(f"WITH {SENT} SELECT doc, idx, round(score, 5) AS score FROM c")
def ref_W1_A12_A13_J10_centrality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize.centrality(sentence_vectors(spark, sf_dir)).select("doc", "idx", F.round("score", 5).alias("score"))


@query(f"""
    WITH {SENT}, r AS (SELECT c.doc, c.idx, sum(words) OVER (PARTITION BY c.doc ORDER BY round(score, 9) DESC, c.idx DESC) AS used, count(*) OVER (PARTITION BY c.doc) AS n FROM c JOIN w ON c.doc = w.doc AND c.idx = w.idx)
    SELECT doc, idx FROM r WHERE n < 3 OR used <= 230""")
def ref_T1_T2_T3_W5_budgeted_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sentence_vectors(spark, sf_dir)
    scored = summarize.centrality(s).join(s.select("doc", "idx", F.col("words").alias("tokens")), ["doc", "idx"]).withColumn("score", F.round("score", 9))
    return summarize.budgeted_prefix(scored, 200).select("doc", "idx")


def _hits(words: list[str]) -> str:
    return rf"len(regexp_extract_all(lower(verbatim), '\b(?:{'|'.join(words)})[a-z]*\b'))"


TOPIC_SQL = ", ".join(f"{{'n': {_hits(annotate.TOPIC_WORDS[t])}, 'k': {-k}, 't': '{t}'}}" for k, t in enumerate(TOPICS) if t in annotate.TOPIC_WORDS)


@query(f"""
    WITH p AS (SELECT DISTINCT passage_id, verbatim FROM passages), h AS (SELECT passage_id, {_hits(annotate.POSITIVE)} AS p, {_hits(annotate.NEGATIVE)} AS m, list_max([{TOPIC_SQL}]) AS b FROM p)
    SELECT passage_id, CASE WHEN b.n > 0 THEN b.t ELSE 'other' END AS topic, CASE WHEN p = 0 AND m = 0 THEN 'unclear' WHEN p > m THEN 'positive' WHEN m > p THEN 'negative' ELSE 'neutral' END AS sentiment FROM h""")
def ref_U5_rule_annotator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic and sentiment of passages by the default annotator."""
    p = table(spark, sf_dir, "passages").select("passage_id", "verbatim").distinct()
    return p.select("passage_id", annotate.topic(F.col("verbatim")).alias("topic"), annotate.sentiment(F.col("verbatim")).alias("sentiment"))


# --- graph ---------------------------------------------------------------------------------

CLAIMS = "c AS (SELECT DISTINCT claim_id, comm_id, entity_name, entity_type, speaker, topic, claim_label, sentiment, summary FROM claims)"


@query("""
    WITH f AS (SELECT id, any_value(is_relevant) AS r, count(*) AS n FROM (SELECT DISTINCT id, is_relevant FROM filter_items) GROUP BY id),
         e AS (SELECT id, max(length(content)) AS n_extract FROM extract_context GROUP BY id), c AS (SELECT comm_id AS id, count(DISTINCT claim_id) AS n_claims FROM claims GROUP BY comm_id)
    SELECT DISTINCT n.id, length(n.full_text) AS n_chars, n_extract, coalesce(n_claims, 0) AS n_claims, f.n IS NOT NULL AS filtered FROM node_communication n LEFT JOIN f ON n.id = f.id LEFT JOIN e ON n.id = e.id LEFT JOIN c ON n.id = c.id""")
def ref_J1_stitching(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "node_communication").select("id", F.length("full_text").alias("n_chars")).distinct()
    f = table(spark, sf_dir, "filter_items").select("id").distinct().withColumn("f", F.lit(True))
    e = table(spark, sf_dir, "extract_context").groupBy("id").agg(F.max(F.length("content")).alias("n_extract"))
    c = table(spark, sf_dir, "claims").groupBy(F.col("comm_id").alias("id")).agg(F.countDistinct("claim_id").alias("n_claims"))
    return n.join(f, "id", "left").join(e, "id", "left").join(c, "id", "left").select("id", "n_chars", "n_extract", F.coalesce("n_claims", F.lit(0)).alias("n_claims"), F.coalesce("f", F.lit(False)).alias("filtered"))


@query("SELECT DISTINCT display_name AS speaker_id, display_name AS name, role, organization, industry, region FROM speakers")
def ref_G1_S14_speaker_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.speaker_nodes(table(spark, sf_dir, "speakers"))


@query("""
    WITH c AS (SELECT DISTINCT claim_id, comm_id, speaker, topic, summary FROM claims WHERE comm_id IS NOT NULL AND speaker IS NOT NULL AND topic IS NOT NULL),
         t AS (SELECT comm_id || '__' || speaker || '__' || topic AS topic_id, comm_id, speaker, topic, count(*) AS n_claims, arg_min(summary, claim_id) AS f FROM c GROUP BY comm_id, speaker, topic),
         s AS (SELECT topic_id, max(nullif(topic_summary, '')) AS own FROM node_topic GROUP BY topic_id)
    SELECT topic_id, comm_id, speaker, topic, n_claims, coalesce(own, left(f, 500)) AS topic_summary FROM t LEFT JOIN s USING (topic_id)""")
def ref_G3_P9_P10_topic_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.topic_nodes(table(spark, sf_dir, "claims"), table(spark, sf_dir, "node_topic"))


@query("SELECT entity_name, arg_max(entity_type, claim_id) FILTER (WHERE entity_type IS NOT NULL) AS entity_type, count(DISTINCT claim_id) AS n_claims FROM claims WHERE entity_name IS NOT NULL GROUP BY entity_name")
def ref_G4_entity_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.entity_nodes(table(spark, sf_dir, "claims"))


# --- questions -----------------------------------------------------------------------------


def claims_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "claims").select("claim_id", "comm_id", "entity_name", "entity_type", "speaker", "topic", "claim_label", "sentiment", "summary").distinct()


@query(f"WITH {CLAIMS} SELECT speaker, entity_name, topic, count(*) AS n, count(*) FILTER (WHERE sentiment = 'positive') AS positive, count(*) FILTER (WHERE sentiment = 'negative') AS negative FROM c WHERE speaker IS NOT NULL AND entity_name IS NOT NULL GROUP BY speaker, entity_name, topic")
def ref_Q1_Q4_Q5_speaker_on_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("sentiment")
    return claims_once(spark, sf_dir).where("speaker IS NOT NULL AND entity_name IS NOT NULL").groupBy("speaker", "entity_name", "topic").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(s == "positive", 1)).alias("positive"), F.count(F.when(s == "negative", 1)).alias("negative"))


@query(f"WITH {CLAIMS} SELECT topic, entity_name, count(*) AS n FROM c WHERE sentiment = 'positive' AND entity_name IS NOT NULL GROUP BY topic, entity_name")
def ref_Q2_positive_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims_once(spark, sf_dir).where("sentiment = 'positive' AND entity_name IS NOT NULL").groupBy("topic", "entity_name").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
    WITH {CLAIMS}, d AS (SELECT id, max(try_strptime(content_date, '%Y-%m-%d')::DATE) AS d FROM node_communication GROUP BY id),
    m AS (SELECT entity_name, date_trunc('month', d)::DATE AS month, avg(CASE sentiment WHEN 'positive' THEN 1.0 WHEN 'negative' THEN -1.0 ELSE 0.0 END) AS mood, count(*) AS n FROM c JOIN d ON c.comm_id = d.id WHERE d IS NOT NULL AND entity_name IS NOT NULL GROUP BY 1, 2)
    SELECT entity_name, month, n, round(mood, 6) AS mood, round(mood - lag(mood) OVER (PARTITION BY entity_name ORDER BY month), 6) AS change FROM m""")
def ref_Q3_Q12_sentiment_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "node_communication").groupBy(F.col("id").alias("comm_id")).agg(F.max(F.try_to_timestamp("content_date", F.lit("yyyy-M-d")).cast("date")).alias("d"))
    v = F.when(F.col("sentiment") == "positive", 1.0).when(F.col("sentiment") == "negative", -1.0).otherwise(0.0)
    m = claims_once(spark, sf_dir).where("entity_name IS NOT NULL").join(d.where("d IS NOT NULL"), "comm_id").groupBy("entity_name", F.trunc("d", "month").alias("month")).agg(F.avg(v).alias("mood"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("entity_name").orderBy("month")
    return m.select("entity_name", "month", "n", F.round("mood", 6).alias("mood"), F.round(F.col("mood") - F.lag("mood").over(w), 6).alias("change"))


def by_group(spark: SparkSession, sf_dir: str, attr: str) -> DataFrame:
    """Claims per speaker and topic first, then the registry: hot speakers meet it once a topic."""
    s = F.col("sentiment")
    c = claims_once(spark, sf_dir).where("speaker IS NOT NULL").groupBy("speaker", "topic").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(s == "positive", 1)).alias("p"), F.count(F.when(s == "negative", 1)).alias("m"))
    r = table(spark, sf_dir, "speakers").select(F.col("display_name").alias("speaker"), F.coalesce(attr, F.lit("none")).alias("grp"))
    return c.join(r, "speaker").groupBy("topic", "grp").agg(F.sum("n").alias("n"), F.sum("p").alias("positive"), F.sum("m").alias("negative"))


GROUPED = "SELECT topic, coalesce({0}, 'none') AS grp, count(*) AS n, count(*) FILTER (WHERE sentiment = 'positive') AS positive, count(*) FILTER (WHERE sentiment = 'negative') AS negative FROM c JOIN speakers s ON c.speaker = s.display_name GROUP BY 1, 2"


@query(f"WITH {CLAIMS} {GROUPED.format('industry')}")
def ref_Q6_compare_industries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_group(spark, sf_dir, "industry")


@query(f"WITH {CLAIMS}, g AS ({GROUPED.format('industry')}) SELECT topic, count(*) AS n_groups, round(var_samp(positive / n::DOUBLE), 8) AS division FROM g GROUP BY topic")
def ref_Q7_division(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_group(spark, sf_dir, "industry").groupBy("topic").agg(F.count(F.lit(1)).alias("n_groups"), F.round(F.var_samp(F.col("positive") / F.col("n")), 8).alias("division"))


@query(f"WITH {CLAIMS} {GROUPED.format('region')}")
def ref_Q8_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_group(spark, sf_dir, "region")


@query(f"""
    WITH {CLAIMS}, d AS (SELECT id, max(try_strptime(content_date, '%Y-%m-%d')::DATE) AS d FROM node_communication GROUP BY id),
    f AS (SELECT entity_name, industry, min(d) AS first_day FROM c JOIN d ON c.comm_id = d.id JOIN speakers s ON c.speaker = s.display_name WHERE d IS NOT NULL AND entity_name IS NOT NULL GROUP BY 1, 2)
    SELECT entity_name, industry, first_day, rank() OVER (PARTITION BY entity_name ORDER BY first_day) AS place FROM f""")
def ref_Q9_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "node_communication").groupBy(F.col("id").alias("comm_id")).agg(F.max(F.try_to_timestamp("content_date", F.lit("yyyy-M-d")).cast("date")).alias("d")).where("d IS NOT NULL")
    r = table(spark, sf_dir, "speakers").select(F.col("display_name").alias("speaker"), "industry")
    f = claims_once(spark, sf_dir).where("entity_name IS NOT NULL").select("comm_id", "entity_name", "speaker").distinct().join(d, "comm_id").join(r, "speaker").groupBy("entity_name", "industry").agg(F.min("d").alias("first_day"))
    return f.select("entity_name", "industry", "first_day", F.rank().over(Window.partitionBy("entity_name").orderBy("first_day")).cast("bigint").alias("place"))


@query(f"WITH {CLAIMS} SELECT topic, sentiment, count(*) AS n, grouping(topic) + grouping(sentiment) AS level FROM c GROUP BY ROLLUP (topic, sentiment)")
def ref_Q10_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims_once(spark, sf_dir).rollup("topic", "sentiment").agg(F.count(F.lit(1)).alias("n"), (F.grouping("topic") + F.grouping("sentiment")).cast("bigint").alias("level"))


@query(f"WITH {CLAIMS}, e AS (SELECT DISTINCT comm_id, entity_name FROM c WHERE entity_name IS NOT NULL AND comm_id IS NOT NULL) SELECT a.entity_name AS entity_a, b.entity_name AS entity_b, count(*) AS n FROM e a JOIN e b ON a.comm_id = b.comm_id AND a.entity_name < b.entity_name GROUP BY 1, 2 HAVING count(*) > 1")
def ref_Q11_cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs within a communication, whose entities are few."""
    e = claims_once(spark, sf_dir).where("entity_name IS NOT NULL AND comm_id IS NOT NULL").select("comm_id", "entity_name").distinct()
    a, b = e.alias("a"), e.alias("b")
    return a.join(b, (F.col("a.comm_id") == F.col("b.comm_id")) & (F.col("a.entity_name") < F.col("b.entity_name"))).groupBy(F.col("a.entity_name").alias("entity_a"), F.col("b.entity_name").alias("entity_b")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query(f"WITH {CLAIMS} SELECT 'speaker' AS kind, speaker AS key, topic, count(DISTINCT comm_id) AS n FROM c WHERE speaker IS NOT NULL GROUP BY speaker, topic UNION ALL SELECT 'communication', comm_id, topic, count(DISTINCT speaker) FROM c WHERE comm_id IS NOT NULL GROUP BY comm_id, topic")
def ref_Q13_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = claims_once(spark, sf_dir)

    def edge(kind: str, key: str, other: str) -> DataFrame:
        return c.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key"), "topic").agg(F.countDistinct(other).alias("n")).select(F.lit(kind).alias("kind"), "key", "topic", "n")

    return edge("speaker", "speaker", "comm_id").unionByName(edge("communication", "comm_id", "speaker"))


@query(f"""
    WITH {CLAIMS}, m AS (SELECT DISTINCT id, unnest(matched_speakers) AS s FROM filter_items)
    SELECT s AS speaker, count(DISTINCT c.comm_id) AS n_comms, count(DISTINCT c.topic) AS n_topics, count(DISTINCT c.entity_name) AS n_entities, count(DISTINCT claim_id) AS n_claims
    FROM m JOIN c ON c.comm_id = m.id WHERE s IN (SELECT display_name FROM speakers) GROUP BY s""")
def ref_Q14_J13_traversal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speaker to communication to topic, entity and claim."""
    m = table(spark, sf_dir, "filter_items").select(F.col("id").alias("comm_id"), F.explode("matched_speakers").alias("s")).distinct()
    m = m.join(table(spark, sf_dir, "speakers").select(F.col("display_name").alias("s")).distinct(), "s", "left_semi")
    c = claims_once(spark, sf_dir).select("comm_id", "topic", "entity_name", "claim_id")
    return m.join(c, "comm_id").groupBy(F.col("s").alias("speaker")).agg(F.countDistinct("comm_id").alias("n_comms"), F.countDistinct("topic").alias("n_topics"), F.countDistinct("entity_name").alias("n_entities"), F.countDistinct("claim_id").alias("n_claims"))
