"""Stage operators with their errors, limits and graph rows, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from commgraph import annotate
from commgraph.config import LIMITS
from commgraph.functions import text as T
from commgraph.functions import urls as U
from commgraph.functions.dates import parse_date
from commgraph.operators import chunks, faults, similarity, state, summarize
from commgraph.operators import discovery as D
from commgraph.operators import graph as G
from commgraph.plans.knowledge import CLAIMS, FOLD, LOG, stage_log
from commgraph.plans.scalars import DATE, NETLOC
from commgraph.runtime import table
from commgraph.sources import registry
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


# --- state ---------------------------------------------------------------------------------


@query(f"""
    WITH {LOG}, m AS (SELECT user_id AS article_id, event_id AS seq, event_id % (user_id % 7 + 1) AS o, unnest(json_keys(props)) AS key, props FROM events WHERE props IS NOT NULL)
    SELECT article_id, ['discover','scrape','filter','summarize','extract','categorize','graph'][o + 1] AS stage, key, arg_max(json_extract_string(props, '$."' || key || '"'), seq) AS value FROM m GROUP BY article_id, o, key""")
def ref_X11_metadata_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged metadata of each stage row, entry by entry."""
    return state.fold_log(stage_log(spark, sf_dir)).select("article_id", "stage", F.explode("metadata").alias("key", "value"))


@query(f"""
    WITH {LOG}, {FOLD} SELECT f.article_id, f.stage, f.status, d.title, d.url, d.publication_date, d.batch_no FROM fold f LEFT JOIN discovered d ON d.disc_id = f.article_id""")
def ref_P14_stage_rows_with_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = state.fold_log(stage_log(spark, sf_dir)).select("article_id", "stage", "status")
    return state.article_fields(fold, table(spark, sf_dir, "discovered"), "disc_id", ["title", "url", "publication_date", "batch_no"])


@query(f"""
    WITH {LOG}, {FOLD}, r AS (SELECT DISTINCT user_id AS article_id, ['discover','scrape','filter','summarize','extract','categorize','graph'][user_id % 7 + 1] AS stage FROM events WHERE event_type = 'click')
    SELECT f.article_id, f.stage, f.status, f.retry_count FROM fold f JOIN r ON r.article_id = f.article_id AND r.stage = f.stage""")
def ref_S4_point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stage rows asked for by article and stage: the last stage that articles with a click reach."""
    asked = table(spark, sf_dir, "events").where("event_type = 'click'").select(F.col("user_id").alias("article_id"), state.stage_at((F.col("user_id") % 7).cast("int")).alias("stage"))
    return registry.lookup(state.fold_log(stage_log(spark, sf_dir)), asked, ["article_id", "stage"]).select("article_id", "stage", "status", "retry_count")


@query("SELECT search_url, min(disc_id) AS disc_id, arg_min(id, disc_id) AS id, arg_min(title, disc_id) AS title FROM discovered WHERE search_url IS NOT NULL GROUP BY search_url")
def ref_T7_S5_first_by_attribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One article per search address, the one found first."""
    first = F.min(F.struct("disc_id", "id", "title")).alias("f")
    return table(spark, sf_dir, "discovered").where("search_url IS NOT NULL").groupBy("search_url").agg(first).select("search_url", "f.disc_id", "f.id", "f.title")


@query("""
    SELECT user_id AS article_id, event_type AS stage, greatest(round(min(value) / 1000, 2), 0.01) AS elapsed, CASE WHEN round(sum(value / 1000), 2) != 0 THEN round(sum(value / 1000), 2) END AS total FROM events GROUP BY user_id, event_type""")
def ref_P22_elapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times in seconds, at least a hundredth; a total of nothing is null."""
    t = F.round(F.sum(F.col("value") / 1000), 2)
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("article_id"), F.col("event_type").alias("stage")).agg(F.greatest(F.round(F.min("value") / 1000, 2), F.lit(0.01)).alias("elapsed"), F.when(t != 0, t).alias("total"))


# --- discovery ----------------------------------------------------------------------------------


@query("""
    WITH o AS (SELECT search_url, batch_no, nullif(url, '') AS u FROM discovered WHERE search_url IS NOT NULL AND batch_no IS NOT NULL),
         f AS (SELECT search_url, u, min(batch_no) AS b FROM o WHERE u IS NOT NULL GROUP BY search_url, u),
         a AS (SELECT search_url, batch_no, count(*) AS n_actions, count(*) FILTER (WHERE b < batch_no) AS n_visited FROM (SELECT DISTINCT * FROM o WHERE u IS NOT NULL) JOIN f USING (search_url, u) GROUP BY search_url, batch_no),
         p AS (SELECT search_url, batch_no, count(*) FILTER (WHERE u IS NULL) AS n_failed FROM o GROUP BY search_url, batch_no),
         n AS (SELECT p.*, coalesce(n_actions, 0) AS n_actions, coalesce(n_visited, 0) AS n_visited, row_number() OVER (PARTITION BY search_url ORDER BY batch_no)::INT AS page FROM p LEFT JOIN a USING (search_url, batch_no))
    SELECT search_url AS session, batch_no AS batch, page, n_visited, n_failed, CASE WHEN page > 5 THEN 'max pages' WHEN n_actions = 0 THEN 'no address' WHEN n_visited = n_actions THEN 'visited' END AS stop FROM n""")
def ref_F16_T6_crawl_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.crawl_stops(table(spark, sf_dir, "discovered"), "search_url", "batch_no", "url", LIMITS.max_pages)


@query(f"""
    WITH d AS (SELECT batch_no, url AS k, {DATE} AS p, search_url IS NULL AND date_source = 'url_path' AS r FROM discovered),
         b AS (SELECT batch_no, count(*) AS n_rows, coalesce(bool_or(p < DATE '2024-01-09'), false) AS below, coalesce(bool_or(r), false) AS reset FROM d GROUP BY batch_no),
         n AS (SELECT b, count(*) AS n_new FROM (SELECT k, min(batch_no) AS b FROM d GROUP BY k) GROUP BY b),
         s AS (SELECT b.batch_no, n_rows, coalesce(n_new, 0) AS n_new, below, reset FROM b LEFT JOIN n ON n.b = b.batch_no),
         i AS (SELECT *, sum(CASE WHEN n_new > 0 OR reset THEN 1 ELSE 0 END) OVER (ORDER BY batch_no) AS island FROM s)
    SELECT batch_no AS batch, n_rows, n_new, below, n_new = 0 AS duplicate_only, (sum(CASE WHEN n_new = 0 AND NOT reset THEN 1 ELSE 0 END) OVER (PARTITION BY island ORDER BY batch_no))::BIGINT AS barren_run FROM i""")
def ref_F15_R5_barren_runs_with_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch in which a link was followed, which are rows dated by their path without a search address, starts a new run."""
    followed = F.col("search_url").isNull() & (F.col("date_source") == "url_path")
    return D.batch_progress(table(spark, sf_dir, "discovered"), "batch_no", "url", parse_date(F.col("publication_date")), "2024-01-10", followed)


@query("SELECT batch_no, disc_id, title, place FROM (SELECT batch_no, disc_id, title, row_number() OVER (PARTITION BY batch_no ORDER BY disc_id)::INT AS place FROM discovered WHERE batch_no IS NOT NULL) WHERE place <= 5")
def ref_T6_report_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five rows of each batch's report; each task keeps five a batch before the shuffle."""
    w = Window.partitionBy("batch_no").orderBy("disc_id")
    return table(spark, sf_dir, "discovered").where("batch_no IS NOT NULL").withColumn("place", F.row_number().over(w)).where(F.col("place") <= LIMITS.report_rows).select("batch_no", "disc_id", "title", "place")


@query(rf"""
    WITH d AS (SELECT disc_id, batch_no, regexp_replace({NETLOC}, '^www\.', '') AS domain FROM discovered), r AS (SELECT DISTINCT domain FROM d WHERE batch_no = 0)
    SELECT disc_id, d.domain, CASE WHEN r.domain IS NULL THEN 'unsupported domain: ' || coalesce(d.domain, '') END AS error_message FROM d LEFT JOIN r ON r.domain = d.domain""")
def ref_F10_J8_supported_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every article with its domain, an error where history's registry hasn't got it."""
    t = table(spark, sf_dir, "discovered").select("disc_id", "batch_no", "url")
    domains = t.where("batch_no = 0").select(U.domain_key(F.col("url")).alias("known"))
    return registry.supported(t, "url", domains, "known").select("disc_id", "domain", "error_message")


# --- extraction -------------------------------------------------------------------------------------


@query("""
    WITH w AS (SELECT DISTINCT comm_id, speaker, trim(coalesce(entity, '')) AS e FROM whitelist WHERE speaker IS NOT NULL)
    SELECT comm_id, speaker, coalesce(string_agg(e, '|' ORDER BY e) FILTER (WHERE e != ''), '') AS entities FROM w GROUP BY comm_id, speaker""")
def ref_F8_entity_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each speaker's entities, blank ones dropped; a speaker with only blank names stays, without entities."""
    e = F.nullif(F.trim("entity"), F.lit(""))
    return table(spark, sf_dir, "whitelist").where("speaker IS NOT NULL").groupBy("comm_id", "speaker").agg(F.array_join(F.array_sort(F.collect_set(e)), "|").alias("entities"))


@query("""
    WITH f AS (SELECT DISTINCT id, matched_speakers AS m FROM filter_items WHERE id IS NOT NULL), e AS (SELECT id, unnest(m) AS s FROM f),
         n AS (SELECT id, count(*) AS given, count(*) FILTER (WHERE s IN (SELECT display_name FROM speakers)) AS known FROM e GROUP BY id)
    SELECT f.id, coalesce(given, 0) AS n_given, coalesce(known, 0) AS n_known, CASE WHEN coalesce(given, 0) = 0 THEN 'no speakers' WHEN known = 0 THEN 'no known speaker' END AS error_message FROM (SELECT DISTINCT id FROM f) f LEFT JOIN n USING (id)""")
def ref_F9_known_speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown speakers are passed over; an item without any known one is an error."""
    f = table(spark, sf_dir, "filter_items").where("id IS NOT NULL").select("id", "matched_speakers").distinct()
    e = f.select("id", F.explode_outer("matched_speakers").alias("display_name"))
    r = table(spark, sf_dir, "speakers").select("display_name").distinct().withColumn("k", F.lit(1))
    n = e.join(r, "display_name", "left").groupBy("id").agg(F.count("display_name").alias("n_given"), F.count("k").alias("n_known"))
    return n.withColumn("error_message", F.when(F.col("n_given") == 0, "no speakers").when(F.col("n_known") == 0, "no known speaker"))


@query("""
    WITH i AS (SELECT DISTINCT id FROM filter_items WHERE id IS NOT NULL)
    SELECT id, CASE WHEN id NOT IN (SELECT id FROM node_communication WHERE id IS NOT NULL) THEN 'missing scrape' WHEN id NOT IN (SELECT comm_id FROM claims WHERE comm_id IS NOT NULL) THEN 'missing categorize' END AS error_message FROM i""")
def ref_J1_missing_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stitching needs a scrape and its categories; what lacks one is an error of that item."""
    i = table(spark, sf_dir, "filter_items").where("id IS NOT NULL").select("id").distinct()
    s = table(spark, sf_dir, "node_communication").select("id").distinct().withColumn("s", F.lit(1))
    c = table(spark, sf_dir, "claims").select(F.col("comm_id").alias("id")).distinct().withColumn("c", F.lit(1))
    return i.join(s, "id", "left").join(c, "id", "left").select("id", F.when(F.col("s").isNull(), "missing scrape").when(F.col("c").isNull(), "missing categorize").alias("error_message"))


@query("""
    WITH p AS (SELECT DISTINCT passage_id, comm_id, verbatim FROM passages),
         n AS (SELECT comm_id, verbatim, row_number() OVER (PARTITION BY comm_id ORDER BY passage_id) - 1 AS k FROM p),
         c AS (SELECT DISTINCT claim_id, comm_id, claim_id % 7 - 1 AS i FROM claims)
    SELECT claim_id, md5(n.verbatim) AS passage_md5, CASE WHEN i < 0 THEN 'negative index' WHEN n.k IS NULL THEN 'index out of range' END AS error_message FROM c LEFT JOIN n ON n.comm_id = c.comm_id AND n.k = c.i""")
def ref_J7_passage_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages by their place in the communication; a place that isn't there is an error and never dropped."""
    p = table(spark, sf_dir, "passages").select("passage_id", "comm_id", "verbatim").distinct()
    n = p.select("comm_id", "verbatim", (F.row_number().over(Window.partitionBy("comm_id").orderBy("passage_id")) - 1).alias("k"))
    c = table(spark, sf_dir, "claims").select("claim_id", "comm_id").distinct().withColumn("k", (F.col("claim_id") % 7 - 1).cast("int"))
    return c.join(n.withColumn("there", F.lit(1)), ["comm_id", "k"], "left").select("claim_id", F.md5(F.col("verbatim").cast("binary")).alias("passage_md5"), F.when(F.col("k") < 0, "negative index").when(F.col("there").isNull(), "index out of range").alias("error_message"))


@query("""
    WITH p AS (SELECT comm_id, speaker, count(DISTINCT passage_id) AS n FROM passages WHERE speaker IS NOT NULL GROUP BY comm_id, speaker)
    SELECT comm_id, string_agg(speaker || ':' || n, '; ' ORDER BY speaker) AS passages_per_speaker, sum(n)::BIGINT AS n_passages FROM p GROUP BY comm_id""")
def ref_A3_passages_per_speaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "passages").where("speaker IS NOT NULL").groupBy("comm_id", "speaker").agg(F.countDistinct("passage_id").alias("n"))
    m = p.groupBy("comm_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("speaker", "n")))).alias("m"), F.sum("n").alias("n_passages"))
    return m.select("comm_id", F.array_join(F.transform(F.map_entries("m"), lambda x: F.concat_ws(":", x["key"], x["value"])), "; ").alias("passages_per_speaker"), "n_passages")


@query("""
    WITH p AS (SELECT DISTINCT comm_id, passage_id, pos, entity FROM passages WHERE comm_id IS NOT NULL),
         n AS (SELECT *, row_number() OVER (PARTITION BY comm_id ORDER BY pos, passage_id) - 1 AS k FROM p),
         g AS (SELECT comm_id, entity, min(k) AS first_k, string_agg(k::VARCHAR, ',' ORDER BY k) AS indices FROM n WHERE entity IS NOT NULL GROUP BY comm_id, entity)
    SELECT comm_id, entity, indices, row_number() OVER (PARTITION BY comm_id ORDER BY first_k)::INT AS place FROM g""")
def ref_A5_passage_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages by entity, in the order entities are first met, each with its place among all of the communication."""
    p = table(spark, sf_dir, "passages").where("comm_id IS NOT NULL").select("comm_id", "passage_id", "pos", "entity").distinct()
    n = p.withColumn("k", F.row_number().over(Window.partitionBy("comm_id").orderBy("pos", "passage_id")) - 1)
    g = n.where("entity IS NOT NULL").groupBy("comm_id", "entity").agg(F.array_sort(F.collect_list("k")).alias("ks"))
    return g.select("comm_id", "entity", F.array_join("ks", ",").alias("indices"), F.row_number().over(Window.partitionBy("comm_id").orderBy(F.col("ks")[0])).alias("place"))


@query("""
    WITH f AS (SELECT comm_id, entity, min(struct_pack(ord := ord, speaker := speaker)) AS f FROM whitelist WHERE entity IS NOT NULL AND ord IS NOT NULL AND speaker IS NOT NULL GROUP BY comm_id, entity)
    SELECT comm_id, entity, f.speaker AS first_speaker, row_number() OVER (PARTITION BY comm_id ORDER BY f.ord, f.speaker, entity)::INT AS place FROM f""")
def ref_X4_ordered_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entities of all speakers of a communication, each once, in the order first met."""
    w = table(spark, sf_dir, "whitelist").where("entity IS NOT NULL AND ord IS NOT NULL AND speaker IS NOT NULL")
    f = w.groupBy("comm_id", "entity").agg(F.min(F.struct("ord", "speaker")).alias("f"))
    return f.select("comm_id", "entity", F.col("f.speaker").alias("first_speaker"), F.row_number().over(Window.partitionBy("comm_id").orderBy("f.ord", "f.speaker", "entity")).alias("place"))


@query("SELECT comm_id, entity, count(*) AS n FROM (SELECT comm_id, entity FROM whitelist UNION ALL SELECT comm_id, entity FROM passages UNION ALL SELECT comm_id, entity_name FROM claims) GROUP BY comm_id, entity")
def ref_X5_append_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of several chunks appended, repeats kept."""
    parts = [table(spark, sf_dir, n).select("comm_id", F.col(c).alias("entity")) for n, c in (("whitelist", "entity"), ("passages", "entity"), ("claims", "entity_name"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("comm_id", "entity").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT comm_id, speaker, entity, passage_id FROM (SELECT DISTINCT comm_id, speaker, entity, passage_id FROM passages) WHERE comm_id IS NOT NULL AND speaker IS NOT NULL AND entity IS NOT NULL")
def ref_X15_nested_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speaker to entity to passages as nested maps, and flat again."""
    p = table(spark, sf_dir, "passages").where("comm_id IS NOT NULL AND speaker IS NOT NULL AND entity IS NOT NULL").groupBy("comm_id", "speaker", "entity").agg(F.collect_set("passage_id").alias("ps"))
    inner = p.groupBy("comm_id", "speaker").agg(F.map_from_entries(F.collect_list(F.struct("entity", "ps"))).alias("m"))
    nested = inner.groupBy("comm_id").agg(F.map_from_entries(F.collect_list(F.struct("speaker", "m"))).alias("m"))
    flat = nested.select("comm_id", F.explode("m").alias("speaker", "m")).select("comm_id", "speaker", F.explode("m").alias("entity", "ps"))
    return flat.select("comm_id", "speaker", "entity", F.explode("ps").alias("passage_id"))


@query()
def ref_X9_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "extract_context").select("id", "content").distinct()
    return chunks.chunked(c, "id", "content").select("id", "chunk_no", "start", F.length("chunk").alias("n_chars"))


@query(r"""
    WITH d AS (SELECT DISTINCT id, full_text FROM node_communication WHERE id IS NOT NULL AND full_text IS NOT NULL),
         a AS (SELECT id, list_filter(string_split(regexp_replace(full_text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: x != '') AS l FROM d),
         s AS (SELECT id, unnest(l) AS s, generate_subscripts(l, 1) - 1 AS idx FROM a),
         w AS (SELECT id, s, idx, CASE WHEN regexp_replace(s, '^\s+|\s+$', '', 'g') = '' THEN 0 ELSE len(regexp_split_to_array(regexp_replace(s, '^\s+|\s+$', '', 'g'), '\s+')) END AS n FROM s),
         r AS (SELECT *, sum(n) OVER (PARTITION BY id ORDER BY n DESC, idx DESC) AS used, count(*) OVER (PARTITION BY id) AS c FROM w)
    SELECT id, md5(string_agg(s, ' ' ORDER BY idx)) AS summary_md5, count(*) AS n_sentences FROM r WHERE c < 3 OR used <= 230 GROUP BY id""")
def ref_T3_X8_joined_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest sentences within a budget, in their order and joined again."""
    d = table(spark, sf_dir, "node_communication").where("id IS NOT NULL AND full_text IS NOT NULL").select("id", "full_text").distinct()
    s = summarize.split_sentences(d, "id", "full_text")
    kept = summarize.budgeted_prefix(s.select("doc", "idx", F.col("words").alias("score"), F.col("words").alias("tokens")), 200)
    both = kept.select("doc", "idx").join(s, ["doc", "idx"])
    n = both.groupBy("doc").agg(F.count(F.lit(1)).alias("n_sentences"))
    return summarize.joined(both).join(n, "doc").select(F.col("doc").alias("id"), F.md5(F.col("summary").cast("binary")).alias("summary_md5"), "n_sentences")


@query()
def ref_X10_U9_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries by the centrality of sentence vectors; the default vectors are hashed words."""
    d = table(spark, sf_dir, "node_communication").where("id IS NOT NULL AND full_text IS NOT NULL")
    return summarize.summaries(d, "id", "full_text", 200).select(F.col("doc").alias("id"), T.word_count("summary").alias("n_words"))


@query()
def ref_P24_R4_line_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines each passage of a communication adds to the one before it."""
    p = table(spark, sf_dir, "passages").where("comm_id IS NOT NULL").select("comm_id", "passage_id", "pos", "verbatim").distinct()
    old = F.lag("verbatim").over(Window.partitionBy("comm_id").orderBy("pos", "passage_id"))
    return p.withColumn("old", old).select("passage_id", F.size(similarity.line_delta(F.col("old"), F.col("verbatim"))).alias("n_added"))


# --- annotators ---------------------------------------------------------------------------------------


@query("""
    WITH f AS (SELECT DISTINCT id, lower(coalesce(title, '')) AS t FROM filter_items WHERE id IS NOT NULL)
    SELECT id, CASE WHEN t LIKE '%debate%' THEN 'debate' WHEN t LIKE '%interview%' THEN 'interview' WHEN t LIKE '%presentation%' THEN 'presentation' WHEN t LIKE '%speech%' OR t LIKE '%remarks%' OR t LIKE '%address%' THEN 'speech' WHEN t = '' THEN 'unknown' ELSE 'other' END AS content_type FROM f""")
def ref_U2_content_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "filter_items").where("id IS NOT NULL").select("id", "title").distinct().select("id", annotate.content_type(F.col("title")).alias("content_type"))


@query(r"""
    WITH p AS (SELECT DISTINCT passage_id, entity, verbatim FROM passages WHERE entity IS NOT NULL AND verbatim IS NOT NULL),
         s AS (SELECT passage_id, entity, unnest(list_filter(string_split(regexp_replace(verbatim, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: x != '')) AS s FROM p)
    SELECT passage_id, count(*) AS n_sentences FROM s WHERE contains(lower(s), lower(entity)) GROUP BY passage_id""")
def ref_U4_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences that name the entity, the default of passage extraction."""
    p = table(spark, sf_dir, "passages").where("entity IS NOT NULL AND verbatim IS NOT NULL").select("passage_id", "entity", "verbatim").distinct()
    return annotate.mentions(p, "passage_id", "verbatim", "entity").groupBy("passage_id").agg(F.count(F.lit(1)).alias("n_sentences"))


@query("SELECT DISTINCT passage_id, CASE WHEN speaker IS NOT NULL THEN length(speaker) END AS n_chars, CASE WHEN speaker IS NULL THEN 'ValueError: no speaker' END AS error_message FROM passages")
def ref_R6_R8_isolated_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row whose work fails keeps its error; the rest goes on."""

    def work(row: dict) -> dict:
        if not isinstance(row["speaker"], str):
            raise ValueError("no speaker")
        return {"n_chars": len(row["speaker"])}

    p = table(spark, sf_dir, "passages").select("passage_id", "speaker").distinct()
    return faults.isolated(p, ["passage_id"], "n_chars long", work).select("passage_id", "n_chars", "error_message").distinct()


@query("SELECT DISTINCT id, 'Title: ' || coalesce(title, '') || chr(10) || 'Speakers: ' || array_to_string(coalesce(list_filter(active_speakers, lambda x: x IS NOT NULL), []), ', ') AS prompt FROM filter_items WHERE id IS NOT NULL")
def ref_P20_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array_join(F.coalesce("active_speakers", F.array().cast("array<string>")), ", ")
    return table(spark, sf_dir, "filter_items").where("id IS NOT NULL").select("id", F.concat(F.lit("Title: "), F.coalesce("title", F.lit("")), F.lit("\nSpeakers: "), names).alias("prompt")).distinct()


# --- validation -----------------------------------------------------------------------------------------


@query("""
    WITH v AS (
        SELECT DISTINCT claim_id, 'label_length' AS v FROM claims WHERE NOT coalesce(length(claim_label) BETWEEN 2 AND 50, false)
        UNION SELECT claim_id, 'label_words' FROM claims WHERE coalesce(len(regexp_split_to_array(trim(claim_label), '\\s+')) > 3, true)
        UNION SELECT claim_id, 'topic' FROM claims WHERE coalesce(topic, '') NOT IN {topics}
        UNION SELECT claim_id, 'sentiment' FROM claims WHERE coalesce(sentiment, '') NOT IN ('positive', 'negative', 'neutral', 'unclear')
        UNION SELECT claim_id, 'entity_type' FROM claims WHERE coalesce(entity_type, '') NOT IN ('organization', 'location', 'person', 'program', 'product', 'event', 'other')
        UNION SELECT claim_id, 'no_passages' FROM claims WHERE coalesce(len(passages), 0) < 1
        UNION SELECT claim_id, 'entity_name' FROM claims WHERE NOT coalesce(length(entity_name) BETWEEN 1 AND 200, false))
    SELECT claim_id, string_agg(v, ',' ORDER BY v) AS violations FROM v GROUP BY claim_id""".replace("{topics}", str(TOPICS)))
def ref_V1_V3_V4_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = G.violations(table(spark, sf_dir, "claims"), TOPICS, ENTITY_TYPES, SENTIMENTS).select("claim_id", F.explode("violations").alias("v")).distinct()
    return v.groupBy("claim_id").agg(F.array_join(F.array_sort(F.collect_list("v")), ",").alias("violations"))


@query("""
    WITH m AS (SELECT DISTINCT id, unnest(matched_speakers) AS s FROM filter_items), c AS (SELECT DISTINCT claim_id, comm_id, speaker FROM claims WHERE speaker IS NOT NULL AND comm_id IS NOT NULL)
    SELECT claim_id, speaker FROM c WHERE EXISTS (SELECT 1 FROM m WHERE m.id = c.comm_id AND m.s IS NOT NULL) AND NOT EXISTS (SELECT 1 FROM m WHERE m.id = c.comm_id AND m.s = c.speaker)""")
def ref_V2_unmatched_speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims of speakers that the item's matched speakers don't hold; items without any are passed over."""
    m = table(spark, sf_dir, "filter_items").select(F.col("id").alias("comm_id"), F.explode("matched_speakers").alias("speaker")).where("speaker IS NOT NULL").distinct()
    c = table(spark, sf_dir, "claims").where("speaker IS NOT NULL AND comm_id IS NOT NULL").select("claim_id", "comm_id", "speaker").distinct()
    return c.join(m.select("comm_id").distinct(), "comm_id", "left_semi").join(m, ["comm_id", "speaker"], "left_anti").select("claim_id", "speaker")


@query("SELECT DISTINCT comm_id, entity FROM whitelist w WHERE entity IS NOT NULL AND comm_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM claims c WHERE c.comm_id = w.comm_id AND c.entity_name = w.entity)")
def ref_V4_entities_without_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = table(spark, sf_dir, "whitelist").where("entity IS NOT NULL AND comm_id IS NOT NULL").select("comm_id", "entity").distinct()
    return w.join(table(spark, sf_dir, "claims").select("comm_id", F.col("entity_name").alias("entity")), ["comm_id", "entity"], "left_anti")


@query("""
    SELECT DISTINCT id, CASE WHEN title IS NULL THEN 'title is missing' WHEN id NOT IN (SELECT comm_id FROM passages WHERE comm_id IS NOT NULL) THEN 'no passages' END AS error_message FROM filter_items WHERE id IS NOT NULL""")
def ref_V6_V7_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items that can't be filtered or categorized, as they lack a title or passages."""
    p = table(spark, sf_dir, "passages").select(F.col("comm_id").alias("id")).distinct().withColumn("p", F.lit(1))
    error = F.when(F.col("title").isNull(), "title is missing").when(F.col("p").isNull(), "no passages")
    return table(spark, sf_dir, "filter_items").where("id IS NOT NULL").select("id", "title").distinct().join(p, "id", "left").select("id", error.alias("error_message")).distinct()


# --- graph ------------------------------------------------------------------------------------------------


@query("""
    SELECT DISTINCT id, coalesce(nullif(title, ''), 'Unknown') AS name, coalesce(nullif(title, ''), 'Unknown') AS title, coalesce(nullif(content_type, ''), 'other') AS content_type, coalesce(nullif(content_date, ''), 'Unknown') AS content_date,
           coalesce(source_url, '') AS source_url, md5(coalesce(full_text, '')) AS text_md5, coalesce(word_count, 0)::INT AS word_count, coalesce(was_summarized, false) AS was_summarized, coalesce(compression_ratio, 1.0) AS compression_ratio FROM node_communication WHERE id IS NOT NULL""")
def ref_G2_communication_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.communication_nodes(table(spark, sf_dir, "node_communication")).withColumn("text_md5", F.md5(F.col("full_text").cast("binary"))).drop("full_text")


@query(f"""
    WITH {CLAIMS}, t AS (SELECT *, comm_id || '__' || speaker || '__' || topic AS topic_id FROM c WHERE comm_id IS NOT NULL AND speaker IS NOT NULL AND topic IS NOT NULL),
    m AS (SELECT DISTINCT id, unnest(matched_speakers) AS s FROM filter_items)
    SELECT DISTINCT s AS src, 'DELIVERED' AS rel, id AS dst FROM m WHERE s IN (SELECT display_name FROM speakers)
    UNION ALL SELECT DISTINCT comm_id, 'HAS_TOPIC', topic_id FROM t UNION ALL SELECT DISTINCT topic_id, 'HAS_ENTITY', entity_name FROM t WHERE entity_name IS NOT NULL
    UNION ALL SELECT DISTINCT entity_name, 'HAS_CLAIM', claim_id::VARCHAR FROM t WHERE entity_name IS NOT NULL""")
def ref_G2_J12_edge_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.edges(table(spark, sf_dir, "filter_items"), table(spark, sf_dir, "speakers"), table(spark, sf_dir, "claims"))


@query(f"""
    WITH {CLAIMS} SELECT sha256(concat_ws(chr(1), coalesce(comm_id, ''), coalesce(speaker, ''), coalesce(topic, ''), coalesce(entity_name, ''), coalesce(claim_label, ''), claim_id::VARCHAR)) AS claim_key,
           claim_id, claim_label AS name, speaker, topic, sentiment, md5(summary) AS summary_md5 FROM c""")
def ref_G5_claim_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claim nodes; the table given twice makes none twice."""
    c = table(spark, sf_dir, "claims")
    return G.claim_nodes(c.unionAll(c)).select("claim_key", "claim_id", "name", "speaker", "topic", "sentiment", F.md5(F.col("summary").cast("binary")).alias("summary_md5"))


@query("""
    SELECT 'Speaker' AS label, count(DISTINCT display_name) AS n_nodes, 0::BIGINT AS n_broken FROM speakers UNION ALL SELECT 'Communication', count(DISTINCT id), 0 FROM node_communication
    UNION ALL SELECT 'Topic', count(DISTINCT comm_id || '__' || speaker || '__' || topic), 0 FROM claims UNION ALL SELECT 'Entity', count(DISTINCT entity_name), 0 FROM claims""")
def ref_G0_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the built nodes are unique and there."""
    c = table(spark, sf_dir, "claims")
    return G.broken_constraints(
        {
            "Speaker": (G.speaker_nodes(table(spark, sf_dir, "speakers")), "speaker_id"),
            "Communication": (G.communication_nodes(table(spark, sf_dir, "node_communication")), "id"),
            "Topic": (G.topic_nodes(c, table(spark, sf_dir, "node_topic")), "topic_id"),
            "Entity": (G.entity_nodes(c), "entity_name"),
        }
    )


@query("""
    WITH p AS (SELECT DISTINCT id AS c, s FROM (SELECT id, unnest(matched_speakers) AS s FROM filter_items) WHERE s IN (SELECT display_name FROM speakers)),
         k AS (SELECT DISTINCT claim_id, comm_id || '__' || speaker || '__' || topic AS t, entity_name AS e FROM claims WHERE comm_id IS NOT NULL AND speaker IS NOT NULL AND topic IS NOT NULL),
         x AS (SELECT count(*) AS p, count(DISTINCT s) AS s, count(DISTINCT c) AS c FROM p),
         y AS (SELECT count(DISTINCT t) AS t, count(DISTINCT CASE WHEN e IS NOT NULL THEN t || chr(1) || e END) AS te, count(DISTINCT e) AS e, count(e) AS k, count(DISTINCT CASE WHEN e IS NOT NULL THEN e || chr(1) || claim_id END) AS ek FROM k)
    SELECT 'Speaker' AS kind, p AS touched, s AS n FROM x UNION ALL SELECT 'Communication', p, c FROM x UNION ALL SELECT 'DELIVERED', p, p FROM x UNION ALL SELECT 'Topic', t, t FROM y UNION ALL SELECT 'HAS_TOPIC', t, t FROM y
    UNION ALL SELECT 'Entity', te, e FROM y UNION ALL SELECT 'HAS_ENTITY', te, te FROM y UNION ALL SELECT 'Claim', k, k FROM y UNION ALL SELECT 'HAS_CLAIM', k, ek FROM y""")
def ref_A14_load_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.load_counters(table(spark, sf_dir, "filter_items"), table(spark, sf_dir, "speakers"), table(spark, sf_dir, "claims"))
