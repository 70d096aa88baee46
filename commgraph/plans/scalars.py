"""Projections, filters and lookups on the stage tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commgraph.config import LIMITS
from commgraph.functions import text as T
from commgraph.functions import urls as U
from commgraph.functions.dates import parse_date
from commgraph.operators import discovery as D
from commgraph.runtime import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

SLUG = r"trim(regexp_replace(regexp_replace(lower(trim({0})), '[^\p{{L}}\p{{N}}\p{{M}}_\s-]', '', 'g'), '[-\s]+', '-', 'g'), '-')"
SLUG_TITLE = SLUG.format("title")
REST = r"regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.\-]*:', '')"
NETLOC = rf"regexp_extract({REST}, '^//([^/?#]*)', 1)"
PATH = rf"regexp_extract(regexp_replace({REST}, '^//[^/?#]*', ''), '^([^?#]*)', 1)"
DATE = "try_strptime(publication_date, '%Y-%m-%d')::DATE"


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return keep


@query(f"SELECT disc_id, {SLUG_TITLE} AS slug, left({SLUG_TITLE}, 40) AS slug40, left({SLUG_TITLE}, 40) || '_' || left(md5(url), 6) AS article_id FROM discovered")
def ref_P1_P2_article_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "discovered").select("disc_id", T.slugify("title").alias("slug"), T.slugify("title", 40).alias("slug40"), U.article_id(F.col("title"), F.col("url")).alias("article_id"))


@query(rf"""
    WITH u AS (SELECT disc_id, url, split_part(replace({NETLOC}, 'www.', ''), '.', 1) AS host, {SLUG.format(f"split_part(trim({PATH}, '/'), '/', 1)")} AS seg, regexp_replace({NETLOC}, '^www\.', '') AS d FROM discovered)
    SELECT disc_id, CASE WHEN coalesce(url, '') = '' THEN 'unknown-source' WHEN seg = '' THEN host ELSE host || '-' || seg END AS source_slug, d AS domain FROM u""")
def ref_P3_P4_source_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "discovered").select("disc_id", U.source_slug(F.col("url")).alias("source_slug"), U.domain_key(F.col("url")).alias("domain"))


WORDS = r"CASE WHEN {0} IS NULL THEN NULL WHEN regexp_replace({0}, '^\s+|\s+$', '', 'g') = '' THEN 0 ELSE len(regexp_split_to_array(regexp_replace({0}, '^\s+|\s+$', '', 'g'), '\s+')) END"


@query(f"SELECT doc_id, ({WORDS.format('text')})::INT AS n_words FROM documents")
def ref_P5_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.word_count("text").alias("n_words"))


@query(f"""
    WITH s AS (SELECT DISTINCT id, full_text, word_count FROM node_communication WHERE id IS NOT NULL),
         r AS (SELECT id, word_count, {WORDS.format('full_text')} AS o FROM s)
    SELECT id, CASE WHEN o = 0 OR o IS NULL THEN 1.0 ELSE round(word_count / o::DOUBLE, 6) END AS ratio,
           CASE WHEN o > 0 AND word_count < o THEN word_count END AS summary_words, CASE WHEN o > 0 AND word_count < o THEN o END AS original_words FROM r""")
def ref_P6_P7_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "node_communication").where("id IS NOT NULL").select("id", "full_text", "word_count").distinct().select("id", "word_count", T.word_count("full_text").alias("o"))
    short = (F.col("o") > 0) & (F.col("word_count") < F.col("o"))
    return s.select("id", F.when(F.coalesce("o", F.lit(0)) == 0, 1.0).otherwise(F.round(F.col("word_count") / F.col("o"), 6)).alias("ratio"), F.when(short, F.col("word_count")).alias("summary_words"), F.when(short, F.col("o").cast("bigint")).alias("original_words"))


@query(r"""
    WITH s AS (SELECT id, max(CASE WHEN regexp_replace(content, '\s+', '', 'g') != '' THEN md5(content) END) AS c FROM filter_items GROUP BY id),
         e AS (SELECT id, max(CASE WHEN regexp_replace(content, '\s+', '', 'g') != '' THEN md5(content) END) AS c FROM extract_context GROUP BY id)
    SELECT s.id, coalesce(e.c, s.c) AS content_md5, CASE WHEN e.c IS NOT NULL THEN 'summarize' WHEN s.c IS NOT NULL THEN 'scrape' ELSE 'Empty content' END AS origin FROM s LEFT JOIN e USING (id)""")
def ref_P8_content_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    def side(name: str, alias: str) -> DataFrame:
        return table(spark, sf_dir, name).groupBy("id").agg(F.max(F.when(~T.is_blank("content"), F.md5(F.col("content").cast("binary")))).alias(alias))

    j = side("filter_items", "s").join(side("extract_context", "e"), "id", "left")
    return j.select("id", F.coalesce("e", "s").alias("content_md5"), F.when(F.col("e").isNotNull(), "summarize").when(F.col("s").isNotNull(), "scrape").otherwise("Empty content").alias("origin"))


@query("""
    WITH f AS (SELECT id, max(nullif(content_type, '')) AS t FROM filter_items GROUP BY id)
    SELECT DISTINCT c.id, CASE WHEN coalesce(c.title, '') = '' THEN 'Unknown' ELSE c.title END AS title, CASE WHEN coalesce(c.content_date, '') = '' THEN 'Unknown' ELSE c.content_date END AS content_date,
           coalesce(c.source_url, '') AS source_url, coalesce(f.t, 'other') AS content_type, coalesce(f.t, 'unknown') AS state_content_type, coalesce(c.compression_ratio, 1.0) < 1 AS was_summarized
    FROM node_communication c LEFT JOIN f USING (id)""")
def ref_P11_P12_communication_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = table(spark, sf_dir, "filter_items").groupBy("id").agg(F.max(F.nullif("content_type", F.lit(""))).alias("t"))

    def known(c: str, default: str):
        return F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(default)).alias(c)

    return table(spark, sf_dir, "node_communication").join(f, "id", "left").select(
        "id", known("title", "Unknown"), known("content_date", "Unknown"), F.coalesce("source_url", F.lit("")).alias("source_url"), F.coalesce("t", F.lit("other")).alias("content_type"),
        F.coalesce("t", F.lit("unknown")).alias("state_content_type"), (F.coalesce("compression_ratio", F.lit(1.0)) < 1).alias("was_summarized"),
    ).distinct()


@query("SELECT disc_id, nullif(regexp_extract('a[href=''' || url || ''']', '^a\\[href=''(.*?)''\\]', 1), '') AS href, url || ':click:' || 'a[href=''' || url || ''']' AS action_key FROM discovered")
def ref_P15_P16_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    sel = F.concat(F.lit("a[href='"), F.col("url"), F.lit("']"))
    return table(spark, sf_dir, "discovered").select("disc_id", U.href_of(sel).alias("href"), F.concat_ws(":", "url", F.lit("click"), sel).alias("action_key"))


@query(r"SELECT doc_id, md5(array_to_string(list_slice(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]'), 1, 10000), ' ')) AS first_tokens FROM documents WHERE text IS NOT NULL")
def ref_P17_token_truncation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.md5(T.first_tokens("text", LIMITS.preview_tokens)).alias("first_tokens"))


BODY = "content"
for _tag in T.NOT_SAMPLED:
    BODY = rf"regexp_replace({BODY}, '<{_tag}(?:\s[^>]*)?>.*?</{_tag}\s*>', '', 'gis')"


@query(f"""
    WITH s AS (SELECT DISTINCT id, content FROM extract_context WHERE content IS NOT NULL), b AS (SELECT id, {BODY} AS content FROM s), t AS (SELECT id, content, length(content) AS n FROM b)
    SELECT id, md5(substr(content, floor(n * 0.25)::INT + 1, least(floor(n * 0.25)::INT + 30000, floor(n * 0.75)::INT) - floor(n * 0.25)::INT)) AS sample FROM t""")
def ref_P18_html_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "extract_context").where("content IS NOT NULL").select("id", "content").distinct().select("id", F.md5(T.middle_sample(T.without_blocks("content"), LIMITS.html_sample).cast("binary")).alias("sample"))


@query("SELECT disc_id, strftime(discovered_at, 'discovery-%Y%m%d_%H%M%S') AS discovery_id, coalesce(publication_date, 'unknown') || ' to present' AS date_range FROM discovered")
def ref_P23_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "discovered").select("disc_id", F.date_format("discovered_at", "'discovery-'yyyyMMdd_HHmmss").alias("discovery_id"), F.concat(F.coalesce("publication_date", F.lit("unknown")), F.lit(" to present")).alias("date_range"))


@query(f"SELECT disc_id, {DATE} AS published FROM discovered WHERE date_score >= 2 AND {DATE} BETWEEN DATE '2024-06-01' AND DATE '2025-12-31'")
def ref_F1_F2_valid_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = parse_date(F.col("publication_date"))
    return table(spark, sf_dir, "discovered").where((F.col("date_score") >= 2) & day.between("2024-06-01", "2025-12-31")).select("disc_id", day.alias("published"))


@query(f"""
    WITH d AS (SELECT disc_id, batch_no, date_diff('day', DATE '1970-01-01', {DATE}) AS n FROM discovered),
         q AS (SELECT batch_no, quantile_cont(n, 0.05) AS lo, quantile_cont(n, 0.95) AS hi FROM d WHERE n IS NOT NULL GROUP BY batch_no)
    SELECT disc_id, batch_no, coalesce(n IS NULL OR lo IS NULL OR (n >= lo - 5 AND n <= least(hi + 5, date_diff('day', DATE '1970-01-01', DATE '2025-12-31'))), true) AS inlier FROM d LEFT JOIN q USING (batch_no)""")
def ref_F3_A2_inliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "discovered").select("disc_id", "batch_no", "publication_date")
    return D.mark_inliers(t, "batch_no", parse_date(F.col("publication_date")), "2025-12-31").select("disc_id", "batch_no", "inlier")


@query("""
    WITH f AS (SELECT DISTINCT id, active_speakers FROM filter_items WHERE id IS NOT NULL),
         e AS (SELECT id, md5(array_to_string(coalesce(active_speakers, []), '|')) AS v, unnest(active_speakers) AS s, generate_subscripts(active_speakers, 1) AS k FROM f WHERE len(active_speakers) > 0),
         m AS (SELECT id, v, string_agg(s, '|' ORDER BY k) AS matched, count(*) AS n FROM e WHERE s IN (SELECT display_name FROM speakers) GROUP BY id, v)
    SELECT f.id, coalesce(m.matched, '') AS matched, coalesce(n, 0) AS n_matched, coalesce(n, 0) > 0 AS is_relevant
    FROM f LEFT JOIN m ON m.id = f.id AND m.v = md5(array_to_string(coalesce(f.active_speakers, []), '|'))""")
def ref_F5_F6_J4_matched_speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order and repeats are kept; the registry is met by a semi-join, whatever its size."""
    f = table(spark, sf_dir, "filter_items").where("id IS NOT NULL").select("id", "active_speakers").distinct().withColumn("v", F.md5(F.array_join(F.coalesce("active_speakers", F.array().cast("array<string>")), "|")))
    e = f.select("id", "v", F.posexplode("active_speakers").alias("k", "s"))
    m = e.join(table(spark, sf_dir, "speakers").select(F.col("display_name").alias("s")).distinct(), "s", "left_semi").groupBy("id", "v").agg(F.array_sort(F.collect_list(F.struct("k", "s"))).alias("m"))
    size = F.when(F.col("m").isNull(), 0).otherwise(F.size("m"))
    return f.join(m, ["id", "v"], "left").select("id", F.coalesce(F.array_join(F.transform("m", lambda x: x["s"]), "|"), F.lit("")).alias("matched"), size.cast("bigint").alias("n_matched"), (size > 0).alias("is_relevant"))


@query("SELECT passage_id, comm_id, speaker, entity FROM (SELECT DISTINCT * FROM passages) p WHERE EXISTS (SELECT 1 FROM whitelist w WHERE w.comm_id = p.comm_id AND w.speaker = p.speaker AND w.entity = p.entity)")
def ref_F7_J5_whitelist_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "passages").distinct().select("passage_id", "comm_id", "speaker", "entity")
    return p.join(table(spark, sf_dir, "whitelist").select("comm_id", "speaker", "entity"), ["comm_id", "speaker", "entity"], "left_semi").select("passage_id", "comm_id", "speaker", "entity")


@query("SELECT DISTINCT comm_id, speaker, trim(entity) AS entity FROM whitelist WHERE trim(coalesce(entity, '')) != '' AND speaker IS NOT NULL")
def ref_F8_blank_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "whitelist").where("trim(coalesce(entity, '')) != '' AND speaker IS NOT NULL").select("comm_id", "speaker", F.trim("entity").alias("entity")).distinct()


@query("SELECT speaker, count(*) AS n_claims, bool_or(r.display_name IS NOT NULL) AS known FROM claims c LEFT JOIN (SELECT DISTINCT display_name FROM speakers) r ON c.speaker = r.display_name WHERE speaker IS NOT NULL GROUP BY speaker")
def ref_F9_J2_registry_speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted before the join, so a hot speaker meets the registry once."""
    n = table(spark, sf_dir, "claims").where("speaker IS NOT NULL").groupBy("speaker").agg(F.count(F.lit(1)).alias("n_claims"))
    r = table(spark, sf_dir, "speakers").select(F.col("display_name").alias("speaker")).distinct().withColumn("k", F.lit(True))
    return n.join(r, "speaker", "left").select("speaker", "n_claims", F.coalesce("k", F.lit(False)).alias("known"))


@query("SELECT DISTINCT d.batch_no, d.url FROM discovered d WHERE d.batch_no > 0 AND d.url IS NOT NULL AND NOT EXISTS (SELECT 1 FROM discovered o WHERE o.batch_no < d.batch_no AND o.url = d.url)")
def ref_F12_J6_new_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch against all earlier ones, history included: an address is new in the first batch that has it."""
    return D.first_batches(table(spark, sf_dir, "discovered"), "batch_no", "url").where("batch_no > 0")


@query(f"""
    WITH d AS (SELECT date_trunc('day', discovered_at) AS day_, batch_no, search_url AS k, {DATE} AS p FROM discovered),
         b AS (SELECT batch_no, count(*) AS n_rows, coalesce(bool_or(p < DATE '2024-01-09'), false) AS below FROM d GROUP BY batch_no),
         n AS (SELECT b, count(*) AS n_new FROM (SELECT k, min(batch_no) AS b FROM d GROUP BY k) GROUP BY b),
         s AS (SELECT b.batch_no, n_rows, coalesce(n_new, 0) AS n_new, below FROM b LEFT JOIN n ON n.b = b.batch_no),
         i AS (SELECT *, sum(CASE WHEN n_new > 0 THEN 1 ELSE 0 END) OVER (ORDER BY batch_no) AS island FROM s)
    SELECT batch_no AS batch, n_rows, n_new, below, n_new = 0 AS duplicate_only, (sum(CASE WHEN n_new = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY island ORDER BY batch_no))::BIGINT AS barren_run FROM i""")
def ref_F13_F15_W3_W4_stop_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.batch_progress(table(spark, sf_dir, "discovered"), "batch_no", "search_url", parse_date(F.col("publication_date")), "2024-01-10")


@query(f"""
    SELECT url, disc_id FROM (SELECT url, disc_id, row_number() OVER (PARTITION BY url ORDER BY disc_id) AS k FROM discovered WHERE date_score >= 2 AND {DATE} >= DATE '2024-06-01') WHERE k = 1""")
def ref_W2_F11_first_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "discovered")
    return D.first_valid(t, "url", "disc_id", (F.col("date_score") >= 2) & (parse_date(F.col("publication_date")) >= F.lit("2024-06-01").cast("date"))).select("url", "disc_id")


@query("""
    WITH c AS (SELECT id, publication_date AS d, date_source AS s, disc_id AS p, CASE date_source WHEN 'datetime_attr' THEN 7 WHEN 'schema_org' THEN 5 WHEN 'url_path' THEN 3 WHEN 'near_title' THEN 2 WHEN 'metadata' THEN 1 ELSE 0 END AS w FROM discovered),
         g AS (SELECT id, d, sum(w) + count(*) - 1 AS score, min(p) AS p FROM c GROUP BY id, d),
         h AS (SELECT id, d, s FROM (SELECT *, row_number() OVER (PARTITION BY id, d ORDER BY w DESC, p) AS k FROM c) WHERE k = 1),
         t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d IS NULL, score DESC, p) AS k FROM g) WHERE k = 1)
    SELECT t.id AS article, CASE WHEN t.d IS NOT NULL AND score >= 2 THEN t.d END AS publication_date, (CASE WHEN t.d IS NOT NULL AND score >= 2 THEN score END)::BIGINT AS date_score,
           CASE WHEN t.d IS NOT NULL AND score >= 2 THEN h.s END AS date_source FROM t JOIN h ON t.id = h.id AND t.d IS NOT DISTINCT FROM h.d""")
def ref_A1_T5_date_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.vote_dates(table(spark, sf_dir, "discovered"), "id", "publication_date", "date_source", "disc_id")


@query(f"SELECT batch_no, min(publication_date) AS first_text, max(publication_date) AS last_text, min({DATE}) AS first_day, max({DATE}) AS last_day, count({DATE}) AS n_dated, count(*) AS total, count(DISTINCT url) AS n_urls, count(*) - count(DISTINCT url) AS duplicates FROM discovered GROUP BY batch_no")
def ref_A9_A10_A11_discovery_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = parse_date(F.col("publication_date"))
    return table(spark, sf_dir, "discovered").groupBy("batch_no").agg(
        F.min("publication_date").alias("first_text"), F.max("publication_date").alias("last_text"), F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count(day).alias("n_dated"),
        F.count(F.lit(1)).alias("total"), F.countDistinct("url").alias("n_urls"), (F.count(F.lit(1)) - F.countDistinct("url")).alias("duplicates"),
    )


@query("SELECT d.disc_id, d.url FROM discovered d WHERE d.search_url IN (SELECT search_url FROM discovered WHERE batch_no > 0)")
def ref_S5_J9_lookup_by_attribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "discovered")
    return t.join(t.where("batch_no > 0").select("search_url"), "search_url", "left_semi").select("disc_id", "url")
