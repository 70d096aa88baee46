"""The training-text queries, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commgraph.llm import batches, boilerplate, leakage, mixing, names, residue, spans, split, transcripts
from commgraph.runtime import table

Query = Callable[[SparkSession, str], DataFrame]


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.cut_kinds(table(spark, sf_dir, "extract_context"), "id", "content")


def p2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_oversized(table(spark, sf_dir, "extract_context"), "id", "content")


def p2_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts put together again from their pieces, and whether every piece keeps to limit and overlap."""
    return split.put_together(table(spark, sf_dir, "extract_context").select("id", "content").distinct(), "id", "content")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "discovered")
    return batches.first_of_article(t, "disc_id", "batch_no", "url", "title", "publication_date").select(F.col("first").alias("first_disc_id"), F.col("record").alias("disc_id"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "text").select("doc_id", "item_id")


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaked items with the number of documents and the longest run of words."""
    found = leakage.leaked(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "text")
    return found.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_docs"), F.max("n_words").alias("most_words"))


def p8_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches by proximity: a word left out, put in or changed between one and the next counts still."""
    return leakage.leaked(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "text", slack=1)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = mixing.token_table(table(spark, sf_dir, "documents"), "doc_id", "text", "source")
    return mixing.short_in_mix(mixing.mix_report(tokens, table(spark, sf_dir, "mix_targets"))).select("source")


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = mixing.token_table(table(spark, sf_dir, "documents"), "doc_id", "text", "source")
    return mixing.mix(tokens, table(spark, sf_dir, "mix_targets")).withColumnRenamed("doc", "doc_id")


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = mixing.token_table(table(spark, sf_dir, "documents"), "doc_id", "text", "source")
    return mixing.mix_report(tokens, table(spark, sf_dir, "mix_targets"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.found_pairs(table(spark, sf_dir, "documents"), "doc_id", "text")


def p10_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.shared_share(table(spark, sf_dir, "documents"), "doc_id", "text")


def p10_representatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links in short: each document's representative, and the pairs of those."""
    return spans.set_pairs(table(spark, sf_dir, "documents"), "doc_id", "text")


QUERIES: dict[str, Query] = {f.__name__: f for f in (p2_found, p2_pieces, p2_whole, p4_found, p8_found, p8_report, p8_near, p9_found, p9_mix, p9_shares, p10_found, p10_shared, p10_representatives)}


def _turns(spark: SparkSession, sf_dir: str, speech: bool) -> DataFrame:
    people = table(spark, sf_dir, "speakers")
    comm = transcripts.turns(table(spark, sf_dir, "node_communication"), F.col("id"), "full_text", people, speech=speech)
    said = transcripts.turns(table(spark, sf_dir, "passages"), F.col("passage_id"), "verbatim", people, hint=F.col("speaker"), speech=speech)
    return comm.withColumn("relation", F.lit("node_communication")).unionByName(said.withColumn("relation", F.lit("passages")))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turns(spark, sf_dir, speech=False).select("relation", F.col("rec").alias("rec_id"), "turn_no", "speaker").distinct()


def p7_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turns(spark, sf_dir, speech=True).select("relation", F.col("rec").alias("rec_id"), "turn_no", "speaker", F.col("said").alias("utterance"))


QUERIES |= {f.__name__: f for f in (p7_found, p7_turns)}


def _residue(spark: SparkSession, sf_dir: str, taken: DataFrame | None = None) -> DataFrame:
    return residue.residue(table(spark, sf_dir, "filter_items"), F.col("id"), "content", taken)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _residue(spark, sf_dir).where("is_residue").select(F.col("rec").alias("id")).distinct()


def p3_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``filter_items`` without the records that are residue."""
    t = table(spark, sf_dir, "filter_items")
    return t.join(_residue(spark, sf_dir).where("is_residue").select(F.col("rec").alias("id")).distinct(), "id", "left_anti").select("id", "title", "content_type", F.length("content").alias("n_chars"))


QUERIES |= {f.__name__: f for f in (p3_found, p3_kept)}


def _pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, boilerplate.Weights]:
    """The pages of both relations taken apart, the ids of those that are residue, and the weights learned from all of them."""
    a = boilerplate.taken_apart(table(spark, sf_dir, "filter_items"), "content", F.col("id"), F.col("title"))
    b = boilerplate.taken_apart(table(spark, sf_dir, "node_communication"), "full_text", F.col("id"), F.col("title"))
    bad = _residue(spark, sf_dir, a).where("is_residue").select("rec").distinct()
    return a, b, bad, boilerplate.learn_taken(a.unionAll(b))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b, bad, weights = _pages(spark, sf_dir)
    flags = None
    for relation, rows, without in (("filter_items", a, bad), ("node_communication", b, None)):
        own = boilerplate.flags_of(rows, weights, body=False, without=without).withColumn("relation", F.lit(relation))
        flags = own if flags is None else flags.unionByName(own)
    return flags.select("relation", F.col("rec").alias("id"), "line_no")


def p6_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, bad, weights = _pages(spark, sf_dir)
    items = table(spark, sf_dir, "filter_items").join(bad.withColumnRenamed("rec", "id"), "id", "left_anti").select("id", "title", F.col("content").alias("text"))
    pages = table(spark, sf_dir, "node_communication").select("id", "title", F.col("full_text").alias("text"))
    out = None
    for relation, rows in (("filter_items", items), ("node_communication", pages)):
        own = boilerplate.main_bodies(rows, F.col("id"), "text", weights, F.col("title")).withColumn("relation", F.lit(relation))
        out = own if out is None else out.unionByName(own)
    return out.select("relation", F.col("rec").alias("id"), "body", "n_lines", "n_kept")


QUERIES |= {f.__name__: f for f in (p6_found, p6_bodies)}


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.union_of(
        table(spark, sf_dir, "filter_items").select(F.explode("active_speakers").alias("name")),
        table(spark, sf_dir, "whitelist").select(F.col("entity").alias("name")),
        table(spark, sf_dir, "claims").select(F.col("entity_name").alias("name")),
    )


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.variant_pairs(_names(spark, sf_dir), "name")


def p5_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct string with its entity and how often it stands."""
    return names.link_names(_names(spark, sf_dir), "name")


QUERIES |= {f.__name__: f for f in (p5_found, p5_entities)}
