"""Dates by vote, outlier trimming, first-seen deduplication and stop conditions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commgraph.vocab import DATE_WEIGHTS

THRESHOLD = 2


def weight(source: Column) -> Column:
    w = F.lit(0)
    for s, k in DATE_WEIGHTS.items():
        w = F.when(source == s, k).otherwise(w)
    return w


def vote_dates(candidates: DataFrame, article: str, date: str, source: str, pos: str, least: int = THRESHOLD) -> DataFrame:
    """(article, publication_date, date_score, date_source), one row per article.

    A date scores its sources' weights plus one for each candidate after the
    first; the highest score wins, on a tie the date met first. Its source is the
    heaviest one, on a tie the one met first. Under ``least`` all three are null.
    Candidates without a date don't vote; an article with no others has nulls.
    """
    c = candidates.select(F.col(article).alias("article"), F.col(date).alias("d"), F.col(source).alias("s"), F.col(pos).alias("p")).withColumn("w", weight(F.col("s")))
    heavy = F.min(F.struct((-F.col("w")).alias("w"), F.col("p"), F.col("s").alias("s")))
    by_date = c.groupBy("article", "d").agg((F.sum("w") + F.count(F.lit(1)) - 1).alias("score"), F.min("p").alias("p"), heavy.alias("h"))
    best = Window.partitionBy("article").orderBy(F.col("d").isNull(), F.desc("score"), "p")
    top = by_date.withColumn("k", F.row_number().over(best)).where("k = 1")
    good = F.col("d").isNotNull() & (F.col("score") >= least)
    return top.select(
        "article",
        F.when(good, F.col("d")).alias("publication_date"),
        F.when(good, F.col("score")).alias("date_score"),
        F.when(good, F.col("h.s")).alias("date_source"),
    )


def mark_inliers(rows: DataFrame, batch: str, day: Column, today: str, slack: int = 5) -> DataFrame:
    """``rows`` with ``inlier``: false for dates outside the middle nine tenths of
    their batch by more than ``slack`` days, or after ``today``. Rows without a
    date, and batches without any, stay in.

    The exact percentiles are taken over day counts, which are few; the join
    back is on the batch, whose limits are one row each.
    """
    n = F.datediff(day, F.lit("1970-01-01").cast("date"))
    known = rows.select(F.col(batch).alias("_b"), n.alias("_n")).where("_n IS NOT NULL").groupBy("_b", "_n").agg(F.count(F.lit(1)).alias("_c"))
    limits = known.groupBy("_b").agg(F.expr("percentile(_n, array(0.05, 0.95), _c)").alias("_q"))
    last = F.datediff(F.lit(today).cast("date"), F.lit("1970-01-01").cast("date"))
    inside = (n >= F.col("_q")[0] - slack) & (n <= F.least(F.col("_q")[1] + slack, last.cast("double")))
    return rows.join(limits, rows[batch] == F.col("_b"), "left").withColumn("inlier", F.when(n.isNull() | F.col("_q").isNull(), True).otherwise(inside)).drop("_b", "_q")


def first_valid(rows: DataFrame, key: str, order: str, valid: Column) -> DataFrame:
    """The first valid row of each key; invalid rows don't mark a key as seen."""
    w = Window.partitionBy(key).orderBy(order)
    return rows.where(valid).withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def first_batches(rows: DataFrame, batch: str, key: str) -> DataFrame:
    """(batch, key), one row per key: the first batch that has it, so a batch's
    rows are the keys no earlier batch had. Null keys and batches are left out."""
    return rows.where(F.col(key).isNotNull() & F.col(batch).isNotNull()).groupBy(key).agg(F.min(batch).alias(batch)).select(batch, key)


def batch_progress(rows: DataFrame, batch: str, key: str, day: Column, start: str, followed: Column | None = None) -> DataFrame:
    """(batch, n_rows, n_new, below, duplicate_only, barren_run) of each batch:
    keys first seen in it, whether a date lies before the day before ``start``,
    whether nothing was new, and how many batches in a row, up to it, brought
    nothing new; the run starts afresh where something was new or a row shows
    that a link was ``followed``. Counters of batches are windowed, not rows."""
    firsts = rows.groupBy(F.col(key).alias("k")).agg(F.min(batch).alias("b")).groupBy("b").agg(F.count(F.lit(1)).alias("n_new"))
    sums = rows.groupBy(F.col(batch).alias("b")).agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.when(day < F.date_sub(F.lit(start).cast("date"), 1), 1).otherwise(0)).alias("below"), F.max(F.when(F.lit(False) if followed is None else followed, 1).otherwise(0)).alias("reset"))
    s = sums.join(firsts, "b", "left").na.fill(0, ["n_new"])
    w = Window.partitionBy(F.lit(0)).orderBy("b")  # one row per batch
    s = s.withColumn("island", F.sum(F.when((F.col("n_new") > 0) | (F.col("reset") == 1), 1).otherwise(0)).over(w))
    run = Window.partitionBy("island").orderBy("b")
    return s.select(
        F.col("b").alias("batch"), "n_rows", "n_new", (F.col("below") == 1).alias("below"), (F.col("n_new") == 0).alias("duplicate_only"), F.sum(F.when((F.col("n_new") == 0) & (F.col("reset") == 0), 1).otherwise(0)).over(run).alias("barren_run")
    )


def crawl_stops(rows: DataFrame, session: str, batch: str, url: str, max_pages: int) -> DataFrame:
    """(session, batch, page, n_visited, n_failed, stop): the pages of a session in
    order of batch; actions on an address that an earlier page of the session
    had, and rows without an address to follow. A session stops at a page that
    only repeats actions, that has no address, or is beyond ``max_pages``."""
    own = rows.select(F.col(session).alias("session"), F.col(batch).alias("batch"), F.nullif(F.col(url), F.lit("")).alias("u")).where("session IS NOT NULL AND batch IS NOT NULL")
    first = own.where("u IS NOT NULL").groupBy("session", "u").agg(F.min("batch").alias("first"))
    actions = own.where("u IS NOT NULL").distinct().join(first, ["session", "u"]).groupBy("session", "batch").agg(F.count(F.lit(1)).alias("n_actions"), F.count(F.when(F.col("first") < F.col("batch"), 1)).alias("n_visited"))
    pages = own.groupBy("session", "batch").agg(F.count(F.when(F.col("u").isNull(), 1)).alias("n_failed")).join(actions, ["session", "batch"], "left").na.fill(0, ["n_actions", "n_visited"])
    page = F.row_number().over(Window.partitionBy("session").orderBy("batch"))  # one row per page
    stop = F.when(F.col("page") > max_pages, "max pages").when(F.col("n_actions") == 0, "no address").when(F.col("n_visited") == F.col("n_actions"), "visited")
    return pages.withColumn("page", page).select("session", "batch", "page", "n_visited", "n_failed", stop.alias("stop"))
