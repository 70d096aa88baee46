"""Extractive summaries: centrality of sentences by their vectors, and a budgeted prefix."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commgraph.functions import text as T

#: SLACK is in hundredths, as 200 * 1.15 is below 230 in floating point.
NEAR, SLACK, LEAST, BLOCK = 3, 115, 3, 1024


def centrality(sentences: DataFrame) -> DataFrame:
    """(doc, idx, score) from (doc, idx, vec, words).

    Similarity rows are weighted by length against the document's 0.9 quantile;
    0.7 of the row's median over all sentences and 0.3 of its mean over those up
    to three places away, each scaled to 0..1 within the document. A document's
    sentences come together once and are multiplied block by block, so memory
    grows with their number and not its square.
    """
    kinds = {f.name: f.dataType.simpleString() for f in sentences.schema}

    def scaled(x: np.ndarray) -> np.ndarray:
        return (x - x.min()) / (x.max() - x.min() + 1e-8)

    def scores(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        v, words, idx = np.array(pdf["vec"].tolist(), np.float64), pdf["words"].to_numpy(np.float64), pdf["idx"].to_numpy()
        n = np.sqrt((v * v).sum(1, keepdims=True))
        v = np.divide(v, n, out=np.zeros_like(v), where=n > 0)
        q = np.quantile(words, 0.9)
        weight = np.minimum(words / q, 1.0) if q > 0 else np.ones(len(words))
        middle, around = np.empty(len(v)), np.empty(len(v))
        for k in range(0, len(v), BLOCK):
            m = v[k : k + BLOCK] @ v.T * weight[k : k + BLOCK, None]
            middle[k : k + BLOCK] = np.median(m, axis=1)
            lo, hi = max(0, k - NEAR), min(len(v), k + len(m) + NEAR)  # places that can be near
            gap = np.abs(idx[k : k + len(m), None] - idx[None, lo:hi])
            by = (gap >= 1) & (gap <= NEAR)
            some = by.sum(1)
            around[k : k + BLOCK] = np.divide((m[:, lo:hi] * by).sum(1), some, out=np.zeros(len(m)), where=some > 0)
        return pd.DataFrame({"doc": pdf["doc"].to_numpy(), "idx": idx, "score": 0.7 * scaled(middle) + 0.3 * scaled(around)})

    return sentences.select("doc", "idx", "vec", "words").where("vec IS NOT NULL").groupBy("doc").applyInPandas(scores, f"doc {kinds['doc']}, idx {kinds['idx']}, score double")


def budgeted_prefix(scored: DataFrame, budget: int) -> DataFrame:
    """Of (doc, idx, score, tokens): the best sentences while their tokens stay
    within ``budget`` times SLACK hundredths; the first that overflows ends the prefix.
    Documents of fewer than three sentences are kept whole."""
    rank = Window.partitionBy("doc").orderBy(F.desc("score"), F.desc("idx"))
    s = scored.withColumn("used", F.sum("tokens").over(rank.rowsBetween(Window.unboundedPreceding, 0))).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("doc")))
    return s.where((F.col("n") < LEAST) | (F.col("used") <= budget * SLACK // 100)).select("doc", "idx", "score", "tokens")


def split_sentences(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, idx, sentence, words) of each document; null and empty texts have none."""
    s = docs.select(F.col(doc).alias("doc"), F.posexplode(T.sentences(text)).alias("idx", "sentence"))
    return s.select("doc", "idx", "sentence", T.word_count("sentence").alias("words"))


def joined(kept: DataFrame) -> DataFrame:
    """(doc, summary) of (doc, idx, sentence): the sentences in their order again."""
    return kept.groupBy("doc").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "sentence"))), lambda x: x["sentence"]), " ").alias("summary"))


def summaries(docs: DataFrame, doc: str, text: str, budget: int) -> DataFrame:
    """(doc, summary): sentences ranked by the centrality of their vectors, the
    best within the budget of words, in their order. Rows of one document are
    taken once."""
    s = split_sentences(docs.select(doc, text).distinct(), doc, text)
    scored = centrality(s.withColumn("vec", T.embedding(F.col("sentence")))).join(s.select("doc", "idx", F.col("words").alias("tokens")), ["doc", "idx"])
    return joined(budgeted_prefix(scored, budget).select("doc", "idx").join(s.select("doc", "idx", "sentence"), ["doc", "idx"]))
