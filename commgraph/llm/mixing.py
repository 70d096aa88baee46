"""Mixing sources to target shares by entropy balancing.

Every document d of source s gets a rate r_d, the expected number of its copies
in the mix. Of all rates between 0 and ``max_repeats`` that give each source its
tokens, those are taken that are closest in relative entropy to one copy each.
They are exponentially tilted, r_d = min(cap, exp(b_s t_d)) with t_d the
document's tokens over the source's mean; b_s solves the convex dual of the token
constraint, which is the only one: a second one on the number of documents would
be met by one uniform rate a source, whatever the documents. Where a source must
shrink, long documents give way first; where it must grow, they are repeated
first. Newton's steps, kept between bounds, need two sums a source, which are
Spark aggregates over a compact histogram (source, tokens, documents); the driver
sees those sums only. Rates are then rounded to whole copies systematically along
bounded strata of documents of like length, so that the copies of a stratum stray
from the sum of its rates by less than one; the report shows what was reached.

A source that can't reach its target with ``max_repeats`` copies of everything
gives all it has, and is reported.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commgraph.llm.tokens import VOCABULARY, token_count
from commgraph.runtime import cut

STEPS = 60
TOLERANCE = 1e-9
#: Documents of a stratum in which rates are rounded together.
STRATUM = 20_000


def token_table(docs: DataFrame, doc: str, text: str, source: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc, source, tokens), written out: the texts are read once."""
    return cut(docs.select(F.col(doc).alias("doc"), F.col(source).alias("source"), token_count(text, vocabulary).alias("tokens")), "tokens")


def source_totals(tokens: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per source of ``targets``: (source, target_share, max_repeats,
    n_docs, n_tokens, wanted), wanted tokens being its share of the tokens of
    all documents, those of other or null sources included."""
    by = tokens.groupBy("source").agg(F.count(F.when(F.col("tokens") > 0, 1)).alias("n_docs"), F.sum("tokens").alias("n_tokens"))
    total = by.agg(F.sum("n_tokens")).first()[0] or 0
    t = targets.select("source", "target_share", "max_repeats").where("source IS NOT NULL").dropDuplicates(["source"])
    return t.join(by, "source", "left").select(
        "source", "target_share", "max_repeats", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"), (F.col("target_share") * F.lit(float(total))).alias("wanted")
    )


def short_of(totals: DataFrame) -> DataFrame:
    """Sources whose documents, all ``max_repeats`` times, don't make the target."""
    return totals.where(F.col("max_repeats") * F.col("n_tokens") < F.col("wanted"))


def balance(histogram: DataFrame, totals: list[dict], steps: int = STEPS) -> dict[str, tuple[float, float]]:
    """(a, b, m) of each source whose target lies strictly below its cap: a
    document of ``t`` tokens has the rate min(cap, exp(a + b t / m)), with a = 0.

    ``histogram`` is (source, tokens, n), tokens from 1. The tokens of a source
    grow with b, and b has the bounds that the shortest possible document sets; a
    step that leaves them is replaced by halving. Steps stop when every constraint
    is met to TOLERANCE; the number of sources bounds what is broadcast and what
    comes back.
    """
    spark = histogram.sparkSession
    state = {}
    for r in totals:
        if r["n_tokens"] and 0 < r["wanted"] < r["max_repeats"] * r["n_tokens"] * (1 - 1e-12):
            m, share, cap = r["n_tokens"] / r["n_docs"], r["wanted"] / r["n_tokens"], float(r["max_repeats"])
            state[r["source"]] = {"b": 0.0, "m": m, "cap": cap, "want": share * r["n_docs"], "lo": min(0.0, m * math.log(share)), "hi": m * math.log(cap) if share > 1 else 0.0, "done": False}
    for _ in range(steps):
        going = {s: x for s, x in state.items() if not x["done"]}
        if not going:
            break
        duals = F.broadcast(spark.createDataFrame([(s, x["b"], x["m"], x["cap"]) for s, x in going.items()], "source string, b double, m double, cap double"))
        sums = (
            histogram.join(duals, "source")
            .withColumn("t", F.col("tokens") / F.col("m"))
            .withColumn("raw", F.exp(F.col("b") * F.col("t")))
            .groupBy("source")
            .agg(
                F.sum(F.least("raw", "cap") * F.col("n") * F.col("t")).alias("f"),
                F.sum(F.when(F.col("raw") < F.col("cap"), F.col("raw") * F.col("n") * F.col("t") * F.col("t")).otherwise(0.0)).alias("h"),
            )
            .collect()
        )
        for s in sums:
            x = state[s["source"]]
            if abs(x["want"] - s["f"]) <= TOLERANCE * x["want"]:
                x["done"] = True
                continue
            x["lo" if s["f"] < x["want"] else "hi"] = x["b"]
            # the sum is about exponential in b: Newton's step is taken on its logarithm
            b = x["b"] + math.log(x["want"] / s["f"]) * s["f"] / s["h"] if s["f"] > 0 and s["h"] > 0 else math.nan
            x["b"] = b if x["lo"] < b < x["hi"] else (x["lo"] + x["hi"]) / 2
    left = [s for s, x in state.items() if not x["done"]]
    if left:
        raise ValueError(f"no balance after {steps} steps: {left}")
    return {s: (0.0, x["b"], x["m"]) for s, x in state.items()}


def mix(tokens: DataFrame, targets: DataFrame) -> DataFrame:
    """(doc, source, tokens, rate, copies): the mix, documents without a copy left out.

    ``copies`` never exceeds ``max_repeats``. Documents of sources that aren't
    in ``targets``, or of no source, aren't used. Documents without tokens add
    nothing and are left out. Repeated rows are documents of their own.
    """
    spark = tokens.sparkSession
    totals = [r.asDict() for r in source_totals(tokens, targets).collect()]  # one row per target
    histogram = cut(tokens.where("source IS NOT NULL AND tokens > 0").groupBy("source", "tokens").agg(F.count(F.lit(1)).alias("n")), "histogram")
    duals = balance(histogram, totals)
    rows = []
    for r in totals:
        if r["n_tokens"] and r["wanted"] > 0:
            a, b, m = duals.get(r["source"], (60.0, 0.0, 1.0))
            rows.append((r["source"], a, b, m, float(r["max_repeats"]), 1 + r["n_docs"] // STRATUM))
    known = F.broadcast(spark.createDataFrame(rows, "source string, a double, b double, m double, cap double, salts int"))
    rate = F.least(F.exp(F.col("a") + F.col("b") * F.col("tokens") / F.col("m")), F.col("cap"))
    h = F.xxhash64(F.lit(17), "source", "doc")
    # systematic rounding: along a stratum of documents of like length the copies never stray from the sum of the rates by one
    w = Window.partitionBy("source", "size", "salt").orderBy("h", "doc")
    before = F.sum("part").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.pmod(F.xxhash64("source", "size", "salt"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return (
        tokens.where("tokens > 0")
        .join(known, "source")
        .withColumn("rate", rate)
        .withColumn("part", F.round(F.col("rate") - F.floor("rate"), 9))
        .withColumn("h", h)
        .withColumn("size", F.floor(F.log2(F.col("tokens"))))
        .withColumn("salt", F.pmod(F.xxhash64("h"), F.col("salts")))
        .withColumn("upto", before)
        .withColumn("copies", (F.floor("rate") + F.floor("upto") - F.floor(F.col("upto") - F.col("part"))).cast("int"))
        .where("copies > 0")
        .select("doc", "source", "tokens", "rate", "copies")
    )


def mix_report(tokens: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per target: (source, target_share, wanted, n_docs, n_tokens,
    mixed_tokens, reached_share, most_copies, short). ``reached_share`` is of the
    tokens of the whole mix."""
    totals = source_totals(tokens, targets)
    got = mix(tokens, targets).groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("mixed_tokens"), F.max("copies").alias("most_copies"))
    out = totals.join(got, "source", "left").na.fill(0, ["mixed_tokens", "most_copies"])
    whole = F.sum("mixed_tokens").over(Window.partitionBy(F.lit(1)))  # one row per target
    return out.withColumn("reached_share", F.col("mixed_tokens") / whole).withColumn("short", F.col("max_repeats") * F.col("n_tokens") < F.col("wanted"))


def short_in_mix(report: DataFrame) -> DataFrame:
    """Sources that the mix leaves below their target with every document at the
    cap, by what was mixed; ``short_of`` says the same by comparing totals."""
    return report.where((F.col("mixed_tokens") == F.col("max_repeats") * F.col("n_tokens")) & (F.col("mixed_tokens") < F.col("wanted")))
