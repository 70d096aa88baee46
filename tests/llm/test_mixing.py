import math
import random

import tiktoken

from commgraph.llm import mixing as M
from commgraph.llm import tokens as T


def test_counts_equal_the_tokenizer():
    import base64

    with open(T.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("x", pat_str=T.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(2)
    n = T.counter(T.VOCABULARY)
    for _ in range(3000):
        s = "".join(rnd.choice([" ", " ", "a", "the", "12", "\n", "'s", "é", ".", "  ", "\t", "漢", " "]) for _ in range(rnd.randint(0, 30)))
        assert n(s) == len(enc.encode_ordinary(s)), repr(s)


def test_mix_reaches_its_shares(spark):
    rnd = random.Random(4)
    docs = [(i, s, rnd.randint(0, 600) if i % 50 else 20_000) for i, s in enumerate(["a"] * 4000 + ["b"] * 300 + ["c"] * 10 + ["d"] * 500 + [None] * 20)]
    df = spark.createDataFrame(docs, "doc long, source string, tokens long")
    t = spark.createDataFrame([("a", 0.4, 1), ("b", 0.2, 4), ("c", 0.3, 5), ("z", 0.1, 2)], "source string, target_share double, max_repeats int")
    total = sum(d[2] for d in docs)
    got = {r["source"]: r for r in M.mix_report(df, t).collect()}
    assert {s for s, r in got.items() if r["short"]} == {"c", "z"} == {r["source"] for r in M.short_of(M.source_totals(df, t)).collect()}
    for s in "ab":
        assert abs(got[s]["mixed_tokens"] / (got[s]["target_share"] * total) - 1) < 0.05, got[s]
    assert got["c"]["mixed_tokens"] == 5 * sum(d[2] for d in docs if d[1] == "c") and got["z"]["mixed_tokens"] == 0
    assert max(r["most_copies"] / r["max_repeats"] for r in got.values()) <= 1
    assert abs(sum(r["reached_share"] for r in got.values()) - 1) < 1e-9
    assert M.mix(df.limit(0), t).collect() == [] and {r["source"] for r in M.short_of(M.source_totals(df.limit(0), t)).collect()} == set()


def test_newton_meets_the_constraints(spark):
    rows = [("a", t, 10) for t in range(1, 400)] + [("b", 7, 90)]
    h = spark.createDataFrame(rows, "source string, tokens long, n long")
    totals = [{"source": s, "n_docs": sum(r[2] for r in rows if r[0] == s), "n_tokens": sum(r[1] * r[2] for r in rows if r[0] == s), "max_repeats": 4} for s in "ab"]
    for share in (0.03, 0.9, 3.99):
        for x in totals:
            x["wanted"] = share * x["n_tokens"]
        for s, (a, b, m) in M.balance(h, totals).items():
            got = sum(min(4.0, 2.718281828459045 ** (a + b * t / m)) * t * n for q, t, n in rows if q == s)
            want = next(x["wanted"] for x in totals if x["source"] == s)
            assert abs(got / want - 1) < 1e-6


def test_rates_are_tilted_by_tokens(spark):
    docs = [(i, s, 50 + 13 * (i % 70)) for i, s in enumerate(["a"] * 700 + ["b"] * 700)]
    df = spark.createDataFrame(docs, "doc long, source string, tokens long")
    # far more of a wanted than there is of it, far less of b
    t = spark.createDataFrame([("a", 0.8, 3), ("b", 0.2, 3)], "source string, target_share double, max_repeats int")
    total = sum(d[2] for d in docs)
    totals = [r.asDict() for r in M.source_totals(df, t).collect()]
    duals = M.balance(df.groupBy("source", "tokens").count().withColumnRenamed("count", "n"), totals)
    rates = {s: {k: min(3.0, math.exp(a + b * k / m)) for _, q, k in docs if q == s} for s, (a, b, m) in duals.items()}
    for s, share in (("a", 0.8), ("b", 0.2)):
        lo, hi = rates[s][50], rates[s][50 + 13 * 69]
        assert hi > 1.5 * lo if s == "a" else lo > 1.5 * hi
        assert abs(sum(rates[s][k] * k for _, q, k in docs if q == s) / (share * total) - 1) < 1e-6
    got = M.mix(df, t).collect()
    assert all(abs(r["rate"] - rates[r["source"]][r["tokens"]]) < 1e-9 for r in got) and len({r["rate"] for r in got}) > 50


def test_balance_with_few_very_long_documents(spark):
    rows = [("a", k, 3) for k in range(1, 300)] + [("a", 200_000, 2), ("a", 3_000_000, 1)]
    h = spark.createDataFrame(rows, "source string, tokens long, n long")
    n_docs, n_tokens = sum(r[2] for r in rows), sum(r[1] * r[2] for r in rows)
    for share, cap in ((0.001, 1), (0.5, 1), (0.999, 2), (1.5, 2), (4.99, 5)):
        (_, b, m) = M.balance(h, [{"source": "a", "n_docs": n_docs, "n_tokens": n_tokens, "max_repeats": cap, "wanted": share * n_tokens}])["a"]
        assert abs(sum(min(cap, math.exp(min(b * k / m, 50))) * k * n for _, k, n in rows) / (share * n_tokens) - 1) < 1e-6


def test_found_comes_from_the_mix(spark, monkeypatch):
    from commgraph.llm import queries as Q

    sf, mixed = "/root/testdata/sf0.001", []
    balance = M.balance
    monkeypatch.setattr(M, "balance", lambda h, totals: mixed.append(balance(h, totals)) or mixed[-1])
    got = [r["source"] for r in Q.p9_found(spark, sf).collect()]
    assert mixed and mixed[0]
    tokens = M.token_table(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id", "text", "source")
    assert sorted(got) == sorted(r["source"] for r in M.short_of(M.source_totals(tokens, spark.read.parquet(f"{sf}/mix_targets.parquet"))).collect())
    assert not set(got) & set(mixed[0])
