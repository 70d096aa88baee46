import random

import commgraph.llm.spans as S


def brute(docs, span):
    grams = [(d, {t[k : k + span] for k in range(len(t) - span + 1)}) for d, t in docs]
    return {(min(a, b), max(a, b)) for i, (a, x) in enumerate(grams) for b, y in grams[i + 1 :] if a != b and x & y}


def cover(docs, span):
    out = {}
    for d, t in docs:
        others = {u[k : k + span] for e, u in docs if e != d for k in range(len(u) - span + 1)}
        on = [False] * len(t)
        for k in range(len(t) - span + 1):
            if t[k : k + span] in others:
                on[k : k + span] = [True] * span
        out[d] = sum(on)
    return out


def fixture(seed, many):
    rnd = random.Random(seed)
    text = lambda n: "".join(rnd.choice("abcdé 漢\n") for _ in range(n))
    common = text(330)
    docs = [(k, text(rnd.choice([0, 200, 500, 900]))) for k in range(30)]
    for k in range(30, 55):
        src = rnd.choice(docs)[1] + text(300)
        a = rnd.randint(0, max(0, len(src) - 310))
        docs.append((k, text(rnd.randint(0, 200)) + src[a : a + rnd.choice([299, 300, 301, 450])] + text(rnd.randint(0, 100))))
    docs += [(60 + k, text(rnd.randint(0, 50)) + common[rnd.randint(0, 20) :][:310] + text(rnd.randint(0, 50))) for k in range(many)]
    docs += [(200, docs[31][1]), (201, docs[31][1])]
    return docs


def test_pairs_and_shares_against_brute_force(spark, monkeypatch):
    for seed, many in ((1, 5), (2, 40)):
        docs = fixture(seed, many)
        df = spark.createDataFrame([(d, t, 1) for d, t in [*docs, (300, None), docs[0]]], "doc_id long, text string, cls int")
        pairs, want = brute(docs, 300), cover(docs, 300)
        texts = dict(docs)
        linked = {d: len({texts[a + b - d] for a, b in pairs if d in (a, b)} - {t}) for d, t in docs}
        for together in (S.TOGETHER, 3):  # hot windows spread over all tasks give the same
            assert {tuple(r) for r in S.found_pairs(df, "doc_id", "text", together=together).collect()} == pairs
            shares = {r["doc_id"]: (r["n_shared"], r["n_linked"]) for r in S.shared_share(df, "doc_id", "text", together=together).collect()}
            assert shares == {d: (want[d], linked[d]) for d, t in docs if len(t) >= 300}
        short = S.set_pairs(df, "doc_id", "text").collect()
        of = {r["a"]: r["b"] for r in short if r["kind"] == "member"}
        links = {(r["a"], r["b"]) for r in short if r["kind"] == "link"}
        alone = {d for d in of if not any(d in p for p in pairs)}
        assert {(a, b) for a in of for b in of if a < b and a not in alone and (of[a] == of[b] or (min(of[a], of[b]), max(of[a], of[b])) in links)} == pairs
    assert S.found_pairs(df.limit(0), "doc_id", "text").collect() == []


def test_text_longer_than_a_slice(spark, monkeypatch):
    rnd = random.Random(5)
    long = "".join(rnd.choice("abcdefgh") for _ in range(700_000))
    docs = [(1, long), (2, "x" * 50 + long[299_900:300_210] + "y"), (3, long[599_000:599_299] + "z" * 40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {tuple(r) for r in S.found_pairs(df, "doc_id", "text").collect()} == {(1, 2)}


def test_one_span_in_many_documents_is_linear(spark):
    rnd = random.Random(8)
    span = "".join(rnd.choice("abcdefgh ") for _ in range(330))
    docs = [(k, "".join(rnd.choice("abcdefgh ") for _ in range(40)) + span + "".join(rnd.choice("abcdefgh ") for _ in range(40))) for k in range(5000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    short = S.set_pairs(df, "doc_id", "text")
    assert short.where("kind = 'member'").count() == 5000 and short.where("kind = 'link'").count() < 5000
    assert [tuple(r) for r in S.shared_share(df, "doc_id", "text").groupBy("n_linked").count().collect()] == [(4999, 5000)]
