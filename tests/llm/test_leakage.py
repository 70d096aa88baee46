import random

import numpy as np

from commgraph.llm import leakage as L


def brute(docs, items, n):
    out = set()
    for d, t in docs:
        w = L.words(t)
        grams = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
        for i, s in items:
            v = L.words(s)
            if any(tuple(v[k : k + n]) in grams for k in range(len(v) - n + 1)):
                out.add((d, i))
    return out


def test_against_brute_force_with_segments_and_long_texts(spark, tmp_path):
    rnd = random.Random(3)
    vocab = ["the", "a", "of"] * 4 + [f"w{k}" for k in range(12)]
    docs = [(d, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([0, 3, 60, 400])))) for d in range(60)]
    docs += [(60, None), (61, "The A. of, THE_a"), (61, "The A. of, THE_a"), (2, "x y")]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([2, 8, 20])))) for i in range(60)]
    items += [(100, None), (101, "")]
    for n in (4, 6):
        a = spark.createDataFrame([(d, t, 0) for d, t in docs], "doc_id long, text string, term int")
        b = spark.createDataFrame(items, "item_id long, text string")
        for segment, lap, block in ((1_000_000, 20_000, 20_000), (150, 40, 7)):
            p = L.write_index(a, "doc_id", "text", str(tmp_path / f"{n}-{segment}"), segment, lap)
            got = {(r["doc_id"], r["item_id"]) for r in L.search(p, b, "item_id", "text", n, block=block).collect()}
            assert got == brute([x for x in docs if x[1]], [x for x in items if x[1]], n)
    assert L.leaked(a.limit(0), "doc_id", "text", b, "item_id", "text").collect() == []
    assert L.leaked(a, "doc_id", "text", b.limit(0), "item_id", "text").collect() == []


def chains(docs, items, n, slack):
    """By trying every chain of hits."""
    out = {}
    for d, t in docs:
        w = L.words(t)
        for i, s in items:
            v = L.words(s)
            best = {}
            for p in range(len(w)):
                for k in range(len(v)):
                    if w[p] == v[k]:
                        best[p, k] = 1 + max((best.get((p - x, k - y), 0) for x in range(1, slack + 2) for y in range(1, slack + 2)), default=0)
            m = max(best.values(), default=0)
            if m >= n:
                out[d, i] = max(m, out.get((d, i), 0))
    return out


def test_proximity_against_brute_force(spark, tmp_path):
    rnd = random.Random(11)
    vocab = ["the", "a", "of"] * 2 + [f"w{k}" for k in range(20)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([3, 9, 16])))) for i in range(25)]
    docs = []
    for d in range(60):
        w = []
        for _ in range(rnd.randint(0, 3)):
            for x in L.words(rnd.choice(items)[1]):
                w += [] if rnd.random() < 0.1 else [x, rnd.choice(vocab)] if rnd.random() < 0.1 else [rnd.choice(vocab)] if rnd.random() < 0.1 else [x]
            w += [rnd.choice(vocab) for _ in range(rnd.randint(0, 9))]
        docs.append((d, " ".join(w)))
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for n, slack, segment, lap in ((6, 1, 1_000_000, 20_000), (6, 2, 150, 60), (8, 0, 1_000_000, 20_000)):
        p = L.write_index(a, "doc_id", "text", str(tmp_path / f"{n}-{slack}"), segment, lap)
        got = {(r["doc_id"], r["item_id"]): r["n_words"] for r in L.search(p, b, "item_id", "text", n, slack, block=9).collect()}
        assert got == chains(docs, items, n, slack) and got


def test_proximity_keeps_order_and_ends_of_documents(spark):
    item = [f"k{i}" for i in range(14)]
    swapped = [x for k in range(0, 14, 2) for x in (item[k + 1], item[k])]
    docs = spark.createDataFrame([(1, " ".join(item[:7])), (2, " ".join(item[7:])), (3, " ".join(swapped)), (4, " ".join(item[:6] + ["very"] + item[6:]))], "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")
    hit = lambda s: {r["doc_id"] for r in L.leaked(docs, "doc_id", "text", items, "item_id", "text", slack=s).collect()}
    assert hit(0) == set() and hit(1) == {4} and hit(2) == {4}


def test_pack():
    for x in ([], [0], [5, 9, 70000, 10_000_000], list(range(0, 5000, 3))):
        assert L.unpack(L.pack(np.array(x, np.int64))).tolist() == x
