import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from commgraph.functions import text as T
from commgraph.functions import urls as U
from commgraph.functions.dates import parse_date
from commgraph.operators import discovery as D
from commgraph.operators import graph as G
from commgraph.operators import similarity as S
from commgraph.operators import state
from commgraph.operators.summarize import budgeted_prefix, centrality
from commgraph.vocab import ENTITY_TYPES, SENTIMENTS, TOPICS


def one(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_slugs(spark):
    rows = [("Trump Announces New Policy",), ("Été à Paris – 2026",), ("naïve_test  --x",), ("日本 news",), ("",), (None,)]
    assert [r[0] for r in one(spark, rows, "t string", T.slugify("t", 20))] == ["trump-announces-new-", "été-à-paris-2026", "naïve_test-x", "日本-news", "", None]


def test_words_blank_and_tokens(spark):
    rows = [("a  b\tc d",), ("  ",), ("",), (None,)]
    assert one(spark, rows, "t string", T.word_count("t"), T.is_blank("t")) == [(4, False), (0, True), (0, True), (None, True)]
    assert one(spark, [("One, two three",)], "t string", T.first_tokens("t", 3)) == [("One , two",)]


def test_urls(spark):
    rows = [("https://www.a.b.example/news/x?y=1",), ("https://a.example",), ("a.example/news",), (None,), ("",), ("https://u:p@www.a.example:8/n e/",)]
    got = one(spark, rows, "u string", U.source_slug(F.col("u")), U.domain_key(F.col("u")))
    assert got == [("a-news", "a.b.example"), ("a", "a.example"), ("-aexample", ""), ("unknown-source", None), ("unknown-source", ""), ("u:p@a-n-e", "u:p@www.a.example:8")]
    assert one(spark, [("a[href='/x']",), ('a[href="/x"]',)], "u string", U.href_of(F.col("u"))) == [("/x",), (None,)]


def test_dates(spark):
    assert [r[0] for r in one(spark, [("2026-2-4",), ("2026-02-04",), ("x",), (None,)], "d string", parse_date(F.col("d")))] == [dt.date(2026, 2, 4)] * 2 + [None] * 2


VOTES = {
    "once": ([("d1", "metadata")], (None, None, None)),
    "twice": ([("d1", "metadata"), ("d1", "metadata")], ("d1", 3, "metadata")),
    "tie": ([("d1", "near_title"), ("d2", "near_title")], ("d1", 2, "near_title")),
    "unknown": ([("d1", "rumour")], (None, None, None)),
    "both": ([("d1", "near_title"), ("d1", "url_path")], ("d1", 6, "url_path")),
    "none": ([(None, "datetime_attr")], (None, None, None)),
    "part": ([(None, "datetime_attr"), ("d2", "near_title")], ("d2", 2, "near_title")),
}


def test_votes(spark):
    rows = [(a, d, s, k, "x") for a, (cs, _) in VOTES.items() for k, (d, s) in enumerate(cs)]
    df = spark.createDataFrame(rows, "a string, d string, s string, k int, score string")
    got = {r[0]: tuple(r)[1:] for r in D.vote_dates(df, "a", "d", "s", "k").collect()}
    assert got == {a: want for a, (_, want) in VOTES.items()}
    assert D.vote_dates(df.limit(0), "a", "d", "s", "k").collect() == []


def test_inliers(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(k) for k in range(100)]
    rows = [("a", d) for d in days] + [("a", dt.date(2020, 1, 1)), ("a", None), ("a", dt.date(2030, 1, 1)), ("b", None)]
    got = D.mark_inliers(spark.createDataFrame(rows, "b string, d date"), "b", F.col("d"), "2024-03-01").collect()
    out = {(r["b"], r["d"]): r["inlier"] for r in got}
    assert not out[("a", dt.date(2020, 1, 1))] and not out[("a", dt.date(2030, 1, 1))] and out[("a", None)] and out[("b", None)]
    assert out[("a", dt.date(2024, 3, 1))] and not out[("a", dt.date(2024, 3, 2))]


def test_first_valid_and_progress(spark):
    rows = [(1, "u", False), (2, "u", True), (3, "u", True), (4, "v", False)]
    df = spark.createDataFrame(rows, "k int, url string, ok boolean")
    assert [r["k"] for r in D.first_valid(df, "url", "k", F.col("ok")).collect()] == [2]
    d = dt.date(2024, 5, 10)
    rows = [(1, "a", d), (2, "a", d), (3, "a", dt.date(2024, 5, 8)), (4, "b", d), (5, "a", dt.date(2024, 5, 9))]
    got = [tuple(r) for r in D.batch_progress(spark.createDataFrame(rows, "b int, u string, d date"), "b", "u", F.col("d"), "2024-05-10").orderBy("batch").collect()]
    assert got == [(1, 1, 1, False, False, 0), (2, 1, 0, False, True, 1), (3, 1, 0, True, True, 2), (4, 1, 1, False, False, 0), (5, 1, 0, False, True, 1)]


LOG = "article_id int, stage string, seq int, status string, error_message string, completed_at string, processing_time double, file_path string, metadata string"


def entry(a, stage, seq, status, meta=None, t=1.0):
    ok = status != "FAILED"
    return (a, stage, seq, status, None if ok else "boom", f"t{seq}" if ok else None, t if ok else None, f"f{seq}" if ok else None, json.dumps(meta) if meta else None)


def test_fold_and_states(spark):
    rows = [entry(1, "discover", 1, "FAILED"), entry(1, "discover", 2, "FAILED"), entry(1, "discover", 3, "COMPLETED", {"a": "1"}), entry(1, "discover", 3, "COMPLETED", {"a": "1"})]
    rows += [entry(2, "discover", 1, "COMPLETED", {"a": "1"}), entry(2, "discover", 2, "FAILED", {"a": "2", "b": "3"}), entry(2, "scrape", 3, "FAILED")]
    rows += [entry(3, "discover", 1, "COMPLETED"), entry(3, "filter", 2, "COMPLETED"), entry(4, "filter", 1, "FILTERED"), entry(5, "graph", 1, "COMPLETED")]
    fold = state.fold_log(spark.createDataFrame(rows, LOG))
    got = {(r["article_id"], r["stage"]): r for r in fold.collect()}
    a, b = got[(1, "discover")], got[(2, "discover")]
    assert (a["retry_count"], a["error_message"], a["completed_at"]) == (2, None, "t3")
    assert (b["status"], b["completed_at"], b["file_path"], b["metadata"]) == ("FAILED", "t1", "f1", {"a": "2", "b": "3"})
    s = {r["article_id"]: (r["latest_completed_stage"], r["next_stage"], r["is_filtered"]) for r in state.rebuild_states(fold).collect()}
    assert s == {1: ("discover", "scrape", False), 2: (None, None, False), 3: ("filter", "summarize", False), 4: ("filter", None, True), 5: ("graph", None, False)}
    assert [r["article_id"] for r in state.ready_for(state.rebuild_states(fold), "summarize").collect()] == [3]


def test_similarity():
    assert S.keep_first(["abcdefghij" * 3, "abcdefghij" * 3 + "x", "zzz"]) == [True, False, True]
    a = "a" * 17 + "b" * 3
    assert S.keep_first([a, "a" * 17 + "c" * 3]) == [True, True]  # exactly 0.85 stays
    assert S.keep_longest(["abcdefghi", "abcdefghij", "bcd", "q"]) == ["abcdefghij", "q"]
    assert S.added_lines("a\nb", "a\nc\nb\nd") == ["c", "d"]


def test_dedup_passages(spark):
    rows = [("c", 1, "hello there my friend", 9), ("c", 2, "hello there my friends", 9), ("c", 3, None, 9), ("d", 4, "hello there my friends", 9)]
    df = spark.createDataFrame(rows, "g string, k int, t string, extra int")
    assert sorted(r["k"] for r in S.dedup_passages(df, ["g"], "k", "t").collect()) == [1, 4]


def test_budget_breaks_at_the_first_overflow(spark):
    rows = [("d", 0, 0.9, 5), ("d", 1, 0.8, 20), ("d", 2, 0.7, 1), ("e", 0, 0.1, 99), ("e", 1, 0.2, 99)]
    got = {(r["doc"], r["idx"]) for r in budgeted_prefix(spark.createDataFrame(rows, "doc string, idx int, score double, tokens int"), 10).collect()}
    assert got == {("d", 0), ("e", 0), ("e", 1)}


def test_budgeted_prefix_reaches_the_exact_budget(spark):
    rows = [("d", k, 9.0 - k, t) for k, t in enumerate([100, 100, 30, 1])]
    got = {r["idx"] for r in budgeted_prefix(spark.createDataFrame(rows, "doc string, idx int, score double, tokens int"), 200).collect()}
    assert got == {0, 1, 2}  # 230 words, which are 1.15 times 200


def test_centrality_against_numpy(spark):
    np = pytest.importorskip("numpy")
    rnd = np.random.default_rng(1)
    v, words = rnd.normal(size=(9, 5)).astype("float32"), rnd.integers(3, 30, 9)
    df = spark.createDataFrame([("d", k, [float(x) for x in v[k]], int(words[k])) for k in range(9)], "doc string, idx int, vec array<float>, words int")
    u = v.astype("float64")
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    m = (u @ u.T) * np.minimum(words / np.quantile(words, 0.9), 1)[:, None]
    g = np.median(m, axis=1)
    n = np.array([np.mean([m[i, j] for j in range(max(0, i - 3), min(9, i + 4)) if j != i]) for i in range(9)])
    scale = lambda x: (x - x.min()) / (x.max() - x.min() + 1e-8)
    want = 0.7 * scale(g) + 0.3 * scale(n)
    got = {r["idx"]: r["score"] for r in centrality(df).collect()}
    assert all(abs(got[k] - want[k]) < 1e-9 for k in range(9))


CLAIMS = "claim_id int, comm_id string, entity_name string, entity_type string, speaker string, topic string, claim_label string, sentiment string, summary string, passages array<string>"


def test_graph(spark):
    rows = [(1, "c1", "Apple", "organization", "A", "legal", "x y", "positive", "s" * 600, ["p"]), (2, "c1", "apple", "product", "A", "legal", "a b c d", "bad", "t", []), (3, "c2", "Apple", "location", None, "media", "x", None, "u", None)]
    c = spark.createDataFrame([*rows, rows[0]], CLAIMS)
    s = spark.createDataFrame([("c9__A__legal", "none")], "topic_id string, topic_summary string")
    t = G.topic_nodes(c, s).collect()
    assert [(r["topic_id"], r["n_claims"], len(r["topic_summary"])) for r in t] == [("c1__A__legal", 2, 500)]
    assert {r["entity_name"]: r["entity_type"] for r in G.entity_nodes(c).collect()} == {"Apple": "location", "apple": "product"}
    assert G.claim_nodes(c).count() == G.claim_nodes(c.unionAll(c)).count() == 3
    v = {r["claim_id"]: set(r["violations"]) for r in G.violations(c, TOPICS, ENTITY_TYPES, SENTIMENTS).collect()}
    assert v == {1: set(), 2: {"label_words", "sentiment", "no_passages"}, 3: {"label_length", "sentiment", "no_passages"}}
    items = spark.createDataFrame([("c1", ["A", "A", "Z"]), ("c2", None)], "id string, matched_speakers array<string>")
    reg = spark.createDataFrame([("A", "r", "o", "i", "g"), ("A", "r", "o", "i", "g")], "display_name string, role string, organization string, industry string, region string")
    e = G.edges(items, reg, c).groupBy("rel").count().collect()
    assert {r[0]: r[1] for r in e} == {"DELIVERED": 1, "HAS_TOPIC": 1, "HAS_ENTITY": 2, "HAS_CLAIM": 2}
    assert G.speaker_nodes(reg).count() == 1


def test_new_addresses_of_every_batch(spark, tmp_path):
    from commgraph.plans import catalog

    rows = [("a", 0), ("b", 1), ("a", 1), ("c", 2), ("b", 2), ("d", 7), ("d", 7), ("c", 7), (None, 3)]
    spark.createDataFrame(rows, "url string, batch_no int").write.parquet(f"{tmp_path}/discovered.parquet")
    got = catalog.queries()["ref_F12_J6_new_urls"](spark, str(tmp_path)).collect()
    assert sorted((r["batch_no"], r["url"]) for r in got) == [(1, "b"), (2, "c"), (7, "d")]


def test_stage_log_keeps_every_event(spark):
    from commgraph.plans import knowledge as K

    sf = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{sf}/events.parquet")
    log = K.stage_log(spark, sf)
    assert log.count() == events.count()
    assert log.where(state.stage_order(F.col("stage")) > F.col("article_id") % 7).count() == 0
    assert K.QUERIES["ref_A6_S9_stage_fold"](spark, sf).agg(F.sum("retry_count")).first()[0] == events.where("event_type = 'error'").count()


def test_communication_nodes_and_constraints(spark):
    schema = "id string, title string, content_type string, content_date string, source_url string, full_text string, word_count int, was_summarized boolean, compression_ratio double, n_nodes int"
    rows = [("a", "T", "speech", "2024-01-02", "u", "x" * 100_000, 3, True, 0.5, 1)] * 2 + [("b", None, None, "", None, None, None, None, None, 2), (None, "t", "s", "d", "u", "x", 1, False, 1.0, 3)]
    n = G.communication_nodes(spark.createDataFrame(rows, schema))
    got = {r["id"]: tuple(r) for r in n.collect()}
    assert set(got) == {"a", "b"} and got["b"] == ("b", "Unknown", "Unknown", "other", "Unknown", "", "", 0, False, 1.0) and got["a"][1] == "T" and len(n.columns) == 10
    assert [tuple(r) for r in G.broken_constraints({"C": (n, "id"), "D": (n.unionAll(n), "id"), "E": (n.limit(0), "id")}).collect()] == [("C", 2, 0), ("D", 4, 2), ("E", 0, 0)]


def test_chunks():
    import random

    from commgraph.operators.chunks import chunk, spans_of

    rnd = random.Random(3)
    for _ in range(500):
        text = "".join(rnd.choice(["word ", "longer", "\n", "\n\n", " ", "x" * rnd.randint(1, 30)]) for _ in range(rnd.randint(0, 60)))
        size, overlap = rnd.randint(20, 60), rnd.randint(0, 15)
        cs = chunk(text, 0 if rnd.random() < 0.9 else 10**6, size, overlap)
        assert cs[0][0] == 0 and cs[-1][1] == len(text)
        for (a, b), (c, d) in zip(cs, cs[1:]):
            assert a < c <= b < d and b - c <= overlap
        longest = max((z - a for a, z in spans_of(text, 0, len(text), size)), default=0)
        assert all(b - a <= max(size, longest) for a, b in cs) or len(cs) == 1
    assert chunk("x" * 79_999) == [(0, 79_999)] and chunk("") == [(0, 0)] and len(chunk("word " * 20_000)) > 1


def test_chunked_frame(spark):
    from commgraph.operators.chunks import chunked

    df = spark.createDataFrame([("a", "w " * 50_000, 1), ("b", "short", 2), ("c", None, 3), ("d", "", 4)], "id string, content string, chunk int")
    got = {r["id"]: r["count"] for r in chunked(df, "id", "content").groupBy("id").count().collect()}
    assert got["a"] == 3 and got["b"] == got["d"] == 1 and "c" not in got


def test_retry_isolation_stages_and_guards(spark):
    import dataclasses

    from commgraph.config import RETRIES, RetryPolicy
    from commgraph.operators.faults import isolated, retry
    from commgraph.stage import Stage, guard

    tries, waits = [], []

    def work():
        tries.append(1)
        if len(tries) < 3:
            raise ValueError("no")
        return 7

    assert retry(work, RetryPolicy(2, 10.0, 0.5), waits.append) == 7 and all(10 <= w <= 15 for w in waits) and len(waits) == 2
    with pytest.raises(KeyError):
        retry(lambda: {}["x"], RetryPolicy(1, 0.0), waits.append)
    assert RETRIES["discover"].timeout == 1000 and RETRIES["filter"].timeout == 60
    with pytest.raises(dataclasses.FrozenInstanceError):
        RETRIES["graph"].retries = 9
    df = spark.createDataFrame([(1, 2), (2, 0), (3, None)], "id int, d int")
    out = {r["id"]: (r["q"], r["error_message"]) for r in isolated(df, ["id"], "q double", lambda r: {"q": 6 / r["d"]}).collect()}
    assert out[1] == (3.0, None) and out[2][1].startswith("ZeroDivisionError") and set(out) == {1, 2, 3}
    ok, log = Stage("filter", lambda x: x.withColumn("error_message", F.when(F.col("d") == 0, "zero"))).run(df, "id", "id")
    assert ok.count() == 2 and {r["article_id"]: r["status"] for r in log.collect()}[2] == "FAILED"
    with pytest.raises(ValueError):
        Stage("nothing", lambda x: x)
    assert guard(df, ["id", "d", "e"]) is df
    with pytest.raises(ValueError):
        guard(df, ["id"])


def test_crawl_stops_and_reset(spark):
    rows = [("s", b, u) for b, us in enumerate((["a", "b"], ["a"], [None, ""], ["c"], ["d"], ["e"], ["f"])) for u in us] + [(None, 1, "x")]
    got = {r["batch"]: (r["page"], r["n_visited"], r["n_failed"], r["stop"]) for r in D.crawl_stops(spark.createDataFrame(rows, "q string, b int, u string"), "q", "b", "u", 5).collect()}
    assert got[0] == (1, 0, 0, None) and got[1] == (2, 1, 0, "visited") and got[2] == (3, 0, 2, "no address") and got[5][3] == got[6][3] == "max pages" and got[4][3] is None
    d = dt.date(2024, 5, 10)
    rows = [(1, "a", d, False), (2, "a", d, False), (3, "a", d, True), (4, "a", d, False)]
    out = D.batch_progress(spark.createDataFrame(rows, "b int, u string, d date, f boolean"), "b", "u", F.col("d"), "2024-05-10", F.col("f")).orderBy("batch").collect()
    assert [r["barren_run"] for r in out] == [0, 1, 0, 1]


def test_blocks_left_out_and_embedding(spark):
    page = "<HEAD><title>t</title></HEAD><body><nav class='x'>m</nav>text<header>kept</header><script>1</script>\n<footer>f</footer ></body>"
    assert one(spark, [(page,)], "t string", T.without_blocks("t"))[0][0] == "<body>text<header>kept</header>\n</body>"
    a, b, c = (r[0] for r in one(spark, [("A b",), ("b a",), (None,)], "t string", T.embedding(F.col("t"))))
    assert a == b and abs(sum(x * x for x in a) - 1) < 1e-9 and not any(c)


def test_summary_keeps_order(spark):
    from commgraph.operators.summarize import summaries

    text = "One two three. Four five six! Seven eight nine? Ten."
    df = spark.createDataFrame([("a", text), ("a", text), ("b", "Short one. Two."), ("c", None), ("d", "")], "id string, t string")
    got = {r["doc"]: r["summary"] for r in summaries(df, "id", "t", 6).collect()}
    assert set(got) == {"a", "b"} and got["b"] == "Short one. Two."
    kept = got["a"].split(". ")
    assert sorted(kept, key=text.index) == kept and len(got["a"].split()) <= 7


def test_default_annotators(spark):
    from commgraph import annotate as A

    reg = spark.createDataFrame([("Ana Berg",), ("Carl Dunmore",), (None,)], "display_name string")
    items = spark.createDataFrame([("i", "Debate: Ana Berg", "carl dunmore spoke"), ("j", "", None), (None, "x", "y")], "id string, title string, content string")
    got = {r["id"]: (r["content_type"], r["active_speakers"]) for r in A.active_speakers(items, "id", "title", "content", reg).collect()}
    assert got == {"i": ("debate", ["Ana Berg", "Carl Dunmore"]), "j": ("unknown", [])}
    pages = spark.createDataFrame([(1, "[A b](/x) and ![img](/y) [C](z)"), (2, None)], "p int, md string")
    assert sorted(tuple(r) for r in A.page_articles(pages, "p", "md").collect()) == [(1, "A b", "/x"), (1, "C", "z")]
    p = spark.createDataFrame([("i", "Ana Berg", "We like Acme."), ("i", None, "Acme")], "id string, speaker string, t string")
    e = spark.createDataFrame([("i", "Acme"), ("i", "Zed")], "id string, entity string")
    assert [tuple(r)[:3] for r in A.attributed(p, "id", "speaker", "t", e, "entity").collect()] == [("i", "Ana Berg", "Acme")]
    answers = iter(["bad", "good"])
    call = A.structured(lambda prompt: (next(answers), {"input_tokens": 2}), lambda a: a if a == "good" else 1 / 0, A.RetryPolicy(1, 0.0))
    assert call("q") == ("good", {"input_tokens": 4})
