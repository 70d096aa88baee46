import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from commgraph import annotate
from commgraph.runtime import checkpoint_root
from commgraph.sources import artifacts as A
from commgraph.streaming import incremental as I


def test_artifacts_round_trip(spark, tmp_path):
    for k, d in (("a", {"scrape": "text"}), ("b", {"filter": "x"})):
        p = tmp_path / "2024-01-02" / "src" / k
        p.mkdir(parents=True)
        (p / "scrape.json").write_text(json.dumps({"id": k, "success": True, "data": d, "error_message": None}))
    df = A.read_artifacts(spark, str(tmp_path))
    assert {r["id"]: r["scrape"] for r in A.stage_output(df, "scrape").collect()} == {"a": "text", "b": ""}
    rows = spark.createDataFrame([("a", "2024-01-02", "s"), ("b", "2024-01-03", "s")], "id string, publication_date string, source_slug string")
    out = str(tmp_path / "out")
    A.write_artifacts(rows, out)
    A.write_artifacts(rows.where("id = 'b'").withColumn("id", F.lit("c")), out)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == ["a", "c"]
    nodes = spark.createDataFrame([("a", 1), ("b", 1)], "entity_name string, n int")
    edge = spark.createDataFrame([("a", "R", "b")], "src string, rel string, dst string")
    g = f"file://{tmp_path}/g"
    assert A.write_graph({"edge": edge, "entity": nodes}, g) == ["entity", "edge"]
    A.write_graph({"entity": spark.createDataFrame([("b", 2), ("c", 2)], "entity_name string, n int"), "edge": edge}, g)
    assert {r[0]: r[1] for r in spark.read.parquet(g + "/entity").collect()} == {"a": 1, "b": 2, "c": 2} and spark.read.parquet(g + "/edge").count() == 1
    assert A.artifact_path("2024-01-02", "s", "i", "scrape") == "2024-01-02/s/i/scrape.json"
    with pytest.raises(TypeError):
        A.artifact_path(None, "s", "i", "scrape")


def test_one_object_a_line(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"id": "a"}\n{"id": "b"}\n')
    assert A.read_artifacts(spark, str(tmp_path), form="lines").count() == 2


def test_registry_and_tables(spark, tmp_path):
    from commgraph.sources.registry import Registry, ensure_table

    r = Registry()
    r.register("www.a.example", str.upper)
    r.register("b.example", lambda s: 1 / 0)
    pages = spark.createDataFrame([("https://www.a.example/x", "hi"), ("https://b.example/", "hi"), ("https://c.example/", "hi"), ("https://a.example/y", None), (None, "hi")], "url string, html string")
    got = {x["url"]: (x["scrape"], x["error_message"]) for x in r.extract(pages, "url", "html").collect()}
    assert got["https://www.a.example/x"] == ("HI", None) and got["https://b.example/"][1].startswith("ZeroDivisionError")
    assert got["https://c.example/"] == (None, "unsupported domain: c.example") and got["https://a.example/y"][1] == "page could not be fetched" and got[None][0] is None
    path = f"file://{tmp_path}/t"
    assert ensure_table(spark, path, "a int").count() == 0
    spark.createDataFrame([(1,)], "a int").write.mode("append").parquet(path)
    assert ensure_table(spark, path, "a int").count() == 1


PAGE = """<html><head><title>t</title><style>x</style></head><body><nav>menu</nav><div class="sidebar">side</div><p>First &amp; last.</p>
<div id="ad-1">buy</div><div class="top-banner">b</div><script>1</script><p>Second<br>line</p><aside>no</aside></body></html>"""
ROLL = """<div class="e"><h2 class="s">Ann</h2><span class="t">00:01</span><div class="d">Hi <b>all</b> &amp; you</div></div>
<div class="e"><h2 class="s">Bob</h2><div class="d">Yes</div></div><div class="e"><h2 class="s">Cat</h2></div>"""


def test_pages(spark):
    assert A.strip_html(PAGE) == "First & last.\nSecond\nline"
    assert A.transcript_entries(ROLL, "e", "s", "t", "d") == "Ann [00:01]:\n  Hi all & you\n\nBob:\n  Yes\n"
    nested = '<div class="e"><h2 class="s">Ann</h2><div class="d">one <div>two</div> three</div></div><div class="e x"><h2 class="s">No</h2><div class="d">no</div></div>'
    assert A.transcript_entries(nested, "e", "s", "t", "d") == "Ann:\n  one two three\n"
    df = spark.createDataFrame([("u", PAGE), ("v", None)], "url string, html string")
    assert {r["url"]: r["word_count"] for r in A.scrape(df, "url", "html").collect()} == {"u": 5, "v": 0}


class Shout:
    output = "loud string"

    def __call__(self, batches):
        for b in batches:
            yield b.assign(loud=b["t"].str.upper())[["id", "loud"]]


def test_annotators(spark):
    df = spark.createDataFrame([(1, "they praise the tariff and the tariffs"), (2, "we reject the court"), (3, "nothing")], "id int, t string")
    got = df.select(annotate.topic(F.col("t")), annotate.sentiment(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [("economics", "positive"), ("legal", "negative"), ("other", "unclear")]
    assert [r["loud"] for r in annotate.annotate(df, Shout(), ["id"]).collect()][2] == "NOTHING"


def test_streams(spark, tmp_path):
    src = str(tmp_path / "src.parquet")
    rows = [(k, f"u{k % 7}", k % 3, "FAILED" if k % 5 == 0 else "COMPLETED", f"2024-01-0{1 + k % 4} 10:00:00") for k in range(40)]
    df = spark.createDataFrame(rows, "seq long, url string, article_id long, status string, t string").withColumn("ts", F.col("t").cast("timestamp")).withColumn("stage", F.lit("scrape"))
    df.repartition(4).write.parquet(src)
    assert I.drain(I.new_articles(I.stream_table(spark, src))).count() == 7
    closed = I.drain(I.activity(I.stream_table(spark, src), "ts", "status", late="1 day"))
    assert closed.agg(F.sum("n")).first()[0] in (None, *range(41))
    done = []

    def sink(x):
        done.extend(r["url"] for r in x.collect())

    q = I.process_ready(I.stream_table(spark, src), lambda: spark.createDataFrame([("u0",)], "url string"), "url", lambda x: x, sink, str(tmp_path / "state"))
    q.awaitTermination()
    assert sorted(done) == [f"u{k}" for k in range(1, 7)]
    ok, failed = I.split_outcomes(spark.createDataFrame([(1, None), (2, "x")], "id int, error_message string"))
    assert ok.count() == failed.count() == 1


def test_stream_fold_is_the_twin_of_the_batch_fold(spark, tmp_path):
    """Three keys in several files, one file a trigger, a replayed row, rows out of order."""
    from commgraph.operators.state import fold_log

    schema = "article_id long, stage string, seq long, status string, error_message string, completed_at string, processing_time double, file_path string, metadata string"
    rows = [(a, "scrape", n, "FAILED" if n % 3 == 0 else "COMPLETED", f"e{n}" if n % 3 == 0 else None, None if n % 3 == 0 else f"t{n}", None if n % 3 == 0 else float(n), None, json.dumps({f"k{n % 2}": str(n)}) if n % 2 or a else None) for a in range(3) for n in range(7)]
    order = [rows[k] for k in (6, 0, 13, 3, 20, 1, 2, 4, 5, *range(7, 13), *range(14, 20), 3, 6)]
    src = tmp_path / "in"
    for k in range(0, len(order), 5):
        spark.createDataFrame(order[k : k + 5], schema).coalesce(1).write.mode("append").parquet(str(src))
    log = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    got = I.drain(I.fold_stream(log), "update", ["article_id", "stage"]).collect()
    want = fold_log(spark.read.schema(schema).parquet(str(src))).collect()
    assert len(got) == 3
    for w in want:
        g = next(r for r in got if r["article_id"] == w["article_id"])
        assert all(g[c] == w[c] for c in ("status", "error_message", "retry_count", "completed_at", "processing_time", "file_path")), (g, w)
        assert json.loads(g["metadata"]) == w["metadata"]


def test_scroll_delta(spark, tmp_path):
    rows = [("s", 1, "a\nb"), ("s", 2, "a\nc\nb"), ("t", 1, "x")]
    src = str(tmp_path / "in")
    spark.createDataFrame(rows, "s string, q int, t string").coalesce(1).write.parquet(src)
    out = I.drain(I.scroll_delta(I.stream_table(spark, src), "s", "q", "t")).collect()
    assert {(r["s"], r["q"]): r["added"] for r in out} == {("s", 1): ["a", "b"], ("s", 2): ["c"], ("t", 1): ["x"]}


def test_checkpoint_root_is_read_from_the_session(spark):
    class Conf:
        def get(self, key, default=None):
            return {"spark.checkpoint.dir": "file:///shared"}.get(key, default)

    class Session:
        conf = Conf()

    assert checkpoint_root(Session()) == "file:///shared"
    assert checkpoint_root(spark)


def test_llm_package_is_not_needed():
    import ast
    from pathlib import Path

    root = Path(__file__).resolve().parents[1] / "commgraph"
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            names = [n for x in ast.walk(ast.parse(p.read_text())) if isinstance(x, ast.ImportFrom | ast.Import) for n in ([x.module or ""] if isinstance(x, ast.ImportFrom) else [a.name for a in x.names])]
            assert not any("llm" in n for n in names), p
    assert isinstance(pd.DataFrame(), pd.DataFrame)
