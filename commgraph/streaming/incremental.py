"""Streaming twins of the incremental operators.

The batch operators define the results; a stream that has read all its input
gives the same rows. State is bounded by a watermark wherever one can be given.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from commgraph.operators.similarity import added_lines
from commgraph.runtime import scratch


def stream_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table, file or folder, as a stream of its files."""
    schema = spark.read.parquet(path).schema
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory():
        return spark.readStream.schema(schema).parquet(path)
    folder, _, name = path.rpartition("/")
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)


def drain(stream: DataFrame, mode: str = "append", keys: list[str] | None = None) -> DataFrame:
    """Run a stream over all input there is and return what it wrote.

    Complete results are those of the last micro-batch. In update mode each
    micro-batch writes what changed into a folder of its own, which a repeated
    one replaces, and of each of ``keys`` the last emission stands.
    """
    spark = stream.sparkSession
    out, state = scratch(spark, "stream"), scratch(spark, "stream-state")
    w = stream.writeStream.option("checkpointLocation", state).outputMode(mode).trigger(availableNow=True)
    if mode == "append":
        q = w.format("parquet").option("path", out).start()
    elif mode == "complete":
        q = w.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out)).start()
    else:
        if not keys:
            raise ValueError("update mode needs keys")
        q = w.foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{out}/nth={n}")).start()
    q.awaitTermination()
    if mode != "update":
        return spark.read.schema(stream.schema).parquet(out)
    spark.createDataFrame([], stream.schema).write.mode("overwrite").parquet(f"{out}/nth=-1")
    rows = spark.read.option("basePath", out).parquet(out)
    own = [c for c in stream.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*own), "nth").alias("_l")).select(*keys, *[F.col(f"_l.{c}").alias(c) for c in own]).select(*stream.columns)


def new_articles(discovered: DataFrame, url: str = "url", ts: str | None = None, late: str = "30 days") -> DataFrame:
    """The first row of each address, across batches. With ``ts`` addresses are
    remembered for ``late`` after they were last due, which bounds the state."""
    if ts is None:
        return discovered.dropDuplicates([url])
    return discovered.withWatermark(ts, late).dropDuplicatesWithinWatermark([url])


def activity(events: DataFrame, ts: str, key: str, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """Events per window and key; windows close once the watermark passes."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).groupBy(F.window(ts, window).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), key, "n")


def counts(events: DataFrame, *keys: str) -> DataFrame:
    return events.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


FOLDED = "status string, error_message string, retry_count long, completed_at string, processing_time double, file_path string, metadata string"


def fold_stream(log: DataFrame, article: str = "article_id", stage: str = "stage", expire: int | None = None) -> DataFrame:
    """The twin of :func:`commgraph.operators.state.fold_log`: keyed state of
    (article, stage), emitted whenever it changes, ``metadata`` as JSON text.

    ``seq`` orders rows, also across batches; a row replayed under a known
    ``seq`` changes nothing. State holds the numbers seen of its key, which are
    the attempts at one stage of one article. With ``expire`` milliseconds
    without a new row a key's state is let go; its last emission stands. That is for
    streams that go on: a drained one would wait for its timeouts for ever.
    """
    given = {"error_message": "string", "completed_at": "string", "processing_time": "double", "file_path": "string", "metadata": "string"}
    kind = log.schema[article].dataType.simpleString()
    later = ("completed_at", "processing_time", "file_path")

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        now = json.loads(state.get[0]) if state.exists else {"seen": [], "at": None, "last": [None, None], "failed": 0, "kept": {}, "meta": {}}
        seen, changed = set(now["seen"]), False
        for p in parts:
            for r in p.astype(object).where(p.notna(), None).to_dict("records"):
                n = int(r["seq"])
                if n in seen:
                    continue
                seen.add(n)
                changed = True
                now["failed"] += r["status"] == "FAILED"
                if now["at"] is None or n > now["at"]:
                    now["at"], now["last"] = n, [r["status"], r["error_message"]]
                for c in later:
                    if r[c] is not None and n > now["kept"].get(c, [-1 << 63])[0]:
                        now["kept"][c] = [n, r[c]]
                for k, v in (json.loads(r["metadata"]) if r["metadata"] else {}).items():
                    if n > now["meta"].get(k, [-1 << 63])[0]:
                        now["meta"][k] = [n, v]
        now["seen"] = sorted(seen)
        state.update((json.dumps(now),))
        if expire:
            state.setTimeoutDuration(expire)
        if changed:
            kept = [now["kept"].get(c, [0, None])[1] for c in later]
            meta = json.dumps({k: v for k, (_, v) in sorted(now["meta"].items())}) if now["meta"] else None
            yield pd.DataFrame([[*key, *now["last"], now["failed"], *kept, meta]], columns=[article, stage, "status", "error_message", "retry_count", *later, "metadata"])

    own = log.select(article, stage, "seq", "status", *[(F.col(c) if c in log.columns else F.lit(None)).cast(t).alias(c) for c, t in given.items()])
    timeout = GroupStateTimeout.ProcessingTimeTimeout if expire else GroupStateTimeout.NoTimeout
    return own.groupBy(article, stage).applyInPandasWithState(step, f"{article} {kind}, {stage} string, {FOLDED}", "state string", "update", timeout)


def process_ready(source: DataFrame, done: Callable[[], DataFrame], key: str, work: Callable[[DataFrame], DataFrame], sink: Callable[[DataFrame], None], state: str):
    """Work on rows of each micro-batch whose key isn't done; a failed batch is
    tried again whole, and keys done meanwhile are passed over."""

    def one(df: DataFrame, _: int) -> None:
        sink(work(df.dropDuplicates([key]).join(done(), key, "left_anti")))

    return source.writeStream.foreachBatch(one).option("checkpointLocation", state).trigger(availableNow=True).start()


def split_outcomes(rows: DataFrame, error: str = "error_message") -> tuple[DataFrame, DataFrame]:
    """(ok, failed): the dead letters keep their rows and what went wrong."""
    return rows.where(F.col(error).isNull()), rows.where(F.col(error).isNotNull())


def scroll_delta(pages: DataFrame, session: str, seq: str, text: str) -> DataFrame:
    """(session, seq, added): the lines that each page of a session adds to the one
    before it, kept as keyed state; the first page adds all its lines."""
    kind, order = (pages.schema[c].dataType.simpleString() for c in (session, seq))

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        old = state.get[0] if state.exists else ""
        rows = pd.concat(list(parts)).sort_values("q")
        out = []
        for q, t in zip(rows["q"], rows["t"]):
            out.append((key[0], q, added_lines(old, t or "")))
            old = t or ""
        state.update((old,))
        yield pd.DataFrame(out, columns=["s", "q", "added"])

    own = pages.select(F.col(session).alias("s"), F.col(seq).alias("q"), F.col(text).alias("t")).where("s IS NOT NULL")
    made = own.groupBy("s").applyInPandasWithState(step, f"s {kind}, q {order}, added array<string>", "old string", "append", GroupStateTimeout.NoTimeout)
    return made.withColumnsRenamed({"s": session, "q": seq})
