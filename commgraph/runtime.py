"""Session settings, table access and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(master: str = "local[8]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    b = SparkSession.builder.master(master).config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**SESSION_CONF, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_root(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only where that is unset and the session is local, as in tests, a temporary
    folder takes its place; on a cluster its absence is an error.
    """
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if known:
        return known
    had = spark.sparkContext.getCheckpointDir()
    if had:
        return had.rsplit("/", 1)[0]
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    own = "file://" + tempfile.mkdtemp(prefix="commgraph-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def scratch(spark: SparkSession, what: str) -> str:
    """A fresh path for a written table below the shared folder; it goes when the driver ends."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_sweep)
    _written.append(path)
    return path


_written: list[str] = []


def _sweep() -> None:
    """Delete the written tables of this driver while its session still lives."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        return
    with contextlib.suppress(Exception):
        for path in _written:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def cut(df: DataFrame, what: str, **write_options: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it back.

    A written table survives the loss of executors and is the point where a
    recomputation starts again.
    """
    spark = df.sparkSession
    path = scratch(spark, what)
    df.write.options(**{"compression": "zstd", **write_options}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
