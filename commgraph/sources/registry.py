"""Vetted extractors by domain, and stage tables made where they don't exist."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commgraph.functions.urls import domain_key

Extractor = Callable[[str], str]


class Registry:
    """Extractors ``html -> text`` by domain. Only functions registered in code
    are ever run; text from outside never becomes one."""

    def __init__(self) -> None:
        self.known: dict[str, Extractor] = {}

    def register(self, domain: str, extractor: Extractor) -> None:
        self.known[domain.lower().removeprefix("www.")] = extractor

    def extract(self, pages: DataFrame, url: str, source: str) -> DataFrame:
        """(url, scrape, error_message): each page through its domain's extractor;
        a domain nobody registered, a page that isn't there and an extractor that
        fails are errors of that row."""
        known = dict(self.known)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                out = []
                for d, s in zip(b["domain"], b["source"]):
                    if d not in known:
                        out.append((None, f"unsupported domain: {d or ''}"))
                    elif not isinstance(s, str):
                        out.append((None, "page could not be fetched"))
                    else:
                        try:
                            out.append((known[d](s), None))
                        except Exception as e:
                            out.append((None, f"{type(e).__name__}: {e}"))
                yield pd.DataFrame({"url": b["url"], "scrape": pd.Series([o[0] for o in out], index=b.index, dtype=object), "error_message": pd.Series([o[1] for o in out], index=b.index, dtype=object)})

        own = pages.select(F.col(url).alias("url"), F.lower(domain_key(F.col(url))).alias("domain"), F.col(source).alias("source"))
        return own.mapInPandas(run, "url string, scrape string, error_message string")


def supported(rows: DataFrame, url: str, domains: DataFrame, domain: str) -> DataFrame:
    """``rows`` with ``domain`` and ``error_message``, null where the registry has the domain."""
    known = domains.select(F.col(domain).alias("_d")).where("_d IS NOT NULL").distinct()
    own = rows.withColumn("domain", domain_key(F.col(url)))
    return own.join(known, F.col("domain") == F.col("_d"), "left").withColumn("error_message", F.when(F.col("_d").isNull(), F.concat(F.lit("unsupported domain: "), F.coalesce("domain", F.lit(""))))).drop("_d")


def ensure_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, made empty where there is none; one that is there stays as it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        spark.createDataFrame([], schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def lookup(rows: DataFrame, requests: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of the keys asked for; keys that aren't there give none, repeated requests one."""
    return rows.join(requests.select(*keys).distinct(), keys, "left_semi")
