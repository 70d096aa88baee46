"""Reading and writing stage artifacts and tables."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENVELOPE = "id string, success boolean, data map<string,string>, error_message string"


def read_artifacts(spark: SparkSession, path: str, schema: str = ENVELOPE, form: str = "document") -> DataFrame:
    """JSON artifacts under a declared schema; a broken one fails the read. ``form``
    is "document" for one object, or a list of them, a file, "lines" for one a line."""
    if form not in ("document", "lines"):
        raise ValueError(f"form {form}")
    return spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", form == "document").option("recursiveFileLookup", True).json(path)


def stage_output(artifacts: DataFrame, stage: str) -> DataFrame:
    """(id, <stage>): the text a stage left, '' where it left none."""
    return artifacts.select("id", F.coalesce(F.col("data")[stage], F.lit("")).alias(stage))


def write_artifacts(rows: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write by publication date and source, replacing only the partitions that come; rows without a date are refused."""
    checked = rows.withColumn("publication_date", F.coalesce("publication_date", F.raise_error(F.lit("publication_date is null"))))
    checked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("publication_date", "source_slug").format(fmt).save(path)


#: The tables of a graph in the order they are loaded, with their keys (fixed values).
LOAD_ORDER = {"speaker": ["speaker_id"], "communication": ["id"], "topic": ["topic_id"], "entity": ["entity_name"], "claim": ["claim_key"], "edge": ["src", "rel", "dst"]}


def write_graph(tables: dict[str, DataFrame], path: str) -> list[str]:
    """Merge nodes and edges into the tables below ``path`` by their keys, in
    LOAD_ORDER; a row that comes again replaces the one that is there, so that
    loading twice changes nothing. Returns the versions written. A table is
    written whole beside the old one and then takes its place."""
    done = []
    for name, keys in LOAD_ORDER.items():
        if name not in tables:
            continue
        new = tables[name]
        spark = new.sparkSession
        fs, at, part = _place(spark, f"{path}/{name}")
        if fs.exists(at):
            old = spark.read.schema(new.schema).parquet(f"{path}/{name}")
            new = new.unionByName(old.join(new.select(*keys), keys, "left_anti"))
        new.write.mode("overwrite").parquet(f"{path}/_{name}")
        fs.delete(at, True)
        fs.rename(part, at)
        done.append(name)
    return done


def _place(spark: SparkSession, path: str):
    folder, _, name = path.rpartition("/")
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at, spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_{name}")


def artifact_path(date: str | None, slug: str, item: str, stage: str) -> str:
    """Where a stage's artifact of one item lies; an item without a date is refused."""
    if date is None:
        raise TypeError("publication_date is None")
    return f"{date}/{slug}/{item}/{stage}.json"


#: Blocks that never hold a page's text (fixed values).
DROPPED_TAGS = "aside script style head nav footer".split()
DROPPED_CLASSES = re.compile(r"(?:^|\s)(?:sidebar|advertisement|ads|ad-container|social-share|menu|breadcrumb)(?:\s|$)|banner")


def strip_html(source: str) -> str:
    """Text of a page without the blocks above; entities resolved, a line a block."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        VOID = frozenset("br img hr input meta link area base col embed source track wbr".split())

        def __init__(self) -> None:
            super().__init__(convert_charrefs=True)
            self.out: list[str] = []
            self.open: list[tuple[str, bool]] = []

        def handle_starttag(self, tag: str, attrs: list) -> None:
            if tag in ("br", "p", "div", "li", "h1", "h2", "h3", "tr"):
                self.out.append("\n")
            if tag not in self.VOID:
                a = dict(attrs)
                self.open.append((tag, tag in DROPPED_TAGS or bool(DROPPED_CLASSES.search(a.get("class") or "")) or "ad-" in (a.get("id") or "")))

        def handle_endtag(self, tag: str) -> None:
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] == tag:
                    del self.open[k:]
                    break

        def handle_data(self, data: str) -> None:
            if not any(d for _, d in self.open):
                self.out.append(data)

    r = Reader()
    r.feed(source)
    r.close()
    return "\n".join(line for line in (" ".join(x.split()) for x in "".join(r.out).split("\n")) if line)


def transcript_entries(source: str, entry: str, speaker: str, stamp: str, said: str) -> str:
    """Speaker blocks of a page, by exact class attributes; what is nested in them
    belongs to them. Entries without a speaker or words are skipped."""
    from html.parser import HTMLParser

    wanted = {("h2", speaker): 0, ("span", stamp): 1, ("div", said): 2}

    class Reader(HTMLParser):
        def __init__(self) -> None:
            super().__init__(convert_charrefs=True)
            self.entries: list[list[str | None]] = []
            self.depth = 0  # open divs of an entry
            self.field: int | None = None
            self.tag, self.level = "", 0

        def handle_starttag(self, tag: str, attrs: list) -> None:
            css = dict(attrs).get("class") or ""
            if tag == "div" and css == entry and self.field is None:
                self.entries.append([None, None, None])
                self.depth = 1
                return
            if self.depth and self.field is None and (k := wanted.get((tag, css))) is not None and self.entries[-1][k] is None:
                self.field, self.tag, self.level = k, tag, 1
                self.entries[-1][k] = ""
            elif self.field is not None and tag == self.tag:
                self.level += 1
            elif self.field is not None and tag in ("br", "p"):
                self.handle_data(" ")
            if self.depth and tag == "div":
                self.depth += 1

        def handle_endtag(self, tag: str) -> None:
            if self.field is not None and tag == self.tag:
                self.level -= 1
                if not self.level:
                    self.field = None
            if self.depth and tag == "div":
                self.depth -= 1

        def handle_data(self, data: str) -> None:
            if self.field is not None:
                self.entries[-1][self.field] += data

    r = Reader()
    r.feed(source)
    r.close()
    out = []
    for who, when, what in r.entries:
        who, when, what = (" ".join((x or "").split()) for x in (who, when, what))
        if who and what:
            out += [f"{who} [{when}]:" if when else f"{who}:", f"  {what}", ""]
    return "\n".join(out)


def scrape(pages: DataFrame, url: str, source: str) -> DataFrame:
    """(url, scrape, word_count) of fetched pages; Arrow batches, one page at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [strip_html(s) if isinstance(s, str) else "" for s in b["source"]]
            yield pd.DataFrame({"url": b["url"], "scrape": pd.Series(texts, dtype=object, index=b.index), "word_count": pd.Series([len(t.split()) for t in texts], dtype="int64", index=b.index)})

    return pages.select(F.col(url).alias("url"), F.col(source).alias("source")).mapInPandas(run, "url string, scrape string, word_count long")
