"""The five places where a language model may sit, and a rule-based default.

An annotator maps batches of rows to rows; the default decides from word lists,
so that a whole run is deterministic and needs no network. A live one is given
to the same stages in its place.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commgraph.config import RetryPolicy
from commgraph.functions import text as T
from commgraph.operators.faults import retry
from commgraph.vocab import TOPICS

#: Words that speak for a sentiment or a topic (fixed values).
POSITIVE = ["praise", "support", "protect", "expand", "improve", "welcome", "succeed", "renew", "fund"]
NEGATIVE = ["attack", "reject", "cancel", "oppose", "leak", "cut", "deny", "punish", "ban", "sue"]
TOPIC_WORDS = {
    "economics": ["tariff", "budget", "tax", "market", "bond", "wage", "currency"],
    "healthcare": ["hospital", "clinic", "vaccine", "hospice", "nurse"],
    "legal": ["court", "lawsuit", "verdict", "judge", "statute"],
    "elections": ["ballot", "election", "voter", "campaign"],
    "energy_climate": ["pipeline", "reactor", "grid", "turbine", "drought"],
    "defense": ["military", "frigate", "missile", "soldier"],
    "technology": ["algorithm", "server", "browser", "chip", "sensor"],
}


class Annotator(Protocol):
    """``output`` is the schema of what is added to a row, one or many rows each."""

    output: str

    def __call__(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]: ...


def annotate(rows: DataFrame, annotator: Annotator, keep: list[str]) -> DataFrame:
    """Run an annotator over ``rows``; what it emits carries the columns ``keep``."""
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keep).schema)
    return rows.mapInPandas(annotator, f"{kept}, {annotator.output}")


def _hits(text: Column, words: list[str]) -> Column:
    return F.size(F.regexp_extract_all(F.lower(text), F.lit(r"\b(?:" + "|".join(words) + r")[a-z]*\b"), F.lit(0)))


def sentiment(text: Column) -> Column:
    """Rule-based sentiment, in the JVM: the side with more words; unclear for none."""
    p, n = _hits(text, POSITIVE), _hits(text, NEGATIVE)
    return F.when((p == 0) & (n == 0), "unclear").when(p > n, "positive").when(n > p, "negative").otherwise("neutral")


def topic(text: Column) -> Column:
    """Rule-based topic: the one with most words, the first in order on a tie, else 'other'."""
    scores = [F.struct(_hits(text, TOPIC_WORDS[t]).alias("n"), F.lit(-k).alias("k"), F.lit(t).alias("t")) for k, t in enumerate(TOPICS) if t in TOPIC_WORDS]
    best = F.array_max(F.array(*scores))
    return F.when(best["n"] > 0, best["t"]).otherwise("other")


#: Words of a title that tell the type of its content, in order (fixed values).
TYPE_WORDS = {"debate": ["debate"], "interview": ["interview"], "presentation": ["presentation"], "speech": ["speech", "remarks", "address"]}


def content_type(title: Column) -> Column:
    """Rule-based type of a communication by its title; unknown without one."""
    t = F.lower(F.coalesce(title, F.lit("")))
    out = F.when(t == "", "unknown")
    for kind, words in TYPE_WORDS.items():
        hit = F.lit(False)
        for w in words:
            hit = hit | t.contains(w)
        out = out.when(hit, kind)
    return out.otherwise("other")


#: What each annotator adds to a row.
OUTPUTS = {
    "articles": "title string, url string",
    "speakers": "content_type string, active_speakers array<string>, reason string",
    "entities": "speaker string, entity string, reason string",
    "passages": "entity string, verbatim string",
    "claims": "topic string, sentiment string",
}


def page_articles(pages: DataFrame, page: str, markdown: str) -> DataFrame:
    """(page, title, url): the links of a page's markdown, the default of article extraction."""
    link = r"(?<!!)\[([^\[\]]+)\]\(([^()\s]+)\)"
    found = F.arrays_zip(F.regexp_extract_all(markdown, F.lit(link), F.lit(1)).alias("title"), F.regexp_extract_all(markdown, F.lit(link), F.lit(2)).alias("url"))
    return pages.select(page, F.explode(found).alias("x")).select(page, F.col("x.title").alias("title"), F.col("x.url").alias("url"))


def active_speakers(items: DataFrame, key: str, title: str, text: str, registry: DataFrame, name: str = "display_name") -> DataFrame:
    """(key, content_type, active_speakers, reason): the people of the registry whose
    whole name stands in title or text, the default of speaker classification.
    Names are met by their words: an item's word pairs are joined with the
    first two words of each name, and the whole name is looked for then."""
    body = F.concat_ws(" ", title, text)
    words = F.split(F.regexp_replace(F.lower(body), r"[^\p{L}\p{N}']+", " "), " ")
    pair = F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - 1, F.lit(1))), lambda k: F.concat_ws(" ", F.element_at("w", k), F.try_element_at("w", k + 1)))
    own = items.select(F.col(key).alias("k"), F.col(title).alias("t"), F.lower(body).alias("b"), words.alias("w")).where("k IS NOT NULL").distinct()
    asked = own.select("k", "b", F.explode(F.array_distinct(pair)).alias("p"))
    named = registry.select(F.col(name).alias("n")).where("n IS NOT NULL").distinct().withColumn("w", F.split(F.regexp_replace(F.lower("n"), r"[^\p{L}\p{N}']+", " "), " "))
    named = named.select("n", F.concat_ws(" ", F.element_at("w", 1), F.try_element_at("w", F.lit(2))).alias("p"))
    met = asked.join(named, "p").where(F.contains("b", F.lower("n"))).groupBy("k").agg(F.array_sort(F.collect_set("n")).alias("active_speakers"))
    out = own.select("k", "t").distinct().join(met, "k", "left")
    found = F.coalesce("active_speakers", F.array().cast("array<string>"))
    return out.select(F.col("k").alias(key), content_type(F.col("t")).alias("content_type"), found.alias("active_speakers"), F.when(F.size(found) > 0, "named in the text").otherwise("nobody named").alias("reason"))


def attributed(passages: DataFrame, key: str, speaker: str, text: str, entities: DataFrame, entity: str) -> DataFrame:
    """(key, speaker, entity, reason): entities of the same communication, by
    ``key``, that a speaker's passage names, the default of attribution."""
    p = passages.select(F.col(key).alias("k"), F.col(speaker).alias("speaker"), F.lower(text).alias("b")).where("k IS NOT NULL AND speaker IS NOT NULL")
    e = entities.select(F.col(key).alias("k"), F.col(entity).alias("entity")).where("entity IS NOT NULL AND entity != ''").distinct()
    return p.join(e, "k").where(F.contains("b", F.lower("entity"))).select(F.col("k").alias(key), "speaker", "entity", F.lit("named in a passage").alias("reason")).distinct()


def mentions(rows: DataFrame, key: str, text: str, entity: str) -> DataFrame:
    """(key, entity, verbatim): the sentences of a text that name its entity, the
    default of passage extraction."""
    s = rows.select(F.col(key), F.col(entity).alias("entity"), F.explode(T.sentences(text)).alias("verbatim"))
    return s.where(F.contains(F.lower("verbatim"), F.lower("entity")))


def structured(ask, check, policy: RetryPolicy = RetryPolicy()):
    """A call to a model whose answer must pass ``check``: an answer that raises
    there is asked for again, as the policy says. ``ask`` gives (answer, usage);
    the usage of all attempts is summed."""

    def call(prompt: str) -> tuple[object, dict[str, int]]:
        used: dict[str, int] = {}

        def once() -> object:
            answer, usage = ask(prompt)
            for k, v in usage.items():
                used[k] = used.get(k, 0) + (v or 0)
            return check(answer)

        return retry(once, policy), used

    return call
