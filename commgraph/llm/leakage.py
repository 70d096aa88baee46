"""Held-out passages inside a training corpus, by a positional inverted index.

The corpus is tokenized once into an index of segments, a written table with
one row per (segment, term): a segment holds the postings of a bounded number
of tokens, each posting the position of the term in the segment's running count
of tokens. Documents are one unused position apart, so positions that follow
one another never cross a document.

A search reads the rows of the terms it needs only. Each item of the held-out
set is covered with anchors: of every ``n`` consecutive words at least the one
with the fewest postings in the whole corpus, so that every passage of ``n``
words holds an anchor. A segment is entered from its own terms: only items with
an anchor among them are looked at. The postings of anchors, moved back by the
place of the anchor in the item, are the candidate alignments; they are
intersected with the moved lists of the other words, rarest first, and runs of
``n`` hits are exact phrase matches.

Matches by proximity are chains: words of the item in order, each at most
``slack`` words of the item and at most ``slack`` words of the document after
the one before, all in one document. A chain can step over the rarest word, but
not over ``slack`` + 1 words in a row, so the anchors of each ``n`` consecutive
words are then the ``slack`` + 1 neighbours with the fewest postings together.
Where an anchor's posting stands among enough of the item's words, the longest
chains are found from the postings nearby.

Segments are bounded by tokens, so hot terms, hot sources and very long texts
need no care: a text longer than a segment is laid over several that overlap by
more than the longest item. Items are searched in blocks of bounded size, which
is what bounds what each task is sent.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commgraph.llm.frames import frame
from commgraph.runtime import scratch

#: Words in a row that make a passage.
PASSAGE = 13
#: Tokens of a segment, and by how many the parts of a longer text overlap.
SEGMENT, LAP = 1_000_000, 20_000
#: Items in a block: it bounds what a search sends to every task.
BLOCK = 20_000

WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """Longest runs of letters and digits, in lower case."""
    return WORD.findall(text.lower()) if text else []


def pack(at: np.ndarray) -> bytes:
    """Ascending positions as compressed steps."""
    step = np.diff(at, prepend=np.int64(0))
    kind = np.uint16 if len(step) == 0 or step.max() < 65536 else np.uint32
    raw = step.astype(kind).tobytes()
    return (b"2" if kind is np.uint16 else b"4") + (b"z" + zlib.compress(raw, 1) if len(raw) > 200 else b"r" + raw)


def unpack(b: bytes) -> np.ndarray:
    raw = zlib.decompress(b[2:]) if b[1:2] == b"z" else b[2:]
    return np.cumsum(np.frombuffer(raw, np.uint16 if b[:1] == b"2" else np.uint32), dtype=np.int64)


def write_index(docs: DataFrame, doc: str, text: str, path: str | None = None, segment: int = SEGMENT, lap: int = LAP) -> str:
    """Write the index of ``docs`` and return its path.

    Below it, ``postings`` has (segment, term, n, at), with the reserved term
    '' holding the documents' first positions, and in ``docs`` their ids. Null
    and empty texts have no postings; repeated rows are indexed as often as
    they stand. ``doc`` must be an integer column.
    """
    spark = docs.sparkSession
    path = path or scratch(spark, "postings")

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        terms: dict[str, int] = {}
        flow: list[np.ndarray] = []
        starts: list[int] = []
        ids: list[int] = []
        size = 0

        def flush() -> Iterator[pd.DataFrame]:
            nonlocal number, size
            if not ids:
                return
            code = np.concatenate(flow)
            order = np.argsort(code, kind="stable")
            bounds = np.searchsorted(code[order], np.arange(len(terms) + 1))
            names = list(terms)
            name = (task << 32) + number
            for a in range(0, len(names), 20_000):
                part = range(a, min(a + 20_000, len(names)))
                yield frame(
                    segment=np.full(len(part), name),
                    term=[names[k] for k in part],
                    n=[int(bounds[k + 1] - bounds[k]) for k in part],
                    at=[pack(order[bounds[k] : bounds[k + 1]]) for k in part],
                )
            yield frame(segment=[name], term=[""], n=[len(ids)], at=[np.array([starts, ids], np.int64).tobytes()])
            number, size = number + 1, 0
            terms.clear(), flow.clear(), starts.clear(), ids.clear()

        for b in batches:
            for d, t in zip(b["doc"], b["text"]):
                tokens = words(t)
                for a in range(0, len(tokens), segment - lap):
                    part = tokens if len(tokens) <= segment else tokens[a : a + segment]
                    if size and size + len(part) > segment:
                        yield from flush()
                    starts.append(size)
                    ids.append(int(d))
                    code = np.empty(len(part) + 1, np.int32)
                    code[:-1] = [terms.setdefault(w, len(terms)) for w in part]
                    code[-1] = np.iinfo(np.int32).max
                    flow.append(code)
                    size += len(code)
                    if a + segment >= len(tokens):
                        break
        yield from flush()

    rows = docs.select(F.col(doc).cast("long").alias("doc"), F.col(text).alias("text")).where("doc IS NOT NULL AND text IS NOT NULL")
    rows.mapInPandas(build, "segment long, term string, n long, at binary").write.option("compression", "snappy").parquet(path)
    return path


def anchors(tokens: list[str], weight: dict[str, int], n: int, slack: int = 0) -> list[int]:
    """Places that no match of ``n`` words can miss: of each stretch of ``n`` the
    ``slack`` + 1 consecutive words with the fewest postings together."""
    w = [weight.get(t, 0) for t in tokens]
    cost = [(sum(w[k : k + slack + 1]), tokens[k], k) for k in range(len(tokens) - slack)]
    starts = {min(cost[a : a + n - slack])[2] for a in range(len(tokens) - n + 1)}
    return sorted({k + d for k in starts for d in range(slack + 1)})


def longest_chains(hits: list[tuple[int, int, int]], slack: int) -> dict[int, int]:
    """Of (document, position, place in the item): the length of each document's
    longest chain, by the lengths of the chains that end at each hit."""
    best: dict[tuple[int, int], int] = {}
    top: dict[int, int] = {}
    steps = range(1, slack + 2)
    owner = {}
    for d, p, k in sorted(hits):
        n = 1 + max((best[q] for x in steps for y in steps if (q := (p - x, k - y)) in best and owner[p - x] == d), default=0)
        best[(p, k)], owner[p] = n, d
        top[d] = max(top.get(d, 0), n)
    return top


def runs(hits: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Length of the longest run of True in each row, 0 where it is under n, and where it ends."""
    best, ends, run = (np.zeros(len(hits), np.int64) for _ in range(3))
    for k in range(hits.shape[1]):
        run = np.where(hits[:, k], run + 1, 0)
        ends = np.where(run > best, k, ends)
        np.maximum(best, run, out=best)
    return np.where(best >= n, best, 0), ends


def search(index: str, items: DataFrame, item: str, text: str, n: int = PASSAGE, slack: int = 0, block: int = BLOCK) -> DataFrame:
    """(doc_id, item_id, n_words): documents that hold at least ``n``
    consecutive words of an item one after another, with the longest such run.

    With ``slack`` > 0 a match by proximity counts too: at least ``n`` words of
    the item in order, up to ``slack`` of its words left out and up to ``slack``
    words of the document put in between one and the next; n_words is then the
    number of words of the longest such chain. It never leaves a document. ``n``
    must be more than ``slack``. Items under ``n`` words,
    null or empty ones match nothing. Repeated items and documents give one row
    per pair of ids. All items are searched, block by block; within a block
    the items go to the tasks, which is a bounded number.
    """
    if not 0 <= slack < n:
        raise ValueError("0 <= slack < n")
    spark = items.sparkSession
    postings = spark.read.parquet(index)
    rows = items.select(F.col(item).cast("long").alias("i"), F.col(text).alias("t")).where("i IS NOT NULL AND t IS NOT NULL").dropDuplicates()
    total = rows.count()
    out = None
    for part in range(max(1, -(-total // block))):
        own = rows if total <= block else rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(-(-total // block))) == part)
        found = _search_block(spark, postings, [(r["i"], words(r["t"])) for r in own.toLocalIterator()], n, slack)
        out = found if out is None else out.unionByName(found)
    return out.groupBy("doc_id", "item_id").agg(F.max("n_words").alias("n_words"))


def _search_block(spark: SparkSession, postings: DataFrame, items: list[tuple[int, list[str]]], n: int, slack: int) -> DataFrame:
    schema = "doc_id long, item_id long, n_words long"
    items = [(i, t) for i, t in items if len(t) >= n]
    vocabulary = sorted({w for _, t in items for w in t})
    if not vocabulary:
        return spark.createDataFrame([], schema)
    # bounded by the block: at most its distinct words
    wanted = F.broadcast(spark.createDataFrame([(w,) for w in ["", *vocabulary]], "term string"))
    own = postings.join(wanted, "term", "left_semi")
    weight = {r["term"]: r["n"] for r in own.where("term != ''").groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator()}
    places = [anchors(t, weight, n, slack) for _, t in items]
    by_anchor: dict[str, list[int]] = {}
    for x, (_, t) in enumerate(items):
        for w in {t[k] for k in places[x]}:
            by_anchor.setdefault(w, []).append(x)
    sent = spark.sparkContext.broadcast((items, places, by_anchor, weight))

    def match(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        items, places, by_anchor, weight = sent.value
        starts, ids = np.frombuffer(pdf.loc[pdf["term"] == "", "at"].iloc[0], np.int64).reshape(2, -1)
        packed = dict(zip(pdf["term"], pdf["at"]))
        lists: dict[str, np.ndarray] = {}
        none = np.empty(0, np.int64)

        def at(w: str) -> np.ndarray:
            if w not in lists:
                lists[w] = unpack(packed[w]) if w in packed else none
            return lists[w]

        def in_doc(p: np.ndarray) -> np.ndarray:
            return np.searchsorted(starts, p, "right") - 1

        def exact(tokens: list[str], places: list[int]) -> Iterator[tuple[int, int]]:
            base = np.unique(np.concatenate([at(tokens[k]) - k for k in places]))
            order = sorted(range(len(tokens)), key=lambda k: (weight.get(tokens[k], 0), k))
            hits = np.zeros((len(base), len(tokens)), bool)
            alive = np.arange(len(base))
            for seen, k in enumerate(order):
                p = at(tokens[k])
                if len(p):
                    x = base[alive] + k
                    j = np.searchsorted(p, x)
                    j[j == len(p)] = 0
                    hits[alive, k] = p[j] == x
                # an alignment that misses too many words can't reach n any more
                left = len(tokens) - seen - 1
                alive = alive[hits[alive].sum(1) + left >= n] if seen % 8 == 7 else alive
                if not len(alive):
                    return
            best, ends = runs(hits[alive], n)
            good = best > 0
            # the last place of the run names the document
            yield from zip(in_doc(base[alive[good]] + ends[good]).tolist(), best[good].tolist())

        def near(tokens: list[str], places: list[int]) -> Iterator[tuple[int, int]]:
            seeds = np.unique(np.concatenate([at(tokens[k]) for k in places]))
            every = np.sort(np.concatenate([at(t) for t in set(tokens)]))
            if not len(seeds) or len(every) < n:
                return
            # the n words of a chain stand within so many places, an anchor among them
            wide = (n - 1) * (slack + 1)
            first = every[: len(every) - n + 1][every[n - 1 :] - every[: len(every) - n + 1] <= wide]
            next_ = np.searchsorted(seeds, first)
            first = first[(next_ < len(seeds)) & (seeds[np.minimum(next_, len(seeds) - 1)] <= first + wide)]
            if not len(first):
                return
            # stretches that hold the whole chain, those that meet as one
            reach = len(tokens) * (slack + 1)
            cut = np.flatnonzero(np.diff(first) > 2 * reach) + 1
            lo, hi = first[np.insert(cut, 0, 0)] - reach, first[np.append(cut, len(first)) - 1] + reach
            where: dict[str, list[int]] = {}
            for k, t in enumerate(tokens):
                where.setdefault(t, []).append(k)
            found = []
            for t, ks in where.items():
                p = at(t)
                if len(p):
                    x = np.searchsorted(lo, p, "right") - 1
                    p = p[(x >= 0) & (p <= hi[x])]
                    found += [(x, k) for x in p.tolist() for k in ks]
            if found:
                docs = in_doc(np.array([x for x, _ in found], np.int64)).tolist()
                yield from ((d, m) for d, m in longest_chains([(d, x, k) for d, (x, k) in zip(docs, found)], slack).items() if m >= n)

        out: list[tuple[int, int, int]] = []
        for x in sorted({x for t in packed if t in by_anchor for x in by_anchor[t]}):
            i, tokens = items[x]
            out += [(int(ids[d]), i, m) for d, m in (near if slack else exact)(tokens, places[x])]
        return pd.DataFrame(out, columns=["doc_id", "item_id", "n_words"]).astype("int64")

    return own.select("segment", "term", "at").groupBy("segment").applyInPandas(match, schema)


def leaked(docs: DataFrame, doc: str, text: str, items: DataFrame, item: str, item_text: str, n: int = PASSAGE, slack: int = 0) -> DataFrame:
    """Index ``docs`` and search it for ``items``; see :func:`search`."""
    return search(write_index(docs, doc, text), items, item, item_text, n, slack)
