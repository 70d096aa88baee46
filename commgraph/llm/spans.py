"""Long spans that stand verbatim in more than one record.

1. Exact copies of a text are one class; the work is done on classes.
2. Windows of ``K`` characters are picked by local minima of a rolling hash
   over all stretches of ``span - K + 1`` windows, so that every span of at
   least ``span`` characters holds a picked window, the same one in every
   record that has the span.
3. A first pass counts the picked windows of each partition in a count-min
   sketch; the sketches are merged by blocks of cells. An estimate is never
   below the true count, so a window estimated to stand in one text only does.
4. A second pass sends only windows estimated repeated, with as many characters
   around them as a span can reach. All stretches of exactly ``span`` characters
   around a window are hashed (128 bits) and texts grouped by equal stretches;
   no two texts are ever compared in pairs, so the work is linear in the group.
   Stretches one after another that the same texts share are one run. The
   occurrences of a window are grouped where they lie together; those of a
   window so frequent that no task should hold them are spread over all tasks
   by stretch. The stretches, and so the result, are the same.

The result is kept as membership: groups of texts that share a stretch. Groups of
the same texts are one, and groups inside another that all their texts have as
their largest say nothing new. Texts with the same groups form a set; links are
counted between sets. Pairs of documents are written only where they are asked for.

The sketch follows the number of characters up to ``MAX_CELLS``; beyond that it
passes more windows, and loses none.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commgraph.llm.frames import frame
from commgraph.runtime import cut

SPAN = 300
#: Characters of a window.
K = 100
#: Cells of a sketch row (powers of two) and rows; a broadcast sketch has a bit a cell, so 32 MB a row at most.
MIN_CELLS, MAX_CELLS, ROWS = 1 << 20, 1 << 28, 2
BLOCK = 1 << 16
#: Occurrences of a window that are grouped in one task; it bounds a task's memory, not the result.
TOGETHER = 2048
#: Characters handled at once in a task.
SLICE = 300_000
MULT = np.uint64(0x9E3779B97F4A7C15)
MASK64 = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Roller:
    """Hashes of all windows of ``k`` in an array, by prefix sums modulo 2^64."""

    def __init__(self, k: int, size: int, base: int = 0xA24BAED4963EE407):
        self.k = k
        base = np.uint64(base)
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        self.up = np.cumprod(np.full(size, base), dtype=np.uint64)
        self.down = np.cumprod(np.full(size, inverse), dtype=np.uint64)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        n = len(codes)
        if n < self.k:
            return np.empty(0, np.uint64)
        p = np.zeros(n + 1, np.uint64)
        np.cumsum(mix((codes.astype(np.uint64) + np.uint64(1)) * MULT) * self.down[:n], out=p[1:])
        return mix((p[self.k :] - p[: n - self.k + 1]) * self.up[: n - self.k + 1])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` in a row, in log2(w) steps."""
    step, out = 1, x
    while step * 2 <= w:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    return np.minimum(out[: len(out) - (w - step)], out[w - step :]) if w > step else out


def picked(codes: np.ndarray, owner: np.ndarray, roll: Roller, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the picked windows of texts laid end to end;
    ``owner`` has each character's text, and no window crosses texts."""
    h = roll(codes)
    w = span - roll.k + 1
    if len(h) < w:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    low = sliding_min(h, w)
    valid = owner[: len(low)] == owner[span - 1 : span - 1 + len(low)]
    low = np.where(valid, low, np.uint64(0))
    # a window is picked if it is the least of some valid stretch it lies in
    n = len(h)
    pad = np.zeros(n + w - 1, np.uint64)
    pad[w - 1 : w - 1 + len(low)] = low
    at = np.flatnonzero(h == ~sliding_min(~pad, w)[:n]) if n else np.empty(0, np.int64)
    return at, h[at]


def slices(batches: Iterator[pd.DataFrame], span: int) -> Iterator[tuple[list[int], list[str], np.ndarray, np.ndarray, np.ndarray]]:
    """Texts laid end to end in arrays of about SLICE characters: their keys,
    texts, codes, owners and each one's first place. A longer text comes in
    several parts that overlap by ``span`` - 1, so no stretch is lost."""

    def laid(keys: list[int], texts: list[str], shifts: list[int]):
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = [len(t) for t in texts]
        return keys, texts, codes, np.repeat(np.arange(len(texts), dtype=np.int32), sizes), np.cumsum([0, *sizes])[:-1], shifts

    keys, texts, shifts, size = [], [], [], 0
    for b in batches:
        for k, t in zip(b["cls"], b["text"]):
            for a in range(0, max(1, len(t) - span + 1), SLICE - span + 1):
                part = t if len(t) <= SLICE else t[a : a + SLICE]
                if size and size + len(part) > SLICE:
                    yield laid(keys, texts, shifts)
                    keys, texts, shifts, size = [], [], [], 0
                keys.append(k), texts.append(part), shifts.append(a)
                size += len(part)
    if keys:
        yield laid(keys, texts, shifts)


def cells_of(h: np.ndarray, row: int, cells: int) -> np.ndarray:
    return (mix(h + np.uint64((row + 1) * int(MULT) & MASK64)) & np.uint64(cells - 1)).astype(np.int64)


def sketch(rows: DataFrame, cells: int, span: int) -> DataFrame:
    """The merged sketch, (row, block, bits): bit c of a block is set where its
    cell's count is 2 or more. Counts saturate at 2, which is all that is asked."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        roll = Roller(K, SLICE + span)
        hits: list[np.ndarray] = []
        for keys, _, codes, owner, _, _ in slices(batches, span):
            at, h = picked(codes, owner, roll, span)
            # a window that a text has twice counts once
            pair = np.unique(np.stack([h, np.asarray(keys)[owner[at]].astype(np.int64).view(np.uint64)]), axis=1) if len(at) else np.empty((2, 0), np.uint64)
            hits.append(pair[0])
        h = np.concatenate(hits) if hits else np.empty(0, np.uint64)
        for row in range(ROWS):
            c, n = np.unique(cells_of(h, row, cells), return_counts=True)
            blocks, first = np.unique(c // BLOCK, return_index=True)
            for b, a, z in zip(blocks, first, [*first[1:], len(c)]):
                own = np.zeros(BLOCK, np.uint8)
                own[c[a:z] % BLOCK] = np.minimum(n[a:z], 2)
                once, twice = np.packbits(own >= 1), np.packbits(own >= 2)
                yield frame(row=[row], block=[int(b)], once=[zlib.compress(once.tobytes(), 1)], twice=[zlib.compress(twice.tobytes(), 1)])

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # rows come sorted by block; one block's bits are held at a time, however many parts it has
        def bits(key: tuple) -> pd.DataFrame:
            return frame(row=[key[0]], block=[key[1]], bits=[zlib.compress(twice.tobytes(), 1)])

        current, once, twice = None, np.zeros(BLOCK // 8, np.uint8), np.zeros(BLOCK // 8, np.uint8)
        for pdf in batches:
            for row, block, a, b in zip(pdf["row"], pdf["block"], pdf["once"], pdf["twice"]):
                if (row, block) != current:
                    if current is not None and twice.any():
                        yield bits(current)
                    current = (row, block)
                    once[:] = 0
                    twice[:] = 0
                a, b = np.frombuffer(zlib.decompress(a), np.uint8), np.frombuffer(zlib.decompress(b), np.uint8)
                twice |= b | (once & a)
                once |= a
        if current is not None and twice.any():
            yield bits(current)

    parts = rows.mapInPandas(count, "row int, block int, once binary, twice binary")
    return parts.repartition("row", "block").sortWithinPartitions("row", "block").mapInPandas(merge, "row int, block int, bits binary")


def text_classes(docs: DataFrame, doc: str, text: str, span: int) -> tuple[DataFrame, DataFrame]:
    """(doc, cls, n_chars) of each document that could share a span, and (cls,
    text) of one member of each class of equal texts. Classes are found by a
    128-bit digest, ``cls`` is the smallest document."""
    rows = docs.select(F.col(doc).cast("long").alias("doc"), F.col(text).alias("text")).where(F.length("text") >= span)
    members = rows.select("doc", F.md5(F.col("text").cast("binary")).alias("d"), F.length("text").alias("n_chars"))
    heads = members.groupBy("d").agg(F.min("doc").alias("cls"))
    members = members.dropDuplicates(["doc", "d"]).join(heads, "d").select("doc", "cls", "n_chars")
    return members, rows


def occurrences(rows: DataFrame, cls: str, text: str, span: int = SPAN) -> DataFrame:
    """(cls, h, start, off, ctx): windows estimated repeated, ``start`` their
    place, ``ctx`` the text around them and ``off`` their place in it."""
    spark = rows.sparkSession
    rows = rows.select(F.col(cls).cast("long").alias("cls"), F.col(text).alias("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    picks = 2 * chars // (span - K + 2) + 1
    cells = MIN_CELLS
    while cells < min(MAX_CELLS, 4 * picks):
        cells *= 2
    bits = [np.zeros(cells // 8, np.uint8) for _ in range(ROWS)]
    for r in sketch(rows, cells, span).toLocalIterator():
        at = r["block"] * (BLOCK // 8)
        bits[r["row"]][at : at + BLOCK // 8] = np.frombuffer(zlib.decompress(r["bits"]), np.uint8)
    sent = spark.sparkContext.broadcast([zlib.compress(b.tobytes(), 1) for b in bits])
    reach = span - K

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        roll = Roller(K, SLICE + span)
        own = [np.frombuffer(zlib.decompress(b), np.uint8) for b in sent.value]
        for keys, texts, codes, owner, firsts, shifts in slices(batches, span):
            at, h = picked(codes, owner, roll, span)
            keep = np.ones(len(at), bool)
            for row in range(ROWS):
                c = cells_of(h, row, cells)
                keep &= (own[row][c >> 3] >> (7 - (c & 7)).astype(np.uint8)) & 1 == 1
            at, h = at[keep], h[keep]
            o = owner[at]
            local = at - firsts[o]
            left = np.minimum(local, reach)
            ctx = [texts[k][p - m : p + K + reach] for k, p, m in zip(o.tolist(), local.tolist(), left.tolist())]
            if ctx:
                yield frame(cls=np.asarray(keys, np.int64)[o], h=h.view(np.int64), start=local + np.asarray(shifts, np.int64)[o], off=left.astype(np.int32), ctx=ctx)

    return rows.mapInPandas(send, "cls long, h long, start long, off int, ctx string")


def stretch_keys(offs: np.ndarray, ctxs: list[str], span: int, rolls: tuple[Roller, Roller]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of every stretch of ``span`` characters around each window, and
    whether the text has it: arrays of one row per window and ``span`` - K + 1 columns."""
    reach = span - K
    wide = K + 2 * reach
    sizes = np.array([len(x) for x in ctxs], np.int64)
    codes = np.zeros((len(ctxs), wide), np.uint32)
    flat = np.frombuffer("".join(ctxs).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(ctxs)), sizes)
    codes[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + (reach - offs)[row]] = flat
    a, b = (np.empty((len(ctxs), reach + 1), np.uint64) for _ in rolls)
    step = max(1, SLICE // wide)
    for k in range(0, len(ctxs), step):
        part = codes[k : k + step].ravel()
        for out, roll in zip((a, b), rolls):
            h = np.concatenate([roll(part), np.zeros(span - 1, np.uint64)]).reshape(-1, wide)
            out[k : k + step] = h[:, : reach + 1]
    j = np.arange(reach + 1)[None, :]
    has = (j >= (reach - offs)[:, None]) & (j + span <= (reach - offs + sizes)[:, None])
    return a, b, has


def rollers(span: int) -> tuple[Roller, Roller]:
    size = SLICE + 2 * span
    return Roller(span, size), Roller(span, size, 0xD1342543DE82EF95)


def runs_of(g: pd.DataFrame, span: int, rolls: tuple[Roller, Roller]) -> pd.DataFrame:
    """(k1, k2, cls, start, n) of all occurrences of some windows: the stretches
    that two texts or more have, runs that the same texts share as one piece."""
    offs = g["off"].to_numpy(np.int64)
    a, b, has = stretch_keys(offs, list(g["ctx"]), span, rolls)
    a ^= mix(g["h"].to_numpy(np.int64).view(np.uint64))[:, None]
    row, col = np.nonzero(has)
    ka, kb, cls = a[row, col], b[row, col], g["cls"].to_numpy(np.int64)[row]
    order = np.lexsort((cls, kb, ka))
    ka, kb, cls, row, col = ka[order], kb[order], cls[order], row[order], col[order]
    fresh = np.ones(len(ka), bool)
    fresh[1:] = (ka[1:] != ka[:-1]) | (kb[1:] != kb[:-1])
    group = np.cumsum(fresh) - 1
    once = fresh.copy()
    once[1:] |= cls[1:] != cls[:-1]
    texts = np.bincount(group[once], minlength=1)
    mark = np.zeros(len(texts), np.uint64)
    np.add.at(mark, group[once], mix((cls[once].view(np.uint64) + np.uint64(1)) * MULT))
    keep = texts[group] > 1
    row, col, group = row[keep], col[keep], group[keep]
    ka, kb = ka[keep], kb[keep]
    order = np.lexsort((col, row))
    row, col, group, ka, kb = row[order], col[order], group[order], ka[order], kb[order]
    start = np.ones(len(row), bool)
    start[1:] = (row[1:] != row[:-1]) | (col[1:] != col[:-1] + 1) | (mark[group[1:]] != mark[group[:-1]]) | (texts[group[1:]] != texts[group[:-1]])
    at = np.flatnonzero(start)
    n = np.diff(np.append(at, len(row)))
    where = g["start"].to_numpy(np.int64)[row[at]] - (span - K) + col[at]
    return frame(k1=ka[at].view(np.int64), k2=kb[at].view(np.int64), cls=g["cls"].to_numpy(np.int64)[row[at]], start=where, n=(span - 1 + n).astype(np.int32))


PIECES = "k1 long, k2 long, cls long, start long, n int"


def shared_stretches(occ: DataFrame, span: int = SPAN, together: int = TOGETHER) -> DataFrame:
    """(k1, k2, cls, start, n): stretches that several classes have, (k1, k2) naming
    the stretch and so the group of classes that share it."""
    occ = cut(occ, "occurrences")
    counts = occ.groupBy("h").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi"), F.count(F.lit(1)).alias("m")).where("lo != hi").select("h", "m")
    both = cut(occ.join(counts, "h"), "windows")

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rolls, held, size = rollers(span), [], 0
        for b in batches:
            held.append(b)
            size += len(b)
            if size > SLICE // (span + K):
                g = pd.concat(held, ignore_index=True)
                last = g["h"].iloc[-1]  # its occurrences may go on
                open_ = (g["h"] == last).to_numpy()
                if not open_.all():
                    yield runs_of(g[~open_], span, rolls)
                held, size = [g[open_]], int(open_.sum())
        if size:
            yield runs_of(pd.concat(held, ignore_index=True), span, rolls)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rolls = rollers(span)
        for b in batches:
            for k in range(0, len(b), 500):
                g = b.iloc[k : k + 500]
                a, c, has = stretch_keys(g["off"].to_numpy(np.int64), list(g["ctx"]), span, rolls)
                a ^= mix(g["h"].to_numpy(np.int64).view(np.uint64))[:, None]
                row, col = np.nonzero(has)
                yield frame(k1=a[row, col].view(np.int64), k2=c[row, col].view(np.int64), cls=g["cls"].to_numpy(np.int64)[row], start=g["start"].to_numpy(np.int64)[row] - (span - K) + col, n=np.full(len(row), span, np.int32))

    columns = ["h", "cls", "start", "off", "ctx"]
    few = both.where(F.col("m") <= together).select(columns).repartition("h").sortWithinPartitions("h").mapInPandas(local, PIECES)
    many = cut(both.where(F.col("m") > together).select(columns).mapInPandas(spread, PIECES), "stretches")
    several = many.groupBy("k1", "k2").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo != hi").select("k1", "k2")
    return few.unionByName(many.join(several, ["k1", "k2"], "left_semi").select(few.columns))


def shared_spans(docs: DataFrame, doc: str, text: str, span: int = SPAN, together: int = TOGETHER) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, groups, pieces).

    ``members``: (doc, cls, n_chars). ``groups``: (k1, k2, cls), classes whose
    texts share a span are together in at least one group, and those of a group
    share one; groups of the same classes are given once. ``pieces``: (cls,
    start, n), stretches that another class shares, which together cover all
    that is shared between classes. Nulls and texts under ``span`` characters
    share nothing; white space and case count; repeated rows of one id are one
    document; a document that has a span twice shares it with others only.
    """
    members, rows = text_classes(docs, doc, text, span)
    members = cut(members, "members")
    heads = members.where("doc = cls").select("cls").distinct()
    # written once: both passes read it, and the texts are shuffled once
    rows = cut(rows.withColumnRenamed("doc", "cls").join(heads, "cls", "left_semi"), "texts")
    pieces = cut(shared_stretches(occurrences(rows, "cls", "text", span), span, together), "pieces")
    every = pieces.select("k1", "k2", "cls").distinct()
    one, two = F.xxhash64("cls"), F.xxhash64(F.lit(1), "cls")
    same = every.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(one).alias("x"), F.bit_xor(two).alias("y"))
    first = same.groupBy("m", "x", "y").agg(F.min(F.struct("k1", "k2")).alias("k")).select("k.k1", "k.k2")
    groups = cut(every.join(first, ["k1", "k2"], "left_semi"), "groups")
    return members, groups, pieces.select("cls", "start", "n")


def link_sets(groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cls, set) and (set_a, set_b, n_b): classes with the same groups are a set,
    named by its smallest class; two sets are linked where they have a group in
    common, each set to itself too, and ``n_b`` is the size of the other one.
    A class is linked with all classes of the sets its own is linked with."""
    sizes = groups.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("m"))
    g = groups.join(sizes, ["k1", "k2"])
    top = g.groupBy("cls").agg(F.max(F.struct("m", "k1", "k2")).alias("top"))
    # a group all of whose classes have the same other group as their largest adds no link
    tops = g.join(top, "cls").groupBy("k1", "k2").agg(F.min("top").alias("lo"), F.max("top").alias("hi"))
    kept = tops.where((F.col("lo") != F.col("hi")) | ((F.col("lo.k1") == F.col("k1")) & (F.col("lo.k2") == F.col("k2")))).select("k1", "k2")
    g = cut(groups.join(kept, ["k1", "k2"], "left_semi"), "links")
    own = g.groupBy("cls").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("k1", "k2")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "k1", "k2")).alias("y"))
    sets = own.groupBy("m", "x", "y").agg(F.min("cls").alias("set"), F.count(F.lit(1)).alias("size"))
    member = cut(own.join(sets, ["m", "x", "y"]).select("cls", "set", "size"), "sets")
    heads = g.join(member.where("cls = set"), "cls").select("k1", "k2", "set", "size")
    a, b = heads.alias("a"), heads.alias("b")
    pairs = a.join(b, (F.col("a.k1") == F.col("b.k1")) & (F.col("a.k2") == F.col("b.k2"))).select(F.col("a.set").alias("set_a"), F.col("b.set").alias("set_b"), F.col("b.size").alias("n_b")).distinct()
    return member.select("cls", "set"), pairs


def found_pairs(docs: DataFrame, doc: str, text: str, span: int = SPAN, together: int = TOGETHER) -> DataFrame:
    """(doc_id_a, doc_id_b), a < b, of documents that share a span, copies
    included: every pair is written out, because that is what is asked for."""
    members, groups, _ = shared_spans(docs, doc, text, span, together)
    x, y = groups.alias("x"), groups.alias("y")
    # a skewed group is split by AQE's skew join
    pairs = x.join(y, (F.col("x.k1") == F.col("y.k1")) & (F.col("x.k2") == F.col("y.k2")) & (F.col("x.cls") < F.col("y.cls"))).select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).distinct()
    m = members.select("doc", "cls")
    between = pairs.join(m.withColumnRenamed("cls", "a").withColumnRenamed("doc", "da"), "a").join(m.withColumnRenamed("cls", "b").withColumnRenamed("doc", "db"), "b")
    within = m.withColumnRenamed("doc", "da").join(m.withColumnRenamed("doc", "db"), "cls").where("da < db")
    return between.select("da", "db").unionByName(within.select("da", "db")).select(F.least("da", "db").alias("doc_id_a"), F.greatest("da", "db").alias("doc_id_b")).where("doc_id_a < doc_id_b").distinct()


def shared_share(docs: DataFrame, doc: str, text: str, span: int = SPAN, together: int = TOGETHER) -> DataFrame:
    """One row per document of at least ``span`` characters: (doc_id, class_id,
    n_copies, n_linked, n_chars, n_shared, share): how many of its characters
    stand in spans that other documents share, and with how many other classes
    it is linked. A copied text is shared as a whole. Links are counted between
    sets, never listed."""
    members, groups, pieces = shared_spans(docs, doc, text, span, together)
    w = "PARTITION BY cls ORDER BY start, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    cover = (
        pieces.distinct()
        .withColumn("before", F.expr(f"max(start + n) OVER ({w})"))
        .groupBy("cls")
        .agg(F.sum(F.greatest(F.lit(0), F.col("start") + F.col("n") - F.greatest(F.col("start"), F.coalesce("before", F.col("start"))))).alias("n_shared"))
    )
    member, pairs = link_sets(groups)
    links = member.join(pairs.groupBy(F.col("set_a").alias("set")).agg((F.sum("n_b") - 1).alias("n_linked")), "set").select("cls", "n_linked")
    sizes = members.groupBy("cls").agg(F.count(F.lit(1)).alias("n_copies"))
    return (
        members.join(sizes, "cls")
        .join(cover, "cls", "left")
        .join(links, "cls", "left")
        .select(
            F.col("doc").alias("doc_id"),
            F.col("cls").alias("class_id"),
            "n_copies",
            F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
            "n_chars",
            F.when(F.col("n_copies") > 1, F.col("n_chars").cast("long")).otherwise(F.coalesce("n_shared", F.lit(0))).alias("n_shared"),
        )
        .withColumn("share", F.col("n_shared") / F.col("n_chars"))
    )


def set_pairs(docs: DataFrame, doc: str, text: str, span: int = SPAN, together: int = TOGETHER) -> DataFrame:
    """(kind, a, b): the links in short. ``member`` rows give each document's (a)
    representative (b), the smallest document with the same links, a copy's
    being its class's; ``link`` rows the pairs a < b of representatives that
    share a span. Documents of one representative that is linked at all share one too."""
    members, groups, _ = shared_spans(docs, doc, text, span, together)
    member, pairs = link_sets(groups)
    own = members.join(member, "cls", "left").select(F.lit("member").alias("kind"), F.col("doc").alias("a"), F.coalesce("set", "cls").alias("b"))
    return own.unionByName(pairs.where("set_a < set_b").select(F.lit("link").alias("kind"), F.col("set_a").alias("a"), F.col("set_b").alias("b")))
