"""The main body of a page of text.

Words score for content and what stands for tags in plain text (menus,
separators, link marks, lines without an end) scores against it. The weights are
log odds of words, word pairs and line shapes, counted over all pages at hand,
whose lines are labelled by repetition and place. Pages are taken apart once, by
array operations over the characters of many lines, into a written table of
hashes that has a slice of pages in each row; lines are counted, placed, labelled
and scored from it. Sentences that one page alone has are its running text; lines
that several pages have and that stand around running text are furniture. No line
is known beforehand. A line's score is the sum of its
weights, the page's main region the stretch of lines with the greatest sum,
found by one linear scan; lines inside it that score clearly against content are
interruptions and not body either. A headline, where the page has one known
from its record, opens the region.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commgraph.llm.frames import added, frame, packed, unpacked
from commgraph.runtime import cut

#: Cells of hashed words, of hashed word pairs; the table of weights is of fixed size whatever the corpus.
WORDS, PAIRS = 1 << 18, 1 << 19
#: Bounds of one weight, of a whole line's, of a line's score, and what an interruption scores at most.
CLIP, WHOLE_CLIP, LINE_CLIP, LINE_FLOOR, INTERRUPTION = 2.5, 8.0, 12.0, -3.0, -1.0
#: Least score of a time or a sound.
STOCK = 4.0
HEADLINE = 40.0

#: Stems of what a page interrupts its own text with (fixed values: general words of web pages).
INTERRUPTIONS = re.compile(
    r"\b(?:advert|sponsor|promot|subscri|newsletter|briefing|sign|cookie|gallery|photo|video|listen|podcast|donat|gift|continues|related|trending"
    r"|anzeige|werbung|abonnier|anmeld|rundbrief|publicidad|anuncio|patrocin|suscri|boletín|publicité|parrain|abonne|lettre|suite)",
    re.I,
)
#: Words whose hashes a worker keeps to save time.
KEPT = 400_000
#: Words of a stock phrase of an event at most.
PHRASE = 5
#: Pages looked at in one go, and their bytes if one page doesn't have more; characters taken apart in one go.
SLICE, SLICE_BYTES, PORTION = 1000, 1 << 23, 1 << 18

BULLETS = frozenset("•–*·▪◦-")
LINK = re.compile(r"\[([^\[\]]*)\](?:\([^()\s]*\))?")
NUMBER = re.compile(r"\d+(?:[.,]\d+)*")
TIMED = re.compile(r"\s*(?:>>\s*)?[\[(]?(?:\d{1,2}:)?\d{1,3}:\d{2}[\])]?(?:\s|$)|[^\[\n]{0,60}\[(?:\d{1,2}:)?\d{1,3}:\d{2}\]:?\s*$")
SOUND = re.compile(r"^\s*(?:\([^()]+\)|\[[^\[\]]+\]|<<?[^<>]+>>?|♪[^♪]*♪|\*[^*]+\*)\s*$")
OPENS_SOUND = frozenset("([<♪*")
NOISE = re.compile(r"applau|laugh|cheer|cross ?talk|inaudible|unintelligible|music|cough|bell|audio|silence|pause|\bboo|sigh|noise|gavel|rires|musik|beifall|risas|aplausos", re.I)
LABEL = re.compile(r"^\s*(?:>>\s*)?(?:\[[^\[\]]{2,50}\]:?|[^\W\d_][\w.'’\- ,()]{1,48}(?::|\s[—–])(?=\s|$))")


def bare(line: str) -> tuple[str, bool]:
    """A line without list and link marks, and whether it had any."""
    s = inner = line.strip()
    if inner[:1] in BULLETS and inner[1:2].isspace():
        inner = inner[1:].lstrip()
    if inner[:1] == "[" and (m := LINK.fullmatch(inner)):
        inner = m[1].strip()
    return inner, inner != s


def plain(line: str) -> str:
    return NUMBER.sub("#", bare(line)[0].lower())


def is_sound(line: str) -> bool:
    return bool(SOUND.match(line) and NOISE.search(line))


SEPARATORS = frozenset("|·»›/→←©°•")
CLOSING, FULL_STOPS = "\"'”’»)", frozenset(".?!…")


def is_sentence(line: str) -> bool:
    s = line.rstrip().rstrip(CLOSING)
    return s[-1:] in FULL_STOPS and len(s.split()) >= 9


#: Bits of a line: its shapes, which have weights, and what labels and scores go by.
SHAPES = ("~n0", "~n1", "~n3", "~n8", "~n15", "~n+", "~end.", "~end?", "~end!", "~end…", "~end:", "~end-", "~up", "~lo", "~mark", "~gap", "~sep")
SENTENCE, QUESTION, STOCKED, LABELLED, ENDS, SHORT, NUMBERED, MARKED, STOPS, HEAD = (1 << k for k in range(len(SHAPES), len(SHAPES) + 10))
BIT = {name: 1 << k for k, name in enumerate(SHAPES)}
CELLS = WORDS + PAIRS + len(SHAPES)
OF_SIZE = [BIT["~n" + ("0" if n == 0 else "1" if n == 1 else "3" if n <= 3 else "8" if n <= 8 else "15" if n <= 15 else "+")] for n in range(17)]
OF_END = {end: BIT["~end" + end] for end in ".?!…:"}
ENDINGS = frozenset(".?!")
#: Marks hashes of words that begin an interruption, of separators and of numbers, above their 32 bits.
STOP, SEPARATOR, FIGURE = 1 << 32, 1 << 33, 1 << 34
#: Kinds of characters: of words, digits, what joins two of either, what stands by itself, blanks.
LETTERS, DIGITS, JOINTS, POINTS, SIGNS, BLANKS = (1 << k for k in range(6))


def kind_of(c: str) -> int:
    kind = DIGITS if c.isdecimal() else LETTERS if c.isalnum() else BLANKS if c.isspace() else 0
    return kind | (JOINTS if c in "'’-" else 0) | (POINTS if c in ".," else 0) | (SIGNS if c in "#|·»›>/→←©°•–—:?!.;,()[]-" else 0)


KINDS = np.array([kind_of(chr(c)) for c in range(1 << 16)], np.uint8)
FACTOR = 0x9E3779B97F4A7C15
POWERS = np.cumprod(np.full(256, FACTOR, np.uint64))


def characters(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of lines, laid end to end with line feeds between, and their kinds."""
    c = np.frombuffer("\n".join(lines).encode("utf-32-le"), np.uint32)
    if not len(c) or c.max() < len(KINDS):
        return c, KINDS[c]
    kind, far = KINDS[np.minimum(c, len(KINDS) - 1)], c >= len(KINDS)
    own, at = np.unique(c[far], return_inverse=True)
    kind[far] = np.array([kind_of(chr(x)) for x in own.tolist()], np.uint8)[at]
    return c, kind


def first_of(on: np.ndarray) -> np.ndarray:
    """Where runs begin."""
    out = on.copy()
    out[1:] &= ~on[:-1]
    return out


def between(kind: np.ndarray, joint: int, of: int) -> np.ndarray:
    """Characters of kind ``of``, and ``joint`` between two of them."""
    on = (kind & of) != 0
    own = (kind & joint) != 0
    out = on.copy()
    out[1:-1] |= own[1:-1] & on[:-2] & on[2:]
    return out


#: Hashes of words by their sums.
WORDS_KNOWN: dict[int, int] = {}


def word_hash(word: str) -> int:
    return xxhash.xxh32_intdigest(word) | (STOP if INTERRUPTIONS.search(word) else 0) | (SEPARATOR if word in SEPARATORS else 0) | (FIGURE if word == "#" else 0)


def hashed(c: np.ndarray, starts: np.ndarray, figure: np.ndarray | None = None) -> np.ndarray:
    """Hashes of words, whose characters lie end to end in ``c``; those of ``figure`` count as numbers. Each
    word is told by its sum of characters times powers, and hashed as text once."""
    global POWERS
    if not len(starts):
        return np.empty(0, np.int64)
    sizes = np.diff(starts, append=len(c))
    while sizes.max() > len(POWERS):
        POWERS = np.concatenate([POWERS, POWERS * POWERS[-1]])
    total = np.empty(len(starts), np.uint64)
    for a in range(0, len(starts), PORTION):  # a long line has any number of words
        first, n = starts[a : a + PORTION] - starts[a], sizes[a : a + PORTION]
        own = c[starts[a] : starts[a] + n.sum()]
        total[a : a + PORTION] = np.add.reduceat(own * POWERS[np.arange(len(own)) - np.repeat(first, n)], first)
    if figure is not None:
        total[figure] = (np.uint64(ord("#")) * POWERS[:1])[0]
    own = pa.array(total).dictionary_encode()
    at, keys = own.indices.to_numpy(), own.dictionary.to_pylist()
    known = list(map(WORDS_KNOWN.get, keys))
    if None in known:
        where = np.empty(len(keys), np.int64)
        where[at] = np.arange(len(at))
        for k in (k for k, h in enumerate(known) if h is None):
            a = starts[where[k]]
            word = "#" if figure is not None and figure[where[k]] else c[a : a + sizes[where[k]]].tobytes().decode("utf-32-le")
            known[k] = word_hash(word)
            if len(WORDS_KNOWN) < KEPT:
                WORDS_KNOWN[keys[k]] = known[k]
    return np.array(known, np.int64)[at]


def by_line(feeds: np.ndarray, places: np.ndarray) -> np.ndarray:
    """How many of ``places`` lie in each line."""
    return np.diff(np.searchsorted(places, feeds), prepend=0, append=len(places))


def some(lines: list[str]) -> Iterator[list[str]]:
    """Lines in portions of bounded length, or one by one."""
    a = n = 0
    for k, x in enumerate(lines):
        if n + len(x) > PORTION and k > a:
            yield lines[a:k]
            a, n = k, 0
        n += len(x) + 1
    if a < len(lines):
        yield lines[a:]


def line_hash(p: str) -> int:
    return xxhash.xxh64_intdigest(p) - (1 << 63)


def lines_apart(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bits, hashes of lines with numbers apart, hashes of their words end to end, and words of each line."""
    own = list(map(bare, lines))
    low = [x.lower() for x, _ in own]
    c, kind = characters(low)
    number = between(kind, POINTS, DIGITS)
    first = first_of(number)
    keep = ~number | first
    c, kind = np.where(first, np.uint32(ord("#")), c)[keep], np.where(first, np.uint8(SIGNS), kind)[keep]
    word = between(kind, JOINTS, LETTERS)
    sign = ((kind & SIGNS) != 0) & ~word
    start, on, feeds = first_of(word) | sign, word | sign, np.flatnonzero(c == 10)
    hs, sizes = hashed(c[on], np.flatnonzero(start[on])), by_line(feeds, np.flatnonzero(start))
    blank = (kind & BLANKS) != 0
    words = by_line(feeds, np.flatnonzero(first_of(~blank)))
    bits = []
    for line, (inner, marked), low_, n in zip(lines, own, low, words.tolist()):
        end = inner[-1:]
        b = OF_SIZE[min(n, 16)] | OF_END.get(end, BIT["~end-"]) | (BIT["~up"] if n and len(inner) > 3 and inner.isupper() and inner == inner.upper() != low_ else BIT["~lo"])
        if marked:
            b |= BIT["~mark"] | MARKED
        if "  " in inner:
            b |= BIT["~gap"]
        if end in ENDINGS:
            b |= ENDS
        if n <= PHRASE:
            b |= SHORT
        if is_sentence(line) if marked else n >= 9 and inner.rstrip(CLOSING)[-1:] in FULL_STOPS:
            b |= SENTENCE | (LABELLED if LABEL.match(line) else 0) | (QUESTION if inner.rstrip(CLOSING)[-1:] == "?" else 0)
        if ":" in line and TIMED.match(line) or line.lstrip()[:1] in OPENS_SOUND and is_sound(line):
            b |= STOCKED
        bits.append(b)
    out = np.array(bits, np.int32)
    marks = np.flatnonzero(hs >= STOP)
    row = np.repeat(np.arange(len(lines)), sizes)[marks]
    for flag, b in ((STOP, STOPS), (SEPARATOR, BIT["~sep"] | MARKED), (FIGURE, NUMBERED)):
        out[row[(hs[marks] & flag) != 0]] |= b
    ps = c.tobytes().decode("utf-32-le").split("\n")
    return out, np.array(list(map(line_hash, ps)), np.int64), hs & (STOP - 1), sizes


class Taken:
    """Lines taken apart, laid end to end: bits, hashes of lines, hashes of words, words of each line, and the page of each."""

    def __init__(self, bits: np.ndarray, line: np.ndarray, word: np.ndarray, sizes: np.ndarray, page: np.ndarray, pages: int):
        self.bits, self.line, self.word, self.sizes, self.page, self.pages = bits, line, word, sizes, page, pages

    @classmethod
    def of(cls, lines: list[str], page: np.ndarray | None = None, pages: int = 1) -> Taken:
        own: dict[str, int] = {}
        at = np.array([own.setdefault(x, len(own)) for x in lines], np.int64)
        got = list(map(lines_apart, some(list(own)))) or [(np.empty(0, np.int32), *(np.empty(0, np.int64) for _ in range(3)))]
        bits, line, word, sizes = (np.concatenate(x) for x in zip(*got))
        n = sizes[at]
        places = np.repeat((np.cumsum(sizes) - sizes)[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return cls(bits[at], line[at], word[places], n, np.zeros(len(lines), np.int64) if page is None else page, pages)

    @classmethod
    def read(cls, b: pa.RecordBatch) -> Taken:
        """The pages of a row of TAKEN; its words may be missing."""
        n = unpacked(b, "lines", np.int32)
        word, sizes = np.empty(0, np.int64), np.empty(0, np.int64)
        if "word" in b.schema.names:
            sizes, codes = unpacked(b, "sizes", np.int32).astype(np.int64), b.column("word")[0].as_buffer()
            word = unpacked(b, "words", np.uint32).astype(np.int64)[unpacked(b, "word", np.uint32 if codes.size > 2 * sizes.sum() else np.uint16)]
        return cls(unpacked(b, "bits", np.int32), unpacked(b, "line", np.int64), word, sizes, np.repeat(np.arange(len(n)), n), len(n))

    def has(self, bit: int) -> np.ndarray:
        return (self.bits & bit) != 0

    def cells(self) -> tuple[np.ndarray, np.ndarray]:
        """Cells of all words and word pairs, and the lines they are of."""
        row = np.repeat(np.arange(len(self.sizes)), self.sizes)
        both = row[1:] == row[:-1]
        h = self.word.astype(np.uint64)
        pair = (h[:-1] * np.uint64(0x9E3779B1) + h[1:])[both]
        pair ^= pair >> np.uint64(29)
        return np.concatenate([h & np.uint64(WORDS - 1), np.uint64(WORDS) + (pair & np.uint64(PAIRS - 1))]).astype(np.int64), np.concatenate([row, row[1:][both]])


def parts(b: pa.RecordBatch, text: str = "t") -> Iterator[pa.RecordBatch]:
    """A batch in slices, so that what is made of one stays small."""
    size, a, n = pc.fill_null(pc.binary_length(b.column(text)), 0).to_pylist(), 0, 0
    for k, x in enumerate(size):
        if k - a == SLICE or n + x > SLICE_BYTES and k > a:
            yield b.slice(a, k - a)
            a, n = k, 0
        n += x
    if a < len(size):
        yield b.slice(a)


class Table:
    """Numbers by hash, as sorted arrays: twenty bytes or so each."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, self.values = keys[order].astype(np.int64), [v[order] for v in values]

    def __len__(self) -> int:
        return len(self.keys)

    def __iter__(self) -> Iterator[int]:
        return iter(self.keys.tolist())

    def __contains__(self, p: str) -> bool:
        h = line_hash(p)
        k = int(np.searchsorted(self.keys, h))
        return k < len(self.keys) and int(self.keys[k]) == h

    def at(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of ``keys``, and whether they are there at all."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        k = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return k, self.keys[k] == keys

    def get(self, keys: np.ndarray, missing: float, column: int = 0) -> np.ndarray:
        k, there = self.at(keys)
        return np.where(there, self.values[column][k] if len(self.keys) else missing, missing)


def running(t: Taken, pages: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each line whether it lies between the first and last statement that no
    other page has, whether after them, and whether its page has any. Questions may be headings of other pages."""
    own = np.flatnonzero(t.has(SENTENCE) & ~t.has(QUESTION) & (pages == 1))
    lo, hi = np.full(t.pages, len(t.bits)), np.full(t.pages, -1)
    lo[t.page[own][::-1]], hi[t.page[own]] = own[::-1], own
    k = np.arange(len(t.bits))
    lo, hi = lo[t.page], hi[t.page]
    return (lo <= k) & (k <= hi), k > hi, hi >= 0


def labelled(t: Taken, known: Table) -> np.ndarray:
    """Labels of lines, 1 body, 0 furniture, -1 unknown: running text
    is what no other page has and lies between sentences of that kind; what
    several pages have around it is furniture, and what stands alone after it
    leads elsewhere. Times, sounds and short phrases of an event, which end like
    speech and stand in or next to it, are body. Pages without running text have no labels."""
    pages, inner = known.get(t.line, 1), known.get(t.line, 0.0, 1)
    inside, after, some = running(t, pages)
    s, marked, stops, brief = t.has(SENTENCE), t.has(MARKED), t.has(STOPS), t.has(ENDS) & t.has(SHORT)
    one = pages == 1
    cases = [
        (~some, -1),  # without running text a page teaches nothing
        (t.has(STOCKED), 1),
        (inside & one, np.where(s, 1, np.where(marked, 0, -1))),
        (inside & (stops | marked | s & (inner < 0.5)), 0),
        (inside & ((inner > 0.6) | brief), 1),
        (inside, -1),
        (~one, np.where((brief & ~t.has(NUMBERED) & (inner > 0.2) | (inner > 0.6)) & ~stops & ~marked, 1, 0)),
        (after | marked, 0),
    ]
    return np.select([c for c, _ in cases], [np.broadcast_to(v, len(s)) for _, v in cases], -1)


class Weights:
    """Weights of the cells of words, word pairs and shapes, and of whole lines by their hash."""

    def __init__(self, cells: np.ndarray, whole: Table):
        self.cells, self.whole = cells.astype(np.float32), whole


class Counts:
    """Counts of cells in furniture and body lines, of lines and their words, and
    of the lines in ``known``, by label."""

    def __init__(self, known: Table):
        self.known, self.cells, self.whole, self.size = known, np.zeros((2, CELLS)), np.zeros((2, len(known))), np.zeros((2, 2))

    def add(self, t: Taken, weight: np.ndarray, skip: np.ndarray | None = None) -> None:
        label = labelled(t, self.known)
        if skip is not None:
            label = np.where(skip, -1, label)
        cell, row = t.cells()
        at, there = self.known.at(t.line)
        for k in (0, 1):
            w = np.where(label == k, weight[t.page], 0.0)
            own = w[row]
            self.cells[k] += np.bincount(cell, own, CELLS)
            for j in range(len(SHAPES)):
                self.cells[k, WORDS + PAIRS + j] += w[t.has(1 << j)].sum()
            self.size[k] += w.sum(), own.sum()
            self.whole[k] += np.bincount(at[there], w[there], len(self.known))

    def weights(self, least: int = 2) -> Weights:
        """Clipped log odds of features between body and furniture lines."""
        (b, a), n = self.cells, self.cells.sum(0)
        size = self.size.repeat([len(SHAPES), WORDS + PAIRS], axis=1)[:, ::-1] + 2  # shapes are once a line, words once a word
        w = np.log((a + 0.5) / size[1]) - np.log((b + 0.5) / size[0])
        # what is known from few lines weighs little
        cells = np.where(n >= least - 1e-6, np.clip(w * np.minimum(1.0, n / 6), -CLIP, CLIP), 0.0)
        # lines that several pages have are known whole, too
        on = np.flatnonzero(self.whole.sum(0) > 0)
        whole = np.clip(2 * np.log((self.whole[1, on] + 0.5) / (self.whole[0, on] + 0.5)), -WHOLE_CLIP, WHOLE_CLIP)
        return Weights(cells, Table(self.known.keys[on], whole))


def summed(keys: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums of ``weights`` by key."""
    own, at = np.unique(keys, return_inverse=True)
    return own, *(np.bincount(at, w, len(own)) for w in weights)


def on_pages(t: Taken, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lines of pages and on how many each stands."""
    order = np.lexsort((t.page, t.line))
    line, page = t.line[order], t.page[order]
    first = np.ones(len(line), bool)
    first[1:] = (line[1:] != line[:-1]) | (page[1:] != page[:-1])
    return summed(line[first], weight[page[first]])


def placed(t: Taken, pages: Table, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the lines that several pages have, their places and those in running text."""
    inside, _, _ = running(t, pages.get(t.line, 1))
    own = pages.at(t.line)[1]
    w = weight[t.page[own]]
    return summed(t.line[own], w, w * inside[own])


def fit(pages: list[str], least: int = 2, unseen: Callable[[str], bool] | None = None) -> Weights:
    """The weights of a list of pages, as :func:`learn` counts them. Lines that
    ``unseen`` holds out are not learned from, to measure how well others teach them."""
    split = [[x for x in p.split("\n") if x.strip()] for p in pages]
    lines = [x for p in split for x in p]
    t, weight = Taken.of(lines, np.repeat(np.arange(len(pages)), [len(p) for p in split]).astype(np.int64), len(pages)), np.ones(len(pages))
    line, n = on_pages(t, weight)
    several = Table(line[n > 1.5], n[n > 1.5])
    line, places, inside = placed(t, several, weight)
    counts = Counts(Table(line, several.get(line, 1), inside / np.maximum(places, 1e-9)))
    counts.add(t, weight, np.array([unseen(plain(x)) for x in lines], bool) if unseen else None)
    return counts.weights(least)


def line_scores(t: Taken, weights: Weights) -> np.ndarray:
    cell, row = t.cells()
    s = np.bincount(row, weights.cells[cell], len(t.bits)) + weights.whole.get(t.line, 0.0)
    for j in range(len(SHAPES)):
        s += np.where(t.has(1 << j), weights.cells[WORDS + PAIRS + j], 0.0)
    s = np.where(t.has(STOCKED), np.maximum(s, STOCK), np.where((s > 0) & t.has(LABELLED), s + 1.0, s))
    return np.clip(s, LINE_FLOOR, LINE_CLIP)


def score(line: str, weights: Weights) -> float:
    return float(line_scores(Taken.of([line]), weights)[0])


def slug(s: str) -> str:
    return re.sub(r"[-\s]+", "-", re.sub(r"[^\w\s-]", "", s.lower().strip())).strip("-")


def headings(title: str | None, rec: str | None) -> tuple[str, str]:
    """The slugs that a headline must equal: of the title, and of what the id keeps of it."""
    stem = rec.rsplit("_", 1)[0].strip("-") if rec and "_" in rec else ""
    return slug(title or ""), stem if len(stem) > 8 else ""


LETTER = re.compile(r"\w")


def is_headline(line: str, whole: str, stem: str) -> bool:
    if not (whole or stem):
        return False
    first = LETTER.search(line)
    c = first[0].lower()[:1] if first else ""
    if not c or c not in (whole[:1], stem[:1]):
        return False
    t = slug(bare(line)[0])
    return bool(t) and (t == whole or bool(stem) and (t[:40].strip("-") == stem or t == stem))


def best_stretch(t: Taken, weights: Weights) -> np.ndarray:
    """Whether each line is body: the best stretch of its page by one scan with the sum since the last fresh start."""
    head = t.has(HEAD)
    s = np.where(head, HEADLINE, line_scores(t, weights))
    ends = np.searchsorted(t.page, np.arange(t.pages + 1))
    inside = np.zeros(len(s), bool)
    values = s.tolist()
    for a, z in zip(ends[:-1].tolist(), ends[1:].tolist()):
        best, lo, hi, run, start = 0.0, a, a - 1, 0.0, a
        for k in range(a, z):
            if run <= 0:
                run, start = 0.0, k
            run += values[k]
            if run > best:
                best, lo, hi = run, start, k
        inside[lo : hi + 1] = True
    return inside & (head | (s > INTERRUPTION))


def apart(texts: list[str], titles: list, recs: list) -> tuple[Taken, np.ndarray]:
    """Pages taken apart, and the number from 1 of each line that isn't blank."""
    lines, nos, page, heads = [], [], [], []
    for n, (text, title, rec) in enumerate(zip(texts, titles, recs)):
        whole, stem = headings(title if isinstance(title, str) else None, rec)
        for k, line in enumerate(text.split("\n"), 1):
            if line.strip():
                lines.append(line), nos.append(k), page.append(n)
                heads.append(is_headline(line, whole, stem))
    t = Taken.of(lines, np.array(page, np.int64), len(texts))
    t.bits |= np.where(np.array(heads, bool), HEAD, 0).astype(np.int32)
    return t, np.array(nos, np.int32)


def body_lines(text: str, weights: Weights, title: str | None = None, rec: str | None = None) -> list[tuple[int, bool]]:
    """(line number from 1, is body) of each line that isn't blank."""
    t, nos = apart([text], [title], [rec])
    return list(zip(nos.tolist(), best_stretch(t, weights).tolist()))


#: Pages taken apart, a slice in each row: ids, hashes of the texts, lines of each page; numbers, bits, hashes and words of
#: each line; distinct words, and the place there of each word.
TAKEN = "rec array<string>, text binary, lines binary, no binary, bits binary, line binary, sizes binary, words binary, word binary"


def taken_apart(pages: DataFrame, text: str, rec: Column | None = None, title: Column | None = None) -> DataFrame:
    """The pages taken apart, as a written table; see TAKEN. Null texts have no part in it."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in parts(b):
                t, nos = apart(*(c.column(x).to_pylist() for x in ("t", "title", "rec")))
                own = pa.array(t.word).dictionary_encode()
                words, code = own.dictionary.to_numpy().astype(np.uint32), own.indices.to_numpy()
                yield packed(
                    rec=pa.array([c.column("rec").to_pylist()], pa.list_(pa.string())), text=c.column("text").to_numpy(), lines=np.bincount(t.page, minlength=t.pages).astype(np.int32),
                    no=nos, bits=t.bits, line=t.line, sizes=t.sizes.astype(np.int32), words=words, word=code.astype(np.uint16 if len(words) <= 1 << 16 else np.uint32),
                )

    none = F.lit(None).cast("string")
    own = pages.select(F.col(text).alias("t"), (none if rec is None else rec.cast("string")).alias("rec"), (none if title is None else title.cast("string")).alias("title"), F.xxhash64(text).alias("text")).where("t IS NOT NULL")
    return cut(own.mapInArrow(take, TAKEN), "lines")


def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows one by one."""
    for b in batches:
        for k in range(b.num_rows):
            yield b.slice(k, 1)


def learn_taken(taken: DataFrame) -> Weights:
    """Fit the weights on all pages of ``taken``; a text that stands several times
    counts once. Tasks send sums; the driver gets the cells and a number for each
    line that several pages have and for each text that stands several times."""
    spark = taken.sparkSession

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in each(batches):
            yield pa.RecordBatch.from_arrays([pa.array(unpacked(b, "text", np.int64))], ["text"])

    again = taken.select("text").mapInArrow(texts, "text long").groupBy("text").count().where("count > 1").toPandas()
    share = Table(again["text"].to_numpy(np.int64), 1.0 / again["count"].to_numpy(float))

    def summed_up(step: Callable, names: list[str], **sent_: object) -> DataFrame:
        sent = spark.sparkContext.broadcast((share, sent_))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, values = sent.value
            for b in each(batches):
                weight = own.get(unpacked(b, "text", np.int64), 1.0)
                got = step(Taken.read(b), weight, **values)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in got], ["key", *names])

        schema = ", ".join(["key long", *(f"{n} double" for n in names)])
        return taken.select("text", "lines", "bits", "line").mapInArrow(run, schema).groupBy("key").agg(*(F.sum(n).alias(n) for n in names))

    got = summed_up(lambda t, weight: on_pages(t, weight), ["n"]).where("n > 1.5").toPandas()
    several = Table(got["key"].to_numpy(np.int64), np.round(got["n"].to_numpy(float)))
    got = summed_up(lambda t, weight, several: placed(t, several, weight), ["places", "inside"], several=several).toPandas()
    key = got["key"].to_numpy(np.int64)
    known = Table(key, several.get(key, 1), (got["inside"] / got["places"]).to_numpy(float))
    sent = spark.sparkContext.broadcast((share, known))

    def count(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
        own, lines = sent.value
        counts = Counts(lines)
        for b in each(batches):
            counts.add(Taken.read(b), own.get(unpacked(b, "text", np.int64), 1.0))
        return [counts.cells, counts.whole, counts.size]

    counts = Counts(known)
    counts.cells, counts.whole, counts.size = added(taken.select("text", "lines", "bits", "line", "sizes", "words", "word"), count, [CELLS, len(known), 2])
    return counts.weights()


def learn(pages: DataFrame, text: str) -> Weights:
    """Fit the weights on all ``pages``."""
    return learn_taken(taken_apart(pages, text))


def flags_of(taken: DataFrame, weights: Weights, body: bool | None = None, without: DataFrame | None = None) -> DataFrame:
    """(rec, line_no, is_body) of every line of pages taken apart that isn't blank;
    of those in or not in the ``body`` only, if given, and of no page whose ``rec`` is in ``without``."""
    sent = taken.sparkSession.sparkContext.broadcast(weights)

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in each(batches):
            t, rec = Taken.read(b), b.column("rec").flatten()
            flags = best_stretch(t, sent.value)
            own = np.flatnonzero(rec.is_valid().to_numpy(zero_copy_only=False)[t.page] & (True if body is None else flags == body))
            yield pa.RecordBatch.from_arrays([rec.take(pa.array(t.page[own])), pa.array(unpacked(b, "no", np.int32)[own]), pa.array(flags[own])], ["rec", "line_no", "is_body"])

    flags = taken.select("rec", "lines", "no", "bits", "line", "sizes", "words", "word").mapInArrow(flag, "rec string, line_no int, is_body boolean")
    return (flags if without is None else flags.join(without, "rec", "left_anti")).distinct()


def line_flags(pages: DataFrame, rec: Column, text: str, weights: Weights, title: Column | None = None) -> DataFrame:
    """(rec, line_no, is_body) of every line that isn't blank.

    Lines end at line feeds and count from 1, blank ones included. Null and
    blank texts have no such lines. Texts are taken once however often their
    row repeats.
    """
    return flags_of(taken_apart(pages, text, rec, title), weights)


def main_bodies(pages: DataFrame, rec: Column, text: str, weights: Weights, title: Column | None = None) -> DataFrame:
    """(rec, body, n_lines, n_kept): the main body of each page, its lines joined again."""
    sent = pages.sparkSession.sparkContext.broadcast(weights)

    def strip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = sent.value
        for b in batches:
            out = []
            t, nos = apart(list(b["text"]), list(b["title"]), list(b["rec"]))
            flags, ends = best_stretch(t, w), np.searchsorted(t.page, np.arange(t.pages + 1))
            for k, text_ in enumerate(b["text"]):
                own = slice(ends[k], ends[k + 1])
                keep = dict(zip(nos[own].tolist(), flags[own].tolist()))
                lines = text_.split("\n")
                out.append(("\n".join(x for k, x in enumerate(lines) if keep.get(k + 1)), len(keep), sum(keep.values())))
            yield frame(rec=list(b["rec"]), body=[o[0] for o in out], n_lines=np.array([o[1] for o in out], np.int32), n_kept=np.array([o[2] for o in out], np.int32))

    own = pages.select(rec.cast("string").alias("rec"), F.col(text).alias("text"), (F.lit(None) if title is None else title).cast("string").alias("title")).where("rec IS NOT NULL AND text IS NOT NULL")
    return own.mapInPandas(strip, "rec string, body string, n_lines int, n_kept int").distinct()
