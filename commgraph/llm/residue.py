"""Template residue and error pages.

Passages are scored by a naive Bayes model learned from positive and unlabelled
text. A passage is a line, or a mark in one: what stands between brackets,
braces, percent signs and the like, described by its delimiters, its case and
its words. Trusted passages are the positive ones: marks in the forms of
template languages, and lines with a known message or filler in records that
have no other running text (fixed values below). All others are unlabelled.
Expectation-maximization starts from counting unlabelled passages as clean and
then lets each count as residue by its posterior, until the model stands still;
trusted ones keep their trust. The rules that name trusted passages are not
features of the model, which knows words, word pairs and marks only. It is a
table of hashed features, of fixed size whatever the corpus.

A record is residue if one of its marks is, by the model, an unfilled
placeholder, or if residue lines stand where its text should be: it has some,
and no line of running text that isn't one itself. An article that mentions such
a message has other text around it and is kept.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commgraph.llm import boilerplate
from commgraph.llm.frames import added, frame, packed, unpacked
from commgraph.runtime import cut

#: Features of lines, and of marks, which have a model of their own: text has few marks, and nearly all are clean.
LINES, MARKS = 1 << 16, 1 << 12
BUCKETS = LINES + MARKS
#: The model stands still when the share of residue moves by less, as a part of it; steps are few, as each shrinks the change.
STILL, STEPS = 1e-3, 40
#: What a posterior of an unlabelled passage counts for against a trusted one.
UNLABELLED = 0.02
THRESHOLD = 0.5
#: How much of what a trusted passage alone taught is left out of its own score.
LEFT_OUT = 0.5
#: Added to every count.
SMOOTH = 0.1
#: Least prior of residue.
LEAST = 0.1
#: Words whose hashes a worker keeps to save time.
KEPT = 400_000

#: Anything that stands out of text like a mark (fixed values: the bracketing of text and of template languages).
MARK = re.compile(
    r"\{\{[^{}\n]*\}\}|\{%[^%\n]*%\}|<%[^%\n]*%>|[$#]?\{[^{}\n]*\}|\[\[[^\[\]\n]*\]\]|\[[^\[\]\n]*\]|<[^<>\n]*>"
    r"|%\([^()\n]*\)\w|%%\w+%%|@@\w+@@|(?<!\w)__\w+?__(?!\w)|(?<![\w$])\$[A-Z_]+\$|\b[A-Z]{2}(?:[/.-][A-Z\d]{2,4})+\b|\b(?:undefined|NaN)(?:[ /]+(?:undefined|NaN))*"
)
#: Marks that are placeholders by form: template tags, format marks, named fields in brackets (fixed values).
PLACEHOLDER = re.compile(
    r"\{\{[^{}\n]*\}\}|\{%[^%\n]*%\}|<%[^%\n]*%>|[$#]\{[^{}\n]+\}"
    r"|\{\d{0,2}\}|\{[A-Za-z_][\w.]*(?:\s*\|\s*\w+)*\}"
    r"|%\([A-Za-z_]\w*\)[sdfr]|%%[A-Za-z_]\w*%%|@@[A-Za-z_]\w*@@|__[A-Za-z]+(?:_[A-Za-z]+)*__|\$[A-Z][A-Z_]*\$"
    r"|\[\[[A-Z_ ]{3,}\]\]"
    r"|\[(?:(?i:insert|your|enter|add|tk|tbd|todo|placeholder)\b[^\[\]\n:;.,!?|/]*|(?i:first|last|full|speaker|company|recipient|author) name|(?i:[^\[\]\n:;.,!?|/]*\bhere))\]"
    r"|<(?:[A-Z]{2,}(?:[ _][A-Z]{2,})*|(?i:insert|your|enter|placeholder)\b[^<>\n:;.,!?|/]*)>"
    r"|[XY]{2}[/.-][XY]{2}[/.-](?:20)?[XY]{2,4}"
    r"|undefined(?:\s+undefined|\s+NaN)|NaN/NaN"
)
#: Messages and fillers that give a short record away (fixed values), by what to look for first, as that is cheap.
MESSAGES = re.compile(
    r"page (?:was )?not found|\b[45]\d\d (?:not found|forbidden|bad gateway|internal server error|service unavailable)|forbidden|bad gateway|gateway time-?out"
    r"|traceback \(most recent call last\)|exception report|database connection|internal (?:server )?(?:error|failure)"
    r"|temporarily unavailable|under maintenance|carry out maintenance|access denied|request blocked|do not have permission|too many requests|rate limited|session has expired"
    r"|something went wrong|not available in your region|no longer exists|seite nicht gefunden|page introuvable|página .{0,20}no existe|upstream did not respond"
    r"|browser is out of date"
    r"|lorem ipsum|dolor sit|(?:blah ){2}|(?:sample text\W+){2}|goes here|placeholder copy|asdf|(?:\btext ){4}|^null$",
    re.I | re.M,
)
SCRIPTS = re.compile(r"(?:enable|requires?|needs?|activate|activer|active|aktivieren sie|support|without) (?:java ?script|scripts|scripting)|scripting (?:appears|turned)|scripts are needed|(?:active|client-side) script|<noscript>", re.I)
CODES = re.compile(r"(?:http|error|erreur|código|code|fehler) ?(?:status )?[45]\d\d\b", re.I)
FAILURES = re.compile(r"(?:could|can|was unable|were unable|failed) ?(?:not|to)? (?:be )?(?:load|open|display|find|retrieve|located?)", re.I)
#: Where a mark may begin, and what every trusted message holds one of, or of each of two; cheap tests before the full patterns.
START = re.compile(r"[{%@$<\[#_uNA-Z](?:(?<=[{%@$<\[#_])|(?<=u)ndefined|(?<=N)aN|(?<=[A-Z])[A-Z][/.-][A-Z])")
BEGIN = "[<{%@$#_"
#: Where each mark begins.
OPENING = re.compile(r"[{<\[$#%@_uNA-Z](?:(?<=[{<\[])|(?<=[$#])\{|(?<=%)[(%]|(?<=@)@|(?<=_)_|(?<=\$)[A-Z_]|(?<=u)ndefined|(?<=N)aN|(?<=[A-Z])[A-Z][/.-][A-Z\d])")
STEMS = (
    "not found|forbidden|bad gateway|gateway time|service unavailable|internal server|internal error|internal failure|traceback|exception report|database connection|temporarily unavailable"
    "|under maintenance|carry out maintenance|access denied|request blocked|do not have permission|too many requests|rate limited|session has expired|something went wrong|not available in"
    "|no longer exists|seite nicht gefunden|page introuvable|no existe|upstream did not|browser is out|lorem ipsum|dolor sit|blah blah|sample text|goes here|placeholder copy|asdf|text text|null"
).split("|")
CODE, FAILED, VERB = (s.split("|") for s in ("http|error|erreur|digo|code|fehler", "could|can|unable|failed", "load|open|display|find|retrieve|locate"))
#: Begins the passage of a mark.
OF_MARK = "\x01"


def holds(text: str, some: list[str]) -> bool:
    for s in some:
        if s in text:
            return True
    return False


def kinds_of(low: str) -> tuple[bool, bool, bool, bool]:
    """Which kinds of trusted messages a text in lower case may hold."""
    return holds(low, STEMS), "script" in low, ("4" in low or "5" in low) and holds(low, CODE), holds(low, VERB) and holds(low, FAILED)


def are_known(text: str, passages: list[str]) -> list[bool]:
    """Whether each of the passages of a text is a trusted message."""
    some = kinds_of(text.lower())
    if not any(some):
        return [False] * len(passages)
    stems, script, code, failure = some
    out = []
    for p in passages:
        low = p.lower()
        out.append(
            bool(
                stems and holds(low, STEMS) and MESSAGES.search(p)
                or script and "script" in low and SCRIPTS.search(p)
                or code and ("4" in low or "5" in low) and holds(low, CODE) and CODES.search(p)
                or failure and holds(low, VERB) and holds(low, FAILED) and FAILURES.search(p)
            )
        )
    return out


def is_known(text: str) -> bool:
    return are_known(text, [text])[0]


def mark_passage(m: str) -> str:
    """A mark by its delimiters, case, number of words and the words."""
    inner = re.sub(r"^\W+|\W+$", "", m) if not m[:2] == "__" else m.strip("_")
    at = m.find(inner) if inner else 0
    words = [w.lower() if not w.isdigit() else "#" for w in re.findall(r"[^\W\d_]+|\d+", inner)]
    case = "none" if inner.upper() == inner.lower() else "upper" if inner == inner.upper() else "lower" if inner == inner.lower() else "title" if inner.istitle() else "mixed"
    joined = "_" if "_" in inner else "." if re.search(r"\w[.|]\w", inner) else "," if "," in inner else "/" if "/" in inner else "-"
    edges = m[:at] + "~" + m[at + len(inner) :] if inner else m
    edges = re.sub(r"\s+", "", edges)
    return OF_MARK + " ".join([f"d:{edges}", f"d:{edges}:{case}", f"d:{edges}:{joined}", f"d:{edges}:{min(len(words), 4)}", *(f"w:{w}" for w in words)])


def marks_of(text: str) -> list[str]:
    """The marks of a text; sound notes are speech."""
    if not any(c in text for c in BEGIN) and not START.search(text):
        return []
    out, end = [], 0
    for at in OPENING.finditer(text):
        # an opening may hide another one in itself, so all of it is looked through
        for k in range(max(at.start(), end), at.end()):
            if k >= end and (m := MARK.match(text, k)):
                end = m.end()
                if not boilerplate.NOISE.search(m[0]):
                    out.append(m[0])
    return out


def passages_of(text: str) -> list[str]:
    return [p for p in (line.strip() for line in text.split("\n")) if p]


def seeded(text: str, weights: boilerplate.Weights) -> list[tuple[str, int]]:
    """The passages of a record, each with whether it is trusted to be residue."""
    ps = passages_of(text)
    known = are_known(text, ps)
    alone = any(known) and not any(not k and boilerplate.is_sentence(p) and boilerplate.plain(p) not in weights.whole and boilerplate.score(p, weights) > 0 for p, k in zip(ps, known))
    return [(p, int(alone and k)) for p, k in zip(ps, known)] + [(mark_passage(m), int(bool(PLACEHOLDER.fullmatch(m)))) for m in marks_of(text)]


class Hashes(dict):
    """Hashes of words, the frequent ones kept."""

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh32_intdigest(word)
        if len(self) < KEPT:
            self[word] = h
        return h


OF_MARKS = Hashes()


def words_of(passages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of lines, end to end, and how many each line has."""
    c, kind = boilerplate.characters([p.lower() for p in passages])
    on = (kind & (boilerplate.LETTERS | boilerplate.DIGITS)) != 0
    first = boilerplate.first_of(on)
    starts = np.flatnonzero(first[on])
    figure = np.logical_or.reduceat((kind[on] & boilerplate.DIGITS) != 0, starts) if len(starts) else None
    return boilerplate.hashed(c[on], starts, figure) & (boilerplate.STOP - 1), boilerplate.by_line(np.flatnonzero(c == 10), np.flatnonzero(first))


def features(passages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and word pairs of each passage, each bucket once, laid
    end to end, and how many each passage has."""
    mark = np.array([p[:1] == OF_MARK for p in passages], bool)
    lines = [words_of(own) for own in boilerplate.some([p for p in passages if p[:1] != OF_MARK])]
    marks = [list(map(OF_MARKS.__getitem__, p[1:].split(" "))) for p in passages if p[:1] == OF_MARK]
    keys = []
    for first, n, where, own in (
        (0, LINES, ~mark, lines),
        (LINES, MARKS, mark, [(np.array([h for x in marks for h in x], np.int64), np.array(list(map(len, marks)), np.int64))]),
    ):
        if not own or not where.any():
            continue
        h, row = np.concatenate([x for x, _ in own]).astype(np.uint64), np.repeat(np.flatnonzero(where), np.concatenate([x for _, x in own]))
        both = row[1:] == row[:-1]
        pair = (h[:-1] * np.uint64(0x9E3779B1) + h[1:])[both]
        pair ^= pair >> np.uint64(29)
        keys.append(np.concatenate([row, row[1:][both]]) * BUCKETS + first + (np.concatenate([h, pair]) & np.uint64(n - 1)).astype(np.int64))
    at = np.sort(np.concatenate(keys)) if keys else np.empty(0, np.int64)
    first = np.ones(len(at), bool)
    first[1:] = at[1:] != at[:-1]
    at = at[first]
    return (at % BUCKETS).astype(np.int32), np.bincount(at // BUCKETS, minlength=len(passages))


#: Passages, a batch in each row: whether trusted, how often they stand, and their features end to end with the number of each.
PASSAGES = "seed binary, n binary, f binary, sizes binary"


def packed_passages(rows: DataFrame, text: str, weights: boilerplate.Weights) -> DataFrame:
    """All distinct passages with their hashed features, as a written table; see PASSAGES."""
    sent = rows.sparkSession.sparkContext.broadcast(weights)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for whole in batches for x in boilerplate.parts(whole)):
            own = [x for t in b.column("t").to_pylist() for x in seeded(t, sent.value)]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in own], pa.string()), pa.array([s for _, s in own], pa.int32())], ["p", "seed"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for whole in batches for x in boilerplate.parts(whole, "p")):
            f, sizes = features(b.column("p").to_pylist())
            yield packed(seed=b.column("seed").to_numpy().astype(np.int8), n=b.column("n").to_numpy(), f=f, sizes=sizes.astype(np.int32))

    own = rows.select(F.col(text).alias("t")).where("t IS NOT NULL").mapInArrow(split, "p string, seed int")
    return cut(own.groupBy("p").agg(F.max("seed").alias("seed"), F.count(F.lit(1)).alias("n")).mapInArrow(hashed, PASSAGES), "passages")


def passages_in(row: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features, the number of each passage, whether it is trusted, how often it stands."""
    f, sizes, seed, n = (unpacked(row, c, kind) for c, kind in (("f", np.int32), ("sizes", np.int32), ("seed", np.int8), ("n", np.int64)))
    return f, sizes.astype(np.int64), seed == 1, n


def passage_table(rows: DataFrame, text: str, weights: boilerplate.Weights) -> DataFrame:
    """(seed, n, f): all distinct passages with their hashed features; ``seed``
    is 1 for trusted ones."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in boilerplate.each(batches):
            f, sizes, seed, n = passages_in(b)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(f))
            yield pa.RecordBatch.from_arrays([pa.array(seed.astype(np.int32)), pa.array(n), lists], ["seed", "n", "f"])

    return packed_passages(rows, text, weights).mapInArrow(unpack, "seed int, n long, f array<int>")


def of_marks(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """1 for the passages that are marks, by their first feature, else 0."""
    first = np.minimum(np.cumsum(sizes) - sizes, max(len(flat) - 1, 0))
    return ((flat[first] >= LINES) & (sizes > 0)).astype(int) if len(flat) else np.zeros(len(sizes), int)


def expected(flat: np.ndarray, sizes: np.ndarray, seed: np.ndarray, n: np.ndarray, model: np.ndarray | None) -> np.ndarray:
    """(2, BUCKETS + 2): expected counts of features in residue and in clean
    passages, and in the last columns of lines and of marks."""
    post = seed.astype(float)
    if model is not None:
        post = np.where(seed, 1.0, UNLABELLED * posterior(flat, sizes, model))
    weight = np.log1p(n)  # a line on every page is one text, not thousands
    kind = of_marks(flat, sizes)
    total = np.zeros((2, BUCKETS + 2))
    for k, share in enumerate((post, np.where(seed, 0.0, 1.0 - post))):
        total[k, :BUCKETS] = np.bincount(flat, np.repeat(share * weight, sizes), BUCKETS)
        total[k, BUCKETS:] = np.bincount(kind, share * weight, 2)
    return total


def maximized(count: np.ndarray) -> np.ndarray:
    """(3, BUCKETS + 2): log likelihoods of features, of residue and of clean
    passages, and in the last columns the log priors of lines and of marks; below
    them the counts in residue."""
    out = np.zeros((3, BUCKETS + 2))
    for k, (a, z) in enumerate(((0, LINES), (LINES, BUCKETS))):
        own = count[:, a:z]
        out[:2, a:z] = np.log(own + SMOOTH) - np.log(own.sum(1, keepdims=True) + SMOOTH * (z - a))
        out[2, a:z] = own[0]
        # where text should be, residue is never rarer than LEAST
        p = max(LEAST, (count[0, BUCKETS + k] + 1) / (count[:, BUCKETS + k].sum() + 2))
        out[:2, BUCKETS + k] = np.log([p, 1 - p])
    return out.astype(np.float32)


def learn(passages: DataFrame, still: float = STILL, steps: int = STEPS) -> np.ndarray:
    """Fit the model on all of ``passages``, as :func:`packed_passages` gives them, step by step until it stands still."""
    spark = passages.sparkSession
    model, mass = None, None
    for _ in range(steps):
        sent = spark.sparkContext.broadcast(model)

        def sums(batches: Iterator[pa.RecordBatch], sent=sent) -> list[np.ndarray]:
            total = np.zeros((2, BUCKETS + 2))
            for b in boilerplate.each(batches):
                total += expected(*passages_in(b), sent.value)
            return [total]

        (count,) = added(passages, sums, [BUCKETS + 2])
        model = maximized(count)
        if mass is not None and abs(count[0, BUCKETS:].sum() - mass) <= still * max(mass, 1.0):
            break
        mass = count[0, BUCKETS:].sum() if mass is not None else -1.0
    else:
        warnings.warn(f"the residue model still moves after {steps} steps", stacklevel=2)
    return model


def posterior(flat: np.ndarray, sizes: np.ndarray, model: np.ndarray, seed: np.ndarray | None = None) -> np.ndarray:
    """Probability that each passage is residue, by its features. Those that
    ``seed`` marks were trusted themselves: part of what they alone taught is left out."""
    odds = (model[0] - model[1]).astype(np.float64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    s = np.bincount(row, odds[flat], len(sizes)) + odds[BUCKETS + of_marks(flat, sizes)]
    if seed is not None:
        own = model[2][flat].astype(np.float64)
        s += np.where(seed, np.bincount(row, np.log(np.maximum(own - LEFT_OUT * np.log(2.0), 0) + SMOOTH) - np.log(own + SMOOTH), len(sizes)), 0.0)
    return 1 / (1 + np.exp(-np.clip(s, -50, 50)))


def lines_residue(ps: list[str], model: np.ndarray) -> np.ndarray:
    return posterior(*features(ps), model, np.array([is_known(p) for p in ps], bool))


def decided(texts: list[str], model: np.ndarray, weights: boilerplate.Weights) -> list[tuple[bool, str, float]]:
    """(is residue, kind, deciding score) of each record: kind 'placeholder', 'message' or ''."""
    out: list[tuple[bool, str, float] | None] = [None] * len(texts)
    # a mark that the page model knows whole is furniture set like a link
    own = [(k, mark_passage(m)) for k, t in enumerate(texts) for m in marks_of(t) if boilerplate.plain(m) not in weights.whole]
    top: dict[int, float] = {}
    for (k, _), s in zip(own, posterior(*features([m for _, m in own]), model).tolist() if own else []):
        top[k] = max(s, top.get(k, 0.0))
    for k, s in top.items():
        if s >= THRESHOLD:
            out[k] = True, "placeholder", s
    # running text that is no residue itself settles the matter; the shortest such passage is the cheapest to judge
    ps = {k: passages_of(t) for k, t in enumerate(texts) if out[k] is None}
    left = {k: filter(boilerplate.is_sentence, sorted(p, key=len)) for k, p in ps.items()}
    many = 1
    while left:
        own = {k: list(islice(rest, many)) for k, rest in left.items()}
        now = [(k, p) for k, some in own.items() for p in some]
        on = boilerplate.line_scores(boilerplate.Taken.of([p for _, p in now]), weights) > 0
        now = [x for x, s in zip(now, on) if s]
        for (k, _), s in zip(now, lines_residue([p for _, p in now], model).tolist() if now else []):
            if s < THRESHOLD and out[k] is None:
                out[k] = False, "", s
        left = {k: rest for k, rest in left.items() if out[k] is None and len(own[k]) == many}
        many *= 2
    # what the page model knows whole, furniture or a phrase of an event, stands beside any text
    rest = [(k, p) for k, own in ps.items() if out[k] is None for p in own if boilerplate.plain(p) not in weights.whole]
    top = {}
    for (k, _), s in zip(rest, lines_residue([p for _, p in rest], model).tolist() if rest else []):
        top[k] = max(s, top.get(k, 0.0))
    return [o or (top.get(k, 0.0) >= THRESHOLD, "message" if top.get(k, 0.0) >= THRESHOLD else "", top.get(k, 0.0)) for k, o in enumerate(out)]


def score_records(rows: DataFrame, rec: Column, text: str, model: np.ndarray, weights: boilerplate.Weights) -> DataFrame:
    """(rec, is_residue, kind, score) of each distinct record. Null, blank or
    merely short text is no residue."""
    sent = rows.sparkSession.sparkContext.broadcast((model, weights))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, w = sent.value
        for b in batches:
            got = [x for k in range(0, len(b), boilerplate.SLICE) for x in decided([t if isinstance(t, str) else "" for t in b["text"].iloc[k : k + boilerplate.SLICE]], m, w)]
            yield frame(rec=list(b["rec"]), is_residue=np.array([g[0] for g in got], bool), kind=[g[1] for g in got], score=np.array([g[2] for g in got]))

    own = rows.select(rec.cast("string").alias("rec"), F.col(text).alias("text")).where("rec IS NOT NULL")
    return own.mapInPandas(run, "rec string, is_residue boolean, kind string, score double").distinct()


def residue(rows: DataFrame, rec: Column, text: str, taken: DataFrame | None = None) -> DataFrame:
    """Learn from ``rows`` and score them; see :func:`score_records`. ``taken``
    are the same rows taken apart as pages, where they are at hand. An empty
    table gives no rows; without any trusted passage nothing is residue."""
    weights = boilerplate.learn(rows, text) if taken is None else boilerplate.learn_taken(taken)
    return score_records(rows, rec, text, learn(packed_passages(rows, text, weights)), weights)
