"""Speech transcripts into clean speaker turns.

A parsing-expression grammar reads the layouts in which transcripts come: labels
in brackets, before a colon or a dash, after chevrons, with a time before or
behind them, or on a line of their own below a time; nested annotations; filler
words; stammered repetitions. The parse tree of a text becomes segments, each a
label, a time where it has one, and its cleaned speech.

What a label means is settled by joins, not in the parser: a label is a role
(host, question, ...) or names a person of the registry, in full, with a title,
an initial or the surname alone, in any case, the surname first, with a remark
in brackets, or misspelt by one letter. Labels and registry names are exploded
into keys, all deletions of one letter included, and joined on them. Of several
people a label could mean, the one named in full in the same text is meant, else
the one the record is filed under, else the only one there is. Anything else
before a colon or in brackets is speech or a note.

Where every segment of a text bears a time, the times give the order. A turn is
a longest run of speech by one speaker in that order.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commgraph.llm.frames import frame
from commgraph.llm.peg import first, later, many, maybe, rule, seq, switch, term
from commgraph.runtime import cut

#: Labels that name a role, titles before a surname, words of notes on sound, filler words (fixed values).
ROLES = frozenset(
    ["host", "moderator", "question", "reporter", "interpreter", "audience member", "audience", "speaker", "questioner", "answer", "interviewer"]
    + ["narrator", "operator", "translator", "chair", "presenter", "anchor", "announcer", "caller", "guest", "panelist", "journalist"]
)
TITLES = frozenset("gov sen rep prof dr amb chair mr mrs ms miss sir dame lord lady governor senator representative professor doctor ambassador minister president secretary judge justice mayor chairman chairwoman chairperson congressman congresswoman hon rev gen col capt lt pres sec".split())
SOUNDS = re.compile(r"\b(?:applause|laughter|laughs?|laughing|cheers?|cheering|crosstalk|cross talk|inaudible|unintelligible|indiscernible|music|coughs?|coughing|bell|no audio|silence|pause|audio|video|booing|sighs?|gavel|noise)\b", re.I)
FILLERS = r"uh-huh|mm-hmm|you know|i mean|sort of|kind of|uh+|um+|erm*|hmm+|mhm|ah|like(?=,)"
#: Fillers begin with few letters; looking at those first is what makes the search fast.
FILLER = re.compile(rf"\b(?=[aehiklmsuy])(?:{FILLERS})\b,?[ \t]*", re.I)
STAMMER = re.compile(r"\b([\w'’-]+(?: [\w'’-]+){0,2}) -- (?=\1\b)", re.I)

TIME = r"(?:\d{1,2}:)?\d{1,3}:\d{2}(?:[.,]\d{1,3})?"
ANY_TIME = rf"(?:\[{TIME}\]|\({TIME}\)|{TIME})"
NAME = r"[^\W\d_][\w.'’\-]*(?:,? [^\W\d_][\w.'’\-]*){0,4}(?: \([^()\n]+\))?"

# --- grammar -----------------------------------------------------------------
time = rule("time", term(ANY_TIME))
name = rule("name", term(NAME))
gap = term(r"[ \t]*")
line_end = term(r"[ \t]*(?:\r\n|\n|\r|\Z)")
chevrons = maybe(term(r">>+[ \t]*"))
stop = term(r"[ \t]*:(?=\s|\Z)")
boxed = rule("label", seq(term(r"\["), gap, name, gap, maybe(time), term(r"[ \t]*\](?:[ \t]*:(?=\s|\Z))?")))
colon = rule("label", seq(chevrons, maybe(seq(time, gap)), name, gap, maybe(time), stop))
dash = rule("label", seq(chevrons, maybe(seq(time, gap)), name, gap, maybe(time), term(r"[ \t]*[—–][ \t]+")))
below = rule("label", seq(chevrons, time, gap, name, line_end))
timed_box = rule("label", seq(time, gap, term(r"\["), name, term(r"\][ \t]*:?")))
label_line = first(below, colon, dash, timed_box)

note = later(lambda: first(*NOTES))


def bracket(a: str, b: str) -> object:
    """A note in brackets, which may hold others."""
    inner = many(first(note, term(rf"[^\n{re.escape(a + b)}\[\](){{}}]+")))
    return rule("note", seq(term(re.escape(a)), inner, term(re.escape(b))))


NOTES = (
    bracket("(", ")"),
    bracket("[", "]"),
    rule("note", term(r"<<?[^<>\s](?:[^<>\n]*[^<>\s])?>>?")),
    rule("note", term(r"♪[^♪\n]*♪")),
    rule("note", term(r"\*[^*\s](?:[^*\n]*[^*\s])?\*")),
)
speech = rule("speech", term(r"[^\[\](){}<>♪*\n\r]+|[^\n\r]"))
newline = rule("newline", term(r"[ \t]*(?:\r\n|\n|\r)[ \t]*"))
item = switch({"[": first(boxed, note), "(": note, "<": note, "♪": note, "*": note, "": first()}, speech)
line = seq(gap, maybe(label_line), many(item), maybe(newline))
text_rule = many(line)


def seconds(t: str) -> float:
    parts = re.findall(r"\d+(?:[.,]\d+)?", t)
    total = 0.0
    for p in parts:
        total = total * 60 + float(p.replace(",", "."))
    return total


def fold(s: str) -> str:
    s = unicodedata.normalize("NFKD", s.replace("ø", "o").replace("Ø", "O").replace("ß", "ss").replace("æ", "ae").replace("ł", "l"))
    return " ".join("".join(c for c in s if not unicodedata.combining(c)).lower().split())


def role_of(label: str) -> str | None:
    s = " ".join(label.lower().split())
    s = s.removeprefix("the ")
    return s if s in ROLES else None


def clean(said: str) -> str:
    """Speech without fillers and stammered repetitions, its white space single."""
    said = FILLER.sub("", said)
    if " -- " in said:
        said = STAMMER.sub("", said)
    return " ".join(said.split())


def segments(text: str) -> list[tuple[str | None, float | None, str]]:
    """(label, seconds, speech) of each stretch after a label; what comes before
    the first has none. Notes, times, fillers and stammers are left out."""
    _, tree = text_rule(text, 0)
    out: list[list] = [[None, None, []]]
    for kind, a, b, children in tree:
        if kind == "label":
            n = next(text[x:y] for k, x, y, _ in children if k == "name")
            if SOUNDS.search(n) and role_of(n) is None:
                continue
            t = next((seconds(text[x:y]) for k, x, y, _ in children if k == "time"), None)
            out.append([n, t, []])
        elif kind == "speech":
            out[-1][2].append(text[a:b])
        elif kind == "newline":
            out[-1][2].append(" ")
        elif kind == "note":
            out[-1][2].append(" ")
    said = ["".join(s) for _, _, s in out]
    return [(n, t, clean(w)) for (n, t, _), w in zip(out, said)]


def label_forms(label: str) -> tuple[str | None, str | None, str] | None:
    """(first, initial, surname) as far as a label has them, folded."""
    s = fold(re.sub(r"\s*\([^()]*\)\s*$", "", label))
    if "," in s:
        last, _, rest = s.partition(",")
        s = f"{rest.strip()} {last.strip()}"
    parts = s.split()
    while len(parts) > 1 and parts[0].rstrip(".") in TITLES:
        parts = parts[1:]
    if not parts or len(parts) > 4:
        return None
    last, given = parts[-1], parts[:-1]
    if not given:
        return None, None, last
    if re.fullmatch(r"[^\W\d_]\.?", given[0]):
        return None, given[0][0], last
    return given[0], given[0][0], last


def deletions(s: str) -> set[str]:
    return {s} | ({s[:k] + s[k + 1 :] for k in range(len(s))} if len(s) > 4 else set())


def near(a: str, b: str) -> int:
    """0 if equal, 1 if one insertion, deletion, substitution or swap apart, else 2."""
    if a == b:
        return 0
    if len(a) > len(b):
        a, b = b, a
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    if len(a) == len(b):
        return 1 if a[k + 1 :] == b[k + 1 :] or (a[k : k + 2] == b[k : k + 2][::-1] and a[k + 2 :] == b[k + 2 :]) else 2
    return 1 if len(b) - len(a) == 1 and a[k:] == b[k + 1 :] else 2


def parsed(rows: DataFrame, rec: Column, text: str, hint: Column | None = None, speech: bool = True) -> DataFrame:
    """(rec, ver, seg, secs, label, role, hint, size, said) for each labelled
    segment of each text; ``ver`` is a digest of the text, which tells two texts
    of one record apart and repeats of one text not. All speech is cleaned, and
    ``size`` is its length then; ``said`` is left null without ``speech``."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r, t, h in zip(b["rec"], b["text"], b["hint"]):
                v = xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63)
                for k, (n, s, said) in enumerate(segments(t)):
                    if n is not None:
                        out.append((r, v, k, s, n, role_of(n), h if isinstance(h, str) else None, len(said), said if speech else None))
                if len(out) > 5000:
                    yield flush(out)
                    out = []
            yield flush(out)

    def flush(out: list) -> pd.DataFrame:
        c = list(zip(*out)) if out else [[]] * 9
        return frame(
            rec=list(c[0]), ver=np.array(c[1], np.int64), seg=np.array(c[2], np.int32), secs=pd.Series(list(c[3]), dtype="float64"), label=list(c[4]), role=list(c[5]), hint=list(c[6]), size=np.array(c[7], np.int32), said=list(c[8])
        )

    own = rows.select(rec.cast("string").alias("rec"), F.col(text).alias("text"), (F.lit(None) if hint is None else hint).cast("string").alias("hint")).where("text IS NOT NULL AND rec IS NOT NULL")
    return own.mapInPandas(parse, "rec string, ver long, seg int, secs double, label string, role string, hint string, size int, said string")


def person_candidates(labels: DataFrame, registry: DataFrame, display: str) -> DataFrame:
    """(label, person, off, whole): people of the registry a label may mean,
    ``off`` letters away, ``whole`` where the label has the first name."""

    def label_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for x in b["label"]:
                f = label_forms(x)
                if f and len(f[2]) > 1:
                    whole = f"{f[0]} {f[2]}" if f[0] else f[2]
                    out += [(k, x, f[0], f[1], f[2]) for k in deletions(whole)]
            c = list(zip(*out)) if out else [[]] * 5
            yield frame(key=list(c[0]), label=list(c[1]), given=list(c[2]), initial=list(c[3]), surname=list(c[4]))

    def name_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for x in b["person"]:
                f = label_forms(x)
                if f:
                    for whole in {f[2], f"{f[0]} {f[2]}" if f[0] else f[2]}:
                        out += [(k, x, f[0], f[2]) for k in deletions(whole)]
            c = list(zip(*out)) if out else [[]] * 4
            yield frame(key=list(c[0]), person=list(c[1]), first=list(c[2]), last=list(c[3]))

    ks = labels.select("label").distinct().mapInPandas(label_keys, "key string, label string, given string, initial string, surname string")
    ns = registry.select(F.col(display).alias("person")).where("person IS NOT NULL").distinct().mapInPandas(name_keys, "key string, person string, first string, last string")

    @F.pandas_udf("int")
    def off(given: pd.Series, surname: pd.Series, first_: pd.Series, last: pd.Series) -> pd.Series:
        return pd.Series([near(f"{g} {s}" if isinstance(g, str) else s, f"{f} {l}" if isinstance(g, str) else l) for g, s, f, l in zip(given, surname, first_, last)], dtype="int32")

    both = ks.join(ns, "key").select("label", "person", "given", "initial", "surname", "first", "last").distinct()
    both = both.where(F.col("given").isNotNull() | F.col("initial").isNull() | (F.col("initial") == F.substring("first", 1, 1)))
    return both.select("label", "person", off("given", "surname", "first", "last").alias("off"), F.col("given").isNotNull().alias("whole")).where("off < 2").groupBy("label", "person").agg(F.min("off").alias("off"), F.max("whole").alias("whole"))


def spoken(parts: DataFrame, registry: DataFrame, display: str = "display_name") -> DataFrame:
    """(rec, ver, seg, secs, speaker, label, size): segments whose label is
    settled, in their place; the others have a null speaker."""
    people = parts.where("role IS NULL").groupBy("rec", "label").agg(F.max("hint").alias("hint"))
    known = cut(person_candidates(people, registry, display), "labels")
    could = people.join(known, "label")
    by = Window.partitionBy("rec", "person")
    could = could.withColumn("named", F.max(F.when(F.col("whole") & (F.col("off") == 0), 1).otherwise(0)).over(by))
    could = could.withColumn("rank", F.when(F.col("whole") & (F.col("off") == 0), 0).when(F.col("named") == 1, 1 + F.col("off")).when(F.col("person") == F.col("hint"), 3 + F.col("off")).otherwise(5 + F.col("off")))
    # the cheapest meaning, if it is the only one of its rank
    best = could.groupBy("rec", "label").agg(F.min(F.struct("rank", "person")).alias("lo"), F.collect_list(F.struct("rank", "person")).alias("all"))
    best = best.where(F.size(F.filter("all", lambda x: x["rank"] == F.col("lo.rank"))) == 1).select("rec", "label", F.col("lo.person").alias("person"))
    return parts.join(best, ["rec", "label"], "left").select("rec", "ver", "seg", "secs", F.coalesce("role", "person").alias("speaker"), "label", "size")


def turns(rows: DataFrame, rec: Column, text: str, registry: DataFrame, hint: Column | None = None, display: str = "display_name", speech: bool = True) -> DataFrame:
    """(rec, turn_no, speaker, said): the turns of each text, from 1 on.

    Null, empty and unlabelled texts have none. Texts are taken once however
    often their row repeats. A label without speech makes no turn. Without
    ``speech`` the words said are cleaned all the same and left out of the result.
    """
    parts = cut(parsed(rows, rec, text, hint, speech), "segments")
    s = spoken(parts.drop("said"), registry, display).dropDuplicates(["rec", "ver", "seg"])
    doc = ["rec", "ver"]
    by = Window.partitionBy(*doc).orderBy("seg")
    # speech after a label that is none goes on with the segment before
    s = s.withColumn("at", F.sum(F.when(F.col("speaker").isNotNull(), 1).otherwise(0)).over(by)).where("at > 0")
    own = F.col("speaker").isNotNull()
    runs = s.groupBy(*doc, "at").agg(F.max("speaker").alias("speaker"), F.max(F.when(own, F.col("secs"))).alias("secs"), F.sum(F.when(own, F.col("size")).otherwise(F.col("size") + 1)).alias("size")).where("size > 0")
    runs = runs.withColumn("timed", F.min(F.when(F.col("secs").isNotNull(), 1).otherwise(0)).over(Window.partitionBy(*doc))).withColumn("order", F.when(F.col("timed") == 1, F.col("secs")).otherwise(F.lit(0.0)))
    inorder = Window.partitionBy(*doc).orderBy("order", "at")
    runs = runs.withColumn("starts", F.when(F.lag("speaker").over(inorder).eqNullSafe(F.col("speaker")), 0).otherwise(1))
    if not speech:
        runs = runs.where("starts = 1")
        return runs.select("rec", F.row_number().over(inorder).cast("int").alias("turn_no"), "speaker", F.lit(None).cast("string").alias("said"))
    # which segment goes where is settled without the words; then each text's words are sent once, to its places
    runs = runs.withColumn("turn_no", F.sum("starts").over(inorder).cast("int")).select(*doc, "at", "speaker", "turn_no", F.row_number().over(inorder).alias("nth"))
    places = s.select(*doc, "at", "seg", F.when(own, F.lit(None)).otherwise(F.col("label")).alias("before")).join(runs, [*doc, "at"])
    none = {"said": "string", "turn_no": "int", "nth": "int", "speaker": "string", "before": "string"}
    columns = [*doc, "seg", *none]
    both = parts.select(*doc, "seg", "said", *[F.lit(None).cast(t).alias(c) for c, t in none.items() if c != "said"]).unionByName(places.withColumn("said", F.lit(None).cast("string")).select(columns))
    each = both.repartition(*doc).groupBy(*doc, "seg").agg(*[F.max(c).alias(c) for c in none]).where("turn_no IS NOT NULL")
    part = F.concat_ws(" ", F.concat("before", F.lit(":")), "said")
    words = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nth", "seg", part.alias("part")))), lambda x: x["part"]), " ")
    return each.groupBy(*doc, "turn_no").agg(F.max("speaker").alias("speaker"), words.alias("said")).select("rec", "turn_no", "speaker", "said")
