"""Variant spellings of the names of people and organisations.

Every string is rewritten to canonical forms by rules: case, accents, spacing,
titles, token order, middle initials, nicknames, legal forms and other
abbreviated words, leading articles, initials, acronyms, surnames alone, dropped
legal forms, and any one letter missing, added, changed or swapped. Strings with
the same full canonical form are one group. The weaker forms of a group (what
is left after a lossy rewriting) are exploded into keys and joined with the keys
of full groups. A match is scored by the rarity of its rewriting, in bits: minus
the binary logarithm of the number of entities that can be rewritten to the
same key, less what a slip of one letter costs. The best entity is linked if it
is better than any other; a form that several share equally links none.

Groups that are one letter apart are linked only if one of them looks like the
slip, that is if it comes in one spelling only; two names that each come in
several renderings are two names. Slips of slips follow to the end of the chain:
entities are connected components, whatever their length.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commgraph.llm.frames import frame
from commgraph.operators.components import connected_components
from commgraph.runtime import cut

#: Bits that a slip of one letter costs: a name has about this many neighbours one letter away, as a power of two.
SLIP_BITS = 9.0

# --- fixed values ---------------------------------------------------------------------------
TITLES = frozenset("gov sen rep prof dr amb chair mr mrs ms miss sir dame lord lady governor senator representative professor doctor ambassador minister president secretary judge justice mayor hon rev gen col capt lt".split())
#: Short forms of given names, each with the full names it may stand for.
NICKNAMES = {
    "tom": "thomas", "tommy": "thomas", "ted": "theodore edward", "teddy": "theodore edward", "theo": "theodore", "kathy": "katherine", "kate": "katherine", "katie": "katherine", "kit": "katherine christopher",
    "hank": "henry", "harry": "henry harold", "peggy": "margaret", "maggie": "margaret", "meg": "margaret", "dot": "dorothy", "dottie": "dorothy", "dolly": "dorothy", "fred": "frederick", "freddy": "frederick", "freddie": "frederick",
    "alex": "alexander alexandra", "sasha": "alexander alexandra", "sandy": "alexander alexandra", "xander": "alexander", "trish": "patricia", "pat": "patricia patrick", "patty": "patricia", "tricia": "patricia", "becky": "rebecca", "becca": "rebecca",
    "jenny": "jennifer", "jen": "jennifer", "jackie": "jacqueline", "ben": "benjamin", "benny": "benjamin", "will": "william", "bill": "william", "billy": "william", "willy": "william", "liam": "william", "leo": "leonard leopold", "len": "leonard", "lenny": "leonard",
    "abby": "abigail", "gail": "abigail", "pam": "pamela", "chris": "christopher christine christina", "topher": "christopher", "rob": "robert", "bob": "robert", "bobby": "robert", "bert": "robert albert", "dan": "daniel", "danny": "daniel", "nick": "nicholas", "nicky": "nicholas",
    "andy": "andrew", "drew": "andrew", "greg": "gregory", "steve": "stephen steven", "sam": "samuel samantha", "sammy": "samuel", "liz": "elizabeth", "beth": "elizabeth", "betty": "elizabeth", "eliza": "elizabeth", "lizzie": "elizabeth", "betsy": "elizabeth", "vicky": "victoria", "tori": "victoria", "larry": "lawrence",
    "chuck": "charles", "charlie": "charles", "chaz": "charles", "mike": "michael", "mick": "michael", "mickey": "michael", "rick": "richard", "dick": "richard", "rich": "richard", "richie": "richard", "ed": "edward edwin", "eddie": "edward", "ned": "edward", "phil": "philip", "pip": "philip",
    "deb": "deborah", "debbie": "deborah", "debby": "deborah", "sue": "susan", "susie": "susan", "suzy": "susan", "tony": "anthony", "joe": "joseph", "joey": "joseph", "jo": "joseph josephine", "dave": "david", "davy": "david", "tim": "timothy", "timmy": "timothy", "jim": "james", "jimmy": "james", "jamie": "james",
    "jack": "john", "johnny": "john", "matt": "matthew", "bella": "isabella", "izzy": "isabella", "belle": "isabella", "ellie": "eleanor", "nell": "eleanor", "nora": "eleanor", "lena": "helena", "marc": "marcus", "mark": "marcus", "cathy": "catherine", "kim": "kimberly", "ron": "ronald", "don": "donald", "ken": "kenneth", "gabe": "gabriel", "nate": "nathaniel nathan", "zach": "zachary", "josh": "joshua", "jon": "jonathan", "pete": "peter", "vic": "victor victoria", "walt": "walter", "ray": "raymond", "gus": "augustus gustav", "barb": "barbara", "cindy": "cynthia", "mandy": "amanda", "nan": "nancy ann", "sally": "sarah", "pepe": "jose", "paco": "francisco", "pancho": "francisco", "nacho": "ignacio", "lola": "dolores", "terry": "terence theresa", "ursa": "ursula", "naomie": "naomi",
}
#: Abbreviated words of organisations' names.
WORDS = {
    "assn": "association", "assoc": "association", "dept": "department", "dep": "department", "u": "university", "univ": "university", "uni": "university", "bk": "bank", "intl": "international", "int'l": "international", "natl": "national", "nat'l": "national",
    "corp": "corporation", "co": "company", "cncl": "council", "inst": "institute", "ltd": "limited", "fdn": "foundation", "found": "foundation", "agcy": "agency", "hldgs": "holdings", "min": "ministry", "comm": "committee", "cmte": "committee", "fed": "federal", "govt": "government", "inc": "incorporated", "soc": "society", "ctr": "center", "centre": "center",
}
STOP = frozenset("the of for and in on a".split())
#: Words that say what kind of body it is, which may be left out.
LEGAL = frozenset("corporation limited plc incorporated company llc gmbh ag sa holdings group association foundation council institute agency party".split())
ADDED = frozenset("plc llc gmbh inc incorporated".split())
BODIES = frozenset("association department university bank international national corporation company council institute limited foundation agency holdings ministry committee society center party board union commission office bureau federation league plc llc".split())
# --------------------------------------------------------------------------------------------


def fold(s: str) -> str:
    s = unicodedata.normalize("NFKD", s.replace("ø", "o").replace("Ø", "O").replace("ß", "ss").replace("æ", "ae").replace("Æ", "Ae").replace("ł", "l").replace("đ", "d"))
    return " ".join("".join(c for c in s if not unicodedata.combining(c)).lower().replace("’", "'").split())


def parse(name: str) -> tuple[str, tuple[str, ...]] | None:
    """(kind, tokens): 'F' a full form, tokens sorted; 'N' (short given name with
    several meanings, surname); 'I' (initial, surname); 'S' (surname,); 'A'
    (letters,). None where nothing is left."""
    s = re.sub(r"\s*\([^()]*\)\s*$", "", fold(name)) or fold(name)
    if not s:
        return None
    if re.fullmatch(r"(?:[a-z]\.?){2,7}", s) and (name.upper() == name or "." in name) and (s.count(".") > 1 or "." not in s) and len(s.replace(".", "")) > 1 and name.upper() == name:
        return "A", (s.replace(".", ""),)
    comma = s.count(",") == 1
    s2 = re.sub(r"[&+/]", " and ", s)
    words = [w.strip(".,;:()\"") for w in re.split(r"[\s,]+|(?<=\w)-(?=\w)", s2)]
    words = [w for w in words if w]
    dotted = [w for w in re.split(r"[\s,]+", s2) if w]
    expanded = [WORDS.get(w, w) for w in words]
    # a single letter is a word of an organisation's name only beside others of its kind
    org = any(x in BODIES and len(w) > 1 for w, x in zip(words, expanded)) or any(w in STOP - {"a"} for w in words) or any(w[:1].isdigit() for w in words)
    if org:
        bag = tuple(sorted(w for w in expanded if w not in STOP and w not in ADDED))
        return ("F", bag) if bag else None
    # a person
    if comma:
        last, _, rest = s.partition(",")
        parts, surname_first = [*rest.split(), *last.split()], True
    else:
        parts, surname_first = dotted, False
    raw = [p.strip(",;:()\"") for p in parts]
    while len(raw) > 1 and raw[0].rstrip(".") in TITLES:
        raw = raw[1:]
    initials = [p for p in raw if re.fullmatch(r"[^\W\d_]\.?", p)]
    full = [p.rstrip(".") for p in raw if p not in initials]
    joined = [p for p in full if len(p) == 2 and len(full) == 2 and re.search(rf"(?<!\w){re.escape(p.upper())}(?!\w)", unicodedata.normalize("NFC", name)) and not re.search("[aeiouy]", p)] or ([full[0]] if len(full) == 2 and len(full[0]) == 2 and name[:2].isupper() and not name.isupper() else [])
    if joined:
        return "I", (joined[0][0], next(p for p in full if p != joined[0]))
    full = [NICKNAMES[p] if p in NICKNAMES and " " not in NICKNAMES[p] and len(full) > 1 else p for p in full]
    if not full:
        return None
    if len(full) == 1:
        return ("I", (initials[0][0], full[0])) if initials else ("S", (full[0],))
    if len(full) == 2 and sum(p in NICKNAMES for p in full) == 1:  # a short name of several meanings
        nick = next(p for p in full if p in NICKNAMES)
        return "N", (nick, next(p for p in full if p != nick))
    return "F", tuple(sorted(full))


def near(a: str, b: str) -> bool:
    """One insertion, deletion, substitution or swap apart, or equal."""
    if a == b:
        return True
    if len(a) > len(b):
        a, b = b, a
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    if len(a) == len(b):
        return a[k + 1 :] == b[k + 1 :] or (a[k : k + 2] == b[k : k + 2][::-1] and a[k + 2 :] == b[k + 2 :])
    return len(b) - len(a) == 1 and a[k:] == b[k + 1 :]


def deletions(w: str) -> set[str]:
    return {w} | {w[:k] + w[k + 1 :] for k in range(len(w))} if len(w) > 3 else {w}


def slips(tokens: tuple[str, ...]) -> Iterator[tuple[str, str]]:
    """(key, token): the other tokens with each deletion of this one."""
    for k, w in enumerate(tokens):
        rest = " ".join(tokens[:k] + tokens[k + 1 :])
        for d in deletions(w):
            yield f"{rest}|{d}", w


def strong_keys(tokens: tuple[str, ...], ordered: tuple[str, ...]) -> Iterator[tuple[str, int]]:
    """(key, cost) of weaker forms that a full form can be rewritten to."""
    if len(tokens) == 2 and not any(t in BODIES for t in tokens):
        for a, b in (tokens, tokens[::-1]):
            for d in deletions(b):
                cost = 0 if d == b else 1
                yield f"I|{a[0]}|{d}", cost
                yield f"S|{d}", cost
            # a short given name that may stand for this one
        for k, w in enumerate(tokens):
            for nick in FORMAL.get(w, ()):
                for d in deletions(tokens[1 - k]):
                    yield f"N|{nick}|{d}", int(d != tokens[1 - k])
        yield f"J|{''.join(ordered)}", 0
    elif any(t in BODIES for t in tokens) and len(tokens) > 2:
        for w in tokens:
            if w in LEGAL:
                yield "D|" + " ".join(t for t in tokens if t != w), 0
        letters = "".join(w[0] for w in ordered if w)
        if len(letters) > 2:
            yield f"A|{letters}", 0


FORMAL: dict[str, list[str]] = {}
for _n, _f in NICKNAMES.items():
    if " " in _f:
        for _x in _f.split():
            FORMAL.setdefault(_x, []).append(_n)


def ordered_tokens(name: str) -> tuple[str, ...]:
    words = [w.strip(".,;:()\"") for w in re.split(r"[\s,]+|(?<=\w)-(?=\w)", re.sub(r"[&+/]", " and ", fold(name)))]
    return tuple(w for w in (WORDS.get(w, w) for w in words) if w and w not in STOP and w not in ADDED)


def rooted_by(groups: DataFrame, edges: DataFrame) -> DataFrame:
    """``groups`` with ``root``: the best known base, by spellings, then by count, of
    all that ``edges`` (base, to) connect; without an edge a base is its own."""
    parts = cut(connected_components(edges, "base", "to").withColumnRenamed("node", "base").withColumnRenamed("root", "part"), "parts")
    best = F.max(F.struct((F.col("kind") == "F").alias("f"), "spellings", "n", "base")).alias("best")
    tops = groups.join(parts, "base").groupBy("part").agg(best).select("part", F.col("best.base").alias("root"))
    return groups.drop("root").join(parts.join(tops, "part").select("base", "root"), "base", "left").withColumn("root", F.coalesce("root", "base"))


def link_names(names: DataFrame, name: str) -> DataFrame:
    """(name, entity, n): each distinct string with the group it names; ``entity``
    is the canonical form of the group's most frequent full form. Strings of
    marks only, which no rule can read, name themselves.

    Nulls and blank strings are left out. Strings count as often as they stand;
    an empty table gives no rows. Extra columns don't matter.
    """
    counted = names.select(F.col(name).alias("name")).where("name IS NOT NULL AND trim(name) != ''").groupBy("name").agg(F.count(F.lit(1)).alias("n"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for x, n in zip(b["name"], b["n"]):
                p = parse(x)
                kind, tokens = p or ("X", (x,))
                out.append((x, n, kind, kind + "|" + "|".join(tokens), " ".join(ordered_tokens(x))))
            c = list(zip(*out)) if out else [[]] * 5
            yield frame(name=list(c[0]), n=np.array(c[1], np.int64), kind=list(c[2]), base=list(c[3]), words=list(c[4]))

    read_names = cut(counted.mapInPandas(read, "name string, n long, kind string, base string, words string"), "names")
    best = Window.partitionBy("base").orderBy(F.desc("n"), "name")
    groups = cut(
        read_names.withColumn("k", F.row_number().over(best))
        .groupBy("base")
        .agg(F.first("kind").alias("kind"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("spellings"), F.max(F.when(F.col("k") == 1, F.col("words"))).alias("words")),
        "groups",
    )
    full = groups.where("kind = 'F'")

    # slips: one token of a full form one letter off
    def slip_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(k, w, base, n, s) for base, n, s in zip(b["base"], b["n"], b["spellings"]) for k, w in slips(tuple(base.split("|")[1:]))]
            c = list(zip(*out)) if out else [[]] * 5
            yield frame(key=list(c[0]), token=list(c[1]), base=list(c[2]), n=np.array(c[3], np.int64), spellings=np.array(c[4], np.int64))

    keys = full.mapInPandas(slip_keys, "key string, token string, base string, n long, spellings long")
    x, y = keys.alias("x"), keys.alias("y")
    close = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.base") != F.col("y.base")) & ((F.col("x.spellings") < F.col("y.spellings")) | ((F.col("x.spellings") == F.col("y.spellings")) & (F.struct("x.n", "x.base") < F.struct("y.n", "y.base"))))).where("x.spellings = 1")
    apart = F.pandas_udf(lambda a, b: pd.Series([near(p, q) for p, q in zip(a, b)], dtype="bool"), "boolean")
    close = close.select(F.col("x.base").alias("base"), F.col("y.base").alias("to"), F.col("x.token").alias("p"), F.col("y.token").alias("q"), F.col("y.spellings").alias("s"), F.col("y.n").alias("m")).distinct().where(apart("p", "q"))
    top = Window.partitionBy("base").orderBy(F.desc("s"), F.desc("m"), "to")
    step = cut(close.withColumn("k", F.row_number().over(top)).where("k = 1").select("base", "to"), "slips")
    rooted = cut(rooted_by(groups, step), "rooted")

    # weaker forms: joined with what the full forms can be rewritten to
    def offers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(k, c, r, base) for base, r, w in zip(b["base"], b["root"], b["words"]) for k, c in strong_keys(tuple(base.split("|")[1:]), tuple(w.split()))]
            c = list(zip(*out)) if out else [[]] * 4
            yield frame(key=list(c[0]), cost=np.array(c[1], np.int32), root=list(c[2]), of=list(c[3]))

    def asks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for base, kind, w in zip(b["base"], b["kind"], b["words"]):
                t = base.split("|")[1:]
                if kind == "X":
                    continue
                if kind == "A":
                    out.append((f"A|{t[0]}", 0, base))
                elif kind == "S":
                    out += [(f"S|{d}", int(d != t[0]), base) for d in deletions(t[0])]
                elif kind in "IN":
                    out += [(f"{kind}|{t[0]}|{d}", int(d != t[1]), base) for d in deletions(t[1])]
                else:
                    out += [(f"D|{' '.join(t)}", 0, base), (f"J|{''.join(w.split())}", 0, base)]
            c = list(zip(*out)) if out else [[]] * 3
            yield frame(key=list(c[0]), own=np.array(c[1], np.int32), base=list(c[2]))

    given = cut(rooted.where("kind = 'F'").select("base", "root", "words").mapInPandas(offers, "key string, cost int, root string, of string").distinct(), "offers")
    shared = given.groupBy("key").agg(F.countDistinct("root").alias("sharing"))
    wanted = rooted.where("base = root").select("base", "kind", "words").mapInPandas(asks, "key string, own int, base string")
    met = wanted.join(given, "key").where("root != base").withColumn("slip", F.greatest("own", "cost"))
    # a slip on both sides still has to be one slip apart, not two
    last = F.element_at(F.split("base", r"\|"), -1)
    toks = F.array_remove(F.split("of", r"\|"), "F")
    close = F.pandas_udf(lambda w, ts: pd.Series([any(near(p, t) for t in tt) for p, tt in zip(w, ts)], dtype="bool"), "boolean")
    met = met.where((F.col("slip") == 0) | close(last, toks)).join(shared, "key")
    scored = met.groupBy("base", "root").agg(F.max(-F.log2(F.col("sharing")) - F.lit(SLIP_BITS) * F.col("slip")).alias("score"))
    best = scored.groupBy("base").agg(F.max("score").alias("score"))
    weak = scored.join(best, ["base", "score"]).groupBy("base").agg(F.min("root").alias("to"), F.max("root").alias("other")).where("to = other").select("base", "to")
    entity = rooted_by(rooted, cut(rooted.where("base != root").select("base", F.col("root").alias("to")).unionByName(weak), "links")).select("base", F.col("root").alias("entity"))
    return read_names.join(entity, "base").select("name", "entity", "n")


def variant_pairs(names: DataFrame, name: str) -> DataFrame:
    """(name_a, name_b), name_a < name_b in code point order, of strings that name the same entity."""
    links = cut(link_names(names, name).select("name", "entity"), "entities")
    a, b = links.alias("a"), links.alias("b")
    return a.join(b, (F.col("a.entity") == F.col("b.entity")) & (F.col("a.name") < F.col("b.name"))).select(F.col("a.name").alias("name_a"), F.col("b.name").alias("name_b")).distinct()


def union_of(*columns: DataFrame) -> DataFrame:
    """One column of names from several."""
    return reduce(DataFrame.unionAll, columns)
