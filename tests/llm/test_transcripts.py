from pyspark.sql import functions as F

from commgraph.llm import transcripts as T

PEOPLE = [("Ana Bergström",), ("Carl Dunmore",), ("Eve Dunmore",), ("Frank Grixberg",), (None,)]


def test_parse():
    text = "HEADLINE: x\n[Host 00:10] Well, um, we -- we (laughs (loudly)) go. [inaudible 00:12]\nThree words: yes you know, no.\n(1:02) ANA BERGSTRÖM: Hi [applause] there\n>> C. Dunmore — a\n02:00 Bergström\nlast"
    got = T.segments(text)
    assert [g[0] for g in got] == [None, "HEADLINE", "Host", "Three words", "ANA BERGSTRÖM", "C. Dunmore", "Bergström"]
    assert [g[1] for g in got] == [None, None, 10, None, 62, None, 120]
    assert got[2][2] == "Well, we go." and got[3][2] == "yes no." and got[4][2] == "Hi there"


def test_near():
    assert [T.near("abc", x) for x in ("abc", "abd", "acb", "ab", "abcd", "xyz", "cba")] == [0, 1, 1, 1, 1, 2, 2]


def test_turns(spark):
    people = spark.createDataFrame([(*p, 1) for p in PEOPLE], "display_name string, rec int")
    rows = [
        ("a", "Carl Dunmore: one\nPoint one: two\nDunmore: three\nThe Host: four\n[Grixbreg] five", None),
        ("a", "Carl Dunmore: one\nPoint one: two\nDunmore: three\nThe Host: four\n[Grixbreg] five", None),
        ("b", "[00:20] HOST: second\n[00:05] Gov. Bergstrom: first\n(00:30) host: third", None),
        ("c", "[00:20] HOST: second\nBergström, Ana (D): first", None),
        ("d", "no labels here", None),
        ("e", None, None),
        ("f", "", None),
        ("g", "Dunmore: who", "Eve Dunmore"),
        ("h", "Dunmore: who", None),
        ("i", "[HOST] [applause]\n[Frank Grixberg] x", None),
        ("j", "Host: " + "word " * 50_000, None),
    ]
    df = spark.createDataFrame(rows, "rec string, full_text string, speaker string")
    out = T.turns(df, F.col("rec"), "full_text", people, hint=F.col("speaker")).collect()
    got = {r: [x["speaker"] for x in sorted((x for x in out if x["rec"] == r), key=lambda x: x["turn_no"])] for r in "abcdefghij"}
    assert got == {"a": ["Carl Dunmore", "host", "Frank Grixberg"], "b": ["Ana Bergström", "host"], "c": ["host", "Ana Bergström"], "d": [], "e": [], "f": [], "g": ["Eve Dunmore"], "h": [], "i": ["Frank Grixberg"], "j": ["host"]}
    assert next(x["said"] for x in out if x["rec"] == "a" and x["turn_no"] == 1) == "one Point one: two three"
    assert T.turns(df.limit(0), F.col("rec"), "full_text", people).collect() == []
    assert T.turns(df, F.col("rec"), "full_text", people.limit(0)).where("rec = 'a'").count() == 1


def test_long_segments_of_fillers_make_no_turn(spark):
    people = spark.createDataFrame([(*p, 1) for p in PEOPLE], "display_name string, rec int")
    rows = [("a", "Carl Dunmore: one\nHost: " + "um, uh, " * 30 + "\nFrank Grixberg: two"), ("b", "Host:" + " " * 200 + "\nFrank Grixberg: two")]
    df = spark.createDataFrame(rows, "rec string, full_text string")
    got = [sorted((r["rec"], r["turn_no"], r["speaker"]) for r in T.turns(df, F.col("rec"), "full_text", people, speech=s).collect()) for s in (False, True)]
    assert got[0] == got[1] == [("a", 1, "Carl Dunmore"), ("a", 2, "Frank Grixberg"), ("b", 1, "Frank Grixberg")]


def test_notes_fillers_and_remarks_of_any_length(spark):
    people = spark.createDataFrame([(*p, 1) for p in PEOPLE], "display_name string, rec int")
    rows = []
    for n in (1, 59, 60, 61, 79, 80, 81, 500):
        note = "x" * n
        assert T.segments(f"Host: a <{note}> b ♪{note}♪ c *{note}* d ({note}) e")[1][2] == "a b c d e"
        assert T.segments(f"Carl Dunmore ({note}): hi")[1][0] == f"Carl Dunmore ({note})"
        fill = ("um " * n)[:n].strip() if n > 2 else "um"
        rows.append((f"r{n}", f"Carl Dunmore: one\nHost: {fill if fill[-1] == 'm' else fill + 'm'}\nFrank Grixberg: two"))
    df = spark.createDataFrame(rows, "rec string, full_text string")
    got = [sorted((r["rec"], r["turn_no"], r["speaker"]) for r in T.turns(df, F.col("rec"), "full_text", people, speech=s).collect()) for s in (False, True)]
    assert got[0] == got[1] == sorted((r, k, n) for r, _ in rows for k, n in ((1, "Carl Dunmore"), (2, "Frank Grixberg")))
    assert T.segments("Host: 3 * 4 and 5 * 6 < 7, 8 > 2")[1][2] == "3 * 4 and 5 * 6 < 7, 8 > 2"
