import random

from commgraph.llm.split import LIMIT, cut_kinds, longest_stretch, pieces, split_oversized


def check(text, limit, overlap):
    ps = list(pieces(text, limit, overlap))
    assert ps[0][0] == 0 and ps[-1][1] == len(text)
    back = ""
    for k, (a, b, o, cut) in enumerate(ps):
        assert b - a <= limit and (b > a or not text)
        if k:
            assert a + o == ps[k - 1][1] and o <= overlap
        back += text[a + o : b]
        if cut not in ("end", "forced"):
            assert text[b - 1] in " \t\r\n" or text[b] in " \t\r\n"
    assert back == text
    forced = any(p[3] == "forced" for p in ps)
    assert forced == (longest_stretch(text) > limit and len(text) > limit), (text, ps)


def test_round_trip_and_forced_exactly_where_a_stretch_exceeds_the_limit():
    rnd = random.Random(1)
    for _ in range(4000):
        limit = rnd.randint(3, 40)
        text = "".join(rnd.choice(rnd.choice(["ab", "ab.\n ", "  \n\r", "é漢", ". "])) * rnd.choice([1, 1, 1, rnd.randint(1, limit + 4)]) for _ in range(rnd.randint(0, 40)))
        check(text, limit, rnd.randint(0, limit // 2))


def test_prefers_paragraphs_and_overlaps():
    text = "\n\n".join("Some words here. More words there." * 20 for _ in range(40))
    ps = list(pieces(text))
    assert all(p[3] == "paragraph" for p in ps[:-1]) and all(p[2] == 200 for p in ps[1:])


def test_levels_are_taken_apart_from_the_largest_down():
    # a paragraph's end is used wherever it stands, also early in a piece
    early = "First para. " + "x" * 1400 + "\n\n" + "words go on " * 400
    assert list(pieces(early))[0][1:] == (1414, 0, "paragraph")
    # whole sections are packed together as long as they fit
    section = "A line.\n\nAnother one.\n\n\n"
    ps = list(pieces(section * 400))
    assert {p[3] for p in ps[:-1]} == {"section"} and all(p[1] - p[0] > LIMIT - len(section) for p in ps[:-1])
    # sentences of an oversized line, words of an oversized sentence
    assert list(pieces("One two. " * 1000))[0][3] == "sentence" and list(pieces("one two " * 1000))[0][3] == "word"


def test_a_line_end_of_two_characters_is_not_torn():
    for n in range(LIMIT - 3, LIMIT + 3):
        for glue in ("", " x"):
            text = "y" * n + "\r\n" + glue + "z " * 3000
            for a, b, *_ in pieces(text):
                assert text[b - 1 : b + 1] != "\r\n", n


def test_frame(spark):
    rows = [("a", None, 1), ("b", "", 2), ("c", "x" * LIMIT, 3), ("d", "x" * (LIMIT + 1), 4), ("d", "x" * (LIMIT + 1), 4), ("e", "word " * 3000, 5)]
    df = spark.createDataFrame(rows, "id string, content string, piece int")
    out = split_oversized(df, "id", "content")
    got = {r["id"]: r["n"] for r in out.groupBy("id").count().withColumnRenamed("count", "n").collect()}
    assert got["a"] == got["b"] == got["c"] == 1 and got["d"] == 4 and got["e"] >= 4
    assert sorted(map(tuple, cut_kinds(df, "id", "content").collect())) == [("d", "forced"), ("e", "boundary")]
    assert cut_kinds(df.limit(0), "id", "content").collect() == []
