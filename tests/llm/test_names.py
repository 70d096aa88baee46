from commgraph.llm import names as N

GROUPS = [
    ["Thomas Torstead", "THOMAS TORSTEAD", "Torstead, Thomas", "Torstead Thomas", "Tom Torstead", "T. Torstead", "TK Torstead", "Gov. Torstead", "Torstead", "Thomas K. Torstead", "Thmas Torstead", "Thomas Torstead "],
    ["Søren Dralmeiszano", "Soren Dralmeiszano", "Dralmeiszano, Søren", "Søren Dra lmeiszano", "Søren Dralmeisznao"],
    ["Henry Wockander", "Hank Wockandur", "Harry Wockander"],
    ["Tosiaxgrad Institute for Open Markets", "TIOM", "T.I.O.M.", "The Tosiaxgrad Institute for Open Markets", "Tosiaxgrad Inst. for Open Markets", "Tosiaxgrad Institute, Open Markets", "Tosixagrad Institute for Open Markets"],
    ["University of Kraexanholt", "Kraexanholt University", "U. of Kraexanholt", "University of Kraexanholt (main campus)"],
    ["Flianduthika Coastal Affairs Corporation", "Flianduthika Coastal Affairs", "Flianduthika Coastal Affairs Corp."],
    ["Youckia & Tosiaxgrad Holdings", "Youckia and Tosiaxgrad Holdings", "Youckia-Tosiaxgrad Holdings"],
]
APART = ["Ursula Leickbeck", "U. Pondvik", "Doris Hamson", "Robert Hamson", "Hamson", "Wamcaster", "Kolvale Rural Council", "Kolvale Rural Corporation", "Kolvale Rural"]


def test_groups(spark):
    rows = [(n, 3 if k == 0 else 1) for g in GROUPS for k, n in enumerate(g)] + [(n, 1) for n in APART] + [(None, 1), ("", 1), ("  ", 1)]
    df = spark.createDataFrame([(n, "x") for n, k in rows for _ in range(k)], "name string, entity string")
    got = {tuple(r) for r in N.variant_pairs(df, "name").collect()}
    want = {(min(a, b), max(a, b)) for g in GROUPS for a in g for b in g if a != b}
    assert got == want, (sorted(want - got)[:5], sorted(got - want)[:5])
    assert N.variant_pairs(df.limit(0), "name").collect() == []


def test_two_spelt_names_one_letter_apart_stay_apart(spark):
    rows = ["Ann Marl", "ANN MARL", "Ann Marls", "ANN MARLS"]
    df = spark.createDataFrame([(r,) for r in rows], "name string")
    assert N.variant_pairs(df, "name").count() == 2


def test_slips_of_slips_end_in_one_entity(spark):
    rows = ["Ann Venstrom"] * 4 + ["Ann Venstrop"] * 3 + ["Ann Venstzop"] * 2 + ["Ann Vqnstzop"] + ["???", "!", None]
    out = {r["name"]: r["entity"] for r in N.link_names(spark.createDataFrame([(r,) for r in rows], "name string"), "name").collect()}
    assert len({out[n] for n in out if n.startswith("Ann")}) == 1 and out["Ann Vqnstzop"] == "F|ann|venstrom"
    assert len(out) == 6 and out["???"] != out["!"]


def test_the_rarer_rewriting_wins(spark):
    # "Kolvale Rural" may stand for either body, "TIOM" only for one of those with other initials
    rows = ["Kolvale Rural Council", "Kolvale Rural Corporation", "Kolvale Rural", "Tosia Institute for Open Markets", "Tosia Agency for Open Markets", "TIOM"]
    out = {r["name"]: r["entity"] for r in N.link_names(spark.createDataFrame([(r,) for r in rows], "name string"), "name").collect()}
    assert out["TIOM"] == out["Tosia Institute for Open Markets"] and len({out[n] for n in rows[:3]}) == 3
