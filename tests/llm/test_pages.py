import random
import re

from pyspark.sql import functions as F

from commgraph.llm import boilerplate as B
from commgraph.llm import frames
from commgraph.llm import residue as R

WORDS = "council budget river harvest minister school bridge union market border winter vote report money paper season".split()


def sentence(rnd):
    return "The " + " ".join(rnd.choice(WORDS) for _ in range(12)) + f", and {rnd.randint(2, 99)} members agreed with it."


def page(rnd, inside=True):
    body = [sentence(rnd) + " " + sentence(rnd) for _ in range(rnd.randint(2, 5))]
    if inside:
        body.insert(1, "Advertisement")
    body.insert(rnd.choice([1, len(body)]), "Thank you.")
    return "\n".join(["Home | World | Opinion", "We and our 12 partners store cookies on your device. Accept all | Reject | Manage choices", "", *body, "Most read", "Why towns still vote", "Share this: Mail | Print | Copy link", "© 2024 Us. All rights reserved."])


def test_lines(spark):
    rnd = random.Random(1)
    pages = [(f"p{k}", page(rnd), "t") for k in range(40)] + [("n", None, "t"), ("e", "", "t"), ("b", " \n\n", "t"), ("p0", None, "t"), ("long", "\n".join(sentence(rnd) for _ in range(3000)), "t")]
    df = spark.createDataFrame(pages, "id string, text string, line_no string")
    w = B.learn(df, "text")
    flags = B.line_flags(df, F.col("id"), "text", w).collect()
    by = {}
    for r in flags:
        by.setdefault(r["rec"], {})[r["line_no"]] = r["is_body"]
    texts = {a: b for a, b, _ in pages if b}
    for k in range(40):
        lines = texts[f"p{k}"].split("\n")
        for n, is_body in by[f"p{k}"].items():
            assert is_body == (lines[n - 1].startswith("The ") or lines[n - 1] == "Thank you."), lines[n - 1]
        assert 3 not in by[f"p{k}"]
    assert all(by["long"].values()) and "e" not in by and "b" not in by and "n" not in by
    bodies = {r["rec"]: r["body"] for r in B.main_bodies(df, F.col("id"), "text", w).collect()}
    assert bodies["p1"].startswith("The ") and "Thank you." in bodies["p1"] and "Most read" not in bodies["p1"] and bodies["e"] == ""
    assert B.line_flags(df.limit(0), F.col("id"), "text", B.learn(df.limit(0), "text")).collect() == []


def test_headline_from_title_or_id():
    w = B.fit([page(random.Random(k)) for k in range(30)])
    text = "Home | World\nUnion Votes On Budget\n" + sentence(random.Random(3))
    assert dict(B.body_lines(text, w, "union votes on  budget"))[2] and dict(B.body_lines(text, w, None, "union-votes-on-budget_a1b2c3"))[2]


def test_residue(spark):
    rnd = random.Random(2)
    good = [(f"g{k}", page(rnd)) for k in range(60)]
    good += [("quote", page(rnd) + "\nHe said the words page not found and lorem ipsum are no answer to the school board at all."), ("set", page(rnd) + "\nSets such as {1, 2, 3} and [sic] are fine, and so is 100% of $40 for <laughs> everyone here."), ("short", "Good evening."), ("null", None), ("blank", " \n "), ("blank", " \n ")]
    menu = "Home | World | Opinion\n{}\nShare this: Mail | Print | Copy link"
    bad = [("e1", "404 Not Found"), ("e10", "Error 404 Not Found"), ("e11", "404 Not Found!"), ("e2", "Page not found. Go back to the start page."), ("e3", menu.format("Please enable JavaScript to continue.")), ("e4", "Lorem ipsum dolor sit amet consectetur elit."), ("e5", menu.format("Lorem dolor amet elit consectetur ipsum sit elit amet dolor.")), ("e6", page(rnd).replace("members", "{{ member_count }}")), ("e7", page(rnd).replace("members", "[INSERT NAME HERE]")), ("e8", "Error 500: the page could not be loaded."), ("e9", page(rnd) + "\n%%DATE%%")]
    bad += [(f"b{k}", f"{w} enable JavaScript to {v}.") for k, (w, v) in enumerate([("Please", "continue"), ("Kindly", "read on"), ("You must", "go on"), ("Please", "view this page")])]
    bad += [(f"l{k}", "Lorem ipsum dolor sit amet " + " ".join(rnd.choice("elit amet dolor ipsum sit consectetur".split()) for _ in range(9))) for k in range(4)]
    df = spark.createDataFrame([(a, b, 0.5) for a, b in [*good, *bad]], "id string, content string, score double")
    out = R.residue(df, F.col("id"), "content").collect()
    assert {r["rec"] for r in out if r["is_residue"]} == {a for a, _ in bad}
    assert {r["rec"] for r in out} == {a for a, _ in [*good, *bad]}
    assert R.residue(df.limit(0), F.col("id"), "content").collect() == []


def test_records_are_decided_together_as_alone():
    rnd = random.Random(5)
    texts = [page(rnd) for _ in range(30)] + ["404 Not Found", "", "Good evening.", page(rnd).replace("members", "{{ n }}"), "Please enable JavaScript to continue."] * 2
    w = B.fit(texts)
    own = [x for t in texts for x in R.seeded(t, w)]
    f, sizes = R.features([p for p, _ in own])
    model = None
    for _ in range(5):
        model = R.maximized(R.expected(f, sizes, R.np.array([s for _, s in own]) == 1, R.np.ones(len(own)), model))
    got = R.decided(texts, model, w)
    alone = [R.decided([t], model, w)[0] for t in texts]
    assert [g[:2] for g in got] == [g[:2] for g in alone] and R.np.allclose([g[2] for g in got], [g[2] for g in alone])
    assert [g[1] for g in got[30:]] == ["message", "", "", "placeholder", "message"] * 2


def test_known_messages():
    known = "Page not found|HTTP 503|Erreur 404|Could not load|was unable to open|Activate JavaScript|scripting appears|<noscript>|blah blah blah|Sample text. Sample text. |text text text text x|null|Rate limited|Gateway time-out|internal failure|Code status 500"
    assert all(R.is_known(x) for x in known.split("|"))
    assert not any(R.is_known(x) for x in "The script of 45 pages|Code 12|nullify|A gateway".split("|"))


def test_residue_is_learned_from_all_passages(spark):
    n = 60_000  # of 160 characters each
    df = spark.range(n).select(F.rpad(F.concat(F.lit("Passage "), "id", F.lit(" of the record")), 160, " and so on").alias("t"))
    got = R.passage_table(df.unionAll(df.limit(10)), "t", B.fit([])).agg(F.count(F.lit(1)), F.sum("n")).first()
    assert tuple(got) == (n, n + 10)


def test_page_weights_are_learned_from_all_pages(spark):
    """Each furniture line stands on two pages of 3,000: whatever is left out of the fit, some would not be known."""
    rnd = random.Random(8)
    pages = ["\n".join([f"Section {chr(97 + k // 2 % 26)}{chr(97 + k // 52 % 26)}{chr(97 + k // 1352)} | News", *(sentence(rnd) + f" Case {WORDS[k % 16]} {k}." for _ in range(2)), "Most read"]) for k in range(3000)]
    df = spark.createDataFrame([(p,) for p in [*pages, *pages[:70], pages[0]]], "t string")
    w, whole = B.learn(df, "t"), B.fit(pages)
    assert all(B.plain(p.split("\n")[0]) in w.whole for p in pages) and not any(B.plain(p.split("\n")[1]) in w.whole for p in pages)
    # the same as in one process, and a page that stands several times counts once
    assert B.np.allclose(w.cells, whole.cells, atol=1e-5) and list(w.whole) == list(whole.whole) and B.np.allclose(w.whole.values[0], whole.whole.values[0])


def test_furniture_is_learned_from_other_furniture():
    """Lines held out of the fit are still told from body, by words and shapes they share with those seen."""
    rnd = random.Random(4)
    pages = []
    for k in range(200):
        site = f"Site {k % 9}"
        top = [f"{site} | {rnd.randint(1, 30)}° clear", rnd.choice(["Log in | Register", "Log in | Subscribe", "Register | Subscribe"]), "Home | World | Sports"]
        end = [rnd.choice(["Share this: Mail | Print", "Share on: Mail | Copy link"]), f"© {2010 + k % 9} {site}. All rights reserved.", rnd.choice(["Terms - Privacy - Contact", "Privacy - Jobs - Contact"])]
        pages.append("\n".join([*top, *(sentence(rnd) for _ in range(4)), *end]))
    held = {B.plain(x) for x in ("Log in | Subscribe", "Share on: Mail | Copy link", "Privacy - Jobs - Contact")}
    w = B.fit(pages, unseen=held.__contains__)
    assert not held & set(w.whole)
    flags = [k for p in pages for n, k in B.body_lines(p, w) if B.plain(p.split("\n")[n - 1]) in held]
    assert len(flags) > 100 and not any(flags)
    assert all(k for p in pages for n, k in B.body_lines(p, w) if p.split("\n")[n - 1].startswith("The "))


def test_lengths_do_not_matter():
    w = B.fit([page(random.Random(k)) for k in range(30)])
    for n in (10, 79, 80, 160, 161, 401, 2000):
        head = "A headline " + "x" * n
        assert dict(B.body_lines(f"Home | World\n{head}\n{sentence(random.Random(3))}", w, head))[2]
        assert B.is_sound(f"(laughter {'x' * n})")
        assert R.PLACEHOLDER.fullmatch("{{ " + "x" * n + " }}") and R.PLACEHOLDER.fullmatch("[INSERT " + "x" * n + "]")


def test_steps_go_on_until_the_model_stands_still():
    rnd = random.Random(6)
    ps = [sentence(rnd) for _ in range(200)] + [f"Error 404: page {k} not found" for k in range(20)] + [f"Error 404: page {k} not found now" for k in range(9)]
    seed = [0] * 200 + [1] * 20 + [0] * 9
    f, sizes = R.features(ps)
    model, mass = None, []
    for _ in range(R.STEPS):
        count = R.expected(f, sizes, R.np.array(seed) == 1, R.np.ones(len(ps)), model)
        model = R.maximized(count)
        mass.append(count[0, R.BUCKETS])
    assert abs(mass[-1] - mass[-2]) < R.STILL * mass[-1]
    post = R.posterior(f, sizes, model)
    assert (post[:200] < 0.5).all() and (post[200:] > 0.5).all()


def test_pages_and_sums_go_many_to_a_row(spark):
    """The JVM gets a row for a slice of pages and for a block of sums, not one for each page, line or cell."""
    rnd = random.Random(9)
    many = " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676 % 26)}{chr(97 + k // 17576)}" for k in range(70_000))  # more words than two bytes tell apart
    pages = [page(rnd) for _ in range(1500)] + [many, "", " \n ", "***\n\n_"]
    df = spark.createDataFrame([(f"p{k}", p) for k, p in enumerate(pages)] + [("none", None), (None, "No id.")], "id string, t string").coalesce(1)
    taken = B.taken_apart(df, "t", F.col("id"))
    assert taken.count() == 2
    rows = [b for b in B.each(taken.toArrow().to_batches())]
    got = [B.Taken.read(b) for b in rows]
    texts = [*pages, "No id."]
    want = B.Taken.of([x for p in texts for x in p.split("\n") if x.strip()])
    for k in ("bits", "line", "word", "sizes"):
        assert B.np.array_equal(B.np.concatenate([getattr(t, k) for t in got]), getattr(want, k)), k
    assert [t.pages for t in got] == [B.SLICE, len(texts) - B.SLICE] and [x for b in rows for x in b["rec"][0].as_py()] == [*(f"p{k}" for k in range(len(pages))), None]
    empty = B.taken_apart(df.where("t = ''"), "t", F.col("id"))
    assert B.flags_of(empty, B.learn_taken(empty)).count() == 0
    # the sums of several tasks, in several blocks and of several kinds
    n = 3 * frames.BLOCK // 2
    sums = frames.added(spark.range(0, 100, 1, 4), lambda batches: [B.np.full((2, n), float(sum(b.num_rows for b in batches))), B.np.ones((2, 1)), B.np.zeros((2, 5))], [n, 1, 5])
    assert (sums[0] == 100).all() and sums[0].shape == (2, n) and (sums[1] == 4).all() and not sums[2].any()


def test_words_are_those_of_the_patterns():
    """Lines taken apart in arrays have the words that patterns find, on odd text too."""
    rnd = random.Random(10)
    word = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*|#|[|·»›>/→←©°•–—:?!.;,()\[\]-]")
    odd = "a B sign newsletter rock’n’roll don't a-b - -- ’ _ a_b 1 2,345.6 1..2 7, ٣ ۴ 𝟙 𝒳 😀 ² ½ İ ΑΣ ß é 中 # | · » . ? ! … ( ) [x](u) [ • * \t \xa0 \x1c \r (laughter) 00:12".split(" ")
    lines = ["".join(rnd.choice(odd) + rnd.choice(["", " ", "  "]) for _ in range(rnd.randint(1, 20))) for _ in range(3000)] + ["", "x" * 3000, "x" * 2999 + "y", "x" * 300_000]
    t, at = B.Taken.of(lines), 0
    for k, line in enumerate(lines):
        p, inner = B.plain(line), B.bare(line)[0]
        ws = word.findall(p)
        assert t.word[at : at + t.sizes[k]].tolist() == [B.xxhash.xxh32_intdigest(w) for w in ws], line[:99]
        at += t.sizes[k]
        one = {b: bool(t.bits[k] & b) for b in (B.SENTENCE, B.STOPS, B.NUMBERED, B.SHORT, B.ENDS, B.STOCKED, B.BIT["~sep"], B.OF_SIZE[min(len(inner.split()), 16)])}
        assert list(one.values()) == [B.is_sentence(line), any(B.INTERRUPTIONS.search(w) for w in ws), "#" in p, len(inner.split()) <= B.PHRASE, p[-1:] in tuple(".?!"), bool(B.TIMED.match(line)) or B.is_sound(line), not B.SEPARATORS.isdisjoint(ws), True], line[:99]
        assert t.line[k] == B.line_hash(p)
    f, sizes = R.features(lines)
    for k, line in enumerate(lines):
        ws = [B.xxhash.xxh32_intdigest("#" if re.search(r"\d", w) else w) for w in re.findall(r"[^\W_]+", line.lower())]
        own = f[sizes[:k].sum() : sizes[: k + 1].sum()]
        assert {w % R.LINES for w in ws} <= set(own.tolist()) and len(own) <= 2 * len(ws)


def test_marks_are_those_of_the_pattern():
    rnd = random.Random(11)
    odd = "a XX /YY AB-12 NaN undefined { } {{n}} {% %} <% <B> ${a} #{b} [[X_Y]] [x] %(a)s %%D%% @@E@@ __f__ __ $G_H$ $ % @ _ \n (laughter) [applause] <music>".split(" ")
    for _ in range(4000):
        text = "".join(rnd.choice(odd) + rnd.choice(["", "", " "]) for _ in range(rnd.randint(1, 12)))
        some = any(c in text for c in R.BEGIN) or re.search(r"undefined|NaN|[A-Z]{2}[/.-][A-Z]", text)
        assert R.marks_of(text) == ([m[0] for m in R.MARK.finditer(text) if not B.NOISE.search(m[0])] if some else []), text
