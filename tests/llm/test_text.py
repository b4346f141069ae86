"""Language, toxicity, licences and page text: held-out accuracy, brute force and odd rows."""

import itertools
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadlake.llm import html_text, language_id, licenses, toxicity

ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "12 ½ 34² !?"), (5, "word"), (5, "word"), (None, "word"), (7, "x" * 200_000), (8, "a " * 60_000)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "score", 1, 0.5) for i, t in rows], "doc_id long, text string, lang_pred string, at int, score double")


# Language


def test_language_on_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language_id.fit(docs.where(~language_id.held_out()))
    got = language_id.predicted(docs, model).join(docs.where(language_id.held_out()), "doc_id").select("lang", "lang_pred", "score").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.93
    assert all(0 <= r["score"] <= 1 for r in got)


def test_unseen_words_fall_back_to_their_longest_known_grams():
    model = language_id.Model.of([("a", "barbarbar", 9), ("b", "lololo", 9), ("b", "zug", 9)])
    assert model.rows("zug") == [model.words["zug"]]
    assert model.rows("barbaq") == [model.grams[g] for g in (" bar", "barb", "arba")]
    assert model.rows("q") == [] and model.rows("xz") == [model.grams["z"]]
    tokens = language_id.Tokens(model, limit=3)
    assert [lang for lang, _ in tokens.texts(["barba!", "LOLO zug", "4 5", "", "one two three four lolo"])] == ["a", "b", "und", "und", "b"]


def test_language_of_odd_rows(spark):
    docs = frame(spark, ODD)
    labelled = spark.createDataFrame([(1, "word is a", "en"), (2, "wort das", "de"), (3, None, "en"), (4, "x", None)], "doc_id long, text string, lang string")
    model = language_id.fit(labelled)
    got = {(r["doc_id"], r["lang_pred"]): r["score"] for r in language_id.predicted(docs, model).collect()}
    assert {i for i, lang in got if lang == "und"} == {1, 2, 3, 4}
    assert got[1, "und"] == 0 and got[5, "en"] > 0.5
    assert language_id.identified(docs, model).count() == 5
    assert language_id.identified(docs, model).schema == docs.schema
    large = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("the weather of day "), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("text"), F.lit("en").alias("lang"))
    few = spark.createDataFrame([(30_000 + i, t, "cy") for i, t in enumerate(["mae hen wlad fy nhadau", "yn annwyl i mi", "gwlad beirdd a chantorion"])], large.schema)
    model = language_id.fit(large.unionByName(few))
    assert sorted(model.languages) == ["cy", "en"]
    asked = spark.createDataFrame([(1, "fy nhadau annwyl"), (2, "the day")], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in language_id.predicted(asked, model).collect()} == {1: "cy", 2: "en"}
    nothing = language_id.fit(labelled.where("false"))
    assert {r["lang_pred"] for r in language_id.predicted(docs, nothing).collect()} == {"und"}
    assert language_id.predicted(docs.where("false"), model).count() == 0


def test_held_out_is_a_checksum_of_the_id(spark):
    import zlib

    got = spark.range(50).select("id", language_id.held_out("id").alias("out")).collect()
    assert all(r["out"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in got)


# Toxicity


def subsequence_kernel(s, t):
    """The kernel by definition: all pairs of equal subsequences of three, weighted by what they span."""

    def parts(x):
        for i, j, k in itertools.combinations(range(len(x)), 3):
            if j - i <= toxicity.GAP and k - j <= toxicity.GAP:
                yield x[i] + x[j] + x[k], toxicity.DECAY ** (k - i + 1)

    return sum(a * b for (u, a), (v, b) in itertools.product(parts(s), parts(t)) if u == v)


def test_kernel_by_definition():
    rng = random.Random(1)
    landmarks = ["idiot", "scum", "ünsinn", "aaaa"]
    tokens = ["idiot", "id.iot", "i-d-i-o-t", "idiots", "moron", "scuum", "aaaaaaa", "a", "", "ünsin", "\U0001f600idiot"]
    tokens += ["".join(rng.choice("idotscumaü") for _ in range(rng.randrange(1, 12))) for _ in range(60)]
    tokens += ["x" * 300 + "idiot", "ixdxixoxt", "idxxxiot"]
    kernel = toxicity.Kernel(landmarks)
    got = kernel.values(tokens)

    def size(token):
        steps = itertools.product(range(1, toxicity.GAP + 1), repeat=2)
        total = sum(max(0, len(token) - a - b) * toxicity.DECAY ** (2 * (a + b + 1)) for a, b in steps)
        return total ** (toxicity.LENGTH_POWER / 2) if total else 1.0

    for i, token in enumerate(tokens):
        for j, landmark in enumerate(landmarks):
            want = subsequence_kernel(token, landmark) / (size(token) * size(landmark))
            assert got[i, j] == pytest.approx(want, rel=1e-4, abs=1e-6), (token, landmark)
    weights = np.array([0.5, -1.0, 2.0, 0.25])
    assert kernel.along(tokens, kernel.direction(weights)) == pytest.approx(got @ weights, rel=1e-4, abs=1e-5)


def test_every_inserted_insult_has_a_value():
    rng = random.Random(5)
    insults = ["idiot", "moron", "trash", "clown", "pathetic", "stupid", "loser", "scumbag", "worthless", "disgusting"]
    kernel = toxicity.Kernel(insults)
    clean = kernel.values(["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 12))) for _ in range(2000)])
    usual = np.quantile(clean, 0.9, axis=0)
    letter = lambda: rng.choice("abcdefghijklmnopqrstuvwxyz")
    for inserted in (1, 2, 3, "every"):
        above = []
        for j, insult in enumerate(insults):
            for _ in range(20):
                if inserted == "every":
                    token = "".join(c + letter() for c in insult[:-1]) + insult[-1]
                else:
                    at = rng.randrange(1, len(insult))
                    token = insult[:at] + "".join(letter() for _ in range(inserted)) + insult[at:]
                found = kernel.values([token])[0]
                assert found[j] > 0, token
                above.append(found[j] > usual[j] and found.argmax() == j)
        assert np.mean(above) >= 0.9, (inserted, np.mean(above))


def test_sentences():
    assert toxicity.plain_sentences("You, I D I O T! Go.\nnow **there**") == [["you", "idiot"], ["go"], ["now", "there"]]
    assert toxicity.plain_sentences("") == [] and toxicity.plain_sentences(" \n !!! ") == []


@pytest.fixture(scope="module")
def insults(spark):
    rng = random.Random(2)
    plain = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    rows = []
    for i in range(600):
        words = [rng.choice(plain) for _ in range(40)]
        toxic = i % 3 == 0
        if toxic:
            words[rng.randrange(40)] = rng.choice(["idiot", "moron", "scumbag", "worthless"])
        rows.append((i, " ".join(w + ("." if at % 9 == 8 else "") for at, w in enumerate(words)), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic")), plain


def test_gapped_and_inserted_characters_are_tolerated(insults):
    model, plain = insults
    scores = toxicity.Scores(model)
    neutral = " ".join(plain[:10])
    for insult in ("idiot", "id-iot", "i.d.i.o.t", "i d i o t", "idiots", "mor*on", "sc.umbag", "worth_less!!", "IDIOT"):
        assert scores.texts([f"{neutral}. {neutral} {insult} {neutral}."])[0] >= toxicity.THRESHOLD, insult
    clean = [" ".join(plain[i : i + 40]) for i in range(0, 360, 10)]
    assert np.mean([p < toxicity.THRESHOLD for p in scores.texts(clean)]) > 0.95


def test_toxicity_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    model = toxicity.fit(docs, labels.where(~language_id.held_out()))
    got = toxicity.scored(docs, model).join(labels, "doc_id").where(language_id.held_out()).select("toxic", "score", "predicted").collect()
    toxic = np.array([r["toxic"] for r in got])
    score = np.array([r["score"] for r in got])
    wins = np.mean([(a > b) + (a == b) / 2 for a in score[toxic == 1] for b in score[toxic == 0]])
    assert wins > 0.7
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in got)


def test_toxicity_of_odd_rows(spark, insults):
    model, _ = insults
    got = {r["doc_id"]: r["score"] for r in toxicity.scored(frame(spark, ODD), model).collect()}
    assert len(got) == 8 and got[1] == got[2] == got[3] < toxicity.THRESHOLD
    assert toxicity.scored(frame(spark, []), model).count() == 0
    docs = frame(spark, ODD)
    none = toxicity.fit(docs, spark.createDataFrame([(1, None), (2, 0)], "doc_id long, toxic int"))
    assert {r["predicted"] for r in toxicity.scored(docs, none).collect()} == {0}


def test_toxicity_learns_one_text_of_an_id(spark):
    docs = frame(spark, [(1, f"text {i}") for i in range(300)] + [(2, "b"), (2, None), (None, "c")])
    labels = spark.createDataFrame([(1, 0), (1, 1), (1, 1), (2, 0), (None, 1), (3, 1)], "doc_id long, toxic int")
    got = toxicity.sampled(docs, labels, "text", "doc_id", "toxic").collect()
    assert sorted((r["_id"], r["_label"]) for r in got) == [(1, 1), (2, 0)]


# Licences


def test_rules_match_in_order(spark):
    grant = licenses.SENTENCES
    texts = {
        1: "Some text. Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.\nMore.",
        2: "Released under the MIT License.\nLicensed under CC BY-NC 4.0.\nReleased under the MIT license!",
        3: f"{grant['bsd-grant']}: {grant['bsd-source']}. {grant['bsd-binary']}. {grant['bsd-names']}.",
        4: f"{grant['bsd-grant']}: {grant['bsd-source']}. {grant['bsd-binary']}.",
        5: f"{grant['bsd-binary']}. {grant['bsd-grant']}.",
        6: None,
        7: "",
        8: "the mit license is released under",
        9: f"{grant['gpl-free']}; {grant['gpl-redistribute']}; {grant['gnu-2-or-later']}.",
    }
    got = {r["doc_id"]: r for r in licenses.scanned(frame(spark, texts.items())).collect()}
    found = {i: r["licenses"] for i, r in got.items()}
    assert found == {
        1: "Apache-2.0", 2: "CC-BY-NC-4.0,MIT", 3: "BSD-3-Clause", 4: "BSD-2-Clause", 5: "", 6: "", 7: "", 8: "", 9: "GPL-2.0-or-later",
    }
    assert got[2]["matched"] == "<mit-released> <cc-by-nc-4> <mit-released>"
    assert got[5]["n_known"] == 2 and got[6]["n_sentences"] == 0 and got[7]["n_sentences"] == 0
    assert licenses.scanned(frame(spark, [])).count() == 0


def test_rules_name_known_sentences_and_stand_before_their_parts():
    assert {i for _, sequence in licenses.RULES for i in sequence} == set(licenses.SENTENCES)
    for at, (_, longer) in enumerate(licenses.RULES):
        for _, earlier in licenses.RULES[:at]:
            assert longer[: len(earlier)] != earlier


# Pages

PAGES = {
    "plain": ("<p>just text", "just text"),
    "references": ("plain &lt;text&gt; &amp;&nbsp;more &#233;", "plain <text> & more é"),
    "markup only": ("<html><body><script>var a='<p>no</p>';</script><style>p{}</style><nav>menu</nav></body>", ""),
    "comment": ("<!-- <p>no</p> --><p>yes</p>", "yes"),
    "unclosed": ("<article><h1>T</h1><p><b>one<br>two<p>three</article><footer>foot</footer>", "T\none two\nthree"),
    "around": (
        '<header><h1>Site</h1></header><div class="cookie-notice">We use, cookies, ok, fine</div><div id="main"><h1>Title</h1><p>One, two &amp; three,'
        ' and four.<p>Next <b>para</b> here, and more.</p><div class="comments"><p>I, like, this, so, very, much</p></div></div>'
        '<aside><p>Side, bar, text, long</p></aside><form><p>in a form, with, commas</p></form><div class="ad">Buy, now, cheap</div>',
        "Title\nOne, two & three, and four.\nNext para here, and more.",
    ),
    "links": (
        "<div><ul>" + "".join(f'<li><a href="/{i}">a, long, link, text, {i}</a></li>' for i in range(30)) + "</ul></div>"
        "<div><p>The story, at last, is here, and it is long enough to be told.</p><p>It ends, too.</p></div>",
        "The story, at last, is here, and it is long enough to be told.\nIt ends, too.",
    ),
    "lists": ("<article><p>a, b</p><ul><li>one</li><li>two</ul><table><tr><td>x<td>y</table></article>", "a, b\none\ntwo\nx\ny"),
    "hidden": ('<article><p>seen</p><p hidden>unseen</p><p style="display: none">unseen</p></article>', "seen"),
    "white": ("<p>  a\n\t b  <i> c</i></p>", "a b c"),
    "cut": ("<article><p>text <a href='x", "text <a href='x"),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    html, want = PAGES[name]
    assert html_text.main_text(html) == want


STORY = "<p>The story, at last, is here, and it is long enough to be told.</p><p>It ends, too.</p>"


@pytest.mark.parametrize(
    "attribute", ['href="/hidden-gems"', 'title="A hidden valley"', 'href="/page?id=search"', 'data-id="footer-7"', "href='/x' data-role=menu", 'data-hidden="1"']
)
def test_attributes_are_told_apart(attribute):
    assert html_text.main_text(f"<article><p>one <a {attribute}>two</a> three</p></article>") == "one two three"
    assert html_text.main_text(f"<body {attribute}><article><p>one two</p></article></body>") == "one two"


@pytest.mark.parametrize("name", ["content-sidebar-wrap", "site has-sidebar", "elementor-widget-post", "no-banner"])
def test_wrappers_of_the_text_stay_and_what_stands_beside_it_goes(name):
    want = "The story, at last, is here, and it is long enough to be told.\nIt ends, too."
    beside = "".join(f'<div class="{c}"><p>Side, text, here</p></div>' for c in ("sidebar", "site-footer", "cookie-notice", "main-nav"))
    assert html_text.main_text(f'<body><div class="{name}"><div>{STORY}</div>{beside}</div></body>') == want
    assert html_text.main_text(f'<div class="{name}">{beside}<article>{STORY}</article></div>') == want


@pytest.mark.parametrize(
    "html, want",
    [
        ("<p><a href=o'neil>one</a> two isn't here</p><p>three</p>", "one two isn't here\nthree"),
        ('<p>one <img alt="5" tall"> two</p><p>three</p>', "one two\nthree"),
        ('<p>a < b, 3 <4 and <a title="x > y">c</a></p>', "a < b, 3 <4 and c"),
        ('<p>one <a href="x>two</a></p><p>three</p>', "one two\nthree"),
        ("<p>one<br/>two <a href=/x/>three</a></p>", "one two three"),
        ('<div class="content"><p>One, two, three, and so on to the end.</p></div><div class="content"><p>Short end.</p></div>', "One, two, three, and so on to the end.\nShort end."),
        (f"<body><form id=all><article>{'<p>One, two.</p>' * 2}</article></form></body>", "One, two.\nOne, two."),
        (f'<body><div class="search results"><article>{"<p>One, two.</p>" * 2}</article></div></body>', "One, two.\nOne, two."),
        ("<article><p>One, two, three.</p><form><p>Write to us</p><input></form></article>", "One, two, three."),
        ("<b><i><p>one</b></i><p>two<div>three</p></div>", "one\ntwo\nthree"),
    ],
)
def test_bad_markup_keeps_its_text(html, want):
    assert html_text.main_text(html) == want


@pytest.mark.parametrize(
    "html", ["<a b='" * 170_000, "<b>" * 8_000 + "<p>word" * 120_000, "<b><div>" + "<i>" * 100_000 + "</b>" * 150_000, "<!" * 500_000, "<title>" * 140_000, "<" * 1_000_000, "<a b=\"" + "<a b='x" * 150_000]
)
def test_a_megabyte_of_bad_markup_ends_soon(html):
    begin = time.process_time()
    html_text.main_text(html)
    assert time.process_time() - begin < 10


def test_deep_and_long_pages():
    assert html_text.main_text("<div>" * 20_000 + "<p>deep") == "deep"
    assert len(html_text.main_text("<article>" + "<p>word, word</p>" * 20_000)) == 20_000 * 11 - 1
    for html in (None, "", " ", "<", "<<<>>>", "</p></div>", "<a"):
        html_text.main_text(html)


def test_pages_of_the_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    odd = spark.createDataFrame([(None, None, None), (1, "u", "")], "page_id long, url string, html string")
    got = html_text.extracted(pages.withColumn("text", F.lit("clash")).select("text", "page_id", "url", "html")).collect()
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in got:
        inside = html[r["page_id"]].split("<article>")[1].split("</article>")[0]
        assert r["n_chars"] == len(r["text"]) and r["text"].split("\n")[0] in html_text.unescape(inside)
        assert "menu" not in r["text"] and "<" not in r["text"]
    assert [tuple(r) for r in html_text.extracted(odd).collect()] == [(None, None, "", 0), (1, "u", "", 0)]
