"""Toxicity, language, quality rules and page text."""

import html
import pickle
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash

from turntable.llm import language, quality, toxicity
from turntable.llm.html_text import extract_text, main_text
from turntable.llm.queries import QUERIES


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    return {row.doc_id: row for row in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}


def test_gradients():
    names = ["abc", "de", "x"]
    own, grams, first = toxicity.word_inputs(names)
    vocabulary = own, grams, first, np.diff(np.append(first, len(grams)))
    p = {name: value.astype(np.float64) for name, value in toxicity.initial(1).items()}
    draw = np.random.default_rng(0)
    windows, mask = draw.integers(0, 3, (toxicity.WINDOW, 4)), np.zeros((toxicity.WINDOW, 4), dtype=bool)
    for i, n in enumerate((48, 7, 1, 20)):
        mask[:n, i] = True
    wanted = np.array([1, 0, 1, 0.0])
    _, found = toxicity.gradients(p, vocabulary, windows, mask, wanted)
    for name, g in found.items():
        rows, values = g if isinstance(g, tuple) else (np.arange(len(g)), g)
        at = np.unravel_index(np.argmax(np.abs(values)), values.shape)
        place = (rows[at[0]], *at[1:])
        losses = []
        for change in (1e-3, -1e-3):
            moved = {key: value.copy() for key, value in p.items()}
            moved[name][place] += change
            losses.append(toxicity.gradients(moved, vocabulary, windows, mask, wanted)[0])
        assert (losses[0] - losses[1]) / 2e-3 == pytest.approx(values[at], rel=0.02, abs=1e-6), name


def test_toxicity_learns_and_handles_edges(spark):
    draw = np.random.default_rng(5)
    words = ["the", "river", "stone", "cloud", "walks", "under", "green"]

    def text(bad):
        some = list(draw.choice(words, 60))
        if bad:
            some[int(draw.integers(60))] = "vex" + str(draw.choice(["on", "ar", "il"]))
        return " ".join(some)

    rows = [(i, text(i % 3 == 0), int(i % 3 == 0)) for i in range(240)]
    df = spark.createDataFrame([(n, t) for n, t, _ in rows], "doc_id bigint, text string")
    model = toxicity.fit(df, spark.createDataFrame([(n, label) for n, _, label in rows], "doc_id bigint, toxic int"))
    new = [(1, text(False) + " vexon " + text(False)), (2, " ".join(text(False) for _ in range(20))), (None, None), (4, ""), (4, "")]
    scored = toxicity.score(spark.createDataFrame(new, "doc_id bigint, text string").selectExpr("*", "'s' AS score"), model)
    found = scored.collect()
    assert len(found) == len(new) and scored.columns == ["doc_id", "text", "score"]
    by = {row.doc_id: row.score for row in found}
    assert by[1] >= toxicity.THRESHOLD > by[2] and by[None] == by[4] == 0
    empty = toxicity.fit(df.limit(0), spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert toxicity.score(df.limit(1), empty).first().score < toxicity.THRESHOLD


def test_toxicity_query(spark, sf_dir, labels):
    found = QUERIES["op2_toxicity"](spark, sf_dir).collect()
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    known = [row for row in found if row.doc_id in labels]
    right = [row.predicted == labels[row.doc_id].toxic for row in known]
    assert np.mean(right) > 0.9
    assert all(row.predicted == (row.score >= 0.3) and 0 <= row.score <= 1 for row in found)


def test_language(spark, sf_dir):
    found = {row.doc_id: row for row in QUERIES["op7_language"](spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()
    aside = [found[row.doc_id].lang_pred == row.lang for row in rows if found[row.doc_id].held_out and row.lang]
    assert np.mean(aside) > 0.95


def test_language_mixture_and_edges(spark):
    model = language.train(["the of and in that"] * 5 + ["der die und das nicht"] * 5, ["en"] * 5 + ["de"] * 5)
    rows = [(1, "the of and in that " * 20 + "der die und das nicht " * 10), (2, None), (3, "12 !!"), (None, "der die das")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS languages")
    found = {row.doc_id: row for row in language.identify(df, model).collect()}
    assert found[1].lang_pred == "en" and found[1].score == pytest.approx(2 / 3, abs=0.05)
    assert [one.lang for one in found[1].languages] == ["en", "de"]
    assert (found[2].lang_pred, found[3].lang_pred, found[2].score) == ("und", "und", 0)
    assert found[None].lang_pred == "de"
    assert language.identify(df, language.train([], [])).where("lang_pred <> 'und'").count() == 0
    assert language.identify(df.limit(0), model).count() == 0


def invented(n_languages, seed=7):
    """Vocabularies that share few trigrams, a model of them, and a function that draws a text of some of them."""
    draw = np.random.default_rng(seed)
    letters = [list("abcdefgh"), list("hijklmno"), list("nopqrstu"), list("uvwxyzab"), list("aeioubdg"), list("éèàùçabc")][:n_languages]
    words = [["".join(draw.choice(own, int(draw.integers(3, 9)))) for _ in range(300)] for own in letters]
    names = [f"l{i}" for i in range(n_languages)]
    model = language.train([" ".join(own) for own in words], names)

    def text(counts):
        return " ".join(word for i, n in enumerate(counts) for word in draw.choice(words[i], n)) if sum(counts) else ""

    return names, model, text, draw


@pytest.mark.parametrize("n_languages", [4, 5, 6])
def test_sets_of_any_size(n_languages):
    names, model, text, _ = invented(n_languages)
    mixtures = language.Mixtures(model.packed)
    for size in range(1, n_languages + 1):
        found = mixtures.shares([text([60] * size + [0] * (n_languages - size))])[0]
        assert sorted(name for name, _ in found) == names[:size]
        assert all(share == pytest.approx(1 / size, abs=0.06) for _, share in found)


def test_sets_by_brute_force():
    """The set is that of the highest likelihood less the penalty, of all sets there are."""
    names, model, text, draw = invented(5)
    mixtures = language.Mixtures(model.packed)
    _, table = pickle.loads(model.packed)
    texts = [text(draw.integers(0, 40, 5) * draw.integers(0, 2, 5)) for _ in range(40)]
    texts = [one for one in texts if one]
    for one, found in zip(texts, mixtures.shares(texts), strict=True):
        words = language.letters_of(one)
        _, grams, first = toxicity.word_inputs(words)
        logs = np.add.reduceat(table[grams].astype(np.float64), first, axis=0)
        values = {}
        for size in range(1, 6):
            for some in combinations(range(5), size):
                share = np.full(size, 1 / size)
                for _ in range(60):
                    weighed = share * np.exp(logs[:, some] - logs.max(axis=1, keepdims=True))
                    share = (weighed / weighed.sum(axis=1, keepdims=True)).mean(axis=0)
                fit = np.log((share * np.exp(logs[:, some] - logs.max(axis=1, keepdims=True))).sum(axis=1)) + logs.max(axis=1)
                values[some] = fit.sum() - 0.5 * (size - 1) * np.log(len(words) + 1)
        own = tuple(sorted(names.index(name) for name, _ in found))
        assert values[own] >= max(values.values()) - 0.05


def test_only_letters_make_words(spark):
    model = language.train(["the of and"], ["en"])
    rows = [(1, "\u00b2  \u00bd \u2167 12 _ !"), (2, "\u0301"), (3, "x\u00b2")]
    found = {row.doc_id: row.lang_pred for row in language.identify(spark.createDataFrame(rows, "doc_id bigint, text string"), model).collect()}
    assert found == {1: "und", 2: "und", 3: "en"}


def test_languages_of_long_texts_are_learnt(spark):
    rows = [(i, "der die und das " * 2000, "de") for i in range(8)] + [(i, "the of and in ", "en") for i in range(8, 16)] + [(None, "x", "fr")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    names, _ = pickle.loads(language.fit(df).packed)
    assert names == ["de", "en"]
    held = df.select("doc_id", toxicity.held_out().alias("h")).collect()
    assert all(row.h == (row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 4 == 2) for row in held)


def test_network_equals_a_plain_one():
    """Scores of texts of any length, window by window and word by word."""
    p = {name: value.astype(np.float64) for name, value in toxicity.initial(3).items()}
    p["words"][:] = np.random.default_rng(1).standard_normal(p["words"].shape)
    scorer, draw = toxicity.Scorer(pickle.dumps(p)), np.random.default_rng(2)
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def one(words):
        own, grams, first = toxicity.word_inputs(words)
        x = [np.concatenate([p["words"][own[i]], p["grams"][part].sum(axis=0)]) for i, part in enumerate(np.split(grams, first[1:]))]
        states = {}
        for side, order in (("forth", range(len(x))), ("back", range(len(x) - 1, -1, -1))):
            state, h = np.zeros(toxicity.HIDDEN), toxicity.HIDDEN
            for i in order:
                given, rest = x[i] @ p[f"{side}_in"] + p[f"{side}_bias"], state @ p[f"{side}_state"]
                stay, reset = sigmoid(given[:h] + rest[:h]), sigmoid(given[h : 2 * h] + rest[h : 2 * h])
                state = stay * state + (1 - stay) * np.tanh(given[2 * h :] + reset * rest[2 * h :])
                states[side, i] = state
        both = np.array([np.concatenate([states["forth", i], states["back", i]]) for i in range(len(x))])
        weight = np.exp(np.tanh(both @ p["attend"] + p["attend_bias"]) @ p["attend_to"])
        return sigmoid((weight / weight.sum()) @ both @ p["out"] + p["out_bias"])[0]

    names = ["ab", "cde", "é", "fghij", "klm"]
    texts = [list(draw.choice(names, n)) for n in (1, 5, 47, 48, 49, 72, 73, 130)]
    for words, found in zip(texts, scorer.texts([" ".join(words) for words in texts]), strict=True):
        size, n = toxicity.WINDOW, len(words)
        starts = {min(s, max(0, n - size)) for s in toxicity.window_starts(n)}
        assert found == pytest.approx(max(one(words[s : s + size]) for s in starts), abs=1e-4)


def test_toxicity_of_rows_held_out(spark):
    """Labelled rows that nothing was learnt from, of the largest tables, which have enough of them."""
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet")
    documents, marks = read("documents").select("doc_id", "text"), read("labels").select("doc_id", "toxic")
    aside = documents.join(marks, "doc_id").where(toxicity.held_out())
    rows = toxicity.score(aside, toxicity.fit(documents, marks)).select("toxic", "score").collect()
    toxic = [row.score >= toxicity.THRESHOLD for row in rows if row.toxic]
    clean = [row.score >= toxicity.THRESHOLD for row in rows if not row.toxic]
    assert len(toxic) > 50 and np.mean(toxic) > 0.85
    assert len(clean) > 500 and np.mean(clean) < 0.03


def plain_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = list(zip(words, words[1:], words[2:], strict=False))
    met = Counter(windows)
    covered = {i + k for i, one in enumerate(windows) if met[one] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def brute_scores(texts, trusted):
    def features(text):
        tokens = re.findall(r"[^\W_]+|[^\w\s]+|_+", text or "")
        mask = quality.BUCKETS - 1
        out = []
        for i, token in enumerate(tokens):
            first = xxhash.xxh64_intdigest(token.encode(), 42)
            out += [first & mask]
            out += [(xxhash.xxh64_intdigest(tokens[i + 1].encode(), first) if i + 1 < len(tokens) else first) & mask]
        return out

    every, good = Counter(), Counter()
    for number, text in texts.items():
        every.update(features(text))
        if number in trusted:
            good.update(features(text))
    n_every, n_good = sum(every.values()) + quality.BUCKETS, sum(good.values()) + quality.BUCKETS
    weight = lambda b: round(1000 * (np.log((good[b] + 1) / n_good) - np.log((every[b] + 1) / n_every)))
    return {n: np.mean([weight(b) for b in own]) / 1000 if (own := features(text)) else 0.0 for n, text in texts.items()}


def test_quality_query(spark, sf_dir, labels):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    wanted = brute_scores(texts, {n for n, row in labels.items() if row.quality == 1})
    found = QUERIES["op1_quality_rules"](spark, sf_dir).collect()
    assert len(found) == len(texts)
    for row in found:
        own = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words)
        assert own == plain_statistics(texts[row.doc_id])
        assert row.base_failed == (own[0] < 50 or 100 * own[4] > 50 * own[0])
        assert row.score == pytest.approx(wanted[row.doc_id], abs=2e-3)
        assert row.kept == (not row.base_failed and row.score >= quality.THRESHOLD)


def test_quality_edges(spark):
    words = " ".join(f"w{i % 7}x{i}" for i in range(60))
    rows = [(1, None), (2, ""), (None, words), (4, words), (4, words), (5, "a b c " * 3000), (6, "x\n\nx\n \nx"), (7, "a b c d a b c\x0b#")]
    rows += [(8, " ".join(str(i % 5000) for i in range(6000)))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS quality", "2 AS _id")
    trusted = spark.createDataFrame([(4,), (4,), (None,)], "doc_id bigint")
    found = quality.quality_rules(df, trusted).select("doc_id", "text", "quality.*").collect()
    assert len(found) == len(rows)
    for row in found:
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == plain_statistics(row.text)
    assert [row.kept for row in found if row.doc_id == 4] == [True, True]
    assert quality.quality_rules(df.limit(0), trusted).count() == 0
    assert {row.score for row in quality.quality_rules(df, trusted.limit(0)).select("quality.score").collect()} == {0.0}


def test_page_text_outside_article():
    clause = "Under section (c) of the act the owner of a house has to pay for the repair of the road that is in front of it."
    long = f"{clause} The sign © stands for a claim of the author, and it is of no use to those who have not read the law. {clause}"
    assert main_text(f"<body><p>{clause}</p><p>{long}</p><p>© 2024 the owners of it</p></body>") == f"{clause} {long}"
    assert main_text(f"<body><p>{clause}</p><p>Copyright (c) the owners of it</p><p>(c) 2024 and all of us</p></body>") == clause
    finnish = "Vanha kalastaja lähti aamulla järvelle, jossa tuuli puhalsi hiljaa ja aallot keinuttivat pientä venettä pitkään."
    page = f'<body><nav><a href="/">Etusivu</a></nav><div><p>{finnish}</p><p>{finnish}</p></div></body>'
    assert main_text(page) == f"{finnish} {finnish}"


def test_elements_that_close_themselves_or_never():
    """Only what an element holds is skipped, however it ends."""
    page = lambda inside: f"<article><p>A</p><p>See {inside} icon B</p><p>C</p></article><footer>no</footer>"
    whole = "A See icon B C"
    assert main_text(page("<svg width='1'/>")) == whole
    assert main_text(page("<svg><path d='M0'/><title>no</title><style/><text>no</text></svg>")) == whole
    assert main_text(page("<svg><svg/><g>no</g><svg>no</svg>no</svg>")) == whole
    assert main_text(page("<math/>")) == main_text(page("<math><mi>x</mi></math>")) == whole
    assert main_text(page("<select><option>no</option></select>")) == whole
    assert main_text(page("<object><p>no</p></object>")) == whole
    assert main_text(page("<noscript><p>no<p>no</noscript>")) == whole
    assert main_text(page("<video><source src=a>no</video><canvas>no</canvas>")) == whole
    assert main_text("<article><p>A</p><p>See <select><option>no</p><p>C</p></article>") == "A See C"
    assert main_text("<article><p>A</p><p>See <svg><g>no</p><p>C</p></article><p></svg></p>") == "A See C"
    assert main_text("<article><p>A</p></svg></select><p>C</p></article>") == "A C"
    assert main_text("<article><p>A <script>var s = '<svg>';</script>B</p><p>C</p></article>") == "A B C"
    assert main_text("<article><p>A <script src='x'/>no</script>B</p></article>") == "A B"


def test_pages_of_the_tables_to_the_letter(spark, sf_dir):
    """The article with its markup taken out, and nothing of menus, adverts and footers."""
    pages = {row.page_id: row.html for row in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for row in QUERIES["op3_html_text"](spark, sf_dir).collect():
        page = pages[row.page_id]
        article = re.search(r"(?s)<article>(.*)</article>", page)[1]
        text = re.sub(r"<[^>]+>", "", re.sub(r"</?(?:p|h1|div|br)[^>]*>", " ", article))
        assert row.text == " ".join(html.unescape(text).split())
        outside = re.findall(r"(?s)<(?:nav|footer|script|style)>(.*?)</|<div class=\"ad\">(.*?)</div>", page)
        for part in filter(None, (" ".join(html.unescape(re.sub("<[^>]+>", " ", a or b)).split()) for a, b in outside)):
            assert len(part) < 20 or part not in row.text


def test_page_text(spark, sf_dir):
    page = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var t="</p>";</script></head><body>
    <nav><ul><li><a href="/">Home</a></li></ul></nav><!-- <p>no</p> --><div class="cookie-notice">We use cookies</div>
    <article><h1>A &amp; B</h1><p>One <b>two</b>three.<br><p>Short.</p><div class="comments"><p>the and of it is no</p></div></article>
    <aside>more of the same</aside><form><p>the name</p><input></form><footer>&copy; the firm</footer></body>"""
    assert main_text(page) == "A & B One twothree. Short."
    long = "the stone of the river and it was " * 10
    assert main_text(f"<div>Menu</div><div><p>{long}</p><p>Short.</p><p>{long}</p></div><div>Imprint</div>").count("Short.") == 1
    assert main_text("") == "" and main_text("<p") == "" and main_text("<script>x") == "" and main_text("<article>a < b</article>") == "a < b"
    rows = [(1, page), (None, None), (2, ""), (3, "<article>" + "<p>x y</p>" * 5000)]
    df = spark.createDataFrame(rows, "page_id bigint, html string").selectExpr("*", "'k' AS text", "1 AS _x")
    found = {row.page_id: row.text for row in extract_text(df).collect()}
    assert found[None] == found[2] == "" and len(found[3].split()) == 10000
    assert extract_text(df.limit(0)).count() == 0
    pages = {row.page_id: row.html for row in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for row in QUERIES["op3_html_text"](spark, sf_dir).collect():
        assert row.n_chars == len(row.text) and "<" not in row.text and row.text
        article = re.sub(r"<[^>]+>", " ", re.search(r"(?s)<article>(.*)</article>", pages[row.page_id])[1])
        assert len(row.text.split()) >= 0.98 * len(article.replace("&amp;", "&").split())
