"""Source divergence against a brute force over all terms and pairs."""

import random
import re
from collections import Counter, defaultdict

from turntable.llm.divergence import divergence

LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(documents, least, top):
    counts, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in documents:
        lang, source = lang or "", source or ""
        words = LETTERS.findall((text or "").translate(LOWER))
        groups.add((lang, source))
        counts[lang, source].update(words)
        held[lang].update(set(words))
    rows = set()
    for lang, source in groups:
        kept = [term for term, n in held[lang].items() if n >= least]
        own = {s: counts[lang, s] for one, s in groups if one == lang}
        whole = sum(own.values(), Counter())
        size = lambda c: sum(c[term] for term in kept) + 2 * len(kept)
        share = lambda c, term: 1 + 10**9 * (c[term] + 2) // size(c)
        value = lambda p, q: (p - q) ** 2 // (p + q)
        mine = {term: share(own[source], term) for term in kept}
        pairs = [(-sum(value(mine[term], share(other, term)) for term in kept), s) for s, other in own.items() if s != source]
        terms = []
        for term in kept:
            q = share(whole, term)
            if own[source][term] and mine[term] > q:
                terms.append((-value(mine[term], q), term))
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            rows |= {(lang, source, part, item, -low, at) for at, (low, item) in enumerate(found, 1)}
    return rows


def found(spark, documents, **options):
    rows = [(i, *row, "x", 7) for i, row in enumerate(documents)]
    df = spark.createDataFrame(rows, "doc_id bigint, lang string, source string, text string, term string, n int")
    out = divergence(df, **options).collect()
    assert len(out) == len(set(out))
    return {tuple(row) for row in out}


def test_drawn_texts(spark):
    draw = random.Random(11)
    words = [f"{a}{b}" for a in ("Ab", "be", "çé", "日本", "Éa", "x") for b in ("", "a", "q", "ü", "z")]
    documents = []
    for _ in range(300):
        lang, source = draw.choice(["a", "a", "b", None, ""]), draw.choice(["s1", "s2", "s3", "s4", "s9", "é", None])
        text = draw.choice([" ", "-", "1"]).join(draw.choices(words, weights=range(1, len(words) + 1), k=draw.randint(0, 30)))
        documents.append((lang, source, draw.choice([text, text, text, None, ""])))
    documents += [("lone", "s1", "only one source " * 3)] * 12 + [("poor", "s1", "too few"), ("poor", "s2", None)]
    documents += [("a", "s1", "aaa " * 50_000)]
    assert found(spark, documents, min_documents=5, top=4) == brute(documents, 5, 4)
    assert found(spark, documents) == brute(documents, 10, 10)


def test_ties_are_ranked_by_item(spark):
    documents = [("l", s, "one two") for s in ("a", "b", "c")] * 10
    assert found(spark, documents) == brute(documents, 10, 10)
    assert {row[5] for row in found(spark, documents) if row[1] == "b"} == {1, 2}


def test_no_documents(spark):
    assert found(spark, []) == set()


def test_rows_that_share_paths(spark, many_tasks):
    """Every term of a block is used alike, so the tree has few nodes for many rows."""
    documents = []
    for source in range(6):
        text = " ".join(f"{chr(97 + block)}{chr(97 + i)}" for block in range(4) for i in range(26) if source % (block + 1) == 0)
        documents += [("l", f"s{source}", text)] * (2 + source)
    assert found(spark, documents) == brute(documents, 10, 10)
