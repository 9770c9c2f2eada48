"""Recursive byte-level BPE against the library that defines the vocabulary."""

import hashlib
import random

import public_tokenizers
import pytest
from tiktoken import Encoding

from tests.llm.drawn import all_code_points, drawn_texts
from turntable.llm import recursive_bpe
from turntable.llm.queries import QUERIES
from turntable.llm.recursive_bpe import LONG, RecursiveBpe, decode_documents, encode_documents, read_ranks
from turntable.sources.tables import read_table

FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(FILE), special_tokens={})


@pytest.fixture(scope="module")
def bpe():
    return RecursiveBpe(FILE, public_tokenizers.PATTERN)


def same(bpe, library, texts):
    ids = bpe.encode(texts)
    want = [library.encode_ordinary(text) for text in texts]
    found = [memoryview(own).cast("i").tolist() for own in ids]
    assert [(text[:80], a[:80], b[:80]) for text, a, b in zip(texts, found, want, strict=True) if a != b] == []
    assert bpe.decode(found) == [text.encode() for text in texts]


def test_drawn_texts(bpe, library):
    same(bpe, library, drawn_texts(3000))


def test_every_code_point(bpe, library):
    same(bpe, library, all_code_points())


def test_long_words(bpe, library):
    draw = random.Random(2)
    texts = ["a" * n for n in (LONG, LONG + 1, 1000, 100_003)] + ["abc" * 20_000, "日本" * 9000, "ab" * 77 + "b" * 400, " " * 5000, "=" * 3000]
    texts += ["".join(draw.choices("abcdefghijklmnopqrstuvwxyzéß", k=n)) for n in (129, 190, 1000, 60_000)]
    texts += ["".join(draw.choices("ab", k=n)) for n in (300, 5000)]
    same(bpe, library, texts)


def test_both_ways_to_contract_agree(bpe):
    draw = random.Random(3)
    words = ["".join(draw.choices("aab", k=draw.randint(1, 90))).encode() for _ in range(200)]
    words += [text.encode() for text in drawn_texts(200) if text]
    one, other = bpe._contract(words)[0], bpe._contract(words, recursive_bpe.TOGETHER)[0]
    assert [a.tolist() for a in one] == [b.tolist() for b in other]


def test_unsound_vocabulary(tmp_path):
    """A merge may open an earlier one: then no word is cut and no two pairs are contracted at once."""
    import base64

    tokens = [bytes([byte]) for byte in range(256)] + [b"xx", b"xxx", b"ab", b"bc"]
    order = tokens[:256] + [b"abc", b"ab"]  # abc has the lower rank and comes from ab and c alone
    for name, chosen, sound in (("sound", tokens, True), ("unsound", order, False)):
        file = tmp_path / name
        file.write_bytes(b"".join(base64.b64encode(token) + b" %d\n" % rank for rank, token in enumerate(chosen)))
        own = RecursiveBpe(str(file), public_tokenizers.PATTERN)
        assert own.sound() == sound
        same(own, Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(str(file)), special_tokens={}), ["abcabxxxxx" * 40])


def test_cache_is_bounded(bpe, library):
    small = RecursiveBpe(FILE, public_tokenizers.PATTERN)
    small._known._limit = 2000
    for text in drawn_texts(50):
        same(small, library, [text])
        assert small._known._size <= 2000


def test_table(spark):
    rows = [(1, "One two", 5), (1, "One two", 5), (None, None, None), (2, "", 1), (3, "日本 <|endoftext|>", 2)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, IDS int").selectExpr("*", "7 AS decoded", "8 AS word")
    out = encode_documents(df, FILE, public_tokenizers.PATTERN, decoded=True)
    assert out.columns == ["doc_id", "text", "word", "ids", "decoded"]
    assert sorted((bytes(row.decoded).decode() for row in out.collect())) == sorted(text or "" for _, text, _ in rows)
    again = decode_documents(out.drop("decoded"), FILE, public_tokenizers.PATTERN)
    assert sorted(bytes(row.decoded).decode() for row in again.collect()) == sorted(text or "" for _, text, _ in rows)
    none = spark.createDataFrame([([1],), (None,), ([],)], "ids array<int>")
    assert {None if row.decoded is None else len(row.decoded) for row in decode_documents(none, FILE, public_tokenizers.PATTERN).collect()} == {None, 0, 1}
    assert encode_documents(df.limit(0), FILE, public_tokenizers.PATTERN).count() == 0


def test_query(spark, sf_dir, library):
    found = {tuple(row) for row in QUERIES["op13_recursive_bpe"](spark, sf_dir).collect()}
    want = set()
    for row in read_table(spark, f"{sf_dir}/documents.parquet").collect():
        ids, raw = library.encode_ordinary(row.text or ""), (row.text or "").encode()
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.add((row.doc_id, len(ids), digest, hashlib.sha256(raw).hexdigest()))
    assert found == want
