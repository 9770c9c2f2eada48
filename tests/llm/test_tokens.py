"""Token counts, the word transducer and binary records against the library."""

import gc
import hashlib
import random
import time
import weakref
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from tokenizers import Tokenizer

from tests.llm.drawn import all_code_points, drawn_texts
from turntable.llm.bpe_stream import PATTERN, Transducer, Word, decode_documents, digests, encode_documents
from turntable.llm import records
from turntable.llm.bytelevel import Merges
from turntable.llm.classes import holds_any, in_ascii
from turntable.llm.queries import QUERIES
from turntable.llm.records import Encoder, RecordError, masked_crc32c, read_at, read_index, read_records, write_records
from turntable.llm.token_counts import PrefixCounts, count_tokens, fit_budgets, prefix_table

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "b", "the", " and", "ing", "aaaa", " ", "  ", "\n", "\t", "  \n ", "'re", "'ve", "'s", "'", "!", "9", "12", "é", "é", "日本", "　", "\x1c", "́"]
PARTS += ["<|endoftext|>", "<|startoftext|>", "<|endo", "Σ", "İ", "ß", "ABC", "क़"]
EDGES = [(1, None), (None, ""), (3, " \n\t "), (4, "x" * 3000), (5, "same"), (5, "same"), (6, "<|endoftext|> x")]


def texts(n, longest=14):
    draw = random.Random(1)
    return ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, longest))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def test_every_code_point_as_the_library_has_it(library):
    """Letters, numbers and folding are those of the library, whatever Unicode version the other modules have."""
    some, of_bytes = all_code_points() + drawn_texts(4000), Tokenizer.from_file(BYTES)
    wanted = [one.ids for one in library.encode_batch(some, add_special_tokens=False)]
    transducer, counts = Transducer(WORDS), PrefixCounts(BYTES)
    assert [text[:50] for text, ids in zip(some, wanted, strict=True) if transducer.encode(text) != ids] == []
    found = [np.frombuffer(ids, "<u2").tolist() for ids in Encoder(WORDS).encode(some)]
    assert [text[:50] for text, a, b in zip(some, found, wanted, strict=True) if a != b] == []
    n = [len(one.ids) for one in of_bytes.encode_batch(some, add_special_tokens=False)]
    assert [text[:50] for text, one in zip(some, n, strict=True) if counts.total(text) != one] == []


def test_patterns_in_ascii():
    draw = random.Random(6)
    for pattern in (PATTERN, public_tokenizers.PATTERN, r"[^\s\p{L}\]x]+|\p{N}"):
        for _ in range(300):
            text = "".join(chr(draw.choice([*range(128), 32, 32, 39, 97, 115])) for _ in range(40))
            assert in_ascii(pattern).findall(text) == regex.findall(pattern, text)


def test_characters_are_looked_up_whatever_their_plane():
    """A search costs much the same for one character and for thousands of ranges that reach beyond the first plane."""
    draw = random.Random(9)
    for span in (range(0x80, 0xD800, 50), range(0x10000, 0x30000, 50), range(0x80, 0x30000, 50), ()):
        characters = {chr(code) for code in span if not 0xD800 <= code < 0xE000}
        holds = holds_any(characters)
        for _ in range(300):
            text = "".join(chr(draw.choice([65, draw.randrange(0x80, 0x800), draw.randrange(0x10000, 0x11000)])) for _ in range(draw.randint(0, 9)))
            assert holds(text) == (not characters.isdisjoint(text))

    def took(holds, text):
        times = []
        for _ in range(5):
            start = time.process_time()
            assert not holds(text)
            times.append(time.process_time() - start)
        return min(times)

    many, one = holds_any(chr(code) for code in range(0xE000, 0x30000, 50)), holds_any("\U0010ffff")
    for text in ("é" * 100_000, "é" * 100_000 + "\U0001f44d" * 1000):
        assert took(many, text) < 20 * took(one, text) + 0.001


def test_lookahead_is_enough():
    """Nothing that follows changes the boundaries in front of the lookahead, and words of any length keep to it."""
    transducer, draw = Transducer(WORDS), random.Random(8)
    assert transducer.reach < transducer.lookahead < 1000
    for letters in ("aeinrst", "abab", "xyzq", "aaab"):
        word = "".join(draw.choices(letters, k=3000))
        ends = np.cumsum([len(transducer.merges.spelling[token].removesuffix("</w>")) for token in transducer.word(word)]).tolist()
        for cut in (1000, 1700, 2400):
            final = cut - 1 - transducer.lookahead
            own = np.cumsum([len(transducer.merges.spelling[token].removesuffix("</w>")) for token in transducer.word(word[:cut])]).tolist()
            assert [end for end in own if end <= final] == [end for end in ends if end <= final]


def test_long_texts_are_cut_at_white_space(library):
    transducer = Transducer(WORDS)
    long = " ".join(drawn_texts(9000, seed=4)) + " " + "y" * 200_000 + " <|endoftext|> end"
    assert len(list(transducer._segments(long))) > 2 and "".join(transducer._segments(long)) == long
    assert transducer.encode(long) == library.encode(long, add_special_tokens=False).ids


def test_counts_at_every_prefix():
    counts, library = PrefixCounts(BYTES), Tokenizer.from_file(BYTES)
    for text in texts(300):
        wanted = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert counts.prefixes(text).tolist() == wanted, text
        assert counts.total(text) == wanted[-1]


def test_transducer_equals_library(library):
    transducer = Transducer(WORDS)
    for text in texts(1500) + texts(30, 400) + ["".join(random.Random(2).choices(["a", "the", "ing", "zq"], k=4000))]:
        wanted = library.encode(text, add_special_tokens=False).ids
        assert transducer.encode(text) == wanted, text
        assert "".join(transducer.decode(wanted, separated=True)) == library.decode(wanted, skip_special_tokens=False)


def test_transducer_keeps_little():
    transducer, draw = Transducer(WORDS), random.Random(3)
    word, held = Word(transducer), 0
    for _ in range(5000):
        word.feed(draw.choice(["a", "the", "ing", "e", "zq"]))
        held = max(held, len(word._last))
    assert held <= 4 * transducer.reach < transducer.lookahead
    assert "".join(transducer.decode(transducer.encode("Héllo 日本"))) == "héllo 日本 "


def test_record_encoder_equals_library(library):
    some = texts(1500)
    found = Encoder(WORDS).encode(some)
    assert [np.frombuffer(ids, "<u2").tolist() for ids in found] == [library.encode(t, add_special_tokens=False).ids for t in some]


def test_checksums():
    data = np.frombuffer(b"123456789" + b"\0" * 32, dtype=np.uint8)
    crc = masked_crc32c(data, np.array([0, 9]), np.array([9, 41])).tolist()
    unmasked = [((value - 0xA282EAD8) % 2**32) for value in crc]
    assert [(value >> 17 | value << 15) % 2**32 for value in unmasked] == [0xE3069283, 0x8A9136AA]


def test_edges(spark):
    df = spark.createDataFrame(EDGES, "doc_id bigint, text string").selectExpr("*", "text AS n", "doc_id AS ids", "1 AS _id")
    counted = {(row.doc_id, row.n_bytes, row.n_tokens) for row in count_tokens(df, BYTES).collect()}
    assert {(1, 0, 0), (None, 0, 0), (5, 4, 1)} <= counted
    assert count_tokens(df.limit(0), BYTES).count() == 0
    encoded = encode_documents(df, WORDS)
    assert encoded.count() == len(EDGES)
    assert digests(encode_documents(df.limit(0), WORDS)).count() == 0
    rows = {row.doc_id: row for row in digests(encoded).collect()}
    assert rows[3].n_tokens == 0 and rows[3].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    assert rows[6].n_tokens == 2
    assert decode_documents(encoded, WORDS, decoded="again").where("doc_id = 5").first().again == "same "


def test_budgets(spark):
    df = spark.createDataFrame([(1, "some words here"), (2, None)], "doc_id bigint, text string")
    fits = {row.doc_id: row.n_fit for row in fit_budgets(prefix_table(df, BYTES), 2).collect()}
    assert fits == {1: len("some words"), 2: 0}


def test_records(spark, tmp_path, library):
    df = spark.createDataFrame(EDGES, "doc_id bigint, text string")
    index = write_records(df, str(tmp_path / "all"), WORDS, 1)
    rows = read_records(spark, str(tmp_path / "all")).orderBy("start").collect()
    ordered = sorted(EDGES, key=lambda row: (row[0] is not None, row[0] or 0))
    assert [row.doc_id for row in rows] == [number for number, _ in ordered]
    wanted = [[*library.encode(text or "", add_special_tokens=False).ids, 1] for _, text in ordered]
    assert [np.frombuffer(row.tokens, "<u4").tolist() for row in rows] == wanted
    assert [row.start for row in rows] == np.cumsum([0, *map(len, wanted)])[:-1].tolist()
    one = read_at(index.where("doc_id = 4"), str(tmp_path / "all")).first()
    assert np.frombuffer(one.tokens, "<u4").tolist() == wanted[[n for n, _ in ordered].index(4)]
    write_records(df.limit(0), str(tmp_path / "none"), WORDS, 1)
    assert read_records(spark, str(tmp_path / "none")).count() == 0


def test_damaged_record(spark, tmp_path):
    write_records(spark.createDataFrame([(1, "abc")], "doc_id bigint, text string"), str(tmp_path / "r"), WORDS, 1)
    file = next((tmp_path / "r").glob("*.rec"))
    raw = bytearray(file.read_bytes())
    raw[-6] ^= 1
    file.write_bytes(raw)
    with pytest.raises(Exception, match=RecordError.__name__):
        read_records(spark, str(tmp_path / "r")).collect()


def test_queries(spark, sf_dir, library):
    documents = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    ids = {n: library.encode(text or "", add_special_tokens=False).ids for n, text in documents.items()}
    count = Tokenizer.from_file(BYTES)
    for row in QUERIES["op4_token_counts"](spark, sf_dir).collect():
        n = len(count.encode(documents[row.doc_id] or "", add_special_tokens=False).ids)
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len((documents[row.doc_id] or "").encode()), n, n > 1024)
    start = 0
    for row in QUERIES["op8_binary_records"](spark, sf_dir).orderBy("doc_id").collect():
        own = [*ids[row.doc_id], 1]
        assert (row.start, row.n_tokens) == (start, len(own))
        assert row.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        start += len(own)
    for row in QUERIES["op9_bpe_stream"](spark, sf_dir).collect():
        own = ids[row.doc_id]
        assert row.n_tokens == len(own)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, own)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(own, skip_special_tokens=False).encode()).hexdigest()


def test_merges_go_with_their_operator():
    """What a worker has of a vocabulary is freed when another operator drops it."""
    merges = Merges(WORDS)
    assert "the</w>" in merges.whole()
    held = weakref.ref(merges)
    del merges
    gc.collect()
    assert held() is None


def test_short_parts_go_to_the_library_together():
    class Counted(Encoder):
        asked = 0

        def _ids(self, texts):
            self.asked += len(texts)
            return super()._ids(texts)

    draw = random.Random(3)
    words = {"".join(draw.choices("abcdefghéüñ", k=draw.randint(3, 9))) for _ in range(4000)}
    some = [*(f"{word}," for word in words), "a 0 b", "0", "00", "x0y", "\u0338a", "a\u0338b", "\xa0", "<|endoftext|>", "İ,", "क़,", "z" * 500]
    encoder = Counted(WORDS)
    before = encoder.asked
    found = [np.frombuffer(ids, "<u2").tolist() for ids in encoder.encode(some)]
    library = Tokenizer.from_file(WORDS)
    assert found == [one.ids for one in library.encode_batch(some, add_special_tokens=False)]
    assert encoder.asked - before < len(words) / 20


def test_words_go_to_the_library_with_nothing_between():
    class Counted(Encoder):
        given = 0

        def _ids(self, texts):
            ids = super()._ids(texts)
            self.given += sum(map(len, ids)) // self.width
            return ids

    letters = "abcdefghijklmnopqrstuvwxyzéü"
    words = [a + b for a in letters for b in letters]
    encoder = Counted(WORDS)
    before = encoder.given
    found = encoder.encode([" ".join(f"{word}," for word in words)])
    wanted = Tokenizer.from_file(WORDS).encode(" ".join(f"{word}," for word in words), add_special_tokens=False).ids
    assert np.frombuffer(found[0], "<u2").tolist() == wanted
    assert encoder.given - before < 1.1 * (len(wanted) - len(words))


def test_record_encoder_takes_arrow_and_forgets(library, monkeypatch):
    """Slices and nulls of a column, and parts that do not fit the table of known ones."""
    draw = random.Random(7)
    odd = ["Étre", "é,", "İ,", "ß.", "Я,", "й-", "~", "a~b", "`", "\u1fef", "0", "a0b", "don't", "A'S", "x\u0308,", "ǅ1", "z" * 60, "\u02b0", "\u3164"]
    odd += ["<b", "a<|b", "<|ENDOFTEXT|>,", "<|endoftext|>,"]
    some = [None, "", " "] + [draw.choice(["", " ", "\x1c", "\xa0", "\n"]).join(draw.choices(odd, k=draw.randint(1, 6))) for _ in range(3000)]
    wanted = [library.encode(text or "", add_special_tokens=False).ids for text in some]
    for most in (records.CACHED_PARTS, 40):
        monkeypatch.setattr(records, "CACHED_PARTS", most)
        encoder, found = Encoder(WORDS), []
        column = pa.array(["unused", *some, "unused"])
        for at in range(0, len(some), 251):
            found += encoder.encode(column.slice(at + 1, min(251, len(some) - at)))
        assert [text for text, ids, own in zip(some, found, wanted, strict=True) if np.frombuffer(ids, "<u2").tolist() != own] == []
        assert len(encoder._parts) <= most
    assert encoder.encode([]) == encoder.encode(column.slice(0, 0)) == []
