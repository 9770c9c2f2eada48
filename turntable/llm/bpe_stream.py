"""Word BPE as a streaming transducer: tokens leave as soon as no later symbol can change them.

A merge can only be undone from the right, by a merge of lower rank that takes its last symbols first. That one may be
undone in the same way by one of still lower rank, and so on. The longest such chain follows from the merge list
(`lookahead`): with so many symbols read after it, a boundary is final, whatever comes. Each prefix of a
word has one last token (`Merges.beside`), so the boundaries are found by walking back from the last symbol read.
Tokens in front of the lookahead leave, most of them sooner; a word of any length needs room for the lookahead and a block.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from turntable.llm.bytelevel import BYTE_OF, Merges, spelled
from turntable.llm.classes import Folding, Pieces, tokenizers_members
from turntable.llm.common import Known, map_batches, of_worker

# Fixed value: the pieces of a text as the vocabulary's file defines them.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

BLOCK = 256
SEGMENT = 1 << 16  # characters of a text that are cut into pieces at once, up to the next white space
KNOWN_PIECES = 32 << 20  # bytes of each of two generations of known pieces
_BLANK = re.compile(r"\s")


class Word:
    """The state of the transducer inside one word."""

    def __init__(self, of: Transducer) -> None:
        self._of = of
        self._found = of.ending.iter("")
        self._read = 0  # symbols so far
        self._left = 0  # of these, symbols whose tokens have left
        self._last = [0]  # last token of each prefix from self._left on
        self._size = [0]
        self._tail = ""
        self._before = 0  # the last token that has left

    def feed(self, symbols: str) -> list[int]:
        """Take more symbols of the word; the tokens that have become stable."""
        known, beside, last, size, left = self._of.merges.known_beside, self._of.merges.beside, self._last, self._size, self._left
        done = -1
        self._found.set(symbols)  # positions go on from the last block
        for at, (n, token) in self._found:
            if at == done:
                continue
            start = at + 1 - n
            if start > left:
                before = last[start - left]
                apart = known.get((before, token))
                if not (beside(before, token) if apart is None else apart):
                    continue
            elif start < left or (left and not beside(self._before, token)):
                continue
            last.append(token)
            size.append(n)
            done = at
        self._read += len(symbols)
        if len(last) != self._read - left + 1:
            raise AssertionError("a prefix without a last token")
        self._tail = (self._tail + symbols)[-self._of.reach :]
        return self._stable()

    def _way(self, position: int) -> list[int]:
        """Boundaries from a position back to the last token that left, nearest first."""
        way = [position]
        while position > self._left:
            position -= self._size[position - self._left]
            way.append(position)
        return way

    def _stable(self) -> list[int]:
        """The tokens that nothing can change any more.

        Those are all that end before the lookahead. Whatever follows, the next boundary is one of the last `reach` positions:
        where the ways back from all of these have met already, tokens are stable sooner.
        """
        if self._read - self._left <= 2 * self._of.reach:
            return []
        way = self._way(self._read)
        final = self._read - 1 - self._of.lookahead  # the last symbol read may turn out to end the word
        common = set(way)
        for position in range(max(self._left, self._read - self._of.reach + 1), self._read):
            common.intersection_update(self._way(position))
        return self._leave(max(max(common), next((b for b in way if b <= final), self._left)))

    def _leave(self, boundary: int) -> list[int]:
        out = [self._last[end - self._left] for end in reversed(self._way(boundary)[:-1])]
        if out:
            self._before = out[-1]
            shift = boundary - self._left
            del self._last[1 : shift + 1], self._size[1 : shift + 1]
            self._left = boundary
        return out

    def finish(self) -> list[int]:
        """The word ends here: its remaining tokens."""
        of, n = self._of, self._read
        for size in range(min(len(self._tail), n - self._left), 0, -1):
            token = of.final.get(self._tail[-size:])
            if token is None:
                continue
            start = n - size
            before = self._before if start == self._left else self._last[start - self._left]
            if not start or of.merges.beside(before, token):
                return [*self._leave(start), token]
        raise AssertionError("no token ends this word")


class Transducer:
    """Text to token ids and back for one vocabulary file."""

    def __init__(self, file: str) -> None:
        from tokenizers import Tokenizer

        self.merges = Merges(file)
        suffix = self.merges.suffix
        self.final: dict[str, int] = {}
        self.ending = ahocorasick.Automaton()
        self.reach = 1
        for spelling, token in self.merges.whole().items():
            size = len(spelling) - len(suffix) * spelling.endswith(suffix)
            self.reach = max(self.reach, size)
            if suffix and spelling.endswith(suffix):
                self.final[spelling.removesuffix(suffix)] = token
            else:
                self.ending.add_word(spelling, (size, token))
                if not suffix:
                    self.final[spelling] = token
        self.ending.make_automaton()
        self.lookahead = self._lookahead()
        special = sorted(self.merges.special, key=len, reverse=True)
        self._special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self._fold = Folding(Tokenizer.from_file(file).normalizer.normalize_str)
        self._pieces = Pieces(PATTERN, tokenizers_members)
        self._known = Known(self._piece, KNOWN_PIECES)
        raw = {number: self._raw(number) for number in self.merges.spelling}
        self._bytes = [raw.get(number, b"") for number in range(max(raw) + 1)]
        self._spelled = [self.merges.spelling.get(number, "").encode() for number in range(max(raw) + 1)]

    def _size(self, token: int) -> int:
        return len(self.merges.spelling[token].removesuffix(self.merges.suffix) if self.merges.suffix else self.merges.spelling[token])

    def _lookahead(self) -> int:
        """Symbols after a boundary that decide whether it stays, at most.

        A merge that crosses the end of another one first joins a token that ends there, a suffix of it, with one that begins
        there. Going through the merges by rank, `beyond` has for each left half how far its merges so far can
        make a difference after its end: the right half, and what can undo that merge in turn.
        """
        beyond: dict[int, int] = {}
        most = 0
        for (left, right), _ in sorted(self.merges.merge.items(), key=lambda pair: pair[1]):
            made = self.merges.spelling[left] + self.merges.spelling[right]
            suffixes = (self.merges.id_of.get(made[at:]) for at in range(1, len(made)))
            own = max((beyond[token] for token in suffixes if token in beyond), default=0)
            beyond[left] = max(beyond.get(left, 0), self._size(right) + own)
            most = max(most, self._size(left) + self._size(right) - 1 + own)
        return most

    def _raw(self, number: int) -> bytes:
        """The bytes that a token stands for, with a space after a word."""
        spelling, suffix = self.merges.spelling[number], self.merges.suffix
        if spelling in self.merges.special:
            return spelling.encode()
        ends = bool(suffix) and spelling.endswith(suffix)
        return bytes(BYTE_OF[c] for c in (spelling.removesuffix(suffix) if ends else spelling)) + b" " * ends

    def word(self, symbols: str) -> list[int]:
        """Tokens of one word, fed in blocks."""
        state, out = Word(self), []
        for at in range(0, len(symbols), BLOCK):
            out += state.feed(symbols[at : at + BLOCK])
        return out + state.finish()

    def _piece(self, piece: str) -> bytes:
        return array("i", self.word(spelled(piece.encode()))).tobytes()

    def _segments(self, text: str) -> Iterator[str]:
        """The text in parts that end before white space, across which nothing composes or merges."""
        at = 0
        while at < len(text):
            blank = _BLANK.search(text, at + SEGMENT) if at + SEGMENT < len(text) else None
            stop = blank.start() if blank else len(text)
            yield text[at:stop]
            at = stop

    def _plain(self, text: str) -> bytes:
        """Ids of a text without special strings. White space only separates pieces, of whatever kind."""
        folded = self._fold(text)
        known = self._known
        return b"".join([known[piece] for piece in self._pieces.of(folded).findall(folded)])

    def ids(self, text: str) -> bytes:
        """Token ids of a text, as int32; strings of special tokens give their ids."""
        out = bytearray()
        for segment in self._segments(text):
            parts = self._special.split(segment) if self._special and "<" in segment else [segment]
            for at, part in enumerate(parts):
                out += array("i", [self.merges.special[part]]).tobytes() if at % 2 else self._plain(part)
        self._known.trim()
        return bytes(out)

    def encode(self, text: str) -> list[int]:
        """Token ids of a text."""
        return array("i", self.ids(text)).tolist()

    def decode(self, ids: Iterable[int], separated: bool = False) -> Iterator[str]:
        """Text of token ids, block by block; incomplete characters wait for their last byte.

        `separated` spells tokens as the vocabulary does, with a space between two of them, which is
        how its library decodes. Otherwise the bytes that tokens stand for come out, and a space after
        each word.
        """
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        table, gap = (self._spelled, b" ") if separated else (self._bytes, b"")
        ids = ids if isinstance(ids, list) else list(ids)
        for at in range(0, len(ids), BLOCK):
            raw = gap.join([table[number] for number in ids[at : at + BLOCK]])
            if text := machine.decode(gap + raw if at else raw):
                yield text
        if text := machine.decode(b"", final=True):
            yield text


def transducer(file: str) -> Transducer:
    return of_worker(Transducer, file)


def _lists(values: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(values) + 1, dtype=np.int32)
    np.cumsum([len(value) // 4 for value in values], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(values), dtype="<i4")))


def encode_documents(df: DataFrame, file: str, text: str = "text") -> DataFrame:
    """All columns of `df`, and ids (array<int>) and decoded (the ids decoded again, tokens apart by a space).

    A null or empty text, or one of white space alone, has no ids and decodes to the empty string. Rows
    are taken one by one: repeated rows and null ids stay. Columns named ids or decoded are replaced.
    One pass without a shuffle.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = transducer(file)
        ids = [coder.ids(value or "") for value in batch.column(text).to_pylist()]
        decoded = ["".join(coder.decode(array("i", own).tolist(), separated=True)) for own in ids]
        own = [batch.column(name) for name in kept]
        return pa.record_batch([*own, _lists(ids), pa.array(decoded, pa.string())], [*kept, "ids", "decoded"])

    kept = [name for name in df.columns if name.lower() not in ("ids", "decoded")]
    schema = df.select(*[F.col(f"`{name}`") for name in kept]).schema.add("ids", ArrayType(IntegerType())).add("decoded", StringType())
    return map_batches(df, work, schema)


def decode_documents(df: DataFrame, file: str, ids: str = "ids", decoded: str = "text") -> DataFrame:
    """`df` with the text of its token ids: the bytes they stand for, a space after each word. Null gives null."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        decode = transducer(file).decode
        texts = [None if one is None else "".join(decode(one)) for one in batch.column(ids).to_pylist()]
        return pa.record_batch([*[batch.column(name) for name in kept], pa.array(texts, pa.string())], [*kept, decoded])

    kept = [name for name in df.columns if name.lower() != decoded.lower()]
    return map_batches(df, work, df.select(*[F.col(f"`{name}`") for name in kept]).schema.add(decoded, StringType()))


def digests(encoded: DataFrame, id_column: str = "doc_id", keep: Sequence[str] = ()) -> DataFrame:
    """Per row its id, n_tokens, and the sha256 of the ids in decimal, one space apart, and of the decoded text; then the columns to `keep`."""
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        id_column,
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(decimal, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        *keep,
    )
