"""Exact token counts at every prefix of a text, so that budgets need no second encoding.

The last token of every prefix of a piece follows from those of its shorter prefixes: a token t ends
prefix i if it stays apart from the last token of prefix i - |t| (`Merges.beside`); exactly one token
does. count[i] = count[i - |t|] + 1 then holds the number of tokens at every prefix.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turntable.llm.bytelevel import Merges, spelled
from turntable.llm.classes import Pieces, tokenizers_members
from turntable.llm.common import ENTRY_BYTES, map_batches, of_worker, texts_of

# The pieces that a byte-level vocabulary of this kind never merges across, and the white
# space its pattern means (Python's own class also holds U+001C to U+001F).
_SPACE = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
_RUN = regex.compile(rf" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_BLANKS = regex.compile(rf"[{_SPACE}]+")
_PIECE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"

CACHED_CHARACTERS = 40
CACHED = (100 << 20) // (ENTRY_BYTES + CACHED_CHARACTERS)  # runs, and as many pieces


class PrefixCounts:
    """Counts for one vocabulary. Up to CACHED runs and pieces of text are kept."""

    def __init__(self, file: str) -> None:
        self._merges = Merges(file)
        self._pattern = Pieces(_PIECE, tokenizers_members)
        self._ending = ahocorasick.Automaton()
        for spelling, token in self._merges.whole().items():
            self._ending.add_word(spelling, (len(spelling), token))
        self._ending.make_automaton()
        special = sorted(self._merges.special, key=len, reverse=True)
        self._special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self._runs: dict[str, int] = {}
        self._pieces: dict[str, int] = {}

    def of_piece(self, piece: str) -> list[int]:
        """Tokens at every byte prefix of a piece, from the empty one on."""
        symbols = spelled(piece.encode())
        known, beside, done = self._merges.known_beside, self._merges.beside, -1
        last, count = [0], [0]
        for end, (size, token) in self._ending.iter(symbols):
            if end == done:
                continue
            if start := end + 1 - size:
                before = last[start]
                apart = known.get((before, token))
                if not (beside(before, token) if apart is None else apart):
                    continue
            last.append(token)
            count.append(count[start] + 1)
            done = end
        return count

    def _of_run(self, run: str) -> int:
        known, total = self._pieces, 0
        for piece in self._pattern.of(run).findall(run):
            n = known.get(piece)
            if n is None:
                n = self.of_piece(piece)[-1]
                if len(piece) <= CACHED_CHARACTERS:
                    if len(known) >= CACHED:
                        known.clear()
                    known[piece] = n
            total += n
        return total

    def _plain(self, text: str) -> int:
        known, total = self._runs, 0
        runs = _RUN.findall(text)
        for run in runs:
            n = known.get(run)
            if n is None:
                n = self._of_run(run)
                if len(run) <= CACHED_CHARACTERS:
                    if len(known) >= CACHED:
                        known.clear()
                    known[run] = n
            total += n
        return total

    def total(self, text: str) -> int:
        """Tokens of a whole text: the count at its last prefix."""
        if not self._special or "<" not in text:
            return self._plain(text)
        parts = self._special.split(text)
        return sum(map(self._plain, parts)) + len(parts) - 1

    def _plain_prefixes(self, text: str) -> np.ndarray:
        """Tokens at every character prefix of a text without special strings."""
        out = np.zeros(len(text) + 1, dtype=np.int64)
        at = base = 0
        for run in _RUN.findall(text):
            start, at = at, at + len(run)
            if _BLANKS.fullmatch(run):
                before = base
                base += self._of_run(run)
                # White space at the end of a prefix is one piece together with all of it before.
                first = start
                while first and _BLANKS.match(text[first - 1]):
                    first -= 1
                if first < start:
                    before = int(out[first])
                blanks = self._characters(text[first:at])
                out[start + 1 : at + 1] = before + blanks[start - first + 1 :]
                continue
            offset = start
            for piece in self._pattern.of(run).findall(run):
                counts = self._characters(piece)
                out[offset + 1 : offset + len(piece) + 1] = base + counts[1:]
                if piece in ("'re", "'ve", "'ll"):  # cut short, its letter is a piece of its own
                    out[offset + 2] = base + 2
                offset += len(piece)
                base += int(counts[-1])
            if run[0] == " " and start and _BLANKS.match(text[start - 1]):
                first = start
                while first and _BLANKS.match(text[first - 1]):
                    first -= 1
                out[start + 1] = out[first] + self.of_piece(text[first : start + 1])[-1]
        return out

    def _characters(self, piece: str) -> np.ndarray:
        ends = np.cumsum([0, *(len(character.encode()) for character in piece)])
        return np.asarray(self.of_piece(piece))[ends]

    def prefixes(self, text: str) -> np.ndarray:
        """Tokens of text[:i] for every i from 0 to its length."""
        out, base, at = [np.zeros(1, dtype=np.int64)], 0, 0
        for found in self._special.finditer(text) if self._special else ():
            own = self._plain_prefixes(text[at : found.end()])[1:]
            base_after = base + self._plain(text[at : found.start()]) + 1
            own = own + base
            own[-1] = base_after
            out.append(own)
            base, at = base_after, found.end()
        out.append(self._plain_prefixes(text[at:])[1:] + base)
        return np.concatenate(out)


def counter(file: str) -> PrefixCounts:
    return of_worker(PrefixCounts, file)


def count_tokens(df: DataFrame, file: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Per row its id, n_bytes (UTF-8) and n_tokens of the whole text.

    A null or empty text has 0 of both; a null id stays null; equal rows give equal rows. Other columns
    are not read. One pass without a shuffle.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = counter(file)
        texts = texts_of(batch, "_text")
        n_tokens = pa.array(map(counts.total, texts), pa.int64())
        return pa.record_batch([batch.column("_id"), batch.column("_bytes"), n_tokens], ["_id", "_bytes", "n"])

    chosen = df.select(
        F.col(id_column).alias("_id"),
        F.col(text).alias("_text"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("_bytes"),
    )
    kind = chosen.schema["_id"].dataType.simpleString()
    out = map_batches(chosen, work, f"_id {kind}, _bytes bigint, n bigint")
    return out.select(F.col("_id").alias(id_column), F.col("_bytes").alias("n_bytes"), F.col("n").alias("n_tokens"))


def prefix_table(df: DataFrame, file: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Per row its id and `counts`: the tokens of text[:i] for every i from 0 to the length of the text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = counter(file)
        lists = [counts.prefixes(value) for value in texts_of(batch, "_text")]
        return pa.record_batch([batch.column("_id"), pa.array(lists, pa.list_(pa.int64()))], ["_id", "counts"])

    chosen = df.select(F.col(id_column).alias("_id"), F.col(text).alias("_text"))
    kind = chosen.schema["_id"].dataType.simpleString()
    return map_batches(chosen, work, f"_id {kind}, counts array<bigint>").withColumnRenamed("_id", id_column)


def fit_budgets(table: DataFrame, budget: int) -> DataFrame:
    """Add n_fit to a prefix table: the longest prefix, in characters, of at most `budget` tokens.

    Counts are not monotone (a longer prefix may merge into fewer tokens), so the last prefix that fits
    is taken, whatever lies before it.
    """
    fits = F.transform("counts", lambda n, i: F.when(n <= budget, i))
    return table.withColumn("n_fit", F.coalesce(F.array_max(fits), F.lit(0)).cast("bigint"))
