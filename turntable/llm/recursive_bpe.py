"""Byte-level BPE by recursive queries: DuckDB contracts the token rows of words inside each task.

Spark deals the texts; a task cuts its texts into pieces by the vocabulary's pattern and asks DuckDB for pieces it has not met.
A row is a token at a place in a word. Each step joins neighbours with the merge table and contracts the
leftmost pair of minimum rank in every word; a word without a pair in the table is done. Decoding joins the ids
of a text with the vocabulary and aggregates the spellings in order.

A word of more than LONG bytes is cut into blocks that overlap by half. In a sound vocabulary a row of tokens is the encoding if
each two neighbours are (a later merge never opens an earlier one), so two blocks that share a token are joined there. Where
neighbours share none, which takes periodic text, the whole word is contracted, all leftmost pairs of the minimum rank at a time.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType

from turntable.llm.classes import Pieces, tiktoken_members
from turntable.llm.common import Known, map_batches, of_worker

LONG = 128
SYMBOLS = 400_000  # symbols of one query
TOKENS = 500_000  # tokens of one decoding query
_STEP = LONG // 2

_PAIRS = """
    SELECT s.*, m.id, m.size FROM (SELECT *, lead(token) OVER (PARTITION BY word ORDER BY pos) AS following FROM state WHERE NOT done) s
    LEFT JOIN merges m ON m.a = s.token AND m.b = s.following
"""

#: One contraction a step. `best` of a word is its leftmost pair of minimum rank: rank, place and size of the left half in one number.
LEFTMOST = """
WITH RECURSIVE state(word, pos, token, done, highest) AS (
    SELECT word, pos, token, false, -1 FROM symbols
    UNION ALL (
        WITH still AS (SELECT word, pos, token, highest FROM state WHERE NOT done),
        neighbours AS (SELECT word, pos, token, lead(token) OVER (PARTITION BY word ORDER BY pos) AS following FROM still),
        pairs AS (
            SELECT word, id::BIGINT * 549755813888 + pos::BIGINT * 256 + size AS pair
            FROM neighbours JOIN merges ON a = token AND b = following
        ),
        bests AS (SELECT word, min(pair) AS best FROM pairs GROUP BY word),
        named AS (SELECT word, best >> 39 AS made, (best >> 8) & 2147483647 AS place, best & 255 AS size FROM bests)
        SELECT word, pos, CASE WHEN pos = place THEN made::INTEGER ELSE token END, made IS NULL, greatest(highest, coalesce(made, -1)::INTEGER)
        FROM still LEFT JOIN named USING (word)
        WHERE made IS NULL OR pos <> place + size
    )
)
SELECT word, list(token ORDER BY pos) AS tokens, max(highest) AS highest FROM state WHERE done GROUP BY word ORDER BY word
"""

#: All pairs of minimum rank a step, from the left: of a run of such pairs that overlap, every second one.
TOGETHER = f"""
WITH RECURSIVE state(word, pos, token, done) AS (
    SELECT word, pos, token, false FROM symbols
    UNION ALL
    SELECT word, pos, CASE WHEN taken THEN made ELSE token END, made IS NULL
    FROM (
        SELECT *, lag(taken, 1, false) OVER (PARTITION BY word ORDER BY pos) AS gone
        FROM (
            SELECT *, coalesce(id = made, false) AND count(*) FILTER (id = made) OVER (PARTITION BY word, run ORDER BY pos) % 2 = 1 AS taken
            FROM (
                SELECT *, count(*) FILTER (id IS NULL OR id <> made) OVER (PARTITION BY word ORDER BY pos) AS run
                FROM (SELECT *, min(id) OVER (PARTITION BY word) AS made FROM ({_PAIRS}))
            )
        )
    )
    WHERE NOT gone
)
SELECT word, list(token ORDER BY pos) AS tokens, 0 AS highest FROM state WHERE done GROUP BY word ORDER BY word
"""

DECODE = "SELECT text, string_agg(spelling, '' ORDER BY pos) AS spelled FROM tokens JOIN vocabulary USING (id) GROUP BY text"


def read_ranks(file: str) -> dict[bytes, int]:
    """Rank, which is the id as well, of each token of a vocabulary file: base64 and rank on each line."""
    with open(file, "rb") as source:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, source)}
    if not all(bytes([byte]) in ranks for byte in range(256)):
        raise ValueError(f"{file} does not spell every byte")
    return ranks


class RecursiveBpe:
    """One vocabulary in an in-memory DuckDB, and ids of pieces met before."""

    def __init__(self, file: str, pattern: str) -> None:
        ranks = read_ranks(file)
        self._bytes = np.array([ranks[bytes([byte])] for byte in range(256)], dtype=np.int32)
        self._spelling = {rank: token for token, rank in ranks.items()}
        self._duck = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        if max(map(len, ranks)) > 255:
            raise ValueError(f"{file} has a token of more than 255 bytes")
        halves = [(ranks.get(token[:i]), ranks.get(token[i:]), rank, i) for token, rank in ranks.items() for i in range(1, len(token))]
        a, b, made, size = (pa.array(column, pa.int32()) for column in zip(*[pair for pair in halves if None not in pair], strict=True))
        self._table("merges", {"a": a, "b": b, "id": made, "size": size})
        # Bytes as the characters of the same number: the text type takes them all.
        spelled = pa.array([token.decode("latin-1") for token in ranks], pa.string())
        self._table("vocabulary", {"id": pa.array(ranks.values(), pa.int32()), "spelling": spelled})
        self._pieces = Pieces(pattern, tiktoken_members)
        self._known = Known()
        self._sound: bool | None = None

    def _table(self, name: str, columns: dict[str, pa.Array]) -> None:
        self._duck.register("_given", pa.table(columns))
        self._duck.execute(f"CREATE TABLE {name} AS SELECT * FROM _given")
        self._duck.unregister("_given")

    def _ask(self, query: str, name: str, columns: dict[str, np.ndarray]) -> pa.Table:
        self._duck.register(name, pa.table(columns))
        try:
            return self._duck.sql(query).to_arrow_table()
        finally:
            self._duck.unregister(name)

    def _contract(self, words: list[bytes], query: str = LEFTMOST) -> tuple[list[np.ndarray], list[int]]:
        """Ids of words that are not empty, and the highest rank contracted in each."""
        ids: list[np.ndarray] = []
        highest: list[int] = []
        at = 0
        while at < len(words):
            stop, size = at, 0
            while stop < len(words) and (stop == at or size + len(words[stop]) <= SYMBOLS):
                size += len(words[stop])
                stop += 1
            lengths = np.array([len(word) for word in words[at:stop]])
            starts = np.cumsum(lengths) - lengths
            found = self._ask(query, "symbols", {
                "word": np.repeat(np.arange(stop - at, dtype=np.int32), lengths),
                "pos": (np.arange(size) - np.repeat(starts, lengths)).astype(np.int32),
                "token": self._bytes[np.frombuffer(b"".join(words[at:stop]), dtype=np.uint8)],
            })
            lists = found.column("tokens").combine_chunks()
            flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
            ids += [flat[ends[i] : ends[i + 1]] for i in range(len(lists))]
            highest += found.column("highest").to_pylist()
            at = stop
        return ids, highest

    def sound(self) -> bool:
        """Whether each token comes from its own bytes by merges up to its own rank."""
        if self._sound is None:
            ranks = sorted(rank for rank, token in self._spelling.items() if len(token) > 1)
            ids, highest = self._contract([self._spelling[rank] for rank in ranks])
            self._sound = all(len(own) == 1 and most == rank for own, most, rank in zip(ids, highest, ranks, strict=True))
        return self._sound

    def _joined(self, blocks: list[np.ndarray]) -> np.ndarray | None:
        """Tokens of overlapping blocks as those of the whole, or None if two neighbours share none."""
        whole, ends = blocks[0], self._ends(blocks[0])
        out: list[np.ndarray] = []
        for i, block in enumerate(blocks[1:], 1):
            own = self._ends(block) + i * _STEP
            # A token is its end and its number: where both agree, it is the same token.
            place = np.searchsorted(ends, own)
            place[place == len(ends)] = 0
            same = np.flatnonzero((ends[place] == own) & (whole[place] == block))
            if not len(same):
                return None
            out.append(whole[: place[same[0]]])
            whole, ends = block[same[0] :], own[same[0] :]
        return np.concatenate([*out, whole])

    def _ends(self, tokens: np.ndarray) -> np.ndarray:
        return np.cumsum([len(self._spelling[token]) for token in tokens.tolist()])

    def _encoded(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of any words, long ones by their blocks."""
        parts: list[bytes] = []
        spans: list[tuple[int, int]] = []
        for word in words:
            first = len(parts)
            if len(word) <= LONG or not self.sound():
                parts.append(word)
            else:
                parts += [word[at : at + LONG] for at in range(0, len(word) - _STEP, _STEP)]
            spans.append((first, len(parts)))
        ids, _ = self._contract(parts)
        out = [ids[first] if last == first + 1 else self._joined(ids[first:last]) for first, last in spans]
        periodic = [i for i, own in enumerate(out) if own is None]
        for i, own in zip(periodic, self._contract([words[i] for i in periodic], TOGETHER)[0], strict=True):
            out[i] = own
        return out

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text, as int32."""
        split = [self._pieces.of(text).findall(text) for text in texts]
        known = self._known
        new = known.unknown(set().union(*split))
        known.add(dict(zip(new, [own.tobytes() for own in self._encoded([piece.encode() for piece in new])], strict=True)))
        out = [b"".join([known[piece] for piece in pieces]) for pieces in split]
        known.trim()
        return out

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """Bytes of each list of ids."""
        out, at = [b""] * len(ids), 0
        while at < len(ids):
            stop, size = at, 0
            while stop < len(ids) and (stop == at or size + len(ids[stop]) <= TOKENS):
                size += len(ids[stop])
                stop += 1
            lengths = [len(own) for own in ids[at:stop]]
            found = self._ask(DECODE, "tokens", {
                "text": np.repeat(np.arange(at, stop, dtype=np.int32), lengths),
                "pos": np.arange(size, dtype=np.int32), "id": np.concatenate(ids[at:stop]).astype(np.int32),
            })
            for text, spelled in zip(found.column("text").to_pylist(), found.column("spelled").to_pylist(), strict=True):
                out[text] = spelled.encode("latin-1")
            at = stop
        return out


def _bpe(file: str, pattern: str) -> RecursiveBpe:
    return of_worker(RecursiveBpe, file, pattern)


def _lists(values: list[bytes]) -> pa.Array:
    offsets = np.cumsum([0, *(len(value) // 4 for value in values)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(values), dtype="<i4")))


def _others(df: DataFrame, *replaced: str) -> list[str]:
    return [name for name in df.columns if name.lower() not in replaced]


def encode_documents(df: DataFrame, file: str, pattern: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """All columns of `df`, and ids (array<int>); with `decoded`, also the bytes of these ids, made from them.

    Pieces are the matches of `pattern`, each encoded by itself; special tokens are ordinary text. A null or empty
    text has no ids and decodes to no bytes. Rows are taken one by one: repeated rows and null ids stay, an empty table
    gives none. Columns named ids (or decoded, if asked for) are replaced. One pass without a shuffle.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = _bpe(file, pattern)
        ids = bpe.encode([value or "" for value in batch.column(text).to_pylist()])
        columns = [*(batch.column(name) for name in kept), _lists(ids)]
        if decoded:
            columns.append(pa.array(bpe.decode([np.frombuffer(own, dtype="<i4") for own in ids]), pa.binary()))
        return pa.record_batch(columns, [*kept, *made])

    made = ["ids", "decoded"] if decoded else ["ids"]
    kept = _others(df, *made)
    schema = df.select(*[F.col(f"`{name}`") for name in kept]).schema.add("ids", ArrayType(IntegerType()))
    return map_batches(df, work, schema.add("decoded", BinaryType()) if decoded else schema)


def decode_documents(df: DataFrame, file: str, pattern: str, ids: str = "ids") -> DataFrame:
    """All columns of `df`, and decoded: the bytes of its token ids. Null gives null; a column named decoded is replaced."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(ids).to_pylist()
        made = _bpe(file, pattern).decode([np.array(own or [], dtype=np.int32) for own in lists])
        values = pa.array([None if own is None else one for own, one in zip(lists, made, strict=True)], pa.binary())
        return pa.record_batch([*(batch.column(name) for name in kept), values], [*kept, "decoded"])

    kept = _others(df, "decoded")
    return map_batches(df, work, df.select(*[F.col(f"`{name}`") for name in kept]).schema.add("decoded", BinaryType()))


def digests(coded: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per row its id, n_tokens, and the sha256 of the ids in decimal, a comma apart, and of the decoded bytes."""
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        id_column,
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(decimal, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
