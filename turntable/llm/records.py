"""Token ids in length-delimited binary records, with an index of offsets for shuffled reads.

A record is: length (8 bytes), masked CRC-32C of these 8 bytes (4), payload, masked CRC-32C of the
payload (4); all numbers are little-endian. The payload is doc_id (8 bytes), a kind (1: bit 0 for a null
doc_id, bit 1 for ids of 4 bytes instead of 2), and the ids. Files hold the documents in ascending order
of doc_id. The index is a Parquet table: doc_id, part, file, place, offset, size, n_tokens.
"""

from __future__ import annotations

import os
import struct
import sys
import uuid
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turntable.llm.bytelevel import BYTE_OF
from turntable.llm.common import of_worker, ready_workers

# Fixed values of the record format: the reversed polynomial of CRC-32C, and the mask of stored checksums.
_POLYNOMIAL = 0x82F63B78
_MASK = 0xA282EAD8

_HEAD = struct.Struct("<QI")
_OWN = struct.Struct("<qB")
_BLOCK = 4096
READ_BYTES = 4 << 20
# Some 160 MB of a worker, for words of usual length; no other operator's tables stay beside them.
CACHED_PARTS = 1_000_000
CACHED_BYTES = 48
INDEX = "doc_id bigint, part int, file string, place bigint, offset bigint, size bigint, n_tokens bigint"

# Chunks hold no white space of ASCII. They are cut between a letter and a sign or digit of ASCII; the letters listed here
# are letters in every version of Unicode and stay single characters when they are folded (U+0130 does not).
_LAST_LETTER = "([a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f\u0400-\u0481\u048a-\u04ff])([!-;=-@\\[-`{-~])"
AT_ONCE = 128  # parts that the library gets as one text
_BETWEEN = "~"  # the piece between two of these; parts that hold it go alone


class RecordError(ValueError):
    """A record whose checksum or length does not fit."""


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The share of a byte that stands n bytes before the end of a block; and the step over a whole block."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, byte >> 1 ^ np.uint32(_POLYNOMIAL), byte >> 1)
    far = np.empty((_BLOCK, 256), dtype=np.uint32)
    far[0] = byte
    for n in range(1, _BLOCK):
        far[n] = byte[far[n - 1] & 0xFF] ^ far[n - 1] >> 8
    step = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32)[:, None])
    for _ in range(_BLOCK):
        step = byte[step & 0xFF] ^ step >> 8
    return far.ravel(), step


def masked_crc32c(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Masked CRC-32C of data[start:end] for separate runs of at least 4 bytes; `data` is an array of bytes.

    The checksum is linear: each byte has a share that depends on how far from the end it stands. Shares
    within a block are looked up and added (xor) for all runs at once; blocks are joined one by one.
    """
    far, step = _tables()
    data = data.copy()
    data[(np.asarray(starts)[:, None] + np.arange(4)).ravel()] ^= 0xFF
    out = np.empty(len(starts), dtype=np.uint32)
    for i, (start, end) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
        crc = 0
        at = start
        while at < end:
            stop = at + ((end - at) % _BLOCK or _BLOCK)
            shares = far.take(_ROWS[_BLOCK - (stop - at) :] + data[at:stop])
            if at > start:
                crc = int(step[0, crc & 255] ^ step[1, crc >> 8 & 255] ^ step[2, crc >> 16 & 255] ^ step[3, crc >> 24])
            crc ^= int(np.bitwise_xor.reduce(shares))
            at = stop
        crc ^= 0xFFFFFFFF
        out[i] = ((crc >> 15 | crc << 17) + _MASK) & 0xFFFFFFFF
    return out


_ROWS = 256 * np.arange(_BLOCK - 1, -1, -1, dtype=np.int32)


class Encoder:
    """A library tokenizer that keeps the ids of parts of texts it has met.

    Where a vocabulary drops white space, no token, special string or composed character crosses it, nor the
    end of a run of letters, so a text is encoded from such parts; where it also folds case, A-Z may be folded
    before. Arrow cuts the texts and puts the ids together; only parts not met before go to the library. For
    other vocabularies, and for special strings without "<|", the library encodes whole texts.
    """

    def __init__(self, file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(file)
        self._library.no_truncation()
        self._library.no_padding()
        self.width = 2 if self._library.get_vocab_size() <= 1 << 16 else 4
        ends = [self._ids([text])[0] for text in ("a", "b", " a\n  b ")]
        special = [token.content for token in self._library.get_added_tokens_decoder().values()]
        self._by_chunk = ends[0] + ends[1] == ends[2] and all("<|" in one and len(one.split()) == 1 for one in special)
        normal = self._library.normalizer
        self._folds = normal is not None and normal.normalize_str("AZ") == "az"
        self._parts: dict[bytes, bytes] = {}
        self._between = self._ids([_BETWEEN])[0]
        self._ends = self._ends_of_words()

    def _ids(self, texts: list[str]) -> list[bytes]:
        kind = "H" if self.width == 2 else "I"
        encoded = self._library.encode_batch_fast(texts, add_special_tokens=False)
        return [array(kind, one.ids).tobytes() for one in encoded]

    def _ends_of_words(self) -> np.ndarray | None:
        """Which ids end a piece, where the last one of each piece and no other does."""
        suffix = getattr(self._library.model, "end_of_word_suffix", None)
        vocabulary = self._library.get_vocab()
        if not suffix or not {one + suffix for one in BYTE_OF}.issubset(vocabulary):
            return None
        ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        ends[[number for spelling, number in vocabulary.items() if spelling.endswith(suffix)]] = True
        return ends

    def _together(self, parts: list[str], words: bool) -> tuple[dict[str, bytes], list[str]]:
        """Ids of parts that go to the library many at a time, and the parts of which it does not tell whose ids are whose.

        Each word has one id at least that ends a piece; where a group has as many as words, each has one. A
        known piece stands between two other parts, and they are told apart where its id comes out as often.
        """
        ids: dict[str, bytes] = {}
        rest: list[str] = []
        groups = [parts[at : at + AT_ONCE] for at in range(0, len(parts), AT_ONCE)]
        between = "\n" if words else f"\n{_BETWEEN}\n"
        for group, raw in zip(groups, self._ids([between.join(group) for group in groups]), strict=True):
            numbers = np.frombuffer(raw, dtype=f"u{self.width}")
            if words:
                starts = [0, *((np.flatnonzero(self._ends[numbers]) + 1) * self.width).tolist()]
                stops = starts[1:]
                starts.pop()
            else:
                at = np.flatnonzero(numbers == int.from_bytes(self._between, sys.byteorder))
                starts = [0, *((at + 1) * self.width).tolist()]
                stops = [*(at * self.width).tolist(), len(raw)]
            if len(stops) == len(group):
                ids.update((part, raw[start:stop]) for part, start, stop in zip(group, starts, stops, strict=True))
            else:
                rest += group
        return ids, rest

    def _ids_of_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of different texts that white space may be put around; short ones go to the library many at a time."""
        words, mixed, alone = [], [], []
        for part in parts:
            if len(part) > CACHED_BYTES:
                alone.append(part)
            elif self._ends is not None and part.isalpha():
                words.append(part)
            elif len(self._between) != self.width or _BETWEEN in part or "<" in part:
                alone.append(part)
            else:
                mixed.append(part)
        ids: dict[str, bytes] = {}
        for some, of_words in ((words, True), (mixed, False)):
            told, rest = self._together(some, of_words)
            ids.update(told)
            alone += rest
        ids.update(zip(alone, self._ids(alone), strict=True))
        return [ids[part] for part in parts]

    def _of_parts(self, parts: pa.Array) -> pa.Array:
        """Ids of different parts."""
        names, known = _lines(parts), self._parts
        ids = [known.get(name) for name in names]
        new = [at for at, one in enumerate(ids) if one is None]
        if new:
            if len(known) + len(new) > CACHED_PARTS:
                known.clear()
            texts = b"\n".join([names[at] for at in new]).decode().split("\n")
            for at, one in zip(new, self._ids_of_parts(texts), strict=True):
                ids[at] = one
                if len(names[at]) <= CACHED_BYTES and len(known) < CACHED_PARTS:
                    known[names[at]] = one
        return _binary(ids)

    def _of_chunks(self, chunks: pa.Array) -> pa.Array:
        """Ids of different chunks; one that may hold a special string is a part."""
        cut = pc.replace_substring_regex(chunks, pattern=_LAST_LETTER, replacement=r"\1 \2")
        parts = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(chunks, "<"), chunks, cut))
        different = parts.flatten().dictionary_encode()
        return _joined(self._of_parts(different.dictionary).take(different.indices), parts.offsets)

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text, `width` bytes each; a null text has none."""
        if not self._by_chunk:
            return self._ids([text or "" for text in (texts.to_pylist() if isinstance(texts, pa.Array) else texts)])
        column = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        if self._folds:  # special strings would come to be by folding
            column = pc.if_else(pc.match_substring(column, "<|"), column, pc.ascii_lower(column))
        chunks = pc.ascii_split_whitespace(column)
        different = chunks.flatten().dictionary_encode()
        return _joined(self._of_chunks(different.dictionary).take(different.indices), chunks.offsets).to_pylist()


def _lines(values: pa.Array) -> list[bytes]:
    """Strings without line breaks as a list; faster than one by one."""
    if not len(values):
        return []
    whole = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(pa.string()))
    return pc.binary_join(whole, "\n")[0].as_buffer().to_pybytes().split(b"\n")


def _binary(values: list[bytes]) -> pa.Array:
    ends = np.cumsum(np.fromiter(map(len, values), dtype=np.int64, count=len(values)))
    buffers = [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(b"".join(values))]
    return pa.Array.from_buffers(pa.large_binary(), len(values), buffers)


def _joined(values: pa.Array, offsets: pa.Array) -> pa.Array:
    """Values from one offset to the next as one; `values` is of large_binary, without nulls."""
    _, ends, data = values.buffers()
    at = np.frombuffer(ends, dtype=np.int64, count=len(values) + 1, offset=8 * values.offset) if len(values) else np.zeros(1, dtype=np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(at[offsets.to_numpy()]), data or pa.py_buffer(b"")])


def _encoder(file: str) -> Encoder:
    return of_worker(Encoder, file)


def _place(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """A file system that tasks can reach, and the path in it."""
    return pyarrow.fs.FileSystem.from_uri(regex.sub(r"^file:/+", "file:///", uri))


def _write(batches: Iterator[pa.RecordBatch], path: str, file: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """One task's records into one file; its rows of the index."""
    encoder, part, offset, place = _encoder(file), TaskContext.get().partitionId(), 0, 0
    end = int(end_id).to_bytes(encoder.width, "little")
    name = f"part-{part:06d}-{uuid.uuid4().hex}.rec"
    sink = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if sink is None:
            system, folder = _place(path)
            system.create_dir(folder, recursive=True)
            sink = system.open_output_stream(f"{folder}/{name}")
        ids = encoder.encode(batch.column(1))
        numbers = batch.column(0).to_pylist()
        wide = 2 * (encoder.width == 4)
        payloads = [_OWN.pack(number or 0, (number is None) | wide) + own + end for number, own in zip(numbers, ids, strict=True)]
        sizes = np.array([len(payload) for payload in payloads], dtype=np.int64)
        heads = sizes.astype("<u8").view(np.uint8)
        eights = 8 * np.arange(len(sizes) + 1)
        head_crc = masked_crc32c(heads, eights[:-1], eights[1:])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        crc = masked_crc32c(np.frombuffer(b"".join(payloads), dtype=np.uint8), bounds[:-1], bounds[1:])
        frames = []
        for payload, first, second in zip(payloads, head_crc.tolist(), crc.tolist(), strict=True):
            frames += [_HEAD.pack(len(payload), first), payload, second.to_bytes(4, "little")]
        sink.write(b"".join(frames))
        whole = sizes + 16
        at = offset + np.concatenate([[0], np.cumsum(whole)[:-1]])
        yield pa.record_batch({
            "doc_id": batch.column(0), "part": pa.array([part] * len(sizes), pa.int32()), "file": pa.array([name] * len(sizes)),
            "place": place + np.arange(len(sizes)), "offset": at.astype(np.int64), "size": whole,
            "n_tokens": (sizes - _OWN.size) // encoder.width,
        })
        offset += int(whole.sum())
        place += len(sizes)
    if sink is not None:
        sink.close()


def write_records(docs: DataFrame, path: str, file: str, end_id: int, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Encode the texts and write them below `path`; the index as a table, also kept at path/index.

    Each document ends with `end_id`; a null or empty text has that id alone. Documents lie in ascending
    order of id, null ids first, equal ids by their text. `path` is a URI or absolute path that all
    executors reach. Each task writes one new file and names it in the index, so files of lost or
    repeated attempts are never read. Texts are dealt by ranges of id and encoded once, after that.
    """
    ready_workers(docs.sparkSession)

    chosen = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).alias("_text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("_text")]
    dealt = chosen.repartitionByRange(*order).sortWithinPartitions(*order, "_text")
    dealt.mapInArrow(lambda batches: _write(batches, path, file, end_id), INDEX).write.parquet(f"{path}/index")
    return read_index(docs.sparkSession, path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{path}/index")


def _verified(data: np.ndarray, heads: list[int], sizes: list[int]) -> None:
    """Check the frames at `heads`, whose payloads have these sizes."""
    at, size = np.array(heads, dtype=np.int64), np.array(sizes, dtype=np.int64)
    stored = lambda places: np.ascontiguousarray(data[places[:, None] + np.arange(4)]).view("<u4").ravel()
    if (masked_crc32c(data, at, at + 8) != stored(at + 8)).any():
        raise RecordError("a record's length does not fit its checksum")
    if (masked_crc32c(data, at + 12, at + 12 + size) != stored(at + 12 + size)).any():
        raise RecordError("a record does not fit its checksum")


def _tokens(payload: bytes) -> tuple[int | None, bytes]:
    number, kind = _OWN.unpack_from(payload)
    ids = payload[_OWN.size :]
    return (None if kind & 1 else number), ids if kind & 2 else np.frombuffer(ids, dtype="<u2").astype("<u4").tobytes()


def _frames(source: pa.NativeFile) -> Iterator[list[bytes]]:
    """The payloads of a file, some READ_BYTES at a time; every frame is checked."""
    rest = b""
    while block := source.read(READ_BYTES):
        rest += block
        at, heads, sizes = 0, [], []
        while at + _HEAD.size <= len(rest):
            size = _HEAD.unpack_from(rest, at)[0]
            if size < _OWN.size or size > 1 << 40:
                raise RecordError("a record's length does not fit its checksum")
            if at + size + 16 > len(rest):
                break
            heads.append(at)
            sizes.append(size)
            at += size + 16
        if heads:
            _verified(np.frombuffer(rest, dtype=np.uint8), heads, sizes)
            yield [rest[head + 12 : head + 12 + size] for head, size in zip(heads, sizes, strict=True)]
            rest = rest[at:]
    if rest:
        raise RecordError("the last record is cut short")


def _read(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """The records of whole files."""
    for batch in batches:
        for row in batch.to_pylist():
            system, folder = _place(path)
            start = row["start"]
            with system.open_input_stream(f"{folder}/{row['file']}") as source:
                for payloads in _frames(source):
                    pairs = [_tokens(payload) for payload in payloads]
                    sizes = np.array([len(ids) // 4 for _, ids in pairs], dtype=np.int64)
                    starts = start + np.concatenate([[0], np.cumsum(sizes)[:-1]])
                    start += int(sizes.sum())
                    yield pa.record_batch({
                        "doc_id": pa.array([number for number, _ in pairs], pa.int64()),
                        "start": starts.astype(np.int64), "tokens": pa.array([ids for _, ids in pairs], pa.binary()),
                    })


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the files that the index names: doc_id, start (ids before it), tokens (uint32, little-endian).

    One task reads a file from front to back. Where it starts follows from the sums of the index, one row
    for each file. A frame that does not fit its checksums fails the job.
    """
    index = read_index(spark, path)
    files = index.groupBy("part", "file").agg(F.sum("n_tokens").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = files.select("file", F.coalesce(before, F.lit(0)).alias("start"))
    n_files = max(1, files.count())

    return starts.repartition(n_files, "file").mapInArrow(lambda batches: _read(batches, path), "doc_id bigint, start bigint, tokens binary")


def _seek(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Single records."""
    system, folder = _place(path)
    for batch in batches:
        pairs = []
        for file, offset, size in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            with system.open_input_file(f"{folder}/{file}") as source:
                frame = source.read_at(size, offset)
            _verified(np.frombuffer(frame, dtype=np.uint8), [0], [_HEAD.unpack_from(frame)[0]])
            pairs.append(_tokens(frame[12:-4]))
        yield pa.record_batch([pa.array([n for n, _ in pairs], pa.int64()), pa.array([ids for _, ids in pairs], pa.binary())], ["doc_id", "tokens"])


def read_at(index: DataFrame, path: str) -> DataFrame:
    """The records of some rows of the index, in the order of these rows: doc_id and tokens, as read_records gives them.

    For shuffled reads: order the index at random, and every task seeks its own records.
    """
    ready_workers(index.sparkSession)

    return index.select("file", "offset", "size").mapInArrow(lambda batches: _seek(batches, path), "doc_id bigint, tokens binary")
