"""Near-duplicate texts by MinHash bands, Bayesian pruning of candidates, and exact verification.

Texts with the same set of word shingles are one class. Classes that agree in a whole band of their signature
meet in a bucket. First each member of a bucket is compared with the bucket's pivot, its smallest id; members are dealt over
tasks and the pivot is copied to them. Linked members become one component. Buckets that then still hold several
components are cut into cells of bounded size, and within a cell all members of different components are compared, which
gives no pairs but the few links that join components. A candidate's signatures are compared batch by batch, and
it is dropped as soon as the posterior probability of a similarity of SIMILARITY is below MISS. What remains is verified on the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turntable.llm.common import ENTRY_BYTES, KNOWN_BYTES, map_batches, of_worker, ready_workers
from turntable.llm.components import components
from turntable.sources.tables import materialise

SHINGLE = 5
SIMILARITY = 0.75
ROWS = 5
BANDS = 40
HASHES = ROWS * BANDS
BATCH = 40
MISS = 1e-5
CELL_MEMBERS = 1024  # of a side of a cell
CELL_SHINGLES = 200_000  # of the sets of a side together, unless a single one has more
_PAIRS = 100_000  # compared at once
_WORD_BYTES = 64  # longer words are not kept

_MIX = np.uint64(0x9E3779B97F4A7C15)  # an odd constant that spreads bits


class _Words(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: bytes) -> int:
        made = xxhash.xxh3_64_intdigest(word)
        if len(word) <= _WORD_BYTES:
            if len(self) >= KNOWN_BYTES // (ENTRY_BYTES + _WORD_BYTES):
                self.clear()
            self[word] = made
        return made


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text (see near_duplicates)."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(of_worker(_Words).__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(SHINGLE, len(words))
    out = np.full(len(words) - size + 1, size if size < SHINGLE else 0, dtype=np.uint64)
    for i in range(size):
        out = (out ^ hashes[i : len(words) - size + 1 + i]) * _MIX
        out ^= out >> np.uint64(31)
    return np.unique(out)


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(7)
    turns = random.integers(0, 1 << 32, HASHES, dtype=np.uint32)
    factors = random.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return turns, factors


def signature(values: np.ndarray) -> np.ndarray:
    """HASHES minima of a set that is not empty."""
    turns, factors = _permutations()
    short = (values >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(short), 256):
        mixed = (short[at : at + 256, None] ^ turns) * factors
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        mixed ^= mixed >> np.uint32(12)
        np.minimum(least, mixed.min(axis=0), out=least)
    return least


def _buckets(least: np.ndarray) -> np.ndarray:
    """One number for each band and the values in it."""
    bands = least.reshape(BANDS, ROWS).astype(np.uint64)
    out = np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX
    for row in range(ROWS):
        out = (out ^ bands[:, row]) * _MIX
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


@lru_cache(maxsize=1)
def least_agreements() -> np.ndarray:
    """For each batch, how many of the hashes up to its end must agree for a candidate to stay.

    With every similarity equally likely beforehand, the probability of SIMILARITY or more after m agreements
    among n hashes is that of at most m successes in n + 1 trials with chance SIMILARITY.
    """
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, -1
        while total < MISS:
            m += 1
            total += comb(n + 1, m) * SIMILARITY**m * (1 - SIMILARITY) ** (n + 1 - m)
        out.append(m)
    return np.array(out)


def _digest(values: np.ndarray) -> bytes | None:
    """Of a set; null of the empty one."""
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None


def _sketch(df: DataFrame) -> DataFrame:
    """Per row of (id, text): id, set (its digest, null if empty), n, signature and buckets."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        digests, sizes, signatures, buckets = [], [], [], []
        for text in batch.column(1).to_pylist():
            values = shingles(text)
            sizes.append(len(values))
            digests.append(_digest(values))
            if not len(values):
                signatures.append(None)
                buckets.append(None)
                continue
            least = signature(values)
            # One byte of each minimum: unequal ones agree once in 256, which lets a candidate stay, never go.
            signatures.append((least & np.uint32(0xFF)).astype(np.uint8).tobytes())
            buckets.append(_buckets(least))
        columns = [batch.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64())]
        columns += [pa.array(signatures, pa.binary()), pa.array(buckets, pa.list_(pa.int64()))]
        return pa.record_batch(columns, ["id", "set", "n", "signature", "buckets"])

    return map_batches(df, work, "id bigint, set binary, n bigint, signature binary, buckets array<bigint>")


def _sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, n, signature, values) of the wanted (id, set, n, signature), from the text of the id that has this set."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = [shingles(text) for text in batch.column("text").to_pylist()]
        own = [i for i, (set_, digest) in enumerate(zip(values, batch.column("set").to_pylist(), strict=True)) if _digest(set_) == digest]
        rows = pa.array(own, pa.int64())
        kept = pa.array([values[i].view(np.int64) for i in own], pa.list_(pa.int64()))
        return pa.record_batch([*(batch.column(name).take(rows) for name in ("id", "n", "signature")), kept], ["id", "n", "signature", "values"])

    found = map_batches(texts.join(wanted, "id"), work, "id bigint, n bigint, signature binary, values array<bigint>")
    return found.dropDuplicates(["id"])


def _whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of sorted batches, regrouped so that no two tables share a key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        first = int(np.searchsorted(keys, keys[-1]))  # of the last key, which may go on
        if held and held[-1].column(key)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        if first:
            yield pa.Table.from_batches([*held, batch.slice(0, first)])
            held = []
        held.append(batch.slice(first))
    if held:
        yield pa.Table.from_batches(held)


class _Rows:
    """Members of some groups: sizes of their sets, signatures, and the sets if they are at hand."""

    def __init__(self, table: pa.Table) -> None:
        self.ids = table.column("id").to_numpy()
        self.n = table.column("n").to_numpy()
        self.signatures = np.frombuffer(b"".join(table.column("signature").to_pylist()), dtype=np.uint8).reshape(-1, HASHES)
        if "values" in table.column_names:
            lists = table.column("values").combine_chunks()
            self._values, self._ends = lists.values.to_numpy(), lists.offsets.to_numpy()

    def likely(self, x: np.ndarray, y: np.ndarray, bands: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of rows that size and posterior do not rule out; with `bands`, those that agree in no whole band before it."""
        # Sets can overlap by no more than the share of the smaller in the larger.
        alive = np.minimum(self.n[x], self.n[y]) >= SIMILARITY * np.maximum(self.n[x], self.n[y])
        x, y = x[alive], y[alive]
        if bands is not None:
            bands = bands[alive]
        agreed = np.zeros(len(x), dtype=np.int64)
        for i, least in enumerate(least_agreements()):
            part = slice(i * BATCH, (i + 1) * BATCH)
            same = self.signatures[x, part] == self.signatures[y, part]
            agreed += same.sum(axis=1)
            alive = agreed >= least
            if bands is not None:
                whole = same.reshape(len(x), BATCH // ROWS, ROWS).all(axis=2)
                before = np.arange(i * BATCH // ROWS, (i + 1) * BATCH // ROWS) < bands[:, None]
                alive &= ~(whole & before).any(axis=1)
                bands = bands[alive]
            x, y, agreed = x[alive], y[alive], agreed[alive]
        return x, y

    def linked(self, x: int, y: int) -> bool:
        """Whether the full sets of two rows are similar enough."""
        a, b = (self._values[self._ends[row] : self._ends[row + 1]] for row in (x, y))
        shared = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * shared >= round(100 * SIMILARITY) * (len(a) + len(b) - shared)


LINK = "a bigint, b bigint"


def _links(x: list[int], y: list[int]) -> pa.RecordBatch:
    low, high = np.minimum(x, y), np.maximum(x, y)
    return pa.record_batch([pa.array(low, pa.int64()), pa.array(high, pa.int64())], ["a", "b"])


def _verify_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of members with the pivot that was copied to them."""
    for table in _whole_groups(batches, "cell"):
        rows = _Rows(table)
        pivots = table.column("pivot").to_numpy()
        own = {number: row for row, number in enumerate(rows.ids.tolist()) if number == pivots[row]}
        x = np.flatnonzero(rows.ids != pivots)
        x, y = rows.likely(x, np.array([own[number] for number in pivots[x].tolist()], dtype=np.int64))
        found = [(a, b) for a, b in zip(x.tolist(), y.tolist(), strict=True) if rows.linked(a, b)]
        if found:
            a, b = np.array(found).T
            yield _links(rows.ids[a], rows.ids[b])


def _slot(number: str, shingles_: str) -> Column:
    """Parts that a group of so many members with so many shingles is cut into."""
    return F.greatest(F.ceil(F.col(number) / CELL_MEMBERS), F.ceil(F.col(shingles_) / CELL_SHINGLES), F.lit(1)).cast("bigint")


def _star_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between the members of buckets and the pivots of these."""
    near = F.least("n", "pivot_n") >= SIMILARITY * F.greatest("n", "pivot_n")
    stars = members.where((F.col("id") != F.col("pivot")) & near).select("pivot", "id", "n").distinct()
    slots = stars.groupBy("pivot").agg(F.count("*").alias("_m"), F.sum("n").alias("_n")).select("pivot", _slot("_m", "_n").alias("_slots"))
    dealt = stars.join(slots, "pivot").select("pivot", "id", F.pmod(F.xxhash64("id"), "_slots").alias("_slot"))
    copied = slots.select("pivot", F.col("pivot").alias("id"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_slots") - 1)).alias("_slot"))
    rows = dealt.union(copied).join(sets, "id").withColumn("cell", F.xxhash64("pivot", "_slot"))
    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(_verify_stars, LINK)


def _candidates(table: pa.Table, rows: _Rows) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one cell and different components that remain after pruning, each in one cell only."""
    cells, sides, bands, labels = (table.column(name).to_numpy() for name in ("cell", "side", "band", "component"))
    parted = np.flatnonzero(np.diff(cells)) + 1
    starts = np.concatenate([[0], parted])
    before = np.arange(len(cells)) - np.repeat(starts, np.diff(np.append(starts, len(cells))))
    ends = np.cumsum(before)
    at = 0
    while at < len(cells):
        done = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + _PAIRS, side="right")))
        n = before[at:stop]
        x = np.repeat(np.arange(at, stop), n)
        y = x - 1 - (np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n))
        met = (labels[x] != labels[y]) & ((sides[x] != sides[y]) | (sides[x] == _WITHIN))
        x, y = x[met], y[met]
        yield rows.likely(x, y, bands[x])
        at = stop


_WITHIN = 2  # side of the members of a cell that is not crossed by another part of its bucket


def _open_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of cells that have a candidate there."""
    for table in _whole_groups(batches, "cell"):
        rows, some = _Rows(table), np.zeros(table.num_rows, dtype=bool)
        for x, y in _candidates(table, rows):
            some[x] = some[y] = True
        if some.any():
            yield from table.select(["cell", "side", "band", "id", "component"]).filter(pa.array(some)).combine_chunks().to_batches()


def _verify_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between components that meet in a cell, no more than join them."""
    for table in _whole_groups(batches, "cell"):
        rows, labels = _Rows(table), table.column("component").to_pylist()
        least: dict[int, int] = {}

        def root(label: int) -> int:
            while (above := least.get(label, label)) != label:
                label = above
            return label

        found = []
        for x, y in _candidates(table, rows):
            for a, b in zip(x.tolist(), y.tolist(), strict=True):
                one, other = root(labels[a]), root(labels[b])
                if one != other and rows.linked(a, b):
                    least[max(one, other)] = min(one, other)
                    found.append((a, b))
        if found:
            a, b = np.array(found).T
            yield _links(rows.ids[a], rows.ids[b])


def _cell_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between different components of (bucket, band, id, n, component) rows with their bucket's size."""
    parts = _slot("_m", "_total")
    cut = members.withColumn("_parts", parts).withColumn("_part", F.pmod(F.xxhash64("id"), F.col("_parts")))
    cut = cut.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1)))
    cell = F.xxhash64("bucket", F.least("_part", "_other"), F.greatest("_part", "_other"))
    side = F.when(F.col("_part") == F.col("_other"), _WITHIN).otherwise((F.col("_part") > F.col("_other")).cast("int"))
    placed = cut.select(cell.alias("cell"), side.alias("side"), "band", "id", "component")
    signed = placed.join(sets.select("id", "n", "signature"), "id").repartition("cell").sortWithinPartitions("cell")
    shape = "cell bigint, side int, band int, id bigint, component bigint"
    some = materialise(signed.mapInArrow(_open_cells, shape))
    whole = some.join(sets, "id").repartition("cell").sortWithinPartitions("cell")
    return whole.mapInArrow(_verify_cells, LINK)


def _labels(members: DataFrame, sets: DataFrame) -> DataFrame | None:
    """(node, component) of ids that are linked with others, or None if none are."""
    stars = materialise(_star_links(members, sets))
    if stars.isEmpty():
        labelled = members.withColumn("component", F.col("id"))
    else:
        own = components(stars).select(F.col("node").alias("id"), "component")
        labelled = members.join(own, "id", "left").withColumn("component", F.coalesce("component", "id"))
    labelled = materialise(labelled)
    several = labelled.groupBy("bucket").agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
    several = several.where("_low < _high").select("bucket")
    more = materialise(_cell_links(labelled.join(several, "bucket", "left_semi"), sets))
    links = stars.union(more)
    return None if links.isEmpty() else components(links)


def near_duplicates(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Per id: n_shingles, component_id and kept.

    A-Z are lower-cased, words end at ASCII white space. The set of a text is its distinct runs of SHINGLE
    words; with fewer words, all of them as one. Without words (also null or empty) the set is empty and linked with nothing. Texts
    are linked if their sets overlap by SIMILARITY of their union or more; component_id is the smallest id
    reachable by links, kept marks that one. Ids are bigint; of rows with the same id the one with the smallest
    set digest counts, empty sets first, and rows with a null id give one row each with their own null component, kept. Other columns
    are not read; an empty table gives no rows.
    """
    ready_workers(df.sparkSession)
    texts = df.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))
    sketch = materialise(_sketch(texts))
    documents = sketch.where("id IS NOT NULL").groupBy("id").agg(F.min(F.struct("set", "n")).alias("_own"))
    documents = documents.select("id", "_own.set", "_own.n")
    classes = materialise(documents.where("set IS NOT NULL").groupBy("set").agg(F.min("id").alias("id")))
    # Of an id with several texts, only the row of its class counts.
    chosen = sketch.join(classes, ["id", "set"], "left_semi").dropDuplicates(["id", "set"])
    banded = chosen.select("id", "n", F.posexplode("buckets").alias("band", "bucket"))
    shared = banded.groupBy("bucket").agg(
        F.count("*").alias("_m"), F.sum("n").alias("_total"), F.min(F.struct("id", "n")).alias("_first")
    )
    shared = shared.where("_m > 1").select("bucket", "_m", "_total", F.col("_first.id").alias("pivot"), F.col("_first.n").alias("pivot_n"))
    members = materialise(banded.join(shared, "bucket"))
    wanted = chosen.select("id", "set", "n", "signature").join(members.select("id").distinct(), "id", "left_semi")
    sets = materialise(_sets(texts, wanted))
    labels = _labels(members, sets)

    result = documents.join(classes.select("set", F.col("id").alias("_class")), "set", "left")
    result = result.withColumn("_class", F.coalesce("_class", "id"))
    if labels is not None:
        result = result.join(labels.select(F.col("node").alias("_class"), "component"), "_class", "left")
    else:
        result = result.withColumn("component", F.lit(None).cast("bigint"))
    component = F.coalesce("component", "_class")
    nameless = sketch.where("id IS NULL").select("id", "n", F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    named = result.select("id", "n", component.alias("component_id"), (F.col("id") == component).alias("kept"))
    return named.union(nameless).select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), "component_id", "kept")


def drop_near_duplicates(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The rows of `df` with one document of each group of near duplicates, the one with the smallest id.

    Rows of the same id are one document, of which the row stays whose text near_duplicates took (of several such rows, the same
    one on every run). Rows with a null id all stay.
    """
    named = F.col(f"`{id_column}`")
    kept = near_duplicates(df, text, id_column).where(F.col("kept") & named.isNotNull())
    ids = materialise(kept.select(named.alias("_kept_id")))
    stays = df.join(ids, named.cast("bigint") == F.col("_kept_id"), "left_semi")
    repeated = materialise(df.where(named.isNotNull()).groupBy(named.cast("bigint").alias("_kept_id")).count().where("count > 1").select("_kept_id"))
    if not repeated.isEmpty():
        again = named.cast("bigint") == F.col("_kept_id")
        several = stays.join(repeated, again, "left_semi")
        row = several.select(F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("_row"), named.cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))
        row = row.withColumn("_hash", F.xxhash64(F.to_json("_row")))
        one = _with_digest(row).groupBy("id").agg(F.min_by("_row", F.struct("set", "_hash")).alias("_row")).select("_row.*")
        stays = stays.join(repeated, again, "left_anti").union(one)
    return stays.union(df.where(named.isNull()))


def _with_digest(rows: DataFrame) -> DataFrame:
    """Rows of (_row, id, text, _hash) with the digest of their set, empty bytes for the empty one."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        digests = [_digest(shingles(text)) or b"" for text in batch.column("text").to_pylist()]
        return pa.record_batch([*batch.columns, pa.array(digests, pa.binary())], [*batch.schema.names, "set"])

    return map_batches(rows, work, rows.select("*").schema.add("set", "binary"))
