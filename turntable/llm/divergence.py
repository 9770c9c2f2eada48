"""How far the sources of a language use its terms differently, from a frequent-pattern tree of term rows.

A term row holds, in order of source, the sources that use a term and how often. A divergence sums a function
of two smoothed shares over all terms, and most terms are absent from most sources. So the sum is taken for
absence everywhere at first, then corrected per source for the counts it has, then per pair of sources for
terms that both have. The pairs come from a prefix tree: rows are inserted with their multiplicity, rows that begin alike share
nodes, and a node's count corrects each (node, ancestor) combination once. Sorted rows are the tree in
depth-first order, so a task builds it block by block; a node that two blocks share is counted in parts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turntable.llm.common import ready_workers
from turntable.operators.joins import fan_out_join
from turntable.operators.ranking import top_n
from turntable.sources.tables import materialise

MIN_DOCUMENTS = 10
TOP = 10
SCALE = 1_000_000_000
# Bytes of terms, A-Z as a-z; what is no letter of ASCII and no part of other characters separates them.
_LETTERS = bytes(byte + 32 if 65 <= byte <= 90 else byte if 97 <= byte <= 122 or byte > 127 else 32 for byte in range(256))
ENTRIES = 500_000  # (language, source, term) counts that a task holds before it hands them on
NODES = 400_000  # entries of paths that are inserted into a tree at once
_COMBINATIONS = 250_000  # nodes and ancestors that are worked on at once


def _quotient(a: Column, b: Column) -> Column:
    """Whole quotient, exact in whole numbers and decimals."""
    return F.call_function("div", a, b)


def _share(count: Column, size: Column, kept: Column) -> Column:
    """Smoothed share of a count among `size`, in units of 1 / SCALE; null if the language keeps no term."""
    whole = (size + 2 * kept).cast("decimal(20,0)")
    scaled = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    return 1 + _quotient(scaled, F.when(whole > 0, whole))


def _apart(p: Column, q: Column) -> Column:
    return _quotient((p - q) * (p - q), p + q)


def _apart_whole(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class _Counts:
    """Occurrences and documents of terms by language and source."""

    def __init__(self) -> None:
        self._groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        self.entries = 0

    def add(self, lang: str, source: str, text: str) -> None:
        terms = text.encode().translate(_LETTERS).split()
        occurrences, documents = self._groups.setdefault((lang, source), (Counter(), Counter()))
        before = len(occurrences)
        occurrences.update(terms)
        documents.update(set(terms))
        self.entries += len(occurrences) - before

    def rows(self) -> pa.RecordBatch:
        """What has been counted since the last call."""
        langs, sources, terms, n, documents = [], [], [], [], []
        for (lang, source), (occurrences, held) in self._groups.items():
            langs += [lang] * len(occurrences)
            sources += [source] * len(occurrences)
            terms += occurrences
            n += occurrences.values()
            documents += map(held.__getitem__, occurrences)
        self._groups, self.entries = {}, 0
        return pa.record_batch(
            [pa.array(langs, pa.string()), pa.array(sources, pa.string()), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()),
             pa.array(documents, pa.int64())], ["lang", "source", "term", "n", "documents"],
        )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = _Counts()
    for batch in batches:
        for row in zip(*(batch.column(name).to_pylist() for name in ("lang", "source", "text")), strict=True):
            counts.add(*row)
            if counts.entries > ENTRIES:
                yield counts.rows()
    yield counts.rows()


def term_rows(texts: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Per (lang, term) of at least `min_documents` rows of (lang, source, text): total and path, its (source, n) in order.

    Counts are combined in each task before they move. They move once: dealt by language and term, the sources of a term lie together.
    """
    ready_workers(texts.sparkSession)
    each = texts.mapInArrow(_count, "lang string, source string, term string, n bigint, documents bigint")
    counted = each.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("_documents"))
    rows = counted.groupBy("lang", "term").agg(
        F.sum("_documents").alias("_documents"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("_path")
    )
    return rows.where(F.col("_documents") >= min_documents).select("lang", "term", "total", F.sort_array("_path").alias("path"))


class Tree:
    """A prefix tree of sorted paths, as arrays over the entries of all paths one after another.

    The entry at depth d of a path is a node of its own if the path parts from the one before at d or
    above; its ancestors are the entries before it in the same path, and its count is that of all rows until a path parts
    there again.
    """

    def __init__(self, starts: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> None:
        """`starts` has the first entry of each path and the end of the last; `keys` tell entries apart; `counts` are of paths."""
        first, lengths = starts[:-1], np.diff(starts)
        shared = np.zeros(len(first), dtype=np.int64)
        alive = np.arange(1, len(first))
        depth = 0
        while len(alive):
            alive = alive[(lengths[alive] > depth) & (lengths[alive - 1] > depth)]
            alive = alive[keys[first[alive] + depth] == keys[first[alive - 1] + depth]]
            depth += 1
            shared[alive] = depth
        until = np.concatenate([[0], np.cumsum(counts)])
        nodes, depths, totals = [], [], []
        for depth in range(int(lengths.max(initial=0))):
            parted = np.flatnonzero(shared <= depth)
            own = np.diff(until[np.append(parted, len(first))])
            there = lengths[parted] > depth
            nodes.append(first[parted[there]] + depth)
            totals.append(own[there])
            depths.append(np.full(len(totals[-1]), depth))
        none = np.zeros(0, dtype=np.int64)
        self.nodes, self.depths, self.counts = (np.concatenate([none, *parts]).astype(np.int64) for parts in (nodes, depths, totals))

    def combinations(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Blocks of entries of nodes, entries of their ancestors, and the nodes' counts: each combination once."""
        ends = np.cumsum(self.depths)
        at = 0
        while at < len(ends):
            done = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, done + _COMBINATIONS, side="right")))
            depths = self.depths[at:stop]
            node = np.repeat(self.nodes[at:stop], depths)
            above = np.arange(len(node)) - np.repeat(np.cumsum(depths) - depths, depths)
            yield node, node - np.repeat(depths, depths) + above, np.repeat(self.counts[at:stop], depths)
            at = stop


def _corrections(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Sums by language and pair of sources over the tree of some sorted rows."""
    table = pa.Table.from_batches(batches).combine_chunks()
    paths = table.column("path").combine_chunks()
    starts = paths.offsets.to_numpy().astype(np.int64)
    source, n, p, absent = paths.values.flatten()
    names = source.dictionary_encode()
    source, n, p, absent = (column.to_numpy() for column in (names.indices, n, p, absent))
    langs = table.column("lang").combine_chunks().dictionary_encode()
    of_row = langs.indices.to_numpy().astype(np.int64)
    lang = np.repeat(of_row, np.diff(starts))
    source = lang * len(names.dictionary) + source
    keys = np.unique(np.stack([source, n]), axis=1, return_inverse=True)[1].ravel() if len(n) else source
    tree = Tree(starts, keys, table.column("rows").to_numpy())
    pairs, sums = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for node, above, count in tree.combinations():
        if not len(node):
            continue
        both = _apart_whole(p[above], p[node]) - _apart_whole(p[above], absent[node])
        both += _apart_whole(absent[above], absent[node]) - _apart_whole(absent[above], p[node])
        pair = source[above] * (len(names.dictionary) * len(langs.dictionary)) + source[node]
        found, place = np.unique(pair, return_inverse=True)
        order = np.argsort(place, kind="stable")
        pairs.append(found)
        sums.append(np.add.reduceat((both * count)[order], np.searchsorted(place[order], np.arange(len(found)))))
    pair, value = np.concatenate(pairs), np.concatenate(sums)
    a, b = np.divmod(pair, max(1, len(names.dictionary) * len(langs.dictionary)))
    own, a = np.divmod(a, max(1, len(names.dictionary)))
    b = b % max(1, len(names.dictionary))
    columns = [langs.dictionary.take(pa.array(own)), names.dictionary.take(pa.array(a)), names.dictionary.take(pa.array(b)), pa.array(value)]
    return pa.record_batch(columns, ["lang", "a", "b", "value"])


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    entries = 0
    for batch in batches:
        held.append(batch)
        entries += len(batch.column("path").flatten())
        if entries > NODES:
            yield _corrections(held)
            held, entries = [], 0
    if held:
        yield _corrections(held)


def _shared_terms(placed: DataFrame) -> DataFrame:
    """Corrections (lang, a, b, value), a before b, for terms that two sources have."""
    node = F.struct("source", "n", "p", "absent")
    paths = placed.groupBy("lang", "term").agg(F.sort_array(F.collect_list(node)).alias("path"))
    distinct = materialise(paths.groupBy("lang", "path").agg(F.count("*").alias("rows")))
    ready_workers(placed.sparkSession)
    dealt = distinct.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    return dealt.mapInArrow(_grow, "lang string, a string, b string, value bigint")


def divergence(
    df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_documents: int = MIN_DOCUMENTS, top: int = TOP
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): how each source of a language departs from the others and from the whole.

    Each row of `df` is a document; repeated rows and rows with a null or equal id count each. Null text, lang and source
    are the empty string; other columns are not read. Terms are runs of letters A-Z, which are lower-cased, and of all
    non-ASCII characters; a language keeps those in at least `min_documents` of its documents. The share of a term
    is 1 + floor(SCALE * (count + 2) / (size + 2 * kept terms)), the value floor((p - q)^2 / (p + q)). Part `pair` has every
    other source of the language, with the value summed over all kept terms, 0 without any. Part `term` has the `top` terms
    that a source uses more than the language does. Equal values are ranked by item. Empty tables give no rows.
    """
    texts = df.select(*[F.coalesce(F.col(f"`{column}`"), F.lit("")).alias(name) for name, column in (("lang", lang), ("source", source), ("text", text))])
    rows = materialise(term_rows(texts, min_documents))
    each = rows.select("lang", "term", "total", F.inline("path"))
    kept = rows.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("whole"))
    sizes = each.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    groups = texts.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(kept, "lang", "left")
    groups = groups.na.fill(0, ["size", "kept", "whole"])
    groups = materialise(groups.withColumn("absent", _share(F.lit(0), F.col("size"), F.col("kept"))))

    shares = _share(F.col("n"), F.col("size"), F.col("kept")).alias("p"), _share(F.col("total"), F.col("whole"), F.col("kept")).alias("q")
    placed = materialise(each.join(groups, ["lang", "source"]).select("lang", "source", "term", "n", "absent", *shares))

    above = placed.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value"))
    order = [F.col("value").desc(), F.col("item")]
    terms = top_n(above, ["lang", "source"], order, top)

    others = groups.select("lang", F.col("source").alias("item"), F.col("absent").alias("_absent"))
    nowhere = fan_out_join(groups.select("lang", "source", "absent", "kept"), others, "lang").where("source <> item")
    nowhere = nowhere.select("lang", "source", "item", F.coalesce(F.col("kept") * _apart(F.col("absent"), F.col("_absent")), F.lit(0)).alias("value"))
    levels = materialise(placed.groupBy("lang", "source", "p", "absent").agg(F.count("*").alias("_terms")))
    own = fan_out_join(levels, others, "lang", pairs_per_cell=50_000).where("source <> item")
    gain = F.col("_terms") * (_apart(F.col("p"), F.col("_absent")) - _apart(F.col("absent"), F.col("_absent")))
    own = own.select("lang", F.col("source").alias("a"), F.col("item").alias("b"), gain.alias("value"))
    corrections = materialise(own.union(_shared_terms(placed)).groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    parts = nowhere
    for a, b in (("a", "b"), ("b", "a")):
        parts = parts.union(corrections.select("lang", F.col(a).alias("source"), F.col(b).alias("item"), "value"))
    pairs = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
    return pairs.union(terms.select(pairs.columns))
