"""Near duplicates, decontamination, shards and the pipeline."""

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

import corpus_pipeline
from turntable.llm import decontaminate, near_duplicates
from turntable.llm.components import components
from turntable.llm.decontaminate import find_passages, without_passages
from turntable.llm.hilbert import curve_index, hilbert_shards, write_shards
from turntable.llm.near_duplicates import drop_near_duplicates, least_agreements
from turntable.llm.queries import QUERIES
from turntable.sources.tables import read_table

WORDS = [f"w{i}" for i in range(400)]


def brute_components(texts):
    sets = {}
    for number, text in texts.items():
        words = (text or "").encode().lower().split()
        sets[number] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    least = {number: number for number in sets}

    def root(number):
        while least[number] != number:
            number = least[number]
        return number

    holders = defaultdict(list)
    for number, own in sets.items():
        for one in own:
            holders[one].append(number)
    shared = Counter((a, b) for own in holders.values() for i, a in enumerate(own) for b in own[:i])
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            low, high = sorted((root(a), root(b)))
            least[high] = low
    return {number: (len(own), root(number)) for number, own in sets.items()}


def same_as_brute(spark, texts):
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").selectExpr("*", "1 AS id", "2 AS n")
    found = {row.doc_id: (row.n_shingles, row.component_id) for row in near_duplicates.near_duplicates(df).collect()}
    assert found == brute_components(texts)


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 200), (200, 150), (5, 5)]
    found = dict(components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert found == {**dict.fromkeys(range(1, 41), 1), 100: 100, 150: 100, 200: 100}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_pruning_bound():
    from math import comb

    for n, m in zip(range(40, 201, 40), least_agreements(), strict=True):
        tail = lambda k: sum(comb(n + 1, i) * 0.75**i * 0.25 ** (n + 1 - i) for i in range(k + 1))
        assert tail(m - 1) < near_duplicates.MISS <= tail(m)


def test_near_duplicates_of_edited_copies(spark):
    """A cloud of copies around one base, some near enough and some not, beside texts that share a passage."""
    draw = random.Random(4)
    base, passage = draw.choices(WORDS, k=120), draw.choices(WORDS, k=60)
    texts = {}
    for i in range(60):
        words = list(base)
        for _ in range(draw.randint(0, 6)):
            words[draw.randrange(120)] = draw.choice(WORDS)
        texts[i] = " ".join(words)
    for i in range(100, 150):
        texts[i] = " ".join(passage + draw.choices(WORDS, k=draw.randint(5, 25)))
    texts |= {200: None, 201: "", 202: "One two", 203: "one TWO", 204: " ", 205: "x " * 5000, 206: "x " * 4000}
    same_as_brute(spark, texts)


def test_near_duplicates_across_cells(spark, monkeypatch):
    """Buckets cut into many cells and pivots copied to many parts give the same components."""
    monkeypatch.setattr(near_duplicates, "CELL_MEMBERS", 5)
    monkeypatch.setattr(near_duplicates, "CELL_SHINGLES", 900)
    draw = random.Random(14)
    base = draw.choices(WORDS, k=80)
    texts = {}
    for i in range(150):
        words = list(base)
        for _ in range(draw.randint(0, 5)):
            words[draw.randrange(80)] = draw.choice(WORDS)
        texts[i] = " ".join(words)
    same_as_brute(spark, texts)


def test_several_texts_under_one_id(spark):
    """The text that the id stands for is the one it is compared by and the one that stays, on every run."""
    draw = random.Random(15)
    texts = [" ".join(draw.choices(WORDS, k=30)) for _ in range(6)]
    rows = [(n, text) for n, text in enumerate(texts)] + [(9, text) for text in texts] + [(9, texts[0])] * 3 + [(8, ""), (8, texts[1])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    taken = set()
    for partitions in (1, 5):
        found = {row.doc_id: row for row in near_duplicates.near_duplicates(df.repartition(partitions, "text")).collect()}
        assert len(found) == 8 and found[8].n_shingles == 0 and found[8].component_id == 8
        taken.add(found[9].component_id)
        assert all(found[n].component_id == n for n in range(6)) and not found[9].kept
        alone = df.where("doc_id > 5").repartition(partitions)
        assert sorted(row.text for row in drop_near_duplicates(alone).collect()) == ["", texts[found[9].component_id]]
    assert len(taken) == 1


def test_near_duplicate_edges(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (3, "a b"), (3, "a b"), (2, "A\tb ")], "doc_id bigint, text string")
    found = near_duplicates.near_duplicates(df).collect()
    assert sorted((row.doc_id, row.component_id, row.kept) for row in found if row.doc_id) == [(2, 2, True), (3, 2, False)]
    assert [(row.component_id, row.kept) for row in found if row.doc_id is None] == [(None, True)] * 2
    assert sorted(row.doc_id or 0 for row in drop_near_duplicates(df).collect()) == [0, 0, 2]
    assert near_duplicates.near_duplicates(df.limit(0)).count() == 0
    assert drop_near_duplicates(df.limit(0)).count() == 0


def test_near_duplicates_query(spark, sf_dir):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    wanted = brute_components(texts)
    for row in QUERIES["op5_near_duplicates"](spark, sf_dir).collect():
        assert (row.n_shingles, row.component_id) == wanted[row.doc_id]
        assert row.kept == (row.doc_id == row.component_id)


def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_passages(spark, monkeypatch, broadcast):
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", broadcast)
    draw = random.Random(6)
    item = draw.choices(WORDS, k=40)
    changed = list(item)
    for i in range(3, 40, 7):
        changed[i] = "other"
    noise = lambda n: draw.choices(WORDS, k=n)
    texts = {
        1: noise(50) + item + noise(20), 2: noise(30) + changed + noise(9), 3: noise(300), 4: item[10:30], 5: item[:6] + noise(80),
        6: item[5:40], 7: noise(4),
    }
    rows = [(n, " ".join(words).upper()) for n, words in texts.items()] + [(8, None), (9, ""), (None, " ".join(item)), (1, " ".join(item))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "0 AS seed", "1 AS at")
    items = spark.createDataFrame([(7, ", ".join(item)), (7, ", ".join(item)), (8, "too short"), (9, None)], "item_id bigint, text string")
    found = find_passages(df, items)
    assert sorted((row.doc_id or 0, row.item_id) for row in found.collect()) == [(0, 7), (1, 7), (2, 7), (4, 7), (6, 7)]
    assert sorted(row.doc_id or 0 for row in without_passages(df, items).collect()) == [0, 3, 5, 7, 8, 9]
    assert find_passages(df.limit(0), items).count() == find_passages(df, items.limit(0)).count() == 0


def brute_passages(words, item):
    """(n_equal, n_hits, first_word) over all windows of the item at all places of the text, or None."""
    length = min(decontaminate.WINDOW, len(item))
    found = []
    for shift in range(-len(item) + 1, len(words)):
        same = [0 <= shift + k < len(words) and words[shift + k] == item[k] for k in range(len(item))]
        for start in range(len(item) - length + 1 if sum(same) >= 6 else 0):
            window = same[start : start + length]
            seeded = any(
                all(window[at + k] for k, bit in enumerate(mask) if bit == "1")
                for mask in decontaminate.MASKS
                for at in range(length - len(mask) + 1)
            )
            if seeded and 4 * sum(window) >= 3 * length:
                found.append((sum(window), shift))
    return (max(same for same, _ in found), len(found), max(0, min(shift for _, shift in found))) if found else None


def test_passages_brute_force(spark):
    draw = random.Random(16)
    items = {i: draw.choices(WORDS, k=size) for i, size in enumerate([8, 11, 15, 16, 17, 25, 40, 70])}
    items[8] = items[6][:20] + items[6][:20]
    texts = {}
    for number in range(900):
        item = items[number % 9]
        size = min(len(item), draw.randint(12, 20) if number % 5 else 70)
        at = draw.randint(0, len(item) - size)
        quoted = item[at : at + size]
        for place in draw.sample(range(size), min(size, draw.randint(1, 4) if number % 5 else size // 5)):
            quoted[place] = "other"
        texts[number] = draw.choices(WORDS, k=draw.randint(0, 20)) + quoted + draw.choices(WORDS, k=draw.randint(0, 20))
    rows = [(number, " ".join(words)) for number, words in texts.items()]
    df = spark.createDataFrame(rows + rows[:50], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(i, " ".join(words)) for i, words in items.items()], "item_id bigint, text string")
    found = {(row.doc_id, row.item_id): (row.n_equal, row.n_hits, row.first_word) for row in find_passages(df, benchmark).collect()}
    wanted = {(n, i): brute_passages(words, item) for n, words in texts.items() for i, item in items.items()}
    assert found == {pair: held for pair, held in wanted.items() if held}
    assert 100 < len(found)


def test_short_items_and_null_ids(spark):
    draw = random.Random(7)
    item = draw.choices(WORDS, k=30)
    noise = " ".join(draw.choices(WORDS, k=30))
    texts = [
        (1, f"{noise} Forty-two apples fell {noise}"), (2, f"{noise} forty-two pears fell"), (3, noise), (None, noise), (None, " ".join(item)),
        (None, f"{noise} 東京は日本の首都です。{noise}"), (4, "東京は日本の首都です"), (5, "東京は日本の都です"), (6, "two"), (6, " ".join(item)),
    ]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    rows = [(1, "forty two apples fell"), (2, "東京は日本の首都です"), (None, " ".join(item)), (3, " "), (None, " ".join(reversed(item)))]
    items = spark.createDataFrame(rows, "item_id bigint, text string")
    found = {(row.doc_id, row.item_id): (row.n_equal, row.n_hits) for row in find_passages(df, items).collect()}
    assert found == {(1, 1): (4, 1), (4, 2): (1, 1), (None, 2): (1, 1), (None, None): (16, 15), (6, None): (16, 15)}
    kept = [row.text for row in without_passages(df, items, keep_nameless=False).collect()]
    assert sorted(kept) == sorted([noise, noise, texts[1][1], texts[7][1]])
    assert without_passages(df, items).where("doc_id IS NULL").count() == 3


def test_passages_query(spark, sf_dir):
    grams = defaultdict(set)
    for row in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        words = words_of(row.text)
        for i in range(len(words) - 11):
            grams[tuple(words[i : i + 12])].add(row.item_id)
    wanted = set()
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        words = words_of(row.text)
        wanted |= {(row.doc_id, item) for i in range(len(words) - 11) for item in grams.get(tuple(words[i : i + 12]), ())}
    assert wanted <= {(row.doc_id, row.item_id) for row in QUERIES["op6_decontamination"](spark, sf_dir).collect()}


@pytest.mark.parametrize(("axes", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_curve(axes, bits):
    points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
    place = curve_index(points, bits)
    assert sorted(place) == list(range(len(points)))
    assert (np.abs(np.diff(points[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def test_shards(spark, tmp_path):
    rows = [(i if i % 10 else None, f"t{i % 7}" * (i % 5), "hot" if i % 3 else f"l{i}", i % 4) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, size int").selectExpr("*", "1 AS shard", "2 AS slot")
    found = hilbert_shards(df, ["lang", "size"], 24).collect()
    slots = defaultdict(list)
    for row in found:
        slots[row.shard].append(row.slot)
    assert sorted(slots) == list(range(24)) and {len(own) for own in slots.values()} <= {8, 9}
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert hilbert_shards(df.limit(0), ["lang"], 24).count() == 0
    assert hilbert_shards(df.limit(3), ["lang"], 24).select("shard").distinct().count() == 3
    unique = df.where("doc_id IS NOT NULL")
    write_shards(unique.drop("shard"), hilbert_shards(unique, ["lang", "size"], 4), str(tmp_path / "out"))
    back = read_table(spark, str(tmp_path / "out"))
    assert back.count() == unique.count() and back.select("shard").distinct().count() == 4


def test_shards_query(spark, sf_dir):
    """Sizes, checksums, order and shards against plain sorting of the curve."""
    rows = QUERIES["op10_hilbert_shards"](spark, sf_dir)
    assert rows.columns[:7] == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = rows.collect()
    docs = {row.doc_id: row for row in read_table(spark, f"{sf_dir}/documents.parquet").collect()}
    assert sorted(row.doc_id for row in rows) == sorted(docs)
    for row in rows:
        raw = (docs[row.doc_id].text or "").encode()
        assert (row.size, row.text_crc32, row.law, row.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
    ordered = sorted(rows, key=lambda row: (row.curve, row.doc_id))
    places = [(row.shard, row.slot) for row in ordered]
    assert places == sorted(places)
    sizes = Counter(row.shard for row in rows)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(slot == k for shard in sizes for k, slot in enumerate(sorted(row.slot for row in rows if row.shard == shard)))


def test_files_are_skipped_by_every_dimension(spark, tmp_path):
    """Addresses that begin alike for many characters prune files as numbers do."""
    import pyarrow.parquet as parquet

    draw = random.Random(3)
    rows = [(i, f"https://www.example.org/archive/{draw.randrange(10**6):06}", draw.randrange(10**6), "t") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id bigint, url string, n bigint, text string")
    write_shards(df, hilbert_shards(df, ["url", "n"], 32), str(tmp_path / "out"))
    files = [parquet.ParquetFile(path) for path in sorted((tmp_path / "out").glob("shard=*/*.parquet"))]
    boxes = []
    for file in files:
        of = {file.metadata.row_group(0).column(i).path_in_schema: file.metadata.row_group(0).column(i).statistics for i in range(file.metadata.num_columns)}
        boxes.append(tuple((of[name].min, of[name].max) for name in ("url", "n")))
    for axis in (0, 1):
        met = [sum(box[axis][0] <= row[axis + 1] <= box[axis][1] for box in boxes) for row in rows[:200]]
        assert np.mean(met) < 0.35 * len(boxes)


def test_short_items_can_be_left_out(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "it is a test of the thing")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "A"), (2, "is a test of the")], "item_id bigint, text string")
    assert without_passages(df, items).count() == 0
    assert [row.doc_id for row in without_passages(df, items, least_words=5).collect()] == [1]


def test_seeds_stand_for_nearly_all_windows():
    """Of all ways to change words of a window, how many leave a seed whole."""
    laid = [int(mask, 2) << at for mask in decontaminate.MASKS for at in range(17 - len(mask))]
    for changed, least in ((1, 16), (2, 120), (3, 560), (4, 1736)):
        sets = [sum(1 << place for place in places) for places in combinations(range(16), changed)]
        assert sum(any(one & some == 0 for one in laid) for some in sets) == least


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.materialise(stage(spark, left, sf_dir))
        if name != "bpe":
            assert out.columns == docs.columns and out.count() < left.count()
            assert out.join(left, docs.columns, "left_anti").count() == 0
        else:
            assert out.count() == left.count()
        left = out
