"""Benchmark passages in training texts by spaced seeds, from SQL functions alone.

A seed is a run of words of which only those at the mask's ones are hashed, so a changed word between them does
not matter. Seeds of texts and of benchmark items are joined; all windows around the hits are laid side by side,
and a passage counts if enough of its words are equal, whatever stands at the others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASKS = ("11101011", "1101100111", "101110100011", "110000100111")
WINDOW = 16
EQUAL = 0.75
BROADCAST_SEEDS = 1_000_000

_TOKENS = r"[\p{L}\p{M}\p{N}]+"
_SHORTEST = min(map(len, MASKS))


def _words(text: Column) -> Column:
    """Hashes of the words of a text, in lower case, without what stands between them."""
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(_TOKENS), F.lit(0)), lambda word: F.xxhash64(word))


def _seeds(words: Column, masks: list[str], whole_only: bool) -> Column:
    """The hashes of all masks laid at each place in turn.

    For items, null where a mask does not end within the item, or where a mask for short items is not the whole item.
    """

    def at(place: Column) -> Column:
        made = []
        for i, mask in enumerate(masks):
            seed = F.xxhash64(F.lit(i), *[F.get(words, place + k) for k, bit in enumerate(mask) if bit == "1"])
            fits = place + len(mask) <= F.size(words) if i < len(MASKS) else F.size(words) == len(mask)
            made.append(F.when(fits, seed) if whole_only else seed)
        return F.array(*made)

    shortest = min(map(len, masks))
    places = F.sequence(F.lit(0), F.size(words) - shortest)
    return F.when(F.size(words) >= shortest, F.flatten(F.transform(places, at)))


def _placed(df: DataFrame, key: list[str], masks: list[str], whole_only: bool) -> DataFrame:
    """Rows (key, at, seed) of the seeds of (key, words). The words stay behind: a long text has as many rows as words."""
    seeds = df.select(*key, _seeds(F.col("words"), masks, whole_only).alias("seeds"))
    # Outer: Spark would otherwise cut the texts into words a first time to see which are long enough.
    each = seeds.select(*key, F.posexplode_outer("seeds").alias("place", "seed")).where("seed IS NOT NULL")
    return each.select(*key, F.expr(f"place div {len(masks)}").cast("int").alias("at"), "seed")


def _short_masks(items: DataFrame) -> list[str]:
    """A mask of all words for each length of items that are too short for MASKS."""
    lengths = items.select(F.size("words").alias("n")).where((F.col("n") > 0) & (F.col("n") < _SHORTEST)).distinct()
    return ["1" * row.n for row in lengths.sort("n").collect()]


def _windows(words: Column, shift: Column, item: Column, low: Column, high: Column) -> Column:
    """Of the windows within an item's places `low` to `high`, laid at `shift` in `words`: (n_equal, n_windows) of those that are passages.

    The bits of one number are the last WINDOW places, set where the words are equal; each is judged at the place after it.
    """
    length = F.least(F.lit(WINDOW), F.size(item))
    laid = [int(mask, 2) << left for mask in MASKS for left in range(WINDOW - len(mask) + 1)]

    def step(seen: Column, place: Column) -> Column:
        bits, same = seen["bits"], F.bit_count(seen["bits"])
        seeded = reduce(Column.__or__, [bits.bitwiseAND(F.lit(one)) == one for one in laid])
        # Of an item too short for a seed, all words.
        enough = F.when(length < _SHORTEST, same == length).otherwise((same >= F.ceil(EQUAL * length)) & seeded)
        passage = (place >= low + length) & enough
        equal = F.when(F.get(words, shift + place) == F.get(item, place), 1).otherwise(0)
        return F.struct(
            F.shiftleft(bits, 1).bitwiseAND(F.lit((1 << WINDOW) - 1)).bitwiseOR(equal).alias("bits"),
            F.greatest(seen["n_equal"], F.when(passage, same).otherwise(0)).alias("n_equal"),
            (seen["n_windows"] + F.when(passage, 1).otherwise(0)).alias("n_windows"),
        )

    none = F.struct(F.lit(0).alias("bits"), F.lit(0).alias("n_equal"), F.lit(0).alias("n_windows"))
    return F.aggregate(F.sequence(low, high + 1), none, step)


def _found(df: DataFrame, benchmark: DataFrame, text: str, id_column: str, item_text: str, item_id: str, least_words: int) -> DataFrame:
    """Rows (id, content, item_id, item, shift, n_equal, n_windows) of the shifts at which a text holds passages of an item.

    Texts go by id and a hash of their text, items by a hash of id and words, so that null ids and several texts under one are kept apart.
    """
    items = benchmark.select(F.col(item_id).alias("item_id"), _words(F.col(item_text)).alias("words")).distinct()
    items = items.where(F.size("words") >= least_words)
    items = items.withColumn("item", F.xxhash64("item_id", "words"))
    masks = [*MASKS, *_short_masks(items)]
    of_items = _placed(items, ["item"], masks, True).withColumnRenamed("at", "item_at").distinct()
    texts = df.select(F.col(id_column).alias("id"), F.xxhash64(F.col(text)).alias("content"), F.col(text).alias("text"))
    of_texts = _placed(texts.select("id", "content", _words(F.col("text")).alias("words")), ["id", "content"], masks, False)
    of_items = F.broadcast(of_items) if of_items.count() <= BROADCAST_SEEDS else of_items
    hits = of_texts.join(of_items, "seed").withColumnsRenamed({"id": "hit_id", "content": "hit_content"})
    hits = hits.select("hit_id", "hit_content", "item", "item_at", (F.col("at") - F.col("item_at")).alias("shift"))
    # All windows with a seed lie between those that end with the first hit and those that begin with the last.
    hits = hits.groupBy("hit_id", "hit_content", "item", "shift").agg(F.min("item_at").alias("first_at"), F.max("item_at").alias("last_at"))
    hits = hits.groupBy("hit_id", "hit_content").agg(F.collect_list(F.struct("item", "shift", "first_at", "last_at")).alias("hits"))
    same_text = F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("content") == F.col("hit_content"))
    met = texts.join(hits, same_text).select("id", "content", _words(F.col("text")).alias("words"), "hits")
    each = met.select("id", "content", "words", F.explode("hits").alias("hit")).select("id", "content", "words", "hit.*")
    # Only the words that those windows can reach go on; the first of them is at `part_at`.
    each = each.withColumn("part_at", F.greatest(F.lit(0), F.col("shift") + F.col("first_at") - (WINDOW - 1)))
    part = F.slice("words", F.col("part_at") + 1, F.col("shift") + F.col("last_at") + WINDOW - F.col("part_at"))
    each = each.select("id", "content", "item", "shift", "first_at", "last_at", "part_at", part.alias("part"))
    each = each.join(items.withColumnRenamed("words", "item_words"), "item")
    low = F.greatest(F.lit(0), F.col("first_at") - (WINDOW - 1))
    high = F.least(F.size("item_words") - 1, F.col("last_at") + (WINDOW - 1))
    windows = _windows(F.col("part"), F.col("shift") - F.col("part_at"), F.col("item_words"), low, high)
    found = each.select("id", "content", "item_id", "item", "shift", windows.alias("_found")).where("_found.n_windows > 0")
    # Repeated rows of a text find the same windows, which count once.
    return found.select("id", "content", "item_id", "item", "shift", "_found.*").distinct()


def find_passages(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    least_words: int = 1,
) -> DataFrame:
    """Rows (id, item_id, n_equal, n_hits, first_word): the items of which each text holds a passage.

    A passage is WINDOW words of an item (or the whole item if it is shorter), in their order, of which EQUAL
    are the same, with at least one seed among them, wherever it stands; all windows of an item are laid everywhere.
    Every window with up to 3 changed words has a seed, and 1,736 in 1,820 of those with 4.
    Of items of fewer words than the shortest mask, all words must be the same, so one of a single word is found in each text with that word;
    items of fewer than `least_words` words are not looked for.
    n_equal is the most equal words in a window, n_hits how many windows are passages, first_word the
    place in the text of the earliest item start laid there, 0 at least. Case and signs between words do not matter. Null and empty texts
    and items hold nothing. Rows with null ids and items with null ids are checked like others, and grouped
    under null; repeated rows count as one text, repeated items as one item.

    The lengths of short items reach the driver, at most one of each. The seeds of the benchmark are counted first: up to
    BROADCAST_SEEDS are sent to all tasks, more are joined by shuffling (id, content, place, seed). Texts are joined with their
    hits by id and content, a hit being the places met in an item and how far the text is shifted against it.
    """
    passages = _found(df, benchmark, text, id_column, item_text, item_id, least_words).groupBy("id", "item_id")
    counted = passages.agg(
        F.max("n_equal").alias("n_equal"), F.sum("n_windows").alias("n_hits"), F.greatest(F.min("shift"), F.lit(0)).alias("first_word")
    )
    return counted.withColumnRenamed("id", id_column)


def without_passages(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    keep_nameless: bool = True,
    least_words: int = 1,
) -> DataFrame:
    """The rows of `df` whose texts hold no passage of the benchmark.

    Rows with a null id stay, or with `keep_nameless=False` only if their own text holds none. Items of fewer than
    `least_words` words are not looked for: one of a common word alone would empty the corpus.
    """
    nameless = F.when(F.col("id").isNull(), F.col("content"))
    held = _found(df, benchmark, text, id_column, "text", "item_id", least_words).select(F.col("id").alias("_held"), nameless.alias("_content")).distinct()
    if keep_nameless:
        return df.join(held, F.col(id_column) == F.col("_held"), "left_anti")
    content = F.when(F.col(id_column).isNull(), F.xxhash64(F.col(text)))
    return df.join(held, F.col(id_column).eqNullSafe(F.col("_held")) & content.eqNullSafe(F.col("_content")), "left_anti")
