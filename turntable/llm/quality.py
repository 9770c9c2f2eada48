"""Quality rules from SQL functions alone: plain text statistics, then hashed n-grams against a trusted corpus.

Words and runs of other signs, and pairs of neighbours, are hashed into BUCKETS. Their shares in the trusted
texts and in the whole corpus make two multinomials. A text's score is the mean, over its n-grams, of the
log of the trusted share by the corpus share; texts below a fixed threshold go.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
THRESHOLD = -0.5
UNITS = 1000  # weights are whole thousandths, so that their sums do not depend on any order
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

_BLANKS = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_PLACE_BITS = 12
_FEW = 32  # so many repeated windows are looked up one by one; more are found in sorted order
_TOKENS = r"[\p{L}\p{M}\p{N}]+|[^\s\p{L}\p{M}\p{N}]+"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _spaced(text: Column) -> Column:
    """The text with a space for each other ASCII white space. Plain replacements pass over what they do not find."""
    for blank in _BLANKS[1:]:
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return text


def _symbols(text: Column) -> Column:
    rest = text
    for symbol in _SYMBOLS:
        rest = F.replace(rest, F.lit(symbol), F.lit(""))
    return F.char_length(text) - F.char_length(rest)


def _twice(ordered: Column, key: Callable[[Column], Column], place: Callable[[Column], Column]) -> Column:
    """Places of the entries of a sorted array that share their key with a neighbour, in ascending order."""
    # get() gives null beyond the ends, which is equal to nothing.
    met = F.transform(
        ordered,
        lambda x, i: F.when((key(F.get(ordered, i - 1)) == key(x)) | (key(F.get(ordered, i + 1)) == key(x)), place(x)),
    )
    return F.sort_array(F.filter(met, lambda i: i.isNotNull()))


def _repeated(words: Column, n: Column) -> Column:
    """Words that lie in a window of three found twice or more."""

    def packed(hashes: Column) -> Column:
        """Hash and place in one number, as far as places fit below the hash bits that tell windows apart."""
        one = F.transform(hashes, lambda h, i: F.shiftleft(h, _PLACE_BITS).bitwiseOR(i.cast("bigint")))
        low = F.lit((1 << _PLACE_BITS) - 1)
        return _let(
            F.sort_array(one),
            lambda ordered: _twice(
                ordered, lambda x: F.shiftright(x, _PLACE_BITS), lambda x: x.bitwiseAND(low).cast("int")
            ),
        )

    def paired(hashes: Column) -> Column:
        both = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return _let(F.array_sort(both), lambda ordered: _twice(ordered, lambda x: x["h"], lambda x: x["i"]))

    def few(hashes: Column, again: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), n - 3), lambda i: F.array_contains(again, F.get(hashes, i)))

    def covered(hashes: Column, again: Column) -> Column:
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n"))
        places = (
            F.when(F.size(again) <= _FEW, few(hashes, again))
            .when(n <= 1 << _PLACE_BITS, packed(hashes))
            .otherwise(paired(hashes))
        )
        return F.aggregate(
            places,
            start,
            lambda so_far, i: F.struct(
                i.alias("last"), (so_far["n"] + F.least(F.lit(3), i - so_far["last"])).alias("n")
            ),
        )["n"]

    def counted(hashes: Column) -> Column:
        again = _let(F.sort_array(hashes), lambda s: F.filter(s, lambda x, i: x == F.get(s, i - 1)))
        total = _let(again, lambda values: covered(hashes, values))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), total).otherwise(F.lit(0).cast("bigint"))

    windows = F.transform(
        F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    )
    return F.when(n > 3, _let(windows, counted)).otherwise(F.lit(0).cast("bigint"))


def _bucket(*tokens: Column) -> Column:
    return F.xxhash64(*tokens).bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_TOKENS), F.lit(0))


def bucket_weights(df: DataFrame, trusted: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row with `weights`: for each bucket the log of its trusted share by its share in all of `df`, in UNITS.

    `trusted` holds the ids of trusted rows. Each token counts alone and with the token after it (the last
    one with nothing). Both shares have one added to each bucket. Without trusted rows all weights are 0.
    Counts are summed per task before the shuffle; the row is as long as there are buckets, whatever the data.
    """
    known = trusted.select(F.col(id_column).alias("_trusted")).where("_trusted IS NOT NULL").distinct()
    marked = df.select(F.col(id_column).alias("_id"), F.col(text).alias("_text")).join(
        known.hint("shuffle_hash"), F.col("_id") == F.col("_trusted"), "left"
    )
    tokens = marked.select(F.col("_trusted").isNotNull().cast("bigint").alias("_own"), _tokens(F.col("_text")).alias("_tokens"))
    # The outer form keeps Spark from cutting the texts a first time to see whether there is a token.
    placed = tokens.select("_own", "_tokens", F.posexplode_outer("_tokens").alias("_at", "_token"))
    placed = placed.where(F.col("_token").isNotNull())
    pair = _bucket(F.col("_token"), F.get(F.col("_tokens"), F.col("_at") + 1))
    hashed = placed.select("_own", F.explode(F.array(_bucket(F.col("_token")), pair)).alias("_bucket"))
    counts = hashed.groupBy("_bucket").agg(F.count("*").alias("_all"), F.sum("_own").alias("_good"))
    buckets = df.sparkSession.range(0, BUCKETS, 1, 1).select(F.col("id").cast("int").alias("_bucket"))
    full = buckets.join(counts, "_bucket", "left").select(
        "_bucket", F.coalesce("_all", F.lit(0)).alias("_all"), F.coalesce("_good", F.lit(0)).alias("_good")
    )
    rows = full.agg(
        F.sum("_all").alias("_n_all"),
        F.sum("_good").alias("_n_good"),
        F.array_sort(F.collect_list(F.struct("_bucket", "_all", "_good"))).alias("_rows"),
    )
    good = (F.col("_n_good") + BUCKETS).cast("double")
    every = (F.col("_n_all") + BUCKETS).cast("double")

    def weight(row: Column) -> Column:
        ratio = F.log((row["_good"] + 1) / good) - F.log((row["_all"] + 1) / every)
        return F.round(ratio * UNITS).cast("int")

    nothing = F.array_repeat(F.lit(0), BUCKETS)
    return rows.select(F.when(F.col("_n_good") > 0, F.transform("_rows", weight)).otherwise(nothing).alias("weights"))


def _score(tokens: Column, weights: Column) -> Column:
    total = F.aggregate(
        F.sequence(F.lit(0), F.size(tokens) - 1),
        F.lit(0).cast("bigint"),
        lambda so_far, i: so_far
        + F.get(weights, _bucket(F.get(tokens, i)))
        + F.get(weights, _bucket(F.get(tokens, i), F.get(tokens, i + 1))),
    )
    return F.when(F.size(tokens) > 0, total / (2 * UNITS * F.size(tokens))).otherwise(F.lit(0.0))


def quality_rules(
    df: DataFrame, trusted: DataFrame, output: str = "quality", text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """All columns of `df`, and a struct `output`: the plain statistics, base_failed, score and kept.

    n_words and word_chars (code points) of words between ASCII white space; n_symbols of #*$%&|<>;
    n_dup_lines equal to an earlier line with a word; n_repeat_words in windows of three words found twice
    or more. base_failed: under 50 words, or over half of them repeated. kept: not base_failed, and a score
    of THRESHOLD or more. A null text counts as empty and fails. Equal rows give equal results; a null id is
    never trusted; a column named as the output is replaced. Each row is judged in place: only the counts
    shuffle the texts, by id. They are made at once, and BUCKETS numbers of them reach the driver.
    """
    numbers = bucket_weights(df, trusted, text, id_column).select(F.array_join("weights", ",")).first()[0]
    weights = F.split(F.lit(numbers), ",").cast("array<int>")  # a constant of BUCKETS numbers once planned
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))

    def judged(text: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda line: F.trim(_spaced(line)) != "")

        def rules(spaced: Column, words: Column) -> Column:
            n = F.size(words)
            return F.struct(
                n.cast("bigint").alias("n_words"),
                F.char_length(F.replace(spaced, F.lit(" "), F.lit(""))).cast("bigint").alias("word_chars"),
                _symbols(text).cast("bigint").alias("n_symbols"),
                _let(lines, lambda own: F.size(own) - F.size(F.array_distinct(own))).cast("bigint").alias("n_dup_lines"),
                _repeated(words, n).alias("n_repeat_words"),
                _let(_tokens(text), lambda tokens: _score(tokens, weights)).alias("score"),
            )

        return _let(
            _spaced(text),
            lambda spaced: _let(F.array_remove(F.split(spaced, " "), ""), lambda words: rules(spaced, words)),
        )

    def verdict(found: Column) -> Column:
        failed = (found["n_words"] < MIN_WORDS) | (100 * found["n_repeat_words"] > MAX_REPEATED_PERCENT * found["n_words"])
        return found.withField("base_failed", failed).withField("kept", ~failed & (found["score"] >= THRESHOLD))

    # The verdict is part of the one expression: a filter on it that is pushed below the column would work all of it out again for each part.
    return df.withColumn(output, _let(content, lambda text: _let(judged(text), verdict)))
