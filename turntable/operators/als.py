"""Implicit-feedback ALS over the play counts: split, grid search, error and playlists."""

from __future__ import annotations

import itertools
import time
import uuid
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turntable.config import EngineConfig
from turntable.operators.dimensions import RECORDING_KEYS
from turntable.operators.joins import fan_out_join
from turntable.operators.ranking import positions, top_n
from turntable.schemas import MODEL_RUN
from turntable.sources.tables import materialise, scratch_root

SPLITS = ("training", "validation", "test")
TOP_ARTIST_SET = "top_artist"
SIMILAR_ARTIST_SET = "similar_artist"
SETS = (TOP_ARTIST_SET, SIMILAR_ARTIST_SET)
_ROUNDING = 1e-5  # of a score that is kept as a float
_IDS_PER_BLOCK = 32  # users or items of an ALS block, at least


def new_model_id(cfg: EngineConfig) -> str:
    return f"{cfg.model_id_prefix}-{uuid.uuid4()}"


def ratings(playcounts: DataFrame) -> DataFrame:
    """Play counts as (user_id int, recording_id int, count float)."""
    return playcounts.select(
        F.col("user_id").cast("int"), F.col("recording_id").cast("int"), F.col("count").cast("float")
    )


def split_name(cfg: EngineConfig) -> Column:
    """The split a play count belongs to, by a hash of its ids and the seed.

    Depends on the row alone, so it is the same whatever the partitioning and needs no second
    pass, unlike `randomSplit`.
    """
    key = F.concat_ws("-", "user_id", "recording_id", F.lit(cfg.seed))
    bucket = F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint"), F.lit(sum(cfg.split_weights)))
    training, validation, _ = itertools.accumulate(cfg.split_weights)
    return (
        F.when(bucket < training, SPLITS[0]).when(bucket < validation, SPLITS[1]).otherwise(SPLITS[2])
    )


def hash_split(playcounts: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Play counts with their `split`."""
    return playcounts.withColumn("split", split_name(cfg))


class RmseResult(NamedTuple):
    #: Over all held-out rows, those without a prediction adding nothing to the error.
    rmse: float | None
    #: Over the rows with a prediction.
    rmse_scored: float | None
    n: int
    n_scored: int


def predictions(model: ALSModel, data: DataFrame, cold: str = "drop") -> DataFrame:
    """`data` with a `prediction`; pairs unseen in training are dropped, or NaN with `cold="nan"`."""
    return model.setColdStartStrategy(cold).transform(data)


def rmse(model: ALSModel, data: DataFrame) -> RmseResult:
    """Root mean squared error of the predicted preference against the raw count.

    Implicit ALS predicts a preference near 0..1, so this ranks models rather than measuring
    play counts. One pass: NaN predictions are counted, not dropped and counted again.
    """
    known = ~F.isnan("prediction")
    squared = F.when(known, F.pow(F.col("prediction") - F.col("count"), F.lit(2)))
    row = (
        predictions(model, data, cold="nan")
        .agg(
            F.sqrt(F.sum(squared) / F.count("*")).alias("rmse"),
            F.sqrt(F.sum(squared) / F.count(squared)).alias("rmse_scored"),
            F.count("*").alias("n"),
            F.count(squared).alias("n_scored"),
        )
        .first()
    )
    return RmseResult(row.rmse, row.rmse_scored, row.n, row.n_scored)


class GridResult(NamedTuple):
    model: ALSModel
    model_id: str
    rank: int
    lmbda: float
    num_iterations: int
    validation: RmseResult
    runs: DataFrame


def als_blocks(n_ratings: int, cfg: EngineConfig) -> int:
    """User and item blocks of a fit: about a million ratings each, whatever the size of the cluster."""
    return cfg.als_blocks or 1 + n_ratings // 1_000_000


def _side_blocks(n_ratings: int, n_ids: int, cfg: EngineConfig) -> int:
    """Blocks of the users or the items of a fit: by the ratings, each with enough ids to be worth one.

    The other side's factors are copied to every block that rates them, so blocks of a few items would be shipped
    all users' factors over and over, more often the larger the data.
    """
    return cfg.als_blocks or max(1, min(als_blocks(n_ratings, cfg), n_ids // _IDS_PER_BLOCK))


def fit_grid(training: DataFrame, validation: DataFrame, cfg: EngineConfig, model_id: str | None = None) -> GridResult:
    """Fit every combination of rank, lambda and iterations; the lowest validation RMSE wins.

    The first of equals wins. Pass persisted or stored frames: each fit reads them again. A few
    fits run at a time, the longest first, so that the tail of one leaves no cores idle. ALS cuts its lineage into
    the session's checkpoint folder. `model_id` names the winner.
    """
    spark = training.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(scratch_root(spark))
    sizes = training.agg(
        F.count("*").alias("n"), F.approx_count_distinct("user_id").alias("users"), F.approx_count_distinct("recording_id").alias("items")
    ).first()
    user_blocks, item_blocks = (_side_blocks(sizes.n, n_ids, cfg) for n_ids in (sizes.users, sizes.items))

    def fit(combination: tuple[int, float, int]) -> tuple[ALSModel, RmseResult, list]:
        rank, lmbda, iterations = combination
        estimator = ALS(
            rank=rank,
            maxIter=iterations,
            regParam=lmbda,
            alpha=cfg.alpha,
            implicitPrefs=True,
            seed=cfg.seed,
            numUserBlocks=user_blocks,
            numItemBlocks=item_blocks,
            userCol="user_id",
            itemCol="recording_id",
            ratingCol="count",
            checkpointInterval=10,
        )
        started = time.monotonic()
        model = estimator.fit(training)
        fitted = time.monotonic()
        error = rmse(model, validation)
        seconds = [fitted - started, time.monotonic() - fitted]
        return model, error, [*combination, error.rmse, error.rmse_scored, error.n_scored, error.n, *seconds]

    combinations = list(itertools.product(cfg.ranks, cfg.lambdas, cfg.iterations))
    with ThreadPool(min(cfg.grid_parallelism, len(combinations))) as pool:
        longest_first = sorted(range(len(combinations)), key=lambda i: -combinations[i][0] * combinations[i][2])
        done = pool.map(inheritable_thread_target(spark)(fit), [combinations[i] for i in longest_first], chunksize=1)
    fits = [one for _, one in sorted(zip(longest_first, done, strict=True), key=lambda pair: pair[0])]
    errors = [float("inf") if error.rmse is None else error.rmse for _, error, _ in fits]
    winner = errors.index(min(errors))
    ids = [new_model_id(cfg) for _ in fits]
    ids[winner] = model_id or ids[winner]
    rows = [[ids[i], *run, i == winner] for i, (_, _, run) in enumerate(fits)]
    model, error, _ = fits[winner]
    return GridResult(model, ids[winner], *combinations[winner], error, spark.createDataFrame(rows, MODEL_RUN))


def load_model(path: str) -> ALSModel:
    return ALSModel.load(path)


def candidate_sets_union(top: DataFrame, similar: DataFrame) -> DataFrame:
    """Both sets of candidates, or of the artists behind them, in one frame told apart by `set`."""
    return top.withColumn("set", F.lit(TOP_ARTIST_SET)).unionByName(
        similar.withColumn("set", F.lit(SIMILAR_ARTIST_SET))
    )


def recommend(model: ALSModel, candidates: DataFrame, recordings: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The best-scored candidates of each user and `set`, ranked and described.

    For stored candidates (user_id, recording_id, set). Candidates that ALS cannot score are
    dropped. Only the ranked rows meet the recordings.
    """
    return _playlists(predictions(model, candidates), recordings, cfg)


def recommend_from_artists(
    model: ALSModel, artists: DataFrame, recordings: DataFrame, cfg: EngineConfig
) -> DataFrame:
    """`recommend` over all recordings of each user's artists (user_id, artist_name, set).

    The factors travel with the artists and the recordings, so a candidate is scored where it
    arises and most are cut there: of all candidates only each user's best per task are shuffled.
    Of an artist with more than `cfg.norm_block` recordings, most are not scored at all, see `promising_scores`.
    """
    return _playlists(promising_scores(model, artists, recordings, cfg), recordings, cfg)


def _dot(x: str, y: str, rank: int) -> Column:
    """Inner product of two factor columns, in the order in which scores are always added."""
    return sum((F.col(x)[i] * F.col(y)[i] for i in range(1, rank)), F.col(x)[0] * F.col(y)[0])


def _norm(column: str, rank: int) -> Column:
    return F.sqrt(sum(F.pow(F.col(column)[i].cast("double"), F.lit(2)) for i in range(rank)))


def promising_scores(model: ALSModel, artists: DataFrame, recordings: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Scored candidates (user_id, recording_id, set, prediction) that hold the best of each user and set.

    An artist's recordings lie in blocks by falling norm of their factors. The first blocks are scored; they give
    each user a score that as many candidates reach as the playlist takes. A later block is scored only for users
    whose norm times the block's highest reaches that score (Cauchy-Schwarz): no recording left out could be listed.
    """
    user_factors = model.userFactors.select(F.col("id").alias("user_id"), F.col("features").alias("_user"))
    item_factors = model.itemFactors.select(F.col("id").alias("recording_id"), F.col("features").alias("_item"))
    left = materialise(artists.select("user_id", "artist_name", "set").join(user_factors, "user_id"))
    items = recordings.select("recording_id", "artist_name").where("artist_name IS NOT NULL").join(item_factors, "recording_id")
    items = materialise(items.withColumn("_norm", _norm("_item", model.rank)))
    score = _dot("_user", "_item", model.rank).cast("float").alias("prediction")

    def scored(pairs: DataFrame) -> DataFrame:
        return pairs.select("user_id", "recording_id", "set", score)

    most = items.groupBy("artist_name").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    if most <= cfg.norm_block:
        return scored(fan_out_join(left, items, "artist_name"))
    order = [F.desc("_norm"), F.asc("recording_id")]
    placed = positions(items, ["artist_name"], order, "_place", "_of_artist")
    placed = materialise(placed.withColumn("_block", F.floor((F.col("_place") - 1) / cfg.norm_block)).drop("_place", "_of_artist"))
    first = fan_out_join(left, placed.where("_block = 0").drop("_norm", "_block"), "artist_name")
    ranked = materialise(_best(scored(first), cfg))
    reached = ranked.where(F.col("rank") == _limit(cfg)).select("user_id", "set", F.col("prediction").alias("_reached"))

    blocks = placed.where("_block > 0").groupBy("artist_name", "_block").agg(F.max("_norm").alias("_highest"))
    norms = left.select("user_id", "set", "artist_name", _norm("_user", model.rank).alias("_own"))
    met = fan_out_join(norms, materialise(blocks), "artist_name").join(reached, ["user_id", "set"], "left")
    # Scores are rounded to floats, which the bound must not cut short.
    bound = F.col("_own") * F.col("_highest")
    open_ones = met.where(F.col("_reached").isNull() | (bound * (1 + _ROUNDING) + _ROUNDING >= F.col("_reached")))
    cell = F.concat_ws(":", F.col("_block").cast("string"), "artist_name").alias("_cell")
    wanted = open_ones.select("user_id", "set", cell).join(user_factors, "user_id")
    of_cells = placed.where("_block > 0").select(cell, "recording_id", "_item")
    return ranked.drop("rank").union(scored(fan_out_join(materialise(wanted), of_cells, "_cell")))


def factor_scores(model: ALSModel, candidates: DataFrame) -> DataFrame:
    """Candidates that the model knows, each scored from the published factors: an independent check of predictions."""
    user_factors = model.userFactors.select(F.col("id").alias("user_id"), F.col("features").alias("_user"))
    item_factors = model.itemFactors.select(F.col("id").alias("recording_id"), F.col("features").alias("_item"))
    both = candidates.join(user_factors, "user_id").join(item_factors, "recording_id")
    exact = sum(F.col("_user")[i].cast("double") * F.col("_item")[i].cast("double") for i in range(model.rank))
    return both.select(*candidates.columns, exact.alias("score"))


def normal_equations(model: ALSModel, training: DataFrame, alpha: float, lmbda: float) -> DataFrame:
    """Per user of the training data: n_ratings, and how far the user's factors miss their normal equations.

    A fit ends by solving (Y'Y + Y'(C - 1)Y + lambda n) x = Y'C p for each user, C holding 1 + alpha times the count
    and p the preference, with the published item factors Y. `residual` is the norm of what is left by that of
    the right-hand side: a rounding error if the model is what it is said to be.
    """
    rank = model.rank
    users = model.userFactors.select(F.col("id").alias("user_id"), F.col("features").alias("_x"))
    items = model.itemFactors.select(F.col("id").alias("recording_id"), F.col("features").alias("_y"))

    def entry(column: str, i: int) -> Column:
        return F.col(column)[i].cast("double")

    # rank * (rank + 1) / 2 numbers, whatever the data.
    upper = [(i, j) for i in range(rank) for j in range(i, rank)]
    found = items.agg(*[F.sum(entry("_y", i) * entry("_y", j)).alias(f"g{i}_{j}") for i, j in upper]).first()
    gram = {pair: found[f"g{pair[0]}_{pair[1]}"] for pair in upper}
    extra = F.lit(alpha) * F.abs("count").cast("double")
    target = F.when(F.col("count") > 0, 1 + extra).otherwise(0.0)
    inner = sum(entry("_x", i) * entry("_y", i) for i in range(rank))
    each = training.join(items, "recording_id").join(users, "user_id")
    sums = each.groupBy("user_id").agg(
        F.any_value("_x").alias("_x"),
        F.count("*").alias("n_ratings"),
        F.count_if(F.col("count") > 0).alias("_n"),
        *[F.sum((extra * inner - target) * entry("_y", i)).alias(f"_r{i}") for i in range(rank)],
        *[F.sum(target * entry("_y", i)).alias(f"_b{i}") for i in range(rank)],
    )
    left = [
        F.col(f"_r{i}")
        + sum(F.lit(gram[min(i, j), max(i, j)]) * entry("_x", j) for j in range(rank))
        + F.lit(lmbda) * F.col("_n") * entry("_x", i)
        for i in range(rank)
    ]
    size = F.sqrt(sum(F.pow(F.col(f"_b{i}"), F.lit(2)) for i in range(rank)))
    missed = F.sqrt(sum(F.pow(one, F.lit(2)) for one in left))
    return sums.select("user_id", "n_ratings", (missed / F.when(size > 0, size).otherwise(1.0)).alias("residual"))


def _limits(cfg: EngineConfig) -> dict[str, int]:
    return {
        TOP_ARTIST_SET: cfg.top_artist_recommendations,
        SIMILAR_ARTIST_SET: cfg.similar_artist_recommendations,
    }


def _limit(cfg: EngineConfig) -> Column:
    limits = _limits(cfg)
    return F.when(F.col("set") == TOP_ARTIST_SET, limits[TOP_ARTIST_SET]).otherwise(limits[SIMILAR_ARTIST_SET])


def _best(scored: DataFrame, cfg: EngineConfig) -> DataFrame:
    order = [F.desc("prediction"), F.asc("recording_id")]
    return top_n(scored, ["user_id", "set"], order, max(_limits(cfg).values())).where(F.col("rank") <= _limit(cfg))


def _playlists(scored: DataFrame, recordings: DataFrame, cfg: EngineConfig) -> DataFrame:
    described = recordings.select("recording_id", *RECORDING_KEYS)
    return (
        _best(scored, cfg)
        .join(described, "recording_id")
        .select("user_id", "set", "rank", "recording_id", F.col("prediction").alias("rating"), *RECORDING_KEYS)
    )


def recommendation_status(requested: DataFrame, users: DataFrame, recommendations: DataFrame) -> DataFrame:
    """Per requested `user_name`: `unknown_user`, `no_recommendations`, or how many in each set."""
    known = users.select("user_name", "user_id")
    counts = recommendations.groupBy("user_id").agg(
        F.count_if(F.col("set") == TOP_ARTIST_SET).alias("top_artist_count"),
        F.count_if(F.col("set") == SIMILAR_ARTIST_SET).alias("similar_artist_count"),
    )
    status = (
        F.when(F.col("user_id").isNull(), "unknown_user")
        .when(F.col("top_artist_count").isNull(), "no_recommendations")
        .otherwise("ok")
    )
    return (
        requested.select("user_name")
        .distinct()
        .join(known, "user_name", "left")
        .join(counts, "user_id", "left")
        .select(
            "user_name",
            status.alias("status"),
            F.coalesce("top_artist_count", F.lit(0)).alias("top_artist_count"),
            F.coalesce("similar_artist_count", F.lit(0)).alias("similar_artist_count"),
        )
    )


def stored_runs(spark: SparkSession, path: str) -> DataFrame:
    """The stored grid rows of all training runs."""
    return spark.read.schema(MODEL_RUN).parquet(path)
