import math
from collections import defaultdict
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from turntable.config import EngineConfig
from turntable.operators import als, dimensions
from turntable.sources.tables import materialise

CFG = EngineConfig(
    ranks=(2, 3), lambdas=(0.1, 10.0), iterations=(2,), top_artist_recommendations=3, similar_artist_recommendations=2
)


@pytest.fixture(scope="module")
def playcounts(spark):
    counts = spark.range(900).select(
        (F.col("id") % 30 + 1).cast("int").alias("user_id"),
        (F.pmod(F.xxhash64("id"), F.lit(60)) + 1).cast("int").alias("recording_id"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5)) + 1).alias("count"),
    )
    return materialise(counts.dropDuplicates(["user_id", "recording_id"]))


@pytest.fixture(scope="module")
def split(spark, playcounts):
    parts = als.hash_split(playcounts, CFG)
    return {name: materialise(als.ratings(parts.where(F.col("split") == name))) for name in als.SPLITS}


@pytest.fixture(scope="module")
def grid(split):
    return als.fit_grid(split["training"], split["validation"], CFG, "the-model")


def test_split_is_exhaustive_stable_and_weighted(playcounts):
    parts = als.hash_split(playcounts, CFG)
    again = als.hash_split(playcounts.repartition(13), CFG)
    assert parts.exceptAll(again).isEmpty()
    shares = {row.split: row["count"] / playcounts.count() for row in parts.groupBy("split").count().collect()}
    assert set(shares) == set(als.SPLITS)
    assert abs(shares["training"] - 4 / 6) < 0.08
    other_seed = als.hash_split(playcounts, replace(CFG, seed=46))
    assert not parts.exceptAll(other_seed).isEmpty()


def test_ratings_have_the_types_als_takes(split):
    assert dict(split["training"].dtypes) == {"user_id": "int", "recording_id": "int", "count": "float"}


def test_rmse_counts_cold_rows(spark, grid, split):
    cold = spark.createDataFrame([(999, 1, 5.0), (1, 999, 2.0)], split["validation"].schema)
    data = split["validation"].unionByName(cold)
    result = als.rmse(grid.model, data)
    scored = als.predictions(grid.model, data).collect()
    squares = sum((row.prediction - row["count"]) ** 2 for row in scored)
    assert result.n == data.count() and result.n_scored == len(scored) <= result.n - 2
    assert math.isclose(result.rmse, math.sqrt(squares / result.n), rel_tol=1e-6)
    assert math.isclose(result.rmse_scored, math.sqrt(squares / result.n_scored), rel_tol=1e-6)


def test_grid_takes_the_first_of_the_lowest_errors(grid, split):
    runs = grid.runs.collect()
    assert [(r["rank"], r.lmbda, r.num_iterations) for r in runs] == [(2, 0.1, 2), (2, 10.0, 2), (3, 0.1, 2), (3, 10.0, 2)]
    best = min(runs, key=lambda r: r.validation_rmse)
    assert [r.model_id for r in runs if r.best] == [best.model_id] == ["the-model"] == [grid.model_id]
    assert len({r.model_id for r in runs}) == 4
    assert grid.rank == best["rank"] == grid.model.rank and grid.lmbda == best.lmbda
    assert math.isclose(als.rmse(grid.model, split["validation"]).rmse, best.validation_rmse, rel_tol=1e-6)


def test_blocks_grow_with_the_ratings():
    assert als.als_blocks(10, CFG) == 1
    assert als.als_blocks(2_500_000, CFG) == 3
    assert als.als_blocks(10**10, CFG) == 10_001
    assert als.als_blocks(10**10, replace(CFG, als_blocks=7)) == 7


@pytest.fixture(scope="module")
def catalogue(spark):
    recordings = spark.range(1, 62).select(
        F.col("id").cast("int").alias("recording_id"),
        F.concat(F.lit("artist "), F.col("id") % 6).alias("artist_name"),
        *[F.concat(F.lit(f"{name} "), "id").alias(name) for name in dimensions.RECORDING_KEYS if name != "artist_name"],
    )
    pairs = spark.range(31 * 6).select(
        (F.col("id") % 31 + 1).cast("int").alias("user_id"),
        F.concat(F.lit("artist "), F.floor(F.col("id") / 31)).alias("artist_name"),
        F.when(F.col("id") < 93, als.TOP_ARTIST_SET).otherwise(als.SIMILAR_ARTIST_SET).alias("set"),
    )
    return materialise(recordings), materialise(pairs)


def test_playlists(spark, grid, catalogue):
    recordings, pairs = catalogue
    stored = pairs.join(recordings, "artist_name").select("user_id", "recording_id", "set")
    rows = als.recommend(grid.model, stored, recordings, CFG).collect()
    candidates = {tuple(row) for row in stored.collect()}
    playlists = defaultdict(list)
    for row in rows:
        assert (row.user_id, row.recording_id, row["set"]) in candidates
        assert row.track_name == f"track_name {row.recording_id}"
        playlists[row.user_id, row["set"]].append((row["rank"], row.rating))
    # User 31 is unknown to the model.
    assert len(playlists) == 60
    for (_, name), playlist in playlists.items():
        ranks, ratings = zip(*sorted(playlist))
        assert ranks == tuple(range(1, (3 if name == als.TOP_ARTIST_SET else 2) + 1))
        assert list(ratings) == sorted(ratings, reverse=True)
    scored = als.predictions(grid.model, stored).collect()
    for key in [(1, als.TOP_ARTIST_SET), (30, als.SIMILAR_ARTIST_SET)]:
        best = sorted((-row.prediction for row in scored if (row.user_id, row["set"]) == key))
        assert [-rating for _, rating in sorted(playlists[key])] == best[: len(playlists[key])]


def test_scoring_where_candidates_arise_gives_the_same_playlists(grid, catalogue):
    recordings, pairs = catalogue
    stored = pairs.join(recordings, "artist_name").select("user_id", "recording_id", "set")

    def playlists(df):
        return {(r.user_id, r["set"], r["rank"]): (r.recording_id, r.rating) for r in df.collect()}

    one = playlists(als.recommend(grid.model, stored, recordings, CFG))
    other = playlists(als.recommend_from_artists(grid.model, pairs, recordings, CFG))
    assert one.keys() == other.keys()
    for key, (_, rating) in one.items():
        assert math.isclose(rating, other[key][1], rel_tol=1e-4, abs_tol=1e-6)
    assert sum(one[key][0] == other[key][0] for key in one) > 0.95 * len(one)


def test_recordings_that_cannot_be_listed_are_not_scored(spark, grid, catalogue):
    """Artists cut into blocks by norm give the same playlists from far fewer scores."""
    recordings, pairs = catalogue
    known = grid.model.itemFactors.select(F.col("id").alias("recording_id"))
    one_artist = recordings.join(known, "recording_id").withColumn("artist_name", F.lit("artist 0"))
    wanted = pairs.where("artist_name = 'artist 0'")

    def playlists(cfg):
        rows = als.recommend_from_artists(grid.model, wanted, one_artist, cfg).collect()
        return {(r.user_id, r["set"], r["rank"]): (r.recording_id, r.rating) for r in rows}

    whole, cut = replace(CFG, norm_block=100), replace(CFG, norm_block=4)
    assert playlists(cut) == playlists(whole)
    every = als.promising_scores(grid.model, wanted, one_artist, whole).count()
    some = als.promising_scores(grid.model, wanted, one_artist, cut).count()
    assert every == known.count() * 30 and some < 0.7 * every


def test_blocks_of_very_uneven_norms(spark, grid, catalogue):
    """A model whose norms fall fast: two blocks of a long artist suffice, scores of either sign included."""
    class Model:
        rank = 2
        userFactors = spark.createDataFrame([(u, [1.0, (-1.0) ** u]) for u in range(1, 9)], "id int, features array<float>")
        itemFactors = spark.createDataFrame(
            [(i, [(-1.0) ** i * 0.9**i, (-1.0) ** (i // 2) * 0.9**i]) for i in range(1, 301)], "id int, features array<float>"
        )

    described = [F.concat(F.lit(f"{name} "), "id").alias(name) for name in dimensions.RECORDING_KEYS if name != "artist_name"]
    items = spark.range(1, 301).select(F.col("id").cast("int").alias("recording_id"), F.lit("a").alias("artist_name"), *described)
    users = spark.createDataFrame([(u, "a", s) for u in range(1, 10) for s in als.SETS], "user_id int, artist_name string, set string")

    def playlists(block):
        rows = als.recommend_from_artists(Model, users, items, replace(CFG, norm_block=block)).collect()
        return {(r.user_id, r["set"], r["rank"]): (r.recording_id, r.rating) for r in rows}

    assert playlists(20) == playlists(10) == playlists(1000)
    # Of the first block, all are scored and the best go on.
    assert 16 * 20 + als.promising_scores(Model, users, items, replace(CFG, norm_block=20)).count() < 0.1 * 300 * 16


def test_factors_satisfy_the_normal_equations(spark, split):
    cfg = replace(CFG, ranks=(3,), lambdas=(0.1,))
    model = als.fit_grid(split["training"], split["validation"], cfg).model
    rows = als.normal_equations(model, split["training"], cfg.alpha, 0.1).collect()
    assert len(rows) == split["training"].select("user_id").distinct().count()
    assert sum(row.n_ratings for row in rows) == split["training"].count()
    assert max(row.residual for row in rows) < 1e-4
    # Another lambda, another alpha or other counts are noticed.
    for other in (als.normal_equations(model, split["training"], cfg.alpha, 1.0), als.normal_equations(model, split["training"], 4.0, 0.1)):
        assert min(row.residual for row in other.collect()) > 1e-3
    exact = {tuple(row)[:2]: row.score for row in als.factor_scores(model, split["validation"].select("user_id", "recording_id")).collect()}
    for row in als.predictions(model, split["validation"]).collect():
        assert math.isclose(exact[row.user_id, row.recording_id], row.prediction, rel_tol=1e-4, abs_tol=1e-6)


def test_recommendation_status(spark, grid, catalogue):
    recordings, pairs = catalogue
    users = spark.createDataFrame([("one", 1), ("thirty-one", 31)], "user_name string, user_id int")
    requested = spark.createDataFrame([("one",), ("thirty-one",), ("nobody",)], "user_name string")
    playlists = als.recommend_from_artists(grid.model, pairs, recordings, CFG)
    status = {row.user_name: tuple(row)[1:] for row in als.recommendation_status(requested, users, playlists).collect()}
    assert status == {"one": ("ok", 3, 2), "thirty-one": ("no_recommendations", 0, 0), "nobody": ("unknown_user", 0, 0)}


def test_model_round_trip(grid, split, tmp_path):
    path = str(tmp_path / "model")
    grid.model.write().overwrite().save(path)
    loaded = als.load_model(path)
    assert als.rmse(loaded, split["test"]) == pytest.approx(als.rmse(grid.model, split["test"]))


def test_blocks_hold_enough_ids():
    """A hundred recordings fill three blocks, however many ratings there are: more would only copy the users' factors."""
    assert als._side_blocks(20_000_000, 100, CFG) == 3
    assert als._side_blocks(20_000_000, 540_000, CFG) == als.als_blocks(20_000_000, CFG) == 21
    assert als._side_blocks(10, 3, CFG) == 1
    assert als._side_blocks(10**10, 100, replace(CFG, als_blocks=7)) == 7
