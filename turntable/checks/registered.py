"""Every operator as a query over the test tables, keyed by name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turntable.config import EngineConfig, Layout
from turntable.functions import dates
from turntable.operators import als, candidates, dimensions, stats
from turntable.operators.ranking import dense_id, positions
from turntable.plans import jobs
from turntable.sources import adapters
from turntable.sources import listens as listen_table
from turntable.sources.tables import materialise, overwrite, run_sql, scratch_path
from turntable.streaming import requests

Query = Callable[[SparkSession, str], DataFrame]

#: The instants the queries take as "now": the events span January 2024, the orders 1995 to 2001.
EVENTS_NOW = datetime(2024, 1, 31)
ORDERS_NOW = datetime(1998, 6, 15)
#: Small limits, so that with the events' twenty artists a user's similar artists are not all top artists.
CONFIG = EngineConfig(top_artists_limit=5, similar_artists_limit=3)
#: The limits that the jobs run with, for the orders, which have many artists.
ORDER_CONFIG = EngineConfig()

REGISTERED: dict[str, Query] = {}


def registered(query: Query) -> Query:
    REGISTERED[query.__name__] = query
    return query


def _text(df: DataFrame) -> DataFrame:
    """Arrays as comma-separated text and timestamps as text, to compare across engines."""
    columns = []
    for name, dtype in df.dtypes:
        column = F.col(name)
        if dtype.startswith("array"):
            column = F.array_join(column, ",")
        elif dtype.startswith("timestamp"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif dtype == "int":
            column = column.cast("bigint")
        columns.append(column.alias(name))
    return df.select(columns)


# ---- statistics


@registered
def user_artists(spark, sf_dir):
    return _text(stats.user_artists(adapters.listens_from_events(spark, sf_dir)))


@registered
def user_recordings(spark, sf_dir):
    return _text(stats.user_recordings(adapters.listens_from_events(spark, sf_dir)))


@registered
def user_releases(spark, sf_dir):
    return _text(stats.user_releases(adapters.listens_from_events(spark, sf_dir)))


@registered
def user_artist_summary(spark, sf_dir):
    return stats.user_artist_summary(adapters.listens_from_events(spark, sf_dir))


def _flat_pages(nested: DataFrame, entries: str, name: str) -> DataFrame:
    line = F.transform(entries, lambda e: F.concat_ws("=", e[name], e["listen_count"].cast("string")))
    return _text(nested.withColumn(entries, line))


@registered
def user_stats_all(spark, sf_dir):
    listens = adapters.listens_from_events(spark, sf_dir)
    return _flat_pages(jobs.user_stats_all(listens, EVENTS_NOW, CONFIG), "artist_stats", "artist_name")


@registered
def user_recording_pages(spark, sf_dir):
    counts = stats.user_recordings(adapters.listens_from_orders(spark, sf_dir))
    return _flat_pages(stats.nest_by_user(counts, "recording_stats", "recording_count", 10), "recording_stats", "recording_msid")


@registered
def user_release_pages(spark, sf_dir):
    counts = stats.user_releases(adapters.listens_from_events(spark, sf_dir))
    return _flat_pages(stats.nest_by_user(counts, "release_stats", "release_count", 7), "release_stats", "release_name")


@registered
def artist_popularity(spark, sf_dir):
    return stats.artist_popularity(adapters.mbid_listens_from_events(spark, sf_dir))


@registered
def artist_popularity_csv(spark, sf_dir):
    """The ranking through its CSV export."""
    source, csv = scratch_path(spark), scratch_path(spark)
    overwrite(adapters.mbid_listens_from_events(spark, sf_dir), source)
    jobs.export_artist_popularity(spark, source, csv, "parquet")
    return spark.read.schema("artist_mbid string, cnt bigint").csv(csv)


@registered
def order_user_artists(spark, sf_dir):
    return _text(stats.user_artists(adapters.listens_from_orders(spark, sf_dir)))


@registered
def order_user_releases(spark, sf_dir):
    return _text(stats.user_releases(adapters.listens_from_orders(spark, sf_dir)))


def _in_order(df: DataFrame) -> DataFrame:
    """Rows of a sorted frame with the position at which they come."""
    # The ids rise from row to row and from partition to partition.
    tagged = materialise(df.withColumn("_came", F.monotonically_increasing_id()))
    return positions(tagged, [], [F.asc("_came")], size="_size").drop("_came", "_size")


@registered
def artist_popularity_order(spark, sf_dir):
    """The ranking with the place of each row."""
    return _in_order(stats.artist_popularity(adapters.mbid_listens_from_events(spark, sf_dir)))


@registered
def order_stats_from_months(spark, sf_dir):
    """Statistics up to a month from partial counts, of which one month is counted anew after it has been replaced."""
    layout = Layout(scratch_path(spark))
    listens = materialise(listen_table.with_month(adapters.listens_from_orders(spark, sf_dir)))
    listen_table.write_listens(listens, layout.listens)
    jobs.refresh_monthly_counts(spark, layout)
    replaced = listens.where((F.col("year") == ORDERS_NOW.year) & (F.col("month") == 1))
    listen_table.write_listens(replaced, layout.listens, "replace_months")
    jobs.refresh_monthly_counts(spark, layout)
    cfg = replace(ORDER_CONFIG, stats_epoch=datetime(1997, 1, 1))
    nested = jobs.user_stats_from_months(spark, layout, ORDERS_NOW, cfg)
    return _flat_pages(nested, "artist_stats", "artist_name")


# ---- listen scans and projections


@registered
def month_range_scan(spark, sf_dir):
    listens = adapters.listens_from_orders(spark, sf_dir)
    start, end = dates.month_aligned_window(ORDERS_NOW, CONFIG.train_window_days)
    return _text(listen_table.scan_months(listens, start, end))


@registered
def month_table_scan(spark, sf_dir):
    """The same scan through the partitioned table."""
    path = scratch_path(spark)
    listen_table.write_listens(listen_table.with_month(adapters.listens_from_orders(spark, sf_dir)), path)
    start, end = dates.month_aligned_window(ORDERS_NOW, CONFIG.train_window_days)
    listens = listen_table.scan_months(spark.read.parquet(path), start, end)
    return _text(listens)


@registered
def recent_listens(spark, sf_dir):
    listens = adapters.listens_from_events(spark, sf_dir)
    return _text(listen_table.recent_listens(listens, EVENTS_NOW, CONFIG.generation_window_days))


@registered
def year_nonblank_listens(spark, sf_dir):
    return _text(listen_table.listens_of_year(adapters.listens_from_events(spark, sf_dir), 2024))


@registered
def listens_projection(spark, sf_dir):
    return _text(listen_table.training_columns(adapters.listens_from_events(spark, sf_dir)))


@registered
def date_helpers(spark, sf_dir):
    day = F.col("o_orderdate")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return _text(
        orders.select(
            "o_orderkey",
            dates.replace_days(day, 13).alias("day_13"),
            dates.adjust_months(day, 3).alias("months_back"),
            dates.adjust_months(day, 3, shift_backwards=False).alias("months_ahead"),
            dates.adjust_days(day, 3).alias("days_back"),
            dates.adjust_days(day, 3, shift_backwards=False).alias("days_ahead"),
        )
    )


def _epoch_and_text(flat: DataFrame) -> DataFrame:
    return _text(flat.withColumn("listened_at", F.unix_seconds("listened_at")))


@registered
def flatten_raw_listens(spark, sf_dir):
    raw = listen_table.parse_raw_listens(adapters.raw_listens_from_events(spark, sf_dir))
    return _epoch_and_text(listen_table.flatten_listens(raw))


@registered
def import_raw_listens(spark, sf_dir):
    """Raw JSON files into the month table and back."""
    dump, table = scratch_path(spark), scratch_path(spark)
    adapters.raw_listens_from_events(spark, sf_dir).withColumnRenamed("value", "text").write.format("text").save(
        f"{dump}/text"
    )
    raw = listen_table.parse_raw_listens(spark.read.text(f"{dump}/text"))
    listen_table.write_listens(listen_table.with_month(listen_table.flatten_listens(raw)), table)
    start, end = dates.month_aligned_window(EVENTS_NOW, CONFIG.generation_window_days)
    return _epoch_and_text(listen_table.scan_months(listen_table.read_listens(spark, table), start, end))


@registered
def sql_user_counts(spark, sf_dir):
    """A query text with a named parameter over a DataFrame."""
    listens = adapters.listens_from_events(spark, sf_dir)
    text = "SELECT user_name, count(*) AS listens FROM {listens} WHERE artist_name <> :artist GROUP BY user_name"
    return run_sql(spark, text, {"artist": "artist_1"}, listens=listens)


# ---- dimensions and play counts


def _stored_orders(spark: SparkSession, sf_dir: str, fan_out: bool = False) -> DataFrame:
    """What the dimensions and windows take of the order listens, for queries that read it several times."""
    listens = adapters.listens_from_orders(spark, sf_dir, fan_out)
    return materialise(listens.select("listened_at", "user_name", *dimensions.RECORDING_KEYS))


def _dims(listens: DataFrame) -> tuple[DataFrame, DataFrame]:
    return dimensions.users_dim(listens), dimensions.recordings_dim(listens)


def _playcounts(listens: DataFrame) -> DataFrame:
    return dimensions.playcounts(listens, *_dims(listens))


@registered
def users_dim(spark, sf_dir):
    return _text(dimensions.users_dim(adapters.listens_from_events(spark, sf_dir)))


@registered
def recordings_dim(spark, sf_dir):
    return _text(dimensions.recordings_dim(adapters.listens_from_events(spark, sf_dir)))


@registered
def order_users_dim(spark, sf_dir):
    return _text(dimensions.users_dim(adapters.listens_from_orders(spark, sf_dir)))


@registered
def order_recordings_dim(spark, sf_dir):
    return _text(dimensions.recordings_dim(adapters.listens_from_orders(spark, sf_dir)))


def _requested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One requested user per customer, of whom many do not occur in the events."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return customers.select(F.concat(F.lit("user_"), F.col("c_custkey") - 1).alias("user_name"))


@registered
def user_id_lookup(spark, sf_dir):
    users = dimensions.users_dim(adapters.listens_from_events(spark, sf_dir))
    return _text(dimensions.user_ids(_requested(spark, sf_dir), users))


@registered
def unknown_users(spark, sf_dir):
    users = dimensions.users_dim(adapters.listens_from_events(spark, sf_dir))
    return dimensions.unknown_users(_requested(spark, sf_dir), users)


@registered
def playcounts(spark, sf_dir):
    return _text(_playcounts(adapters.listens_from_events(spark, sf_dir)))


@registered
def order_playcounts(spark, sf_dir):
    return _text(_playcounts(_stored_orders(spark, sf_dir)))


@registered
def order_playcounts_fan_out(spark, sf_dir):
    """Play counts where a recording_msid has many metadata variants, summed up per user."""
    counts = _playcounts(_stored_orders(spark, sf_dir, fan_out=True))
    totals = counts.groupBy("user_id").agg(
        F.count("*").alias("recordings"), F.sum("count").alias("listens"), F.max("recording_id").alias("last_id")
    )
    return _text(totals)


@registered
def mbid_recording_ids(spark, sf_dir):
    subset = listen_table.listens_of_year(adapters.listens_from_events(spark, sf_dir), 2024)
    return _text(dimensions.mbid_recordings_dim(subset))


@registered
def mbid_playcounts(spark, sf_dir):
    return _text(jobs.playcounts_by_mbid(adapters.listens_from_events(spark, sf_dir), 2024)[2])


@registered
def mbid_playcount_audit(spark, sf_dir):
    users, recordings, counts = jobs.playcounts_by_mbid(adapters.listens_from_events(spark, sf_dir), 2024)
    return _text(dimensions.playcount_audit(counts, users, recordings))


@registered
def mbid_playcounts_order(spark, sf_dir):
    """The play counts with the place of each row."""
    return _text(_in_order(jobs.playcounts_by_mbid(adapters.listens_from_events(spark, sf_dir), 2024)[2]))


@registered
def mbid_playcount_audit_order(spark, sf_dir):
    users, recordings, counts = jobs.playcounts_by_mbid(adapters.listens_from_events(spark, sf_dir), 2024)
    return _text(_in_order(dimensions.playcount_audit(counts, users, recordings)))


@registered
def mbid_playcount_audit_of_user(spark, sf_dir):
    users, recordings, counts = jobs.playcounts_by_mbid(adapters.listens_from_events(spark, sf_dir), 2024)
    return _text(dimensions.playcount_audit(counts, users, recordings, "user_1"))


def _kept(spark: SparkSession, sf_dir: str, keys: list[str], id_column: str) -> DataFrame:
    """Ids of all keys where those of the orders up to a day had been numbered before."""
    listens = _stored_orders(spark, sf_dir)
    early = dense_id(listens.where(F.col("listened_at") < ORDERS_NOW).select(*keys).distinct(), keys, id_column)
    return dimensions.kept_ids(listens.select(*keys), keys, id_column, early)[0]


@registered
def order_users_kept_ids(spark, sf_dir):
    return _text(_kept(spark, sf_dir, dimensions.USER_KEYS, "user_id"))


@registered
def order_recordings_kept_ids(spark, sf_dir):
    return _text(_kept(spark, sf_dir, dimensions.RECORDING_KEYS, "recording_id"))


@registered
def table_counts(spark, sf_dir):
    """Row counts of what the dataframe job writes."""
    listens = adapters.listens_from_events(spark, sf_dir)
    users, recordings = _dims(listens)
    tables = {
        "listens": listens,
        "users": users,
        "recordings": recordings,
        "playcounts": dimensions.playcounts(listens, users, recordings),
    }
    counted = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = counted[0]
    for one in counted[1:]:
        result = result.unionByName(one)
    return result


# ---- candidate sets


class _Candidates:
    """The inputs and intermediate tables of the candidate sets over one adapter."""

    def __init__(self, spark: SparkSession, sf_dir: str, orders: bool = False):
        cfg = ORDER_CONFIG if orders else CONFIG
        if orders:
            self.listens, now = _stored_orders(spark, sf_dir), ORDERS_NOW
            self.relation = adapters.relation_from_orders(spark, sf_dir)
        else:
            self.listens, now = adapters.listens_from_events(spark, sf_dir), EVENTS_NOW
            self.relation = adapters.relation_from_events(spark, sf_dir)
        window = listen_table.recent_listens(self.listens, now, cfg.generation_window_days)
        self.top = materialise(candidates.top_artists(window, cfg.top_artists_limit))
        self.similar = materialise(candidates.similar_artists(self.relation, cfg.similar_artists_limit))

    @property
    def with_relation(self) -> DataFrame:
        return candidates.top_artists_with_relation(self.top, self.similar)

    @property
    def net_similar(self) -> DataFrame:
        return candidates.net_similar_artists(self.top, self.similar)

    def recordings_of(self, artists: DataFrame, users: DataFrame, recordings: DataFrame) -> DataFrame:
        return candidates.candidate_recordings(materialise(dimensions.with_user_id(artists, users)), recordings)

    def top_set(self, users: DataFrame, recordings: DataFrame) -> DataFrame:
        return self.recordings_of(self.with_relation, users, recordings)

    def similar_set(self, users: DataFrame, recordings: DataFrame) -> DataFrame:
        return self.recordings_of(self.net_similar, users, recordings)

    def status(self, requested: DataFrame) -> DataFrame:
        users, recordings = _dims(self.listens)
        return candidates.user_status(
            requested, users, self.top, materialise(self.with_relation), materialise(self.net_similar), recordings
        )


@registered
def undirected_relations(spark, sf_dir):
    return candidates.undirected(adapters.relation_from_events(spark, sf_dir))


@registered
def order_undirected_relations(spark, sf_dir):
    return candidates.undirected(adapters.relation_from_orders(spark, sf_dir))


@registered
def similar_artists(spark, sf_dir):
    return _text(candidates.similar_artists(adapters.relation_from_events(spark, sf_dir), CONFIG.similar_artists_limit))


@registered
def order_similar_artists(spark, sf_dir):
    return _text(candidates.similar_artists(adapters.relation_from_orders(spark, sf_dir), ORDER_CONFIG.similar_artists_limit))


@registered
def top_artists(spark, sf_dir):
    listens = adapters.listens_from_events(spark, sf_dir)
    window = listen_table.recent_listens(listens, EVENTS_NOW, CONFIG.generation_window_days)
    return _text(candidates.top_artists(window, CONFIG.top_artists_limit))


@registered
def order_top_artists(spark, sf_dir):
    """Top artists over the whole history, not only the window."""
    return _text(candidates.top_artists(adapters.listens_from_orders(spark, sf_dir), ORDER_CONFIG.top_artists_limit))


@registered
def top_artists_with_relation(spark, sf_dir):
    return _Candidates(spark, sf_dir).with_relation


@registered
def net_similar_artists(spark, sf_dir):
    return _Candidates(spark, sf_dir).net_similar


@registered
def similar_artist_report(spark, sf_dir):
    inputs = _Candidates(spark, sf_dir)
    return _text(candidates.similar_artist_report(inputs.top, inputs.similar))


@registered
def top_artist_candidates(spark, sf_dir):
    inputs = _Candidates(spark, sf_dir)
    return _text(inputs.top_set(*_dims(inputs.listens)))


@registered
def similar_artist_candidates(spark, sf_dir):
    inputs = _Candidates(spark, sf_dir)
    return _text(inputs.similar_set(*_dims(inputs.listens)))


@registered
def candidate_sets(spark, sf_dir):
    """Both sets of all users in one frame."""
    inputs = _Candidates(spark, sf_dir)
    dims = _dims(inputs.listens)
    return _text(als.candidate_sets_union(inputs.top_set(*dims), inputs.similar_set(*dims)))


@registered
def order_top_artist_candidates(spark, sf_dir):
    inputs = _Candidates(spark, sf_dir, orders=True)
    return _text(inputs.top_set(*_dims(inputs.listens)))


@registered
def order_similar_artist_candidates(spark, sf_dir):
    inputs = _Candidates(spark, sf_dir, orders=True)
    return _text(inputs.similar_set(*_dims(inputs.listens)))


@registered
def user_status(spark, sf_dir):
    return _Candidates(spark, sf_dir).status(_requested(spark, sf_dir))


@registered
def order_user_status(spark, sf_dir):
    requested = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_name").alias("user_name"))
    return _Candidates(spark, sf_dir, orders=True).status(requested)


# ---- recommender


@registered
def hash_split_counts(spark, sf_dir):
    split = als.hash_split(_playcounts(adapters.listens_from_events(spark, sf_dir)), CONFIG)
    return split.groupBy("split").agg(F.count("*").alias("row_count"), F.sum("count").alias("listens"))


class _Trained(_Candidates):
    """The candidate sets over the events, the split of the play counts, and the winner of the whole grid."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir)
        self.users, self.recordings = map(materialise, _dims(self.listens))
        counts = dimensions.playcounts(self.listens, self.users, self.recordings)
        self.split = materialise(als.hash_split(counts, CONFIG))
        parts = [als.ratings(self.part(name)).persist() for name in als.SPLITS[:2]]
        try:
            grid = als.fit_grid(*parts, CONFIG)
        finally:
            for part in parts:
                part.unpersist()
        path = scratch_path(spark)
        grid.model.write().save(path)
        self.grid, self.model = grid, als.load_model(path)

    def part(self, name: str) -> DataFrame:
        return self.split.where(F.col("split") == name).drop("split")

    @property
    def artists(self) -> DataFrame:
        return dimensions.with_user_id(als.candidate_sets_union(self.with_relation, self.net_similar), self.users)

    @property
    def candidates(self) -> DataFrame:
        dims = self.users, self.recordings
        return als.candidate_sets_union(self.top_set(*dims), self.similar_set(*dims))


_TRAINED: dict[tuple[str, str], _Trained] = {}


def _trained(spark: SparkSession, sf_dir: str) -> _Trained:
    """What the queries on a model share: it is trained and stored once in an application, as the jobs do."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _TRAINED:
        _TRAINED.clear()
        _TRAINED[key] = _Trained(spark, sf_dir)
    return _TRAINED[key]


@registered
def als_model_runs(spark, sf_dir):
    """The whole grid of eight fits."""
    return _trained(spark, sf_dir).grid.runs


@registered
def als_recommendations(spark, sf_dir):
    """Playlists of all users from stored candidates, by the winner of the grid."""
    trained = _trained(spark, sf_dir)
    return als.recommend(trained.model, trained.candidates, trained.recordings, CONFIG)


@registered
def als_artist_recommendations(spark, sf_dir):
    """The same playlists, scored while the candidates are expanded."""
    trained = _trained(spark, sf_dir)
    return als.recommend_from_artists(trained.model, trained.artists, trained.recordings, CONFIG)


@registered
def als_normal_equations(spark, sf_dir):
    """Users of the training data, with their ratings, whose published factors satisfy their normal equations."""
    trained = _trained(spark, sf_dir)
    training = als.ratings(trained.part(als.SPLITS[0]))
    equations = als.normal_equations(trained.model, training, CONFIG.alpha, trained.grid.lmbda)
    return equations.select(F.col("user_id").cast("bigint").alias("user_id"), "n_ratings", (F.col("residual") < 1e-3).alias("satisfied"))


@registered
def als_grid_audit(spark, sf_dir):
    """Each fit with its rows of validation data, and whether the errors are those that the published factors give."""
    trained = _trained(spark, sf_dir)
    validation = als.ratings(trained.part(als.SPLITS[1]))
    squared = F.pow(F.col("score") - F.col("count"), F.lit(2))
    squares = als.factor_scores(trained.model, validation).agg(F.sum(squared)).first()[0]
    runs = trained.grid.runs
    least = runs.agg(F.min("validation_rmse")).first()[0]
    error = F.sqrt(F.lit(squares) / F.col("n_validation"))
    right = F.abs(error - F.col("validation_rmse")) < 1e-4 * error
    return runs.select(
        F.col("rank").cast("bigint").alias("rank"),
        "lmbda",
        F.col("num_iterations").cast("bigint").alias("num_iterations"),
        "n_validation",
        "n_scored",
        F.when(F.col("best"), right & (F.col("validation_rmse") == least)).otherwise(True).alias("consistent"),
    )


def _playlist_audit(trained: _Trained, playlists: DataFrame) -> DataFrame:
    """Per user and set: candidates the model knows, entries of the playlist, and whether ranks and scores are right and none better is left out."""
    scored = als.factor_scores(trained.model, trained.candidates)
    listed = playlists.select("user_id", "set", "recording_id", "rank", "rating")
    keys = ["user_id", "set"]
    both = scored.join(listed, [*keys, "recording_id"], "full")
    found = both.groupBy(*keys).agg(
        F.count("score").alias("n_candidates"),
        F.count("rank").alias("n_listed"),
        F.max("rank").alias("_last"),
        F.count_distinct("rank").alias("_ranks"),
        F.max(F.when(F.col("rank").isNotNull(), F.abs(F.col("score") - F.col("rating")))).alias("_off"),
        F.min("rating").alias("_worst"),
        F.max(F.when(F.col("rank").isNull(), F.col("score"))).alias("_best_left"),
        F.count_if(F.col("score").isNull()).alias("_strange"),
    )
    return found.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        "set",
        "n_candidates",
        "n_listed",
        ((F.col("_last") == F.col("n_listed")) & (F.col("_ranks") == F.col("n_listed"))).alias("ranks_complete"),
        ((F.col("_off") < 1e-4) & (F.col("_strange") == 0)).alias("scores_right"),
        (F.coalesce("_best_left", "_worst") <= F.col("_worst") + 1e-5).alias("none_better"),
    )


@registered
def als_recommendations_audit(spark, sf_dir):
    """The playlists from stored candidates against all scores."""
    trained = _trained(spark, sf_dir)
    return _playlist_audit(trained, als_recommendations(spark, sf_dir))


@registered
def als_artist_recommendations_audit(spark, sf_dir):
    """The playlists scored where candidates arise, artists cut into blocks of few recordings, against all scores."""
    trained = _trained(spark, sf_dir)
    cfg = replace(CONFIG, norm_block=2)
    return _playlist_audit(trained, als.recommend_from_artists(trained.model, trained.artists, trained.recordings, cfg))


# ---- requests


def _registry(spark: SparkSession, sf_dir: str) -> requests.Registry:
    return requests.default_registry(adapters.listens_from_events(spark, sf_dir), EVENTS_NOW, CONFIG)


@registered
def dispatch_results(spark, sf_dir):
    messages = adapters.requests_from_events(spark, sf_dir)
    responses = requests.dispatch(messages, _registry(spark, sf_dir), scratch_path(spark))
    return responses.select("request_id", "status", F.coalesce("result_rows", F.lit(0)).alias("result_rows"))


@registered
def published_user_stats(spark, sf_dir):
    """What the requests publish for all users, read back from its JSON payload."""
    out = scratch_path(spark)
    requests.dispatch(adapters.requests_from_events(spark, sf_dir), _registry(spark, sf_dir), out)
    payload = "user_name string, artist_count bigint, artist_stats array<struct<artist_name: string, listen_count: bigint>>"
    published = requests.read_results(spark, out).select(F.from_json("payload", payload).alias("p")).select("p.*")
    listed = F.transform("artist_stats", lambda e: F.concat_ws("=", e["artist_name"], e["listen_count"].cast("string")))
    return published.where("artist_stats IS NOT NULL").select(
        "user_name", "artist_count", F.array_join(listed, ",").alias("artist_stats")
    )


@registered
def dispatch_stream(spark, sf_dir):
    """The same requests as files of a stream, counted by outcome."""
    inbox, out = scratch_path(spark), scratch_path(spark)
    adapters.requests_from_events(spark, sf_dir).select("message").write.text(inbox)
    query = requests.stream_requests(spark, inbox, out, _registry(spark, sf_dir), scratch_path(spark))
    query.awaitTermination()
    return (
        requests.read_responses(spark, out)
        .groupBy("status", F.coalesce("query", F.lit("")).alias("query"))
        .agg(F.count("*").alias("requests"))
    )
