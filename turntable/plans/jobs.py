"""The batch jobs: each reads tables below a `Layout`, and writes its results there."""

from __future__ import annotations

import hashlib
import re
import time
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from turntable.config import EngineConfig, Layout
from turntable.errors import PathNotFound
from turntable.functions.dates import month_aligned_window
from turntable.operators import als, candidates, dimensions, stats
from turntable.schemas import BUILD_STEP, CANDIDATE_RUN, COUNTED_MONTH, MBID_LISTEN, MODEL_METADATA
from turntable.sources import listens as listen_table
from turntable.sources.builds import bound, candidates_of, latest_dataframes, latest_model, made
from turntable.sources.tables import (
    append,
    drop_path,
    materialise,
    overwrite,
    read_table,
    scratch_scope,
    sorted_by,
    write_ranking_csv,
)


def _now() -> datetime:
    return datetime.now(timezone.utc)


def import_listens(
    spark: SparkSession, json_dir: str, layout: Layout, mode: str = "overwrite", raw: bool = False, dump: str | None = None
) -> None:
    """Load a dump of listens into the month table.

    Flat dumps are bucketed by file name, raw submissions by time. `overwrite` reloads all,
    `replace_months` only the months of this dump, and of rows without a month those of the same `dump` (by default the folder).
    """
    if raw:
        rows = listen_table.with_month(listen_table.flatten_listens(listen_table.read_raw_listens(spark, json_dir)))
        rows = listen_table.of_dump(rows, dump or json_dir)
    else:
        rows = listen_table.read_dump(spark, json_dir, dump)
    listen_table.write_listens(rows, layout.listens, mode)


class _Steps:
    """Writes of a build, each with the rows that it wrote and the time it took."""

    def __init__(self, spark: SparkSession, build: str) -> None:
        self._spark, self._build, self._rows = spark, build, []

    def write(self, step: str, df: DataFrame, path: str, *more: Column, drop: Sequence[str] = ()) -> Row:
        """Overwrite `path` with `df` less some columns; its row count and `more` aggregates, taken while writing.

        They are taken where rows are handed to the writer, after the last shuffle, so that tasks run again are not counted twice.
        """
        seen = Observation()
        started = time.monotonic()
        overwrite(df.observe(seen, F.count(F.lit(1)).alias("row_count"), *more).drop(*drop), path)
        self._rows.append((self._build, step, seen.get["row_count"], time.monotonic() - started))
        return Row(**seen.get)

    def store(self, path: str) -> None:
        append(self._spark.createDataFrame(self._rows, BUILD_STEP), path)


def _numbered(spark: SparkSession, rows: DataFrame, keys: list[str], id_column: str, path: str) -> DataFrame:
    """Rows with the ids registered at `path`, after the keys that are new have been registered."""
    known = spark.createDataFrame([], rows.select(*keys).schema.add(id_column, IntegerType()))
    try:
        known = read_table(spark, path, known.schema)
    except PathNotFound:
        pass
    numbered, new = dimensions.kept_ids(rows, keys, id_column, known)
    append(new, path)
    return numbered


def create_dataframes(spark: SparkSession, layout: Layout, as_of: datetime, cfg: EngineConfig) -> Row:
    """Build the dimensions and play counts of the training window; append and return its metadata.

    The tables go to a folder of their own, named by the id of the build; the row of metadata, appended when all are
    written, makes them the newest. Users and recordings keep the ids of earlier builds. The dimensions are read
    back before they are joined, so ids are the same in all tables. Listens are read once for each table. One build runs at a time.
    """
    start, end = month_aligned_window(as_of, cfg.train_window_days)
    listens = listen_table.scan_months(listen_table.read_listens(spark, layout.listens), start, end)
    build = als.new_model_id(cfg)
    own, steps = layout.of(build), _Steps(spark, build)
    with scratch_scope(spark):
        named = listens.groupBy(*dimensions.USER_KEYS).agg(F.count("*").alias("_listens"))
        users = _numbered(spark, named, dimensions.USER_KEYS, "user_id", layout.ids("users"))
        of_users = steps.write("users", users, own.users, F.sum("_listens").alias("listens"), drop=["_listens"])
        described = listens.select(*dimensions.RECORDING_KEYS)
        recordings = _numbered(spark, described, dimensions.RECORDING_KEYS, "recording_id", layout.ids("recordings"))
        of_recordings = steps.write("recordings", recordings, own.recordings)
        counts = dimensions.playcounts(listens, read_table(spark, own.users), read_table(spark, own.recordings))
        of_counts = steps.write("playcounts", sorted_by(counts, "user_id", "recording_id"), own.playcounts)
    steps.store(layout.build_steps)
    metadata = {
        "dataframe_created": _now(),
        "from_date": start.replace(tzinfo=timezone.utc),
        "to_date": end.replace(tzinfo=timezone.utc),
        "listens_count": of_users.listens or 0,
        "users_count": of_users.row_count,
        "recordings_count": of_recordings.row_count,
        "playcounts_count": of_counts.row_count,
        "model_id": build,
        "updated": False,
    }
    return append_metadata(spark, metadata, layout)


def append_metadata(spark: SparkSession, values: dict, layout: Layout) -> Row:
    """Append one row to the model metadata; fields not given are NULL."""
    row = Row(**{field.name: values.get(field.name) for field in MODEL_METADATA.fields})
    append(spark.createDataFrame([row], MODEL_METADATA), layout.model_metadata)
    return row


def train_models(spark: SparkSession, layout: Layout, cfg: EngineConfig) -> als.GridResult:
    """Search the grid, save the best model under the id of its dataframes, append its metadata."""
    # Collected timestamps are in the local zone of the driver.
    built = {
        name: value.astimezone(timezone.utc) if isinstance(value, datetime) else value
        for name, value in made(latest_dataframes(spark, layout), "create_dataframes").asDict().items()
    }
    own = layout.of(built["model_id"])
    split = als.hash_split(read_table(spark, own.playcounts), cfg)
    parts = {
        name: als.ratings(split.where(F.col("split") == name)).persist(StorageLevel.MEMORY_AND_DISK)
        for name in als.SPLITS
    }
    with scratch_scope(spark, checkpoints=True):
        try:
            grid = als.fit_grid(parts["training"], parts["validation"], cfg, built["model_id"])
            test = als.rmse(grid.model, parts["test"])
            n_training = parts["training"].count()
        finally:
            for part in parts.values():
                part.unpersist()
        grid.model.write().overwrite().save(layout.model(grid.model_id))
    # The fitted factors may need checkpoints that are gone; the stored ones do not.
    grid = grid._replace(model=als.load_model(layout.model(grid.model_id)))
    append(grid.runs, layout.model_runs)
    trained = {
        "model_created": _now(),
        "model_param": Row(
            alpha=cfg.alpha, lmbda=grid.lmbda, num_iterations=grid.num_iterations, rank=grid.rank
        ),
        "training_data_count": n_training,
        "validation_data_count": grid.validation.n,
        "validation_rmse": grid.validation.rmse,
        "test_data_count": test.n,
        "test_rmse": test.rmse,
        "updated": True,
    }
    append_metadata(spark, {**built, **trained}, layout)
    return grid


def build_candidate_sets(
    spark: SparkSession,
    layout: Layout,
    as_of: datetime,
    cfg: EngineConfig,
    requested: DataFrame | None = None,
    expand: bool = True,
) -> None:
    """Write both candidate sets, the artists behind them, the similar artists and each user's status.

    `requested` holds a `user_name` column; without it all users of the window are taken. The tables belong to the
    newest build (or that of the layout) and to a run of their own, which is the newest once all are written. Recommendations need
    only the artists: with `expand=False` the recordings of the artists, a table of all pairs, are not written.
    """
    start, end = month_aligned_window(as_of, cfg.generation_window_days)
    months = listen_table.scan_months(listen_table.read_listens(spark, layout.listens), start, end)
    window = listen_table.recent_listens(months, as_of, cfg.generation_window_days)
    run = uuid.uuid4().hex
    build = bound(spark, layout).build
    own = layout.of(build, run)
    users, recordings = read_table(spark, own.users), read_table(spark, own.recordings)
    if requested is None:
        requested = window
    else:
        window = window.join(dimensions.user_ids(requested, users).select("user_name"), "user_name", "left_semi")
    with scratch_scope(spark):
        top = materialise(candidates.top_artists(window, cfg.top_artists_limit))
        relation = read_table(spark, layout.artists_relation)
        similar = materialise(candidates.similar_artists(relation, cfg.similar_artists_limit))
        overwrite(candidates.similar_artist_report(top, similar), own.similar_artist_report)

        artists = als.candidate_sets_union(
            candidates.top_artists_with_relation(top, similar), candidates.net_similar_artists(top, similar)
        )
        overwrite(dimensions.with_user_id(artists, users), own.candidate_artists)
        artists = read_table(spark, own.candidate_artists)
        of_top, of_similar = (artists.where(F.col("set") == name) for name in als.SETS)
        if expand:
            overwrite(candidates.candidate_recordings(of_top, recordings), own.top_artist_set)
            overwrite(candidates.candidate_recordings(of_similar, recordings), own.similar_artist_set)
        status = candidates.user_status(requested, users, top, of_top, of_similar, recordings)
        overwrite(status, own.user_status)
    append(spark.createDataFrame([(run, build, _now())], CANDIDATE_RUN), layout.candidate_runs)


def build_recommendations(
    spark: SparkSession, layout: Layout, cfg: EngineConfig, requested: DataFrame | None = None
) -> None:
    """Write ranked playlists by the latest model, for all users with candidates or those requested.

    Users, recordings and candidates are those of the model's own build, whatever has been built since; without candidates of
    that build the job does not start.
    """
    model_id = layout.build or made(latest_model(spark, layout), "train_models").model_id
    own = candidates_of(spark, layout, model_id)
    model = als.load_model(layout.model(model_id))
    users, recordings = read_table(spark, own.users), read_table(spark, own.recordings)
    artists = read_table(spark, own.candidate_artists)
    if requested is None:
        requested = read_table(spark, own.user_status).select("user_name")
    else:
        artists = artists.join(dimensions.user_ids(requested, users).select("user_id"), "user_id", "left_semi")
    with scratch_scope(spark):
        overwrite(als.recommend_from_artists(model, artists, recordings, cfg), layout.recommendations)
        playlists = read_table(spark, layout.recommendations)
        overwrite(als.recommendation_status(requested, users, playlists), layout.recommendation_status)


def drop_builds(spark: SparkSession, layout: Layout, keep: int = 2) -> list[str]:
    """Delete the dataframes and candidate sets of all but the newest `keep` builds and that of the latest model; their ids.

    Models and metadata stay. To be run when no job reads an old build any more.
    """
    built = read_table(spark, layout.model_metadata, MODEL_METADATA).where(~F.col("updated"))
    ids = [row.model_id for row in built.orderBy(F.desc("dataframe_created")).select("model_id").collect()]
    latest = latest_model(spark, layout)
    old = [build for build in ids[keep:] if latest is None or build != latest.model_id]
    try:
        runs = read_table(spark, layout.candidate_runs, CANDIDATE_RUN).where(F.col("model_id").isin(old)).collect()
    except PathNotFound:
        runs = []
    for run in runs:
        drop_path(spark, f"{layout.root}/candidate_sets/{run.run_id}")
    for build in old:
        drop_path(spark, f"{layout.root}/dataframes/{build}")
    return old


def refresh_monthly_counts(spark: SparkSession, layout: Layout) -> list[tuple[int, int]]:
    """Count the months whose files have changed since they were counted; these months, as (year, month).

    A month of the listen table is the set of its files, so replaced months are found by file names, without
    reading any listen. Months that are gone lose their counts. What is interrupted is done again by the next call.
    """
    listens = listen_table.read_listens(spark, layout.listens)
    files: dict[tuple[int, int], list[str]] = {}
    for name in listens.inputFiles():
        if found := re.search(r"/year=(\d+)/month=(\d+)/([^/]+)$", name):
            files.setdefault((int(found[1]), int(found[2])), []).append(found[3])
    now = {month: hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest() for month, names in files.items()}
    try:
        counted = {(row.year, row.month): row.files for row in read_table(spark, layout.counted_months, COUNTED_MONTH).collect()}
    except PathNotFound:
        counted = {}
    changed = sorted(month for month, names in now.items() if counted.get(month) != names)
    for year, month in counted.keys() - now.keys():
        drop_path(spark, f"{layout.monthly_artists}/year={year}/month={month}")
    if changed:
        of_months = reduce(Column.__or__, [(F.col("year") == year) & (F.col("month") == month) for year, month in changed])
        partial = stats.monthly_artists(listens.where(of_months))
        balanced = partial.hint("rebalance", "year", "month")
        replaced = balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        replaced.partitionBy("year", "month").parquet(layout.monthly_artists)
    if changed or counted.keys() - now.keys():
        rows = [(year, month, names) for (year, month), names in sorted(now.items())]
        overwrite(spark.createDataFrame(rows, COUNTED_MONTH).coalesce(1), layout.counted_months)
    return changed


def user_stats_from_months(spark: SparkSession, layout: Layout, as_of: datetime, cfg: EngineConfig) -> DataFrame:
    """`user_stats_all` from the stored partial counts, after a refresh: no listen is read."""
    partial = read_table(spark, layout.monthly_artists)
    history = listen_table.scan_months(partial, cfg.stats_epoch, as_of)
    return stats.nest_by_user(stats.merged_artists(history), "artist_stats", "artist_count", cfg.page_size)


def user_stats_all(listens: DataFrame, as_of: datetime, cfg: EngineConfig) -> DataFrame:
    """Artist statistics of every user over all months since the stats epoch, nested per user."""
    history = listen_table.scan_months(listens, cfg.stats_epoch, as_of)
    return stats.nest_by_user(stats.user_artists(history), "artist_stats", "artist_count", cfg.page_size)


def export_artist_popularity(spark: SparkSession, source: str, csv_path: str, fmt: str = "parquet") -> None:
    """Rank the artists of the second data set and write the ranking as headerless CSV.

    `fmt="avro"` reads Avro files, or a glob of them, where the session has that source.
    """
    schema = None if fmt == "avro" else MBID_LISTEN
    ranking = stats.artist_popularity(read_table(spark, source, schema, fmt))
    write_ranking_csv(ranking, csv_path, [F.desc("cnt"), F.asc("artist_mbid")])


def playcounts_by_mbid(listens: DataFrame, year: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Users, recordings and play counts of one year's listens that carry a recording mbid."""
    subset = listen_table.listens_of_year(listens, year)
    users = dimensions.users_dim(subset)
    recordings = dimensions.mbid_recordings_dim(subset)
    return users, recordings, dimensions.playcounts_by_mbid(subset, users, recordings)


def month_row_count(spark: SparkSession, layout: Layout, year: int, month: int) -> int:
    """Number of listens stored for one month."""
    day = datetime(year, month, 1)
    return listen_table.scan_months(listen_table.read_listens(spark, layout.listens), day, day).count()
