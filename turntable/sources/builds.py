"""Which build of the dataframes, model and run of the candidate sets is the newest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from turntable.config import Layout
from turntable.errors import NotReady, PathNotFound
from turntable.schemas import CANDIDATE_RUN, MODEL_METADATA
from turntable.sources.tables import read_table


def _newest(rows: DataFrame, moment: str) -> Row | None:
    return rows.agg(F.max_by(F.struct("*"), moment).alias("newest")).first().newest


def latest_dataframes(spark: SparkSession, layout: Layout) -> Row | None:
    """Metadata of the latest build of the dataframes."""
    return _newest(read_table(spark, layout.model_metadata, MODEL_METADATA).where(~F.col("updated")), "dataframe_created")


def latest_model(spark: SparkSession, layout: Layout) -> Row | None:
    """Metadata of the latest trained model."""
    trained = read_table(spark, layout.model_metadata, MODEL_METADATA).where("updated AND model_deleted IS NULL")
    return _newest(trained, "model_created")


def latest_candidate_run(spark: SparkSession, layout: Layout, build: str | None = None) -> Row | None:
    """The latest run that made candidate sets, of one build if it is named."""
    runs = read_table(spark, layout.candidate_runs, CANDIDATE_RUN)
    return _newest(runs if build is None else runs.where(F.col("model_id") == build), "created")


def made(found: Row | None, job: str) -> Row:
    if found is None:
        raise NotReady(f"run {job} first")
    return found


def _active() -> SparkSession:
    spark = SparkSession.getActiveSession()
    if spark is None:
        raise NotReady("bind the layout to a build, or start a session that can look it up")
    return spark


def newest_build(layout: Layout) -> str:
    return made(latest_dataframes(_active(), layout), "create_dataframes").model_id


def newest_candidate_run(layout: Layout) -> str:
    return made(latest_candidate_run(_active(), layout, layout.build), "build_candidate_sets").run_id


def bound(spark: SparkSession, layout: Layout) -> Layout:
    """The layout bound to its build, the newest unless it has one."""
    return layout if layout.build else layout.of(made(latest_dataframes(spark, layout), "create_dataframes").model_id)


def candidates_of(spark: SparkSession, layout: Layout, build: str) -> Layout:
    """The layout bound to a build and the latest candidate sets made from it; an error if there are none."""
    if layout.candidate_run:
        return layout.of(build, layout.candidate_run)
    try:
        run = latest_candidate_run(spark, layout, build)
    except PathNotFound:
        run = None
    if run is None:
        raise NotReady(f"run build_candidate_sets for the build {build} first")
    return layout.of(build, run.run_id)
