"""Named queries answered from JSON requests, in batch or from a stream of files."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from turntable.config import EngineConfig
from turntable.operators import stats
from turntable.plans.jobs import user_stats_all
from turntable.sources.tables import materialise, overwrite, scratch_scope

log = logging.getLogger(__name__)

# Outcome of a request.
BAD_REQUEST = "bad_request"
UNKNOWN_QUERY = "unknown_query"
FAILED = "failed"
OK = "ok"

_RESULT = "result_key string, payload string, counted boolean"


@dataclass(frozen=True)
class Handler:
    """A query that answers all of its requests at once.

    `answer` takes the distinct requests, result_key and the string params of these names, and returns
    result rows with their result_key. `counted` tells which rows count towards a result's size.
    """

    params: tuple[str, ...]
    answer: Callable[[DataFrame], DataFrame]
    counted: Column | None = None


#: Query name -> its handler.
Registry = Mapping[str, Handler]


def default_registry(
    listens: DataFrame | Callable[[], DataFrame], as_of: datetime | Callable[[], datetime], cfg: EngineConfig
) -> Registry:
    """The per-user statistics, for all users or for those named in requests.

    Pass functions where tables and time move on between batches: they are called for each answer.
    """

    def now(value: object) -> object:
        return value() if callable(value) else value

    def for_all(asked: DataFrame) -> DataFrame:
        # Without params all requests are one.
        return user_stats_all(now(listens), now(as_of), cfg).withColumn("result_key", F.lit(asked.first().result_key))

    def for_users(counts: Callable[[DataFrame], DataFrame]) -> Handler:
        def answer(asked: DataFrame) -> DataFrame:
            return counts(now(listens).join(asked, "user_name", "left_semi")).join(asked, "user_name")

        return Handler(("user_name",), answer)

    return {
        "stats.user.all": Handler((), for_all, F.col("page") == 0),
        "stats.user.artists": for_users(stats.user_artists),
        "stats.user.recordings": for_users(stats.user_recordings),
        "stats.user.releases": for_users(stats.user_releases),
    }


def classify(requests: DataFrame, registry: Registry) -> DataFrame:
    """Requests with their query, params and `status`: `ok` here means that a handler takes these params."""
    parsed = F.from_json("message", "query string, params string")
    found = requests.withColumn("_request", parsed).select(
        *requests.columns,
        F.col("_request.query").alias("query"),
        F.coalesce("_request.params", F.lit("{}")).alias("params"),
    )
    given = F.from_json("params", "map<string, string>")
    fits = F.lit(False)
    for name, handler in registry.items():
        wanted = F.array(*map(F.lit, sorted(handler.params))).cast("array<string>")
        has_all = F.sort_array(F.map_keys(given)) == wanted
        for param in handler.params:
            has_all &= F.try_element_at(given, F.lit(param)).isNotNull()
        fits = F.when(F.col("query") == name, F.coalesce(has_all, F.lit(False))).otherwise(fits)
    status = (
        F.when(F.col("query").isNull(), BAD_REQUEST)
        .when(~F.col("query").isin(*registry), UNKNOWN_QUERY)
        .when(fits, OK)
        .otherwise(FAILED)
    )
    ordered = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(given))))
    key = F.when(status == OK, F.sha2(F.concat_ws("\n", "query", ordered), 256))
    return found.select("*", status.alias("status"), key.alias("result_key"))


def _answer(asked: DataFrame, handler: Handler, path: str) -> bool:
    """Answer the requests of one query into `path`, JSON payload rows by result key; False if that failed."""
    given = F.from_json("params", "map<string, string>")
    params = [F.try_element_at(given, F.lit(name)).alias(name) for name in handler.params]
    distinct = asked.select("result_key", *params).distinct()
    try:
        rows = handler.answer(distinct)
        columns = [name for name in rows.columns if name != "result_key"]
        payload = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("payload")
        counted = F.lit(True) if handler.counted is None else handler.counted
        overwrite(rows.select("result_key", payload, counted.alias("counted")), path)
    except Exception:
        # Whatever a handler raises must not stop the other queries; what an earlier attempt left must not stay.
        log.exception("requests below %s failed", path)
        overwrite(asked.sparkSession.createDataFrame([], _RESULT), path)
        return False
    return True


def dispatch(requests: DataFrame, registry: Registry, out_path: str, batch_id: int = 0) -> DataFrame:
    """Answer requests (`request_id`, `message`) and return their responses.

    All requests of a query are answered by one job, whatever their number, into
    `results/batch_id=<n>/query=<name>`; responses go to `responses/batch_id=<n>` and refer to results by
    key. Running a batch again replaces its output. Only the names of the queries asked for, at most those
    of the registry, pass through the driver. Scratch tables go when the batch is answered.
    """
    with scratch_scope(requests.sparkSession):
        return _dispatch(requests, registry, out_path, batch_id)


def _dispatch(requests: DataFrame, registry: Registry, out_path: str, batch_id: int) -> DataFrame:
    spark = requests.sparkSession
    classified = materialise(classify(requests, registry))
    valid = classified.where(F.col("status") == OK)
    names = sorted(row["query"] for row in valid.select("query").distinct().collect())
    root = f"{out_path}/results/batch_id={batch_id}"
    failed = [
        name
        for name in names
        if not _answer(valid.where(F.col("query") == name), registry[name], f"{root}/query={name}")
    ]
    if names:
        results = spark.read.schema(_RESULT).parquet(*[f"{root}/query={name}" for name in names])
    else:
        results = spark.createDataFrame([], _RESULT)
    sizes = results.groupBy("result_key").agg(F.count_if("counted").alias("_rows"))
    status = F.when(F.col("query").isin(failed) & (F.col("status") == OK), FAILED).otherwise(F.col("status"))
    answered = classified.withColumn("status", status).join(sizes, "result_key", "left")
    responses = answered.select(
        "request_id",
        "query",
        "params",
        "status",
        "result_key",
        F.when(F.col("status") == OK, F.coalesce("_rows", F.lit(0))).alias("result_rows"),
    )
    path = f"{out_path}/responses/batch_id={batch_id}"
    overwrite(responses, path)
    return spark.read.schema(responses.schema).parquet(path)


def read_results(spark: SparkSession, out_path: str) -> DataFrame:
    """All published payload rows with their batch, query and result key."""
    schema = "result_key string, payload string, batch_id bigint, query string"
    return spark.read.schema(schema).parquet(f"{out_path}/results")


def read_responses(spark: SparkSession, out_path: str) -> DataFrame:
    """The responses of all batches."""
    schema = "request_id string, query string, params string, status string, result_key string, result_rows bigint"
    return spark.read.schema(f"{schema}, batch_id bigint").parquet(f"{out_path}/responses")


def stream_requests(
    spark: SparkSession,
    in_path: str,
    out_path: str,
    registry: Registry,
    checkpoint: str,
    files_per_batch: int = 100,
    **trigger,
) -> StreamingQuery:
    """Answer requests as files arrive, one JSON message per line; handles every file now by default.

    Batches may be replayed after a failure; `dispatch` then replaces what they had written.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(in_path)
    requests = lines.select(
        F.sha2(F.concat_ws("\n", "_metadata.file_path", "value"), 256).alias("request_id"),
        F.col("value").alias("message"),
    )

    def answer(batch: DataFrame, batch_id: int) -> None:
        dispatch(batch, registry, out_path, batch_id)

    return (
        requests.writeStream.foreachBatch(answer)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
