"""Ingest of listens and the month-partitioned listen table."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turntable.errors import InvalidWindow, PathNotFound, WriteError
from turntable.schemas import LISTEN, LISTEN_TABLE, RAW_LISTEN
from turntable.sources.tables import drop_path, materialise, read_table, scratch_scope

_NO_STRINGS = "array<string>"
_NO_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder of rows without a partition value


def parse_raw_listens(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON text of raw submissions as nested rows; a malformed line becomes a row of NULLs."""
    return lines.select(F.from_json(F.col(column), RAW_LISTEN).alias("raw")).select("raw.*")


def read_raw_listens(spark: SparkSession, json_dir: str) -> DataFrame:
    """Nested raw submissions from every `.json` file below a folder."""
    reader = spark.read.schema(RAW_LISTEN).option("pathGlobFilter", "*.json").option("recursiveFileLookup", True)
    return reader.json(json_dir)


def flatten_listens(raw: DataFrame) -> DataFrame:
    """Nested raw submissions as `LISTEN` rows.

    An optional field that is absent or null takes its default, `''` or `[]`: `from_json` cannot
    tell the two apart. Epoch seconds become timestamps, so the session time zone only matters
    for display.
    """
    meta, info = "track_metadata", "track_metadata.additional_info"

    def text(path: str) -> Column:
        return F.coalesce(F.col(path), F.lit(""))

    def texts(path: str) -> Column:
        return F.coalesce(F.col(path), F.array().cast(_NO_STRINGS))

    return raw.select(
        texts(f"{info}.artist_mbids").alias("artist_mbids"),
        F.col(f"{info}.artist_msid").alias("artist_msid"),
        F.col(f"{meta}.artist_name").alias("artist_name"),
        F.timestamp_seconds("listened_at").alias("listened_at"),
        text(f"{info}.recording_mbid").alias("recording_mbid"),
        F.col("recording_msid"),
        text(f"{info}.release_mbid").alias("release_mbid"),
        text(f"{info}.release_msid").alias("release_msid"),
        text(f"{meta}.release_name").alias("release_name"),
        texts(f"{info}.tags").alias("tags"),
        F.col(f"{meta}.track_name").alias("track_name"),
        F.col("user_name"),
    )


def with_month(listens: DataFrame) -> DataFrame:
    """Add partition columns from `listened_at` in UTC; a row without a time gets none.

    The month of a listen must not depend on the time zone of the session that stored it.
    """
    time = F.col("listened_at")
    if listens.schema["listened_at"].dataType == T.TimestampType():
        time = F.to_utc_timestamp(time, F.current_timezone())
    return listens.withColumn("year", F.year(time)).withColumn("month", F.month(time))


def read_dump(spark: SparkSession, json_dir: str, dump: str | None = None) -> DataFrame:
    """Flat listens of a dump, bucketed by file name as `<year>/<month>.json`.

    Rows of any other file, such as `invalid.json`, and rows without a readable time get no year
    and month. Times without a zone are UTC, whatever the session's zone. Each row carries the name of its dump,
    the folder unless another is given.
    """
    rows = (
        spark.read.schema(LISTEN)
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", True)
        .option("timeZone", "UTC")
        .json(json_dir)
        .select("*", F.col("_metadata.file_path").alias("_file"))
    )

    def part(group: int) -> Column:
        found = F.regexp_extract("_file", r"/(\d{4})/(\d{1,2})\.json$", group)
        return F.when(F.col("listened_at").isNotNull(), F.nullif(found, F.lit("")).cast("int"))

    dated = rows.withColumn("year", part(1)).withColumn("month", part(2)).drop("_file")
    return of_dump(dated, dump or json_dir)


def of_dump(listens: DataFrame, dump: str) -> DataFrame:
    """Listens with the name of the dump they come from."""
    return listens.withColumn("dump", F.lit(dump.rstrip("/")))


def _undated() -> Column:
    return F.col("year").isNull() | F.col("month").isNull()


def write_listens(listens: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write bucketed listens (`read_dump`, `with_month`) as the year/month-partitioned table.

    `mode="overwrite"` reloads the whole table; `mode="replace_months"` replaces only the months
    present in `listens`. Rows without a month are kept in the table's null partition, which
    `scan_months` prunes and `read_invalid` returns. There, rows are replaced by dump: those of the dumps in `listens`
    go, those of others stay, so neither are earlier ones lost nor does a repeated import double them. Rows that
    carry no dump are added if the table does not hold them yet. The rebalance groups each month's rows for
    the writer and splits a month that is too large for one task. Within a file, rows are sorted
    by user, so that a query for one user skips most row groups; the writer has to sort by month
    anyway.
    """
    if mode != "replace_months":
        _write_months(listens, path, mode)
    elif "dump" in listens.columns:
        with scratch_scope(listens.sparkSession):
            _replace_months(listens, path)
    else:
        _write_months(listens.where(~_undated()), path, mode)
        _write_months(_not_held(listens.where(_undated()), path), path, "append")


def _replace_months(listens: DataFrame, path: str) -> None:
    """Replace months, and in the null partition the rows of the same dumps; other rows there are written again."""
    spark = listens.sparkSession
    try:
        held = read_table(spark, path, T.StructType([*LISTEN_TABLE.fields, T.StructField("dump", T.StringType())]))
    except PathNotFound:
        return _write_months(listens, path, "replace_months")
    dumps = materialise(listens.select("dump").distinct())
    undated = held.where(_undated())
    others = materialise(undated.join(dumps, undated["dump"].eqNullSafe(dumps["dump"]), "left_anti"))
    if others.isEmpty() and listens.where(_undated()).isEmpty():
        # A partition that nothing is written to would stay as it is.
        drop_path(spark, f"{path}/year={_NO_PARTITION}")
    _write_months(listens.unionByName(others.select(listens.columns)), path, "replace_months")


def _not_held(undated: DataFrame, path: str) -> DataFrame:
    try:
        held = read_table(undated.sparkSession, path, undated.schema)
    except PathNotFound:
        return undated
    return undated.exceptAll(held.where(_undated()))


def _write_months(listens: DataFrame, path: str, mode: str) -> None:
    order = ["year", "month", *[name for name in ("user_name",) if name in listens.columns]]
    balanced = listens.hint("rebalance", "year", "month").sortWithinPartitions(*order)
    writer = balanced.write.partitionBy("year", "month")
    if mode == "replace_months":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    elif mode == "overwrite":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "static")
    else:
        writer = writer.mode(mode)
    try:
        writer.parquet(path)
    except PySparkException as err:
        raise WriteError(f"cannot write {path}: {err}") from err


def read_listens(spark: SparkSession, path: str) -> DataFrame:
    """The listen table with its partition columns."""
    return read_table(spark, path, LISTEN_TABLE)


def read_invalid(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the listen table that belong to no month."""
    return read_listens(spark, path).where(_undated()).drop("year", "month")


def instant(listens: DataFrame, moment: datetime, column: str = "listened_at") -> Column:
    """A literal of the column's own timestamp type, so that comparisons reach the scan.

    `moment` is naive and in UTC, whatever the session's time zone.
    """
    dtype = listens.schema[column].dataType
    zone = "Z" if dtype == T.TimestampType() else ""
    return F.lit(moment.isoformat(sep=" ") + zone).cast(dtype)


def scan_months(listens: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Listens of every month from that of `start` to that of `end`, both whole.

    On the partitioned table this is a partition predicate; elsewhere a range on `listened_at`.
    Missing months add nothing.
    """
    if end < start:
        raise InvalidWindow(f"window ends at {end}, before its start {start}")
    if {"year", "month"} <= set(listens.columns):
        year, month = F.col("year"), F.col("month")
        from_start = (year > start.year) | ((year == start.year) & (month >= start.month))
        to_end = (year < end.year) | ((year == end.year) & (month <= end.month))
        return listens.where(from_start & to_end).drop("year", "month")
    lower = start.replace(day=1, hour=0, minute=0, second=0, microsecond=0)
    upper = datetime(end.year + end.month // 12, end.month % 12 + 1, 1)
    time = F.col("listened_at")
    return listens.where((time >= instant(listens, lower)) & (time < instant(listens, upper)))


def recent_listens(listens: DataFrame, as_of: datetime, days: int) -> DataFrame:
    """Listens from midnight `days` before `as_of` up to, not including, `as_of`."""
    midnight = (as_of - timedelta(days=days)).replace(hour=0, minute=0, second=0, microsecond=0)
    time = F.col("listened_at")
    return listens.where((time >= instant(listens, midnight)) & (time < instant(listens, as_of)))


def listens_of_year(listens: DataFrame, year: int) -> DataFrame:
    """Listens of one year that have a recording mbid.

    The year is a range, not `year(listened_at)`, so that it reaches the scan.
    """
    time = F.col("listened_at")
    in_year = (time >= instant(listens, datetime(year, 1, 1))) & (time < instant(listens, datetime(year + 1, 1, 1)))
    return listens.where(in_year & (F.col("recording_mbid") != ""))


def training_columns(listens: DataFrame) -> DataFrame:
    """The columns of a listen that the play counts are built from."""
    return listens.select("listened_at", "track_name", "recording_msid", "user_name")
