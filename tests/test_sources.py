import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from turntable.errors import InvalidWindow, PathNotFound, QueryError, WriteError
from turntable.schemas import LISTEN, MBID_LISTEN
from turntable.sources import listens as table
from turntable.sources.tables import (
    append,
    materialise,
    overwrite,
    read_table,
    run_sql,
    scratch_root,
    sorted_by,
    write_ranking_csv,
)


def months(spark, *dates):
    rows = [(i, date) for i, date in enumerate(dates)]
    return table.with_month(spark.createDataFrame(rows, "id long, listened_at timestamp"))


@pytest.mark.parametrize("partitioned", [True, False])
def test_months_are_whole_and_inclusive(spark, tmp_path, partitioned):
    path = str(tmp_path / "t")
    stored = months(
        spark, datetime(2019, 10, 1), datetime(2019, 11, 30, 23, 59, 59), datetime(2019, 12, 1), datetime(2018, 11, 5),
        datetime(2020, 2, 2),
    )
    table.write_listens(stored, path)
    listens = spark.read.parquet(path) if partitioned else stored.drop("year", "month")

    def ids(start, end):
        return sorted(row.id for row in table.scan_months(listens, start, end).collect())

    assert ids(datetime(2019, 10, 1), datetime(2019, 11, 1)) == [0, 1]
    assert ids(datetime(2019, 10, 20), datetime(2019, 10, 20)) == [0]
    # January is missing, and February must not be skipped from an unaligned day.
    assert ids(datetime(2019, 12, 30), datetime(2020, 2, 1)) == [2, 4]
    assert ids(datetime(2021, 1, 1), datetime(2021, 6, 1)) == []
    assert ids(datetime(2018, 1, 1), datetime(2019, 12, 31)) == [0, 1, 2, 3]
    with pytest.raises(InvalidWindow):
        ids(datetime(2019, 11, 1), datetime(2019, 10, 1))
    assert issubclass(InvalidWindow, ValueError)


def test_recent_listens_are_from_midnight_and_before_now(spark):
    now = datetime(2024, 1, 31, 15)
    at = [datetime(2024, 1, 23, 23, 59), datetime(2024, 1, 24), datetime(2024, 1, 31, 14), now]
    assert [row.id for row in table.recent_listens(months(spark, *at), now, 7).collect()] == [1, 2]


def test_year_drops_blank_and_missing_mbids(spark):
    rows = [(datetime(2017, 1, 1), "m"), (datetime(2017, 5, 1), ""), (datetime(2017, 5, 1), None), (datetime(2018, 1, 1), "m")]
    listens = spark.createDataFrame(rows, "listened_at timestamp, recording_mbid string")
    assert table.listens_of_year(listens, 2017).collect() == [(datetime(2017, 1, 1), "m")]


def test_append_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1, 2)], "column1 long, column2 long")
    append(one, path)
    assert read_table(spark, path).count() == 1
    append(one, path)
    assert read_table(spark, path).count() == 2
    overwrite(one, path)
    assert read_table(spark, path).count() == 1
    assert run_sql(spark, "SELECT * FROM {t}", t=read_table(spark, path)).count() == 1


def test_typed_errors(spark, tmp_path):
    with pytest.raises(PathNotFound):
        read_table(spark, str(tmp_path / "none"))
    with pytest.raises(QueryError, match="parse"):
        run_sql(spark, "SELEC 1")
    with pytest.raises(QueryError, match="analyse"):
        run_sql(spark, "SELECT nothing FROM nowhere")
    path = str(tmp_path / "t")
    table.write_listens(months(spark, datetime(2019, 10, 1)), path)
    with pytest.raises(WriteError):
        table.write_listens(months(spark, datetime(2019, 10, 1)), path)


def test_sql_parameters_are_values(spark):
    names = spark.createDataFrame([("O'Brien \"X\"",), ("U",)], "user_name string")
    found = run_sql(spark, "SELECT * FROM {names} WHERE user_name = :name", {"name": "O'Brien \"X\""}, names=names)
    assert found.count() == 1


def test_ranking_csv_has_no_header_and_keeps_order(spark, tmp_path):
    path = str(tmp_path / "csv")
    ranking = spark.createDataFrame([("a", 1), ("b", 3), ("c", 2), (None, 0)], "artist_mbid string, cnt long")
    write_ranking_csv(ranking, path, [F.desc("cnt"), F.asc("artist_mbid")])
    lines = [line for part in sorted((tmp_path / "csv").glob("part-*")) for line in part.read_text().splitlines()]
    assert lines == ["b,3", "c,2", "a,1", ",0"]


def test_sorted_by_spreads_one_hot_key(spark, tmp_path, many_tasks):
    rows = spark.range(10_000).select(F.lit(1).alias("user_id"), F.col("id").alias("recording_id"))
    overwrite(sorted_by(rows, "user_id", "recording_id"), str(tmp_path / "t"))
    assert len(list((tmp_path / "t").glob("part-*"))) > 1


def test_avro_needs_its_source(spark, tmp_path):
    with pytest.raises(QueryError):
        read_table(spark, str(tmp_path), MBID_LISTEN, "avro")


def test_scratch_is_the_session_checkpoint_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    frame = materialise(spark.range(5))
    assert frame.count() == 5 and scratch_root(spark) in frame.inputFiles()[0]


# ---- ingest

FLAT = {
    "artist_mbids": ["m1"], "artist_msid": "a", "artist_name": "A", "listened_at": "2019-10-05 01:02:03",
    "recording_mbid": "", "recording_msid": "r", "release_mbid": "", "release_msid": "", "release_name": "",
    "tags": [], "track_name": "T", "user_name": "u",
}


def write_lines(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines))


def test_dump_files_become_months(spark, tmp_path):
    dump = tmp_path / "dump"
    # A file's name, not the time inside, decides the month.
    write_lines(dump / "x" / "2019" / "9.json", [FLAT, {**FLAT, "user_name": "v"}])
    write_lines(dump / "x" / "2019" / "10.json", [FLAT, "{not json"])
    write_lines(dump / "x" / "invalid.json", [{**FLAT, "user_name": "w"}])
    write_lines(dump / "x" / "2019" / "10.txt", [FLAT])
    path = str(tmp_path / "listens")
    table.write_listens(table.read_dump(spark, str(dump)), path)
    listens = table.read_listens(spark, path)
    assert listens.drop("year", "month").columns == LISTEN.fieldNames()
    counts = {(r.year, r.month): r["count"] for r in listens.groupBy("year", "month").count().collect()}
    assert counts == {(2019, 9): 2, (2019, 10): 1, (None, None): 2}
    assert {row.user_name for row in table.read_invalid(spark, path).collect()} == {"w", None}
    first = table.scan_months(listens, datetime(2019, 10, 1), datetime(2019, 10, 1)).first()
    assert first.listened_at == datetime(2019, 10, 5, 1, 2, 3) and first.artist_mbids == ["m1"]
    assert table.scan_months(listens, datetime(2002, 1, 1), datetime(2030, 1, 1)).count() == 3


def test_reload_and_month_replacement(spark, tmp_path):
    path = str(tmp_path / "t")

    def ids():
        return sorted(row.id for row in spark.read.parquet(path).collect())

    table.write_listens(months(spark, datetime(2019, 10, 1), datetime(2019, 11, 1)), path)
    replacement = months(spark, datetime(2019, 11, 2)).withColumn("id", F.lit(7).cast("long"))
    table.write_listens(replacement, path, "replace_months")
    assert ids() == [0, 7]
    table.write_listens(replacement, path, "overwrite")
    assert ids() == [7]


def test_replacing_months_keeps_undated_rows(spark, tmp_path):
    path = str(tmp_path / "t")

    def imported(name, invalid, mode):
        write_lines(tmp_path / name / "2019" / "9.json", [{**FLAT, "user_name": name}])
        write_lines(tmp_path / name / "invalid.json", [{**FLAT, "user_name": user} for user in invalid])
        table.write_listens(table.read_dump(spark, str(tmp_path / name)), path, mode)

    imported("first", ["bad1", "bad2"], "replace_months")
    imported("second", ["bad3"], "replace_months")
    imported("second", ["bad3"], "replace_months")
    assert sorted(row.user_name for row in table.read_listens(spark, path).collect()) == ["bad1", "bad2", "bad3", "second"]


def test_flat_times_are_utc_in_any_session_zone(spark, tmp_path):
    write_lines(tmp_path / "2019" / "1.json", [{**FLAT, "listened_at": "2019-01-31T23:30:00"}])
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        listens = table.read_dump(spark, str(tmp_path))
        recent = table.recent_listens(listens, datetime(2019, 2, 1), 1)
        assert recent.count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def raw(additional=None, **extra):
    meta = {"artist_name": "A", "track_name": "T", "additional_info": {"artist_msid": "a", **(additional or {})}}
    return {"listened_at": 0, "user_name": "u", "recording_msid": "r", "track_metadata": {**meta, **extra}}


def test_raw_listens_take_defaults(spark):
    full = raw(
        {"artist_mbids": ["m"], "release_msid": "rl", "release_mbid": "rb", "recording_mbid": "rc", "tags": ["t"]},
        release_name="R",
    )
    nulls = raw(dict.fromkeys(["artist_mbids", "release_msid", "release_mbid", "recording_mbid", "tags"]), release_name=None)
    lines = [json.dumps(raw()), json.dumps(nulls), json.dumps(full), "{broken"]
    frame = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, value string").coalesce(1)
    flat = table.flatten_listens(table.parse_raw_listens(frame)).collect()
    assert flat[0] == flat[1]
    assert flat[0].artist_mbids == [] and flat[0].tags == []
    assert flat[0].release_name == flat[0].release_msid == flat[0].release_mbid == flat[0].recording_mbid == ""
    assert flat[0].listened_at == datetime(1970, 1, 1)
    assert flat[2].artist_mbids == ["m"] and flat[2].tags == ["t"] and flat[2].release_name == "R"
    assert (flat[2].release_msid, flat[2].release_mbid, flat[2].recording_mbid) == ("rl", "rb", "rc")
    assert flat[3].user_name is None and flat[3].listened_at is None


def test_raw_files(spark, tmp_path):
    write_lines(tmp_path / "a" / "b.json", [raw(), {**raw(), "listened_at": 1571000000.25}])
    flat = table.flatten_listens(table.read_raw_listens(spark, str(tmp_path)))
    assert flat.schema.fieldNames() == LISTEN.fieldNames()
    assert [f.dataType for f in flat.schema] == [f.dataType for f in LISTEN]
    assert {row.listened_at for row in flat.collect()} == {datetime(1970, 1, 1), datetime(2019, 10, 13, 20, 53, 20, 250000)}


def test_months_do_not_depend_on_the_session_time_zone(spark, tmp_path):
    path = str(tmp_path / "t")
    lines = spark.createDataFrame([(json.dumps({**raw(), "listened_at": 1577836800}),)], "value string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        flat = table.with_month(table.flatten_listens(table.parse_raw_listens(lines)))
        table.write_listens(flat, path)
        stored = table.read_listens(spark, path)
        assert [(row.year, row.month) for row in stored.collect()] == [(2020, 1)]
        new_year = datetime(2020, 1, 1)
        for frame in (stored, stored.drop("year", "month")):
            assert table.scan_months(frame, new_year, new_year).count() == 1
        assert table.recent_listens(stored, new_year, 7).count() == 0
        assert table.recent_listens(stored, datetime(2020, 1, 1, 0, 0, 1), 0).count() == 1
        assert table.listens_of_year(stored.withColumn("recording_mbid", F.lit("m")), 2020).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_month_files_are_sorted_by_user(spark, tmp_path):
    rows = spark.range(3000).select(
        F.format_string("user %05d", F.pmod(F.xxhash64("id"), F.lit(700))).alias("user_name"),
        F.timestamp_seconds(1570000000 + F.col("id") * 3600).alias("listened_at"),
    )
    table.write_listens(table.with_month(rows.repartition(5)), str(tmp_path / "t"))
    files = list((tmp_path / "t").glob("year=*/month=*/*.parquet"))
    assert len(files) > 4
    for file in files:
        users = [row.user_name for row in spark.read.parquet(str(file)).coalesce(1).collect()]
        assert users == sorted(users)
