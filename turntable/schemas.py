"""Declared row schemas of the tables the jobs read and write."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, nullable) for name, dtype, nullable in fields])


_STRING, _TIMESTAMP, _INT, _FLOAT = T.StringType(), T.TimestampType(), T.IntegerType(), T.FloatType()
_STRINGS = T.ArrayType(_STRING)

LISTEN = _struct(
    ("artist_mbids", _STRINGS, True),
    ("artist_msid", _STRING, False),
    ("artist_name", _STRING, False),
    ("listened_at", _TIMESTAMP, False),
    ("recording_mbid", _STRING, True),
    ("recording_msid", _STRING, False),
    ("release_mbid", _STRING, True),
    ("release_msid", _STRING, True),
    ("release_name", _STRING, True),
    ("tags", _STRINGS, True),
    ("track_name", _STRING, False),
    ("user_name", _STRING, False),
)

#: The listen table at rest: `LISTEN` plus its partition columns.
LISTEN_TABLE = T.StructType(LISTEN.fields + [T.StructField("year", _INT), T.StructField("month", _INT)])

#: One raw submission. `listened_at` is in epoch seconds and may carry a fraction.
RAW_LISTEN = _struct(
    ("listened_at", T.DoubleType(), True),
    ("user_name", _STRING, True),
    ("recording_msid", _STRING, True),
    (
        "track_metadata",
        _struct(
            ("artist_name", _STRING, True),
            ("track_name", _STRING, True),
            ("release_name", _STRING, True),
            (
                "additional_info",
                _struct(
                    ("artist_msid", _STRING, True),
                    ("artist_mbids", _STRINGS, True),
                    ("release_msid", _STRING, True),
                    ("release_mbid", _STRING, True),
                    ("recording_mbid", _STRING, True),
                    ("tags", _STRINGS, True),
                ),
                True,
            ),
        ),
        True,
    ),
)

MODEL_PARAM = _struct(
    ("alpha", _FLOAT, True),
    ("lmbda", _FLOAT, True),
    ("num_iterations", _INT, True),
    ("rank", _INT, True),
)

MODEL_METADATA = _struct(
    ("dataframe_created", _TIMESTAMP, False),
    ("from_date", _TIMESTAMP, False),
    ("listens_count", T.LongType(), False),
    ("model_created", _TIMESTAMP, True),
    ("model_deleted", _TIMESTAMP, True),
    ("model_id", _STRING, False),
    ("model_param", MODEL_PARAM, True),
    ("playcounts_count", T.LongType(), False),
    ("recordings_count", T.LongType(), False),
    ("test_data_count", T.LongType(), True),
    ("test_rmse", _FLOAT, True),
    ("to_date", _TIMESTAMP, False),
    ("training_data_count", T.LongType(), True),
    ("updated", T.BooleanType(), False),
    ("users_count", T.LongType(), False),
    ("validation_data_count", T.LongType(), True),
    ("validation_rmse", _FLOAT, True),
)

MODEL_RUN = _struct(
    ("model_id", _STRING, False),
    ("rank", _INT, False),
    ("lmbda", T.DoubleType(), False),
    ("num_iterations", _INT, False),
    ("validation_rmse", T.DoubleType(), True),
    ("validation_rmse_scored", T.DoubleType(), True),
    ("n_scored", T.LongType(), False),
    ("n_validation", T.LongType(), False),
    ("training_seconds", T.DoubleType(), False),
    ("rmse_seconds", T.DoubleType(), False),
    ("best", T.BooleanType(), False),
)

#: One run that made candidate sets from the build `model_id`.
CANDIDATE_RUN = _struct(
    ("run_id", _STRING, False),
    ("model_id", _STRING, False),
    ("created", _TIMESTAMP, False),
)

#: What one step of a build wrote, and how long it took.
BUILD_STEP = _struct(
    ("model_id", _STRING, False),
    ("step", _STRING, False),
    ("row_count", T.LongType(), False),
    ("seconds", T.DoubleType(), False),
)

#: Months whose partial counts are stored, with a digest of the names of the files they were counted from.
COUNTED_MONTH = _struct(
    ("year", _INT, True),
    ("month", _INT, True),
    ("files", _STRING, False),
)

#: Listens of the second data set, keyed by mbid.
MBID_LISTEN = _struct(
    ("listened_at", _TIMESTAMP, True),
    ("user_name", _STRING, False),
    ("artist_mbid", _STRING, True),
    ("release_mbid", _STRING, True),
    ("recording_mbid", _STRING, True),
)

REQUEST = _struct(
    ("query", _STRING, True),
    ("params", T.MapType(_STRING, _STRING), True),
)
