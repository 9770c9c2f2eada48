from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from turntable.functions.dates import adjust_days, adjust_months, month_aligned_window, replace_days


def apply(spark, moment, function, dtype="timestamp"):
    row = spark.createDataFrame([(moment,)], f"t {dtype}").select(function(F.col("t")).alias("t"))
    assert row.schema["t"].dataType.simpleString() == dtype
    return row.first().t


@pytest.mark.parametrize("dtype", ["timestamp", "timestamp_ntz"])
def test_calendar_steps(spark, dtype):
    day = datetime(2019, 5, 12, 10, 30)
    assert apply(spark, day, lambda t: replace_days(t, 13), dtype) == datetime(2019, 5, 13, 10, 30)
    assert apply(spark, day, lambda t: adjust_months(t, 3, shift_backwards=False), dtype) == datetime(2019, 8, 12, 10, 30)
    assert apply(spark, day, lambda t: adjust_months(t, 3), dtype) == datetime(2019, 2, 12, 10, 30)
    assert apply(spark, day, lambda t: adjust_days(t, 3, shift_backwards=False), dtype) == datetime(2019, 5, 15, 10, 30)
    assert apply(spark, day, lambda t: adjust_days(t, 3), dtype) == datetime(2019, 5, 9, 10, 30)


def test_shorter_months(spark):
    assert apply(spark, datetime(2019, 1, 31), lambda t: adjust_months(t, 1, False)) == datetime(2019, 2, 28)
    assert apply(spark, datetime(2020, 3, 31), lambda t: adjust_months(t, 1)) == datetime(2020, 2, 29)
    with pytest.raises(PySparkException, match="out of range"):
        apply(spark, datetime(2019, 2, 10), lambda t: replace_days(t, 30))


def test_month_aligned_window():
    as_of = datetime(2019, 7, 15, 12)
    assert month_aligned_window(as_of, 180) == (datetime(2019, 1, 1), as_of)
    assert month_aligned_window(datetime(2019, 7, 3), 7)[0] == datetime(2019, 6, 1)
