import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripweave.functions import (
    bike_time_cell, cell_date, cell_hour, cell_key, known_zip, minutes, number, pad_cell_hour,
    share, taxi_time_cell,
)


def values(spark, texts, expression, type_name="string"):
    """expression applied to each value, in order (rows keep a number to sort by)."""
    df = spark.createDataFrame(list(enumerate(texts)), f"i int, v {type_name}")
    return [r[0] for r in df.select(expression(F.col("v")), "i").orderBy("i").collect()]


def test_bike_times(spark):
    cases = {
        "2018-08-01 00:00:07.3210": ("2018-08-01", "00"),
        "8/1/2016 0:01:22": ("2016-08-01", "0"),
        "12/31/2015 23:59": ("2015-12-31", "23"),
        "2018-08-01": ("2018-08-01", "-1"),
        "8/1/2016": ("2016-08-01", "-1"),
        "10/1/2016 5:05": ("2016-10-01", "5"),
        "1/10/2016 05:05": ("2016-01-10", "05"),
        "2018-08-01 ": ("2018-08-01", "-1"),
        "2018-08-01  07:00": ("2018-08-01", ""),
        "2018-08-01 07 junk:00": ("2018-08-01", "07"),
        "": ("", "-1"),
    }
    cells = values(spark, list(cases), bike_time_cell)
    assert list(zip(values(spark, cells, cell_date), values(spark, cells, cell_hour))) == list(
        cases.values()
    )
    assert values(spark, [None], bike_time_cell) == [None]


def test_padded_hours(spark):
    padded = values(spark, ["2016-08-01 0", "2016-08-01 00", "2016-08-01"], pad_cell_hour)
    assert padded == ["2016-08-01 00", "2016-08-01 00", "2016-08-01"]


def test_taxi_times(spark):
    texts = ["2018-08-01 14:05:00", "2018-08-01", "8/1/2016 0:01", None]
    assert values(spark, texts, taxi_time_cell) == [
        "2018-08-01 14", "2018-08-01", "8/1/2016 0", None,
    ]


def python_cell(text):
    """The stated rule, in plain Python, for slashed times with all four parts."""
    month, day, rest = text.split(":")[0].split("/")
    year, hour = rest.split(" ")
    return f"{year}-{month.zfill(2)}-{day.zfill(2)} {hour}"


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.integers(1, 12), st.integers(1, 31), st.integers(1990, 2030), st.integers(0, 23),
            st.booleans(),
        ),
        min_size=1, max_size=40,
    )
)
def test_slashed_times_follow_the_rule(spark, moments):
    texts = [
        f"{m:02d}/{d:02d}/{y} {h:02d}:15:00" if wide else f"{m}/{d}/{y} {h}:15"
        for m, d, y, h, wide in moments
    ]
    assert values(spark, texts, bike_time_cell) == [python_cell(t) for t in texts]


def test_minutes_round_the_binary_value(spark):
    assert values(spark, [61.5, 90.0, 60.0, 0.0, None], minutes, "double") == [
        1.02, 1.5, 1.0, 0.0, None,
    ]


def test_numbers(spark):
    assert values(spark, ["1.5", ".00", "0", None], number) == [1.5, 0.0, 0.0, None]
    assert values(spark, ["abc", "2"], lambda c: number(c, "drop")) == [None, 2.0]
    with pytest.raises(Exception, match="not a number: abc"):
        values(spark, ["abc"], number)
    with pytest.raises(ValueError):
        number(F.col("v"), "ignore")


def test_bad_numbers_fail_without_ansi_mode_too(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="not a number: abc"):
            values(spark, ["abc"], number)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_zips_shares_and_keys(spark):
    assert values(spark, ["10001", "", None], known_zip) == ["10001", "00000", "00000"]
    assert values(spark, [3], lambda c: share(c, F.lit(4)), "long") == [0.75]
    key = cell_key(F.lit("10001"), F.lit("10002"), F.lit("2019-06-01"), F.lit("00"))
    assert values(spark, ["x"], lambda c: key) == ["10001100022019-06-0100"]
