"""Data-quality checks on small frames: NULL semantics and one-pass shapes."""

import datetime as dt

from salesmart.operators import quality as dq

ROWS = [("a", "x", dt.date(2015, 1, 2)), ("a", None, dt.date(2015, 1, 2)),
        (None, "y", None), (None, None, dt.date(2016, 3, 4)), ("b", "x", dt.date(2015, 1, 3))]
SCHEMA = "k string, v string, d date"


def frame(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_null_profile_one_row_per_column(spark):
    got = {r["column_name"]: r["null_count"] for r in dq.null_profile(frame(spark)).collect()}
    assert got == {"k": 2, "v": 2, "d": 1}


def test_null_profile_by_group(spark):
    got = {(r["k"], r["column_name"]): r["null_count"]
           for r in dq.null_profile_by(frame(spark), "k").collect()}
    assert got[("a", "v")] == 1 and got[(None, "d")] == 1 and got[("b", "v")] == 0


def test_duplicate_keys_never_flags_null(spark):
    got = [(r["key_value"], r["row_count"]) for r in dq.duplicate_keys(frame(spark), "k", "t").collect()]
    assert got == [("a", 2)]


def test_group_counts_null_group_counts_zero_values(spark):
    got = {r["k"]: (r["row_count"], r["value_count"])
           for r in dq.group_counts(frame(spark), "k").collect()}
    assert got[None] == (2, 0) and got["a"] == (2, 2)


def test_date_range_and_daily_counts(spark):
    r = dq.date_range(frame(spark), "d").first()
    assert (r["min_date"], r["max_date"], r["row_count"], r["rows_without_date"]) == (
        dt.date(2015, 1, 2), dt.date(2016, 3, 4), 5, 1)
    daily = {x["d"]: x["row_count"] for x in dq.daily_counts(frame(spark), "d").collect()}
    assert daily[dt.date(2015, 1, 2)] == 2 and daily[None] == 1


def test_key_lookup(spark):
    assert dq.key_lookup(frame(spark), "k", "b").count() == 1
