"""Property tests of the key and date rules against plain Python.

Each property draws a batch of values and checks them in one Spark job.
"""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesmart.functions.keys import canonical_key, normalize_trans_key, parse_trans_dt
from salesmart.plans.fixtures import e_notation

SETTINGS = settings(max_examples=5, deadline=None)


def _apply(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["r"] for r in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=10**29 - 1), min_size=1, max_size=200))
def test_e_notation_keys_round_trip(spark, numbers):
    texts = _apply(spark, [str(n) for n in numbers], e_notation)
    assert _apply(spark, texts, normalize_trans_key) == [str(n) for n in numbers]


@SETTINGS
@given(st.lists(st.tuples(st.integers(min_value=0, max_value=10**20), st.integers(0, 6)),
                min_size=1, max_size=200))
def test_padded_keys_lose_their_zeros(spark, pairs):
    texts = ["0" * pad + str(n) for n, pad in pairs]
    assert _apply(spark, texts, canonical_key) == [str(n) for n, _ in pairs]


@SETTINGS
@given(st.lists(st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2100, 12, 31)),
                min_size=1, max_size=200))
def test_both_date_layouts_parse(spark, days):
    slash = [f"{d.month}/{d.day}/{d.year}" for d in days]
    padded = [f"{d.month:02d}/{d.day:02d}/{d.year}" for d in days]
    iso = [f"{d.isoformat()} 00:00:00" for d in days]
    for texts in (slash, padded, iso):
        assert _apply(spark, texts, parse_trans_dt) == days


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 12), st.integers(1, 31), st.integers(1990, 2030)),
                min_size=1, max_size=200))
def test_impossible_dates_are_null_strict(spark, parts):
    texts = [f"{m}/{d}/{y}" for m, d, y in parts]
    expected = []
    for m, d, y in parts:
        try:
            expected.append(dt.date(y, m, d))
        except ValueError:
            expected.append(None)
    assert _apply(spark, texts, parse_trans_dt) == expected
