"""Column rules for keys, dates, measures and the loyalty flag."""

import datetime as dt

from pyspark.sql import functions as F

from salesmart.functions.keys import (canonical_key, is_member, normalize_trans_key,
                                      parse_trans_dt, to_double, to_int)


def _one(spark, expr, value):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(expr(F.col("v")).alias("r")).first()["r"]


def test_trans_dt_formats(spark):
    assert _one(spark, parse_trans_dt, "2015-07-24 00:00:00") == dt.date(2015, 7, 24)
    assert _one(spark, parse_trans_dt, "2015-07-24") == dt.date(2015, 7, 24)
    assert _one(spark, parse_trans_dt, "6/26/2015") == dt.date(2015, 6, 26)
    assert _one(spark, parse_trans_dt, "06/26/2015") == dt.date(2015, 6, 26)
    assert _one(spark, parse_trans_dt, "1/2/2016") == dt.date(2016, 1, 2)


def test_trans_dt_bad_text_is_null_not_error(spark):
    for bad in ("", "   ", "13/45/2015", "02/30/2015", "yesterday", None):
        assert _one(spark, parse_trans_dt, bad) is None, bad


def test_trans_dt_lenient_rolls_over(spark):
    lenient = lambda c: parse_trans_dt(c, lenient=True)
    assert _one(spark, lenient, "13/45/2015") == dt.date(2016, 2, 14)
    assert _one(spark, lenient, "02/30/2015") == dt.date(2015, 3, 2)
    assert _one(spark, lenient, "6/26/2015") == dt.date(2015, 6, 26)


def test_trans_key_e_notation_and_digits(spark):
    assert _one(spark, normalize_trans_key, "1.6945500000E+25") == "16945500000000000000000000"
    assert _one(spark, normalize_trans_key, "3.152050000E+24") == "3152050000000000000000000"
    assert _one(spark, normalize_trans_key, "31216969731182201507241448") == "31216969731182201507241448"
    assert _one(spark, normalize_trans_key, "not a key") is None


def test_canonical_key(spark):
    assert _one(spark, canonical_key, "00123") == "123"
    assert _one(spark, canonical_key, "-1") == "-1"
    assert _one(spark, canonical_key, " 1794 ") == "1794"
    assert _one(spark, canonical_key, "6e36648") == "6e36648"
    assert _one(spark, canonical_key, "dc35b695") == "dc35b695"
    assert _one(spark, canonical_key, "") is None
    assert _one(spark, canonical_key, "1" * 40) == "1" * 40


def test_measures(spark):
    assert _one(spark, to_double, "8.53") == 8.53
    assert _one(spark, to_double, "x") is None
    assert _one(spark, to_int, "1.0") == 1
    assert _one(spark, to_int, "2") == 2
    assert _one(spark, to_int, "") is None


def test_is_member(spark):
    assert _one(spark, is_member, "-1") == "No"
    assert _one(spark, is_member, None) == "No"
    assert _one(spark, is_member, "139518000000") == "Yes"
