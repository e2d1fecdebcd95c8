"""Column functions for keys, dates and the loyalty flag.

All are ``Column -> Column`` built from Spark SQL expressions, so they stay
inside whole-stage code generation. ANSI mode stays on: every parse that may
meet bad text uses a ``try_`` form and yields NULL instead of failing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values the outputs depend on.
NON_MEMBER_KEY = "-1"          # collector_key of a sale without a loyalty card
MEMBER_YES = "Yes"
MEMBER_NO = "No"
SLASH_DATE_FORMAT = "M/d/yyyy"  # landing dates such as 6/26/2015 or 06/26/2015
SLASH_DATE_PATTERN = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
TRANS_KEY_DECIMAL = "decimal(30,0)"
INTEGER_TEXT = r"^[+-]?[0-9]+$"
NUMBER_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
# Amounts beyond this do not count as good values (see functions.measures).
AMOUNT_LIMIT = 1e15


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Trimmed text, with empty text as NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def canonical_key(c: Column | str) -> Column:
    """Key text as a number-typed read would print it.

    Integer text loses leading zeros and a plus sign (``00123`` -> ``123``);
    any other text is kept trimmed; blank is NULL.
    """
    s = blank_to_null(c)
    as_number = s.try_cast("decimal(38,0)").cast("string")
    return F.when(s.rlike(INTEGER_TEXT), F.coalesce(as_number, s)).otherwise(s)


def normalize_trans_key(c: Column | str) -> Column:
    """Transaction key through ``decimal(30,0)``: E-notation is expanded
    (``1.6945500000E+25`` -> ``16945500000000000000000000``), long digit text
    stays exact, text that is not a number becomes NULL."""
    return blank_to_null(c).try_cast(TRANS_KEY_DECIMAL).cast("string")


def parse_trans_dt(c: Column | str, lenient: bool = False) -> Column:
    """Landing date text -> DATE.

    Accepts ISO dates with or without a time part (``2015-10-28 00:00:00``)
    and month/day/year (``6/26/2015``). Impossible dates give NULL; with
    ``lenient=True`` month and day overflow into the following months the way
    a lenient calendar does (``13/45/2015`` -> 2016-02-14).
    """
    s = blank_to_null(c)
    strict = (F.when(s.rlike(SLASH_DATE_PATTERN), F.try_to_date(s, SLASH_DATE_FORMAT))
              .otherwise(s.try_cast("date")))
    if not lenient:
        return strict
    m = F.regexp_extract(s, SLASH_DATE_PATTERN, 1).try_cast("int")
    d = F.regexp_extract(s, SLASH_DATE_PATTERN, 2).try_cast("int")
    y = F.regexp_extract(s, SLASH_DATE_PATTERN, 3).try_cast("int")
    rolled = F.date_add(F.add_months(F.make_date(y, F.lit(1), F.lit(1)), m - 1), d - 1)
    return F.coalesce(strict, F.when(s.rlike(SLASH_DATE_PATTERN), rolled))


def is_member(collector_key: Column | str = "collector_key") -> Column:
    """Loyalty flag: no card (NULL) or the non-member key -> ``No``."""
    k = _col(collector_key)
    return (F.when(k.isNull() | (k == F.lit(NON_MEMBER_KEY)), F.lit(MEMBER_NO))
            .otherwise(F.lit(MEMBER_YES)))


def number(c: Column | str) -> Column:
    """Decimal text as a double; other text a numeric cast might take (``NaN``,
    ``Infinity``, ``1.5d``) is NULL."""
    s = blank_to_null(c)
    return F.when(s.rlike(NUMBER_TEXT), s.try_cast("double"))


def amount(value: Column | str) -> Column:
    """A number below ``AMOUNT_LIMIT``, else NULL. It refers to ``value`` twice:
    where rows are many, pass a column that holds it."""
    value = _col(value)
    return F.when(F.abs(value) < AMOUNT_LIMIT, value)


def to_double(c: Column | str) -> Column:
    """Decimal text as a double; text that is no number and values beyond
    ``AMOUNT_LIMIT`` are NULL."""
    return amount(number(c))


def to_int(c: Column | str) -> Column:
    """Integer measure; ``1.0`` is accepted as 1 like a numeric read would."""
    return to_double(c).try_cast("int")
