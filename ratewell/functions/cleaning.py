"""Typing and trimming of provider text. Every function is a JVM-side column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratewell.schemas import NUMERIC

# The characters with the Unicode White_Space property.
WHITE_SPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The accepted date literal and the accepted series code, matched over the whole value.
DATE_LITERAL = r"\A(?!0000)\d{4}-\d{1,2}-\d{1,2}\z"
SERIES_CODE = r"\A[A-Z]{3}\z"


def strip_blanks(text: Column) -> Column:
    """Trim all Unicode white space, not the space alone."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def clean_code(text: Column) -> Column:
    return F.upper(strip_blanks(text))


def strict_date(text: Column) -> Column:
    """A date for YYYY-[M]M-[D]D, NULL for the shorter and longer forms that a Spark cast would take."""
    return F.when(text.rlike(DATE_LITERAL), text.try_cast("date"))


def strict_numeric(text: Column) -> Column:
    """NUMERIC of the trimmed text; NULL for empty text, N/A and anything else that is no number. The cast
    itself gives NULL for '' and 'N/A', so neither is compared on its own."""
    return strip_blanks(text).try_cast(NUMERIC)


def is_series_code(code: Column) -> Column:
    return code.rlike(SERIES_CODE)
