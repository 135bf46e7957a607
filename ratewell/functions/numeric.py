"""Exact decimals. decimal(38,9) operands lose scale in Spark arithmetic, so each function picks operand
types whose result keeps nine places, and gives NUMERIC back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratewell.schemas import NUMERIC

# (37,9) +/- (37,9) is (38,9); (29,9) / (38,9) is (38,9); an exact whole quotient survives (38,9) / (38,9), which is (38,6).
_ADDITIVE = "decimal(37,9)"
_DIVIDEND = "decimal(29,9)"


def numeric(value: Column) -> Column:
    return value.cast(NUMERIC)


def difference(left: Column, right: Column) -> Column:
    return (left.cast(_ADDITIVE) - right.cast(_ADDITIVE)).cast(NUMERIC)


def safe_divide(left: Column, right: Column) -> Column:
    """Quotient at nine places, rounded half up; NULL for a NULL or zero divisor and where the quotient does not fit.

    One division gives nine places if the dividend has at most twenty before the point. A larger one is divided into a
    whole part and a remainder first, and where the remainder is that large too, so is the divisor, and both lose nine
    places before they meet. Spark rounds quotients at 38 places and then at nine: below a divisor of 10^19 no quotient
    comes close enough to the middle of two results to be rounded twice; beyond, the last place is one too high for
    quotients less than 10^-20 below it. Dividends of 10^28 and more give NULL over smaller divisors than 10^20, and so do
    quotients of 10^28 and more of dividends of 10^20 and more."""
    left, right = numeric(left), F.nullif(numeric(right), numeric(F.lit(0)))
    large = left.try_cast(_ADDITIVE)
    rest = large % right
    whole = F.try_divide(large - rest, right).try_cast(_ADDITIVE)
    in_two = (whole + F.try_divide(rest.try_cast(_DIVIDEND), right).try_cast(_ADDITIVE)).try_cast(NUMERIC)
    billion = F.lit(10**9).cast("decimal(10,0)")
    shortened = F.try_divide((left / billion).try_cast(_DIVIDEND), (right / billion).cast(NUMERIC))
    return F.coalesce(
        F.try_divide(left.try_cast(_DIVIDEND), right), in_two, F.when(F.abs(right) >= F.lit("1e20").cast("decimal(21,0)"), shortened)
    ).try_cast(NUMERIC)


def mean(total: Column, count: Column, most: int) -> Column:
    """total / count for a count of at most `most`; NULL for none. (38,9) over so few digits stays at nine
    places, rounded once."""
    return F.try_divide(numeric(total), count.cast(f"decimal({len(str(most))},0)")).try_cast(NUMERIC)


def relative_change(new: Column, old: Column) -> Column:
    """new / old - 1, NULL where the quotient is."""
    return (safe_divide(new, old).try_cast(_ADDITIVE) - F.lit(1).cast(_ADDITIVE)).cast(NUMERIC)


def drift(base: Column, new: Column) -> Column:
    """|base - new| / base in double, as float arithmetic gives it."""
    return F.try_divide(F.abs(base - new).cast("double"), base.cast("double"))


def jump(new: Column, base: Column) -> Column:
    """|new / base - 1| in double; NULL where the base is zero or either side is NULL."""
    return F.abs(F.try_divide(new.cast("double"), base.cast("double")) - F.lit(1.0))
