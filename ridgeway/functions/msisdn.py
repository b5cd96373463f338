"""Phone-number (MSISDN) normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Country code, the operator prefixes placed before the last
# eight digits, and the second-digit class that selects each prefix.
COUNTRY = "225"
HOME_PREFIX = "22507"
LOCAL_DIGITS = 8
OPERATOR_CLASSES = (("22501", "[0-3]"), ("22505", "[4-6]"), ("22507", "[7-9]"))
FIRST_DIGIT = "[04-9]"
FOREIGN_LABEL = "EXT"


def _tail(number: Column) -> Column:
    return F.right(number, F.lit(LOCAL_DIGITS))


def canonical(number: Column, prefix: str = HOME_PREFIX) -> Column:
    """Home prefix followed by the last eight digits; NULL stays NULL."""
    return F.concat(F.lit(prefix), _tail(number))


def by_operator_class(number: Column, strict: bool = False) -> Column:
    """Pick the operator prefix from the second local digit.

    ``strict=False`` accepts any number of trailing digits and keeps every
    number that starts with the country code; ``strict=True`` wants exactly
    eight local digits and keeps 13-digit numbers only. Anything else is NULL.
    """
    rest = "[0-9]{6}" if strict else "[0-9]*"
    kept = "[0-9]{10}" if strict else "[0-9]*"
    result = F.when(
        number.rlike(f"^({COUNTRY})?{FIRST_DIGIT}{OPERATOR_CLASSES[0][1]}{rest}$"),
        canonical(number, OPERATOR_CLASSES[0][0]),
    )
    for prefix, second in OPERATOR_CLASSES[1:]:
        result = result.when(
            number.rlike(f"^({COUNTRY})?{FIRST_DIGIT}{second}{rest}$"), canonical(number, prefix)
        )
    return result.when(number.rlike(f"^{COUNTRY}{kept}$"), number)


def by_length(number: Column) -> Column:
    """11 digits lose the country code and gain the home prefix; 13 are kept."""
    size = F.length(number)
    return F.when(size == 11, canonical(number)).when(size == 13, number)


def with_country_code(number: Column) -> Column:
    """Complete 9- and 10-digit national numbers; leave the others alone."""
    size = F.length(number)
    return (
        F.when(size == 9, F.concat(F.lit(COUNTRY + "0"), number))
        .when(size == 10, F.concat(F.lit(COUNTRY), number))
        .otherwise(number)
    )


def _has_country_code(number: Column) -> Column:
    return F.substring(number, 1, 5).contains(COUNTRY)


def canonical_if_local(number: Column) -> Column:
    """Canonical form for home numbers, foreign numbers untouched.

    A number counts as home when the country code starts within its first five
    characters or when it has at most ten digits.
    """
    starts = F.locate(COUNTRY, number)
    return F.when(starts.between(1, 5) | (F.length(number) <= 10), canonical(number)).otherwise(
        number
    )


def mark_foreign(number: Column) -> Column:
    """Replace numbers without the country code up front by one label."""
    return F.when(~_has_country_code(number), F.lit(FOREIGN_LABEL)).otherwise(number)
