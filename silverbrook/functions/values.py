"""Column helpers that never raise on bad input."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverbrook import settings


def once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row.

    The optimizer copies a plain column expression into every filter and projection that
    uses it; it does not do so with the output of a generator. For parsing of JSON and whole
    texts only.
    """
    return rows.select("*", F.explode(F.array(value)).alias(name))


def present(column: str | Column) -> Column:
    """True when a string is neither null nor empty."""
    value = F.col(column) if isinstance(column, str) else column
    return value.isNotNull() & (F.length(value) > 0)


def parse_ts(column: str | Column) -> Column:
    """ISO text to timestamp; null when it cannot be read."""
    return F.try_to_timestamp(F.col(column) if isinstance(column, str) else column)


def number_or_zero(column: str | Column) -> Column:
    """A number, or 0 when missing or unreadable."""
    value = F.col(column) if isinstance(column, str) else column
    return F.coalesce(value.try_cast("double"), F.lit(0.0))


def exact(column: str | Column) -> Column:
    """Money as DECIMAL(18,2): sums do not depend on the order rows arrive in.

    Cleaning lets only amounts through that fit; anything else raises here and is never lost.
    """
    value = F.col(column) if isinstance(column, str) else column
    return value.cast("decimal(18,2)")


def is_money(column: str | Column) -> Column:
    """True for a readable, finite number that the money type can hold."""
    text = F.col(column) if isinstance(column, str) else column
    # Comparisons put NaN above every number.
    return F.coalesce(F.abs(text.try_cast("double")) < F.lit(1e15), F.lit(False))


def amount(text: str | Column) -> Column:
    """A number as it was written, to a millionth, so that sums and roundings don't depend on doubles."""
    value = F.col(text) if isinstance(text, str) else text
    return value.try_cast("decimal(24,6)")


def cents(value: Column) -> Column:
    """An exact amount rounded half up to cents."""
    return F.round(value, 2).cast("double")


def money_sum(column: str | Column) -> Column:
    return F.sum(exact(column)).cast("double")


def money_avg(column: str | Column) -> Column:
    return ratio(money_sum(column), F.count(exact(column)))


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as double, null when the divisor is 0."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def growth_pct(now: str, before: str) -> Column:
    """Growth in percent; null unless the earlier value is positive."""
    then = F.col(before).cast("double")
    change = (F.col(now) - F.col(before)).cast("double")
    return F.when(F.col(before) > 0, change / then * 100)


def surrogate_id(column: str | Column) -> Column:
    """Non-negative 64-bit id of a name; dimensions check that ids are unique."""
    return F.xxhash64(column).bitwiseAND(F.lit(2**63 - 1))


def fix_mojibake(column: Column) -> Column:
    """Repair UTF-8 letters that were read as Latin-1; clean text skips the replacements."""
    repaired = reduce(
        lambda text, pair: F.replace(text, F.lit(pair[0]), F.lit(pair[1])),
        settings.MOJIBAKE,
        column,
    )
    return F.when(F.contains(column, F.lit("Ã")), repaired).otherwise(column)


def review_message(raw: str | Column) -> Column:
    """Text after the ``---`` line, without one title line and one blank line."""
    return F.regexp_extract(raw, settings.REVIEW_MESSAGE, 1)


def word_count(text: str | Column) -> Column:
    """Pieces between runs of white space; white space at an edge adds an empty piece."""
    return F.size(F.split(text, r"\s+"))


def sentiment(rating: str = "rating") -> Column:
    return (
        F.when(F.col(rating) >= settings.POSITIVE_FROM, "positive")
        .when(F.col(rating) == settings.NEUTRAL_AT, "neutral")
        .otherwise("negative")
    )


def risk_label(probability: str | Column) -> Column:
    value = F.col(probability) if isinstance(probability, str) else probability
    return (
        F.when(value > settings.RISK_HIGH, "high")
        .when(value > settings.RISK_MEDIUM, "medium")
        .otherwise("low")
    )
