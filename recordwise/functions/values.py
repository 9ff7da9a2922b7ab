"""Scalar expressions: ratios, scores, labels and display text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def in_millions(amount: ColumnOrName) -> Column:
    return as_column(amount) / F.lit(1_000_000)


def difference(left: ColumnOrName, right: ColumnOrName, digits: int | None = None) -> Column:
    """``left - right``; NULL when either side is NULL."""
    result = as_column(left) - as_column(right)
    return result if digits is None else F.round(result, digits)


def ratio_of_positive(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """``numerator / denominator`` for denominators above zero, otherwise NULL."""
    denominator = as_column(denominator)
    return F.when(denominator > 0, as_column(numerator) / denominator)


def percent_gain(final: ColumnOrName, initial: ColumnOrName, digits: int | None = None) -> Column:
    """Gain of ``final`` over ``initial`` in percent; NULL when ``initial`` is 0 or NULL."""
    gain = (F.try_divide(as_column(final), as_column(initial)) - 1) * 100
    return gain if digits is None else F.round(gain, digits)


def percent_gain_of_positive(
    final: ColumnOrName, initial: ColumnOrName, digits: int = 2
) -> Column:
    """``percent_gain`` that also yields NULL for an ``initial`` below zero."""
    initial = as_column(initial)
    return F.when(initial > 0, percent_gain(final, initial, digits))


def divide_or(
    numerator: ColumnOrName, denominator: ColumnOrName, default: float = 0.0
) -> Column:
    """Quotient, or ``default`` for a zero or NULL denominator. A NULL numerator stays NULL."""
    denominator = as_column(denominator)
    return F.when(denominator != 0, as_column(numerator) / denominator).otherwise(F.lit(default))


def bucket(
    value: ColumnOrName,
    edges: Sequence[float],
    labels: Sequence[str],
    null_label: str | None = None,
    above: bool = False,
) -> Column:
    """Label ``value`` by the first edge it lies below; the last label takes the rest.

    NULL compares as unknown and so lands in the last label, unless ``null_label`` is
    given. With ``above=True`` edges are read downwards: the first edge the value
    exceeds decides (``edges`` then runs from high to low).
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("bucket() needs exactly one label more than edges")
    value = as_column(value)
    cases = [((value > e) if above else (value < e), l) for e, l in zip(edges, labels)]
    if null_label is not None:
        cases.insert(0, (value.isNull(), null_label))
    chain = F
    for condition, label in cases:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(labels[-1]))


def ordinal(value: ColumnOrName, labels: Sequence[str]) -> Column:
    """1-based place of ``value`` in ``labels``; anything else shares the last place."""
    value = as_column(value)
    chain = F
    for place, label in enumerate(labels[:-1], start=1):
        chain = chain.when(value == label, F.lit(place))
    return chain.otherwise(F.lit(len(labels)))


def blended_score(
    rating: ColumnOrName, votes: ColumnOrName, popularity: ColumnOrName
) -> Column:
    """Weighted popularity score; NULL as soon as one input is NULL.

    Fixed weights: 0.3 of rating/10, 0.3 of log(1+votes)/10, 0.4 of popularity/100.
    """
    return (
        as_column(rating) / 10.0 * 0.3
        + F.log1p(as_column(votes)) / 10.0 * 0.3
        + as_column(popularity) / 100.0 * 0.4
    )


def label_if_present(value: ColumnOrName, present: str, absent: str) -> Column:
    return F.when(as_column(value).isNotNull(), F.lit(present)).otherwise(F.lit(absent))


def money_text(value: ColumnOrName, digits: int = 2) -> Column:
    """Millions as text, such as ``$1,234.50M``."""
    value = as_column(value).cast("double")
    return F.when(value.isNotNull(), F.format_string(f"$%,.{digits}fM", value))


def percent_text(value: ColumnOrName, digits: int = 2) -> Column:
    value = as_column(value).cast("double")
    return F.when(value.isNotNull(), F.format_string(f"%.{digits}f%%", value))


def shorten(text: ColumnOrName, limit: int) -> Column:
    """First ``limit`` characters followed by ``...`` when the text is longer."""
    text = as_column(text)
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)
