"""Hotel score expressions (built-in column expressions only).

The arithmetic keeps the original operation order, left to right, so that
results agree bit for bit with any SQL engine evaluating the same text:
``max_points - (x - min) * max_points / range``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.constants import PRICE_MAX_POINTS, REVIEW_MAX_POINTS


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """NaN (e.g. a missing review that arrived as a float) becomes NULL."""
    c = _col(c)
    return F.nanvl(c, F.lit(None).cast("double"))


def price_per_night(total: str | Column, nights: int) -> Column:
    """Total stay price divided by the number of nights (F7; a column expression, not a row lambda: X1)."""
    return _col(total) / F.lit(nights)


def safe_range(x: str | Column) -> Column:
    """A range width usable as a divisor: zero becomes NULL (no ANSI divide error)."""
    return F.nullif(_col(x), F.lit(0.0))


def price_points(price, min_price, diff_price, max_points: int = PRICE_MAX_POINTS) -> Column:
    """Cheapest offer gets ``max_points``, the dearest 0; NULL when the range is 0."""
    return F.lit(max_points) - (_col(price) - _col(min_price)) * max_points / safe_range(diff_price)


def review_points(review, min_review, diff_review, max_points: int = REVIEW_MAX_POINTS) -> Column:
    """Best review gets ``max_points``, the worst 0; NULL when the range is 0."""
    return (_col(review) - _col(min_review)) * max_points / safe_range(diff_review)
