"""Numeric-text semantics (S5, FN-9, FN-10) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal / scientific text. Spark's cast alone is too lenient
# ('1d' -> 1.0), so every text-to-number conversion is guarded by it.
NUMBER_RX = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
SPECIAL_RX = r"(?i)^\s*[+-]?(nan|inf|infinity)\s*$"


# first characters a number text (NUMBER_RX) or a special word
# (SPECIAL_RX) can start with; other text is rejected without a regex
_NUM_START = list("0123456789+-. \t\n\x0b\f\r")
_SPECIAL_START = list("nNiI+- \t\n\x0b\f\r")


def number_like(col) -> Column:
    """``rlike(NUMBER_RX)`` with a regex-free first-character screen."""
    from tidemark.functions.text import char_literals
    c = _c(col)
    return F.when(F.substring(c, 1, 1).isin(*char_literals(_NUM_START)), c.rlike(NUMBER_RX)) \
        .otherwise(F.lit(False))


def special_like(col) -> Column:
    """``rlike(SPECIAL_RX)`` with a regex-free first-character screen."""
    from tidemark.functions.text import char_literals
    c = _c(col)
    return F.when(F.substring(c, 1, 1).isin(*char_literals(_SPECIAL_START)), c.rlike(SPECIAL_RX)) \
        .otherwise(F.lit(False))


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_number_text(col) -> Column:
    c = _c(col)
    return number_like(c) | special_like(c)


def parse_number(col) -> Column:
    """Text -> double; NULL when the text is not a number."""
    c = _c(col)
    low = F.lower(F.trim(c))
    special = special_like(c)
    return (F.when(number_like(c), F.trim(c).cast("double"))
             .when(special & low.contains("nan"), F.lit(float("nan")))
             .when(special & low.startswith("-"), F.lit(float("-inf")))
             .when(special, F.lit(float("inf"))))


def equivalent(a, b) -> Column:
    """Numeric-or-text equality (FN-9): two numbers compare by value
    (``1.00`` = ``1``, NaN never equals), a number never equals text,
    two texts compare as text."""
    a, b = _c(a), _c(b)
    va, vb = parse_number(a), parse_number(b)
    na, nb = va.isNotNull(), vb.isNotNull()   # NaN words parse to NaN, not NULL
    return (F.when(na & nb, (va == vb) & ~F.isnan(va))
             .when(~na & ~nb, a == b)
             .otherwise(F.lit(False)))


def percent(num, den) -> Column:
    """num / den * 100, NULL when den is 0 (FN-10)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double")) * F.lit(100.0)
