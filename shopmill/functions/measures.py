"""Column expressions: amounts, bands, dates, names. All built-in, all inside codegen."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bands and segments of the reports, richest first.
ORDER_BANDS = ("HIGH", "MEDIUM", "LOW")
ORDER_BOUNDS = (1000, 500)
SEGMENTS = ("VIP", "PREMIUM", "REGULAR", "LOW_VALUE")
SEGMENT_BOUNDS = (10000, 5000, 1000)

_PARTS = {
    "year": F.year,
    "quarter": F.quarter,
    "month": F.month,
    "day": F.dayofmonth,
    "day_of_week": F.dayofweek,
    "week_of_year": F.weekofyear,
}


def gross(quantity: Column, price: Column) -> Column:
    """Line amount before discount; exact at scale 2."""
    return (quantity * price).cast("decimal(16,2)")


def discount(gross_amount: Column, percent: Column) -> Column:
    """Unrounded discount of a gross amount (scale 6, exact for two-decimal percents)."""
    return gross_amount * percent * F.lit(Decimal("0.01"))


def net(gross_amount: Column, discount_amount: Column) -> Column:
    return gross_amount - discount_amount


def money(amount: Column, precision: int = 14) -> Column:
    """Round half up to cents, the type of stored amounts."""
    return amount.cast(f"decimal({precision},2)")


def to_cents(amount: Column) -> Column:
    """Whole cents of a two-decimal amount of up to 15 digits, exact.

    Sums of long cents stay primitive inside generated code; decimal sums of this width do not.
    """
    return F.rint(amount.cast("double") * 100).cast("long")


def from_cents(cents: Column, precision: int = 14) -> Column:
    """Decimal amount of whole cents."""
    wide = cents.cast("decimal(18,0)" if precision <= 18 else "decimal(38,0)")
    return (wide * F.lit(Decimal("0.01"))).cast(f"decimal({precision},2)")


def rounded_amounts(quantity: Column, price: Column, percent: Column) -> dict[str, Column]:
    """Stored gross, discount and net amount of a line, each rounded half up on its own.

    The same values as ``money`` of ``gross``, ``discount`` and ``net``, by whole-number
    arithmetic: a percent with two decimals of whole cents counts ten-thousandths of a cent.
    """
    whole = quantity * to_cents(price)
    off = whole * to_cents(percent)
    left = whole * 10000 - off

    def rounded(parts: Column, half: Column) -> Column:
        return F.call_function("div", parts + half, F.lit(10000))

    half = F.lit(5000)
    amounts = {
        "gross_amount": whole,
        "discount_amount": rounded(off, half),
        # Above 100 percent the net amount is negative and rounds the other way.
        "total_amount": rounded(left, F.when(percent > 100, -half).otherwise(half)),
    }
    return {name: from_cents(cents) for name, cents in amounts.items()}


def clamp_negative(value: Column, dtype: str) -> Column:
    """Negative becomes 0, NULL stays NULL (``greatest`` would turn NULL into 0)."""
    return F.when(value < 0, F.lit(0).cast(dtype)).otherwise(value)


def full_name(first: Column, last: Column) -> Column:
    """Names joined by a blank; a NULL part is skipped."""
    return F.concat_ws(" ", first, last)


def strict_name(first: Column, last: Column) -> Column:
    """Names joined by a blank; NULL when any part is NULL (report variant)."""
    return F.concat(first, F.lit(" "), last)


def _ladder(value: Column, labels: Sequence[str], bounds: Sequence, inclusive: bool) -> Column:
    # NULL fails every comparison and so lands on the last label.
    chosen = F.lit(labels[-1])
    for label, bound in reversed(list(zip(labels, bounds))):
        reached = value >= F.lit(bound) if inclusive else value > F.lit(bound)
        chosen = F.when(reached, F.lit(label)).otherwise(chosen)
    return chosen


def order_band(value: Column, bounds: Sequence = ORDER_BOUNDS) -> Column:
    return _ladder(value, ORDER_BANDS, bounds, inclusive=True)


def customer_segment(
    value: Column, bounds: Sequence = SEGMENT_BOUNDS, inclusive: bool = True
) -> Column:
    """Segment by sales; ``inclusive=False`` is the historical dialect (strictly greater)."""
    return _ladder(value, SEGMENTS, bounds, inclusive)


def date_key(day: Column) -> Column:
    """Integer yyyymmdd by arithmetic, without formatting a string per row."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def day_span(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def with_date_parts(
    df: DataFrame,
    column: str,
    parts: Sequence[str] = ("year", "month", "day", "quarter", "day_of_week"),
) -> DataFrame:
    """Add calendar parts of a date column (day_of_week: 1 is Sunday; ISO week)."""
    return df.withColumns({p: _PARTS[p](F.col(column)) for p in parts})
