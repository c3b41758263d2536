"""Numeric column expressions: shares, rounding, dosage arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def share(part: ColumnOrName, total: ColumnOrName, places: int = 3) -> Column:
    """``round_half_even(part / total, places)``, 0 when the total is 0.

    Both operands are divided as doubles from exact integer sums, so two
    engines give the same bits; ``try_divide`` keeps ANSI mode from raising
    on a zero total."""
    ratio = F.try_divide(_col(part).cast("double"), _col(total).cast("double"))
    return F.coalesce(F.bround(ratio, places), F.lit(0.0))


def _trunc_div(a: Column, b: Column) -> Column:
    # integral division, truncating toward zero
    return (a.cast("double") / b.cast("double")).cast("long")


def dosage_frequency(qty: ColumnOrName, days: ColumnOrName) -> Column:
    """Doses per period: ``trunc(qty / days)`` when qty >= days, else 1;
    null when either value is 0 (no instruction is written then)."""
    q, d = _col(qty), _col(days)
    return (F.when((q == 0) | (d == 0), F.lit(None).cast("long"))
            .when(q >= d, _trunc_div(q, d))
            .otherwise(F.lit(1).cast("long")))


def dosage_period(qty: ColumnOrName, days: ColumnOrName) -> Column:
    """Period in days: ``trunc(days / qty)`` when days > qty, else 1."""
    q, d = _col(qty), _col(days)
    return (F.when((q == 0) | (d == 0), F.lit(None).cast("long"))
            .when(d > q, _trunc_div(d, q))
            .otherwise(F.lit(1).cast("long")))
