"""Exact money arithmetic. Ratios are rounded on integers, so no result depends on float or decimal-scale rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(38,2)"
_WHOLE = "decimal(38,0)"


def cents(amount: Column) -> Column:
    """Money with two decimals as a whole number of cents."""
    return (amount.cast(MONEY_SUM) * 100).cast("bigint")


def _rounded_quotient(num: Column, den: Column) -> Column:
    """num / den rounded half away from zero to a whole number; ``den`` > 0."""
    doubled = F.abs(num.cast(_WHOLE)) * 2 + den.cast(_WHOLE)
    whole = F.call_function("div", doubled, den.cast(_WHOLE) * 2)
    return F.when(num < 0, -whole).otherwise(whole)


def rounded_ratio(num: Column, den: Column) -> Column:
    """Whole ``num`` hundredths divided by ``den``, with two decimals, half away from zero; NULL when den is 0."""
    safe_den = F.nullif(den, F.lit(0))
    return (_rounded_quotient(num, safe_den).cast(MONEY_SUM) / 100).cast(MONEY_SUM)


def rounded_mean(total: Column, n: Column) -> Column:
    """Mean of ``n`` money amounts adding up to ``total``, with two decimals."""
    return rounded_ratio(cents(total), n)


def percent_of(part: Column, whole: Column) -> Column:
    """part / whole * 100 with two decimals for whole numbers; NULL when the whole is 0."""
    return rounded_ratio(part.cast(_WHOLE) * 10000, whole)


def growth_pct(cur: Column, prev: Column) -> Column:
    """(cur - prev) / prev * 100 with two decimals for money; NULL when prev is NULL or 0."""
    change = cents(cur) - cents(prev)
    sign = F.signum(cents(prev)).cast("bigint")
    return percent_of(change * sign, F.abs(cents(prev)))


def to_number(col: Column, default: float | None = None) -> Column:
    """Text to number; unreadable text becomes ``default``."""
    number = col.try_cast("double")
    return number if default is None else F.coalesce(number, F.lit(default).cast("double"))


def money_text(col: Column) -> Column:
    """'1,234.56'; NULL becomes an empty text."""
    return F.coalesce(F.format_number(col.cast(MONEY_SUM), 2), F.lit(""))
