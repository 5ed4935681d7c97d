"""Annuity arithmetic.  Rates and growth factors are DOUBLE; money is rounded once
to whole rupees and carried as BIGINT so that later sums do not depend on order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.columns import _col, strict_greatest


def monthly_rate(annual_pct) -> Column:
    return _col(annual_pct).cast("double") / F.lit(1200.0)


def instalment_exact(principal, annual_pct, months) -> Column:
    """Equated monthly instalment before rounding; an interest-free loan splits evenly."""
    p, n = _col(principal).cast("double"), _col(months).cast("double")
    r = monthly_rate(annual_pct)
    growth = F.pow(F.lit(1.0) + r, n)
    return F.when(r == 0, p / n).otherwise(p * r * growth / F.nullif(growth - 1, F.lit(0.0)))


def instalment(principal, annual_pct, months) -> Column:
    return F.round(instalment_exact(principal, annual_pct, months)).cast("bigint")


def balance_after(principal, annual_pct, emi, months) -> Column:
    """Closed-form balance once ``months`` instalments are paid (not floored, not rounded)."""
    p, e = _col(principal).cast("double"), _col(emi).cast("double")
    m, r = _col(months).cast("double"), monthly_rate(annual_pct)
    growth = F.pow(F.lit(1.0) + r, m)
    return F.when(r == 0, p - e * m).otherwise(
        p * growth - e * (growth - 1) / F.nullif(r, F.lit(0.0))
    )


def outstanding(principal, annual_pct, emi, months) -> Column:
    """Never below zero; NULL as soon as one term is missing."""
    left = F.round(balance_after(principal, annual_pct, emi, months)).cast("bigint")
    return strict_greatest(left, F.lit(0).cast("bigint"))


def share_of_income(amount, income) -> Column:
    """Percent of income to one decimal; NULL without an income."""
    safe_income = F.nullif(_col(income).cast("decimal(18,0)"), F.lit(0))
    ratio = F.lit(100).cast("decimal(3,0)") * _col(amount).cast("decimal(18,0)") / safe_income
    return F.round(ratio, 1).cast("decimal(12,1)")


# Far above the error of the growth factors, far below the last decimal kept.
HALF_GUARD = 1e-8


def to_money(amount) -> Column:
    """Four decimals, halves up.  The guard lifts an exact half that binary arithmetic
    left a hair short."""
    return (_col(amount) + F.lit(HALF_GUARD)).cast("decimal(18,4)")
