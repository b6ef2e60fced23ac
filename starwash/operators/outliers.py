"""Outlier flags and capping that leave promotions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starwash.functions.rules import differs_from
from starwash.operators.quantiles import iqr_bounds

FLAG = "Outlier_Flag_Before_Capping"


def bounds_of_regular_sales(df: DataFrame, amount: str, promotion: str) -> DataFrame:
    """Quartile fences of the rows that are not promotions (one row)."""
    return iqr_bounds(df.filter(differs_from(F.col(promotion), "Y")), amount)


def _bound(bounds: DataFrame, name: str) -> Column:
    """The one-row bounds as a scalar subquery: a constant in the scan, not a join."""
    return bounds.select(name).scalar()


def flag_outliers(df: DataFrame, bounds: DataFrame, amount: str, promotion: str) -> DataFrame:
    """Add the outlier flag of regular rows and ``Promo_Outside_Bounds`` of promotions."""
    a = F.col(amount)
    outside = F.coalesce(
        (a < _bound(bounds, "lower_bound")) | (a > _bound(bounds, "upper_bound")), F.lit(False)
    )
    regular = differs_from(F.col(promotion), "Y")
    return df.withColumns({FLAG: outside & regular, "Promo_Outside_Bounds": outside & ~regular})


def cap_outliers(
    df: DataFrame, bounds: DataFrame, amount: str, promotion: str, before: str | None = None
) -> DataFrame:
    """Clip regular rows to the fences; ``before`` names a column keeping the old value."""
    a = F.col(amount)
    capped = F.least(F.greatest(a, _bound(bounds, "lower_bound")), _bound(bounds, "upper_bound"))
    regular = differs_from(F.col(promotion), "Y")
    after = F.when(a.isNotNull() & regular, capped).otherwise(a)
    return df.withColumns({**({before: a} if before else {}), amount: after})


def changed(after: Column, before: Column) -> Column:
    """True where capping changed the value; null before and after is no change."""
    return ~after.eqNullSafe(before)
