"""Numeric column functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratakit.constants import PLACEHOLDERS


def real(c: Column) -> Column:
    """The value without missing-value placeholders and NaN."""
    return F.when(~c.isin(*PLACEHOLDERS) & ~F.isnan(c), c)


def to_number(text: Column) -> Column:
    """Text as a double in plain or exponent notation; null otherwise (suffixes such as ``1d`` are text)."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), trimmed.try_cast("double"))


def nearest_power_of_ten(c: Column) -> Column:
    """10 to the half-even rounded logarithm of the magnitude; 0 for 0."""
    return F.when(c == 0, F.lit(0.0)).when(c.isNotNull(), F.pow(F.lit(10.0), F.rint(F.log10(F.abs(c)))))


def round_to_quarter(c: Column) -> Column:
    return F.rint(c / 0.25) * 0.25


def depth_text(text: Column, limit: float = 60.0) -> Column:
    """A depth label as a number in [0, limit]; null when it is none."""
    value = to_number(F.trim(text, F.lit(" \nm")))
    return F.when(value.between(0.0, limit), value)


def median_of_counts(counted: DataFrame, keys: Sequence[str], value: str, count: str, name: str) -> DataFrame:
    """Exact interpolated median per key from (key, value, count) rows.

    The window runs over distinct values, so a key with any number of rows costs no more than its distinct values.
    """
    order = Window.partitionBy(*keys).orderBy(value)
    total = F.sum(count).over(Window.partitionBy(*keys))
    upto = F.sum(count).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = counted.where(F.col(value).isNotNull()).withColumn("__n", total).withColumn("__u", upto)
    low, high = F.floor((F.col("__n") + 1) / 2), F.floor((F.col("__n") + 2) / 2)
    at = lambda k: F.min(F.when(F.col("__u") >= k, F.col(value)))
    return rows.groupBy(*keys).agg(((at(low) + at(high)) / 2).alias(name))
