"""Numbers: coercion, rounding, growth and forecast variance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(text: Column | str) -> Column:
    """DOUBLE value of ``text``; anything that is not a plain number becomes NULL."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.rlike(_NUMERIC_TEXT), F.trim(text).try_cast("double"))


def round_half_up(value: Column, places: int) -> Column:
    """Round on a decimal, so that the result does not hang on binary representation."""
    return F.round(value.cast("decimal(28,8)"), places).cast("double")


def net_revenue() -> Column:
    return F.coalesce(F.col("revenue"), F.col("amount"))


def growth_rate(current: Column, prior: Column) -> Column:
    """``current / prior - 1``, NULL unless ``prior`` is positive."""
    return F.when(prior > 0, current.cast("double") / prior.cast("double") - 1)


def variance_metrics(
    forecast: Column, actual: Column, zero_forecast: str = "null"
) -> dict[str, Column]:
    """Variance, variance percent and accuracy (at most 100, may be negative).

    Without a positive forecast both ratios are NULL, or 0 with ``zero_forecast="zero"``.
    """
    if zero_forecast not in ("null", "zero"):
        raise ValueError(f"zero_forecast must be 'null' or 'zero', not {zero_forecast!r}")
    otherwise = F.lit(0.0) if zero_forecast == "zero" else F.lit(None).cast("double")
    has_forecast = forecast > 0
    share = actual / forecast * 100
    return {
        "variance": actual - forecast,
        "variance_pct": F.when(
            has_forecast, round_half_up((actual - forecast) / forecast * 100, 2)
        ).otherwise(otherwise),
        "accuracy": F.when(
            has_forecast, round_half_up(F.least(share, F.lit(100.0)), 2)
        ).otherwise(otherwise),
    }
