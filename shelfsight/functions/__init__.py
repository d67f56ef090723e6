"""Column expressions: everything here stays inside whole-stage code generation."""

from shelfsight.functions.codes import (
    clean_token,
    upc_from_number,
    upc_from_sheet_text,
    upc_norm12,
)
from shelfsight.functions.dates import (
    between_dates,
    month_start,
    quarter_label,
)
from shelfsight.functions.metrics import (
    growth_rate,
    net_revenue,
    round_half_up,
    to_number,
    variance_metrics,
)

__all__ = [
    "between_dates",
    "clean_token",
    "growth_rate",
    "month_start",
    "net_revenue",
    "quarter_label",
    "round_half_up",
    "to_number",
    "upc_from_number",
    "upc_from_sheet_text",
    "upc_norm12",
    "variance_metrics",
]
