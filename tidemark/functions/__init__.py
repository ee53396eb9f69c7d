"""Column expressions: periods, flags, bins, rounding, casts."""

from tidemark.functions.periods import (
    TrailingWindow,
    period_end,
    period_shift,
    period_start,
    shift_label,
    trailing_windows,
)
from tidemark.functions.scalars import (
    as_int64,
    edge_bin,
    exclude_patterns,
    hash_order,
    matches_any,
    measure_family,
    month_flag,
    month_id,
    round_even,
    scaled_int,
    significant,
)

__all__ = [
    "TrailingWindow",
    "as_int64",
    "edge_bin",
    "exclude_patterns",
    "hash_order",
    "matches_any",
    "measure_family",
    "month_flag",
    "month_id",
    "period_end",
    "period_shift",
    "period_start",
    "round_even",
    "scaled_int",
    "shift_label",
    "significant",
    "trailing_windows",
]
