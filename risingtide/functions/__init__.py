"""Column-level helpers (built-in Spark SQL expressions only)."""

from risingtide.functions.numeric import (  # noqa: F401
    nan_to_null,
    percent_change,
    period_gain,
    round_half_even_long,
)
