"""Scalar Column expressions (no UDFs)."""

from .dates import (date_key, days_between, is_weekend, key_to_date, month_start,
                    month_text, period_to_month, week_of_year_monday, weekday0)
from .stats import corrected_skew, dbl, dq_tier, money, msum, round_half_even, safe_div
from .text import (blank_to_null, is_blank, last_token, norm_key, parse_mixed_date,
                   parse_mixed_number, trim_ws, yn_flag)

__all__ = [
    "date_key", "days_between", "is_weekend", "key_to_date", "month_start", "month_text",
    "period_to_month", "week_of_year_monday", "weekday0", "corrected_skew", "dbl",
    "dq_tier", "money", "msum", "round_half_even", "safe_div", "blank_to_null", "is_blank", "last_token",
    "norm_key", "parse_mixed_date", "parse_mixed_number", "trim_ws", "yn_flag",
]
