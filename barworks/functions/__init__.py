from barworks.functions.dates import date_bounded, fiscal_quarter, fiscal_year, month_start, safe_date
from barworks.functions.numeric import guarded_ratio, is_missing, pct_change, round_stable, safe_double, safe_long
from barworks.functions.text import base_symbol, clean_upper, exchange_from_suffix, split_list

__all__ = [
    "base_symbol", "clean_upper", "date_bounded", "exchange_from_suffix", "fiscal_quarter", "fiscal_year",
    "guarded_ratio", "is_missing", "month_start", "pct_change", "round_stable", "safe_date",
    "safe_double", "safe_long", "split_list",
]
