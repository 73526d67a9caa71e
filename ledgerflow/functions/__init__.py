"""Column-level helpers (all built-in Spark expressions, no UDFs)."""

from ledgerflow.functions.money import money, to_double, round_money, money_sum, pct_change, ratio_pct
from ledgerflow.functions.dates import parse_statement_date, year_month, month_start, month_start_of_ym
from ledgerflow.functions.text import record_id, upper_like_any, object_path, base_name

__all__ = [
    "money", "to_double", "round_money", "money_sum", "pct_change", "ratio_pct",
    "parse_statement_date", "year_month", "month_start", "month_start_of_ym",
    "record_id", "upper_like_any", "object_path", "base_name",
]
