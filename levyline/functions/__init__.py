"""Column expressions shared by the models: calendar parts, flags, CASE maps, measures."""

from levyline.functions.calendar import date_lit, day, month_start, ts_lit, year, year_month
from levyline.functions.flags import case_map, clean_payment_method, flag
from levyline.functions.measures import exact_avg

__all__ = [
    "case_map",
    "clean_payment_method",
    "date_lit",
    "day",
    "exact_avg",
    "flag",
    "month_start",
    "ts_lit",
    "year",
    "year_month",
]
