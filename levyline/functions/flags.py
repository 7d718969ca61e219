"""Boolean flags and CASE mappings of the models."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Payment-method spellings and the label each group is normalised to (exact match only).
PAYMENT_METHOD_GROUPS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Card", ("Card", "card")),
    ("Bank Transfer", ("Bank", "bank", "Bank Transfer")),
    ("Cash", ("Cash", "cash")),
    ("USSD", ("USSD", "ussd")),
)


def flag(condition: Column) -> Column:
    """CASE WHEN cond THEN true ELSE false END: NULL conditions give false, never NULL."""
    return F.when(condition, True).otherwise(False)


def clean_payment_method(method: Column, groups: Iterable[tuple[str, tuple[str, ...]]] = PAYMENT_METHOD_GROUPS) -> Column:
    """Known spellings map to one label; unknown values pass through; NULL becomes 'Unknown'."""
    expr = None
    for label, spellings in groups:
        cond = method.isin(*spellings)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.coalesce(method, F.lit("Unknown")))


def case_map(value: Column, mapping: Mapping[str, str]) -> Column:
    """Simple CASE without ELSE: unmatched values (and NULL) give NULL."""
    expr = None
    for src, dst in mapping.items():
        cond = value == F.lit(src)
        expr = F.when(cond, F.lit(dst)) if expr is None else expr.when(cond, F.lit(dst))
    return expr
