"""Column expressions shared by the operators."""

from tidemark.functions.dates import as_of, is_month_end, replace_date
from tidemark.functions.text import (
    any_differs,
    cased,
    caseless,
    fold,
    folded,
    like,
    nth_token,
    text_key,
    value_key,
    yes_no,
)

__all__ = [
    "any_differs",
    "as_of",
    "cased",
    "caseless",
    "fold",
    "folded",
    "is_month_end",
    "like",
    "nth_token",
    "replace_date",
    "text_key",
    "value_key",
    "yes_no",
]
