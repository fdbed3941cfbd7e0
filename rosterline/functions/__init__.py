"""Column expressions and join conditions shared by the operators."""

from .columns import epoch_date, is_weekend, moment, numeric_id, run_stamp, text_id, word_tokens
from .conditions import any_differs, same_keys
from .pay import rung

__all__ = [
    "any_differs",
    "epoch_date",
    "is_weekend",
    "moment",
    "numeric_id",
    "run_stamp",
    "rung",
    "same_keys",
    "text_id",
    "word_tokens",
]
