"""Column expressions shared by the operators and the checks."""

from tidemark.functions.marks import (
    above,
    count_where,
    instant_to_ntz,
    is_sentinel,
    ntz,
    to_millis,
    up_to,
)

__all__ = [
    "above",
    "count_where",
    "instant_to_ntz",
    "is_sentinel",
    "ntz",
    "to_millis",
    "up_to",
]
