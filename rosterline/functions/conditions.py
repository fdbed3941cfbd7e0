"""Null-safe join and difference conditions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    """left.k <=> right.k for every key: null matches null, and it is still an equi-join."""
    return reduce(and_, (F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys))


def any_differs(left: str, right: str, types: dict[str, str]) -> Column:
    """True when any column differs, nulls included, after casting both sides to one type."""
    pairs = (
        f"NOT (CAST({left}.`{c}` AS {t}) <=> CAST({right}.`{c}` AS {t}))" for c, t in types.items()
    )
    return F.expr(" OR ".join(pairs))
