"""Salary after a number of strikes.

SQL text and not Column calls: ten rungs of nested Column calls cost about a second
of driver time per plan, the parsed text a few milliseconds.
"""

from __future__ import annotations

from decimal import Decimal

from ..schemas import STRIKE_FACTOR


def rung(
    salary: str, i: int, factor: str = STRIKE_FACTOR, arithmetic: str = "decimal"
) -> str:
    """SQL for round(salary * factor**i, 2), half up, of a salary expression.

    "decimal" multiplies exactly, so a half cent always rounds up; "double"
    multiplies in binary floating point, where a half cent may fall either way.
    """
    if arithmetic == "double":
        return f"round(CAST({salary} AS DOUBLE) * {float(factor) ** i!r}D, 2)"
    power = Decimal(factor) ** i
    digits = max(1, -power.as_tuple().exponent)
    share = f"CAST('{power:f}' AS DECIMAL({digits + 1},{digits}))"
    return f"CAST(round(CAST({salary} AS DECIMAL(20,4)) * {share}, 2) AS DOUBLE)"
