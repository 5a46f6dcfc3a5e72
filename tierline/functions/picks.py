"""Repeatable pseudo-random picks as pure functions of a row id.

``rand()`` per row changes when a task is retried; a pick computed from the
row's own id and a seed does not, so regenerated partitions are identical.
The step is a Lehmer (MINSTD) multiplication, which any SQL engine can
evaluate the same way with integer arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MODULUS = 2147483647  # 2^31 - 1
MULTIPLIER = 48271


def lehmer(id_col: Column, salt: int) -> Column:
    """A value in [0, 2^31 - 1) derived from ``id_col`` and ``salt``.

    The id is reduced first, so the product stays far below 2^63 and ANSI
    arithmetic cannot overflow.
    """
    return F.pmod(F.pmod(id_col, F.lit(MODULUS)) * F.lit(MULTIPLIER) + F.lit(salt), F.lit(MODULUS))


def pick_int(id_col: Column, salt: int, low: int, high: int) -> Column:
    """Integer in [low, high] chosen by the id."""
    return F.lit(low) + F.pmod(lehmer(id_col, salt), F.lit(high - low + 1))


def pick_from(id_col: Column, salt: int, values: list[str]) -> Column:
    """One of ``values`` chosen by the id."""
    return F.element_at(
        F.array(*[F.lit(v) for v in values]),
        (F.pmod(lehmer(id_col, salt), F.lit(len(values))) + 1).cast("int"),
    )


def lehmer_sql(id_sql: str, salt: int) -> str:
    """SQL text of :func:`lehmer` for engines without Spark's functions."""
    return f"((({id_sql}) % {MODULUS}) * {MULTIPLIER} + {salt}) % {MODULUS}"
