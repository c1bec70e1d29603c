"""Registration of queries beside their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Registry:
    def __init__(self):
        self.queries: dict[str, Callable] = {}
        self.oracle: dict[str, str] = {}

    def __call__(self, sql: str | None = None):
        def keep(f: Callable) -> Callable:
            self.queries[f.__name__] = f
            if sql is not None:
                self.oracle[f.__name__] = sql
            return f

        return keep


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded: sums in another order differ in the last bits. Adding 0.0 turns -0.0 into 0.0."""
    return df.select(*((_nearest(F.col(c), digits) + 0.0).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def _nearest(c: Column, digits: int) -> Column:
    """As the SQL rounds: to the whole number next to the scaled double, halves away from 0. F.round to digits goes by the
    shortest decimal instead, so that some ties of the last digit end on its other side."""
    scale = 10.0**digits
    return F.when(F.abs(c) < 1e300, F.round(c * scale) / scale).otherwise(c)


#: Added before rounding where values are short decimals, whose ties two engines' last bits would round apart.
OFF_TIES = 1e-7


def r(expression: str, name: str, digits: int = 4) -> str:
    return f"round({expression}, {digits}) + 0.0 as {name}"
