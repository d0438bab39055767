"""Sums that do not depend on the order or the grouping of their terms.

A number is split into its whole part and the rest in units of 2 ** -30, both whole numbers of
64 bits, and whole numbers add up exactly. A fractional value is thus taken to the nearest
multiple of 2 ** -30 (about 1e-9); whole numbers and halves, quarters and so on are exact. The
whole parts of a group may add up to 2 ** 63 and a group may have 2 ** 33 rows; Spark raises an
error beyond that. NaN counts as missing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNIT = float(1 << 30)


def is_whole(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.IntegralType)


class Measures:
    """Per field, the whole-number columns whose sums give its exact sum and count."""

    def __init__(self, df: DataFrame, fields: list[str]):
        self.columns: dict[str, Column] = {}
        self.of: list[tuple[str, str | None, str]] = []
        for at, field in enumerate(fields):
            value = F.col(field)
            whole, rest, known = f"__w_{at}", f"__r_{at}", f"__k_{at}"
            zero = F.lit(0).cast("long")
            if is_whole(df, field):
                self.columns[whole] = F.coalesce(value.cast("long"), zero)
                self.columns[known] = value.isNotNull().cast("long")
                self.of.append((whole, None, known))
                continue
            value = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
            self.columns[whole] = F.coalesce(F.floor(value).cast("long"), zero)
            self.columns[rest] = F.coalesce(F.rint((value - F.floor(value)) * F.lit(UNIT)).cast("long"), zero)
            self.columns[known] = value.isNotNull().cast("long")
            self.of.append((whole, rest, known))

    @property
    def names(self) -> list[str]:
        return list(self.columns)

    def total(self, at: int, of: Callable[[str], Column]) -> Column:
        """Sum of the field ``at`` as a double, given the sum of each of its columns."""
        whole, rest, _ = self.of[at]
        found = of(whole).cast("double")
        return found if rest is None else found + of(rest).cast("double") / F.lit(UNIT)

    def mean(self, at: int, of: Callable[[str], Column]) -> Column:
        """Mean of the known values; null if there is none."""
        known = of(self.of[at][2])
        return F.when(known > 0, self.total(at, of) / known)

    def mean_sql(self, at: int, of: Callable[[str], str]) -> str:
        """The same as SQL text, which a plan of many fields builds much faster than columns."""
        whole, rest, known = (name and of(name) for name in self.of[at])
        total = f"CAST({whole} AS DOUBLE)" + (f" + CAST({rest} AS DOUBLE) / {UNIT!r}D" if rest else "")
        return f"CASE WHEN {known} > 0 THEN ({total}) / {known} END"
