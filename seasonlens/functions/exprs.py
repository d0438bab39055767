"""Column expressions with explicit null, rounding and parsing rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Position codes a leader board treats as one group.
FLEX = ["RB", "WR", "TE", "FB"]

# Season from which extra points are kicked from 33 instead of 19 yards.
LONG_XP_FROM, SHORT_XP, LONG_XP = 2015, 19, 33


def is_true(condition: Column) -> Column:
    """A comparison with null is False."""
    return F.coalesce(condition, F.lit(False))


def half_even(column: Column | str, digits: int) -> Column:
    """Round the scaled double to even, as floating-point libraries do."""
    column = F.col(column) if isinstance(column, str) else column
    scale = float(10**digits)
    return F.rint(column * scale) / scale


def round_numbers(df: DataFrame, digits: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Round all fractional columns, or the named ones; integers stay as they are."""
    fractional = [field.name for field in df.schema.fields if isinstance(field.dataType, (T.DoubleType, T.FloatType))]
    names = fractional if columns is None else list(columns)
    return df.withColumns({name: half_even(name, digits) for name in names})


def fill_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls become 0, in text columns '0'; dates and flags are left alone."""
    names = list(df.columns if columns is None else columns)
    return df.fillna(0, subset=names).fillna("0", subset=names)


def drop_range(df: DataFrame, first: str, last: str) -> DataFrame:
    """Drop the columns from ``first`` to ``last``, both included, as they stand in the table."""
    names = df.columns
    return df.drop(*names[names.index(first) : names.index(last) + 1])


def swap_where(df: DataFrame, condition: Column, a: str, b: str) -> DataFrame:
    """Exchange two columns on the rows where ``condition`` holds."""
    swap = is_true(condition)
    return df.withColumns(
        {a: F.when(swap, F.col(b)).otherwise(F.col(a)), b: F.when(swap, F.col(a)).otherwise(F.col(b))}
    )


#: date formats besides ISO, with the shape of a text that is tried with each
DATE_FORMATS = {
    "M/d/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
    "yyyyMMdd": r"^\d{8}$",
    "MMM d, yyyy": r"^[A-Z][a-z]{2} \d{1,2}, \d{4}$",
    "d MMM yyyy": r"^\d{1,2} [A-Z][a-z]{2} \d{4}$",
}


def to_date_or_null(column: Column | str) -> Column:
    """Parse a date text; anything that is in none of the formats gives null.

    ISO dates and timestamps, and the ``DATE_FORMATS``. A year alone, or a year and a month, is no
    date. ISO texts are a try_cast, as parse functions raise and catch an exception per bad value.
    """
    text = F.trim((F.col(column) if isinstance(column, str) else column).cast("string"))
    iso = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), text.try_cast("date"))
    others = [F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(form)).cast("date")) for form, shape in DATE_FORMATS.items()]
    return F.coalesce(iso, *others)


def xp_distance(date: Column) -> Column:
    """Extra-point distance by calendar year; an unknown date counts as recent."""
    return F.when(F.year(date) < LONG_XP_FROM, SHORT_XP).otherwise(LONG_XP)


def kick_flags(date: Column, xp_result: Column, fg_result: Column, distance: Column) -> dict[str, Column]:
    """Outcome flags of one kick: extra points by distance, field goals made and missed by range."""
    yards = xp_distance(date)
    tried, good = xp_result.isNotNull(), is_true(xp_result == "good")
    ranges = {"50+": distance >= 50, "40-49": distance.between(40, 49), "0-39": distance < 40}
    flags = {}
    for at in (SHORT_XP, LONG_XP):
        flags[f"xp_attempt_{at}y"] = tried & (yards == at)
        flags[f"xp_made_{at}y"] = good & (yards == at)
    for name, within in ranges.items():
        flags[f"{name}_fg_made"] = is_true((fg_result == "made") & within)
        flags[f"missed_fg_{name}"] = is_true((fg_result == "missed") & within)
    return flags


def count_true(flags: Sequence[Column]) -> Column:
    """How many flags of the row are set."""
    return reduce(lambda a, b: a + b, [flag.cast("int") for flag in flags])


def week_label(week: str = "week") -> Column:
    return F.concat(F.lit("Week "), F.col(week).cast("string"))


def contains_text(column: str, text: str) -> Column:
    """Case-insensitive substring test."""
    return F.lower(column).contains(text.lower())


def plain_text(df: DataFrame, old: str = ",", new: str = "-") -> DataFrame:
    """Every column as text with ``old`` replaced, ready for a comma-separated file."""
    return df.select(*[F.translate(F.col(name).cast("string"), old, new).alias(name) for name in df.columns])


def splice(week: Column, cutoff: int, actual: Column, predicted: Column) -> Column:
    """The actual measure before the cut-off week, the predicted one from it on."""
    return F.when(week < cutoff, actual).otherwise(predicted)


def position_filter(code: str, column: str = "position") -> Column:
    """``All`` keeps every row, ``FLEX`` a fixed set, any other code itself."""
    if code == "All":
        return F.lit(True)
    return F.col(column).isin(FLEX) if code == "FLEX" else F.col(column) == code


def quality_counts(df: DataFrame, swapped: Column, raw_date: str) -> DataFrame:
    """Rows a swap applies to, rows whose date text cannot be parsed, and whether there are any."""
    bad = F.col(raw_date).isNotNull() & to_date_or_null(F.col(raw_date)).isNull()
    return df.agg(
        F.count_if(is_true(swapped)).alias("rows_swapped"),
        F.count_if(bad).alias("bad_dates"),
        F.coalesce(F.bool_or(to_date_or_null(F.col(raw_date)).isNull()), F.lit(False)).alias("any_missing_date"),
    )
