"""Missing-value rules: which sums and tests propagate NULL and which do not."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brinedeck.fixed_values import BAD_FLAGS


def sum_or_zero(value: Column) -> Column:
    """Sum that skips NULL; an empty sum is 0."""
    return F.coalesce(F.sum(value), F.lit(0.0))


def sum_strict(value: Column) -> Column:
    """Sum that is NULL when any value of the group is NULL."""
    return F.when(F.count(F.lit(1)) == F.count(value), F.sum(value))


def max_strict(value: Column) -> Column:
    """Maximum that is NULL when any value of the group is NULL."""
    return F.when(F.count(F.lit(1)) == F.count(value), F.max(value))


def is_in(value: Column, options: Iterable) -> Column:
    """Membership; NULL is a member of nothing."""
    return F.coalesce(value.isin(list(options)), F.lit(False))


def not_in(value: Column, options: Iterable) -> Column:
    """Complement of ``is_in``: keeps NULL."""
    return ~is_in(value, options)


def matches(value: Column, regex: str) -> Column:
    return F.coalesce(value.rlike(regex), F.lit(False))


def not_matches(value: Column, regex: str) -> Column:
    """True for NULL as well as for text without the pattern."""
    return ~matches(value, regex)


def paste(*parts: Column | str) -> Column:
    """Concatenate; a NULL part prints as ``NA``."""
    cols = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("NA")) for p in parts]
    return F.concat(*cols)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that is NULL on a zero denominator."""
    return F.try_divide(numerator, denominator)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def nan_columns_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating-point column."""
    return df.select(*[
        nan_to_null(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def mask_flagged(value: Column, flag: Column, bad: Iterable[int] = BAD_FLAGS) -> Column:
    """NULL where the flag is bad; an absent flag keeps the value."""
    return F.when(not_in(flag, bad), value)


def range_null(value: Column, low: float, high: float) -> Column:
    """NULL outside the open interval (low, high)."""
    return F.when((value > low) & (value < high), value)


def map_code(code: Column, mapping: dict[str, str], default: str | None = None) -> Column:
    """Code to name; unknown codes give ``default``."""
    out = None
    for key, name in mapping.items():
        out = F.when(code == key, name) if out is None else out.when(code == key, name)
    return out.otherwise(F.lit(default))
