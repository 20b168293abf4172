"""Building blocks shared by all Column functions."""

from __future__ import annotations

import operator
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {
    "==": operator.eq,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
}


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def band(value: Column | str, steps: Sequence[tuple], otherwise) -> Column:
    """Ordered ladder: the first ``(op, limit, label)`` that holds gives the label.

    NULL satisfies no step and gets ``otherwise``.
    """
    value = col(value)
    chain = F
    for op, limit, label in steps:
        chain = chain.when(_COMPARE[op](value, F.lit(limit)), F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def flag(condition: Column) -> Column:
    """1 where the condition is true, 0 where it is false or NULL. Kept as int so it can be summed."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def in_flag(value: Column | str, members: Iterable) -> Column:
    return flag(col(value).isin(list(members)))


def category(value: Column | str, groups: Sequence[tuple[str, Sequence]], otherwise=None) -> Column:
    """Label of the first group whose member list holds the value."""
    value = col(value)
    chain = F
    for label, members in groups:
        chain = chain.when(value.isin(list(members)), F.lit(label))
    return chain.otherwise(F.lit(otherwise)) if otherwise is not None else chain


def lookup(value: Column | str, table: Mapping, default=None) -> Column:
    """Value from a small fixed table, else ``default`` (a literal or a Column)."""
    value = col(value)
    chain = F
    for key, result in table.items():
        chain = chain.when(value == F.lit(key), F.lit(result))
    if default is None:
        return chain
    return chain.otherwise(default if isinstance(default, Column) else F.lit(default))


def contains_any(value: Column | str, words: Iterable[str]) -> Column:
    """Case-insensitive 'contains' for any of the words. NULL stays NULL."""
    value = col(value)
    return reduce(operator.or_, [value.ilike(f"%{word}%") for word in words])


def rounded_ratio(numerator: Column, denominator: Column, digits: int, scale: float = 1, otherwise=None) -> Column:
    """``round(numerator / denominator * scale, digits)`` where the denominator is above zero, else ``otherwise``.

    The default ``otherwise`` is NULL; a literal or a Column may be given.
    """
    ratio = numerator / denominator
    if scale != 1:
        ratio = ratio * F.lit(scale)
    chain = F.when(denominator > 0, F.round(ratio, digits))
    if otherwise is None:
        return chain
    return chain.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def strict_greatest(*values: Column) -> Column:
    """``greatest`` that is NULL as soon as one argument is NULL."""
    known = reduce(operator.and_, [v.isNotNull() for v in values])
    return F.when(known, F.greatest(*values))


def known(value: Column | str) -> Column:
    """A double, or NULL where it is not a finite number: the one rule for missing measurements."""
    number = col(value).cast("double")
    return F.when(F.isnan(number) | (F.abs(number) == F.lit(float("inf"))), None).otherwise(number)


def to_number(value: Column | str) -> Column:
    """Text to double; anything that is not a finite number becomes NULL, the texts NaN and Infinity too."""
    return known(col(value).try_cast("double"))


def text_or_empty(value: Column | str) -> Column:
    return F.coalesce(col(value).cast("string"), F.lit(""))


def as_decimal(value: Column) -> Column:
    """The value with twelve digits behind the point, or NULL where that is another number by more than a double's own error."""
    decimal = value.try_cast("decimal(38,12)")
    return F.when(F.abs(decimal.cast("double") - value) <= F.abs(value) * F.lit(1e-15), decimal)


def exact_sum(value: Column | str) -> Column:
    """Sum of the known values that does not depend on row order or task retries, with all their digits.

    Values are added as decimals as long as twelve digits hold each of them and the sum has room;
    otherwise the plain sum of the doubles is taken. NULL if there is no known value.
    """
    number = known(value)
    decimal = as_decimal(number)
    total = F.try_sum(decimal).cast("double")
    return F.when(F.count(decimal) == F.count(number), F.coalesce(total, F.sum(number))).otherwise(F.sum(number))


def exact_avg(value: Column | str) -> Column:
    """Mean of the known values from an exact sum; NULL for a group without any."""
    return F.try_divide(exact_sum(value), F.count(known(value)).cast("double"))


def count_if(condition: Column) -> Column:
    return F.count_if(condition)


def first_present(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    """First candidate that is a column name."""
    return next((name for name in candidates if name in columns), None)


def first_present_col(columns: Sequence[str], candidates: Sequence[str], default: str = "") -> Column:
    """The first candidate column as text, or a constant when none is present."""
    name = first_present(columns, candidates)
    return text_or_empty(F.col(f"`{name}`")) if name else F.lit(default)


def first_filled_col(columns: Sequence[str], candidates: Sequence[str], default: str = "") -> Column:
    """The first candidate with a text in the row, or a constant: columns that a source declares but leaves empty are passed over."""
    found = [F.nullif(F.col(f"`{name}`").cast("string"), F.lit("")) for name in candidates if name in columns]
    return F.coalesce(*found, F.lit(default))


def first_containing(columns: Sequence[str], parts: Sequence[str]) -> str | None:
    """First column whose lower-cased name contains any of the parts."""
    return next((c for c in columns if any(p in c.lower() for p in parts)), None)
