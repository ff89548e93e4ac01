"""Conditional columns driven by rule lists passed in as data."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, functions as F


class Rule(NamedTuple):
    """``test`` names a Column predicate: contains, endswith, like or isin."""

    test: str
    value: str | list[str]
    label: str

    def matches(self, c: Column) -> Column:
        return getattr(c, self.test)(self.value)


def first_match(c: Column, rules: Iterable[Rule], default: str | Column | None) -> Column:
    """Label of the first rule that holds; a null input falls to the default."""
    # coalesce of single-branch whens: the first branch that is not null wins.
    hits = [F.when(rule.matches(c), F.lit(rule.label)) for rule in rules]
    return F.coalesce(*hits, default if isinstance(default, Column) else F.lit(default))


def recode(c: Column, mapping: Mapping[str, str], default: Column | None = None) -> Column:
    """Exact-value replacement; unknown values keep ``c`` (or take ``default``)."""
    if not mapping:
        return c if default is None else default
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), c if default is None else default)


def not_in_keep_null(c: Column, values: Iterable[str]) -> Column:
    return c.isNull() | ~c.isin(*values)


def not_equal_keep_null(c: Column, value: str) -> Column:
    return ~c.eqNullSafe(F.lit(value))


def cap(c: Column, top: float) -> Column:
    """Upper bound; null stays null and small or negative values are untouched."""
    return F.when(c > top, F.lit(top)).otherwise(c)


def guarded_ratio(num: Column, den: Column) -> Column:
    """0 where the denominator is 0, null where either side is null."""
    return F.when(den == 0, F.lit(0.0)).otherwise(F.try_divide(num, den))


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def survivor(columns: Iterable[Column], blank_first: bool = False) -> Column:
    """First non-null in priority order; ``blank_first`` also skips '' in the first source."""
    columns = list(columns)
    if blank_first:
        columns[0] = F.nullif(columns[0], F.lit(""))
    return F.coalesce(*columns)
