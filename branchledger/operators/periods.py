"""Accounting-period assignment: posting date x department -> period.

The closing calendar of a department is an ordered list of (start, end, period).
A date up to and including ``start`` belongs to the month before ``period``, a date in
``(start, end]`` to ``period``, a date after the last ``end`` to the month after.
The calendar is flattened into disjoint half-open intervals ``(after, until]`` and these into one
literal array with an entry for each day, a stretch per department: the department gives where its
stretch begins, the date how far into it. No join, no shuffle, no search, and both columns occur
once in the expression, so it stays small when filters are pushed through it. The array has as many
entries as the closings span days, times departments.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Mapping, Sequence
from datetime import date, timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

OPEN_END = date(2099, 12, 31)
FIRST_DAY, LAST_DAY = date(1, 1, 1), date(9999, 12, 31)

EPOCH = date(1970, 1, 1)


class Closing(NamedTuple):
    start: date
    end: date | None
    period: str  # yyyy-MM


Calendar = Mapping[str, Sequence[Closing]]


def shift_month(period: str, months: int) -> date:
    year, month = (int(x) for x in period.split("-"))
    index = year * 12 + month - 1 + months
    return date(index // 12, index % 12 + 1, 1)


def intervals(closings: Sequence[Closing]) -> list[tuple[date, date, date]]:
    """Disjoint ``(after, until, month)`` rows of one department."""
    rows = []
    covered = FIRST_DAY
    for closing in closings:
        end = closing.end or OPEN_END
        for bound, shift in ((closing.start, -1), (end, 0)):
            if bound > covered:
                rows.append((covered, bound, shift_month(closing.period, shift)))
                covered = bound
        if closing == closings[-1]:
            rows.append((covered, LAST_DAY, shift_month(closing.period, 1)))
            break
    return rows


def _months(day: date) -> int:
    return day.year * 12 + day.month - 1


class DayTable(NamedTuple):
    """Months of all departments, day by day."""

    begins: dict[str, int]  # department -> its first entry
    first: int  # day of the first entry of a stretch, from 1970
    days: int  # entries of a stretch; the last one is for days behind an open end
    least: int  # added to every entry
    months: list[int]


def day_table(calendar: Calendar) -> DayTable | None:
    """The months that rules give to every day; None without any rule.

    A stretch runs from the earliest to the latest bound of all departments. Days before it are like
    its first, days behind it like the last but one, until the end that an open closing has.
    """
    rules = {dept: rows for dept, closings in calendar.items() if (rows := intervals(closings))}
    if not rules:
        return None
    inner = [until for rows in rules.values() for _, until, _ in rows if until < OPEN_END] or [EPOCH]
    first, last = min(inner), max(inner) + timedelta(days=1)
    months: list[int] = []
    for rows in rules.values():
        ends = [until for _, until, _ in rows]
        days = [first + timedelta(days=i) for i in range((last - first).days + 1)] + [OPEN_END + timedelta(days=1)]
        months.extend(_months(rows[bisect_left(ends, day)][2]) for day in days)
    width, least = (last - first).days + 2, min(months)
    return DayTable({d: i * width for i, d in enumerate(rules)}, (first - EPOCH).days, width, least, [m - least for m in months])


def closing_months(dept: Column, posted: Column, calendar: Calendar) -> Column:
    """The month of a date by its department's rules, counted from year 0; null without a rule."""
    table = day_table(calendar)
    if table is None:
        return F.lit(None).cast("int")
    begin = F.try_element_at(F.create_map(*[F.lit(x) for pair in table.begins.items() for x in pair]), dept)
    days = F.unix_date(posted)
    inside = F.greatest(F.lit(0), F.least(F.lit(table.days - 2), days - table.first))
    at = begin + inside + (days > (OPEN_END - EPOCH).days).cast("int")
    # Plain text, which the optimizer turns into a constant array.
    months = F.split(F.lit(",".join(map(str, table.months))), ",").cast("array<int>")
    return F.get(months, at) + table.least


def assign_period(
    df: DataFrame,
    calendar: Calendar,
    dept: str = "dept",
    posted: str = "posting_date",
    fallback: str | None = "month",
) -> DataFrame:
    """Add ``closing_month``, ``closing_year`` and ``period`` (``yyyy-MM``).

    ``fallback='month'`` uses the month of the date where no rule applies, ``None``
    leaves the period null. A null date is null either way.
    """
    day = F.col(posted)
    month = closing_months(F.col(dept), day, calendar)
    if fallback == "month":
        month = F.coalesce(month, F.year(day) * 12 + F.month(day) - 1)
    df = df.withColumn("__month", month)
    month = F.col("__month")
    return df.withColumns(
        {
            "closing_month": (month % 12 + 1).cast("int"),
            "closing_year": F.floor(month / 12).cast("int"),
        }
    ).withColumn("period", F.concat(F.lpad(F.col("closing_year").cast("string"), 4, "0"), F.lit("-"), F.lpad(F.col("closing_month").cast("string"), 2, "0"))).drop("__month")
