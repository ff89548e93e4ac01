"""Dates, times and numbers read from report text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DATE_FMT = "dd/MM/yyyy"
STAMP_FMT = "HH:mm:ss dd/MM/yyyy"
SHORT_STAMP_FMT = "HH:mm dd/MM/yyyy"


def strict_date(c: Column, fmt: str = DATE_FMT) -> Column:
    """Bad text fails the job (ANSI mode)."""
    return F.to_date(c, fmt)


def strict_stamp(c: Column, fmt: str = STAMP_FMT) -> Column:
    return F.to_timestamp_ntz(c, F.lit(fmt))


def lenient_time(c: Column) -> Column:
    """``H:m:s`` text as a timestamp on the epoch day; bad text is null."""
    return F.try_to_timestamp(c, F.lit("H:m:s"))


def minutes_between(start: Column, end: Column) -> Column:
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60.0)


def iso_date(c: Column) -> Column:
    """Text that starts with an ISO date; anything else is null."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(c, 1, 10).try_cast("date"))


def mixed_date(c: Column, fmt: str = DATE_FMT) -> Column:
    """ISO prefix or ``dd/MM/yyyy`` prefix, else null."""
    day = F.try_to_timestamp(F.substring(c, 1, 10), F.lit(fmt)).cast("date")
    return F.coalesce(iso_date(c), F.when(c.rlike(r"^\d{2}/\d{2}/\d{4}"), day))


def lenient_long(c: Column) -> Column:
    """Text -> whole number, truncating; null or unreadable -> 0."""
    # Spark reads Java literals such as ``1d`` as numbers; reports mean text there.
    number = F.when(~c.rlike("[dDfF]$"), c.try_cast("double"))
    return F.coalesce(F.nanvl(number, F.lit(0.0)), F.lit(0.0)).cast("bigint")


def month_floor(c: Column) -> Column:
    return F.trunc(c, "month")


def month_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def in_month(c: Column, year: int, month: int) -> Column:
    """Half-open range on the raw column, so that a scan can prune by it."""
    nxt = (year + 1, 1) if month == 12 else (year, month + 1)
    start = F.lit(f"{year:04d}-{month:02d}-01").cast("timestamp_ntz")
    end = F.lit(f"{nxt[0]:04d}-{nxt[1]:02d}-01").cast("timestamp_ntz")
    return (c >= start) & (c < end)


def month_label_key(label: Column, base_year: int) -> Column:
    """``Tháng 3, 2025`` -> ``2025-03``; ``Tháng 3`` -> base year; ``Tổng`` stays; else null."""
    dated = r"Tháng\s*(\d+),\s*(\d+)"

    def number(pattern: str, group: int) -> Column:
        return F.regexp_extract(label, pattern, group).try_cast("int")

    dated_key = F.format_string("%d-%02d", number(dated, 2), number(dated, 1))
    plain_key = F.format_string(f"{base_year}-%02d", number(r"(\d+)", 1))
    return (
        F.when(label == "Tổng", label)
        .when(label.contains(","), F.when(label.rlike(dated), dated_key))
        .when(label.contains("Tháng") & label.rlike(r"\d"), plain_key)
    )
