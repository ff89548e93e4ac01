"""Column names: report headers, staged names and the English names used in the jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from branchledger.functions.text import plain_text


def staged_name(header: str) -> str:
    """``Mã khách hàng`` -> ``ma_khach_hang``; other punctuation survives."""
    return plain_text(header).lower().replace(" ", "_")


def _unique(names: Sequence[str]) -> list[str]:
    seen: dict[str, int] = {}
    for n in names:
        seen[n] = seen.get(n, 0) + 1
    clashes = sorted(n for n, k in seen.items() if k > 1)
    if clashes:
        raise ValueError(f"column names collide after normalisation: {clashes}")
    return list(names)


def stage_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*_unique([staged_name(c) for c in df.columns]))


def capitalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*_unique([c.capitalize() for c in df.columns]))


def report_headers(df: DataFrame, headers: dict[str, str]) -> DataFrame:
    """Jobs' English names back to report headers, e.g. before staging for old queries."""
    return df.toDF(*_unique([headers.get(c, c) for c in df.columns]))
