"""Sales targets from a month matrix to long form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from branchledger import values as v
from branchledger.functions.parsing import month_label_key
from branchledger.functions.rules import not_equal_keep_null, recode
from branchledger.operators.stack import stack


def targets_long(matrix: DataFrame, ids: Sequence[str], base_year: int) -> DataFrame:
    """(ids, month_label, target, period); a blank cell is a null target."""
    months = [c for c in matrix.columns if c not in ids]
    numeric = matrix.select(*ids, *[F.col(f"`{m}`").cast("double").alias(m) for m in months])
    return numeric.unpivot(list(ids), months, "month_label", "target").withColumn(
        "period", month_label_key(F.col("month_label"), base_year)
    )


def company_targets(
    matrix: DataFrame,
    base_year: int,
    summary_row: str = v.COMPANY_TARGET_ROW,
    dept_names: Mapping[str, str] = v.TARGET_DEPT_NAMES,
) -> DataFrame:
    """Targets per department; the company summary row is dropped, names conformed."""
    rows = targets_long(matrix, ["dept"], base_year)
    return rows.filter(not_equal_keep_null(F.col("dept"), summary_row)).withColumn(
        "dept", recode(F.col("dept"), dept_names)
    )


def employee_targets(sheets: Sequence[DataFrame], base_year: int) -> DataFrame:
    """Targets per employee from the team sheets (stacked before the unpivot)."""
    return targets_long(stack(sheets), ["dept", "employee_name"], base_year)
