"""Two-key counts with a grand-total row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from branchledger.values import TOTAL_LABELS


def counts_with_total(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str,
    total_labels: Sequence[str] = TOTAL_LABELS,
) -> DataFrame:
    """Count of non-null ``value`` per key pair plus one total row, even on empty input.

    Rows with a null key count nowhere. The total is summed from the per-key counts, so
    the input is scanned and shuffled once.
    """
    detail = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(value).alias(out))
    total = detail.agg(F.coalesce(F.sum(out), F.lit(0)).alias(out)).select(
        *[F.lit(label).alias(k) for k, label in zip(keys, total_labels, strict=True)], out
    )
    return detail.unionByName(total)


def counts_by_case_with_total(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    cases: Mapping[str, Column],
    case_name: str,
    out: str,
    total_labels: Sequence[str] = TOTAL_LABELS,
) -> DataFrame:
    """``counts_with_total`` for several row conditions from one grouping pass.

    A key pair appears under a case only if the case holds for at least one of its rows;
    every case has its total row.
    """
    names = list(cases)
    clean = df.dropna(subset=list(keys))
    counted = clean.groupBy(*keys).agg(
        *[F.count(F.when(cases[n], F.lit(1))).alias(f"rows_{i}") for i, n in enumerate(names)],
        *[F.count(F.when(cases[n], F.col(value))).alias(f"n_{i}") for i, n in enumerate(names)],
    )

    def long(per_case: Sequence[Column]) -> Column:
        return F.inline(F.array(*per_case))

    detail = counted.select(
        *keys,
        long(
            [
                F.struct(
                    F.lit(n).alias(case_name),
                    F.col(f"n_{i}").alias(out),
                    (F.col(f"rows_{i}") > 0).alias("present"),
                )
                for i, n in enumerate(names)
            ]
        ),
    ).filter("present")
    total = counted.agg(
        *[F.coalesce(F.sum(f"n_{i}"), F.lit(0)).alias(f"n_{i}") for i in range(len(names))]
    ).select(
        *[F.lit(label).alias(k) for k, label in zip(keys, total_labels, strict=True)],
        long(
            [
                F.struct(F.lit(n).alias(case_name), F.col(f"n_{i}").alias(out))
                for i, n in enumerate(names)
            ]
        ),
    )
    return detail.drop("present").unionByName(total)
