"""Conformed employees, customers and products from three source platforms.

Platform labels appear in the ``platforms`` column; callers may pass their own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from branchledger import values as v
from branchledger.functions.parsing import iso_date, mixed_date, strict_stamp
from branchledger.functions.rules import first_match, recode, survivor
from branchledger.functions.text import (
    drop_name_tags, norm_code, sentence_case, swap_prefix, title_words, unit_int,
)
from branchledger.operators.consolidate import Platform, consolidate, from_sources
from branchledger.operators.lookup import any_of_names
from branchledger.operators.skew import skewed_lookup_join
from branchledger.operators.stack import stack


class Platforms(NamedTuple):
    """Labels of the accounting system, the field-sales app and hand-kept files."""

    accounting: str = "ACCOUNTING"
    field: str = "FIELD"
    file: str = "FILE"


def literal_renames(c: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda acc, p: F.replace(acc, F.lit(p[0]), F.lit(p[1])), pairs, c)


# --- stacks -------------------------------------------------------------------------


def staff_stack(staff: DataFrame, office: str = "dept") -> DataFrame:
    """Office staff files in one frame; head-office staff get a department by name.

    Unlike the ledger, staff are matched by the patterns only and default to head office.
    """
    by_name = first_match(F.col("employee_name"), v.DEPT_BY_NAME, v.HEAD_OFFICE)
    return staff.withColumn(
        office, F.when(F.col(office) == v.HEAD_OFFICE, by_name).otherwise(F.col(office))
    )


# --- employees ----------------------------------------------------------------------


def hr_clean(hr: DataFrame) -> DataFrame:
    """HR sheet: normalised code, title case, dates from mixed text; no code -> dropped."""
    return hr.filter(F.col("employee_code").isNotNull()).select(
        norm_code(F.col("employee_code")).alias("employee_code"),
        title_words(F.col("employee_name")).alias("employee_name"),
        title_words(F.col("work_status")).alias("work_status"),
        F.replace("dept", F.lit("  "), F.lit(" ")).alias("dept"),
        F.replace("branch", F.lit("  "), F.lit(" ")).alias("branch"),
        title_words(F.col("specialty")).alias("specialty"),
        "gender",
        mixed_date(F.col("born_on")).alias("born_on"),
        iso_date(F.col("hired_on")).alias("hired_on"),
        F.col("left_on").cast("date").alias("left_on"),
    )


def employee_dim(
    accounting: DataFrame, field: DataFrame, hr: DataFrame, labels: Platforms = Platforms()
) -> DataFrame:
    """One row per employee code; ``hr`` is the output of ``hr_clean``."""
    acc, fld, fil = labels
    merged = consolidate(
        {
            acc: Platform(accounting, "employee_code", ["employee_name", "gender", "title", "dept"]),
            fld: Platform(
                field,
                "employee_code",
                ["employee_name", "login", "born_on", "gender", "dept", "title"],
            ),
            fil: Platform(
                hr,
                "employee_code",
                ["employee_name", "work_status", "dept", "specialty", "gender", "hired_on", "left_on"],
            ),
        },
        "employee_code",
    )
    name = survivor(from_sources("employee_name", fld, acc, fil))
    return merged.select(
        "employee_code",
        drop_name_tags(title_words(name), v.DIM_NAME_TAIL, v.DIM_NAME_ANYWHERE).alias("employee_name"),
        F.col(f"{acc}__employee_name").alias("accounting_name"),
        F.col(f"{fil}__work_status").alias("work_status"),
        F.col(f"{fil}__hired_on").alias("hired_on"),
        F.col(f"{fil}__left_on").alias("left_on"),
        survivor(from_sources("gender", fld, fil, acc)).alias("gender"),
        recode(survivor(from_sources("dept", fld, acc, fil)), v.DIM_DEPT_NAMES).alias("dept"),
        F.col(f"{fil}__specialty").alias("specialty"),
        sentence_case(survivor(from_sources("title", fld, acc))).alias("title"),
        swap_prefix(F.col(f"{fld}__login"), "84", "0").alias("login"),
        F.col(f"{fld}__born_on").alias("born_on"),
        "platforms",
    )


# --- customers ----------------------------------------------------------------------

CUSTOMER_VALUES = [
    "customer_name", "owner", "dept", "address", "province", "phone", "customer_kind",
    "info_status", "feed", "opened_at", "opened_kind",
]


def stacked_customers(feeds: Mapping[str, DataFrame], labels: Mapping[str, str] = v.FEED_LABELS) -> DataFrame:
    """Own/shared customers and prospects in one schema.

    ``feeds`` maps customers, shared_customers, prospects, shared_prospects to report
    frames. A shared feed has no owner (empty text).
    """

    def shape(name: str, df: DataFrame) -> DataFrame:
        owner = F.lit("") if name.startswith("shared_") else F.col("owner")
        kind = v.CREATED if name.endswith("prospects") else v.CONVERTED
        return df.select(
            norm_code(F.col("account_code")).alias("customer_code"),
            F.col("account_name").alias("customer_name"),
            owner.alias("owner"),
            "dept",
            "address",
            "province",
            "phone",
            literal_renames(F.col("customer_kind"), v.FIELD_KIND_RENAMES).alias("customer_kind"),
            F.col("status").alias("info_status"),
            F.lit(labels[name]).alias("feed"),
            strict_stamp(F.col("opened_at")).alias("opened_at"),
            F.lit(kind).alias("opened_kind"),
        )

    return stack([shape(name, df) for name, df in feeds.items()])


def unified_customers(feeds: Mapping[str, DataFrame], labels: Mapping[str, str] = v.FEED_LABELS) -> DataFrame:
    """``stacked_customers`` without exact duplicates, as a table of its own."""
    return stacked_customers(feeds, labels).distinct()


def customer_base(
    unified: DataFrame,
    hand_kept: DataFrame,
    accounting: DataFrame,
    labels: Platforms = Platforms(),
) -> DataFrame:
    """One row per customer code, without the owner's employee code.

    ``unified`` may hold duplicates: the consolidation takes maxima, so
    ``stacked_customers`` saves the shuffle of ``unified_customers``.
    """
    acc, fld, fil = labels
    kind = literal_renames(F.col("customer_kind"), v.FILE_KIND_RENAMES)
    merged = consolidate(
        {
            acc: Platform(
                accounting,
                "customer_code",
                ["customer_name", "address", "owner_code", "owner", "created_on", "dept"],
            ),
            fld: Platform(unified, "customer_code", CUSTOMER_VALUES),
            fil: Platform(
                hand_kept.withColumn("customer_kind", kind),
                "customer_code",
                ["customer_name", "owner", "dept", "address", "customer_kind"],
            ),
        },
        "customer_code",
    )
    return merged.select(
        "customer_code",
        survivor(from_sources("customer_name", fld, fil, acc)).alias("customer_name"),
        F.col(f"{acc}__customer_name").alias("accounting_name"),
        survivor(from_sources("owner", fld, acc, fil), blank_first=True).alias("owner"),
        survivor(from_sources("address", fld, fil, acc)).alias("address"),
        survivor(from_sources("dept", fld, acc, fil)).alias("dept"),
        F.coalesce(f"{fld}__province", f"{acc}__dept").alias("province"),
        survivor(from_sources("customer_kind", fil, fld)).alias("customer_kind"),
        *[
            F.col(f"{fld}__{c}").alias(c)
            for c in ("phone", "info_status", "feed", "opened_at", "opened_kind")
        ],
        F.col(f"{acc}__created_on").alias("accounting_created_on"),
        F.col(f"{acc}__owner_code").alias("owner_code"),
        "platforms",
    )


def customer_dim(
    unified: DataFrame,
    hand_kept: DataFrame,
    accounting: DataFrame,
    employees: DataFrame,
    labels: Platforms = Platforms(),
) -> DataFrame:
    """``customer_base`` with the employee code of the owner."""
    return with_owner_employee(customer_base(unified, hand_kept, accounting, labels), employees)


def with_owner_employee(customers: DataFrame, employees: DataFrame) -> DataFrame:
    """Owner's employee code: the accounting code, else by either name of the employee."""
    names = any_of_names(employees, ["employee_name", "accounting_name"], "employee_code").select(
        F.col("match_name").alias("owner"), F.col("employee_code").alias("__by_name")
    )
    # One owner, or no owner, may hold a large share of the customers.
    joined = skewed_lookup_join(customers, names, ["owner"], ["customer_code"])
    code = F.upper(F.coalesce("owner_code", "__by_name"))
    return joined.withColumn("employee_code", code).drop("__by_name")


# --- products -----------------------------------------------------------------------


def product_dim(
    field: DataFrame, accounting: DataFrame, hand_kept: DataFrame, labels: Platforms = Platforms()
) -> DataFrame:
    """One row per product code with whole-number price and volume."""
    acc, fld, fil = labels
    merged = consolidate(
        {
            acc: Platform(accounting, "product_code", ["product_name", "unit", "discontinued"]),
            fld: Platform(
                field, "product_code", ["product_name", "brand", "list_price", "volume", "category"]
            ),
            fil: Platform(
                hand_kept,
                "product_code",
                ["product_name", "status", "unit", "brand", "group_2", "product_group_name"],
            ),
        },
        "product_code",
    )
    return merged.select(
        "product_code",
        survivor(from_sources("product_name", fld, acc, fil)).alias("product_name"),
        F.col(f"{acc}__product_name").alias("accounting_name"),
        F.col(f"{fil}__status").alias("status"),
        survivor(from_sources("brand", fld, fil)).alias("brand"),
        survivor(from_sources("unit", fil, acc)).alias("unit"),
        unit_int(F.col(f"{fld}__list_price"), v.PRICE_UNITS).alias("list_price"),
        unit_int(F.col(f"{fld}__volume"), v.VOLUME_UNITS).alias("volume"),
        F.col(f"{fil}__group_2").alias("class_1"),
        F.col(f"{fld}__category").alias("class_2"),
        F.col(f"{fil}__product_group_name").alias("class_3"),
        "platforms",
    )
