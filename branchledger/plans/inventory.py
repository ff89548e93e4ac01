"""Inventory movement detail: stock history joined to orders, slips, waybills and dims."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from branchledger import values as v
from branchledger.functions.rules import first_match
from branchledger.functions.text import join_or_blank, norm_code
from branchledger.operators.skew import HOT_ROWS, heavy_keys, salted_left_joins, skewed_lookup_join, spread_nulls

HISTORY, ORDER = "FILE_INVENTORY", "FILE_ORDER"


def with_waybills_and_customers(
    orders: DataFrame, lading: DataFrame, customers: DataFrame, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Order headers with their waybill and customer attributes.

    Done at order grain, so the wide movement rows are never reshuffled for it.
    """
    ladings = lading.select(
        F.col("waybill").alias("lading_code"),
        "carrier",
        F.col("status").alias("lading_status"),
        F.col("created_at").alias("lading_created_at"),
    )
    owners = customers.select(
        F.col("customer_code").alias("dim_customer"), "dept", "province"
    )
    headers = orders.select(
        norm_code(F.col("order_code")).alias("doc_code"),
        F.col("order_code").alias("sales_order"),
        "account_name",
        F.col("account_code").alias("customer_code"),
        norm_code(F.col("account_code")).alias("dim_customer"),
        F.col("waybill").alias("order_waybill"),
        F.col("n_products").alias("order_qty"),
        F.col("amount").alias("order_amount"),
        F.col("discount").alias("order_discount"),
        F.col("paid").alias("order_paid"),
        F.col("created_by").alias("order_created_by"),
        F.col("status").alias("order_status"),
        F.col("created_at").alias("order_created_at"),
        first_match(F.col("account_code"), v.CUSTOMER_TYPES_LIKE, None).alias("customer_type"),
    )
    # Most orders have no waybill; their null keys are spread.
    shipped = headers.join(
        ladings,
        spread_nulls(F.col("order_waybill"), F.col("doc_code")) == F.col("lading_code"),
        "left",
    ).drop("order_waybill")
    return skewed_lookup_join(shipped, owners, ["dim_customer"], ["doc_code"], hot_rows).drop("dim_customer")


def slips(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(
        norm_code(F.col("slip_code")).alias("doc_code"),
        F.col("slip_type").alias(f"{prefix}_type"),
        F.col("created_by").alias(f"{prefix}_created_by"),
        F.col("created_at").alias(f"{prefix}_created_at"),
        F.col("status").alias(f"{prefix}_status"),
    )


def inventory_detail(
    history: DataFrame,
    orders: DataFrame,
    inbound: DataFrame,
    outbound: DataFrame,
    lading: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every movement and every order without a movement, one row per matching document.

    Orders without movements are added as bare documents; the hot documents to split come from a
    sketch of the movements' codes. ``products`` and ``customers`` are dimensions with unique codes.
    """
    prices = products.select(F.col("product_code").alias("dim_product"), "list_price")
    moves = history.select(
        norm_code(F.col("ref_code")).alias("doc_code"),
        "warehouse",
        "partner",
        "occurred_at",
        "product_code",
        norm_code(F.col("product_code")).alias("dim_product"),
        "product_name",
        "movement",
        "volume",
        "qty",
    ).filter(F.col("doc_code").isNotNull())
    order_codes = orders.select(norm_code(F.col("order_code")).alias("doc_code"))
    moved = moves.select("doc_code").distinct()
    bare = order_codes.dropna().distinct().join(moved, "doc_code", "left_anti")
    priced = skewed_lookup_join(moves, prices, ["dim_product"], ["doc_code", "occurred_at"], hot_rows).drop("dim_product")
    headers = with_waybills_and_customers(orders, lading, customers, hot_rows)
    joined = salted_left_joins(
        priced.withColumn("in_history", F.lit(True)).unionByName(bare, allowMissingColumns=True),
        [headers.withColumn("in_orders", F.lit(True)), slips(inbound, "in"), slips(outbound, "out")],
        ["doc_code"],
        ["product_code", "occurred_at", "partner", "qty"],
        heavy_keys(moves, ["doc_code"], hot_rows),
    )
    in_history, in_orders = F.col("in_history"), F.col("in_orders")
    return joined.select(
        "doc_code",
        "warehouse",
        "partner",
        "account_name",
        join_or_blank(F.col("warehouse"), F.col("partner"), " - ").alias("movement_origin"),
        "sales_order",
        "customer_code",
        "customer_type",
        "dept",
        "province",
        "occurred_at",
        "product_code",
        F.when(F.col("partner").like(v.SAMPLE_PARTNER), v.SAMPLE_GOODS)
        .otherwise(v.SOLD_GOODS)
        .alias("goods_class"),
        "product_name",
        "movement",
        "volume",
        "qty",
        "list_price",
        F.coalesce("out_type", "in_type").alias("slip_type"),
        F.coalesce("out_created_by", "in_created_by").alias("slip_created_by"),
        F.coalesce("out_created_at", "in_created_at").alias("slip_created_at"),
        F.coalesce("out_status", "in_status").alias("slip_status"),
        "order_qty",
        "order_amount",
        "order_discount",
        "order_paid",
        "order_created_by",
        "order_status",
        "order_created_at",
        "lading_code",
        "carrier",
        "lading_status",
        "lading_created_at",
        F.concat_ws(", ", F.when(in_history, F.lit(HISTORY)), F.when(in_orders, F.lit(ORDER))).alias(
            "platforms"
        ),
    )
