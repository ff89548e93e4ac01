"""Session settings the jobs expect; an existing session is used as it is, but for ``compiled``."""

from __future__ import annotations

from pyspark.sql import SparkSession

METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot lookup key may be split even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # HotSpot never compiles methods over 8000 bytes; wide ledgers generate such methods and
    # run several times faster as separately generated operators.
    METHOD_LIMIT: "8000",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str = "branchledger", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in (SETTINGS | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def compiled(spark: SparkSession) -> None:
    """Let a wide plan run as methods that HotSpot compiles, unless the session has its own limit."""
    if spark.conf.get(METHOD_LIMIT, None) is None:
        spark.conf.set(METHOD_LIMIT, SETTINGS[METHOD_LIMIT])


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, if unset one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch").rstrip("/")
