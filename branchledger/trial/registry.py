"""Query registry: each Spark query stands beside its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType

from branchledger.trial import inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def shown(df: DataFrame) -> DataFrame:
    """Dates as text and decimals as doubles, so both engines print the same values."""
    cast = {DateType: "string", TimestampNTZType: "string", DecimalType: "double"}
    return df.select(
        *[
            F.col(f.name).cast(cast[type(f.dataType)]).alias(f.name)
            if type(f.dataType) in cast
            else F.col(f.name)
            for f in df.schema
        ]
    )


def query(name: str, sql: str | None = None, uses: tuple[str, ...] = ()):
    """Register ``fn(inputs...)``; ``uses`` names the inputs, loaded in that order.

    ``sql`` is the body after the input CTEs; it may start with further CTEs by
    beginning with a comma.
    """

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return shown(fn(*[inputs.load(spark, sf_dir, u) for u in uses]))

        QUERIES[name] = run
        if sql is not None:
            # An input may itself be a test table and then needs no CTE.
            derived = [u for u in uses if u in inputs.INPUTS]
            head = f"WITH {inputs.oracle_ctes(*derived)}" if derived else ""
            body = sql.strip()
            if not head and body.startswith(","):
                head, body = "WITH", body[1:]
            ORACLES[name] = f"{head}\n{body}"
        return fn

    return register

