"""Reader queries: the test tables are exported as report drops and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from branchledger.functions.money import cents
from branchledger.plans import jobs, ledger as L
from branchledger.plans.dims import staff_stack
from branchledger.session import shared_folder
from branchledger.sinks.files import write_ledger_month
from branchledger.sinks.parts import part_of, upsert_parts
from branchledger.sinks.tables import stage_table
from branchledger.sources import schemas
from branchledger.sources.reports import read_folder, read_offices, read_report, read_year
from branchledger.trial import sql as S
from branchledger.trial.inputs import DISTRIBUTORS, OFFICES
from branchledger.trial.registry import query

CSV = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def drop_folder(df: DataFrame) -> str:
    return f"{shared_folder(df.sparkSession)}/trial-{uuid.uuid4().hex}"


def write_reports(
    df: DataFrame, layout: schemas.Layout, columns: list[str] | None = None, blank: bool = False, by: dict[str, int] | None = None
) -> str:
    """Report files with title rows, a header and a total row, one for each shuffle partition.

    ``columns``: their order in the files, others being further columns; ``blank``: an empty
    title row; ``by``: one report per office instead, by its number.
    """
    folder = drop_folder(df)
    n_files = len(by) if by else int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    report = F.pmod(F.xxhash64("voucher_no", "product_code"), F.lit(n_files))
    if by:
        report = F.try_element_at(F.create_map(*[F.lit(x) for pair in by.items() for x in pair]), F.col("dept")).cast("bigint")
    columns = columns or list(layout.columns)
    df = df.withColumns({c: F.lit("x") for c in columns if c not in df.columns})
    body = df.select(
        report.alias("report"),
        F.lit(layout.header_row + 1).alias("place"),
        F.to_csv(F.struct(*columns), CSV).alias("value"),
    )
    titles = ["" if blank and i else f"Báo cáo {i},kỳ" for i in range(layout.header_row)]
    edges = [*enumerate(titles), (layout.header_row, ",".join(layout.columns.get(c, c) for c in columns))]
    if layout.footer:
        edges.append((layout.header_row + 2, "Tổng cộng"))
    frame = df.sparkSession.range(n_files).select(
        F.col("id").alias("report"),
        F.inline(F.array(*[F.struct(F.lit(p).alias("place"), F.lit(t).alias("value")) for p, t in edges])),
    )
    (
        body.unionByName(frame)
        .repartition(n_files, "report")
        .sortWithinPartitions("report", "place")
        .drop("place")
        .write.partitionBy("report")
        .text(folder)
    )
    return folder


TOTALS = """count(*) AS n_lines, CAST(sum(CAST(total_payment AS DECIMAL(18,2))) AS DOUBLE) AS total_payment"""


INGEST = f"SELECT salesperson, {TOTALS} FROM sales_lines GROUP BY salesperson"


def ingested(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read_report(spark, f"{folder}/report=*", schemas.SALES)
        .groupBy("salesperson")
        .agg(F.count(F.lit(1)).alias("n_lines"), F.sum(cents("total_payment")).alias("total_payment"))
    )


@query("report_ingest", INGEST, ("sales_lines",))
def report_ingest(lines: DataFrame) -> DataFrame:
    return ingested(lines.sparkSession, write_reports(lines, schemas.SALES))


@query("report_reordered_columns", INGEST, ("sales_lines",))
def report_reordered_columns(lines: DataFrame) -> DataFrame:
    columns = list(schemas.SALES.columns)[::-1]
    return ingested(lines.sparkSession, write_reports(lines, schemas.SALES, columns))


@query("report_extra_columns", INGEST, ("sales_lines",))
def report_extra_columns(lines: DataFrame) -> DataFrame:
    columns = ["extra first", *schemas.SALES.columns, "extra last"]
    return ingested(lines.sparkSession, write_reports(lines, schemas.SALES, columns))


@query("report_blank_title_rows", INGEST, ("sales_lines",))
def report_blank_title_rows(lines: DataFrame) -> DataFrame:
    return ingested(lines.sparkSession, write_reports(lines, schemas.SALES, blank=True))


@query("office_read", f"SELECT dept, {TOTALS} FROM sales_lines GROUP BY dept", ("sales_lines",))
def office_read(lines: DataFrame) -> DataFrame:
    """One report file per office, read back by the offices' file names."""
    spark, numbers = lines.sparkSession, {office: i for i, office in enumerate(OFFICES)}
    folder = write_reports(lines, schemas.SALES, by=numbers)
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for i in numbers.values():  # Spark names its files by itself
        for part in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/report={i}/part-*")):
            fs.rename(part.getPath(), spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/office {i}.csv"))
    sales = read_offices(spark, folder, schemas.SALES, {office: f"office {i}.csv" for office, i in numbers.items()})
    return sales.groupBy("dept").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(cents("total_payment")).alias("total_payment"))


@query("audit_totals", f"SELECT {TOTALS} FROM sales_lines", ("sales_lines",))
def audit_totals(lines: DataFrame) -> DataFrame:
    """Rows and revenue of a report as they were seen while it was staged."""
    spark = lines.sparkSession
    report = read_report(spark, f"{write_reports(lines, schemas.SALES)}/report=*", schemas.SALES)
    found = stage_table(report, f"audit_{uuid.uuid4().hex}", totals={"total_payment": F.sum(cents("total_payment"))}, keep_empty=True)
    return spark.createDataFrame([(found["n_rows"], found["total_payment"])], "n_lines long, total_payment decimal(28,2)")


UPSERTED = """, ranked AS (
 SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT user_id, event_type, event_id, CASE event_type WHEN 'purchase' THEN value + 1 ELSE value END AS value,
 strftime(ts, '%Y-%m') AS month FROM ranked WHERE rn = 1"""


@query("upsert_rerun", UPSERTED, ("events",))
def upsert_rerun(events: DataFrame) -> DataFrame:
    """A table kept by month: a first load, a drop of updates, and the same drop again."""
    spark, table = events.sparkSession, f"events_{uuid.uuid4().hex}"
    events = events.select("user_id", "event_type", "ts", "value", "event_id")
    bought = F.col("event_type") == "purchase"
    updates = events.filter(bought).withColumn("value", F.col("value") + 1)
    for drop in (events.filter(~bought), updates, updates):
        upsert_parts(spark, table, drop, ["user_id"], ["ts", "event_id"], part=part_of("ts"))
    return spark.table(f"stg.{table}").select("user_id", "event_type", "event_id", "value", F.date_format("ts", "yyyy-MM").alias("month"))


@query("year_boundary", f"""{S.head_ledger('sales_lines')}
SELECT CAST(year(CAST(posting_date AS DATE)) AS INTEGER) AS posting_year, closing_month, count(*) AS n_rows,
 CAST(sum(CAST(net_revenue AS DECIMAL(18,2))) AS DOUBLE) AS net_revenue
FROM head WHERE closing_year = 1998 GROUP BY ALL""", ("sales_lines", "staff"))
def year_boundary(lines: DataFrame, staff: DataFrame) -> DataFrame:
    """A year's rows from the runs of two years: those that a run brought for its neighbour are there."""
    spark, path = lines.sparkSession, drop_folder(lines)
    ledger = L.head_office_ledger(lines, staff_stack(staff), S.HEAD_CALENDAR, DISTRIBUTORS)
    early = F.coalesce(F.col("posting_date") < F.lit("1998-01-01").cast("date"), F.lit(True))
    write_ledger_month(ledger.filter(early), path, 1997, 12)
    write_ledger_month(ledger.filter(~early), path, 1998, 1)
    return jobs.year_rows(spark, path, 1998).groupBy(F.year("posting_date").alias("posting_year"), "closing_month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(cents("net_revenue")).alias("net_revenue")
    )


def write_months(lines: DataFrame) -> str:
    """Clean CSV exports in one folder per posting month."""
    folder = drop_folder(lines)
    day = F.col("posting_date")
    run = F.concat(F.lit("T"), F.substring(day, 4, 2).cast("int"), F.lit("_"), F.substring(day, 7, 4))
    # Rows of a month are spread over tasks; each task writes one file per month it holds.
    (
        lines.select(*[F.col(c).alias(h) for c, h in schemas.SALES.columns.items()], run.alias("run"))
        .write.partitionBy("run")
        .options(header=True, **CSV)
        .csv(folder)
    )
    return folder


@query("year_glob_scan", f"""SELECT right(posting_date, 7) AS posting_month, {TOTALS} FROM sales_lines
WHERE right(posting_date, 4) = '1998' GROUP BY ALL""", ("sales_lines",))
def year_glob_scan(lines: DataFrame) -> DataFrame:
    spark = lines.sparkSession
    year = read_year(spark, write_months(lines), 1998, schemas.SALES, "run=T*_{year}/*")
    return year.groupBy(F.right("posting_date", F.lit(7)).alias("posting_month")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(cents("total_payment")).alias("total_payment")
    )


@query("folder_scan", """SELECT customer_kind, count(*) AS n_rows, 1 AS has_file FROM customers GROUP BY ALL""",
       ("customers",))
def folder_scan(customers: DataFrame) -> DataFrame:
    folder = drop_folder(customers)
    headers = [F.col(c).alias(h) for c, h in schemas.FIELD_CUSTOMERS.columns.items()]
    customers.select(headers).write.options(header=True, **CSV).csv(folder)
    rows = read_folder(customers.sparkSession, folder, schemas.FIELD_CUSTOMERS, ["customer_kind"])
    return rows.groupBy("customer_kind").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max(F.col("department").endswith(".csv").cast("int")).alias("has_file"),
    )
