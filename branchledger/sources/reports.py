"""Report drops (CSV, one file per office or sheet) as DataFrames.

Exports carry title rows above the header and a total row below the data. The header is the
first row of a file that holds every header of the layout, and columns are found in it by name:
their order and number, further columns and blank title rows do not matter, a file without such a
row fails the job. Large files are still read in splits: a row is placed by (byte offset of its
split, running id inside the split). Per file one row of *edges* is aggregated: where the header
is, at which place it has each column, and where the file ends; the data rows look up their file's.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, StringType

from branchledger.functions.local import config_table
from branchledger.operators.skew import within_broadcast
from branchledger.sources.schemas import Layout

FILE, BLOCK, ROW = "__file", "__block", "__row"
TEMP_PREFIX = "~$"
#: A cell behind its comma, in quotes or not; a record of a file whose cells may hold line breaks.
CELL = r',("(?:[^"]++|"")*+"|[^,]*+)'
RECORD = r'(?:[^"\r\n]++|"(?:[^"]++|"")*+")++'
#: Bytes of a file's edges at most, for the decision to broadcast them.
EDGE_BYTES = 1024


def _file_name():
    return F.url_decode(F.col("_metadata.file_name"))


def split_cells(line: Column) -> Column:
    """The cells of a line, as many as it has: blank ones null, quotes taken off."""
    quoted = F.transform(
        F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(CELL), F.lit(1)),
        lambda x: F.when(x.startswith('"'), F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(F.nullif(x, F.lit(""))),
    )
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, ",", -1))


def read_report(
    spark: SparkSession,
    path: str | Sequence[str],
    layout: Layout,
    file_column: str | None = None,
    multiline: bool = False,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """Data rows of every report under ``path``, or of the file names in ``only``.

    ``multiline`` is for exports whose quoted cells hold line breaks; such files are not
    splittable, so each is read by one task. The header must lie in the first split of a file.
    A cell of a number column that is neither blank nor a number fails the job.
    """
    reader = spark.read
    if only is not None:
        reader = reader.option("pathGlobFilter", "{" + ",".join(only) + "}")
    read = reader.text(path, wholetext=multiline)
    line: Column = F.col("value")
    if multiline:
        line = F.explode(F.regexp_extract_all("value", F.lit(RECORD), F.lit(0)))
    raw = (
        read.select(
            line.alias("__line"),
            F.col("_metadata.file_path").alias(FILE),
            _file_name().alias("__name"),
            F.col("_metadata.file_block_start").alias(BLOCK),
        )
        .filter(~F.col("__name").startswith(TEMP_PREFIX) & (F.col("__line") != ""))
        # Beside the running id no filter is pushed below, which would cut a line up again.
        .withColumns({ROW: F.monotonically_increasing_id(), "__cells": split_cells(F.col("__line"))})
    )
    wanted = list(dict.fromkeys(layout.columns.values()))
    # The header's words are looked for in the plain line before any cell is cut out of one.
    likely = reduce(and_, [F.contains("__line", F.lit(h)) for h in wanted if '"' not in h], F.lit(True))
    trimmed = F.transform(split_cells(F.col("__line")), lambda x: F.trim(F.translate(x, "\ufeff", "")))
    places = F.transform(F.array(*[F.lit(h) for h in wanted]), lambda h: F.array_position(trimmed, h).cast("int"))
    found = F.when(likely, F.when(F.forall(places, lambda x: x > 0), places))
    edges = (
        raw.withColumn("__places", found)
        .groupBy(F.col(FILE).alias("__edge_file"))
        .agg(
            F.min(F.when(F.col("__places").isNotNull(), F.struct(BLOCK, ROW, "__places"))).alias("__header"),
            F.max(F.struct(BLOCK, ROW)).alias("__last"),
        )
    )
    # One row per file: the listing that Spark has made tells how many there are.
    if within_broadcast(spark, len(read.inputFiles()) * EDGE_BYTES):
        edges = F.broadcast(edges)
    placed = raw.join(edges, F.col(FILE) == F.col("__edge_file"))
    header = F.col("__header")
    below = (F.col(BLOCK) > header[BLOCK]) | (
        (F.col(BLOCK) == header[BLOCK]) & (F.col(ROW) > header[ROW] + layout.skip_first)
    )
    if layout.footer:
        below = below & (F.struct(BLOCK, ROW) < F.col("__last"))
    missing = F.concat(F.lit("no row with the headers " + ", ".join(wanted) + " in "), F.col(FILE))
    # Other rows have no places and so no values, in whatever order filters are applied.
    body = placed.filter(F.when(header.isNull(), F.raise_error(missing)).otherwise(below)).withColumn(
        "__at", F.when(below, header["__places"])
    )

    def cell(name: str, kind: DataType) -> Column:
        at = F.col("__at")[wanted.index(layout.columns[name])] - 1
        value = F.nullif(F.get("__cells", at), F.lit(""))
        if isinstance(kind, StringType):
            return value.alias(name)
        number = value.try_cast(kind)
        bad = F.concat(F.lit(f"{layout.columns[name]}: no number: "), value)
        strict = F.when((F.trim(value) != "") & number.isNull(), F.raise_error(bad)).otherwise(number)
        return strict.alias(name)

    typed = [cell(f.name, f.dataType) for f in layout.schema]
    if file_column:
        typed.append(F.col("__name").alias(file_column))
    return body.select(*typed)


def read_sheet(
    spark: SparkSession, path: str | Sequence[str], layout: Layout, file_column: str | None = None
) -> DataFrame:
    """A clean export: nothing but the header and data rows, no footer."""
    return read_report(spark, path, layout._replace(footer=False), file_column)


def drop_last_columns(df: DataFrame, n: int) -> DataFrame:
    return df.select(*df.columns[:-n])


def office_table(spark: SparkSession, offices: Mapping[str, str]) -> DataFrame:
    """(office, file name) rows of the office configuration."""
    return config_table(spark, list(offices.items()), "office string, office_file string")


def read_offices(
    spark: SparkSession,
    folder: str,
    layout: Layout,
    offices: Mapping[str, str],
    office_column: str = "dept",
) -> DataFrame:
    """All configured office files of a folder in one scan, tagged with their office.

    Files outside the configuration are not read; a missing file contributes no rows (see
    ``missing_offices``).
    """
    files = list(offices.values())
    rows = read_report(spark, folder, layout, file_column="__office_file", only=files)
    config = office_table(spark, offices)
    return (
        rows.join(config, F.col("__office_file") == F.col("office_file"))
        .withColumn(office_column, F.col("office"))
        .select(*layout.columns, office_column)
    )


def present_files(spark: SparkSession, folder: str) -> DataFrame:
    """File names under a folder, from a listing (no file content is read)."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    name = F.url_decode(F.element_at(F.split("path", "/"), -1))
    return listing.select(name.alias("office_file")).distinct()


def missing_offices(spark: SparkSession, folder: str, offices: Mapping[str, str]) -> DataFrame:
    """Configured offices without a file in the folder."""
    return office_table(spark, offices).join(
        present_files(spark, folder), "office_file", "left_anti"
    )


def read_year(
    spark: SparkSession,
    base: str,
    year: int,
    layout: Layout,
    pattern: str = "T*_{year}/*Tong_Hop*",
) -> DataFrame:
    """Month summaries ``T<month>_<year>/*Tong_Hop*`` of one year, temp files skipped."""
    path = f"{base}/{pattern.format(year=year)}"
    df = read_sheet(spark, path, layout, file_column="__name")
    return df.filter(~F.col("__name").startswith(TEMP_PREFIX)).drop("__name")


def read_folder(
    spark: SparkSession, folder: str, layout: Layout, columns: Sequence[str] | None = None
) -> DataFrame:
    """Every file of a folder with its name in ``department``; optional column list."""
    df = read_sheet(spark, folder, layout, file_column="department")
    df = df.filter(~F.col("department").startswith(TEMP_PREFIX))
    return df if columns is None else df.select(*columns, "department")


def read_labelled(
    spark: SparkSession, feeds: Mapping[str, tuple[str, Layout]], label_column: str
) -> dict[str, DataFrame]:
    """One frame per feed, tagged with the feed's label: ``{label: (path, layout)}``."""
    return {
        label: read_sheet(spark, path, layout).withColumn(label_column, F.lit(label))
        for label, (path, layout) in feeds.items()
    }
