"""Exact dedup by distributed MSD radix partitioning: equal bytes, no digest decides.

Documents are split by successive bytes of their normalised text, most significant first. The
first digit is the length with the first ``first_digit`` bytes; every further digit holds
``growth`` times more bytes. A group is named by a number given when it is formed. After each
digit a document is done if it is alone in its group or if its text has ended, for then the group
is equal byte by byte; only the others go on, with the bytes not yet compared.

Rounds after the first hold few of the rows; they are written by as many tasks as their rows and
bytes, counted before, call for.

A round counts groups with map-side combine and joins the counts back; a group that holds a third
of all rows is just one row of the counts, and its members' side of the join can be split. The
number of rounds grows with the logarithm of the longest repeated text.

Defined cases: null text counts as empty, and all empty texts are equal; runs of
``[\\x20\\x09-\\x0D]`` count as one space; the smallest id of a group stays, and of rows that share
it one (any, they are equal); a null id loses against any other; rows with equal ids and different
texts are separate documents; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from branchledger.llm.common import let_pass, row_filter, written


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def equal_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    first_digit: int = 64,
    growth: int = 4,
) -> DataFrame:
    """Per row of ``docs``: id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    The digest is an output only. ``kept`` marks one row of each group.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def few(df: DataFrame, rows: int, size: int) -> DataFrame:
        return df.coalesce(min(parts, 1 + rows // 20_000 + size // (16 << 20)))

    body = F.encode(normalised(F.col(text_col)), "utf-8")
    active = docs.select(F.col(id_col).alias("id"), body.alias("rest")).select(
        "id",
        "rest",
        F.sha2("rest", 256).alias("text_sha256"),
        F.octet_length("rest").cast("long").alias("grp"),
    )
    done: list[DataFrame] = []
    digit, round_ = first_digit, 0
    n_docs = n_rows = n_bytes = 0
    while True:
        rows = active.withColumn("digit", F.substring("rest", 1, digit))
        groups = (
            rows.groupBy("grp", "digit")
            .agg(F.count("*").alias("group_size"), F.min("id").alias("keep_id"))
            .where("group_size > 1")
            .withColumn("next", F.monotonically_increasing_id())
        )
        groups = written(few(groups, n_rows, n_bytes) if round_ else groups, f"radix-groups-{round_}")
        near, alone = rows, []
        if not round_:
            # Documents alone in their group, most of them in this round, are not shuffled.
            wanted = spark.sparkContext.broadcast(row_filter(groups, "grp", "digit"))
            near = let_pass(rows, wanted, "grp", "digit")
            alone.append(
                let_pass(rows, wanted, "grp", "digit", keep=False).selectExpr(
                    "id", "text_sha256", "1L group_size", "id keep_id", "cast(null as long) next", "cast(null as binary) rest"
                )
            )
        split = near.join(groups, ["grp", "digit"], "left").select(
            "id",
            "text_sha256",
            F.coalesce("group_size", F.lit(1)).alias("group_size"),
            F.when(F.col("next").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
            "next",
            F.when(
                F.col("next").isNotNull() & (F.octet_length("rest") > digit),
                F.substring("rest", digit + 1, 2**31 - 1),
            ).alias("rest"),
        )
        for part in alone:
            split = split.unionByName(part)
        split = written(few(split, n_rows, n_bytes) if round_ else split, f"radix-{round_}")
        done.append(split.where("rest is null").drop("rest"))
        active = split.where("rest is not null").select("id", "rest", "text_sha256", F.col("next").alias("grp"))
        n, n_rows, n_bytes = split.agg(F.count("*"), F.count("rest"), F.coalesce(F.sum(F.octet_length("rest")), F.lit(0))).first()
        n_docs = n_docs or n
        if not n_rows:
            break
        digit, round_ = digit * growth, round_ + 1
    result = done[0].withColumn("round", F.lit(0))
    for i, part in enumerate(done[1:], 1):
        result = result.unionByName(part.withColumn("round", F.lit(i)))
    return few(_one_kept(result), n_docs, 0).withColumnRenamed("id", id_col)


def _one_kept(rows: DataFrame) -> DataFrame:
    """Mark as kept the rows whose id stays, and only one of them where ids repeat in a group.

    Only the candidates for staying are numbered, one row a group unless a row is repeated.
    """
    stays = F.col("id").eqNullSafe(F.col("keep_id"))
    columns = ["id", "keep_id", "group_size", "kept", "text_sha256"]
    among = stays & (F.col("group_size") > 1)
    first = F.row_number().over(Window.partitionBy("round", "next").orderBy("text_sha256"))
    return (
        rows.where(among).withColumn("kept", first == 1).select(columns)
        .unionByName(rows.where(~among).withColumn("kept", F.col("group_size") == 1).select(columns))
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each class of equal texts.

    Of rows with the same id and the same normalised text one stays.
    """
    spark = docs.sparkSession
    classes = written(equal_classes(docs, id_col, text_col), "radix-classes")
    stay = classes.where("kept").select(F.col(id_col).alias("__id"), F.col("text_sha256").alias("__sha"))
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    own = own.withColumn("id", F.col("row").getField(id_col))
    own = own.withColumn("sha", F.sha2(F.encode(normalised(F.col("row").getField(text_col)), "utf-8"), 256))
    gone = classes.where("group_size > 1")
    # Rows of classes of one stay without a join; the filter spares them the shuffle.
    wanted = spark.sparkContext.broadcast(row_filter(gone, "text_sha256"))
    many, single = let_pass(own, wanted, "sha"), let_pass(own, wanted, "sha", keep=False)
    rows = many.join(stay, F.col("id").eqNullSafe(F.col("__id")) & (F.col("sha") == F.col("__sha")), "left_semi")
    # A repeated row meets its one staying copy more than once.
    repeated = gone.groupBy(id_col, "text_sha256").count().where("count > 1")
    if not repeated.isEmpty():
        rows = rows.dropDuplicates(["id", "sha"])
    return rows.unionByName(single).select("row.*")
