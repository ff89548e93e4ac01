from __future__ import annotations

import glob
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from branchledger.functions.local import config_table
from branchledger.operators import checks
from branchledger.operators.consolidate import Platform, consolidate
from branchledger.operators.latest import latest_per_key, replace_groups, upsert
from branchledger.operators.lookup import any_of_names, drop_codes, duplicate_keys, lookup_join
from branchledger.operators.margins import counts_by_case_with_total, counts_with_total
from branchledger.operators.scoring import cut_rows, quintile_scores
from branchledger.operators.skew import heavy_keys, hot_keys, rows_per_key, salted_left_joins, skewed_lookup_join, spread_nulls
from branchledger.operators.stack import aligned_sums, stack, stack_tagged
from branchledger.operators.steps import passing_step, stepped


def test_lookup_join_never_adds_rows(frame, rows):
    fact = frame("name string, dept string, n int", ("a", "x", 1), ("a", "x", 2), ("b", "x", 3), (None, "x", 4), ("a", None, 5))
    staff = frame("employee_name string, dept string, employee_code string",
                  ("a", "x", "2"), ("a", "x", "1"), (None, "x", "9"), ("a", None, "8"), ("a", "y", "7"))
    for spread_by in ([], ["n"]):
        got = lookup_join(fact, staff, {"name": "employee_name", "dept": "dept"}, ["employee_code"], spread_by)
        assert rows(got.select("n", "employee_code")) == [(1, "1"), (2, "1"), (3, None), (4, None), (5, None)]
    assert rows(duplicate_keys(staff, ["employee_name", "dept"])) == [("a", "x", 2)]


def test_drop_codes_keeps_null(frame, rows):
    df = frame("code string", ("1",), ("2",), (None,))
    assert rows(drop_codes(df, "code", ["2"])) == [("1",), (None,)]
    assert drop_codes(df, "code", []).count() == 3


def test_any_of_names(frame, rows):
    dim = frame("a string, b string, code string", ("x", "y", "2"), ("y", None, "1"), (None, None, "0"))
    assert rows(any_of_names(dim, ["a", "b"], "code").dropna()) == [("x", "2"), ("y", "1")]


ACCOUNTS = "dept string, owner string, status string, code string"


def accounts(frame):
    return frame(ACCOUNTS, ("d", "a", "p", "1"), ("d", "a", "p", "2"), ("d", "b", "p", None), ("d", "a", "q", "3"),
                 (None, "a", "p", "4"), ("d", None, "p", "5"), ("e", "c", "q", "6"))


def test_counts_with_total(frame, rows):
    got = rows(counts_with_total(accounts(frame).filter("status = 'p'"), ["dept", "owner"], "code", "n"))
    assert got == [("TOTAL", "", 2), ("d", "a", 2), ("d", "b", 0)]


def test_counts_with_total_on_empty_input(frame, rows):
    empty = accounts(frame).filter("status = 'none'")
    assert rows(counts_with_total(empty, ["dept", "owner"], "code", "n")) == [("TOTAL", "", 0)]


def test_counts_by_case_equal_one_count_per_case(frame, rows):
    df = accounts(frame)
    cases = {s: F.col("status") == s for s in ("p", "q", "none")}
    both = counts_by_case_with_total(df, ["dept", "owner"], "code", cases, "case", "n")
    for name in cases:
        one = counts_with_total(df.filter(cases[name]), ["dept", "owner"], "code", "n")
        assert rows(both.filter(F.col("case") == name).select("dept", "owner", "n")) == rows(one)


def test_total_is_counted_in_the_same_pass(frame):
    df = accounts(frame).repartition(4)
    plan = counts_with_total(df, ["dept", "owner"], "code", "n")
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in text


def test_consolidate(frame, rows):
    one = frame("code string, x string, y string", (" ab 1", "1", None), ("AB1", "2", "p"), ("Z", None, None), (None, "7", "7"))
    two = frame("key string, x string", ("ab1", "9"), ("W", "w"))
    got = consolidate({"S1": Platform(one, "code", ["x", "y"]), "A2": Platform(two, "key", ["x"])}, "code")
    assert rows(got.select("code", "S1__x", "S1__y", "A2__x", "platforms")) == [
        ("AB1", "2", "p", "9", "A2, S1"), ("W", None, None, "w", "A2"), ("Z", None, None, None, "S1"),
    ]


def test_latest_and_upsert(frame, rows):
    old = frame("k string, t int, x string", ("a", 1, "old"), ("b", 5, "keep"), ("c", None, "n"))
    new = frame("k string, t int, x string", ("a", 2, "new"), ("b", 4, "late"), ("d", 1, "add"), ("c", 1, "set"))
    assert rows(upsert(old, new, ["k"], ["t"])) == [("a", 2, "new"), ("b", 5, "keep"), ("c", 1, "set"), ("d", 1, "add")]
    assert rows(upsert(old, old.withColumn("x", F.lit("again")), ["k"], ["t"]).select("x").distinct()) == [("again",)]
    assert rows(latest_per_key(old.limit(0), ["k"], ["t"])) == []


def test_quintiles_are_exact_tiles(spark):
    rng = random.Random(3)
    data = [(i, rng.choice([7, None, rng.randint(-50, 50), 123000 + rng.randint(0, 999)]), rng.randint(0, 9)) for i in range(503)]
    df = spark.createDataFrame(data, "id int, m bigint, r bigint")
    got = {x.id: (x.m_score, x.r_score) for x in quintile_scores(df, {"m": "asc", "r": "desc"}, "id").collect()}

    def tiles(ordered):
        sizes = [503 // 5 + (i < 503 % 5) for i in range(5)]
        return dict(zip(ordered, [t + 1 for t, n in enumerate(sizes) for _ in range(n)]))

    by_m = tiles([i for i, *_ in sorted(data, key=lambda x: (x[1] is not None, x[1] or 0, x[0]))])
    by_r = tiles([i for i, *_ in sorted(data, key=lambda x: (-x[2], x[0]))])
    assert got == {i: (by_m[i], by_r[i]) for i, *_ in data}


@pytest.mark.parametrize("most", [1, 7, 5000])
def test_cut_rows_by_rounds_of_counts(spark, most):
    """Brackets down to a single row: values far apart, one value that most rows share, null values."""
    rng = random.Random(most)
    data = [(f"k{i * 7919 % 1000:03}", rng.choice([7, 7, 7, rng.randint(-(10**15), 10**15)]), rng.randint(0, 3)) for i in range(800)]
    df = spark.createDataFrame(data, "id string, m bigint, r bigint")
    ranks = [0, 1, 160, 399, 400, 799]
    got = cut_rows(df, {"m": F.col("m"), "r": -F.col("r")}, "id", ranks, most)
    by_m, by_r = sorted((m, i) for i, m, _ in data), sorted((-r, i) for i, _, r in data)
    assert got == {"m": [by_m[k] for k in ranks], "r": [by_r[k] for k in ranks]}


def test_scores_of_few_rows(spark):
    for n in (0, 1, 3, 5, 6):
        df = spark.range(n).select(F.col("id").cast("string").alias("k"), F.lit(None).cast("bigint").alias("m"))
        got = [r.m_score for r in quintile_scores(df, {"m": "desc"}, "k").orderBy("k").collect()]
        assert got == [r.t for r in df.selectExpr("ntile(5) over (order by k) t").orderBy("t").collect()]


def test_upsert_keeps_rows_without_a_key_and_may_be_rerun(frame, rows):
    schema = "k string, t int, x string"
    old = frame(schema, ("a", 1, "old"), (None, 1, "p"), (None, 2, "q"))
    new = frame(schema, ("a", 2, "new"), ("a", 1, "older"), (None, 2, "q"), (None, 2, "q"), (None, 3, "r"))
    once = upsert(old, new, ["k"], ["t"])
    want = [("a", 2, "new"), (None, 1, "p"), (None, 2, "q"), (None, 2, "q"), (None, 3, "r")]
    assert rows(once) == sorted(want, key=repr) == rows(upsert(once, new, ["k"], ["t"]))


def test_replace_groups_keeps_every_line(frame, rows):
    schema = "doc string, qty int"
    old = frame(schema, ("d1", 1), ("d1", 1), ("d2", 5), (None, 9))
    new = frame(schema, ("d1", 3), ("d1", 3), (None, 9), (None, 4))
    once = replace_groups(old, new, ["doc"])
    want = [("d1", 3), ("d1", 3), ("d2", 5), (None, 9), (None, 4)]
    assert rows(once) == sorted(want, key=repr) == rows(replace_groups(once, new, ["doc"]))


@pytest.mark.parametrize("hot_rows", [20, 10**6])
def test_salted_joins_equal_plain_joins(spark, hot_rows):
    rng = random.Random(5)
    codes = ["hot"] * 200 + [f"k{i % 40}" for i in range(300)] + [None] * 100
    left = spark.createDataFrame([(c, i) for i, c in enumerate(codes)], "code string, i int")
    right = spark.createDataFrame([(f"k{rng.randint(0, 60)}", f"r{i}") for i in range(50)] + [("hot", "h1"), ("hot", "h2"), (None, "n")],
                                  "code string, r string")
    other = spark.createDataFrame([("hot", 1), ("k3", 2), ("k3", 3)], "code string, z int")
    hot = hot_keys(rows_per_key(left, ["code"]), ["code"], hot_rows)
    got = salted_left_joins(left, [right, other], ["code"], ["i"], hot)
    want = left.join(right, "code", "left").join(other, "code", "left")
    assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))


def test_salted_join_on_two_keys(spark):
    left = spark.createDataFrame([("a", "x", i) for i in range(30)] + [("a", None, 90), (None, "x", 91), ("b", "y", 92)],
                                 "k string, g string, i int")
    right = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("b", "y", 3), ("a", None, 4), (None, "x", 5)],
                                  "k string, g string, r int")
    hot = hot_keys(rows_per_key(left, ["k", "g"]), ["k", "g"], 4)
    got = salted_left_joins(left, [right], ["k", "g"], ["i"], hot)
    want = left.join(right, ["k", "g"], "left")
    assert hot.first()["__parts"] == 8
    assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))


def test_hot_rows_spread_over_partitions(spark):
    left = spark.range(4000).select(F.when(F.col("id") < 3000, "hot").otherwise(F.col("id").cast("string")).alias("code"), "id")
    right = spark.createDataFrame([("hot", 1)], "code string, r int")
    hot = hot_keys(rows_per_key(left, ["code"]), ["code"], 50)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = salted_left_joins(left, [right], ["code"], ["id"], hot)
        sizes = [r.n for r in got.filter("r = 1").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 3000 and len(sizes) == 4 and max(sizes) < 1500


def test_sketch_finds_the_keys_that_counting_finds(spark):
    left = spark.range(9000).select(
        F.when(F.col("id") < 4000, "hot").when(F.col("id") < 5000, "warm").when(F.col("id") > 6000, (F.col("id") % 900).cast("string")).alias("k"),
        (F.col("id") % 2).alias("g"), "id",
    )
    for keys in (["k"], ["k", "g"]):
        exact = hot_keys(rows_per_key(left.dropna(), keys), keys, 300)
        assert sorted(map(tuple, heavy_keys(left, keys, 300).collect())) == sorted(map(tuple, exact.collect()))
    assert heavy_keys(left.limit(0), ["k"]).collect() == []


def test_small_lookup_is_broadcast_once_and_not_copied(spark):
    left = spark.range(1000).select((F.col("id") % 7).cast("string").alias("k"), "id")
    right = config_table(spark, [(str(i), i) for i in range(5)], "k string, r int")
    want = sorted(map(tuple, left.join(right, "k", "left").collect()))
    small = skewed_lookup_join(left, right, ["k"], ["id"])
    text = small._jdf.queryExecution().executedPlan().toString()
    assert text.count("BroadcastExchange") == 1 and "Generate" not in text and "SortMergeJoin" not in text
    assert sorted(map(tuple, small.collect())) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = skewed_lookup_join(left, right, ["k"], ["id"], hot_rows=100)
        assert sorted(map(tuple, large.select("k", "id", "r").collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_spread_nulls_matches_nothing(frame, rows):
    left = frame("k string, i int", ("a", 1), (None, 2))
    right = frame("k2 string, r string", ("a", "x"), (None, "y"))
    got = left.join(right, spread_nulls(F.col("k"), F.col("i")) == F.col("k2"), "left")
    assert rows(got.select("i", "r")) == [(1, "x"), (2, None)]


def test_adaptive_execution_splits_a_hot_lookup_key(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        fact = spark.range(60000).repartition(6).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("name"), "id")
        staff = spark.range(60000).select(F.col("id").cast("string").alias("employee_name"), F.col("id").cast("string").alias("employee_code"))
        joined = lookup_join(fact, staff, {"name": "employee_name"}, ["employee_code"], spread_by=["id"])
        assert joined.agg(F.count("employee_code")).first()[0] == 40000
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_stack_widens(frame, rows):
    a, b = frame("x int", (1,)), frame("x int, y string", (2, "b"))
    assert rows(stack([a, b])) == [(1, None), (2, "b")]
    assert rows(stack_tagged({"A": a, "B": b.drop("y")}, "tag")) == [(1, "A"), (2, "B")]


def test_aligned_sums(frame, rows):
    a, b = frame("k string, v int", ("x", 1), ("x", 2)), frame("k string, v int", ("y", 5))
    assert rows(aligned_sums({"a": a, "b": b}, ["k"], "v")) == [("x", 3, None), ("y", None, 5)]


def test_checks(frame):
    ledger = frame("dept string, salesperson string, employee_code string, total_payment double, vat double, net_revenue double",
                   ("d", "a", "1", 11.0, 1.0, 10.0), ("d", "b", None, 5.0, 1.0, 5.0))
    assert checks.net_mismatches(ledger).count() == 1
    totals = checks.control_totals(ledger).first()
    assert (totals.n_rows, totals.n_columns, float(totals.gross_revenue)) == (2, 6, 16.0)
    assert checks.control_totals(ledger.limit(0)).first().n_rows == 0
    assert checks.unresolved_staff(ledger).first().salesperson == "b"


def test_a_step_gives_its_shuffle_files_back(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own = spark.conf.get(key, None)
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def shuffled():
        return {f for top in folders for f in glob.glob(f"{top}/*/shuffle_*")}

    before = shuffled()
    df = spark.range(1000).withColumn("k", F.col("id") % 7).repartition(3, "k")
    read = stepped(df, "step")
    until = time.time() + 20  # the files go in the background
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    assert read.dtypes == df.dtypes and sorted(map(tuple, read.collect())) == [(i, i % 7) for i in range(1000)]
    assert spark.conf.get(key, None) == own
    assert stepped(df.limit(0), "step").collect() == []
    with passing_step(df, "passing") as there:
        kept = stepped(there.filter("k = 1"), "kept")
        folder = there.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
        assert os.path.isdir(folder) and there.count() == 1000
    assert not os.path.exists(folder) and kept.count() == 143
