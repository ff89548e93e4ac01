"""Every registered query against its oracle, and what its plan may not contain."""

from __future__ import annotations

import pytest
from oracle import connect, differences

from branchledger.trial import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for banned in ("CartesianProduct", "NestedLoop", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"):
        assert banned not in plan, banned
    same_columns, extra, missing, n = differences(df, con, ORACLES[name])
    assert same_columns and n > 0
    assert not extra and not missing, (list(extra)[:2], list(missing)[:2])


def plan_of(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(spark, sf_dir):
    plan = plan_of(spark, sf_dir, "upsert_latest")
    assert "props" not in plan
    assert "PushedFilters: [IsNotNull(event_type)" in plan
    assert "l_linestatus" not in plan_of(spark, sf_dir, "ledger_net_by_period")


def test_consolidation_shuffles_once(spark, sf_dir):
    assert plan_of(spark, sf_dir, "employee_dim").count("Exchange hashpartitioning") == 1
    assert plan_of(spark, sf_dir, "product_dim").count("Exchange hashpartitioning") == 1


# --- invariants over the test tables -----------------------------------------------------


def test_ledger_keeps_every_line(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    for name in ("head_office_ledger", "province_ledger", "uid_lookup"):
        assert QUERIES[name](spark, sf_dir).count() == lines


@pytest.mark.parametrize(
    "name, key",
    [("employee_dim", "employee_code"), ("customer_dim", "customer_code"), ("product_dim", "product_code")],
)
def test_dimension_codes_are_unique(spark, sf_dir, name, key):
    dim = QUERIES[name](spark, sf_dir)
    assert dim.count() == dim.select(key).distinct().count()
    assert dim.filter(f"{key} IS NULL").count() == 0


def test_total_rows_equal_their_details(spark, sf_dir):
    for name, by in (("account_status", ["kind", "status"]), ("portfolio", [])):
        df = QUERIES[name](spark, sf_dir)
        sums = df.groupBy(*by).agg(
            {"n_accounts": "sum"}
        ).collect()
        totals = df.filter("dept = 'TOTAL'").select(*by, "n_accounts").collect()
        doubled = {tuple(r[:-1]): r[-1] for r in sums}
        assert len(totals) == len(sums)
        for row in totals:
            assert doubled[tuple(row[:-1])] == 2 * row.n_accounts


def test_net_revenue_is_total_minus_vat(spark, sf_dir):
    from branchledger.operators.checks import net_mismatches

    assert net_mismatches(QUERIES["province_ledger"](spark, sf_dir)).count() == 0
