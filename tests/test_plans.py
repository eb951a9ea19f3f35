"""Physical plan shape: pushdown, pruning, join types, no cartesian products."""

import tempfile

import pytest
from conftest import SF_SMALL
from micro import micro_df

import __spark_entry__ as entry
from txrisk.operators import explore as ex
from txrisk.operators import features as feat
from txrisk.operators import quality as q
from txrisk.plans.riskrun import RiskRun, country_rule_run


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tx_parquet(spark):
    path = tempfile.mkdtemp(prefix="txrisk-pq-") + "/tx"
    micro_df(spark).write.parquet(path)
    return spark.read.parquet(path)


def test_filters_reach_the_scan(tx_parquet):
    plan = _plan(q.customer_history(tx_parquet, 0, order=False))
    assert "PushedFilters: [IsNotNull(CustomerID), EqualTo(CustomerID,0)]" in plan
    plan = _plan(q.amount_lookup(tx_parquet, (-338, -37)))
    assert "In(TransactionAmount, [-338,-37])" in plan


def test_scans_read_only_needed_columns(tx_parquet):
    assert "ReadSchema: struct<TransactionAmount:int>" in _plan(q.import_completeness(tx_parquet))
    plan = _plan(feat.sign_thresholds(tx_parquet.where("TransactionAmount > 0")))
    assert "ReadSchema: struct<CustomerID:int,TransactionSign:string,TransactionAmount:int>" in plan


def test_in_subquery_filters_the_facts_at_the_scan(tx_parquet):
    plan = _plan(ex.customers_with_country(tx_parquet, ["RO"], order=False))
    assert "BroadcastHashJoin" in plan and "getbit" in plan and "Exchange hashpartitioning" not in plan


def test_sorted_results_carry_no_row_id(tx_parquet):
    for df in (ex.customers_with_country(tx_parquet, ["RO"]), q.customer_history(tx_parquet, 0), RiskRun(tx_parquet).outliers()):
        plan = _plan(df)
        assert "rangepartitioning" in plan and "monotonically_increasing_id" not in plan


def test_skew_and_median_read_one_kept_histogram(tx_parquet):
    assert not _reads_facts(q.amount_skew(tx_parquet), tx_parquet)


def _reads_facts(df, tx) -> bool:
    return bool(set(df.inputFiles()) & set(tx.inputFiles()))


def test_alert_rows_join_the_facts_once_and_inner(tx_parquet):
    run = RiskRun(tx_parquet)
    alerts = feat.alert_rows(tx_parquet, feat.reached_bounds(run.profile))
    plan = _plan(alerts)
    assert "Inner" in plan and "LeftOuter" not in plan
    assert _reads_facts(alerts, tx_parquet) and plan.count("FileScan parquet") == 2  # facts and profile


def test_rating_outliers_and_top_list_read_kept_tables_only(tx_parquet):
    run = RiskRun(tx_parquet)
    assert run.alert_rows is not None  # kept from here on
    for df in (run.rating, run.outliers(order=False), run.top_outliers(), run.alerts):
        plan = _plan(df)
        assert not _reads_facts(df, tx_parquet) and "FileScan parquet" in plan
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_kept_profile_is_pruned(tx_parquet):
    plan = _plan(RiskRun(tx_parquet).thresholds)
    assert "ReadSchema: struct<CustomerID:int,TransactionSign:string,n_rows:bigint,s_amt:bigint,q_amt:decimal(30,0)>" in plan


def test_country_rule_rates_only_the_customers_concerned(tx_parquet):
    run = country_rule_run(tx_parquet)
    concerned = {r[0] for r in run.incoming.select("CustomerID").collect()}
    assert {r[0] for r in run.profile.select("CustomerID").collect()} == concerned == {9, 10}
    plan = _plan(run.incoming)
    facts = [line for line in plan.splitlines() if "FileScan" in line and "GreaterThan(TransactionAmount,0)" in line]
    assert len(facts) == (1 if run.hot is None else 2)  # the alert pass alone, split where a group is hot


def test_the_report_reads_the_facts_once_for_its_roll_ups(tx_parquet):
    from txrisk.operators.cube import cube_results, profile_of, transaction_cube
    from txrisk.session import materialize

    cube = transaction_cube(tx_parquet)
    assert _plan(cube).count("FileScan parquet") == 1
    kept = materialize(cube)
    run = RiskRun(tx_parquet, profile=materialize(profile_of(kept)))
    for df in (*cube_results(kept).values(), run.thresholds, run.features):
        assert not _reads_facts(df, tx_parquet)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_cartesian_products(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
