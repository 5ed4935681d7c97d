"""Physical plans: no cross join, no Python worker, no whole table in one task."""

import re

import pytest

from ledgerloom.plans.catalog import QUERIES
from ledgerloom.plans.portfolio import Portfolio
from ledgerloom.sources import entities

FORBIDDEN = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin|EvalPython|InPandas|InArrow|collect_list|collect_set")
# Queries that end in a sort, a limit or a total may gather their few result rows.
ROW_LEVEL = [
    "loan_account", "mandates", "amortization", "ltv", "borrower_state", "loan_economics", "transcript_insight",
    "call_transitions", "call_pairs_lag", "trajectory", "nba_recommendations", "decision_log", "customer_360",
    "carry_rationale", "carry_decision", "carry_decision_log", "apply_decisions", "team_tasks", "queue_purged",
    "document_scan", "document_fields", "income_corroboration", "semantic_cross_entity",
]


@pytest.fixture(scope="module")
def pf(spark):
    return Portfolio(spark, "/root/testdata/sf0.001")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join_and_no_python(pf, name):
    assert not FORBIDDEN.search(plan(QUERIES[name](pf)))


@pytest.mark.parametrize("name", ROW_LEVEL)
def test_rows_are_never_gathered(pf, name):
    text = plan(QUERIES[name](pf))
    for chunk in text.split("Exchange SinglePartition")[1:]:
        # The one gathered input allowed is a ranking's slice totals, one row per slice.
        assert "HashAggregate(keys=[_slice" in chunk[:600], name


def test_scans_read_only_what_they_need(pf):
    text = plan(pf.tradelines.filter("tradeline_status = 'ACTIVE'").select("borrower_id", "current_balance_inr"))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_totalprice:double>" in text
    events = plan(entities.call_events(pf.spark, pf.sf_dir).select("interaction_id"))
    assert "PushedFilters" in text and "EqualTo(event_type,error)" in events


def test_lifetime_value_sends_neither_loans_nor_schedule_through_the_driver(pf):
    assert "BroadcastExchange" not in plan(QUERIES["ltv"](pf))


@pytest.mark.parametrize("name", ["customer_360", "carry_decision_log", "team_tasks", "semantic_cross_entity"])
def test_tables_that_grow_are_not_sent_through_the_driver(pf, name):
    assert "BroadcastExchange" not in plan(QUERIES[name](pf))
