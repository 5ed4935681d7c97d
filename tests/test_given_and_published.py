"""Tables handed in, tables published and opened again, and checks that notice planted faults."""

import copy
import dataclasses

import pytest
from pyspark.sql import functions as F

from ledgerloom.config import Params
from ledgerloom.functions import text as tx
from ledgerloom.functions.finance import outstanding
from ledgerloom.operators import actions, documents, loan_book, ranking
from ledgerloom.plans import catalog, quality, reports
from ledgerloom.plans.portfolio import PUBLISHED, Portfolio

SF_DIR = "/root/testdata/sf0.001"
APP_QUERIES = [
    "vq_asset_class_counts", "portfolio_kpis", "vq_flight_risk_topk", "vq_deteriorating", "vq_pending_collections",
    "vq_npa_upgrade", "borrower_lookup", "borrower_detail", "borrower_pending", "borrower_rec_history", "action_queue",
    "action_queue_collections", "demo_contrast", "semantic_cross_entity",
]


@pytest.fixture(scope="module")
def pf(spark):
    built = Portfolio(spark, SF_DIR)
    built.publish()
    return built


def rows(df):
    return sorted(str(r) for r in df.collect())


def test_handed_in_tables_replace_the_drawn_ones(spark, pf, tmp_path):
    loans = pf.loans.filter(F.substring("borrower_id", -1, 1).isin("1", "2")).withColumn("current_dpd", F.lit(95).cast("bigint"))
    loans.write.parquet(f"{tmp_path}/loans")
    borrowers = pf.borrowers.join(loans.select("borrower_id").distinct(), "borrower_id", "left_semi")
    own = Portfolio(spark, SF_DIR, given={"loan_account": f"{tmp_path}/loans", "borrower": borrowers, "mandate": pf.mandates,
                                          "bureau_tradeline": pf.tradelines, "call_transcript": pf.calls})
    assert own.state.count() == borrowers.count()
    assert own.state.filter("borrower_asset_class <> 'NPA'").count() == 0
    assert own.recs.join(loans, "loan_id", "left_anti").filter("loan_id IS NOT NULL").count() == 0
    assert own.customer_360.count() == borrowers.count()
    with pytest.raises(ValueError):
        Portfolio(spark, SF_DIR, given={"loans": borrowers})


def test_published_tables_answer_in_a_later_session_without_a_rebuild(spark, pf, monkeypatch):
    later = Portfolio.open(spark.newSession(), pf.folder, SF_DIR)
    before = {n: rows(catalog.QUERIES[n](pf)) for n in APP_QUERIES}
    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.parquet", lambda *a, **k: pytest.fail("a table was written"))
    for name in APP_QUERIES:
        assert rows(catalog.QUERIES[name](later)) == before[name], name


def test_opened_tables_have_the_schemas_that_would_be_built(spark, pf, monkeypatch):
    later = Portfolio.open(spark, pf.folder, SF_DIR)
    assert {n: getattr(later, a).schema for n, a in PUBLISHED.items()} == {n: getattr(pf, a).schema for n, a in PUBLISHED.items()}
    again = Portfolio.open(spark, pf.folder, SF_DIR)
    for behind in ("borrowers", "tradelines", "calls", "candidates", "customer_360"):
        monkeypatch.setattr(Portfolio, behind, property(lambda self: pytest.fail("a table was built")))
    for name in set(APP_QUERIES):
        catalog.QUERIES[name](again)


def test_a_lookup_is_pushed_to_sorted_files(pf):
    found = reports.borrower_pending(pf.recs, "BRW000002")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(borrower_id,BRW000002)" in plan and "Exchange" not in plan
    spans = pf.published_360.groupBy(F.input_file_name().alias("f")).agg(F.min("borrower_id").alias("a"), F.max("borrower_id").alias("b"))
    spans = sorted((r.a, r.b) for r in spans.collect())
    assert all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_other_parameters_and_unfinished_folders_are_refused(spark, pf, tmp_path):
    with pytest.raises(ValueError, match="params"):
        Portfolio.open(spark, pf.folder, SF_DIR, dataclasses.replace(Params(), loss_share=Params().loss_share / 2))
    with pytest.raises(ValueError, match="inputs"):
        Portfolio.open(spark, pf.folder, "/root/testdata/sf0.01")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        Portfolio.open(spark, str(tmp_path), SF_DIR)


def test_tasks_are_kept_and_inserted(pf):
    tasks, queue = catalog.QUERIES["team_tasks"](pf), catalog.half_queue(pf)
    kept = tasks.join(queue.select("task_id"), "task_id", "left_semi").count()
    assert kept == queue.count() > 0 and tasks.count() > kept
    assert tasks.select("recommendation_id").distinct().count() == tasks.count()


def test_a_stopped_run_is_finished_for_recommendations_that_are_gone(pf):
    queue = catalog.earlier_queue(pf)
    lost = queue.join(catalog.half_queue(pf).select("task_id"), "task_id", "left_anti").orderBy("task_id").first()
    own = copy.copy(pf)
    own.recs = pf.recs.filter(F.col("recommendation_id") != lost.recommendation_id)
    tasks = catalog.QUERIES["team_tasks"](own)
    assert queue.join(tasks.select("task_id"), "task_id", "left_anti").count() == 0
    assert tasks.select("task_id").distinct().count() == tasks.count()


def test_mandate_numbers_step_over_the_demo_ones(spark, pf, tmp_path):
    p = dataclasses.replace(Params(), demo_mandate_from=20)
    ranking.cut_by_range(loan_book.mandated_loans(pf.loans), "loan_id").write.parquet(f"{tmp_path}/cut")
    made = loan_book.build_mandate(pf.loans, p, spark.read.parquet(f"{tmp_path}/cut"))
    assert made.count() == pf.mandates.count() > 25
    assert made.select("mandate_id").distinct().count() == made.count()


def test_assertions_notice_planted_faults(spark, pf):
    def counts(recs, log, base):
        found = quality.standing_assertions(recs, log, pf.state, pf.loan_economics, pf.loans, base)
        return {r.assertion: r.violation_count for r in found.collect() if r.violation_count}

    base = quality.baseline(pf.recs)
    assert counts(pf.recs, pf.log, base) == {}
    one = pf.recs.filter("loan_id IS NOT NULL").orderBy("recommendation_id").first()
    hit = F.col("recommendation_id") == one.recommendation_id
    assert counts(pf.recs, pf.log.filter(~hit), base) == {quality.A4[0]: 1}
    moved = pf.recs.withColumn("action_code", F.when(hit, "OTHER").otherwise(F.col("action_code")))
    assert counts(moved, pf.log, base) == {quality.A5[0]: 1}
    assert {r.found_in: r.times for r in quality.run_difference(base, moved).collect()} == {"first": 1, "second": 1}
    assert counts(pf.recs.withColumn("rule_basis", F.when(~hit, F.col("rule_basis"))), pf.log, base)[quality.A2[0]] == 1


def test_rules_counted_while_writing_stop_the_publication(spark, pf, tmp_path):
    loans = pf.loans.withColumn("rate_type", F.when(F.col("loan_id").endswith("3"), "ODD").otherwise(F.col("rate_type")))
    loans = loans.withColumn("product_code", F.when(~F.col("loan_id").endswith("4"), F.col("product_code")))
    own = Portfolio(spark, SF_DIR, folder=str(tmp_path / "own"), given={"loan_account": loans})
    with pytest.raises(ValueError, match="loan_account breaks its rules.*allowed rate_type"):
        own.publish()
    faults = own.written_faults("loan_account")
    assert faults["rows"] == loans.count() and faults["allowed rate_type"] == loans.filter("rate_type = 'ODD'").count() > 0
    assert faults["required product_code"] == loans.filter("product_code IS NULL").count() > 0
    assert faults["required borrower_id"] == faults["unpaid within elapsed"] == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        Portfolio.open(spark, own.folder, SF_DIR, given={"loan_account": loans})
    assert own.written_faults("borrower_slices") == {} and own.written_faults("mandate") == {}


def test_rules_of_an_empty_table(spark, pf, tmp_path):
    own = Portfolio(spark, SF_DIR, folder=str(tmp_path / "none"), given={"loan_account": pf.loans.limit(0)})
    assert own.loans.count() == 0 and set(own.written_faults("loan_account").values()) == {0}


def test_contracts_notice_planted_faults(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "z")], "id int, kind string")
    got = {r["check"]: r.violation_count for r in quality.contract(df, "t", ["id"], ["kind"], {"kind": ["a"]}).collect()}
    assert got == {"unique id": 1, "required kind": 1, "allowed kind": 1}


def test_missing_terms_odd_lines_and_unreadable_reasons(spark):
    terms = spark.createDataFrame([(None, 10.0, 100, 3), (1000, None, 100, 3), (1000, 10.0, 2000, 3)], "p bigint, r double, e bigint, m bigint")
    assert [r.o for r in terms.select(outstanding("p", "r", "e", "m").alias("o")).collect()] == [None, None, 0]
    text = "01-Jul-2026 Opening only\n02-Jul-2026  Fee  10  0\n03-Jul-2026  Pay  0  1,500  9,990\n04-Jul-2026  Odd  x  0\nother"
    papers = spark.createDataFrame([("B", "BANK_STATEMENT", text)], "borrower_id string, doc_type string, text string")
    lines = [(r.line_no, r.debit_inr, r.credit_inr, r.balance_inr) for r in documents.statement_lines(papers).collect()]
    assert lines == [(1, 10, 0, None), (2, 0, 1500, 9990)]
    assert [r.line_no for r in documents.statement_rejects(papers).collect()] == [0, 3]
    told = spark.createDataFrame([("व्यापार धीमा", "नौकरी गई"), ("job lost", "job lost")], "a string, b string")
    got = told.select(tx.reasons_differ("a", "b", tx.reason_words("a"), tx.reason_words("b")).alias("c")).collect()
    assert [r.c for r in got] == [None, False]


def test_the_latest_of_two_carried_decisions_wins(spark, pf):
    recs, log = pf.recs.limit(3), pf.log
    one = recs.orderBy("recommendation_id").first().recommendation_id
    own = log.filter(F.col("recommendation_id") == one)

    def decided(word, day):
        return own.withColumns({"human_decision": F.lit(word), "decided_by": F.lit("r"), "decided_at": F.lit(f"2024-01-{day} 00:00:00").cast("timestamp_ntz")})

    old = decided("REJECTED", "02").unionByName(decided("APPROVED", "03")).unionByName(decided("REJECTED", "01"))
    carried, new_log = actions.carry_decision(recs, own, old)
    assert carried.filter(F.col("recommendation_id") == one).first().status == "APPROVED"
    assert new_log.count() == 1 and new_log.first().human_decision == "APPROVED"
    by_key, _ = actions.carry_decision_by_key(recs, own, recs, old)
    assert rows(by_key) == rows(carried)
