"""Every query by name: a function from a portfolio to a lazy DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import DEMO_BORROWERS, economic_table, product_table, rate_table
from ledgerloom.functions import text as tx
from ledgerloom.functions.columns import bucket, strict_greatest, strict_least
from ledgerloom.functions.finance import instalment
from ledgerloom.operators import actions, borrower_state, customer360, digests, documents, economics, enrichment
from ledgerloom.operators import loan_book, ranking, reading, reasons, rules, trajectory
from ledgerloom.plans import evaluation, quality, reports, spend
from ledgerloom.plans.portfolio import PUBLISHED, Portfolio, sample_decisions
from ledgerloom.session import work_folder
from ledgerloom.sources import entities
from ledgerloom.sources.tables import merged

Query = Callable[[Portfolio], DataFrame]
QUERIES: dict[str, Query] = {}

SEARCH = "000012"
SHORT_SEARCH = "ra"
DETAIL_BORROWER = "BRW000002"
CALLED_BORROWER = "BRW000000"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- config, constants and buckets -------------------------------------------------
@query
def rates_lookup(pf):
    by_service = pf_usage(pf).groupBy("service_type").agg(
        F.sum("credits_used").cast("decimal(18,6)").alias("credits"), F.count("*").alias("usage_days")
    )
    return by_service.join(rate_table(pf.spark, pf.p), "service_type", "left")


@query
def config_lookup(pf):
    sizes = pf.loans.groupBy("product_code").agg(F.count("*").alias("loans"))
    return product_table(pf.spark, pf.p).join(sizes, "product_code", "left")


@query
def config_pivot(pf):
    one = reports.config_pivot(pf.spark, pf.p)
    cof = one.select("cost_of_funds_blended_pct").scalar()
    gap = one.select("bt_min_rate_gap_pct").scalar()
    return pf.loans.select(
        "loan_id",
        cof.alias("cost_of_funds_pct"),
        (F.col("roi_pct") - cof).cast("decimal(12,4)").alias("spread_pct"),
        (F.col("rate_gap_vs_bank_pct") >= gap).alias("has_gap"),
    )


@query
def hash_bucket(pf):
    return pf.borrowers.select(
        "borrower_id",
        bucket(["borrower_id"], "lc", 100).alias("h_lc"),
        bucket(["borrower_id"], "persona", 100).alias("h_persona"),
        bucket(["borrower_id", "1"], "prod", 100000).alias("h_prod"),
    )


@query
def null_greatest_least(pf):
    gap = F.col("days_since_previous_contact")
    return pf.calls.select(
        "interaction_id",
        strict_greatest(gap, F.lit(2).cast("bigint")).alias("at_least_two"),
        strict_least(gap, F.lit(5).cast("bigint")).alias("at_most_five"),
    )


@query
def json_extract(pf):
    k = F.get_json_object("props", "$.k")
    return pf.base("events").select("event_id", "event_type", k.alias("k_text"), k.try_cast("bigint").alias("k"))


@query
def variant_extract(pf):
    """The events' properties as VARIANT: any JSON is kept with its types, what is no JSON is NULL."""
    props = F.try_parse_json("props")
    return pf.base("events").select(
        "event_id",
        F.try_variant_get(props, "$.k", "bigint").alias("k"),
        (F.col("props").isNotNull() & props.isNull()).alias("is_malformed"),
    )


@query
def contact_window(pf):
    hour = F.hour(F.convert_timezone(F.lit("UTC"), F.lit("Asia/Kolkata"), F.col("ts")))
    return pf.base("events").select(
        "event_id", hour.cast("bigint").alias("ist_hour"), actions.in_contact_window(F.col("ts"), pf.p).alias("in_window")
    )


# --- loan book -------------------------------------------------------------------------
@query
def loan_explode(pf):
    return loan_book.explode_loans(pf.sliced_borrowers, pf.p).select("borrower_id", "seq", "loan_count", "loan_no")


@query
def product_bounds(pf):
    """Bounds with the loans whose draw fell between them."""
    sizes = product_range_join(pf).groupBy("product_code").agg(F.count("*").alias("loans_drawn"))
    return reports.product_bounds(pf.spark, pf.p).join(sizes, "product_code", "left")


@query
def product_range_join(pf):
    drawn = loan_book.with_draws(
        loan_book.explode_loans(pf.sliced_borrowers, pf.p), ["borrower_id", "seq"], {"prod": loan_book.LOAN_DRAWS["prod"]}
    )
    return drawn.select(
        "borrower_id", "seq", "h_prod", loan_book.product_of(F.col("h_prod"), pf.p).alias("product_code")
    )


@query
def score_spread(pf):
    return pf.borrowers.select(
        "borrower_id", "bureau_score_band", loan_book.score_spread("bureau_score_band").alias("score_spread_pct")
    )


@query
def global_rank(pf):
    ranked = ranking.global_row_number(pf.sliced_tradelines, "tradeline_id", "n")
    return ranked.select("tradeline_id", "borrower_id", "n")


@query
def emi(pf):
    return pf.loans.select(
        "loan_id",
        "sanction_amount_inr",
        "roi_pct",
        "tenor_months",
        instalment("sanction_amount_inr", "roi_pct", "tenor_months").alias("emi_amount_inr"),
    )


@query
def outstanding(pf):
    return pf.loans.select("loan_id", "months_elapsed", "outstanding_principal_inr")


@query
def dpd(pf):
    return loan_book.generated_terms(pf.spark, pf.sliced_borrowers, pf.p).select(
        "borrower_id",
        "seq",
        "months_elapsed",
        F.col("_drawn_dpd").alias("drawn_dpd"),
        loan_book.clamped_dpd(F.col("_drawn_dpd"), "months_elapsed").alias("current_dpd"),
    )


@query
def arrears(pf):
    return pf.loans.select("loan_id", "current_dpd", "unpaid_emi_count", "emi_amount_inr", "arrears_amount_inr")


@query
def loan_account(pf):
    return pf.loans_unwritten


@query
def dedupe_first_loan(pf):
    book = loan_book.build_loan_account(pf.spark, pf.sliced_borrowers, pf.p, demo=False)
    return loan_book.keep_first_loan(book, DEMO_BORROWERS).select("loan_id", "borrower_id", "product_code")


@query
def demo_override(pf):
    return pf.loans.select(
        "loan_id", "borrower_id", "product_code", "roi_pct", "tenor_months", "months_elapsed", "emi_amount_inr",
        "outstanding_principal_inr", "current_dpd", "has_nach_mandate",
    )


@query
def mandates(pf):
    return pf.mandates


@query
def sponsor_bank(pf):
    return pf.mandates.groupBy("sponsor_bank").agg(F.count("*").alias("mandates"))


@query
def latest_mandate(pf):
    return rules.latest_mandate(pf.mandates)


@query
def amortization(pf):
    return pf.schedule


@query
def ltv(pf):
    return loan_book.lifetime_value(pf.loans, pf.schedule)


@query
def ltv_from_terms(pf):
    return pf.ltv


# --- borrower state ----------------------------------------------------------------------
@query
def own_book(pf):
    return borrower_state.own_book(pf.loans).drop("performing_loans")


@query
def external_book(pf):
    return borrower_state.external_book(pf.tradelines)


@query
def mandate_failures(pf):
    return borrower_state.mandate_failures(pf.mandates)


@query
def state_left_defaults(pf):
    return pf.state.select("borrower_id", *borrower_state.EXTERNAL_FIGURES, *borrower_state.MANDATE_FIGURES)


@query
def asset_class(pf):
    return pf.state.select("borrower_id", "max_dpd_own", "borrower_asset_class", "is_npa", "npa_upgrade_eligible")


@query
def performing_dragged(pf):
    return pf.state.select("borrower_id", "performing_loans_dragged_to_npa", "arrears_to_clear_for_upgrade_inr")


@query
def loan_stacked(pf):
    threshold = (
        economic_table(pf.spark, pf.p)
        .filter(F.col("param_key") == "loan_stacking_lender_threshold")
        .select("param_value")
        .scalar()
    )
    lenders = borrower_state.external_book(pf.tradelines).select("borrower_id", "external_lender_count")
    total = F.coalesce("external_lender_count", F.lit(0).cast("bigint")) + 1
    return pf.borrowers.join(merged(lenders), "borrower_id", "left").select(
        "borrower_id", total.alias("total_lender_count"), (total >= threshold).alias("is_loan_stacked")
    )


@query
def foir(pf):
    return pf.state.select("borrower_id", "monthly_income_inr", "total_emi_inr", "foir_own_book_pct", "foir_true_pct")


@query
def borrower_state_table(pf):
    return pf.state


QUERIES["borrower_state"] = QUERIES.pop("borrower_state_table")


# --- economics ------------------------------------------------------------------------------
@query
def loan_with_config(pf):
    return economics.with_configuration(pf.spark, pf.loans, pf.p).select(
        "loan_id", "product_code", "target_gnpa_pct", "bt_min_residual", "switching_cost_assumption"
    )


@query
def loan_economics(pf):
    return pf.loan_economics


@query
def bt_flags(pf):
    return pf.loan_economics.select(
        "loan_id", "borrower_max_dpd_own", "rate_gap_vs_bank_pct", "residual_months", "bt_min_residual",
        "bt_is_economically_rational", "bt_recommended_stance",
    )


@query
def bt_rationale(pf):
    return pf.loan_economics.select("loan_id", "bt_rationale")


@query
def bt_summary(pf):
    return economics.bt_summary(pf.scored_loans)


# --- calls ------------------------------------------------------------------------------------
@query
def transcript_insight(pf):
    return pf.insight.drop("raw_extract_full")


@query
def sentiment(pf):
    return pf.calls.select("interaction_id", tx.sentiment("transcript_text").alias("sentiment"))


@query
def intent(pf):
    return pf.calls.select("interaction_id", tx.intent("transcript_text").alias("predicted_intent"))


@query
def credible_hardship(pf):
    return pf.calls.select("interaction_id", tx.credible_hardship("transcript_text").alias("is_credible_hardship"))


@query
def extract_fields(pf):
    return pf.calls.select("interaction_id", tx.extract_struct("transcript_text").alias("x")).select(
        "interaction_id", "x.*"
    )


@query
def backfill_enrich(pf):
    """Insight of calls before the cut-over is taken as stored; later calls are read now."""
    cutover = F.lit("2024-01-15").cast("date")
    legacy = pf.insight.filter(F.col("enriched_at") < cutover)
    return enrichment.backfill(legacy, pf.calls).drop("raw_extract_full")


@query
def call_pairs(pf):
    return trajectory.pair_calls(pf.scored_calls, pf.scored_calls).select(
        "borrower_id", "from_interaction_id", "to_interaction_id", "from_seq", "to_seq"
    )


@query
def call_pairs_lag(pf):
    return trajectory.lag_pairs(pf.scored_calls)


@query
def ptp_flag(pf):
    return pf.transitions.select(
        "to_interaction_id", "ptp_was_made_on_prior_call", "ptp_flagged_missed_on_this_call"
    )


@query
def reason_changed(pf):
    return pf.transitions.select("to_interaction_id", "from_reason", "to_reason", "reason_changed")


@query
def call_transitions(pf):
    return pf.transitions


@query
def first_last_sentiment(pf):
    return trajectory.first_last(pf.scored_calls)


@query
def trajectory_table(pf):
    return pf.trajectory


QUERIES["trajectory"] = QUERIES.pop("trajectory_table")


# --- rules and recommendations --------------------------------------------------------------------
@query
def nba_loan_rules(pf):
    return rules.loan_rules(pf.scored_loans, pf.mandates, pf.trajectory)


@query
def growth_eligible(pf):
    return rules.growth_eligible(pf.state).select("borrower_id", "bureau_score_band")


@query
def nba_growth(pf):
    return rules.growth_rules(pf.state)


@query
def nba_candidates(pf):
    return pf.candidates


@query
def expected_value(pf):
    return pf.recs.select("recommendation_id", "action_code", "margin_impact_bps", "expected_value_inr")


@query
def inputs_snapshot(pf):
    return pf.staged.select("recommendation_id", "inputs_snapshot")


@query
def snapshot_fields(pf):
    """What the rules saw, stored as VARIANT beside the id and read back by path."""
    stored = pf.staged.select("recommendation_id", F.parse_json("inputs_snapshot").alias("inputs"))
    path = f"{work_folder(pf.spark, 'snapshots')}/inputs"
    stored.write.parquet(path)
    inputs = pf.spark.read.schema(stored.schema).parquet(path)

    def field(name, kind):
        return F.try_variant_get("inputs", f"$.{name}", kind).alias(name)

    return inputs.select(
        "recommendation_id",
        field("current_dpd", "bigint"),
        field("arrears_amount_inr", "bigint"),
        field("rate_gap_vs_bank_pct", "decimal(8,3)"),
        field("residual_months", "bigint"),
        field("bt_stance", "string"),
        field("product_code", "string"),
    )


@query
def nba_recommendations(pf):
    return pf.recs


@query
def decision_log(pf):
    return pf.log


@query
def rationale(pf):
    return actions.add_rationale(pf.recs).select("recommendation_id", "action_code", "model_contribution")


# --- state machine -----------------------------------------------------------------------------------
@query
def carry_rationale(pf):
    return actions.carry_rationale(pf.recs, pf.earlier_recs).select("recommendation_id", "model_contribution")


def decided_before(pf):
    return actions.apply_decisions(pf.earlier_recs, pf.earlier_log, pf.decisions)


@query
def carry_decision(pf):
    _, old_log, _ = decided_before(pf)
    recs, _ = actions.carry_decision(pf.recs, pf.log, old_log)
    return recs.select("recommendation_id", "borrower_id", "loan_id", "action_code", "status")


@query
def carry_decision_log(pf):
    _, old_log, _ = decided_before(pf)
    _, log = actions.carry_decision(pf.recs, pf.log, old_log)
    return log.select("recommendation_id", "human_decision", "decided_by", "decided_at")


@query
def apply_decisions(pf):
    recs, _, _ = decided_before(pf)
    return recs.select("recommendation_id", "borrower_id", "action_code", "status")


@query
def apply_decisions_log(pf):
    _, log, _ = decided_before(pf)
    return log.select("recommendation_id", "human_decision", "decided_by", "decided_at")


@query
def apply_decisions_refused(pf):
    _, _, refused = decided_before(pf)
    return refused


def earlier_queue(pf):
    recs, _, _ = decided_before(pf)
    return actions.create_team_tasks(recs, None, pf.p)


def half_queue(pf):
    """The earlier queue as a run that stopped halfway left it."""
    return earlier_queue(pf).filter(bucket(["recommendation_id"], "queued", 2) == 0)


@query
def team_tasks(pf):
    """Tasks of the earlier generation, topped up once the new generation was reviewed too: those there are stay,
    those missing are inserted.  The stopped run is finished first, so an approval whose recommendation the new
    generation no longer makes has its task all the same."""
    old_recs, old_log, _ = decided_before(pf)
    queue = actions.create_team_tasks(old_recs, half_queue(pf), pf.p)
    recs, log = actions.carry_decision(pf.recs, pf.log, old_log)
    recs, _, _ = actions.apply_decisions(recs, log, sample_decisions(recs, pf.p))
    return actions.create_team_tasks(recs, queue, pf.p)


@query
def carry_decision_foreign(pf):
    """Decisions carried by borrower, loan and action, as from tables with other ids."""
    old_recs, old_log, _ = decided_before(pf)
    other = F.concat(F.lit("old-"), "recommendation_id").alias("recommendation_id")
    old_recs = old_recs.select(other, *[c for c in old_recs.columns if c != "recommendation_id"])
    old_log = old_log.select(other, *[c for c in old_log.columns if c != "recommendation_id"])
    recs, _ = actions.carry_decision_by_key(pf.recs, pf.log, old_recs, old_log)
    return recs.select("recommendation_id", "borrower_id", "loan_id", "action_code", "status")


@query
def queue_orphans(pf):
    return actions.orphan_tasks(earlier_queue(pf), pf.recs)


@query
def queue_purged(pf):
    return actions.purge_orphans(earlier_queue(pf), pf.recs)


# --- customer 360 and application queries ----------------------------------------------------------------
@query
def customer_360(pf):
    return pf.customer_360


@query
def nba_summary(pf):
    return customer360.nba_summary(pf.recs)


@query
def vq_asset_class_counts(pf):
    return reports.asset_class_counts(pf.published_360)


@query
def portfolio_kpis(pf):
    return reports.portfolio_kpis(pf.published_360)


@query
def vq_flight_risk_topk(pf):
    return reports.flight_risk_topk(pf.published_360)


@query
def vq_deteriorating(pf):
    return reports.deteriorating(pf.published_360)


@query
def vq_pending_collections(pf):
    return reports.pending_collections(pf.recs)


@query
def vq_npa_upgrade(pf):
    return reports.npa_upgrade_count(pf.published_360)


@query
def borrower_lookup(pf):
    return reports.borrower_search(pf.published_360, pf.name_grams, pf.gram_counts, SEARCH)


@query
def borrower_lookup_scan(pf):
    """A text of fewer than three characters has no postings: the names are scanned."""
    return reports.borrower_search(pf.published_360, pf.name_grams, pf.gram_counts, SHORT_SEARCH)


@query
def borrower_detail(pf):
    return reports.borrower_detail(pf.spark, pf.published_360, DETAIL_BORROWER)


@query
def borrower_pending(pf):
    return reports.borrower_pending(pf.recs, DETAIL_BORROWER)


@query
def borrower_rec_history(pf):
    return reports.borrower_history(pf.recs, DETAIL_BORROWER)


@query
def borrower_calls(pf):
    return reports.borrower_calls(pf.calls, CALLED_BORROWER)


@query
def first_call(pf):
    return reports.first_call(pf.calls)


@query
def action_queue(pf):
    return reports.action_queue(pf.recs)


@query
def action_queue_collections(pf):
    return reports.action_queue(pf.recs, "COLLECTIONS")


@query
def demo_contrast(pf):
    return reports.demo_contrast(pf.published_360)


@query
def semantic_cross_entity(pf):
    return reports.cross_entity(pf.recs, pf.published_360)


# --- calibration and spend -----------------------------------------------------------------------------------
@query
def gnpa_blend(pf):
    return reports.gnpa_blend(pf.spark, pf.loans, pf.p)


@query
def gnpa_summary(pf):
    return reports.gnpa_summary(gnpa_blend(pf), pf.p)


@query
def delinquency_distribution(pf):
    return reports.delinquency_distribution(pf.state, pf.p)


def pf_usage(pf):
    return entities.metered_usage(pf.spark, pf.sf_dir)


@query
def spend_daily(pf):
    return spend.spend_daily(pf.spark, pf_usage(pf), pf.p)


@query
def spend_summary(pf):
    return spend.spend_summary(spend_daily(pf), pf.p)


@query
def spend_by_category(pf):
    return spend.spend_by_category(spend_daily(pf))


@query
def ai_spend_by_tag(pf):
    return spend.text_spend_by_tag(entities.text_usage(pf.spark, pf.sf_dir))


@query
def budget_crossings(pf):
    return spend.budget_crossings(pf_usage(pf), pf.p)


# --- documents ---------------------------------------------------------------------------------------------------
@query
def document_scan(pf):
    return documents.scan_documents(pf.base("documents"))


@query
def document_fields(pf):
    return pf.paper_fields


@query
def document_statement_lines(pf):
    return documents.statement_lines(pf.papers)


@query
def income_corroboration(pf):
    return documents.income_corroboration(pf.paper_fields, pf.state)


@query
def conversation_insight(pf):
    """Every signal read from the turns of given conversations, whole texts of any language."""
    return enrichment.score_text(pf.base("conversations"), "text").select(
        "conv_id", "turn", *enrichment.SIGNAL_COLUMNS
    )


@query
def document_insight(pf):
    """The same over given documents."""
    return enrichment.score_text(pf.base("documents"), "text").select("doc_id", *enrichment.SIGNAL_COLUMNS)


# --- quality and evaluation ------------------------------------------------------------------------------------------
@query
def standing_assertions(pf):
    """Against a second decision over the same inputs: it is the deciding half that must repeat itself.  Two whole
    builds are compared by ``determinism``."""
    again = pf.decided_again
    return quality.standing_assertions(
        pf.recs, rules.decision_log(again), pf.state, pf.loan_economics, pf.loans, quality.baseline(again)
    )


@query
def assert_a4(pf):
    """Recommendations of this generation that the earlier log does not know."""
    return pf.recs.select("recommendation_id", "action_code").join(
        merged(pf.earlier_log.select("recommendation_id")), "recommendation_id", "left_anti"
    )


@query
def assert_a5(pf):
    return quality.changed_actions(quality.baseline(pf.earlier_recs), pf.recs)


@query
def determinism(pf):
    """Two builds of the same inputs with different numbers of partitions, row by row: no row."""
    return quality.run_difference(pf.baseline, pf.recs)


@query
def generation_difference(pf):
    """What the calls changed: the earlier generation against this one, row by row."""
    return quality.run_difference(pf.earlier_recs, pf.recs)


@query
def generation_difference_by_digest(pf):
    """The same found by descent of two digest trees; only leaves that differ are compared."""
    depth = digests.depth_for(pf.earlier_recs.count())
    before = pf.digested(pf.earlier_recs, depth)
    tree = digests.tree(before, quality.DECISION_COLUMNS, depth)
    return quality.difference_by_digest(before, tree, pf.digested(pf.recs, depth), depth)


@query
def data_contracts(pf):
    p = quality.contract
    statuses = ["PENDING_APPROVAL", "APPROVED", "REJECTED"]
    checks = [
        p(pf.loans, "loan_account", ["loan_id"], ["borrower_id", "product_code", "emi_amount_inr"],
          {"rate_type": ["FIXED", "FLOATING"]}),
        p(pf.mandates, "mandate", ["mandate_id"], ["loan_id", "mandate_status"],
          {"failure_attribution": ["NONE", "TECHNICAL", "CAPACITY", "INTENT"]}),
        p(pf.state, "borrower_state", ["borrower_id"], ["max_dpd_own"],
          {"borrower_asset_class": ["STANDARD", "SMA-0", "SMA-1", "SMA-2", "NPA"]}),
        p(pf.recs, "nba_recommendation", ["recommendation_id"], ["rule_basis", "status"], {"status": statuses}),
        p(pf.log, "nba_decision_log", ["recommendation_id"], ["log_id", "rule_fired"],
          {"human_decision": ["PENDING", "APPROVED", "REJECTED"]}),
        p(earlier_queue(pf), "team_task_queue", ["recommendation_id"], ["task_id", "owning_team"], {"status": ["QUEUED"]}),
        p(pf.scored_calls, "transcript_insight", ["interaction_id"], ["predicted_intent"],
          {"sentiment": list(tx.SENTIMENTS), "predicted_intent": list(tx.INTENTS)}),
        p(pf.transitions, "call_transition", ["to_interaction_id"], ["borrower_id", "from_interaction_id"],
          {"sentiment_direction": ["IMPROVING", "DETERIORATING", "STABLE"]}),
        p(pf.trajectory, "trajectory", ["borrower_id"], ["n_calls"],
          {"overall_sentiment_direction": ["IMPROVING", "DETERIORATING", "STABLE", "MIXED"]}),
        p(pf.schedule, "repayment_schedule", ["schedule_id"], ["loan_id", "due_date"], {}),
        p(pf.published_360, "customer_360", ["borrower_id"], ["borrower_asset_class"], {}),
    ]
    return reduce(DataFrame.unionByName, checks)


@query
def written_contracts(pf):
    """Rules of single rows as counted by the writing of the tables: nothing is scanned again."""
    found = []
    for name in quality.ROW_RULES:
        getattr(pf, PUBLISHED[name])
        counts = pf.written_faults(name)
        found += [(name, check, counts["rows"], n) for check, n in counts.items() if check != "rows"]
    return pf.spark.createDataFrame(found, "table_name string, check string, n_rows bigint, violation_count bigint")


def _labelled(pf):
    return evaluation.labelled(pf.ground_truth, pf.scored_calls)


@query
def confusion_matrix(pf):
    return evaluation.confusion_matrix(_labelled(pf))


@query
def class_accuracy(pf):
    return evaluation.class_accuracy(_labelled(pf))


@query
def signal_combination(pf):
    return evaluation.signal_combination(
        evaluation.borrower_signals(pf.ground_truth, pf.scored_calls, pf.trajectory, pf.mandates)
    )


@query
def extract_null_rates(pf):
    return evaluation.extract_null_rates(_labelled(pf))


@query
def trained_reading(pf):
    labels = _labelled(pf).select("interaction_id", "ground_truth_label", "expected_intent", "predicted_intent")
    calls = pf.calls.select("interaction_id", "borrower_id", "transcript_text").join(merged(labels), "interaction_id")
    folder = work_folder(pf.spark, "reading")
    return trained_reading_of(calls, folder)


def trained_reading_of(calls, folder):
    """``trained_reading`` of labelled calls; each different text of a fold and label is read once."""
    columns = ("transcript_text", "ground_truth_label", "expected_intent", "predicted_intent")
    asked, own = ("transcript_text", "expected_intent"), F.col("_fold")
    by_borrower = reading.told(calls, reading.fold_of(), *columns)
    by_wording = reading.told(calls, reading.wording_fold("transcript_text"), *columns)
    return evaluation.trained_reading(
        reading.read_by_other_folds(by_borrower, *asked, f"{folder}/borrowers", own, "n_calls"),
        reading.read_by_other_folds(by_wording, *asked, f"{folder}/wordings", own, "n_calls"),
    )


@query
def reason_similarity(pf):
    return reasons.compare_reasons(pf.transitions, pf.scored_calls)
