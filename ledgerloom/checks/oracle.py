"""SQL statement per query name; column names equal those of the Spark results.

DECIMAL columns are shown as DOUBLE, dates and times as text, on both sides.
"""

from __future__ import annotations

from ledgerloom import config as c
from ledgerloom.checks.oracle_tables import P, compose, h, mapped, pct, q, scored_text, values
from ledgerloom.functions import text as tx
from ledgerloom.operators import actions as act
from ledgerloom.operators import economics as eco
from ledgerloom.operators import loan_book as book
from ledgerloom.operators import reasons as rs
from ledgerloom.operators import rules as r
from ledgerloom.plans import evaluation as ev
from ledgerloom.plans import quality as qa
from ledgerloom.plans.catalog import CALLED_BORROWER, DETAIL_BORROWER, SEARCH, SHORT_SEARCH

MISSING = "None"
SQL: dict[str, str] = {}


def add(name: str, select: str, double: str = "", text: str = "") -> None:
    """Register a statement; ``double`` and ``text`` list columns to show as such."""
    swaps = [f"CAST({x} AS DOUBLE) AS {x}" for x in double.split()]
    swaps += [f"CAST({x} AS VARCHAR) AS {x}" for x in text.split()]
    if swaps:
        select = f"SELECT * REPLACE ({', '.join(swaps)}) FROM ({select})"
    SQL[name] = compose(select)


# --- config, constants and buckets
add("rates_lookup", """
SELECT service_type, sum(credits_used) AS credits, count(*) AS usage_days, any_value(usd_per_credit) AS usd_per_credit, any_value(rate_note) AS rate_note
FROM x_usage LEFT JOIN x_rate USING (service_type) GROUP BY service_type""", "credits usd_per_credit")
add("config_lookup", """
SELECT p.*, (SELECT nullif(count(*), 0) FROM x_loan l WHERE l.product_code = p.product_code) AS loans FROM x_product p""",
    "count_weight_pct base_roi_pct bank_benchmark_roi_pct target_gnpa_pct nach_mandate_share_pct")
add("config_pivot", """
SELECT loan_id, cof AS cost_of_funds_pct, roi_pct - cof AS spread_pct, rate_gap_vs_bank_pct >= gap AS has_gap
FROM x_loan, (SELECT max(param_value) FILTER (param_key = 'cost_of_funds_blended_pct') AS cof, max(param_value) FILTER (param_key = 'bt_min_rate_gap_pct') AS gap FROM x_econ)""",
    "cost_of_funds_pct spread_pct")
add("hash_bucket", f"""
SELECT borrower_id, {h('borrower_id', 'lc', 100)} AS h_lc, {h('borrower_id', 'persona', 100)} AS h_persona, {h('borrower_id, 1', 'prod', 100000)} AS h_prod FROM x_borrower""")
add("null_greatest_least", """
SELECT interaction_id, CASE WHEN days_since_previous_contact IS NOT NULL THEN greatest(days_since_previous_contact, 2) END AS at_least_two,
       CASE WHEN days_since_previous_contact IS NOT NULL THEN least(days_since_previous_contact, 5) END AS at_most_five FROM x_call""")
add("json_extract", """
SELECT event_id, event_type, json_extract_string(props, '$.k') AS k_text, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
add("variant_extract", """
SELECT event_id, CASE WHEN json_valid(props) THEN TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
       props IS NOT NULL AND NOT json_valid(props) AS is_malformed FROM events""")
add("contact_window", """
SELECT event_id, hour(ts + INTERVAL 330 MINUTE) AS ist_hour, hour(ts + INTERVAL 330 MINUTE) BETWEEN 8 AND 18 AS in_window FROM events""")

# --- loan book
add("loan_explode", "SELECT borrower_id, seq, loan_count, row_number() OVER (ORDER BY borrower_id, seq) AS loan_no FROM x_slot")
add("product_bounds", """
SELECT b.product_code, cum_lo, cum_hi, nullif(count(d.seq), 0) AS loans_drawn
FROM x_bounds b LEFT JOIN x_draw d ON h_prod >= cum_lo AND h_prod < cum_hi GROUP BY ALL""")
add("product_range_join", "SELECT borrower_id, seq, h_prod, product_code FROM x_draw JOIN x_bounds ON h_prod >= cum_lo AND h_prod < cum_hi")
add("score_spread", f"SELECT borrower_id, bureau_score_band, {mapped('bureau_score_band', c.SCORE_SPREAD_PCT, str(c.SCORE_SPREAD_OTHERWISE))} AS score_spread_pct FROM x_borrower", "score_spread_pct")
add("global_rank", "SELECT tradeline_id, borrower_id, row_number() OVER (ORDER BY tradeline_id) AS n FROM x_tradeline")
add("emi", "SELECT loan_id, sanction_amount_inr, roi_pct, tenor_months, emi_amount_inr FROM x_loan", "roi_pct")
add("outstanding", "SELECT loan_id, months_elapsed, outstanding_principal_inr FROM x_loan")
add("dpd", "SELECT borrower_id, seq, months_elapsed, drawn_dpd, least(drawn_dpd, 30 * months_elapsed) AS current_dpd FROM x_aged")
add("arrears", "SELECT loan_id, current_dpd, unpaid_emi_count, emi_amount_inr, arrears_amount_inr FROM x_loan")
add("loan_account", f"SELECT {', '.join(book.LOAN_COLUMNS)} FROM x_loan",
    "roi_pct bank_benchmark_roi_pct rate_gap_vs_bank_pct", "disbursal_date maturity_date")
add("dedupe_first_loan", "SELECT loan_id, borrower_id, product_code FROM x_loan_deduped")
add("demo_override", """
SELECT loan_id, borrower_id, product_code, roi_pct, tenor_months, months_elapsed, emi_amount_inr, outstanding_principal_inr, current_dpd, has_nach_mandate FROM x_loan""", "roi_pct")
add("mandates", "SELECT * FROM x_mandate", text="registration_date last_failure_date")
add("sponsor_bank", "SELECT sponsor_bank, count(*) AS mandates FROM x_mandate GROUP BY 1")
add("latest_mandate", "SELECT * FROM x_latest")
add("amortization", "SELECT * FROM x_schedule",
    "interest_component_inr principal_component_inr opening_balance_inr closing_balance_inr", "due_date")
add("ltv", "SELECT * FROM x_ltv", "ltv_expected_interest_inr")
add("ltv_from_terms", "SELECT * FROM x_ltv", "ltv_expected_interest_inr")

# --- borrower state
add("own_book", "SELECT * FROM x_own", "max_rate_gap_vs_bank_pct")
add("external_book", "SELECT * FROM x_ext")
add("mandate_failures", "SELECT * FROM x_mnd")
add("state_left_defaults", """
SELECT borrower_id, external_tradeline_count, external_lender_count, external_balance_inr, external_emi_inr, external_max_dpd, fintech_tradelines,
       mfi_tradelines, early_warning_mandates, technical_mandate_failures, capacity_mandate_failures, intent_mandate_failures FROM x_state""")
add("asset_class", "SELECT borrower_id, max_dpd_own, borrower_asset_class, is_npa, npa_upgrade_eligible FROM x_state")
add("performing_dragged", "SELECT borrower_id, performing_loans_dragged_to_npa, arrears_to_clear_for_upgrade_inr FROM x_state")
add("loan_stacked", "SELECT borrower_id, total_lender_count, is_loan_stacked FROM x_state")
add("foir", "SELECT borrower_id, monthly_income_inr, total_emi_inr, foir_own_book_pct, foir_true_pct FROM x_state")
add("borrower_state", """
SELECT borrower_id, full_name, city, state, city_tier, primary_language, occupation_type, monthly_income_inr, bureau_score, bureau_score_band,
       own_loan_count, own_product_count, total_outstanding_inr, total_arrears_inr, own_emi_inr, max_dpd_own, min_residual_months, max_residual_months,
       max_rate_gap_vs_bank_pct, borrower_asset_class, is_npa, npa_upgrade_eligible, arrears_to_clear_for_upgrade_inr, performing_loans_dragged_to_npa,
       external_tradeline_count, external_lender_count, total_lender_count, is_loan_stacked, external_balance_inr, external_emi_inr, external_max_dpd,
       fintech_tradelines, mfi_tradelines, total_emi_inr, foir_own_book_pct, foir_true_pct, early_warning_mandates, technical_mandate_failures,
       capacity_mandate_failures, intent_mandate_failures, is_pre_delinquent_warning, is_demo_case, demo_case_label FROM x_state""", "max_rate_gap_vs_bank_pct")

# --- economics
add("loan_with_config", "SELECT loan_id, product_code, target_gnpa_pct, bt_min_residual, switching_cost_assumption FROM x_loan JOIN x_product USING (product_code) JOIN x_threshold USING (product_code)", "target_gnpa_pct")
add("loan_economics", f"SELECT {', '.join(eco.ECONOMICS_COLUMNS)} FROM x_economics",
    "roi_pct bank_benchmark_roi_pct rate_gap_vs_bank_pct cost_of_funds_pct gross_spread_pct nim_pct bt_reduction_needed_pct")
add("bt_flags", "SELECT loan_id, borrower_max_dpd_own, rate_gap_vs_bank_pct, residual_months, bt_min_residual, bt_is_economically_rational, bt_recommended_stance FROM x_economics", "rate_gap_vs_bank_pct")
add("bt_rationale", "SELECT loan_id, bt_rationale FROM x_economics")
add("bt_summary", "SELECT * FROM x_bt", "max_bt_risk_score")

# --- calls
_insight = """
SELECT interaction_id, sentiment, predicted_intent, is_credible_hardship, promise_to_pay_amount, promise_to_pay_date, competitor_name_mentioned,
       competitor_rate_mentioned, stated_reason, previous_promise_missed_raw, strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS enriched_at FROM x_scored_call"""
add("transcript_insight", _insight)
add("backfill_enrich", _insight)
add("stream_enrich", _insight)
add("sentiment", "SELECT interaction_id, sentiment FROM x_scored_call")
add("intent", "SELECT interaction_id, predicted_intent FROM x_scored_call")
add("credible_hardship", "SELECT interaction_id, is_credible_hardship FROM x_scored_call")
add("extract_fields", f"SELECT interaction_id, {', '.join(tx.EXTRACT_FIELDS)} FROM x_scored_call")
add("call_pairs", "SELECT borrower_id, from_interaction_id, to_interaction_id, from_seq, to_seq FROM x_transition")
add("call_pairs_lag", "SELECT borrower_id, from_interaction_id, to_interaction_id, from_sentiment, to_sentiment FROM x_transition")
add("ptp_flag", "SELECT to_interaction_id, ptp_was_made_on_prior_call, ptp_flagged_missed_on_this_call FROM x_transition")
add("reason_changed", "SELECT to_interaction_id, from_reason, to_reason, reason_changed FROM x_transition")
add("call_transitions", "SELECT * FROM x_transition")
add("stream_transitions", "SELECT * FROM x_transition")
add("first_last_sentiment", "SELECT borrower_id, first_sentiment, last_sentiment, n_calls, first_contact_date, last_contact_date FROM x_trajectory", text="first_contact_date last_contact_date")
add("trajectory", "SELECT * FROM x_trajectory", text="first_contact_date last_contact_date")

# --- rules and recommendations
add("nba_loan_rules", "SELECT * FROM x_rule", "rate_gap_vs_bank_pct")
add("growth_eligible", "SELECT g.borrower_id, bureau_score_band FROM x_growth g JOIN x_borrower USING (borrower_id)")
add("nba_growth", "SELECT borrower_id, action_code, rule_basis, borrower_facing_message, outstanding_principal_inr FROM x_growth")
add("nba_candidates", "SELECT * FROM x_candidate", "rate_gap_vs_bank_pct")
add("expected_value", "SELECT recommendation_id, action_code, margin_impact_bps, expected_value_inr FROM x_rec", "margin_impact_bps")
add("inputs_snapshot", "SELECT recommendation_id, inputs_snapshot FROM x_rec")
add("snapshot_fields", f"""
SELECT recommendation_id, {', '.join(f"CAST(json_extract_string(inputs_snapshot, '$.{n}') AS {t}) AS {n}" for n, t in (
    ('current_dpd', 'BIGINT'), ('arrears_amount_inr', 'BIGINT'), ('rate_gap_vs_bank_pct', 'DOUBLE'), ('residual_months', 'BIGINT'),
    ('bt_stance', 'VARCHAR'), ('product_code', 'VARCHAR')))} FROM x_rec""")
add("nba_recommendations", f"SELECT {', '.join(r.RECOMMENDATION_COLUMNS)} FROM x_rec", "margin_impact_bps", "created_at")
add("decision_log", """
SELECT md5('log|' || recommendation_id) AS log_id, recommendation_id, rule_basis AS rule_fired, CAST(NULL AS VARCHAR) AS model_used,
       CAST(NULL AS VARCHAR) AS prompt_version, 1.0 AS confidence, inputs_snapshot, 'PENDING' AS human_decision, CAST(NULL AS VARCHAR) AS decided_by,
       CAST(NULL AS VARCHAR) AS decided_at, created_at AS logged_at FROM x_rec""", "confidence", "logged_at")
_tone = mapped("action_family", act.TONE_BY_FAMILY, q(act.TONE_OTHERWISE))
_told = f"action_code || ' was chosen because ' || rtrim(rule_basis, '.') || '. ' || {_tone}"
add("rationale", f"SELECT recommendation_id, action_code, {_told} AS model_contribution FROM x_rec")

# --- state machine
add("carry_rationale", """
SELECT n.recommendation_id, coalesce(o.model_contribution, 'NONE') AS model_contribution
FROM x_rec n LEFT JOIN x_told_before o ON o.borrower_id = n.borrower_id AND o.loan_id IS NOT DISTINCT FROM n.loan_id
     AND o.action_code = n.action_code AND o.rule_basis = n.rule_basis""")
_carried = """
FROM x_rec n LEFT JOIN (SELECT * FROM x_rec_before JOIN x_decided USING (recommendation_id)) o
     ON o.borrower_id = n.borrower_id AND o.loan_id IS NOT DISTINCT FROM n.loan_id AND o.action_code = n.action_code"""
add("carry_decision", f"SELECT n.recommendation_id, n.borrower_id, n.loan_id, n.action_code, coalesce(o.decision, n.status) AS status {_carried}")
add("carry_decision_log", f"SELECT n.recommendation_id, coalesce(o.decision, 'PENDING') AS human_decision, o.decided_by, o.decided_at {_carried}", text="decided_at")
add("apply_decisions", "SELECT recommendation_id, borrower_id, action_code, coalesce(decision, status) AS status FROM x_rec_before LEFT JOIN x_decided USING (recommendation_id)")
add("apply_decisions_log", "SELECT recommendation_id, coalesce(decision, 'PENDING') AS human_decision, decided_by, decided_at FROM x_rec_before LEFT JOIN x_decided USING (recommendation_id)", text="decided_at")
add("apply_decisions_refused", "SELECT *, 'decision must be APPROVED or REJECTED' AS refusal FROM x_decision WHERE decision = 'approved'", text="decided_at")
_team = mapped("action_family", c.TEAM_BY_FAMILY, q(c.TEAM_OTHERWISE))
_hour = (P.run_at.hour * 60 + P.run_at.minute + 330) // 60 % 24
_now = f"'{P.run_at}'"
_task = f"""
SELECT md5('task|' || recommendation_id) AS task_id, recommendation_id, borrower_id, action_code, {_team} AS owning_team, 'QUEUED' AS status,
       {_now} AS created_at, {_hour} BETWEEN 8 AND 18 AS fpc_window_ok, {_now} AS confirmed_at
FROM x_rec_before JOIN x_decided USING (recommendation_id) WHERE decision = 'APPROVED'"""
# Ids are stable over rebuilds, so an approval carried forward already has its task.
add("carry_decision_foreign", f"SELECT n.recommendation_id, n.borrower_id, n.loan_id, n.action_code, coalesce(o.decision, n.status) AS status {_carried}")
# The review of the new generation adds what is approved there and was not there before.
_fresh = _task.replace("x_rec_before JOIN x_decided", "x_rec JOIN x_decided_now")
add("team_tasks", f"{_task} UNION ALL {_fresh} AND recommendation_id NOT IN (SELECT recommendation_id FROM x_rec_before)")
add("refresh_queue", _fresh)
add("queue_orphans", f"{_task} AND recommendation_id NOT IN (SELECT recommendation_id FROM x_rec)")
add("queue_purged", f"{_task} AND recommendation_id IN (SELECT recommendation_id FROM x_rec)")

# --- customer 360 and application queries
_360d = "foir_true_pct bt_risk_score ltv_expected_interest_inr"
add("customer_360", "SELECT * FROM x_360", _360d)
add("refresh_cycle", "SELECT * FROM x_360", _360d)
add("nba_summary", "SELECT * FROM x_nba")
add("vq_asset_class_counts", "SELECT borrower_asset_class, count(*) AS n FROM x_360 GROUP BY 1")
add("portfolio_kpis", """
SELECT count(*) FILTER (bt_is_a_flight_risk) AS flight_risks, count(*) FILTER (has_retention_offer) AS retention_offers,
       CAST(sum(bt_retention_value_if_offered_inr) AS BIGINT) AS total_retention_value_inr, sum(CAST(ltv_expected_interest_inr AS DECIMAL(18,2))) AS total_ltv_inr FROM x_360""", "total_ltv_inr")
add("vq_flight_risk_topk", "SELECT borrower_id, full_name, ltv_expected_interest_inr, bt_risk_score FROM x_360 WHERE bt_is_a_flight_risk ORDER BY ltv_expected_interest_inr DESC, borrower_id LIMIT 20", "bt_risk_score")
add("maintained_class_counts", "SELECT borrower_asset_class, count(*) AS n FROM x_360 GROUP BY 1")
add("maintained_kpis", """
SELECT count(*) FILTER (bt_is_a_flight_risk) AS flight_risks, count(*) FILTER (has_retention_offer) AS retention_offers,
       CAST(sum(bt_retention_value_if_offered_inr) AS BIGINT) AS total_retention_value_inr, sum(CAST(ltv_expected_interest_inr AS DECIMAL(18,2))) AS total_ltv_inr FROM x_360""", "total_ltv_inr")
add("maintained_flight_risk_topk", "SELECT borrower_id, full_name, ltv_expected_interest_inr, bt_risk_score FROM x_360 WHERE bt_is_a_flight_risk ORDER BY ltv_expected_interest_inr DESC NULLS LAST, borrower_id LIMIT 20", "bt_risk_score")
add("vq_deteriorating", "SELECT borrower_id, full_name, overall_sentiment_direction, any_ptp_made_then_missed FROM x_360 WHERE overall_sentiment_direction = 'DETERIORATING'")
add("vq_pending_collections", "SELECT borrower_id, action_code, rule_basis, expected_value_inr FROM x_rec WHERE status = 'PENDING_APPROVAL' AND action_family = 'COLLECTIONS'")
add("vq_npa_upgrade", "SELECT count(*) AS n FROM x_360 WHERE is_npa AND npa_upgrade_eligible")
for _name, _text in (("borrower_lookup", SEARCH), ("borrower_lookup_scan", SHORT_SEARCH)):
    add(_name, f"""
SELECT borrower_id, full_name, city, borrower_asset_class, bt_risk_score, bt_is_a_flight_risk, ltv_expected_interest_inr, overall_sentiment_direction,
       any_ptp_made_then_missed, n_pending_recommendations FROM x_360 WHERE borrower_id ILIKE '%{_text}%' OR full_name ILIKE '%{_text}%' ORDER BY borrower_id LIMIT 25""", "bt_risk_score")
add("borrower_detail", f"SELECT * FROM x_360 WHERE borrower_id = '{DETAIL_BORROWER}'", _360d)
add("borrower_pending", f"SELECT recommendation_id, action_code, action_family, rule_basis, expected_value_inr, bureau_disclosure, status FROM x_rec WHERE borrower_id = '{DETAIL_BORROWER}' AND status = 'PENDING_APPROVAL'")
add("borrower_rec_history", f"SELECT action_code, rule_basis, model_contribution, expected_value_inr, status FROM x_rec WHERE borrower_id = '{DETAIL_BORROWER}'")
add("borrower_calls", f"SELECT transcript_sequence_number, contact_date, transcript_text FROM x_call WHERE borrower_id = '{CALLED_BORROWER}'", text="contact_date")
add("first_call", "SELECT borrower_id, transcript_text AS first_call_text FROM x_call WHERE transcript_sequence_number = 1")
_queue = "SELECT recommendation_id, borrower_id, action_code, action_family, expected_value_inr, rule_basis FROM x_rec WHERE status = 'PENDING_APPROVAL' {} ORDER BY expected_value_inr DESC NULLS LAST, recommendation_id LIMIT 200"
add("action_queue", _queue.format(""))
add("action_queue_collections", _queue.format("AND action_family = 'COLLECTIONS'"))
add("demo_contrast", "SELECT borrower_id, full_name, borrower_asset_class, bt_risk_score, bt_is_a_flight_risk, ltv_expected_interest_inr, has_retention_offer, demo_case_label FROM x_360 WHERE is_demo_case", "bt_risk_score")
add("semantic_cross_entity", """
SELECT recommendation_id, r.borrower_id, action_code, action_family, status, full_name, borrower_asset_class, bt_risk_score, ltv_expected_interest_inr
FROM x_rec r LEFT JOIN x_360 b ON b.borrower_id = r.borrower_id""", "bt_risk_score")

# --- calibration and spend
_blend = """
SELECT b.product_code, b.product_name, count_weight_pct, avg_ticket_inr, round(100 * share, 3) AS value_weight_pct, target_gnpa_pct,
       CAST(round(count_weight_pct * target_gnpa_pct / 100, 4) AS DECIMAL(12,4)) AS contrib_count_weighted_pct,
       CAST(round(share * CAST(target_gnpa_pct AS DOUBLE), 4) AS DECIMAL(12,4)) AS contrib_value_weighted_pct, count(loan_id) AS book_loans,
       CAST(coalesce(sum(outstanding_principal_inr), 0) AS BIGINT) AS book_outstanding_inr,
       CAST(coalesce(sum(outstanding_principal_inr) FILTER (current_dpd >= 90), 0) AS BIGINT) AS book_npa_inr
FROM (SELECT *, (ticket_min_inr + ticket_max_inr) / 2 AS avg_ticket_inr,
             CAST(count_weight_pct * (ticket_min_inr + ticket_max_inr) AS DOUBLE) / (SELECT CAST(sum(count_weight_pct * (ticket_min_inr + ticket_max_inr)) AS DOUBLE) FROM x_product) AS share
      FROM x_product) b LEFT JOIN x_loan l ON l.product_code = b.product_code
GROUP BY ALL"""
add("gnpa_blend", _blend, "count_weight_pct avg_ticket_inr target_gnpa_pct contrib_count_weighted_pct contrib_value_weighted_pct")
add("gnpa_summary", f"""
SELECT round(sum(contrib_value_weighted_pct), 2) AS blended_gnpa_value_weighted_pct, round(sum(contrib_count_weighted_pct), 2) AS blended_gnpa_count_weighted_pct,
       (SELECT param_value FROM x_econ WHERE param_key = 'benchmark_system_gnpa_pct') AS system_benchmark_pct, {q(c.GROSS_BENCHMARK_NOTE)} AS interpretation,
       {pct('sum(book_npa_inr)', 'sum(book_outstanding_inr)', 2)} AS book_gnpa_pct FROM ({_blend})""",
    "blended_gnpa_value_weighted_pct blended_gnpa_count_weighted_pct system_benchmark_pct")
add("delinquency_distribution", f"""
SELECT borrower_asset_class, count(*) AS borrowers, {pct('count(*)', '(SELECT count(*) FROM x_state)', 2)} AS pct_of_borrowers,
       {mapped('borrower_asset_class', c.ASSET_CLASS_DEFINITIONS)} AS rbi_definition,
       (SELECT param_value FROM x_econ WHERE param_key = 'benchmark_retail_par_31_180_pct') AS benchmark_par_31_180_pct,
       (SELECT param_value FROM x_econ WHERE param_key = 'benchmark_system_gnpa_pct') AS benchmark_system_gnpa_pct FROM x_state GROUP BY borrower_asset_class""",
    "benchmark_par_31_180_pct benchmark_system_gnpa_pct")
add("spend_daily", "SELECT * FROM x_spend", "credits usd_per_credit usd", "usage_date")
_budget = str(P.budget_usd)
add("spend_summary", f"""
SELECT CAST({_budget} AS DOUBLE) AS trial_budget_usd, round(t, 2) AS spent_usd, round({_budget} - t, 2) AS remaining_usd,
       round(CAST(t * 100 AS DOUBLE) / {_budget}, 1) AS pct_used, days AS active_days, round(CAST(t AS DOUBLE) / days, 2) AS usd_per_active_day
FROM (SELECT CAST(sum(usd) AS DECIMAL(18,4)) AS t, count(DISTINCT usage_date) AS days FROM x_spend)""", "spent_usd remaining_usd")
add("spend_by_category", """
SELECT service_type, rate_note, round(sum(credits), 4) AS credits, round(sum(usd), 2) AS usd,
       round(CAST(100 * sum(usd) AS DOUBLE) / CAST((SELECT sum(usd) FROM x_spend) AS DOUBLE), 1) AS pct_of_spend FROM x_spend GROUP BY 1, 2""", "credits usd")
add("ai_spend_by_tag", f"""
SELECT CASE WHEN coalesce(query_tag, '') = '' THEN '(untagged)' ELSE query_tag END AS query_tag, function_name, model_name, CAST(sum(tokens) AS BIGINT) AS tokens,
       sum(token_credits) AS ai_credits, round(CAST(sum(token_credits) AS DECIMAL(18,6)) * CAST({c.DEFAULT_RATE_USD} AS DECIMAL(6,2)), 4) AS usd FROM x_text_usage GROUP BY 1, 2, 3""", "ai_credits usd")
_steps = values([(x,) for x in P.quota_pcts], "threshold_pct")
add("budget_crossings", f"""
SELECT usage_month, CAST(threshold_pct AS BIGINT) AS threshold_pct, min(usage_date) AS crossed_on, min(running) AS credits_at_crossing
FROM (SELECT d.usage_date, CAST(date_trunc('month', d.usage_date) AS DATE) AS usage_month, (SELECT sum(o.credits_used) FROM x_usage o WHERE o.usage_date <= d.usage_date
             AND date_trunc('month', o.usage_date) = date_trunc('month', d.usage_date)) AS running FROM (SELECT DISTINCT usage_date FROM x_usage) d)
JOIN {_steps} ON running * 100 >= {P.credit_quota} * threshold_pct GROUP BY 1, 2""", "credits_at_crossing", "usage_month crossed_on")

# --- documents
add("document_scan", r"""
SELECT doc_id, lang, source, length(text) AS text_chars, len(string_split(text, chr(10))) AS text_lines, length(text) = n_chars AS length_as_declared FROM documents""")
add("document_fields", "SELECT * FROM x_paper_fields")
add("document_statement_lines", f"""
SELECT s.borrower_id, CAST(line_no AS BIGINT) AS line_no, booked_on, description,
       CASE line_no WHEN 6 THEN 1500 WHEN 7 THEN s.own_emi_inr ELSE 0 END AS debit_inr,
       CASE line_no WHEN 4 THEN s.monthly_income_inr WHEN 5 THEN n.net_income_inr ELSE 0 END AS credit_inr, CAST(NULL AS BIGINT) AS balance_inr
FROM x_state s JOIN (SELECT borrower_id, net_income_inr FROM x_paper_fields WHERE doc_type = 'INCOME_STATEMENT') n USING (borrower_id),
     {values([(4, '01-Jan-2024', 'Opening Balance'), (5, '10-Jan-2024', 'Consulting Fee'), (6, '20-Jan-2024', 'Electricity Bill'), (7, '28-Jan-2024', 'EMI - Loan account')], 'line_no, booked_on, description')}""")
add("income_corroboration", f"""
SELECT *, income_gap_pct <= 5 AS income_corroborated
FROM (SELECT s.borrower_id, doc AS document_income_inr, own_emi_inr AS document_emi_inr, monthly_income_inr, foir_true_pct,
             {pct('abs(monthly_income_inr - doc)', 'monthly_income_inr')} AS income_gap_pct, {pct('own_emi_inr', 'doc')} AS emi_to_document_income_pct,
             {pct('own_emi_inr', 'monthly_income_inr')} AS emi_to_recorded_income_pct
      FROM x_state s JOIN (SELECT borrower_id, net_income_inr AS doc FROM x_paper_fields WHERE doc_type = 'INCOME_STATEMENT') USING (borrower_id))""")

# --- quality and evaluation
_names = [qa.A1, qa.A2, qa.A3, qa.A4, qa.A5, qa.B1, qa.B2, qa.C1, qa.D1]
_codes = ", ".join(q(x) for x in c.DISCLOSED_ACTIONS)
_counts = [
    "SELECT count(*) FROM x_rec JOIN x_state USING (borrower_id) WHERE action_code = 'BT_COUNTER' AND max_dpd_own >= 1",
    "SELECT count(*) FROM x_rec WHERE rule_basis IS NULL",
    f"SELECT count(*) FROM x_rec WHERE action_code IN ({_codes}) AND bureau_disclosure IS NULL",
    "SELECT count(*) - count(DISTINCT recommendation_id) FROM x_rec",
    "SELECT count(*) FROM x_rec a JOIN x_rec b USING (borrower_id, loan_id) WHERE a.action_code <> b.action_code",
    "SELECT count(*) FROM x_economics WHERE borrower_max_dpd_own >= 1 AND bt_risk_score <> 0",
    f"SELECT count(*) FROM x_economics WHERE borrower_max_dpd_own >= 1 AND bt_recommended_stance <> '{eco.STANCE_DISTRESS}'",
    "SELECT count(*) FROM x_loan WHERE unpaid_emi_count > months_elapsed",
    "SELECT count(*) FROM x_rec JOIN x_economics USING (loan_id) WHERE action_code = 'BT_COUNTER' AND NOT bt_is_economically_rational",
]
add("standing_assertions", " UNION ALL ".join(
    f"SELECT {q(n[0])} AS assertion, {q(n[1])} AS rule_intent, ({s}) AS violation_count" for n, s in zip(_names, _counts)))
add("assert_a4", "SELECT recommendation_id, action_code FROM x_rec WHERE recommendation_id NOT IN (SELECT recommendation_id FROM x_rec_before)")
add("assert_a5", """
SELECT borrower_id, loan_id, a.action_code AS baseline_action, b.action_code FROM x_rec_before a JOIN x_rec b USING (borrower_id, loan_id) WHERE a.action_code <> b.action_code""")
_cols = "borrower_id, loan_id, action_code, rule_basis"
add("determinism", f"SELECT {_cols}, 'first' AS found_in, CAST(1 AS BIGINT) AS times FROM x_rec WHERE false")
add("generation_difference", f"""
SELECT {_cols}, found_in, count(*) AS times
FROM (SELECT *, 'first' AS found_in FROM (SELECT {_cols} FROM x_rec_before EXCEPT ALL SELECT {_cols} FROM x_rec)
      UNION ALL SELECT *, 'second' AS found_in FROM (SELECT {_cols} FROM x_rec EXCEPT ALL SELECT {_cols} FROM x_rec_before)) GROUP BY ALL""")
SQL["generation_difference_by_digest"] = SQL["generation_difference"]


def _contract(table: str, source: str, key: str, required: list[str], enums: dict[str, list[str]]) -> list[str]:
    rows = [(f"unique {key}", f"SELECT count(*) FROM (SELECT {key} FROM {source} GROUP BY 1 HAVING count(*) > 1)")]
    rows += [(f"required {x}", f"SELECT count(*) FROM {source} WHERE {x} IS NULL") for x in required]
    rows += [(f"allowed {x}", f"SELECT count(*) FROM {source} WHERE {x} NOT IN ({', '.join(q(v) for v in vals)})") for x, vals in enums.items()]
    return [f"SELECT '{table}' AS table_name, {q(n)} AS \"check\", ({s}) AS violation_count" for n, s in rows]


_log = f"(SELECT recommendation_id, md5('log|' || recommendation_id) AS log_id, rule_basis AS rule_fired, 'PENDING' AS human_decision FROM x_rec)"
add("data_contracts", " UNION ALL ".join(
    _contract("loan_account", "x_loan", "loan_id", ["borrower_id", "product_code", "emi_amount_inr"], {"rate_type": ["FIXED", "FLOATING"]})
    + _contract("mandate", "x_mandate", "mandate_id", ["loan_id", "mandate_status"], {"failure_attribution": ["NONE", "TECHNICAL", "CAPACITY", "INTENT"]})
    + _contract("borrower_state", "x_state", "borrower_id", ["max_dpd_own"], {"borrower_asset_class": ["STANDARD", "SMA-0", "SMA-1", "SMA-2", "NPA"]})
    + _contract("nba_recommendation", "x_rec", "recommendation_id", ["rule_basis", "status"], {"status": ["PENDING_APPROVAL", "APPROVED", "REJECTED"]})
    + _contract("nba_decision_log", _log, "recommendation_id", ["log_id", "rule_fired"], {"human_decision": ["PENDING", "APPROVED", "REJECTED"]})
    + _contract("team_task_queue", f"({_task})", "recommendation_id", ["task_id", "owning_team"], {"status": ["QUEUED"]})
    + _contract("transcript_insight", "x_scored_call", "interaction_id", ["predicted_intent"], {"sentiment": list(tx.SENTIMENTS), "predicted_intent": list(tx.INTENTS)})
    + _contract("call_transition", "x_transition", "to_interaction_id", ["borrower_id", "from_interaction_id"], {"sentiment_direction": ["IMPROVING", "DETERIORATING", "STABLE"]})
    + _contract("trajectory", "x_trajectory", "borrower_id", ["n_calls"], {"overall_sentiment_direction": ["IMPROVING", "DETERIORATING", "STABLE", "MIXED"]})
    + _contract("repayment_schedule", "x_schedule", "schedule_id", ["loan_id", "due_date"], {})
    + _contract("customer_360", "x_360", "borrower_id", ["borrower_asset_class"], {})))
_kept_as = {"loan_account": "x_loan", "mandate": "x_mandate", "borrower_state": "x_state", "scored_calls": "x_scored_call",
            "trajectory": "x_trajectory", "recommendations": "x_rec", "customer_360": "x_360"}


def _row_rules(table: str) -> list[str]:
    required, allowed, faulty = qa.ROW_RULES[table]
    tests = [(f"required {x}", f"{x} IS NULL") for x in required]
    tests += [(f"allowed {x}", f"{x} NOT IN ({', '.join(q(v) for v in vals)})") for x, vals in allowed.items()]
    tests += list(faulty.items())
    return [f"SELECT '{table}' AS table_name, {q(n)} AS \"check\", count(*) AS n_rows, count(*) FILTER ({t}) AS violation_count FROM {_kept_as[table]}"
            for n, t in tests]


add("written_contracts", " UNION ALL ".join(s for table in qa.ROW_RULES for s in _row_rules(table)))
_signals = "sentiment, predicted_intent, is_credible_hardship, " + ", ".join(tx.EXTRACT_FIELDS)
add("conversation_insight", f"SELECT conv_id, turn, {_signals} FROM ({scored_text('(SELECT *, text AS transcript_text FROM conversations)')})")
add("document_insight", f"SELECT doc_id, {_signals} FROM ({scored_text('(SELECT *, text AS transcript_text FROM documents)')})")
add("confusion_matrix", "SELECT ground_truth_label, predicted_intent, count(*) AS n FROM x_labelled GROUP BY 1, 2")
add("class_accuracy", f"""
SELECT l.ground_truth_label, count(*) AS n_calls, {pct('count(*) FILTER (predicted_intent = expected_intent)', 'count(*)')} AS accuracy_pct,
       any_value(w.predicted) AS dominant_confusion, any_value(w.n) AS confusion_count
FROM x_labelled l LEFT JOIN (SELECT ground_truth_label, predicted_intent AS predicted, count(*) AS n FROM x_labelled WHERE predicted_intent <> expected_intent
     GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY ground_truth_label ORDER BY count(*) DESC, predicted_intent) = 1) w USING (ground_truth_label)
GROUP BY 1""")
_flags = [("text_only", "txt"), ("any_of_3", "txt OR brk OR chg"), ("two_of_3", "CAST(txt AS INT) + CAST(brk AS INT) + CAST(chg AS INT) >= 2"), ("structural_circular", "str")]
_who = f"""(SELECT l.borrower_id, bool_or(ground_truth_label = '{ev.WILFUL}') AS wilful, bool_or(predicted_intent = 'payment_avoidance_pattern') AS txt,
       bool_or(t.any_ptp_made_then_missed) AS brk, bool_or(t.any_reason_change) AS chg,
       EXISTS (SELECT 1 FROM x_mandate m WHERE m.borrower_id = l.borrower_id AND failure_attribution = 'INTENT') AS str
       FROM x_labelled l JOIN x_trajectory t USING (borrower_id) GROUP BY l.borrower_id)"""
add("signal_combination", f"""
SELECT *, {pct('true_positives', 'n_positive')} AS recall_pct, {pct('false_positives', 'n_negative')} AS false_positive_rate_pct,
       {pct('true_positives', '(true_positives + false_positives)')} AS precision_pct
FROM ({' UNION ALL '.join(f"SELECT '{n}' AS signal, count(*) FILTER (wilful) AS n_positive, count(*) FILTER (NOT wilful) AS n_negative, count(*) FILTER (wilful AND ({e})) AS true_positives, count(*) FILTER (NOT wilful AND ({e})) AS false_positives FROM {_who}" for n, e in _flags)})""")
add("extract_null_rates", " UNION ALL ".join(
    f"SELECT ground_truth_label, '{f}' AS field, count(*) AS n_calls, count(*) FILTER ({f} = 'None') AS n_missing, {pct(f'count(*) FILTER ({f} = {q(MISSING)})', 'count(*)')} AS null_rate_pct FROM x_labelled GROUP BY 1"
    for f in tx.EXTRACT_FIELDS))
_tokens = "list_distinct(regexp_extract_all(lower(reason), '[\\p{L}\\p{M}\\p{N}]+'))"
add("reason_similarity", f"""SELECT * FROM (
WITH given AS (SELECT interaction_id, stated_reason AS reason FROM x_scored_call WHERE stated_reason <> {q(MISSING)}),
held AS (SELECT *, unnest({_tokens}) AS word FROM given),
rare AS (SELECT word, count(*) AS n, (SELECT count(DISTINCT interaction_id) FROM held) AS total FROM held GROUP BY word),
weighed AS (SELECT interaction_id, word, CAST({rs.SCALE} + round({rs.SCALE} * ln((total + 1) / (n + 1))) AS BIGINT) AS w FROM held JOIN rare USING (word)),
norms AS (SELECT interaction_id, CAST(sum(w * w) AS DOUBLE) AS norm FROM weighed GROUP BY 1),
shared AS (SELECT t.to_interaction_id, CAST(sum(a.w * a.w) AS DOUBLE) AS dot FROM x_transition t
           JOIN weighed a ON a.interaction_id = t.from_interaction_id JOIN weighed b ON b.interaction_id = t.to_interaction_id AND b.word = a.word GROUP BY 1)
SELECT borrower_id, from_interaction_id, to_interaction_id, similarity, similarity < {rs.SAME_FROM} AS reason_changed
FROM (SELECT t.borrower_id, t.from_interaction_id, t.to_interaction_id,
             CAST(round({rs.SCALE} * coalesce(dot, 0) / (sqrt(a.norm) * sqrt(b.norm))) AS BIGINT) AS similarity
      FROM x_transition t LEFT JOIN norms a ON a.interaction_id = t.from_interaction_id
      LEFT JOIN norms b ON b.interaction_id = t.to_interaction_id LEFT JOIN shared USING (to_interaction_id)))""")
