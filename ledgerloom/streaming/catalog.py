"""The streaming jobs run to the end of the available data, as named queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.enrichment import INSIGHT_COLUMNS
from ledgerloom.plans.portfolio import Portfolio, sample_decisions
from ledgerloom.session import work_folder
from ledgerloom.streaming import jobs, maintained

STREAM_QUERIES = {}


def stream_query(fn):
    STREAM_QUERIES[fn.__name__] = fn
    return fn


def land_calls(pf: Portfolio, base: str) -> str:
    """Drop the transcripts into a landing folder out of call order, in as many files as the
    shuffle has partitions."""
    path = f"{base}/landing"
    order = F.xxhash64("interaction_id")
    pf.calls.repartition(order).sortWithinPartitions(order).write.mode("overwrite").parquet(path)
    return path


def run_enrichment(pf: Portfolio, base: str) -> str:
    scored = f"{base}/scored"
    jobs.start_enrichment(
        pf.spark, land_calls(pf, base), scored, f"{base}/ckpt-enrich", jobs.CATCH_UP
    ).awaitTermination()
    return scored


@stream_query
def stream_enrich(pf: Portfolio) -> DataFrame:
    scored = run_enrichment(pf, work_folder(pf.spark, "enrich"))
    return jobs.read_scored(pf.spark, scored).select(*INSIGHT_COLUMNS).drop("raw_extract_full")


@stream_query
def stream_transitions(pf: Portfolio) -> DataFrame:
    base = work_folder(pf.spark, "transitions")
    scored = run_enrichment(pf, base)
    out = f"{base}/transitions"
    jobs.start_transitions(pf.spark, scored, out, f"{base}/ckpt-pairs", jobs.CATCH_UP).awaitTermination()
    return jobs.read_transitions(pf.spark, out)


def run_refresh(pf: Portfolio) -> str:
    base = work_folder(pf.spark, "refresh")
    scored = run_enrichment(pf, base)
    out = f"{base}/published"
    jobs.start_refresh(pf, scored, out, f"{base}/ckpt-refresh", jobs.CATCH_UP).awaitTermination()
    return out


def refreshed(pf: Portfolio) -> str:
    """One refresh per portfolio, for the queries that only read what it published."""
    if "refreshed" not in pf.__dict__:
        pf.__dict__["refreshed"] = run_refresh(pf)
    return pf.__dict__["refreshed"]


@stream_query
def refresh_cycle(pf: Portfolio) -> DataFrame:
    return jobs.current(pf.spark, refreshed(pf), "customer_360")


@stream_query
def maintained_kpis(pf: Portfolio) -> DataFrame:
    """The indicators from totals to which each refresh adds what it changes."""
    return maintained.kpis(jobs.current(pf.spark, refreshed(pf), "portfolio_totals"))


@stream_query
def maintained_class_counts(pf: Portfolio) -> DataFrame:
    kept = jobs.current(pf.spark, refreshed(pf), "portfolio_totals")
    return kept.select("borrower_asset_class", F.col("borrowers").alias("n"))


@stream_query
def maintained_flight_risk_topk(pf: Portfolio) -> DataFrame:
    """The first 20 flight risks from the reserve, without a look at the 360 table."""
    return maintained.best(jobs.current(pf.spark, refreshed(pf), "flight_risk_reserve"), maintained.TOP)


@stream_query
def refresh_queue(pf: Portfolio) -> DataFrame:
    """The task queue after the published recommendations were reviewed."""
    out = run_refresh(pf)
    recs = jobs.current(pf.spark, out, "nba_recommendation")
    jobs.decide(pf, out, sample_decisions(recs, pf.p))
    return jobs.current(pf.spark, out, "team_task_queue")
