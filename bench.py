"""Time the headline queries; prints one JSON line.

``queries`` are cold: each starts from the base tables with a new portfolio, so the tables it needs
are built and written within its own time.  ``warm`` repeats those that read published tables over
tables that were published once (``publish``) and opened.  Results go to a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerloom.plans.catalog import QUERIES  # noqa: E402
from ledgerloom.plans.portfolio import Portfolio  # noqa: E402
from ledgerloom.session import build_session  # noqa: E402
from ledgerloom.streaming.catalog import STREAM_QUERIES  # noqa: E402

HEADLINES = [
    "loan_account",
    "mandates",
    "amortization",
    "ltv",
    "borrower_state",
    "loan_economics",
    "transcript_insight",
    "call_transitions",
    "trajectory",
    "nba_recommendations",
    "customer_360",
    "vq_flight_risk_topk",
    "carry_decision",
    "team_tasks",
    "standing_assertions",
    "signal_combination",
    "gnpa_summary",
    "spend_daily",
    "income_corroboration",
    "stream_transitions",
    "refresh_cycle",
]

WARM = [
    "loan_economics", "trajectory", "nba_recommendations", "customer_360", "vq_flight_risk_topk", "carry_decision",
    "team_tasks", "gnpa_summary", "borrower_lookup", "borrower_detail", "action_queue", "semantic_cross_entity",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        "ledgerloom-bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    Portfolio(spark, sf_dir).base("customer").count()  # start the executors
    available = {**QUERIES, **STREAM_QUERIES}
    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        available[name](Portfolio(spark, sf_dir)).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    published = Portfolio(spark, sf_dir)
    start = time.perf_counter()
    folder = published.publish()
    publish = round(time.perf_counter() - start, 3)
    warm = {}
    for name in WARM:
        start = time.perf_counter()
        available[name](Portfolio.open(spark, folder, sf_dir)).write.format("noop").mode("overwrite").save()
        warm[name] = round(time.perf_counter() - start, 3)
    line = {
        "metric": "total_seconds_headline_queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "publish": publish,
        "warm": warm,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
