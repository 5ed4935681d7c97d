"""Incremental versions of enrichment, call pairing and the refresh of recommendations.

Queries chained through files: new transcripts are scored row by row; each micro-batch of scored
calls is paired with the ends of the stored runs around it and refreshes the trajectory, recommendations,
task queue and 360 rows of the borrowers it touches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerloom.operators import actions, call_runs, customer360, enrichment, rules, trajectory
from ledgerloom.operators.loan_book import future_interest
from ledgerloom.plans.portfolio import Portfolio
from ledgerloom.sources.tables import ENTITY_SCHEMAS
from ledgerloom.streaming import maintained
from ledgerloom.streaming.store import Store, fitting_buckets

LIVE = {"processingTime": "1 minute"}
CATCH_UP = {"availableNow": True}


def read_calls(spark: SparkSession, in_dir: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(ENTITY_SCHEMAS["call_transcript"])
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(in_dir)


def scored_schema(spark: SparkSession) -> StructType:
    empty = spark.createDataFrame([], ENTITY_SCHEMAS["call_transcript"])
    return enrichment.scored_calls(empty).schema


def start_enrichment(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Score newly landed transcripts, and only those.

    Scoring is stateless, so arrival order does not matter and nothing is dropped, however late
    it lands; ``read_scored`` takes each repeated interaction once.
    """
    return (
        enrichment.scored_calls(read_calls(spark, in_dir, max_files))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or LIVE))
        .start()
    )


def of_borrowers(df: DataFrame, touched: DataFrame | None) -> DataFrame:
    return df if touched is None else df.join(touched, "borrower_id", "left_semi")


def read_scored(spark: SparkSession, scored_dir: str, touched: DataFrame | None = None) -> DataFrame:
    """Scored calls stored so far, each interaction once.  Scoring is a function of the row,
    so copies of one interaction are equal and any of them will do."""
    stored = spark.read.schema(scored_schema(spark)).parquet(scored_dir)
    return of_borrowers(stored, touched).dropDuplicates(["interaction_id"])


# --- calls, pairs and summaries ------------------------------------------------------------
class Intake:
    """A batch of scored calls added to a version: new calls and the pairs they complete are appended; the runs
    and the summary of the batch's borrowers are merged with the stored ones.  Neither stored calls nor stored
    pairs are read."""

    def __init__(self, store: Store, version: int, batch: DataFrame, buckets: list[int] | None, touched: DataFrame):
        self.store, self.version, self.buckets, self.touched = store, version, buckets, touched
        runs = self._old("call_run")
        fresh = store.append(version, "scored_call", call_runs.unheard(batch, runs).select(*batch.columns))
        nodes = call_runs.single_runs(fresh)
        nodes = nodes if runs is None else nodes.unionByName(runs)
        pairs = store.append(version, "call_transition", call_runs.completed_pairs(nodes))
        summary, old = trajectory.partial_summary(fresh, pairs), self._old("trajectory_state")
        summary = summary if old is None else trajectory.merged_summaries(summary, old)
        self.appended = {"scored_call": fresh, "call_transition": pairs}
        self.tables = {"call_run": self._put("call_run", call_runs.joined_runs(nodes)), "trajectory_state": self._put("trajectory_state", summary)}

    def _old(self, name: str) -> DataFrame | None:
        rows = self.store.read(name, self.buckets, self.version)
        return None if rows is None else of_borrowers(rows, self.touched)

    def _put(self, name: str, fresh: DataFrame) -> DataFrame:
        kept = self.store.read(name, self.buckets, self.version)
        if kept is not None:
            fresh = fresh.unionByName(kept.join(self.touched, "borrower_id", "left_anti").select(*fresh.columns))
        return self.store.write(self.version, name, fresh)


def borrowers_of(store: Store, version: int, batch: DataFrame) -> DataFrame:
    return store.append(version, "touched", batch.filter("borrower_id IS NOT NULL").select("borrower_id").distinct())


def first_version(store: Store, checkpoint: str) -> int:
    """The version of a checkpoint's batch 0, fixed when the checkpoint is new.

    It is kept with the checkpoint.  If that is lost, its successor starts above everything
    published so far, and re-reads all calls.
    """
    spark, path = store.spark, f"{checkpoint}/first_version"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        spark.range(1).selectExpr(f"CAST({store.next_version()} AS BIGINT) AS version").coalesce(1).write.mode(
            "overwrite"
        ).parquet(path)
    return spark.read.schema("version bigint").parquet(path).first()[0]


def _start(
    store: Store, scored_dir: str, checkpoint: str, on_batch, trigger: dict | None, max_files: int | None
) -> StreamingQuery:
    first = first_version(store, checkpoint)

    def body(batch: DataFrame, batch_id: int) -> None:
        """Runs at least once per batch; the same batch writes the same version again."""
        if not batch.isEmpty():
            own = Store(batch.sparkSession, store.folder, store.buckets)
            on_batch(own, first + batch_id, batch)

    reader = store.spark.readStream.schema(scored_schema(store.spark))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.parquet(scored_dir)
        .writeStream.foreachBatch(body)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or LIVE))
        .start()
    )


def start_transitions(
    spark: SparkSession, scored_dir: str, out_dir: str, checkpoint: str, trigger: dict | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Pair each call with the one before it, in whatever order the two arrive.

    A batch meets the stored runs of the buckets it touches; see ``call_runs``.
    """

    def on_batch(store: Store, version: int, batch: DataFrame) -> None:
        buckets = store.buckets_of(batch)
        taken = Intake(store, version, batch, buckets, borrowers_of(store, version, batch))
        store.commit(version, taken.tables, buckets, taken.appended)

    return _start(Store(spark, out_dir), scored_dir, checkpoint, on_batch, trigger, max_files)


def read_transitions(spark: SparkSession, out_dir: str) -> DataFrame:
    return current(spark, out_dir, "call_transition")


def current(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    return Store(spark, out_dir).read(name)


# --- refresh -------------------------------------------------------------------------
class Cycle:
    """One version of the published tables: what it reads, merges and writes."""

    def __init__(self, pf: Portfolio, store: Store, version: int, touched: DataFrame | None):
        self.pf, self.store, self.version, self.touched = pf, store, version, touched
        self.buckets = None if touched is None else store.buckets_of(touched)
        self.tables: dict[str, DataFrame] = {}
        self.appended: dict[str, DataFrame] = {}
        self.replaced: dict[str, DataFrame] = {}

    def old(self, name: str) -> DataFrame | None:
        """Rows of the touched borrowers as published before."""
        rows = self.store.read(name, self.buckets, self.version)
        return None if rows is None else of_borrowers(rows, self.touched)

    def put(self, name: str, fresh: DataFrame) -> DataFrame:
        """Write the touched borrowers' new rows beside their neighbours' old ones."""
        rows, kept = fresh, self.store.read(name, self.buckets, self.version)
        if self.touched is not None and kept is not None:
            rows = rows.unionByName(kept.join(self.touched, "borrower_id", "left_anti").select(*fresh.columns))
        self.tables[name] = self.store.write(self.version, name, rows)
        return of_borrowers(self.tables[name], self.touched)

    def hand_over(self, recs: DataFrame, log: DataFrame) -> DataFrame:
        """Publish recommendations and log, purge the queue of what is gone and top it up."""
        recs = self.put("nba_recommendation", recs)
        self.put("nba_decision_log", log.join(recs.select("recommendation_id", "borrower_id"), "recommendation_id"))
        queue = self.old("team_task_queue")
        queue = queue if queue is None else actions.purge_orphans(queue, recs)
        self.put("team_task_queue", actions.create_team_tasks(recs, queue, self.pf.p))
        return recs

    def show(self, summary: DataFrame, recs: DataFrame) -> None:
        loans, state = of_borrowers(self.pf.scored_loans, self.touched), of_borrowers(self.pf.state, self.touched)
        ltv = future_interest(of_borrowers(self.pf.loans, self.touched))
        self.maintain(self.put("customer_360", customer360.customer_360(state, loans, ltv, summary, recs)))

    def whole(self, name: str) -> DataFrame:
        """All rows as this version will publish them."""
        own = self.tables[name]
        if self.buckets is None:
            return own
        others = [b for b in range(self.store.buckets) if b not in set(self.buckets)]
        kept = self.store.read(name, others, self.version) if others else None
        return own if kept is None else own.unionByName(kept.select(*own.columns))

    def maintain(self, now: DataFrame) -> None:
        """Totals and the top of the flight risks, from the touched borrowers' old and new rows."""
        store, version, before = self.store, self.version, self.old("customer_360")

        def write(rows: DataFrame) -> DataFrame:
            return store.append(version, "flight_risk_reserve", rows)

        kept, reserve = (store.read(n, before=version) for n in ("portfolio_totals", "flight_risk_reserve"))
        if self.touched is None or before is None or kept is None or reserve is None:
            totals = store.append(version, "portfolio_totals", maintained.totals(now))
            rows, floor = maintained.filled_reserve(now, write)
        else:
            change = maintained.added(kept, maintained.totals(before, -1), maintained.totals(now))
            totals = store.append(version, "portfolio_totals", change)
            known = totals.agg(F.sum("flight_risks")).first()[0] or 0
            floors = store.read("flight_risk_floor", before=version).collect()
            rows, floor, _ = maintained.kept_reserve(
                reserve, floors[0] if floors else None, self.touched, maintained.flight_risks(now),
                lambda: self.whole("customer_360"), write, known,
            )
        edge = rows.select(maintained.VALUE, "borrower_id").schema
        floor = store.append(version, "flight_risk_floor", self.pf.spark.createDataFrame([floor] if floor else [], edge))
        self.replaced |= {"portfolio_totals": totals, "flight_risk_reserve": rows, "flight_risk_floor": floor}

    def commit(self) -> None:
        self.store.commit(self.version, self.tables, self.buckets, self.appended, self.replaced)


def refresh(pf: Portfolio, store: Store, version: int, batch: DataFrame | None = None) -> None:
    """One refresh cycle, for the borrowers of a batch of scored calls or, without one, for all.

    A borrower's rows depend on that borrower's data alone, so refreshing the touched borrowers
    gives what a full rebuild would.  Each step reads what the step before it wrote, and the rules
    run once: recommendations and log come from the same staged rows.  Decisions and explanations
    that still hold are carried forward; only new or changed recommendations are explained afresh.
    """
    touched = None if batch is None else borrowers_of(store, version, batch)
    cycle = Cycle(pf, store, version, touched)
    if batch is None:
        batch = pf.spark.createDataFrame([], scored_schema(pf.spark))
    taken = Intake(store, version, batch, cycle.buckets, batch.select("borrower_id") if touched is None else touched)
    cycle.tables |= taken.tables
    cycle.appended |= taken.appended
    summary = trajectory.trajectory_rows(of_borrowers(taken.tables["trajectory_state"], touched))
    summary = cycle.put("trajectory", summary)
    loans, state, mandates = (of_borrowers(t, touched) for t in (pf.scored_loans, pf.state, pf.mandates))
    candidates = rules.nba_candidates(loans, state, mandates, summary)
    staged = store.write(version, "staged", rules.stage_recommendations(pf.spark, candidates, pf.p))
    recs, log = staged.select(*rules.RECOMMENDATION_COLUMNS), rules.decision_log(staged)
    old_recs, old_log = cycle.old("nba_recommendation"), cycle.old("nba_decision_log")
    if old_recs is not None and old_log is not None:
        recs, log = actions.carry_forward(recs, log, old_recs, old_log)
    cycle.show(summary, cycle.hand_over(actions.add_rationale(recs), log))
    cycle.commit()


def decide(pf: Portfolio, out_dir: str, decisions: DataFrame) -> DataFrame:
    """Apply human decisions to the published tables as a new version; returns those refused."""
    store = Store(pf.spark, out_dir)
    version = store.next_version()
    published = store.read("nba_recommendation")
    touched = published.join(decisions.select("recommendation_id"), "recommendation_id", "left_semi")
    cycle = Cycle(pf, store, version, borrowers_of(store, version, touched))
    log = cycle.old("nba_decision_log").select(*rules.LOG_COLUMNS)
    recs, log, refused = actions.apply_decisions(cycle.old("nba_recommendation"), log, decisions)
    refused = store.write(version, "refused", refused.withColumn("borrower_id", F.lit("")))
    cycle.show(cycle.old("trajectory"), cycle.hand_over(recs, log))
    cycle.commit()
    return refused.drop("borrower_id")


def start_refresh(
    pf: Portfolio, scored_dir: str, out_dir: str, checkpoint: str, trigger: dict | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Publish a version in which no call was heard, and refresh on every batch of scored calls."""
    store = Store(pf.spark, out_dir, fitting_buckets(pf.state.count()))
    if not store.versions():
        refresh(pf, store, 0)

    def on_batch(store: Store, version: int, batch: DataFrame) -> None:
        refresh(pf, store, version, batch)

    return _start(store, scored_dir, checkpoint, on_batch, trigger, max_files)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)
