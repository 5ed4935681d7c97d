"""The portfolio from base tables to recommendations."""

from __future__ import annotations

import json
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.config import Params
from ledgerloom.functions.columns import bucket, moment, pick
from ledgerloom.operators import (
    actions,
    customer360,
    digests,
    documents,
    economics,
    enrichment,
    loan_book,
    ranking,
    rules,
    search,
    trajectory,
)
from ledgerloom.operators.borrower_state import build_borrower_state
from ledgerloom.plans import quality
from ledgerloom.session import work_folder
from ledgerloom.sources import entities
from ledgerloom.sources.tables import conformed, listing, read_base, read_entity, read_manifest, write_manifest

GIVEN = {"borrower", "bureau_tradeline", "loan_account", "mandate", "call_transcript"}

#: Published tables and the properties that hold them, each after those it is built from.
PUBLISHED = {
    "borrower_slices": "sliced_borrowers",
    "tradeline_slices": "sliced_tradelines",
    "call_slices": "sliced_calls",
    "loan_account": "loans",
    "mandate_slices": "sliced_mandates",
    "mandate": "mandates",
    "borrower_state": "state",
    "scored_loans": "scored_loans",
    "scored_calls": "scored_calls",
    "trajectory": "trajectory",
    "recommendations": "staged",
    "recommendations_before": "earlier_staged",
    "customer_360": "published_360",
    "name_grams": "name_grams",
    "gram_counts": "gram_counts",
    "baseline": "baseline_rows",
    "baseline_digests": "baseline_tree",
}


class published_table(cached_property):
    """A property that is written as a table.  In an opened portfolio it is read by the schema in the manifest,
    and nothing behind it is built, so a lookup costs its own plan only."""

    def __get__(self, pf, owner=None):
        name = None if pf is None else NAME_OF[self.attrname]
        if pf is not None and name in pf._published and self.attrname not in pf.__dict__:
            schema = StructType.fromJson(json.loads(pf._published[name]))
            pf.__dict__[self.attrname] = pf.spark.read.schema(schema).parquet(f"{pf.folder}/{name}")
        return super().__get__(pf, owner)


NAME_OF = {attribute: name for name, attribute in PUBLISHED.items()}


class Portfolio:
    """Entity and result tables over one set of base tables.

    Tables that several others read (loans, mandates, state, scored loans, scored calls,
    trajectory, staged recommendations) are written once to the shared working folder and
    read back, as a warehouse would create them.  That keeps plans short, lets later scans read only the
    columns they use, and a lost executor costs no more than its running tasks.  All other
    properties are lazy.
    """

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        params: Params | None = None,
        folder: str | None = None,
        given: dict[str, DataFrame | str] | None = None,
        partitions: int | None = None,
    ):
        """``given`` brings entity tables (``borrower``, ``bureau_tradeline``, ``loan_account``,
        ``mandate``, ``call_transcript``) as DataFrames or paths; only what is not given is
        derived from the base tables or drawn.  ``partitions`` sets the shuffle partitions of the
        tables written here.
        """
        self.spark = spark
        self.sf_dir = sf_dir
        self.p = params or Params()
        self._folder = folder
        self.given = dict(given or {})
        self._partitions = partitions
        self._published: dict[str, str] = {}
        self._watched: dict[str, Observation] = {}
        unknown = set(self.given) - GIVEN
        if unknown:
            raise ValueError(f"no such entity table: {sorted(unknown)}")

    @cached_property
    def folder(self) -> str:
        return self._folder or work_folder(self.spark, "portfolio")

    def _table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        setting = "spark.sql.shuffle.partitions"
        before = self.spark.conf.get(setting)
        if self._partitions is not None:
            self.spark.conf.set(setting, self._partitions)
        rows, seen = quality.watched(df, name)
        try:
            rows.write.mode("overwrite").parquet(path)
        finally:
            self.spark.conf.set(setting, before)
        if seen is not None:
            self._watched[name] = seen
        return self.spark.read.schema(df.schema).parquet(path)

    def written_faults(self, name: str) -> dict[str, int]:
        """``rows`` and the faulty rows per check, counted while the table was written; empty if it has no
        rules or was not written by this portfolio."""
        seen = self._watched.get(name)
        return {} if seen is None else {check: n or 0 for check, n in seen.get.items()}

    def _by_borrower(self, df: DataFrame, name: str) -> DataFrame:
        """A table whose files and row groups hold ranges of borrowers, so a lookup reads few."""
        return self._table(df.repartitionByRange("borrower_id").sortWithinPartitions("borrower_id"), name)

    def _entity(self, name: str) -> DataFrame | None:
        given = self.given.get(name)
        if given is None:
            return None
        return read_entity(self.spark, given, name) if isinstance(given, str) else conformed(given, name)

    # --- published tables ---------------------------------------------------
    def _facts(self) -> dict[str, str]:
        given = {k: v if isinstance(v, str) else "a frame" for k, v in self.given.items()}
        inputs = {"base": listing(self.spark, self.sf_dir)}
        inputs |= {k: listing(self.spark, v) for k, v in self.given.items() if isinstance(v, str)}
        return {"params": repr(self.p), "given": repr(sorted(given.items())), "inputs": repr(sorted(inputs.items()))}

    def publish(self) -> str:
        """Write every table that has several readers, then the manifest; returns the folder.

        Rules of single rows are counted by the writing itself; the first table that breaks one ends
        the publication, and without a manifest the folder cannot be opened.
        """
        tables = {}
        for name in PUBLISHED:
            tables[name] = getattr(self, PUBLISHED[name]).schema.json()
            broken = {check: n for check, n in self.written_faults(name).items() if check != "rows" and n}
            if broken:
                raise ValueError(f"{name} breaks its rules and nothing was published: {broken}")
        write_manifest(self.spark, self.folder, self._facts() | {f"table {n}": s for n, s in tables.items()})
        return self.folder

    @classmethod
    def open(
        cls, spark: SparkSession, folder: str, sf_dir: str, params: Params | None = None,
        given: dict[str, DataFrame | str] | None = None,
    ) -> Portfolio:
        """A portfolio over published tables, in any later application; nothing is rebuilt.

        Refused unless parameters, given tables and the files of the inputs are those of the
        manifest.
        """
        pf = cls(spark, sf_dir, params, folder, given)
        facts = read_manifest(spark, folder)
        for name, value in pf._facts().items():
            if facts.get(name) != value:
                raise ValueError(f"{folder} was published with other {name}")
        pf._published = {n.removeprefix("table "): s for n, s in facts.items() if n.startswith("table ")}
        return pf

    def base(self, name: str) -> DataFrame:
        return read_base(self.spark, self.sf_dir, name)

    # --- entities -----------------------------------------------------------
    @cached_property
    def borrowers(self) -> DataFrame:
        given = self._entity("borrower")
        return entities.borrowers(self.spark, self.sf_dir, self.p) if given is None else given

    @cached_property
    def tradelines(self) -> DataFrame:
        given = self._entity("bureau_tradeline")
        return entities.tradelines(self.spark, self.sf_dir, self.p) if given is None else given

    @published_table
    def sliced_tradelines(self) -> DataFrame:
        keys = self.tradelines.select("tradeline_id", "borrower_id")
        return self._table(ranking.cut_by_range(keys, "tradeline_id"), "tradeline_slices")

    @published_table
    def sliced_calls(self) -> DataFrame:
        """Call events cut into even ranges along borrower and time, from which they are numbered."""
        events = entities.call_events(self.spark, self.sf_dir)
        return self._table(ranking.cut_by_range(events, *entities.CALL_ORDER), "call_slices")

    @cached_property
    def calls(self) -> DataFrame:
        given = self._entity("call_transcript")
        return entities.calls(self.spark, self.sliced_calls, self.p) if given is None else given

    @cached_property
    def ground_truth(self) -> DataFrame:
        return entities.ground_truth(self.spark, self.sf_dir)

    # --- spine --------------------------------------------------------------
    @published_table
    def sliced_borrowers(self) -> DataFrame:
        """Borrower keys cut into even ranges, from which loans are numbered."""
        keys = self.borrowers.select("borrower_id", "bureau_score_band")
        return self._table(ranking.cut_by_range(keys, "borrower_id"), "borrower_slices")

    @cached_property
    def loans_unwritten(self) -> DataFrame:
        """The loan book for a query that reads it once."""
        given = self._entity("loan_account")
        if given is not None:
            return given
        return loan_book.build_loan_account(self.spark, self.sliced_borrowers, self.p)

    @published_table
    def loans(self) -> DataFrame:
        return self._table(self.loans_unwritten, "loan_account")

    @published_table
    def sliced_mandates(self) -> DataFrame:
        keys = ranking.cut_by_range(loan_book.mandated_loans(self.loans), "loan_id")
        return self._table(keys, "mandate_slices")

    @published_table
    def mandates(self) -> DataFrame:
        given = self._entity("mandate")
        if given is None:
            given = loan_book.build_mandate(self.loans, self.p, self.sliced_mandates)
        return self._table(given, "mandate")

    @published_table
    def state(self) -> DataFrame:
        state = build_borrower_state(self.borrowers, self.loans, self.tradelines, self.mandates, self.p)
        return self._table(state, "borrower_state")

    # --- economics ------------------------------------------------------------
    @published_table
    def scored_loans(self) -> DataFrame:
        return self._table(economics.score_loans(self.spark, self.loans, self.state, self.p), "scored_loans")

    @cached_property
    def loan_economics(self) -> DataFrame:
        return economics.loan_economics(self.scored_loans)

    @cached_property
    def schedule(self) -> DataFrame:
        return loan_book.amortization(self.loans)

    @cached_property
    def ltv(self) -> DataFrame:
        return loan_book.future_interest(self.loans)

    # --- calls ------------------------------------------------------------------
    @cached_property
    def insight(self) -> DataFrame:
        return enrichment.enrich_transcripts(self.calls)

    @published_table
    def scored_calls(self) -> DataFrame:
        return self._table(enrichment.scored_calls(self.calls), "scored_calls")

    @cached_property
    def transitions(self) -> DataFrame:
        return trajectory.call_transitions(self.scored_calls)

    @published_table
    def trajectory(self) -> DataFrame:
        summary = trajectory.trajectory_summary(self.scored_calls, self.transitions)
        return self._table(summary, "trajectory")

    # --- recommendations ----------------------------------------------------------
    @cached_property
    def candidates(self) -> DataFrame:
        return rules.nba_candidates(self.scored_loans, self.state, self.mandates, self.trajectory)

    @published_table
    def staged(self) -> DataFrame:
        return self._by_borrower(rules.stage_recommendations(self.spark, self.candidates, self.p), "recommendations")

    @cached_property
    def recs(self) -> DataFrame:
        return self.staged.select(*rules.RECOMMENDATION_COLUMNS)

    @cached_property
    def log(self) -> DataFrame:
        return rules.decision_log(self.staged)

    @published_table
    def earlier_staged(self) -> DataFrame:
        """The generation before any call was heard: same rules, no trajectory."""
        before = rules.nba_candidates(self.scored_loans, self.state, self.mandates, None)
        return self._by_borrower(rules.stage_recommendations(self.spark, before, self.p), "recommendations_before")

    @cached_property
    def earlier_recs(self) -> DataFrame:
        return actions.add_rationale(self.earlier_staged.select(*rules.RECOMMENDATION_COLUMNS))

    @cached_property
    def earlier_log(self) -> DataFrame:
        return rules.decision_log(self.earlier_staged)

    @cached_property
    def decisions(self) -> DataFrame:
        """Reviewers' decisions on the earlier generation, some of them not acceptable."""
        return sample_decisions(self.earlier_recs, self.p)

    @cached_property
    def customer_360(self) -> DataFrame:
        return customer360.customer_360(self.state, self.scored_loans, self.ltv, self.trajectory, self.recs)

    @published_table
    def published_360(self) -> DataFrame:
        """The same rows as a table, which the application queries read."""
        return self._by_borrower(self.customer_360, "customer_360")

    @published_table
    def name_grams(self) -> DataFrame:
        """Posting lists of the borrowers' ids and names, each in few row groups."""
        grams = search.postings(self.published_360).repartitionByRange("gram", "borrower_id")
        return self._table(grams.sortWithinPartitions("gram", "borrower_id"), "name_grams")

    @published_table
    def gram_counts(self) -> DataFrame:
        counts = search.gram_counts(self.name_grams)
        return self._table(counts.repartitionByRange("gram").sortWithinPartitions("gram"), "gram_counts")

    # --- the kept baseline -----------------------------------------------------------------
    def digested(self, recs: DataFrame, depth: int) -> DataFrame:
        return digests.with_leaf(quality.baseline(recs), quality.DECISION_KEY, depth)

    @published_table
    def baseline_rows(self) -> DataFrame:
        """What was decided, kept with the published tables: sorted by leaf of the digest tree."""
        rows = self.digested(self.recs, digests.depth_for(self.recs.count()))
        return self._table(rows.repartitionByRange("leaf").sortWithinPartitions("leaf"), "baseline")

    @published_table
    def baseline_tree(self) -> DataFrame:
        depth = digests.depth_for(self.recs.count())
        return self._table(digests.tree(self.baseline_rows, quality.DECISION_COLUMNS, depth).coalesce(1), "baseline_digests")

    def changed_since(self, earlier: Portfolio, recs: DataFrame | None = None) -> DataFrame:
        """Decisions that differ from an earlier, published run; equal runs cost a look at two roots."""
        depth = digests.depth_of(earlier.baseline_tree)
        rows = self.digested(self.recs if recs is None else recs, depth)
        return quality.difference_by_digest(earlier.baseline_rows, earlier.baseline_tree, rows, depth)

    # --- a second decision and a second build ------------------------------------------------
    @cached_property
    def decided_again(self) -> DataFrame:
        """The rules over the same stored inputs, dealt over another number of partitions."""
        partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions")) + 3
        loans = self.scored_loans.repartition(partitions, "loan_id")
        candidates = rules.nba_candidates(loans, self.state, self.mandates, self.trajectory)
        return self._table(rules.stage_recommendations(self.spark, candidates, self.p), "decided_again")

    @cached_property
    def rebuilt(self) -> Portfolio:
        """The same inputs built again in another folder, with another number of partitions: what
        it recommends is the stored baseline that this build is compared with."""
        partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions")) + 3
        return Portfolio(self.spark, self.sf_dir, self.p, None, self.given, partitions)

    @cached_property
    def baseline(self) -> DataFrame:
        return self._table(quality.baseline(self.rebuilt.recs), "determinism_baseline")

    # --- papers ---------------------------------------------------------------------
    @cached_property
    def papers(self) -> DataFrame:
        return entities.papers(self.borrowers, self.loans)

    @cached_property
    def paper_fields(self) -> DataFrame:
        return documents.extract_fields(self.papers)


def sample_decisions(recs: DataFrame, p: Params) -> DataFrame:
    """A stand-in for reviewers: half of the recommendations decided, a tenth with a word
    that is no decision."""
    draw = bucket(["recommendation_id"], "decide", 10)
    return recs.filter(draw < 6).select(
        "recommendation_id",
        pick([(draw < 3, "APPROVED"), (draw < 5, "REJECTED")], "approved").alias("decision"),
        F.concat(F.lit("reviewer_"), bucket(["recommendation_id"], "who", 7).cast("string")).alias("decided_by"),
        moment(p.run_at).alias("decided_at"),
    )
