"""Portfolio totals and the top of the flight risks, kept current by what a refresh changes.

**Totals.** The rows of the touched borrowers as they were count with -1, as they are with +1; the signed sums
are added to the stored totals, of which there is one row for each regulatory class.

**Top.** A reserve holds the first ``RESERVE`` flight risks, more than are ever asked for.  Its floor is the
last place it is known to be complete to: touched borrowers leave it, and enter again if they stand at or above
the floor.  If more leave than enter and fewer than ``TOP`` are left although the totals know of more, the
reserve is filled anew from the whole table, once in many refreshes.  Without a floor it holds all.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOP, RESERVE = 20, 200
RISK_COLUMNS = ["borrower_id", "full_name", "ltv_expected_interest_inr", "bt_risk_score"]
VALUE, OFFERED = "ltv_expected_interest_inr", "bt_retention_value_if_offered_inr"
TOTALS = [
    "borrowers", "flight_risks", "retention_offers", "npa_upgrades", "retention_values", "retention_value_inr", "ltv_values",
    "ltv_value_inr",
]


def totals(rows: DataFrame, sign: int = 1) -> DataFrame:
    """One row per class; what may be missing is summed beside the number of values there are."""
    counted = {
        "borrowers": F.lit(True), "flight_risks": F.col("bt_is_a_flight_risk"), "retention_offers": F.col("has_retention_offer"),
        "npa_upgrades": F.col("is_npa") & F.col("npa_upgrade_eligible"), "retention_values": F.col(OFFERED).isNotNull(),
        "ltv_values": F.col(VALUE).isNotNull(),
    }
    sums = {"retention_value_inr": OFFERED, "ltv_value_inr": VALUE}
    zero = F.lit(0).cast("decimal(38,2)")
    found = rows.groupBy("borrower_asset_class").agg(
        *[(sign * F.count_if(c)).cast("bigint").alias(n) for n, c in counted.items()],
        *[(sign * F.coalesce(F.sum(c).cast("decimal(38,2)"), zero)).cast("decimal(38,2)").alias(n) for n, c in sums.items()],
    )
    return found.select("borrower_asset_class", *TOTALS)


def added(*parts: DataFrame) -> DataFrame:
    """Signed totals added up; a class without borrowers is gone."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    kinds = dict(whole.dtypes)
    sums = [F.sum(c).cast(kinds[c]).alias(c) for c in TOTALS]
    return whole.groupBy("borrower_asset_class").agg(*sums).filter("borrowers <> 0")


def kpis(kept: DataFrame) -> DataFrame:
    """The portfolio's indicators from its totals; a sum of no values is NULL, as over the rows."""
    def whole(value: str, n: str) -> Column:
        return F.when(F.sum(n) > 0, F.sum(value))

    return kept.agg(
        F.coalesce(F.sum("flight_risks"), F.lit(0)).alias("flight_risks"),
        F.coalesce(F.sum("retention_offers"), F.lit(0)).alias("retention_offers"),
        whole("retention_value_inr", "retention_values").cast("bigint").alias("total_retention_value_inr"),
        whole("ltv_value_inr", "ltv_values").alias("total_ltv_inr"),
    )


def flight_risks(rows: DataFrame) -> DataFrame:
    return rows.filter("bt_is_a_flight_risk").select(*RISK_COLUMNS)


def best(risks: DataFrame, n: int) -> DataFrame:
    return risks.orderBy(F.desc_nulls_last(VALUE), "borrower_id").limit(n)


def at_or_above(floor) -> Column:
    """Whether a row stands no lower than the floor, in the order of ``best``."""
    value, last, who = F.col(VALUE), floor[VALUE], F.col("borrower_id") <= floor["borrower_id"]
    if last is None:
        return value.isNotNull() | who
    return F.coalesce((value > last) | ((value == last) & who), F.lit(False))


def kept_reserve(
    reserve: DataFrame, floor, touched: DataFrame, came: DataFrame, whole: Callable[[], DataFrame], write: Callable[[DataFrame], DataFrame],
    known: int, top: int = TOP, size: int = RESERVE,
) -> tuple[DataFrame, object, bool]:
    """The reserve after a refresh, as written, its floor, and whether it had to be filled anew.

    ``came`` are the touched borrowers that are flight risks now; ``known`` is how many there are in all."""
    entering = came if floor is None else came.filter(at_or_above(floor))
    rows = write(best(reserve.join(touched, "borrower_id", "left_anti").unionByName(entering), size))
    n = rows.count()
    if n < min(top, known):
        rows, floor = filled_reserve(whole(), write, size)
        return rows, floor, True
    return rows, lowest(rows) if n == size else floor, False


def filled_reserve(whole: DataFrame, write: Callable[[DataFrame], DataFrame], size: int = RESERVE) -> tuple[DataFrame, object]:
    rows = write(best(flight_risks(whole), size))
    return rows, lowest(rows) if rows.count() == size else None


def lowest(rows: DataFrame):
    """The last row in the order of ``best``."""
    found = rows.orderBy(F.asc_nulls_first(VALUE), F.desc("borrower_id")).select(VALUE, "borrower_id").limit(1).collect()
    return found[0] if found else None
