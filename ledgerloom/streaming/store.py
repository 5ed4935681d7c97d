"""Published tables that a micro-batch can change without reading their history.

Tables of events are appended to: a version adds its new rows and touches no others.  Tables of borrowers have
a few rows for each ``borrower_id``, whose hash names a bucket; a version rewrites whole buckets,
the rows of the touched borrowers anew and those of their neighbours as they were.  The heads of a
version say which versions hold the rows of each table and bucket; they are written last and so
commit the version.  A reader opens the newest heads and only the buckets it wants, so the cost of
a batch follows the buckets it touches, not the number of batches before it.  A borrower whose
rows are gone is gone with the rewritten bucket.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

BUCKETS = 64
PER_BUCKET = 5_000  # borrowers, when a store is made
HEADS = "name string, bucket bigint, version bigint, schema string"


def fitting_buckets(borrowers: int) -> int:
    return max(1, -(-borrowers // PER_BUCKET))


class Store:
    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        """``buckets`` counts for a new store; an existing one keeps its own number."""
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._heads: dict[int, dict] = {}
        heads = self.heads()
        self.buckets = int(heads["", -1][0]) if heads else buckets

    # --- versions -----------------------------------------------------------------------
    def versions(self) -> list[int]:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/heads")
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        names = [(s.getPath(), s.getPath().getName()) for s in fs.listStatus(path)]
        done = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return sorted(int(n.partition("=")[2]) for p, n in names if "=" in n and fs.exists(done(p, "_SUCCESS")))

    def next_version(self) -> int:
        return max(self.versions(), default=-1) + 1

    def heads(self, before: int | None = None) -> dict[tuple[str, int], tuple[int, str]]:
        """The newest committed heads below ``before``; at ``("", -1)`` the number of buckets."""
        known = [v for v in self.versions() if before is None or v < before]
        if not known:
            return {}
        if known[-1] not in self._heads:  # what is committed does not change
            rows = self.spark.read.schema(HEADS).parquet(f"{self.folder}/heads/version={known[-1]}")
            self._heads = {known[-1]: {(r["name"], r["bucket"]): (r["version"], r["schema"]) for r in rows.collect()}}
        return dict(self._heads[known[-1]])

    # --- rows -----------------------------------------------------------------------------
    def bucket(self):
        return F.pmod(F.xxhash64("borrower_id"), F.lit(self.buckets))

    def buckets_of(self, borrowers: DataFrame) -> list[int]:
        return sorted(r[0] for r in borrowers.select(self.bucket()).distinct().collect())

    def read(self, name: str, buckets: list[int] | None = None, before: int | None = None) -> DataFrame | None:
        """Current rows of a table, or of some of its buckets; None if there is no such table."""
        heads = self.heads(before)
        if (name, -1) not in heads:
            return None
        schema = StructType.fromJson(json.loads(heads[name, -1][1]))
        appended = [v for (table, bucket), (v, _) in heads.items() if table == name and bucket < -1]
        if appended:
            paths = [f"{self.folder}/{name}/version={v}" for v in sorted(appended)]
            return self.spark.read.schema(schema).parquet(*paths)
        by_version: dict[int, list[int]] = {}
        for (table, bucket), (version, _) in heads.items():
            if table == name and bucket >= 0 and (buckets is None or bucket in buckets):
                by_version.setdefault(version, []).append(bucket)
        if not by_version:
            return self.spark.createDataFrame([], schema)
        base = f"{self.folder}/{name}"
        wanted = F.lit(False)
        for version, own in sorted(by_version.items()):
            wanted = wanted | ((F.col("version") == version) & F.col("bucket").isin(own))
        full = StructType([*schema.fields]).add("version", LongType()).add("bucket", LongType())
        rows = self.spark.read.schema(full).option("basePath", base)
        return rows.parquet(*[f"{base}/version={v}" for v in sorted(by_version)]).filter(wanted).drop("version", "bucket")

    def write(self, version: int, name: str, rows: DataFrame) -> DataFrame:
        """Write a version's rows, not yet committed; the same version again replaces them.

        A bucket is one file, and so a version as many as there are buckets, unless it is larger than the advised
        size of a partition: then adaptive execution splits it over several tasks."""
        path = f"{self.folder}/{name}/version={version}"
        dealt = rows.withColumn("bucket", self.bucket()).hint("rebalance", "bucket")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path).select(*rows.columns)

    def append(self, version: int, name: str, rows: DataFrame) -> DataFrame:
        """Write a version's new rows of a table of events, not yet committed."""
        path = f"{self.folder}/{name}/version={version}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def commit(
        self, version: int, tables: dict[str, DataFrame], buckets: list[int] | None,
        appended: dict[str, DataFrame] | None = None, replaced: dict[str, DataFrame] | None = None,
    ) -> None:
        """Make ``tables`` as written the rows of ``buckets`` (None: of all), and add what was appended; what was
        appended to take the place of a small table as a whole is its only content from now on."""
        heads = self.heads(version)
        heads["", -1] = (self.buckets, "")
        for name, rows in tables.items():
            heads[name, -1] = (version, rows.schema.json())
            for b in range(self.buckets) if buckets is None else buckets:
                heads[name, b] = (version, "")
        heads = {key: v for key, v in heads.items() if key[0] not in (replaced or {})}
        for name, rows in {**(appended or {}), **(replaced or {})}.items():
            heads[name, -1] = (version, rows.schema.json())
            heads[name, -2 - version] = (version, "")
        rows = [(name, b, v, s) for (name, b), (v, s) in sorted(heads.items())]
        self.spark.createDataFrame(rows, HEADS).coalesce(1).write.mode("overwrite").parquet(
            f"{self.folder}/heads/version={version}"
        )
