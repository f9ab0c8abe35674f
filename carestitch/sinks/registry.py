"""Surrogate keys that survive further deliveries, and the incremental build of a staging table.

A registry is a log of runs. Each run holds the rows that appeared or went since the run before: a 128-bit digest of the
row, its key, the value the table is split by, and whether the row is there. Known rows keep their key, new ones are
numbered after the last one of their hash bucket, and a row that comes back gets its old key again. Only digests are
shuffled to find the changes; the rows of unchanged splits are neither shuffled nor written.

A run's folder counts once it is complete, and its changes are pending until the table is written. So a job that is
stopped at any point is simply started again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import BUCKET_BITS

DIGEST = ("_digest_1", "_digest_2")
LOG = "_digest_1 bigint, _digest_2 bigint, split string, g_id bigint, live boolean, run int"
COMPLETE, APPLIED = "_SUCCESS", "_APPLIED"


class Registry:
    """The log of one table's keys below a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, *names: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *names)))

    def _fs(self):
        return self._at().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def runs(self) -> list[int]:
        """Complete runs, in order."""
        fs = self._fs()
        if not fs.exists(self._at()):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(self._at()) if s.isDirectory()]
        return sorted(int(n[4:]) for n in names if n.startswith("run-") and fs.exists(self._at(n, COMPLETE)))

    def pending(self) -> list[int]:
        """Complete runs whose changes the table may not show yet."""
        return [r for r in self.runs() if not self._fs().exists(self._at(f"run-{r}", APPLIED))]

    def mark_applied(self, runs: Sequence[int]) -> None:
        for run in runs:
            self._fs().create(self._at(f"run-{run}", APPLIED), True).close()

    def log(self, runs: Sequence[int] | None = None) -> DataFrame:
        """(digest, split, g_id, live, run) of some or all complete runs."""
        parts = [
            self.spark.read.schema(LOG).parquet(f"{self.path}/run-{r}").withColumn("run", F.lit(r))
            for r in (self.runs() if runs is None else runs)
        ]
        out = self.spark.createDataFrame([], LOG)
        for part in parts:
            out = out.union(part)
        return out

    def write(self, changes: DataFrame) -> int:
        run = max(self.runs(), default=0) + 1  # an incomplete folder of that number is replaced
        changes.write.mode("overwrite").parquet(f"{self.path}/run-{run}")
        return run


def with_digest(rows: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """The rows with a digest of their key columns (all by default). Two of 10^11 rows share one with a probability below 10^-16."""
    keys = list(keys or rows.columns)
    nulls = F.concat(*[F.when(F.col(k).isNull(), "0").otherwise("1") for k in keys])  # a hash passes over nulls
    return rows.withColumns({DIGEST[0]: F.xxhash64(F.lit(1), nulls, *keys), DIGEST[1]: F.xxhash64(F.lit(2), *keys, nulls)})


def find_changes(digests: DataFrame, log: DataFrame) -> DataFrame:
    """(digest, split, g_id, live) of the rows that appeared or went.

    Digests and log are dealt by hash bucket once; grouping and numbering happen inside the buckets.
    """
    there = digests.select(*DIGEST, F.col("split").cast("string"), F.lit(None).cast("bigint").alias("g_id"),
                           F.lit(None).cast("boolean").alias("live"), F.lit(None).cast("int").alias("run"))
    both = there.unionByName(log).withColumn("bucket", F.pmod(DIGEST[0], F.lit(1 << BUCKET_BITS))).repartition("bucket")
    state = both.groupBy("bucket", *DIGEST).agg(
        F.max("split").alias("split"), F.min("g_id").alias("known"),
        F.max(F.col("run").isNull()).alias("here"),
        F.max(F.struct("run", "live"))["live"].alias("was_live"),
    )
    last = F.max(F.shiftright("known", BUCKET_BITS)).over(Window.partitionBy("bucket"))
    nth = F.row_number().over(Window.partitionBy("bucket").orderBy(F.col("known").isNotNull(), *DIGEST))
    fresh = F.shiftleft((F.coalesce(last, F.lit(-1)) + nth).cast("bigint"), BUCKET_BITS) + F.col("bucket")
    numbered = state.select(*DIGEST, "split", F.coalesce("known", fresh).alias("g_id"), F.col("here").alias("live"),
                            F.coalesce("was_live", F.lit(False)).alias("was_live"))
    return numbered.filter(F.col("live") != F.col("was_live")).drop("was_live")


def live_ids(log: DataFrame) -> DataFrame:
    """(digest, split, g_id) of the rows that are there after the last run."""
    state = log.groupBy(*DIGEST).agg(
        F.max("split").alias("split"), F.min("g_id").alias("g_id"), F.max(F.struct("run", "live"))["live"].alias("live"))
    return state.filter("live").drop("live")


def with_registered_id(rows: DataFrame, registry: Registry) -> DataFrame:
    """Distinct rows with the key the registry gives them; new rows are registered first."""
    marked = with_digest(rows)
    digests = marked.select(*DIGEST, F.lit(None).cast("string").alias("split")).distinct()
    run = registry.write(find_changes(digests, registry.log()))
    registry.mark_applied([run])  # the caller writes whole tables
    ids = live_ids(registry.log()).select(*DIGEST, "g_id")
    return marked.dropDuplicates(DIGEST).join(ids, list(DIGEST)).select(*rows.columns, "g_id")


def rekeyed(tables: Mapping[str, DataFrame], base: str) -> dict[str, DataFrame]:
    """Staged tables with registered keys in place of their row ids, one registry a table below a folder."""
    return {
        name: with_registered_id(df.drop("g_id"), Registry(df.sparkSession, f"{base.rstrip('/')}/{name}")).select(*df.columns)
        for name, df in tables.items()
    }


@dataclass(frozen=True)
class Increment:
    """What one incremental build did: rows that appeared and went, and the values whose partitions were written."""

    run: int
    added: int
    gone: int
    splits: list[str | None]


def _same(split: Column, values: Sequence[str | None]) -> Column:
    known = [v for v in values if v is not None]
    return split.isin(known) | (split.isNull() if None in values else F.lit(False))


def stage_increment(rows: DataFrame, path: str, registry: Registry, split_by: str) -> Increment:
    """Bring a table split by one column up to date with ``rows``, its whole present content.

    Rows keep their ``g_id`` over runs; equal rows count once. Only partitions in which a row appeared or went are written;
    a partition that lost its last row is removed. The values of ``split_by`` are few (years, sources): those that
    changed are collected.
    """
    spark = rows.sparkSession
    marked = with_digest(rows)
    digests = marked.select(*DIGEST, F.col(split_by).cast("string").alias("split")).distinct()
    run = registry.write(find_changes(digests, registry.log()))
    pending = registry.pending()
    changed = registry.log(pending).groupBy("split").agg(F.count_if("live").alias("added"), F.count_if(~F.col("live")).alias("gone")).collect()
    splits = sorted((c.split for c in changed), key=lambda s: (s is not None, s))
    if splits:
        ids = live_ids(registry.log()).filter(_same(F.col("split"), splits)).select(*DIGEST, "g_id")
        part = marked.filter(_same(F.col(split_by).cast("string"), splits)).dropDuplicates(DIGEST)
        table = part.join(ids, list(DIGEST)).select(*rows.columns, "g_id")
        table.hint("rebalance", split_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(split_by).parquet(path)
        left = {r.split for r in live_ids(registry.log()).filter(_same(F.col("split"), splits)).select("split").distinct().collect()}
        _remove(spark, path, split_by, [s for s in splits if s not in left])
    registry.mark_applied(pending)
    return Increment(run, sum(c.added for c in changed), sum(c.gone for c in changed), splits)


def _remove(spark: SparkSession, path: str, split_by: str, values: Sequence[str | None]) -> None:
    """Drop the partitions of these values."""
    if not values:
        return
    written = spark.read.parquet(path).filter(_same(F.col(split_by).cast("string"), values))
    for row in written.groupBy(split_by).agg(F.min("_metadata.file_path").alias("file")).collect():
        folder = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(row.file)).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
