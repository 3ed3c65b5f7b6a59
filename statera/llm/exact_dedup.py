"""Exact deduplication with streaming state.

A Structured Streaming query reads the document files once and keeps, per SHA-256 digest of
the normalised text, the smallest (doc_id, content locator) and the number of rows. The state
is keyed by the digest, lives in RocksDB on the executors' disks, is checkpointed to the shared
folder and never expires: later runs over a grown input read only the new files. The state is
then read back as a table and every row is decided against it. A digest hit is not trusted:
the bytes of each hit are compared with the bytes of the row its locator names, and rows whose
bytes differ (a collision) are regrouped by their whole text.

Text: null counts as empty; each run of ``[\\x20\\x09-\\x0D]`` becomes one space. Of equal texts
the row with the smallest doc_id stays; a null id comes after all others; rows with the same id
and text are told apart by their locator (file, row), so exactly one row of a group stays. An
empty table gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, SlotFilter, landed, scratch, session_conf

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else 4 MB of disk a partition, even if empty
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

MEETING = 200  # rows of a group, about, that are compared with their keeper in one place


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


class ExactDedup:
    """``ingest`` folds the files under ``path`` into the state; ``decide`` gives the decisions
    for all rows read so far. ``digest`` can be replaced (tests use a weak one)."""

    def __init__(self, spark: SparkSession, path: str, state_dir: str | None = None,
                 max_bytes_per_trigger: int = 1 << 39, digest=sha256_digest):
        self.spark, self.path, self.digest = spark, path.rstrip("/"), digest
        self.work = scratch(spark, "exact-dedup")
        self.state_dir = state_dir or f"{self.work}/state"
        self.max_bytes = max_bytes_per_trigger
        self.schema = spark.read.parquet(self.path).schema

    def _rows(self, files: DataFrame) -> DataFrame:
        meta = files.metadataColumn("_metadata")
        text = normalised(files["text"])
        rows = files.select(files["doc_id"].cast("long").alias("doc_id"), text.alias("norm"),
                            F.struct(files["doc_id"].isNull().alias("no_id"),
                                     files["doc_id"].cast("long").alias("doc_id"),
                                     meta["file_path"].alias("file"),
                                     meta["row_index"].alias("row")).alias("loc"))
        return rows.withColumn("digest", self.digest(F.col("norm")))

    def ingest(self) -> None:
        # the last letter as a class: a glob, which the file source takes for files and folders alike
        pattern = f"{self.path[:-1]}[{self.path[-1]}]"
        files = (self.spark.readStream.schema(self.schema).option("maxBytesPerTrigger", self.max_bytes)
                 .parquet(pattern))
        state = self._rows(files).groupBy("digest").agg(F.min("loc").alias("keep"), F.count("*").alias("n"))
        with session_conf(self.spark, **ROCKSDB):
            query = (state.writeStream.format("noop").outputMode("update")
                     .option("checkpointLocation", self.state_dir).trigger(availableNow=True).start())
            query.awaitTermination()

    def state(self) -> DataFrame:
        """digest, keep (struct of the row that stays: id and locator), n."""
        with session_conf(self.spark, **ROCKSDB):
            stored = self.spark.read.format("statestore").load(self.state_dir)
            keep, n = [f"value.`{f.name}`" for f in stored.schema["value"].dataType.fields]
            return landed(stored.select(F.col("key.digest").alias("digest"), F.col(keep).alias("keep"),
                                        F.col(n).alias("n")).where("n > 1"), f"{self.work}/groups")

    def decide(self) -> DataFrame:
        """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
        rows = self._rows(self.spark.read.schema(self.schema).parquet(self.path))
        groups = self.state()
        hit = F.col("n").isNotNull()
        # the text travels with rows whose digest can be a group's, and with few others
        key = F.xxhash64("digest")
        known = SlotFilter(groups.select(key.alias("key")), "key", f"{self.work}/filter")
        rows = rows.select("doc_id", "loc", "digest", F.sha2(F.col("norm").cast("binary"), 256).alias("sha"),
                           F.when(known.passes(known.words, key), F.col("norm")).alias("norm"))
        decided = landed(
            rows.join(groups, "digest", "left").select("doc_id", "loc", "digest", "keep", "n", "sha",
                                                       F.when(hit, F.col("norm")).alias("norm")), f"{self.work}/decided")
        hits = decided.where(hit)
        # a large group meets copies of its keeper in several tasks
        parts = F.ceil(F.col("n") / MEETING).cast("int")
        keepers = hits.where(F.col("loc") == F.col("keep")).select(
            "digest", F.col("norm").alias("keep_norm"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
        met = hits.withColumn("part", F.pmod(F.xxhash64("loc"), parts).cast("int")).join(keepers, ["digest", "part"])
        differing = landed(met.where(F.col("norm") != F.col("keep_norm")).select("digest").distinct(), f"{self.work}/collisions")
        slim = decided.drop("norm")
        if not differing.isEmpty():  # rows of a colliding digest: grouped by their whole text
            whole = hits.join(differing, "digest", "left_semi").groupBy("digest", "norm") \
                .agg(F.min("loc").alias("keep"), F.count("*").alias("n"))
            again = hits.drop("keep", "n").join(differing, "digest", "left_semi").join(whole, ["digest", "norm"])
            slim = slim.join(differing, "digest", "left_anti").unionByName(again.drop("norm"))
        single = F.col("n").isNull()
        return slim.select(
            "doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
            F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
            (single | (F.col("loc") == F.col("keep"))).alias("kept"), F.col("sha").alias("text_sha256"))


def exact_dedup(spark: SparkSession, path: str, **options) -> DataFrame:
    run = ExactDedup(spark, path, **options)
    run.ingest()
    return run.decide()


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, f"{sf_dir.rstrip('/')}/documents.parquet")


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM d WINDOW g AS (PARTITION BY norm)
"""
