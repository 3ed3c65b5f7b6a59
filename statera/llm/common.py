"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITE = r"[\x20\x09-\x0D]+"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder beside the session's shared checkpoint folder, deleted when the driver ends."""
    path = scratch_dir(spark, name)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def landed(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as a parquet table and read back: cuts the lineage at files that survive
    a lost executor, and gives the planner true sizes."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def session_conf(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Session settings for one block, put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def lower_az(text: Column) -> Column:
    """A-Z to a-z, every other character as it is. Pure ASCII text takes the cheap path."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)) \
        .otherwise(F.translate(text, UPPER, LOWER))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc32_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def with_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that helper columns can't clash with them."""
    return F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns])


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows, so that very long texts don't meet by the thousand in one batch.
    Set for the session, as the DataFrames that need it run after their function has returned."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))


FEWEST_SLOTS, MOST_SLOTS = 1 << 20, 1 << 27  # of a slot filter; 16 MB at most
SLOTS_PER_KEY = 16


class SlotFilter:
    """A filter over the bigint column ``key`` of ``keys`` (a landed table): a bit for each slot, by the key modulo the
    number of slots, which follows the number of keys up to a limit. It lets all keys through, and others at the
    rate at which slots are taken (beyond eight million keys ever more); it only ever saves work.

    ``words`` is a scalar subquery on a written table of one row, so that the bits are in no plan text. As Spark allows
    no subquery in a higher-order function, make a column of it first there."""

    def __init__(self, keys: DataFrame, key: str, path: str):
        spark = keys.sparkSession
        self.slots = min(max(FEWEST_SLOTS, 1 << (SLOTS_PER_KEY * keys.count()).bit_length()), MOST_SLOTS)
        slot = self._slot(F.col(key))
        taken = keys.groupBy(F.shiftright(slot, 6).alias("id")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))).alias("w"))
        every = spark.range(self.slots // 64).join(taken, "id", "left").select(F.struct("id", F.coalesce("w", F.lit(0)).alias("w")).alias("x"))
        self.table = landed(every.agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["w"]).alias("words")), path)

    @property
    def words(self) -> Column:
        return self.table.scalar()

    def _slot(self, key: Column) -> Column:
        return F.pmod(key, F.lit(self.slots))

    def passes(self, words: Column, key: Column) -> Column:
        slot = self._slot(key)
        return F.getbit(F.get(words, F.shiftright(slot, 6).cast("int")), (slot % 64).cast("int")) == 1
