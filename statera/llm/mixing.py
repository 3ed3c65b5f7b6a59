r"""Mixing sources to target weights by temperature.

Token shares of the sources are raised to an exponent and normalised. The exponent is the smallest
in [0, 1] (0: all sources alike, 1: as they are) at which the entropy of the weights is at most
``entropy`` times that of equal weights and no source is read more than ``max_epochs`` times; both
fall as it grows, so it is found by section: each round is one aggregate over the table of sources
that tries 15 exponents. Where even 1 repeats a source too often, 1 is taken.

The weights are realised against a token budget (``budget``, or else the smallest at which every
source is read once at least, so that nothing is lost). A source's quota is some whole passes and a
part of one more. For that part its documents are dealt by hash into ``BLOCKS`` blocks, each into as
many sub-blocks, whose order is a permutation of its own for each source; the longest prefix of
sub-blocks within the quota is taken. Only sums of blocks are ever ordered, never documents, so a
source that holds most of the rows is no burden to one task.

Tokens are runs of non-white characters; a null text has none. A null source is a source of its own.
A source without tokens has weight 0 and no copies. Rows without an id are dealt by their text;
repeated rows fall into the same sub-block. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import landed, scratch, table, with_row
from .sharding import document_key

BLOCKS = 1009  # prime, so that any step through the blocks is a permutation
ENTROPY, MAX_EPOCHS = 0.97, 4.0
SECTIONS, ROUNDS = 16, 9


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _number(digest: Column, at: int) -> Column:
    return F.conv(F.substring(digest, at, 8), 16, 10).cast("long")


def source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def _rank(docs_digest: Column, source_digest: Column, level: int) -> Column:
    """Place of the document's block in the source's permutation of blocks."""
    block = _number(docs_digest, 1 + 8 * level) % BLOCKS
    step = _number(source_digest, 1 + 16 * level) % (BLOCKS - 1) + 1
    return (block * step + _number(source_digest, 9 + 16 * level)) % BLOCKS


def dealt(docs: DataFrame) -> DataFrame:
    """``row``, source_key, and the ranks of block and sub-block."""
    key = source_key(docs["source"])
    doc, own = F.md5(document_key(docs).cast("binary")), F.md5(key.cast("binary"))
    return docs.select(with_row(docs).alias("row"), key.alias("source_key"),
                       _rank(doc, own, 0).cast("int").alias("block"), _rank(doc, own, 1).cast("int").alias("sub"))


def exponent(shares: DataFrame, total: int, entropy: float, max_epochs: float, budget: int | None) -> float:
    """The smallest exponent within both limits; ``shares`` has a positive share for each source."""
    ends = shares.agg(F.min("p"), F.max("p"), F.count("*")).first()
    if not ends[2]:
        return 1.0
    low_p, top_p, limit = ends[0], ends[1], entropy * math.log(ends[2])
    lo, hi = 0.0, 1.0
    for _ in range(ROUNDS):
        tried = [lo + (hi - lo) * i / SECTIONS for i in range(0 if lo == 0.0 else 1, SECTIONS)]
        sums = shares.agg(*[F.sum(F.pow("p", F.lit(a))) for a in tried],
                          *[F.sum(F.pow("p", F.lit(a)) * F.log("p")) for a in tried]).first()
        for i, a in enumerate(tried):
            z, slope = sums[i], sums[len(tried) + i]
            tokens = budget if budget is not None else total * z * top_p ** (1 - a)
            if math.log(z) - a * slope / z <= limit + 1e-12 and \
                    tokens / (total * z) * low_p ** (a - 1) <= max_epochs + 1e-12:
                hi = a
                break
            lo = a
        if hi <= lo:
            break
    return round(hi, 6)


def mixing_plan(docs: DataFrame, entropy: float = ENTROPY, max_epochs: float = MAX_EPOCHS,
                budget: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents as slim rows: doc_id, source, source_key, block, sub, n_tokens; one row per source
    with source_key, weight, passes, cut_block, cut_sub)."""
    work = scratch(docs.sparkSession, "mixing")
    slim = docs.select("doc_id", "source", "text")
    slim = landed(dealt(slim).select("row.doc_id", "row.source", "source_key", "block", "sub",
                                     n_tokens(F.col("row.text")).alias("n_tokens")), f"{work}/slim")
    blocks = landed(slim.groupBy("source_key", "block").agg(F.sum("n_tokens").alias("tokens")), f"{work}/blocks")
    totals = landed(blocks.groupBy("source_key").agg(F.sum("tokens").alias("tokens")), f"{work}/totals")
    total = totals.agg(F.sum("tokens")).first()[0] or 0
    shares = totals.where("tokens > 0").withColumn("p", F.col("tokens") / F.lit(float(total or 1)))
    power = exponent(shares, total, entropy, max_epochs, budget)
    z = shares.agg(F.sum(F.pow("p", F.lit(power)))).first()[0] or 1.0
    weights = shares.withColumn("weight", F.round(F.pow("p", F.lit(power)) / F.lit(z), 12))
    if budget is None:
        budget = weights.agg(F.max(F.col("tokens") / F.col("weight"))).first()[0] or 0
    quota = F.round(F.col("weight") * F.lit(float(budget))).cast("long")
    weights = weights.withColumn("passes", F.floor(quota / F.col("tokens")).cast("long")) \
        .withColumn("rest", quota % F.col("tokens"))
    weights = landed(totals.select("source_key").join(weights.drop("p"), "source_key", "left")
                     .na.fill(0, ["weight", "passes", "rest"]), f"{work}/weights")

    # the first block that doesn't fit wholly into the rest, then the sub-blocks that do within it
    def upto(*by: str, order: str) -> Column:
        return F.sum("tokens").over(Window.partitionBy(*by).orderBy(order))
    cut = blocks.join(weights.select("source_key", "rest"), "source_key") \
        .withColumn("upto", upto("source_key", order="block")).where("upto > rest") \
        .groupBy("source_key").agg(F.min(F.struct("block", (F.col("rest") - F.col("upto") + F.col("tokens"))
                                                  .alias("left"))).alias("cut")) \
        .select("source_key", "cut.block", "cut.left")
    subs = slim.join(cut, ["source_key", "block"]).groupBy("source_key", "block", "left", "sub") \
        .agg(F.sum("n_tokens").alias("tokens")) \
        .withColumn("upto", upto("source_key", order="sub")).where("upto > left") \
        .groupBy("source_key").agg(F.min("sub").alias("cut_sub"))
    plan = weights.select("source_key", "weight", "passes") \
        .join(cut.select("source_key", F.col("block").alias("cut_block")), "source_key", "left") \
        .join(subs, "source_key", "left")
    return slim, landed(plan, f"{work}/plan")


def with_copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``copies``: the whole passes, and one more for sub-blocks before the cut. The planner broadcasts
    the plan (a row per source) while it is small, and splits hot sources where it isn't."""
    before = (F.col("block") < F.col("cut_block")) | ((F.col("block") == F.col("cut_block"))
                                                      & (F.col("sub") < F.col("cut_sub")))
    return rows.join(plan, "source_key").withColumn(
        "copies", (F.col("passes") + F.coalesce(before, F.lit(False)).cast("long")))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The documents as often as the mixture reads them, with the columns of ``docs``."""
    _, plan = mixing_plan(docs, **options)
    rows = with_copies(dealt(docs), plan).where("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("pass")).select("row.*")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    slim, plan = mixing_plan(table(spark, sf_dir, "documents"))
    return with_copies(slim, plan).select("doc_id", "source", "n_tokens", F.round("weight", 6).alias("weight"),
                                          "block", "sub", "copies")


OP10_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce('=' || source, 'null') AS k, coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS key,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS n_tokens FROM documents),
h AS (SELECT *, md5(key) AS dm, md5(k) AS sm FROM d),
n AS (SELECT doc_id, source, k, n_tokens, ('0x' || dm[1:8])::BIGINT AS d0, ('0x' || dm[9:16])::BIGINT AS d1,
             ('0x' || sm[1:8])::BIGINT AS s0, ('0x' || sm[9:16])::BIGINT AS c0,
             ('0x' || sm[17:24])::BIGINT AS s1, ('0x' || sm[25:32])::BIGINT AS c1 FROM h),
r AS (SELECT doc_id, source, k, n_tokens, ((d0 % 1009) * (s0 % 1008 + 1) + c0) % 1009 AS block,
             ((d1 % 1009) * (s1 % 1008 + 1) + c1) % 1009 AS sub FROM n),
t AS (SELECT k, sum(n_tokens) AS tokens FROM r GROUP BY k),
p AS (SELECT k, tokens, tokens / (SELECT sum(tokens) FROM t)::DOUBLE AS p FROM t WHERE tokens > 0),
ends AS (SELECT min(p) AS a, max(p) AS b, 0.97 * ln(count(*)) AS cap, list(p) AS ps FROM p),
-- the smallest exponent with entropy <= cap and (largest share / smallest share) ** (1 - exponent) <= 4
search(i, lo, hi) AS (
  SELECT 0, 0::DOUBLE, 1::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN lo ELSE mid END, CASE WHEN ok THEN mid ELSE hi END
  FROM (SELECT i, lo, hi, mid, ln(z) - mid * list_sum(list_transform(ps, lambda x: pow(x, mid) * ln(x))) / z <= cap + 1e-12
               AND pow(b / a, 1 - mid) <= 4.0 + 1e-12 AS ok
        FROM (SELECT *, (lo + hi) / 2 AS mid, list_sum(list_transform(ps, lambda x: pow(x, (lo + hi) / 2))) AS z
              FROM search, ends WHERE i < 40))),
e AS (SELECT round(hi, 6) AS e FROM search WHERE i = 40),
w AS (SELECT k, tokens, round(pow(p, e) / (SELECT sum(pow(p, e)) FROM p, e), 12) AS weight FROM p, e),
q AS (SELECT *, round(weight * (SELECT max(tokens / weight) FROM w))::BIGINT AS quota FROM w),
b1 AS (SELECT r.k, block, sum(n_tokens) AS tokens, any_value(quota % q.tokens)::BIGINT AS rest
       FROM r JOIN q USING (k) GROUP BY r.k, block),
cut AS (SELECT k, min(block) AS cut_block, arg_min(rest - upto + tokens, block) AS rem
        FROM (SELECT *, sum(tokens) OVER (PARTITION BY k ORDER BY block) AS upto FROM b1) WHERE upto > rest GROUP BY k),
b2 AS (SELECT r.k, sub, any_value(rem) AS rem, sum(n_tokens) AS tokens
       FROM r JOIN cut ON cut.k = r.k AND cut.cut_block = r.block GROUP BY r.k, sub),
cut2 AS (SELECT k, min(sub) AS cut_sub
         FROM (SELECT *, sum(tokens) OVER (PARTITION BY k ORDER BY sub) AS upto FROM b2) WHERE upto > rem GROUP BY k)
SELECT doc_id, source, n_tokens, round(coalesce(weight, 0), 6) AS weight, block::INTEGER AS block, sub::INTEGER AS sub,
       (coalesce(quota // tokens, 0) + coalesce(block < cut_block OR (block = cut_block AND sub < cut_sub), false)::INTEGER)::BIGINT AS copies
FROM r LEFT JOIN q USING (k) LEFT JOIN cut USING (k) LEFT JOIN cut2 USING (k)
"""
