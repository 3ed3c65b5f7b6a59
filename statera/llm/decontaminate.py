r"""Benchmark decontamination by winnowing, in DataFrame expressions only.

Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the text with A-Z lowered. A window is
``WINDOW`` = 10 consecutive words of an item; an item of fewer words is one window. Texts are
fingerprinted by winnowing: of every ``w`` consecutive ``k``-gram hashes the smallest is kept.
With ``k + w - 1`` equal to the window length both sides keep the same smallest hash of a shared
window, so every shared span of that length shares a fingerprint. Items shorter than the window
form length classes of their own with ``k + w - 1`` equal to their length.

1. benchmark: fingerprints per length class, and a slot filter over them;
2. one pass over the documents: word count, fingerprints, and the words of those documents
   whose fingerprints pass the filter (a superset; text is never shuffled);
3. the surviving fingerprints are joined with the benchmark's, and each hit is extended to the
   windows around it, which are joined with the benchmark's windows on their words;
4. covered word positions and items are counted per document.

A null or empty text has no words and no hits; an item without words has no window. Repeated
documents are each decided; repeated items count by distinct id. Items without an id make hits like
all others; in n_items they count as one item together, and the list of ids leaves them out. An
empty benchmark leaves every document clean. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SlotFilter, landed, lower_az, scratch, table, with_row

WINDOW, GRAM = 10, 4
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_az(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def gram_at(words: Column, start: Column, length: int) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def _spread(n: Column, f) -> Column:
    """f(1..n) as an array; empty for n < 1."""
    return F.transform(span(F.lit(1), n), f)


def span(first: Column, last: Column) -> Column:
    """first, first + 1, ..., last; empty if last is smaller."""
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def all_windows(words: Column, length: int) -> Column:
    return _spread(F.size(words) - (length - 1), lambda i: gram_at(words, i, length))


def windows_around(words: Column, grams: Column, fps: Column, length: int) -> Column:
    """(start, gram) of each window of ``length`` words that holds a k-gram whose hash is in ``fps``."""
    k = min(GRAM, length)
    at = F.filter(_spread(F.size(grams), lambda i: F.when(F.array_contains(fps, F.element_at(grams, i)), i)),
                  lambda i: i.isNotNull())
    starts = F.array_distinct(F.flatten(F.transform(at, lambda i: span(
        F.greatest(i - (length - k), F.lit(1)), F.least(i, F.size(words) - (length - 1))))))
    return F.transform(starts, lambda s: F.struct(s.alias("start"), gram_at(words, s, length).alias("gram")))


def classed(fps: Column, length: int) -> Column:
    """Fingerprints with their length class."""
    return F.transform(fps, lambda fp: F.struct(F.lit(length).alias("len"), fp.alias("fp")))


def _combined(df: DataFrame, a: str, b: str, shift: int, f, into: str) -> DataFrame:
    """``into[i] = f(a[i], b[i + shift])`` as far as ``b`` goes."""
    n = F.greatest(F.size(b) - shift, F.lit(0))
    return df.withColumn(into, F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(shift + 1), n), f))


def with_grams(df: DataFrame, length: int, words: str = "words", into: str = "grams") -> DataFrame:
    """Hashes of all k-grams of the class of windows of ``length`` words, by doubling: gram hashes
    of 1, 2, 4, ... words are combined, so that each position costs a few hashes of two numbers."""
    k, both = min(GRAM, length), lambda x, y: F.xxhash64(x, y)
    before = df.columns
    df, have = df.withColumn("_1", F.transform(F.col(words), lambda x: F.xxhash64(x))), 1
    while have * 2 <= k:
        df = _combined(df, f"_{have}", f"_{have}", have, both, f"_{have * 2}")
        have *= 2
    rest, done = k - have, have
    while rest:
        part = 1 << (rest.bit_length() - 1)
        df = _combined(df, f"_{done}", f"_{part}", done, both, f"_{done + part}")
        rest, done = rest - part, done + part
    return df.select(*before, F.col(f"_{k}").alias(into))


def with_winnowed(df: DataFrame, length: int, grams: str = "grams", into: str = "fps") -> DataFrame:
    """The smallest of each ``w`` consecutive gram hashes, without repeats (also by doubling)."""
    w, have = length - min(GRAM, length) + 1, 1
    before, at, smaller = df.columns, grams, lambda x, y: F.least(x, y)
    while have * 2 <= w:
        df = _combined(df, at, at, have, smaller, f"_min{have * 2}")
        have, at = have * 2, f"_min{have * 2}"
    if have < w:
        df = _combined(df, at, at, w - have, smaller, "_min")
        at = "_min"
    return df.select(*before, F.array_distinct(at).alias(into))


class Benchmark:
    """Windows and fingerprints of the items, as tables, and what is fixed in size about them."""

    def __init__(self, items: DataFrame, work: str):
        # the id within a struct, as sets drop bare nulls
        words = items.select(F.struct(F.col("item_id").cast("string").alias("id")).alias("item_id"),
                             words_of(F.col("text")).alias("words"))
        sized = words.where(F.size("words") > 0).withColumn("len", F.least(F.size("words"), F.lit(WINDOW)))
        sized = landed(sized.distinct(), f"{work}/items")
        self.lengths = sorted(r[0] for r in sized.select("len").distinct().collect())  # 1 to WINDOW
        parts, windows = [], []
        for n in self.lengths:
            own = sized.where(F.col("len") == n)
            parts.append(with_winnowed(with_grams(own, n), n).select(F.lit(n).alias("len"), F.explode("fps").alias("fp")))
            windows.append(own.select("item_id", F.explode(all_windows(F.col("words"), n)).alias("gram")))
        empty = sized.sparkSession.createDataFrame([], "len int, fp bigint")
        none = sized.sparkSession.createDataFrame([], "item_id struct<id:string>, gram string")
        for p in parts:
            empty = empty.union(p)
        for p in windows:
            none = none.union(p)
        self.fingerprints = landed(empty.distinct(), f"{work}/fingerprints")
        # items with the same window, as one set: documents meet few sets, whatever the windows
        sets = none.groupBy("gram").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids")) \
            .withColumn("set_id", F.md5(F.to_json("item_ids")))
        self.windows = landed(sets, f"{work}/windows")
        self.sets = landed(self.windows.groupBy("set_id").agg(F.first("item_ids").alias("item_ids")),
                           f"{work}/sets")
        self.filter = SlotFilter(self.fingerprints, "fp", f"{work}/filter")


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: ``row`` (the document's columns), n_words, n_hit, n_items,
    items_sha256, contaminated."""
    spark = docs.sparkSession
    work = scratch(spark, "decontaminate")
    bench = Benchmark(items, work)
    read = docs.select(with_row(docs).alias("row"), words_of(docs["text"]).alias("words")) \
        .withColumn("n_words", F.size("words").cast("long"))
    own = F.array().cast("array<struct<len:int,fp:bigint>>")
    for n in bench.lengths:
        read = with_winnowed(with_grams(read, n), n, into=f"fps{n}").drop("grams")
        own = F.concat(own, classed(F.col(f"fps{n}"), n))
    read = read.select("row", "n_words", "words", own.alias("own"), bench.filter.words.alias("known"))
    read = read.select("row", "n_words", "words", F.filter(
        "own", lambda x: bench.filter.passes(F.col("known"), x["fp"])).alias("hits")).select(
        F.monotonically_increasing_id().alias("uid"), "row", "n_words",
        F.when(F.size("hits") > 0, F.col("words")).alias("words"), "hits")
    read = landed(read, f"{work}/read")
    windows = _windows(read.where(F.size("hits") > 0).select("uid", "words", "hits"), bench)
    return _counted(read, windows, bench.sets, f"{work}/counted")


def _windows(found: DataFrame, bench: Benchmark) -> DataFrame:
    """uid, start, len, set_id of the document windows that are windows of items."""
    # which (document, class) have a true fingerprint; the words travel once per document and class
    true = found.select("uid", F.explode("hits").alias("hit")).select("uid", "hit.*").join(bench.fingerprints, ["len", "fp"]) \
        .groupBy("uid", "len").agg(F.collect_set("fp").alias("fps"))
    whole = found.select("uid", "words", F.explode(F.array_distinct("hits.len")).alias("len")).join(true, ["uid", "len"])
    spans = None
    for n in bench.lengths:
        own = with_grams(whole.where(F.col("len") == n), n)
        own = own.select("uid", "len", F.explode(
            windows_around(F.col("words"), F.col("grams"), F.col("fps"), n)).alias("x")).select("uid", "len", "x.*")
        spans = own if spans is None else spans.union(own)
    if spans is None:
        spans = found.sparkSession.createDataFrame([], "uid bigint, len int, start int, gram string")
    return spans.join(bench.windows.select("gram", "set_id"), "gram").select("uid", "len", "start", "set_id")


def _counted(read: DataFrame, windows: DataFrame, sets: DataFrame, path: str) -> DataFrame:
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        "spans", lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1))))).cast("long")
    sets_of = F.sort_array("sets")
    per_doc = windows.groupBy("uid").agg(
        F.collect_set(F.struct("start", "len")).alias("spans"), F.collect_set("set_id").alias("sets")) \
        .select("uid", covered.alias("n_hit"), sets_of.alias("sets"), F.md5(F.array_join(sets_of, ",")).alias("combination"))
    per_doc = landed(per_doc, path)  # read twice
    # many documents have the same sets: their items are told once for each combination
    listed = per_doc.groupBy("combination").agg(F.first("sets").alias("sets")) \
        .select("combination", F.explode("sets").alias("set_id")).join(sets, "set_id") \
        .select("combination", F.explode("item_ids").alias("item_id")) \
        .groupBy("combination").agg(F.sort_array(F.collect_set("item_id")).alias("ids")) \
        .select("combination", F.size("ids").cast("long").alias("n_items"),
                F.sha2(F.concat_ws(",", F.col("ids")["id"]), 256).alias("items_sha256"))
    ids = per_doc.drop("sets").join(listed, "combination").drop("combination")
    return read.select("uid", "row", "n_words").join(ids, "uid", "left").select(
        "row", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate(docs, table(spark, sf_dir, "benchmark")) \
        .select("row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


OP3_SQL = r"""
WITH dw AS (
  SELECT row_number() OVER () AS uid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
  FROM iw, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS r(i) WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM wins),
hits AS (
  SELECT p.uid, p.i, p.n, wins.item_id
  FROM (SELECT uid, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
        FROM dw, lens, unnest(range(1, len(w) - n + 2)) AS r(i)) p
  JOIN wins ON wins.n = p.n AND wins.gram = p.gram),
words AS (SELECT uid, count(DISTINCT pos) AS n_hit FROM (SELECT uid, unnest(range(i, i + n)) AS pos FROM hits) GROUP BY uid),
items AS (SELECT uid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT uid, item_id::VARCHAR AS id FROM hits) GROUP BY uid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM dw LEFT JOIN words USING (uid) LEFT JOIN items USING (uid)
"""
