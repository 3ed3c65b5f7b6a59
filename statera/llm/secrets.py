r"""Secrets by base patterns and character Markov models, in DataFrame expressions only.

Base spans, leftmost and non-overlapping per kind: ``assign`` (a keyword, = or :, and a value of six
or more characters), ``access`` (AKIA and 16 or more capitals and digits) and ``hex`` (24 or more
hex digits). Then two first-order Markov models of characters are trained over all texts: one of
random strings from the values that the base patterns label, one of ordinary text from all runs of 8
or more identifier characters that overlap no base span, whatever characters they are of; words by far
outnumber the secrets among them. Each of these runs is compared by the log-likelihood ratio of the
two, in which the ordinary model is that of all other runs: all occurrences of its own value are taken
out, so that a secret never vouches for itself. Those with a ratio of ``TOTAL`` or more, and ``MEAN`` or
more a character, are added with kind ``markov``.

The models have a fixed alphabet of 66 characters, so their table of 4356 pairs is broadcast.
Offsets count code points, end exclusive. Null and empty texts have no spans. Repeated rows get the
same spans. Without base spans or without ordinary runs there is nothing to compare and none are
added. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SlotFilter, landed, scratch, table

KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = r"AKIA[A-Z0-9]{16,}"   # of a run too short no later start is long enough either
HEX = r"[0-9a-f]{24,}+"
RUN = r"[A-Za-z0-9+/_=-]{8,}+"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
SMOOTH, TOTAL, MEAN = 0.5, 16.0, 0.8
CHUNK = 256  # matches whose offsets are summed up together
FOUND = "array<struct<start:int,kind:int,end:int,value:string>>"


def _none() -> Column:
    return F.array().cast(FOUND)


def located(text: Column, pattern: str, kind: int, value_group: int = 0) -> Column:
    """start, kind, end, value of all matches. The pieces between the matches and the matches
    themselves give the offsets, as both search leftmost and without overlap."""
    size = lambda x: F.char_length(x)
    gaps = F.transform(F.split(text, pattern), size)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if value_group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    parts = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), F.arrays_zip(found.alias("m"), values.alias("v")),
                       lambda gap, m: F.struct(gap.alias("gap"), m["m"].alias("m"), m["v"].alias("v")))
    start = F.struct(F.lit(0).alias("at"), _none().alias("out"))

    def step(acc: Column, p: Column) -> Column:
        a = acc["at"] + p["gap"]
        b = a + F.char_length(p["m"])
        one = F.struct(a.alias("start"), F.lit(kind).alias("kind"), b.alias("end"), p["v"].alias("value"))
        return F.struct(b.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    def chunk(acc: Column, ps: Column) -> Column:  # what is found is copied once a chunk, not once a match
        own = F.aggregate(ps, F.struct(acc["at"].alias("at"), _none().alias("out")), step)
        return F.transform(F.array(own), lambda x: F.struct(
            x["at"].alias("at"), F.concat(acc["out"], x["out"]).alias("out")))[0]
    chunks = F.transform(F.sequence(F.lit(0), F.floor(F.size(parts) / CHUNK).cast("int")),
                         lambda i: F.slice(parts, i * CHUNK + 1, F.lit(CHUNK)))
    return F.aggregate(chunks, start, chunk, lambda acc: acc["out"])


def base_found(text: Column) -> Column:
    """All base spans, by start and kind. Cheap tests keep the searches to texts that can match."""
    low = F.lower(text)
    keyword = F.lit(False)
    for k in KEYWORDS:
        keyword = keyword | low.contains(k)
    assign = F.filter(located(text, ASSIGN, 0, 2), lambda x: F.char_length(x["value"]) >= 6)
    return F.array_sort(F.concat(
        F.when(keyword, assign).otherwise(_none()),
        F.when(text.contains("AKIA"), located(text, ACCESS, 1)).otherwise(_none()),
        F.when(text.rlike(HEX), located(text, HEX, 2)).otherwise(_none())))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined, by start and kind."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def apart(runs: Column, base: Column) -> Column:
    return F.filter(runs, lambda r: ~F.exists(base, lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))


def pairs_of(value: Column) -> Column:
    """Neighbouring characters; none of a value of one character."""
    # split once: a substring of a long value would be looked for from its start each time
    return F.transform(F.array(F.split(value, "")), lambda c: F.zip_with(
        F.slice(c, F.lit(1), F.size(c) - 1), F.slice(c, F.lit(2), F.size(c) - 1), lambda a, b: F.concat(a, b)))[0]


def pair_counts(labelled: DataFrame, values: DataFrame) -> DataFrame:
    """pair, first, random (log of the probability of the second character after the first in random strings),
    o and all_o (how often ordinary runs have the pair, and its first character before another one);
    ``labelled`` has value, ``values`` value and its occurrences c."""
    spark, n = values.sparkSession, len(ALPHABET)
    pairs = F.explode(pairs_of(F.col("value"))).alias("pair")
    r = labelled.select(pairs).groupBy("pair").agg(F.count("*").alias("r"))
    o = values.select("c", pairs).groupBy("pair").agg(F.sum("c").alias("o"))
    letter = lambda at: F.substring(F.lit(ALPHABET), at.cast("int") + 1, F.lit(1))
    every = spark.range(n * n).select(F.concat(letter(F.floor(F.col("id") / n)), letter(F.col("id") % n)).alias("pair"))
    full = every.join(r, "pair", "left").join(o, "pair", "left").select(
        "pair", F.substring("pair", 1, 1).alias("first"), F.coalesce("r", F.lit(0)).alias("r"), F.coalesce("o", F.lit(0)).alias("o"))
    after = full.groupBy("first").agg(F.sum("r").alias("all_r"), F.sum("o").alias("all_o"))
    return full.join(after, "first").select(
        "pair", "first", F.log((F.col("r") + SMOOTH) / (F.col("all_r") + SMOOTH * n)).alias("random"), "o", "all_o")


def random_values(values: DataFrame, model: DataFrame) -> DataFrame:
    """Those of ``values`` (vid, value, c) that pass ``TOTAL`` and ``MEAN``, each against the other values."""
    every = model.agg(F.sum("o")).first()[0]
    pairs = values.select("vid", "c", F.explode(pairs_of(F.col("value"))).alias("pair")) \
        .groupBy("vid", "c", "pair").agg(F.count("*").alias("m")).join(F.broadcast(model), "pair")
    own = F.sum(F.col("c") * F.col("m")).over(Window.partitionBy("vid", "first"))
    ordinary = F.log((F.col("o") - F.col("c") * F.col("m") + SMOOTH) / (F.col("all_o") - own + SMOOTH * len(ALPHABET)))
    passed = pairs.withColumn("ratio", F.col("m") * (F.col("random") - ordinary)).groupBy("vid", "c") \
        .agg(F.sum("ratio").alias("total"), F.sum("m").alias("n")) \
        .where((F.col("total") >= TOTAL) & (F.col("total") >= MEAN * F.col("n")) & (F.col("c") * F.col("n") < every))
    return values.join(passed.select("vid"), "vid").select("value", F.xxhash64("value").alias("h"))


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, base and spans (arrays of start, kind, end, value, by start and kind) of every document."""
    work = scratch(docs.sparkSession, "secrets")
    text = F.coalesce(docs["text"], F.lit(""))
    read = docs.select("doc_id", base_found(text).alias("base"),
                       F.when(text.rlike(RUN), located(text, RUN, 3)).otherwise(_none()).alias("runs"))
    read = landed(read.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "base",
                              apart(F.col("runs"), F.col("base")).alias("runs")), f"{work}/read")
    runs = read.select("uid", F.explode("runs").alias("run")).select("uid", "run.*")
    labelled = read.select(F.explode("base").alias("b")).select("b.value")
    values = runs.groupBy("value").agg(F.count("*").alias("c")).withColumn("vid", F.monotonically_increasing_id())
    values = landed(values, f"{work}/values")
    if labelled.isEmpty() or values.isEmpty():
        return read.select("doc_id", "base", F.col("base").alias("spans"))
    model = landed(pair_counts(labelled, values), f"{work}/pairs")
    scored = landed(random_values(values, model), f"{work}/random")
    # few runs are random: the others stay where they are
    known = SlotFilter(scored, "h", f"{work}/filter")
    unsure = runs.where(known.passes(known.words, F.xxhash64("value")))
    added = unsure.join(scored.select("value"), "value").groupBy("uid").agg(
        F.collect_list(F.struct("start", "kind", "end", "value")).alias("added"))
    return read.select("uid", "doc_id", "base").join(added, "uid", "left").select(
        "doc_id", "base", F.array_sort(F.concat("base", F.coalesce("added", _none()))).alias("spans"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"),
                        written(F.col("spans")).alias("spans"))


def count(kind: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
