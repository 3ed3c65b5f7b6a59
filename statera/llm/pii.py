r"""Personal data by base patterns and bootstrapped contextual extraction.

Base spans, leftmost and non-overlapping per kind: email, ip, card (16 to 19 digits, Luhn) and phone
(8 to 15 digits). They seed the bootstrap. Every identifier-like token of every text (one with a
digit or an at sign) is an instance, with the lexical patterns around it: its two words before, and
the word before with the word after. Spark holds the graph of patterns and instances and scores it
in turns: a pattern's confidence for a kind is the mean score of its instances of that kind's shape
(smoothed), an instance's score joins the confidences of its patterns; seeds score 1. A pattern is
trusted if enough of its instances, seeds or discovered ones, have a high score, so that discoveries
lead to further patterns. Scores only rise, and the turns end when they no longer do. Tokens outside
base spans whose score and whose best pattern pass high thresholds are added.

Kinds of unseen tokens by shape: an at sign is an email; digits with three dots or with colons an
ip; 12 to 19 digits a card; 7 to 11 digits a phone; others have no kind and are no instances.

Offsets count code points, end exclusive. Null and empty texts have no spans. Repeated rows get the
same spans. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, landed, scratch, table

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")  # a match can only start where a run of digits does
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MARK = re.compile(r"[0-9@]")
TOKEN = re.compile(r"[^\x00-\x20]++")
EDGE = "\"'`.,;:!?()[]{}<>|*#$%&=~"
SUPPORT, TRUST, ACCEPT = 5, 0.5, 0.8
STILL = 1e-6  # a rise of a pattern's confidence that counts as none
LONG = 40  # longer words are told apart by their digests


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at sign back over its local part: linear, where a search from every start isn't."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", done if found else at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), by kind and start."""
    spans = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if not MARK.search(text):
        return spans
    spans += [(1, *m.span()) for m in IP.finditer(text)
              if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, *m.span()))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            spans.append((3, *m.span()))
    return spans


def shape_kind(token: str) -> int | None:
    if "@" in token:
        return 0
    digits = sum("0" <= c <= "9" for c in token)
    if any(c.isalpha() for c in token) or not digits:
        return None
    if token.count(".") == 3 or token.count(":") > 1:
        return 1
    return 2 if 12 <= digits <= 19 else 3 if 7 <= digits <= 11 else None


def _word(token: str) -> str:
    word = token.strip(EDGE).lower()
    return word if len(word) <= LONG else hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def instances(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str, bool, list[str]]]:
    """(kind, start, end, value, seed, patterns) of base spans and of identifier-like tokens apart from them."""
    if not spans and not MARK.search(text):
        return []
    tokens = [m.span() for m in TOKEN.finditer(text)]
    starts = [a for a, _ in tokens]
    ordered, out, before, s = sorted(spans, key=lambda x: x[1]), [], ("", ""), 0
    base_end = 0
    for i, (a, b) in enumerate(tokens):
        while s < len(ordered) and ordered[s][1] < b:
            kind, start, end = ordered[s]
            following = bisect_left(starts, end, i)
            after = _word(text[slice(*tokens[following])]) if following < len(tokens) else ""
            out.append((kind, start, end, text[start:end].lower(), True, _patterns(before, after)))
            base_end, s = max(base_end, end), s + 1
        if a < base_end:
            continue
        raw = text[a:b]
        if MARK.search(raw):
            cut = len(raw) - len(raw.lstrip(EDGE))
            value = raw.strip(EDGE)
            kind = shape_kind(value) if value else None
            if kind is not None:
                after = _word(text[slice(*tokens[i + 1])]) if i + 1 < len(tokens) else ""
                out.append((kind, a + cut, a + cut + len(value), value.lower(), False, _patterns(before, after)))
        before = (before[1], _word(raw))
    return out


def _patterns(before: tuple[str, str], after: str) -> list[str]:
    return [p for p, known in ((f"{before[0]} {before[1]} _", before[1]), (f"{before[1]} _ {after}", before[1] and after))
            if known]


SPAN = "struct<kind:int,start:int,end:int>"
FOUND = "struct<kind:int,start:int,end:int,value:string,seed:boolean,patterns:array<string>>"


def _read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        spans = [base_spans(t) for t in part["text"]]
        found = [instances(t, s) for t, s in zip(part["text"], spans, strict=True)]
        yield pd.DataFrame({"doc_id": part["doc_id"], "base": spans, "found": found})


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined, by kind and start."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def bootstrapped(edges: DataFrame, work: str) -> tuple[DataFrame, DataFrame]:
    """(pattern, kind, trust) and (kind, value, score); ``edges``: pattern, kind, value, seed, distinct."""
    # patterns of fewer instances can't ever have the support
    sizes = edges.groupBy("pattern", "kind").agg(F.count("*").alias("n")).where(F.col("n") >= SUPPORT)
    edges = landed(edges.join(sizes, ["pattern", "kind"]), f"{work}/able")
    patterns, scores, turn = None, None, 0
    while True:
        scored = edges.withColumn("score", F.lit(0.0)) if scores is None else \
            edges.join(scores, ["kind", "value"], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
        scored = scored.withColumn("score", F.when(F.col("seed"), 1.0).otherwise(F.col("score")))
        now = scored.groupBy("pattern", "kind").agg(
            F.sum("score").alias("positive"), F.first("n").alias("n"), F.count_if(F.col("score") >= ACCEPT).alias("support")) \
            .where(F.col("support") >= SUPPORT) \
            .select("pattern", "kind", (F.col("positive") / (F.col("n") + 1)).alias("trust")).where(F.col("trust") >= TRUST)
        now = landed(now, f"{work}/patterns{turn}")
        if patterns is not None:
            before = patterns.withColumnRenamed("trust", "was")
            risen = now.join(before, ["pattern", "kind"], "left").where(F.col("trust") - F.coalesce("was", F.lit(0.0)) > STILL)
            if risen.isEmpty():
                return patterns, scores
        patterns = now
        scores = edges.join(patterns, ["pattern", "kind"]).groupBy("kind", "value") \
            .agg((1 - F.exp(F.sum(F.log(1 - F.col("trust"))))).alias("score"))
        scores, turn = landed(scores, f"{work}/scores{turn}"), turn + 1


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, base and spans (arrays of kind, start, end) of every document."""
    spark = docs.sparkSession
    work = scratch(spark, "pii")
    bounded_batches(spark)
    read = docs.select("doc_id", F.coalesce(docs["text"], F.lit("")).alias("text")) \
        .mapInPandas(_read, f"doc_id long, base array<{SPAN}>, found array<{FOUND}>")
    read = landed(read.withColumn("uid", F.monotonically_increasing_id()), f"{work}/read")
    found = read.select("uid", F.explode("found").alias("f")).select("uid", "f.*") \
        .select("uid", "kind", "start", "end", "value", "seed", F.explode("patterns").alias("pattern"))
    edges = landed(found.groupBy("pattern", "kind", "value").agg(F.max("seed").alias("seed")), f"{work}/edges")
    patterns, scores = bootstrapped(edges, work)
    added = found.where("NOT seed").join(patterns.where(F.col("trust") >= ACCEPT), ["pattern", "kind"]) \
        .join(scores.where(F.col("score") >= ACCEPT), ["kind", "value"]) \
        .groupBy("uid").agg(F.collect_set(F.struct("kind", "start", "end")).alias("added"))
    return read.select("uid", "doc_id", "base").join(added, "uid", "left").select(
        "doc_id", "base", F.concat("base", F.coalesce("added", F.array().cast(f"array<{SPAN}>"))).alias("spans"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    counts = [_count("base", i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"),
                        written(F.col("spans")).alias("spans"))


def _count(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
