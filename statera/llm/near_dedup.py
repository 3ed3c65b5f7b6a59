r"""Near-duplicate groups by SuperMinHash signatures, banding, verification and union-find.

Words are ``[^\x20\x09-\x0D]+`` of the text with A-Z lowered; a document's set is its distinct
shingles of ``width`` words, two in op7 (its whole sequence if it has fewer words). Two documents are linked if
100 * |intersection| >= 80 * |union|; a group is what links reach.

1. ``sketched``: per document the size and digest of its set and the hashes of the bands of its
   signature. Documents with equal sets form one class before anything else; the rest works on one
   member of each class, so exact copies cost nothing.
2. SuperMinHash: every shingle puts its ranks 0 + r0, 1 + r1, ... on the slots in the order of a
   random permutation of its own; a slot keeps the smallest. All shingles put one rank at a time,
   and a signature is done as soon as every slot has one, as later ranks can't be smaller. With 44
   bands of 6 slots a linked pair shares no band with a probability under 2e-6.
3. In each band bucket all members are verified on their full sets against one pivot, the member that
   meets most others over all bands (the original of a group of copies is in nearly every bucket of
   theirs), then linked members are united. Buckets with the same pivot are one from here on, a row per
   pivot and member. Only those that still hold several groups go on. Two
   members x, y of a pivot P share at most min(|x & P|, |y & P|) shingles inside P, so only what members
   have beyond P is laid out, a row per shingle. Pairs that share a rare one of these (up to ``RARE``
   members of P have it) are listed with the number they share, which is linear, and verified if this
   number, their frequent ones and the bound inside P suffice for a link. All other pairs need enough
   inside P and of frequent ones on both sides, which rules out most without looking at their sets; up
   to 64 members outside the pivot's group become pivots at a time and meet the members of other
   groups that this bound, the sizes and the triangle inequality of the Jaccard distance leave; it ends
   when every bucket is one group or all its members were pivots. No link inside a bucket is lost, and
   a group of near copies of any size is joined by one pivot.
4. Union-find: hooking each label to the smallest it is linked with and halving paths, by joins.

Null or empty texts have an empty set and are linked with nothing. In op7 rows with a null id take no
part: component_id is null and they are kept; ``one_of_each_group`` lets them take part. Repeated rows share class and component. Other columns are
not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SlotFilter, bounded_batches, landed, scratch, table, with_row

BANDS, ROWS = 44, 6
SLOTS = BANDS * ROWS
PERCENT = 80
PIVOTS = 64
RARE = 16  # members of a pivot that share a rare shingle at most
CHUNK = 200_000  # shingles that are sketched together
CACHED_WORDS = 200_000
LAZY = 8  # ranks for which permutations are traced back; after that they are held
U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class WordHashes(dict):
    """Word -> 64-bit hash; starts anew when it has grown too large."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= CACHED_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingle_set(text: bytes | None, hashes: WordHashes, width: int = 2) -> np.ndarray:
    """Sorted distinct shingle hashes. ``bytes`` lower and split on ASCII alone, as wanted here."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, U)
    h = np.array([hashes[w] for w in words], U)
    width = min(width, len(words))
    if width == 1:
        return np.unique(_mixed(h + U(0x9E3779B97F4A7C15)))
    count = len(h) - width + 1
    out = h[:count]
    for i in range(1, width):
        following = h[i:i + count]
        following = (following << U(31)) | (following >> U(33))
        out = _mixed(out * U(0xD1B54A32D192ED03) + following * U(0x8CB92BA72F3D8DD7))
    return np.unique(out)


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signatures of non-empty sets, one row each. A value is rank << 52 | random bits."""
    sig = np.full(len(sets) * slots, np.iinfo(U).max, U)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    x = np.concatenate(sets) if sets else np.empty(0, U)
    drawn: list[np.ndarray] = []  # the place that each shingle's permutation swapped at each rank
    perm = None
    for rank in range(slots):
        r = _mixed(x + U(((2 * rank + 1) * 0x9E3779B97F4A7C15) & (2**64 - 1)))
        pick = rank + (((_mixed(r + U(0x632BE59BD9B4E019)) >> U(32)) * U(slots - rank)) >> U(32)).astype(np.int64)
        if perm is None:
            slot = pick
            for earlier in range(rank - 1, -1, -1):
                slot = np.where(drawn[earlier] == slot, earlier, slot)
            drawn.append(pick)
        else:
            rows = np.arange(len(x))
            slot = perm[rows, pick].astype(np.int64)
            perm[rows, pick] = perm[:, rank]
        np.minimum.at(sig, doc * slots + slot, (U(rank) << U(52)) | (r >> U(12)))
        open_docs = (sig.reshape(-1, slots).max(axis=1) >> U(52)) > U(rank)
        if not open_docs.any():
            break
        left = open_docs[doc]
        if not left.all():
            x, doc = x[left], doc[left]
            drawn = [d[left] for d in drawn]
            perm = perm if perm is None else perm[left]
        if perm is None and rank + 1 == LAZY and rank + 1 < slots:
            perm = np.tile(np.arange(slots, dtype=np.int16), (len(x), 1))
            rows = np.arange(len(x))
            for step, d in enumerate(drawn):
                taken = perm[rows, d]
                perm[rows, d] = perm[:, step]
                perm[:, step] = taken
    return sig.reshape(-1, slots)


def band_hashes(sig: np.ndarray) -> np.ndarray:
    parts = sig.reshape(len(sig), -1, ROWS)
    h = np.broadcast_to(np.arange(1, parts.shape[1] + 1, dtype=U) * U(0x9E3779B97F4A7C15), parts.shape[:2]).copy()
    for i in range(ROWS):
        h = _mixed(h * U(0xD1B54A32D192ED03) + parts[:, :, i])
    return h


def _set_key(s: np.ndarray) -> np.ndarray:
    return np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64)


def _sketches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        texts, start = batch.column("text"), 0
        while start < batch.num_rows:
            sets, total, end = [], 0, start
            while end < batch.num_rows and total < CHUNK:
                sets.append(shingle_set(texts[end].as_py(), hashes, width))
                total, end = total + len(sets[-1]), end + 1
            keys = np.array([_set_key(s) for s in sets])
            bands = np.zeros((len(sets), BANDS), U)
            filled = [i for i, s in enumerate(sets) if len(s)]
            if filled:
                bands[filled] = band_hashes(signatures([sets[i] for i in filled]))
            part = batch.slice(start, end - start)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("content"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(keys[:, 0]), pa.array(keys[:, 1]),
                pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32()),
                                         pa.array(bands.view(np.int64).ravel()))],
                ["doc_id", "content", "n", "k0", "k1", "bands"])
            start = end


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The sets of the texts, without those whose id stands for another text here."""
    hashes = WordHashes()
    for batch in batches:
        got = []
        for nid, k0, k1, text in zip(*(batch.column(c) for c in ("nid", "k0", "k1", "text")), strict=True):
            s = shingle_set(text.as_py(), hashes, width)
            key = _set_key(s)
            if key[0] == k0.as_py() and key[1] == k1.as_py():
                got.append((nid.as_py(), s.tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in got], pa.int64()),
                                          pa.array([x[1] for x in got], pa.binary())], ["nid", "members"])


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        inter, na, nb = [], [], []
        for a, b in zip(batch.column("sa"), batch.column("sb"), strict=True):
            a, b = (np.frombuffer(x.as_buffer(), U) for x in (a, b))
            both = np.concatenate([a, b])
            both.sort(kind="stable")  # two sorted runs
            inter.append(int((both[1:] == both[:-1]).sum()))
            na.append(len(a))
            nb.append(len(b))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(inter, pa.int64()),
                                          pa.array(na, pa.int64()), pa.array(nb, pa.int64())],
                                         ["a", "b", "inter", "na", "nb"])


def _beyond(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of ``own`` that ``other`` hasn't."""
    def rows(nids: list[int], pivots: list[int], rests: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        sizes = [len(r) for r in rests]
        columns = [np.repeat(np.array(nids, np.int64), sizes), np.repeat(np.array(pivots, np.int64), sizes),
                   np.concatenate(rests).view(np.int64)]
        for i in range(0, sum(sizes), CHUNK):
            yield pa.RecordBatch.from_arrays([pa.array(c[i:i + CHUNK]) for c in columns], ["nid", "pivot", "h"])

    for batch in batches:
        nids, pivots, rests, total = [], [], [], 0
        for nid, pivot, own, other in zip(*(batch.column(c) for c in ("nid", "pivot", "own", "other")), strict=True):
            own, other = (np.frombuffer(x.as_buffer(), U) for x in (own, other))
            at = np.minimum(np.searchsorted(other, own), len(other) - 1)
            nids.append(nid.as_py())
            pivots.append(pivot.as_py())
            rests.append(own[other[at] != own])
            total += len(rests[-1])
            if total >= CHUNK:
                yield from rows(nids, pivots, rests)
                nids, pivots, rests, total = [], [], [], 0
        if rests:
            yield from rows(nids, pivots, rests)


def sketched(docs: DataFrame, width: int = 2) -> DataFrame:
    """doc_id, content (digest of the text), n, k0 and k1 (digest of the set), bands."""
    text = F.coalesce(docs["text"], F.lit("")).cast("binary")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.md5(text).alias("content"), text.alias("text")) \
        .mapInArrow(partial(_sketches, width=width), "doc_id long, content string, n long, k0 long, k1 long, bands array<long>")


def united(edges: DataFrame, work: str) -> DataFrame:
    """nid, label of every node that isn't the smallest of its component."""
    def ordered(a, b):
        return F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")
    edges = landed(edges.where("a <> b").select(*ordered(F.col("a"), F.col("b"))).distinct(), f"{work}/edges0")
    labels, turn = None, 0
    while not edges.isEmpty():
        turn += 1
        hook = edges.groupBy("hi").agg(F.min("lo").alias("to"))
        hook, halving = landed(hook, f"{work}/hook{turn}"), 0
        while True:  # until every path ends at its root
            halving += 1
            step = hook.select(F.col("hi").alias("to"), F.col("to").alias("next"))
            hook = landed(hook.select("hi", "to").join(step, "to", "left").select(
                "hi", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")),
                f"{work}/halved{turn}-{halving}")
            if hook.where("moved").isEmpty():
                break
        step = hook.select(F.col("hi").alias("at"), F.col("to").alias("next"))

        def moved(df: DataFrame, name: str, step: DataFrame = step) -> DataFrame:
            return df.join(step.withColumnRenamed("at", name), name, "left") \
                .withColumn(name, F.coalesce("next", name)).drop("next")
        own = hook.select(F.col("hi").alias("nid"), F.col("to").alias("label"))
        labels = landed(own if labels is None else moved(labels, "label").select("nid", "label").union(own),
                        f"{work}/labels{turn}")
        edges = landed(moved(moved(edges, "hi"), "lo").where("hi <> lo")
                       .select(*ordered(F.col("hi"), F.col("lo"))).distinct(), f"{work}/edges{turn}")
    if labels is None:
        return edges.select(F.col("hi").alias("nid"), F.col("lo").alias("label"))
    return labels


def _linked(inter: str = "inter", na: str = "na", nb: str = "nb"):
    return F.expr(f"100 * {inter} >= {PERCENT} * ({na} + {nb} - {inter})")


class NearDuplicates:
    """``decide`` gives one row per document: doc_id, content, n, k0, k1, label (of its group; null for an
    empty set), component_id. Rows with a null id take part only if ``null_ids`` is set."""

    def __init__(self, docs: DataFrame, width: int = 2, null_ids: bool = False):
        self.docs, self.spark, self.width, self.null_ids = docs, docs.sparkSession, width, null_ids
        self.work = scratch(self.spark, "near-dedup")
        bounded_batches(self.spark)

    def _land(self, df: DataFrame, name: str) -> DataFrame:
        return landed(df, f"{self.work}/{name}")

    def _verified(self, pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
        """a, b, inter, na, nb of pairs whose sizes allow a link."""
        n = self.classes.select("nid", "n")
        able = pairs.join(n.toDF("a", "na"), "a").join(n.toDF("b", "nb"), "b") \
            .where(f"100 * least(na, nb) >= {PERCENT} * greatest(na, nb)").select("a", "b")
        return self._land(able.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
                          .mapInArrow(_overlaps, "a long, b long, inter long, na long, nb long"), name)

    def decide(self) -> DataFrame:
        sketch = self._land(sketched(self.docs, self.width), "sketch")
        classes = sketch.where("n > 0" if self.null_ids else "n > 0 AND doc_id IS NOT NULL").groupBy("k0", "k1").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "content")).alias("s"),
            F.first("n").alias("n"), F.first("bands").alias("bands")).select("k0", "k1", "s.doc_id", "s.content", "n", "bands")
        self.classes = classes = self._land(classes.withColumn("nid", F.monotonically_increasing_id()), "classes")
        rows = classes.select("nid", F.explode("bands").alias("band"))
        counts = rows.groupBy("band").agg(F.count("*").alias("c")).where("c > 1")
        members = self._land(rows.join(counts, "band"), "shared")
        weight = members.groupBy("nid").agg(F.sum("c").alias("weight"))
        pivots = members.join(weight, "nid").groupBy("band") \
            .agg(F.max(F.struct("weight", "nid")).getField("nid").alias("pivot"))
        members = members.select("band", "nid").join(pivots, "band")
        # the buckets of a pivot as one: those of a group of copies have nearly the same members in all bands
        members = self._land(members.select("pivot", "nid").distinct(), "members")

        wanted = members.select("nid").distinct().join(classes.select("nid", "doc_id", "content", "k0", "k1"), "nid")
        wanted = self._land(wanted, "wanted")
        known = SlotFilter(wanted.select(F.xxhash64("doc_id", "content").alias("key")), "key", f"{self.work}/wanted-filter")
        text = F.coalesce(self.docs["text"], F.lit("")).cast("binary")
        texts = self.docs.select(self.docs["doc_id"].cast("long").alias("doc_id"), F.md5(text).alias("content"), text.alias("text"))
        texts = texts.where(known.passes(known.words, F.xxhash64("doc_id", "content")))  # few texts travel
        found = texts.join(wanted, ["doc_id", "content"]).select("nid", "k0", "k1", "text")
        if self.null_ids:  # copies without an id become one before they travel
            same = texts.where("doc_id IS NULL").groupBy("content").agg(F.first("text").alias("text"))
            found = found.unionByName(same.join(wanted.where("doc_id IS NULL"), "content").select("nid", "k0", "k1", "text"))
        sets = found \
            .mapInArrow(partial(_sets, width=self.width), "nid long, members binary").dropDuplicates(["nid"])
        sets = self._land(sets, "sets")

        pairs = members.where("nid <> pivot").select(F.col("nid").alias("a"), F.col("pivot").alias("b"))
        seen = self._verified(pairs, sets, "verified")
        links = seen.where(_linked()).select("a", "b")
        labels = united(links, f"{self.work}/united")
        labels = self._rest(members, seen, sets, labels)

        least = classes.select("nid", "doc_id").join(labels, "nid", "left") \
            .select("doc_id", "nid", F.coalesce("label", "nid").alias("label"))
        component = least.join(labels.select("label").distinct(), "label", "left_semi").groupBy("label") \
            .agg(F.min("doc_id").alias("component_id"))
        least = least.join(component, "label", "left") \
            .select("nid", "label", F.coalesce("component_id", "doc_id").alias("component_id"))
        known = classes.select("k0", "k1", "nid").join(least, "nid").select("k0", "k1", "label", "component_id")
        takes_part = F.col("n") > 0 if self.null_ids else F.col("doc_id").isNotNull() & (F.col("n") > 0)
        return sketch.drop("bands").join(known, ["k0", "k1"], "left") \
            .withColumn("label", F.when(takes_part, F.col("label"))) \
            .withColumn("component_id", F.when(takes_part, F.col("component_id")).otherwise(F.col("doc_id")))

    def _rest(self, members: DataFrame, seen: DataFrame, sets: DataFrame, labels: DataFrame) -> DataFrame:
        """Goes on with the pivots whose members are in several groups until none has an unverified pair."""
        far = F.expr("1 - inter / (na + nb - inter)")
        known = seen.select(F.col("a").alias("nid"), F.col("b").alias("pivot"), far.alias("d"))
        # what isn't verified against the pivot was ruled out by size: farther than a link, up to 1
        left = members.where("nid <> pivot").join(known, ["nid", "pivot"], "left").select(
            "nid", "pivot", F.coalesce("d", F.lit((100 - PERCENT) / 100)).alias("near"),
            F.coalesce("d", F.lit(1.0)).alias("far"))
        left, turn = left.join(self.classes.select("nid", "n"), "nid"), 0
        while True:
            turn += 1
            label = labels.select("nid", "label")
            left = left.drop("label", "of_pivot") \
                .join(label, "nid", "left").withColumn("label", F.coalesce("label", "nid")) \
                .join(label.toDF("pivot", "of_pivot"), "pivot", "left") \
                .withColumn("of_pivot", F.coalesce("of_pivot", "pivot"))
            left = self._land(left, f"left{turn}")
            still = left.where("label <> of_pivot").select("pivot").distinct()
            left = self._land(left.join(still, "pivot", "left_semi"), f"open{turn}")
            if turn == 1:
                left, links = self._possible(left, sets)
                labels = self._joined(labels, links, 0)
                continue
            outside = left.where("label <> of_pivot")
            if outside.isEmpty():
                return labels
            slot = F.pmod(F.xxhash64("nid"), F.lit(PIVOTS))
            chosen = outside.groupBy("pivot", slot.alias("slot")).agg(F.min("nid").alias("nid")).drop("slot")
            pivots = self._land(left.join(chosen, ["pivot", "nid"]).select("pivot", *[
                F.col(c).alias(f"p_{c}") for c in ("nid", "n", "inside", "often", "label", "near", "far")]), f"pivots{turn}")
            apart = F.greatest(F.col("near") - F.col("p_far"), F.col("p_near") - F.col("far"))
            pairs = left.join(pivots, "pivot").where(F.col("label") != F.col("p_label")) \
                .where("9 * (least(inside, p_inside) + least(often, p_often)) >= 4 * (n + p_n)") \
                .where("5 * least(n, p_n) >= 4 * greatest(n, p_n)") \
                .where(apart <= (100 - PERCENT) / 100 + 1e-9) \
                .select(F.least("nid", "p_nid").alias("a"), F.greatest("nid", "p_nid").alias("b")).distinct()
            links = self._verified(pairs, sets, f"verified{turn}").where(_linked()).select("a", "b")
            labels = self._joined(labels, links, turn)
            left = left.join(pivots.select("pivot", F.col("p_nid").alias("nid")), ["pivot", "nid"], "left_anti")

    def _possible(self, left: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Members with ``inside``, the number of their shingles that their pivot has too, and ``often``, of
        the others those that many members of the pivot have, without those that have too few of both for a
        link with the smallest partner their pivot can offer; and the links between members of different
        groups that share a rare shingle."""
        pairs = left.select("nid", "pivot", "n", "label")
        rows = pairs.join(sets.toDF("nid", "own"), "nid").join(sets.toDF("pivot", "other"), "pivot") \
            .select("nid", "pivot", "own", "other").mapInArrow(_beyond, "nid long, pivot long, h long")
        rows = self._land(rows, "beyond")
        counts = rows.groupBy("pivot", "h").agg(F.count("*").alias("c")).where("c > 1")
        rows = self._land(rows.join(counts, ["pivot", "h"], "left"), "shingles")
        sums = rows.groupBy("nid", "pivot").agg(F.count("*").alias("beyond"), F.count_if(F.col("c") > RARE).alias("often"))
        known = self._land(pairs.join(sums, ["nid", "pivot"], "left").select(
            "nid", "pivot", "n", "label", F.expr("n - coalesce(beyond, 0)").alias("inside"),
            F.coalesce("often", F.lit(0)).alias("often")), "inside")
        rare = rows.where(F.col("c") <= RARE)
        met = rare.select("pivot", "h", F.col("nid").alias("a")) \
            .join(rare.select("pivot", "h", F.col("nid").alias("b")), ["pivot", "h"]) \
            .where("a < b").groupBy("pivot", "a", "b").agg(F.count("*").alias("r"))
        able = met.join(known.toDF("a", "pivot", "na", "la", "ia", "oa"), ["a", "pivot"]) \
            .join(known.toDF("b", "pivot", "nb", "lb", "ib", "ob"), ["b", "pivot"]) \
            .where("la <> lb AND 9 * (least(ia, ib) + r + least(oa, ob)) >= 4 * (na + nb)").select("a", "b").distinct()
        links = self._verified(able, sets, "verified-rare").where(_linked()).select("a", "b")
        smallest = left.groupBy("pivot").agg(F.min("n").alias("smallest"))
        # overlap >= 4/9 of both sizes together, and the partner has 4/5 of the size at least
        left = left.join(known.drop("n", "label"), ["nid", "pivot"]).join(smallest, "pivot") \
            .where("45 * (inside + often) >= 4 * greatest(9 * n, 5 * (n + smallest))").drop("smallest")
        return self._land(left, "possible"), links

    def _joined(self, labels: DataFrame, links: DataFrame, turn: int) -> DataFrame:
        """``labels`` after the groups on both sides of each link have become one."""
        if links.isEmpty():
            return labels
        for side in ("a", "b"):
            links = links.join(labels.toDF(side, "label"), side, "left") \
                .withColumn(side, F.coalesce("label", side)).drop("label")
        new = united(links, f"{self.work}/united{turn}")
        step = new.toDF("label", "next")
        moved = labels.join(step, "label", "left").select("nid", F.coalesce("next", "label").alias("label"))
        return self._land(moved.union(new), f"labels{turn}")


def one_of_each_group(docs: DataFrame, width: int = 2) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group one row stays, that with the smallest id (rows
    without an id come last; of several texts under that id, the one with the smallest digest; of repeated
    rows, one). Different groups under one id each keep a row. Of texts without words, repeated rows become
    one, and rows without an id stay."""
    run = NearDuplicates(docs, width, null_ids=True)
    decided = run._land(run.decide().where("n > 0 OR doc_id IS NOT NULL").groupBy("label", "doc_id", "content")
                        .agg(F.count("*").alias("n")), "decided")
    # documents with an empty set are their own group
    own = F.when(F.col("label").isNull(), F.struct("doc_id", "content")).alias("own")
    stay = decided.groupBy("label", own) \
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "content", "n")).alias("s")) \
        .select("s.doc_id", "s.content", (F.col("s.n") > 1).alias("repeated"))
    stay = run._land(stay, "stay")
    text = F.coalesce(docs["text"], F.lit("")).cast("binary")
    rows = docs.select(with_row(docs).alias("row"), docs["doc_id"].cast("long").alias("doc_id"),
                       F.md5(text).alias("content"), docs["text"].rlike(r"[^\x20\x09-\x0D]").alias("words"))
    # only rows that may have to go are joined with those that stay
    key = F.xxhash64("doc_id", "content")
    moving = decided.where("doc_id IS NOT NULL").join(stay.where("NOT repeated"), ["doc_id", "content"], "left_anti")
    known = SlotFilter(run._land(moving.select(key.alias("key")), "moving"), "key", f"{run.work}/moving-filter")
    may_go = known.passes(known.words, key)
    calm = rows.where(F.col("doc_id").isNotNull() & ~may_go)
    kept = rows.where(F.col("doc_id").isNotNull() & may_go).join(stay, ["doc_id", "content"])
    if not stay.where("repeated AND doc_id IS NOT NULL").isEmpty():
        kept = kept.where("NOT repeated").unionByName(
            kept.where("repeated").dropDuplicates(["doc_id", "content"]))
    without = rows.where("doc_id IS NULL")
    one = without.where("words").groupBy("content").agg(F.first("row").alias("row")) \
        .join(stay.where("doc_id IS NULL").select("content"), "content", "left_semi")
    return calm.select("row").unionByName(kept.select("row")).unionByName(one.select("row")) \
        .unionByName(without.where("NOT coalesce(words, false)").select("row")).select("row.*")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = NearDuplicates(table(spark, sf_dir, "documents"), width=2).decide()
    return decided.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                          F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)),
       lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM w),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sh),
rare AS (SELECT *, row_number() OVER (PARTITION BY x.doc_id ORDER BY df, g) AS r FROM x JOIN (SELECT g, count(*) AS df FROM x GROUP BY g) USING (g)),
-- sets with 80 percent in common share one of the rarest fifth of their shingles
pre AS (SELECT doc_id, n, g FROM rare WHERE r <= n - ceil(n * 0.8) + 1),
pairs AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM pre a JOIN pre b ON a.g = b.g AND a.doc_id < b.doc_id
          WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
links AS (SELECT a, b FROM (SELECT p.a, p.b, len(x.s) AS na, len(y.s) AS nb, len(list_intersect(x.s, y.s)) AS i
          FROM pairs p JOIN sh x ON x.doc_id = p.a JOIN sh y ON y.doc_id = p.b) WHERE 100 * i >= 80 * (na + nb - i)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a)
SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id,
       doc_id = least(doc_id, coalesce(m, doc_id)) AS kept
FROM sh LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) r ON r.a = sh.doc_id
"""
