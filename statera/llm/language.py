r"""Language identification by error-correcting output codes.

Each language learnt gets a codeword; one binary classifier per bit tells the languages with 1
from those with 0 by hashed n-grams of bytes of the lowered letters. A classifier's weights are
log ratios of n-gram frequencies, from sums per language that Spark adds up over all partitions;
documents weigh alike whatever their length. Decoding sums for each codeword the losses of its
bits at the margins found, weighted by how well the bit separates its languages, and takes the
codeword with the least. ``score`` is its share after a softmax of the losses; ``ambiguous`` says
that the next one is close.

Learns from text and lang alone, of rows with a lang and with a crc32 of the id as text whose
remainder by 3 isn't 1; rows with a null id are not learnt from. A text that is null or has no
letter is ``und`` with score 0, as is every text if there is nothing to learn from. Languages
beyond ``MAX_LANGUAGES`` (by name) raise an error rather than being dropped. Code words have a bit for each way to
split up to ``EXHAUSTIVE`` languages in two, and ``BITS`` bits drawn with a fixed seed for more of them. Repeated rows are
predicted alike; ``held_out`` is null for a null id; other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, crc32_mod, landed, scratch, table

FOLDS, HELD_OUT = 3, 1
TRI, BI = 4096, 1024  # slots of hashed 3-grams and 2-grams
SIZE = TRI + BI
EXHAUSTIVE, BITS = 6, 63  # up to 6 languages all splits are bits; else as many, drawn with a fixed seed
MAX_LANGUAGES = 1000
SHARPNESS, CLOSE = 8.0, 0.1
CHUNK = 256
LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))  # other ASCII to blanks


def n_grams(text: str) -> np.ndarray | None:
    """Frequencies of hashed n-grams; None without a letter."""
    if not text or not any(map(str.isalpha, text)):  # category L; digits such as ½, ² and ① are none
        return None
    cleaned = b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(LETTERS).split()) + b" "
    b = np.frombuffer(cleaned, np.uint8).astype(np.uint32)
    two = b[:-1] * np.uint32(256) + b[1:]
    three = two[:-1] * np.uint32(256) + b[2:]
    counts = np.concatenate([
        np.bincount((three * np.uint32(2654435761)) >> np.uint32(20), minlength=TRI),
        np.bincount((two * np.uint32(2654435761)) >> np.uint32(22), minlength=BI)])
    return counts / len(b)


def codewords(k: int) -> np.ndarray:
    """k rows of +1 and -1, all different, without constant bits where k > 1."""
    if k <= 1:
        return np.ones((k, 1))
    if k <= EXHAUSTIVE:
        return np.array([(1.0, *c) for c in itertools.product((1.0, -1.0), repeat=k - 1) if -1.0 in c]).T
    rng, best, far = np.random.default_rng(7), None, -1
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], (k, BITS))
        code[0, np.abs(code.sum(axis=0)) == k] *= -1
        apart = int(((BITS - code @ code.T) / 2 + BITS * np.eye(k)).min())
        if apart > far:
            best, far = code, apart
    return best


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray       # languages x bits
    weights: np.ndarray    # n-grams x bits
    middle: np.ndarray     # of the margins of a bit's two sides
    spread: np.ndarray     # half the distance of the sides
    trust: np.ndarray      # of the bits, summing to 1

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index, score and ambiguity of each row of n-gram frequencies."""
        margin = np.clip((x @ self.weights - self.middle) / self.spread, -3, 3)
        loss = np.log1p(np.exp(-2 * margin[:, None, :] * self.code[None])) @ self.trust
        share = np.exp(-SHARPNESS * (loss - loss.min(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        ranked = np.sort(share, axis=1)
        close = np.zeros(len(x), bool) if share.shape[1] < 2 else ranked[:, -1] - ranked[:, -2] < CLOSE
        return share.argmax(axis=1), ranked[:, -1], close


def learn(docs: DataFrame) -> Model:
    bounded_batches(docs.sparkSession)
    rows = docs.select(docs["lang"].cast("string").alias("lang"), docs["text"].alias("text"), docs["doc_id"].alias("doc_id")) \
        .where("lang IS NOT NULL AND text IS NOT NULL").where(crc32_mod(F.col("doc_id"), FOLDS) != HELD_OUT) \
        .select("lang", "text")

    def sums(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by: dict[str, np.ndarray] = {}
        for part in parts:
            for lang, text in zip(part["lang"], part["text"], strict=True):
                if (x := n_grams(text)) is not None:
                    if lang not in by:
                        by[lang] = np.zeros(SIZE + 1)
                    by[lang][:SIZE] += x
                    by[lang][SIZE] += 1
        for lang, total in by.items():
            at = np.flatnonzero(total)
            yield pd.DataFrame({"lang": lang, "i": at.astype(np.int32), "v": total[at]})
    summed = rows.mapInPandas(sums, "lang string, i int, v double").groupBy("lang", "i").agg(F.sum("v").alias("v")) \
        .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("sums"))
    found = landed(summed, f"{scratch(docs.sparkSession, 'language')}/sums").orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    seen, totals = [r["lang"] for r in found], {r["lang"]: np.zeros(SIZE + 1) for r in found}
    for r in found:  # SIZE + 1 sums at most each, whatever the corpus
        totals[r["lang"]][[x["i"] for x in r["sums"]]] = [x["v"] for x in r["sums"]]
    code = codewords(len(seen))
    if not seen:
        return Model([], code, np.zeros((SIZE, 1)), np.zeros(1), np.ones(1), np.ones(1))
    mean = np.stack([t[:SIZE] / t[SIZE] for t in totals.values()])  # languages weigh alike
    smooth = 1e-5
    one, other = np.maximum(code.T, 0) @ mean, np.maximum(-code.T, 0) @ mean
    one /= np.maximum((code.T > 0).sum(axis=1), 1)[:, None]
    other /= np.maximum((code.T < 0).sum(axis=1), 1)[:, None]
    weights = np.log((one + smooth) / (other + smooth)).T
    margins = mean @ weights
    if len(seen) == 1:
        return Model(seen, code, weights, np.zeros(1), np.ones(1), np.ones(1))
    above = np.where(code > 0, margins, np.inf).min(axis=0)
    below = np.where(code < 0, margins, -np.inf).max(axis=0)
    gap = np.maximum(above - below, 1e-6)
    return Model(seen, code, weights, (above + below) / 2, gap / 2, gap / gap.sum())


def predicted(model: Model, text: Column) -> Column:
    """struct of lang_pred, score and ambiguous."""
    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        lang, score, close = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        for start in range(0, len(texts) if model.languages else 0, CHUNK):
            found = [(start + i, x) for i, t in enumerate(texts.iloc[start:start + CHUNK]) if (x := n_grams(t)) is not None]
            if found:
                at = [i for i, _ in found]
                best, score[at], close[at] = model.decode(np.stack([x for _, x in found]))
                for i, k in zip(at, best, strict=True):
                    lang[i] = model.languages[k]
        return pd.DataFrame({"lang_pred": lang, "score": score, "ambiguous": close})
    return predict(text)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs)
    return docs.select("doc_id", (crc32_mod(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
                       predicted(model, F.col("text")).alias("p")).select("doc_id", "held_out", "p.*")
