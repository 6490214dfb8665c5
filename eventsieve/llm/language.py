"""Language ID: averaged hashed subword embeddings with a linear softmax, trained by SGD in numpy.

Features are sequences of two and three characters of the lower-cased text, with every run of
other characters than letters as one word end. Each is hashed to a bucket with an embedding; a
text's vector is the mean over its features, and a linear softmax gives the languages. The model is
fitted on a bounded sample: about ``PER_LANGUAGE`` documents of each language, drawn by hash from
all rows that may be learned from. A fifth of the sample is held back to calibrate the softmax
temperature and the score under which a prediction is marked ``rejected`` (from that score on, a
share of ``ACCEPT`` of the held-back predictions is right).

Defined results: a null text or one without a letter is ``und`` with score 0 and rejected; whole
texts are read, also very long ones; a null doc_id is neither held out nor learned from; repeated
rows count once in the sample; with nothing to learn from, all texts are ``und``; ties go to the
language of least name; an empty table gives an empty result. Other columns are never inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches

PER_LANGUAGE, BUCKETS, SIZE = 600, 1 << 14, 16
EPOCHS, RATE, ACCEPT = 6, 0.5, 0.998
#: Characters that are hashed at once; texts of any length are read in such pieces.
PIECE = 1 << 19

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Code point to itself for letters, to 32 for all else."""
    if not _letters:
        codes = np.arange(0x110000, dtype=np.uint32)
        letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        _letters.append(np.where(letter, codes, np.uint32(32)))
    return _letters[0]


def _hashed(codes: np.ndarray) -> np.ndarray:
    """Buckets of all two and three character sequences but those of word ends alone."""
    a = codes.astype(np.uint64)
    two = a[:-1] * np.uint64(0x9E3779B97F4A7C15) + a[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    three = two[:-1] + a[2:] * np.uint64(0x165667B19E3779F9) + np.uint64(1)
    two = two[(codes[:-1] != 32) | (codes[1:] != 32)]
    three = three[codes[1:-1] != 32]
    x = np.concatenate([two, three])
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(64 - 14)).astype(np.int32)


def buckets(text: str | None):
    """Bucket arrays of a whole text, piece by piece; none without a letter."""
    if not text:
        return
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    codes = _letter_table()[codes]
    keep = np.concatenate(([True], (codes[1:] != 32) | (codes[:-1] != 32)))
    codes = codes[keep]
    if not (codes != 32).any():
        return
    codes = np.concatenate(([32], codes, [32])).astype(np.uint32)
    for a in range(0, len(codes) - 2, PIECE):
        yield _hashed(codes[a : a + PIECE + 2])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1, F.lit(False))


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # bucket x language: embeddings times the linear layer
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def scores(self, text: str | None) -> np.ndarray | None:
        total, n = np.zeros(len(self.languages)), 0
        for b in buckets(text):
            total += self.weights[b].sum(axis=0, dtype=np.float64)
            n += len(b)
        if not n:
            return None
        return softmax((total / n + self.bias) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@F.pandas_udf(T.StructType([T.StructField("bucket", T.ArrayType(T.IntegerType())), T.StructField("share", T.ArrayType(T.FloatType()))]))
def _features(text: pd.Series) -> pd.DataFrame:
    idx, val = [], []
    for t in text:
        count = np.zeros(BUCKETS, np.int64)
        for b in buckets(t):
            count += np.bincount(b, minlength=BUCKETS)
        i = np.flatnonzero(count)
        idx.append(i.astype(np.int32))
        val.append((count[i] / max(1, count.sum())).astype(np.float32))
    return pd.DataFrame({"bucket": idx, "share": val})


def training_sample(docs: DataFrame, per_language: int) -> list:
    """Sparse features of about ``per_language`` documents of each language, by hash order."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.select("lang", "text", F.xxhash64("doc_id", "lang", "text").alias("_h"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("_h", 0.01).alias("n")).collect()}
    if not counts:
        return []
    limit = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(2**63 - 1, int(per_language / n * 2**63)))) for k, n in counts.items()])
    few = rows.filter((F.col("_h").bitwiseAND(2**63 - 1)) <= limit).dropDuplicates(["_h"])
    few = few.select("lang", "_h", _features("text").alias("f")).filter(F.size("f.bucket") > 0)
    return sorted(few.select("lang", "_h", "f.bucket", "f.share").collect(), key=lambda r: (r["_h"], r["lang"]))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, seed: int = 3) -> Model | None:
    """Train and calibrate on the bounded sample; the same rows give the same model."""
    sample = training_sample(docs, per_language)
    if not sample:
        return None
    languages = sorted({r["lang"] for r in sample})
    y = np.array([languages.index(r["lang"]) for r in sample])
    x = [(np.array(r["bucket"]), np.array(r["share"], np.float32)) for r in sample]
    rng = np.random.default_rng(seed)
    check = np.arange(len(x)) % 5 == 4
    train = np.flatnonzero(~check)
    embed = rng.normal(0, 1 / SIZE, (BUCKETS, SIZE)).astype(np.float32)
    linear, bias = np.zeros((SIZE, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    weight = len(train) / np.maximum(1, np.bincount(y[train], minlength=len(languages))) / len(languages)
    steps = EPOCHS * len(train)
    for step, k in enumerate(np.concatenate([rng.permutation(train) for _ in range(EPOCHS)])):
        idx, val = x[k]
        mean = val @ embed[idx]
        error = softmax(mean @ linear + bias)
        error[y[k]] -= 1
        rate = RATE * (1 - step / steps) * min(5.0, weight[y[k]])
        push = linear @ error
        linear -= rate * np.outer(mean, error)
        bias -= 0.1 * rate * error
        embed[idx] -= (rate * len(idx) * 0.05) * np.outer(val, push)
    model = Model(languages, (embed @ linear).astype(np.float32), bias.astype(np.float64))
    held = np.flatnonzero(check) if check.any() else train
    logits = np.array([x[k][1] @ model.weights[x[k][0]] for k in held]) + model.bias
    loss = {t: -np.log(softmax(logits / t)[np.arange(len(held)), y[held]] + 1e-12).mean() for t in np.geomspace(0.2, 4, 30)}
    model.temperature = float(min(loss, key=loss.get))
    p = softmax(logits / model.temperature)
    # the least score from which on predictions are right often enough
    best = np.sort(p.max(axis=1))[::-1]
    right = (p.argmax(axis=1) == y[held])[np.argsort(-p.max(axis=1), kind="stable")]
    fine = np.flatnonzero(np.cumsum(right) >= ACCEPT * np.arange(1, len(held) + 1))
    model.reject_below = float(best[fine[-1]]) if len(fine) else 1.0
    return model


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected."""
    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def language(text: pd.Series) -> pd.DataFrame:
        out = []
        for t in text:
            p = model.scores(t) if model is not None else None
            if p is None:
                out.append(("und", 0.0, True))
            else:
                k = int(p.argmax())
                out.append((model.languages[k], float(p[k]), bool(p[k] < model.reject_below)))
        return pd.DataFrame(out, columns=["lang_pred", "score", "rejected"])

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), language("text").alias("_l")).select(
        "doc_id", "held_out", "_l.*")


def identify(docs: DataFrame) -> DataFrame:
    """Fit on the rows that may be learned from, predict all rows."""
    small_batches(docs.sparkSession)
    return predict(docs, fit(docs))
