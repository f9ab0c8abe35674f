"""A quality classifier learned from trusted positives and unlabelled text (non-negative risk, public: Kiryo et al., 2017).

Texts are described by the shapes of their words (letters, capitals, digits, other characters as they are) and by
some shares: repeated, distinct, upper-case and symbol-bearing words. A linear model on these minimises
prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)); the prior of good text is estimated from
where a first model finds unlabelled text scarcest against positives. Fitting sees a bounded, documented sample;
scoring is a vectorised function over all whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import CHUNK_BYTES, Known, chunks, codes

SHAPES = 512
_DENSE = 12
_RULES = ((re.compile(rb"[A-Z]+"), b"A"), (re.compile(rb"[a-z\x80-\xff]+"), b"a"), (re.compile(rb"[0-9]+"), b"0"))


@dataclass(frozen=True)
class Fit:
    """Bounds of the fitting sample (rows) and settings of the descent."""

    positives: int = 4000
    unlabelled: int = 6000
    steps: int = 250
    rate: float = 0.05
    decay: float = 1e-4
    seed: int = 11


@dataclass(frozen=True)
class Model:
    """``score`` = sigmoid((features - mean) / spread · weight + bias)."""

    weight: np.ndarray
    bias: float
    mean: np.ndarray
    spread: np.ndarray
    prior: float


def _shape(word: bytes) -> tuple[int, int]:
    """(hashed shape, kind: 1 upper case of two letters or more, 2 symbols at the end, 4 no letter or digit)."""
    shape = word
    for rule, sign in _RULES:
        shape = rule.sub(sign, shape)
    kind = (1 if b"A" in shape and b"a" not in shape and len(word) > 1 else 0) + (2 if len(shape) > 2 and shape[-2:].isascii() and not shape[-2:].isalnum() and shape[-2] == shape[-1] else 0)
    kind += 0 if re.search(rb"[aA0]", shape) else 4
    return xxhash.xxh3_64_intdigest(shape[:24]) % SHAPES, kind


_SHAPE = Known(_shape)


def _shapes(found: list[bytes]) -> np.ndarray:
    return np.array([_SHAPE[w] for w in found], np.int64).reshape(-1, 2)


def features(texts: list[str | None]) -> np.ndarray:
    """One row of SHAPES + 12 numbers for each whole text; null and empty texts give zeros."""
    found = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in texts]
    n = np.array([len(w) for w in found], np.int64)
    flat = [w for ws in found for w in ws]
    docs = len(texts)
    owner = np.repeat(np.arange(docs), n)
    out = np.zeros((docs, SHAPES + _DENSE), np.float32)
    if not flat:
        return out
    code, shape = codes(flat), _shapes(flat)
    counts = np.bincount(owner * SHAPES + shape[:, 0], minlength=docs * SHAPES).reshape(docs, SHAPES)
    some = np.maximum(n, 1)
    out[:, :SHAPES] = np.sqrt(counts / some[:, None])
    share = lambda mask: np.bincount(owner[mask], minlength=docs) / some
    again = np.zeros(len(flat), bool)
    again[1:] = (code[1:] == code[:-1]) & (owner[1:] == owner[:-1])
    key = np.sort((owner.astype(np.uint64) << np.uint64(52)) | (code >> np.uint64(12)))
    new = np.concatenate(([True], key[1:] != key[:-1]))
    distinct = np.bincount((key[new] >> np.uint64(52)).astype(np.int64), minlength=docs)
    size = np.array([len(w) for w in flat])
    dense = [
        share(again), np.sqrt(share(again)), 1 - distinct / some, np.maximum(0, 1 - distinct / np.maximum(1, some ** 0.8)),
        share((shape[:, 1] & 1) > 0), share((shape[:, 1] & 2) > 0), share((shape[:, 1] & 4) > 0), np.log1p(n) / 10,
        np.bincount(owner, size, docs) / some / 10, (n > 0) * 1.0, (n < 20) * 1.0, share(size > 20),
    ]
    out[:, SHAPES:] = np.stack(dense, axis=1)
    return out


def _pieces(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Runs of texts of bounded size."""
    start = total = 0
    for i, t in enumerate(texts):
        size = len(t or "")
        if i > start and (total + size > CHUNK_BYTES or i - start >= 1000):
            yield texts[start:i]
            start, total = i, 0
        total += size
    if start < len(texts):
        yield texts[start:]


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches, "text", 1000):
        x = features(part.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("kinds"), pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "kinds", "x"])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _descend(xp: np.ndarray, xu: np.ndarray, prior: float, fit: Fit, plain: bool = False) -> tuple[np.ndarray, float]:
    """Adam on the non-negative risk with logistic loss; ``plain`` tells positives from unlabelled instead."""
    w = np.zeros(xp.shape[1] + 1, np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    xp1, xu1 = (np.hstack([x, np.ones((len(x), 1), np.float32)]) for x in (xp, xu))
    for t in range(1, fit.steps + 1):
        sp, su = _sigmoid(xp1 @ w), _sigmoid(xu1 @ w)
        up, un = xp1.T @ (sp - 1) / len(xp1), xu1.T @ su / len(xu1)
        if plain:
            grad = up + un
        else:
            risk_n = -np.log(np.maximum(1 - su, 1e-12)).mean() + prior * np.log(np.maximum(1 - sp, 1e-12)).mean()
            down = un - prior * (xp1.T @ sp) / len(xp1)
            grad = prior * up + down if risk_n >= 0 else -down
        grad = grad + fit.decay * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= (fit.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return w[:-1], float(w[-1])


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled: the smallest ratio of tail masses above any score.

    Only the unlabelled positives lie where positives are; the ratio of the masses above a score can't be less than
    their share. Tails of less than half the positives are too noisy to be looked at.
    """
    best = 1.0
    for t in np.quantile(positive, np.linspace(0.0, 0.5, 51)):
        p, u = (positive >= t).mean(), (unlabelled >= t).mean()
        slack = 0.5 * np.sqrt(u * (1 - u) / max(1, len(unlabelled)))  # against the luck of the smallest of many ratios
        best = min(best, (u + slack) / p)
    return float(min(0.99, max(0.01, best)))


def fit_pu(positives: np.ndarray, unlabelled: np.ndarray, fit: Fit = Fit()) -> Model:
    """A model from the features of two samples. Without rows in one of them every score is a half."""
    xp, xu = positives, unlabelled
    width = SHAPES + _DENSE
    if not len(xp) or not len(xu):
        return Model(np.zeros(width), 0.0, np.zeros(width), np.ones(width), 0.5)
    both = np.concatenate([xp, xu])
    mean, spread = both.mean(axis=0, dtype=np.float64), both.std(axis=0, dtype=np.float64) + 0.02
    xp, xu = ((x - mean) / spread for x in (xp, xu))
    xp, xu = xp.astype(np.float32), xu.astype(np.float32)
    # Halves: scores of rows that a model was fitted on are too far apart to estimate from.
    w, b = _descend(xp[::2], xu[::2], 0.5, fit, plain=True)
    odd = (xp[1::2], xu[1::2]) if len(xp) > 1 and len(xu) > 1 else (xp, xu)
    prior = estimate_prior(*(x @ w + b for x in odd))
    w, b = _descend(xp, xu, prior, fit)
    return Model(w, b, mean, spread, prior)


def score_column(model: Model, text: str = "text") -> Column:
    """The score (0 to 1) of each whole text; the model is a few kilobytes of any corpus."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        found = [_sigmoid((features(x) - model.mean) / model.spread @ model.weight + model.bias) for x in _pieces([t if isinstance(t, str) else None for t in texts])]
        return pd.Series(np.concatenate(found) if found else np.zeros(0))

    return score(text)


def held_out(id: str = "doc_id") -> Column:
    """Whether a row is kept from fitting: crc32 of its id as text, modulo 5, is 0. Null ids are not held out, nor fitted on."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % 5 == 0, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> Model:
    """Fits on rows that are not held out: labelled good ones, and documents regardless of labels, both by a seeded
    hash of their ids up to the bounds of ``fit``. Ids with several labels count as good if any is 1; labels other
    than 1 are not looked at."""
    draw = F.xxhash64(F.lit(fit.seed), "doc_id")
    good = labels.where("quality = 1 and doc_id is not null").where(~held_out()).select(F.col("doc_id").cast("long")).distinct()
    good = good.orderBy(draw, "doc_id").limit(fit.positives)
    some = docs.where("doc_id is not null").where(~held_out()).select("doc_id").distinct().orderBy(draw, "doc_id").limit(fit.unlabelled)
    picked = good.withColumn("kind", F.lit("p")).union(some.withColumn("kind", F.lit("u")))
    ids = picked.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))  # at most positives + unlabelled rows
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"])
    rows = texts.select("doc_id", "kinds", "text").mapInArrow(_described, "doc_id long, kinds array<string>, x binary").orderBy("doc_id").collect()
    both = [np.frombuffer(b"".join(r["x"] for r in rows if kind in r["kinds"]), np.float32).reshape(-1, SHAPES + _DENSE) for kind in "pu"]
    return fit_pu(*both, fit)


def score_quality(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 at a score of ``threshold`` or more); columns of these names are replaced.

    Every row is scored by its whole text alone; null and empty texts get the score of a text without words.
    """
    return docs.withColumn("score", score_column(model)).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
