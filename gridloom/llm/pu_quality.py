"""Quality classifier by positive-unlabelled learning.

Known-good documents (trusted positives) and all other web text (unlabelled) are enough: with the
class prior p, the risk of a scorer g under a loss l is

    p E+[l(g)] + max(0, Eu[l(-g)] - p E+[l(-g)]),

the non-negative unbiased risk.  With a linear g over text-shape features and the squared loss, each
expectation is a quadratic form in the moments E[x] and E[x x'].  Moments are sums, so one pass over
every document, pre-aggregated in its task, gathers all that the risk depends on; the driver then
minimises it over matrices of fixed size.  No document is sampled or sent to the driver.

The prior comes from a first scorer (positives against unlabelled) as the least ratio of the two
groups' upper tails.  A second pass counts scores of both groups in fixed bins, and the score of a
document is p f+(bin) / fu(bin), made monotone.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import materialise, small_batches

BINS = 400
_LOW, _HIGH = -3.0, 3.0
_PROBES = b"\n .,!?|#$%&*;:()[]{}<>=/\\@_-+'\"0~^`"


#: What a short text's shares are drawn towards: bytes, words and usual shares of prose.
_BYTES, _WORDS, _UPPER, _USUAL = 40, 8, 0.03, {" ": 0.15, ".": 0.015, ",": 0.012}
_USUALLY = np.array([_USUAL.get(chr(b), 0.0) for b in _PROBES])


def features_of(text: str | None) -> np.ndarray:
    """Shape of a text: shares of byte classes and of probe characters, word lengths, repetition.

    Nothing here is a word or a language; an empty text has zeros and the empty flag.
    """
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    n = len(raw)
    if n == 0:
        return np.concatenate([[1.0], np.zeros(FEATURES - 1)])
    counts = np.bincount(raw, minlength=256).astype(float)
    upper, lower, digit = counts[65:91].sum(), counts[97:123].sum(), counts[48:58].sum()
    high = counts[128:].sum()
    letters = upper + lower + high + _BYTES
    upper = (upper + _UPPER * _BYTES) / letters
    high = high / letters
    probes = (counts[np.frombuffer(_PROBES, np.uint8)] + _BYTES * _USUALLY) / (n + _BYTES)
    words = text.split()
    m = len(words) + _WORDS
    lengths = np.minimum(np.fromiter(map(len, words), np.int64, len(words)), 24) if words else np.zeros(1, np.int64)
    spread = np.bincount(lengths // 3, minlength=9)[:9] / m
    lines = text.split("\n")
    tails = sum(w[-1] in "!#$%&*|" for w in words) / m
    bars = sum(w == "|" for w in words) / m
    stutter = sum(map(str.__eq__, words, words[1:])) / m
    shares = counts[counts > 0] / n
    bare = [
        0.0, upper, high, digit / (n + _BYTES), tails, bars, stutter,
        (len(words) - len(set(words))) / m, 1 - len(set(lines)) / len(lines),
        -(shares * np.log(shares)).sum() / 5, lengths.mean() / 10, lengths.std() / 5,
        np.log1p(m) / 10, np.log1p(n / len(lines)) / 10,
        float(upper > 0.4), float(tails > 0.2), float(bars > 0.1), float(stutter > 0.2), float(stutter > 0.05), float(probes[4:].sum() > 0.05),
    ]
    return np.concatenate([bare, np.sqrt(probes), spread])


FEATURES = 20 + len(_PROBES) + 9


@dataclass(frozen=True)
class Model:
    """A fitted scorer: weights over features, and the calibrated score of each bin."""

    weights: np.ndarray
    scores: np.ndarray
    prior: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return _bins(x, self.weights)

    def to_json(self) -> str:
        return json.dumps({"weights": self.weights.tolist(), "scores": self.scores.tolist(), "prior": self.prior})


def _bins(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    g = x @ weights[:-1] + weights[-1]
    return np.clip(((g - _LOW) / (_HIGH - _LOW) * BINS).astype(np.int64), 0, BINS - 1)


def with_features(docs: DataFrame, text: str = "text", out: str = "shape") -> DataFrame:
    """Add ``out``: :data:`FEATURES` floats for each whole text."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([features_of(t).astype(np.float32) for t in texts], dtype=object)

    return small_batches(docs).withColumn(out, of(F.col(f"`{text}`")))


def _gather(featured: DataFrame, size: int, one_pass) -> np.ndarray:
    """Sum of one vector of fixed length per group over all rows; rows of ``trusted``, then of all."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((2, size))
        for batch in batches:
            if len(batch):
                x = np.stack(batch["shape"].to_list()).astype(float)
                for group, rows in enumerate((x[batch["trusted"].to_numpy(bool)], x)):
                    if len(rows):
                        sums[group] += one_pass(rows)
        yield pd.DataFrame({"grp": [0, 1], "sums": list(sums)})

    parts = featured.select("shape", "trusted").mapInPandas(part, "grp int, sums array<double>")
    each = parts.select("grp", F.posexplode("sums").alias("at", "v")).groupBy("grp", "at").agg(F.sum("v").alias("v"))
    out = np.zeros((2, size))
    for r in each.collect():  # 2 * size numbers, whatever the input
        out[r["grp"], r["at"]] = r["v"]
    return out


def _moments(x: np.ndarray) -> np.ndarray:
    x = np.c_[x, np.ones(len(x))]
    return np.append((x.T @ x).ravel(), x.sum(0))


def _minimise(plus: np.ndarray, m_plus: np.ndarray, all_: np.ndarray, m_all: np.ndarray, prior: float, ridge: float, steps: int) -> np.ndarray:
    """Non-negative risk minimised by steps that follow the unbiased risk while its negative part is
    positive, and shrink that part where it is not."""
    d = len(m_plus)
    scale = np.sqrt(np.maximum(np.diag(all_), 1e-9))
    q_plus, q_all = plus / np.outer(scale, scale), all_ / np.outer(scale, scale)
    b_plus, b_all = m_plus / scale, m_all / scale
    penalty = ridge * np.eye(d)
    # squared loss l(z) = (1 - z)^2 / 4: p E+[l(g)] - p E+[l(-g)] is linear in g
    w = np.linalg.solve(q_all / 2 + penalty, (prior * b_plus + prior * b_plus - b_all) / 2)
    step = 0.5 / (np.linalg.eigvalsh(q_all / 2)[-1] + ridge)

    def part(q: np.ndarray, b: np.ndarray, w: np.ndarray, mass: float) -> float:
        return (mass + 2 * w @ b + w @ q @ w) / 4  # E[l(-g)]

    for _ in range(steps):
        negative = part(q_all, b_all, w, 1.0) - prior * part(q_plus, b_plus, w, 1.0)
        slope = (b_all + q_all @ w) / 2 - prior * (b_plus + q_plus @ w) / 2
        if negative >= 0:
            slope = slope + prior * (q_plus @ w - b_plus) / 2
        else:
            slope = -slope
        w = w - step * (slope + 2 * ridge * w)
    return w / scale


def _prior(plus: np.ndarray, all_: np.ndarray) -> float:
    """Least ratio of unlabelled to trusted mass in the upper tails that hold enough of both."""
    f, u = plus[::-1].cumsum() / max(plus.sum(), 1), all_[::-1].cumsum() / max(all_.sum(), 1)
    slack = 1 / np.sqrt(max(plus.sum(), 1))
    enough = f > 0.2
    return float(np.clip(((u + slack) / np.maximum(f - slack, 1e-6))[enough].min(), 0.01, 0.99)) if enough.any() else 0.5


def _calibrate(plus: np.ndarray, all_: np.ndarray, prior: float) -> np.ndarray:
    """Monotone p f+/fu by pooling adjacent violators, interpolated over empty bins."""
    f, u = plus / max(plus.sum(), 1) * prior, all_ / max(all_.sum(), 1)
    floor = 1 / max(all_.sum(), 1)
    blocks: list[list[float]] = []
    for a, b in zip(f, u, strict=True):
        blocks.append([a, b, 1])
        while len(blocks) > 1 and blocks[-2][0] * (blocks[-1][1] + floor) >= blocks[-1][0] * (blocks[-2][1] + floor):
            a2, b2, n2 = blocks.pop()
            blocks[-1][0] += a2
            blocks[-1][1] += b2
            blocks[-1][2] += n2
    return np.clip(np.concatenate([np.full(int(n), a / max(b, floor)) for a, b, n in blocks]), 0.0, 1.0)


def fit(featured: DataFrame, trusted: Column, prior: float | None = None, ridge: float | None = None, steps: int = 2000) -> Model:
    """Fit on all rows of a table with ``shape``; ``trusted`` marks the known positives.

    Without any trusted row every document scores 0.5.  Rows where ``trusted`` is null are unlabelled.
    """
    featured = featured.select("shape", F.coalesce(trusted, F.lit(False)).alias("trusted"))
    d = FEATURES + 1
    (plus, every) = _gather(featured, d * d + d, _moments)
    n_plus, n_all = plus[-1], every[-1]
    if n_plus == 0 or n_all == 0:
        return Model(np.zeros(d), np.full(BINS, 0.5), 0.5)
    ridge = ridge or float(np.clip(1 / n_plus, 4e-4, 3e-3))
    square = lambda v, n: v[: d * d].reshape(d, d) / n
    mean = lambda v, n: v[d * d :] / n
    moments = (square(plus, n_plus), mean(plus, n_plus), square(every, n_all), mean(every, n_all))

    def counted(weights: np.ndarray) -> np.ndarray:
        return _gather(featured, BINS, lambda x: np.bincount(_bins(x, weights), minlength=BINS).astype(float))

    if prior is None:
        prior = _prior(*counted(_minimise(*moments, 0.5, ridge, 0)))
    weights = _minimise(*moments, prior, ridge, steps)
    return Model(weights, _calibrate(*counted(weights), prior), prior)


def score(featured: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """Add ``out``: probability of good quality, from 0 to 1, of rows with ``shape``.

    Repeated rows are alike, an empty table gives an empty one; a column called ``out`` is replaced, others stay.
    """

    @F.pandas_udf(T.DoubleType())
    def of(shapes: pd.Series) -> pd.Series:
        if not len(shapes):
            return pd.Series([], dtype=float)
        return pd.Series(model.scores[model.bins(np.stack(shapes.to_list()).astype(float))])

    return featured.withColumn(out, of("shape"))


def classify(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, threshold: float = 0.7, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, ``quality_score``, ``quality_ok`` (score at least ``threshold``) and ``carry`` of each row of ``docs``.

    ``labels`` has doc_id and quality; a document counts as trusted if it has a label 1, and none 0,
    outside ``held_out`` (over doc_id).  Every other document, held-out ones included, is unlabelled
    text.  Null or empty texts get the score of texts with no shape; repeated rows score alike; null
    labels and ids are no labels.  Documents are joined to at most one label row.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    if held_out is not None:
        known = known.where(~held_out)
    known = known.groupBy("doc_id").agg((F.min("quality") == 1).alias("_trusted"))
    more = [c for c in carry if c not in ("doc_id", "text")]
    featured = with_features(docs.select("doc_id", "text", *more))
    featured = materialise(featured if "text" in carry else featured.drop("text"), "pu-shapes")
    # rows keep their place: only shapes meet the labels
    marked = materialise(featured.select("doc_id", "shape").join(known, "doc_id", "left").select("shape", "_trusted"), "pu-marked")
    model = fit(marked, F.col("_trusted"))
    return score(featured, model, "quality_score").select("doc_id", "quality_score", (F.col("quality_score") >= threshold).alias("quality_ok"), *carry)
