"""Toxicity by compression distance.

Two zstandard dictionaries are trained by zstandard's own trainer, one on windows of toxic text and one
on windows of ordinary text.  A window is one word with every letter between marks of its place in the
word, so that a dictionary tells how a word begins from how one ends, and so that a short word is long
enough to compress; its distance is the length of its compression with the ordinary dictionary less
that with the toxic one.  Runs without spaces (longer than any word, or in a script that has none) have
a window at each character, so that all of a text counts.  Windows beyond a threshold count; a
document's counts beyond each threshold, against what ordinary text of its length has, give its score
by a logistic curve.  Rates and curve are calibrated on labelled documents that trained no dictionary.

Toxic documents are mostly ordinary text, so the toxic dictionary is trained on those of their windows
whose beginnings are significantly commoner in toxic than in ordinary documents.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import small_batches

#: Labelled documents of each class that the fit looks at, at most; characters of a class, and of a document among them.
SAMPLE, SAMPLE_CHARS, TAUGHT_CHARS = 3000, 24_000_000, 200_000
#: Windows that a dictionary is trained on, and its bytes, at most; segment and substring length of the trainer.
TRAINED_ON, TOXIC_BYTES, ORDINARY_BYTES = 300_000, 32768, 98304
SEGMENT, SUBSTRING = 32, 8
LEVEL = 19
THRESHOLDS = tuple(range(-1, 13))
_MARKS = ".,;:!?()[]{}\"'|*#$%&<>-_"

_LONGEST = 40
_SHORTEST, _BEGINNING = 4, 13
_KEPT = 400_000


#: Letters of scripts that put no spaces between words (Thai, Lao, Burmese, Khmer, kana, Han).
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_JOINTS = re.compile(r"[\s/\\_,;:|+=~。、,;:!?・…]+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased words without the marks around them; of a run without spaces the windows at each character."""
    out = []
    for w in _JOINTS.split((text or "").lower()):
        w = w.strip(_MARKS)
        if len(w) > _LONGEST or _UNSPACED.search(w):
            out += [w[i : i + _BEGINNING] for i in range(max(1, len(w) - _SHORTEST + 1))]
        elif w:
            out.append(w)
    return out


def tagged(word: str) -> bytes:
    """A word's letters, each between two marks of its place, and an end."""
    return "".join(chr(0x30 + i) + c + chr(0x30 + i) for i, c in enumerate(word[:_LONGEST] + " ")).encode("utf-8", "surrogatepass")


def beginnings(word: str) -> list[str]:
    word = word + " " if len(word) <= _BEGINNING else word[:_BEGINNING]
    return [word[:i] for i in range(_SHORTEST, len(word) + 1)]


def telling(toxic: list[list[str]], ordinary: list[list[str]], least: int = 4, z: float = 4.5, times: float = 3.0) -> set[str]:
    """Beginnings of words in at least ``least`` toxic documents, significantly commoner there: the signed
    root of the log-likelihood ratio is over ``z``, and the share of documents over ``times`` as large."""
    count = lambda docs: Counter(b for d in docs for b in {b for w in set(d) for b in beginnings(w)})
    in_toxic, in_ordinary = count(toxic), count(ordinary)
    share = len(toxic) / (len(toxic) + len(ordinary))
    out = set()
    for b, n in in_toxic.items():
        m = in_ordinary[b]
        if n >= least and n * len(ordinary) > times * m * len(toxic):
            ratio = n * math.log(n / (n + m) / share) + (m * math.log(m / (n + m) / (1 - share)) if m else 0)
            if 2 * ratio > z * z:
                out.add(b)
    return out


def _dictionary(windows: Iterable[bytes], size: int) -> bytes:
    """A dictionary of at most ``size`` bytes by zstandard's trainer.

    Windows too few to train on make one by themselves, the commonest last (nearest).
    """
    counts = Counter(windows)
    long = sorted(w for w in counts.elements() if len(w) >= SUBSTRING)
    random.Random(1).shuffle(long)
    try:
        return zstandard.train_dictionary(size, long[:TRAINED_ON], k=SEGMENT, d=SUBSTRING, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        held, kept = 0, []
        for window, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
            held += len(window)
            if held <= size:
                kept.append(window)
        return b"".join(reversed(kept))


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    rates: np.ndarray
    means: np.ndarray
    spreads: np.ndarray
    weights: np.ndarray


class Distance:
    """Distance of a window, behind a bounded cache."""

    def __init__(self, toxic: bytes, ordinary: bytes) -> None:
        parameters = zstandard.ZstdCompressionParameters.from_level(LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0)

        def compressor(data: bytes):
            # what the dictionary holds, without the symbol tables that were trained with it: a window is too short for those
            dictionary = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(compression_params=parameters)
            return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters).compress

        self._toxic, self._ordinary = compressor(toxic), compressor(ordinary)
        self._known: dict[str, int] = {}

    def __call__(self, words: list[str]) -> np.ndarray:
        known = self._known
        if len(known) > _KEPT:
            known.clear()
        for w in set(words):
            if w not in known:
                window = tagged(w)
                known[w] = len(self._ordinary(window)) - len(self._toxic(window))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def _beyond(distances: np.ndarray) -> np.ndarray:
    """Numbers of windows at or beyond each threshold, and of all."""
    return np.array([*[(distances >= t).sum() for t in THRESHOLDS], len(distances)], float)


def _features(counts: np.ndarray, rates: np.ndarray) -> np.ndarray:
    n = counts[:, -1:]
    excess = (counts[:, :-1] - n * rates) / np.sqrt(n * rates + 0.3)
    return np.c_[np.sign(excess) * np.log1p(np.abs(excess)), np.log1p(n)]


def fit(toxic: Iterable[str | None], ordinary: Iterable[str | None], odds: float | None = None) -> Model | None:
    """A model from two lists of texts; None without at least ten of each.

    ``odds`` are those of toxic to ordinary text outside the lists, if they are not as in the lists.
    """
    toxic, ordinary = [words_of(t) for t in toxic], [words_of(t) for t in ordinary]
    if len(toxic) < 10 or len(ordinary) < 10:
        return None
    train = lambda docs: [d for i, d in enumerate(docs) if i % 3]
    held = lambda docs: docs[::3]
    signs = telling(train(toxic), train(ordinary)) or telling(train(toxic), train(ordinary), 2, 1.0, 1.0)
    told = {w: any(b in signs for b in beginnings(w)) for d in [*train(toxic), *train(ordinary)] for w in set(d)}
    bad = [tagged(w) for d in train(toxic) for w in set(d) if told[w]]
    good = [tagged(w) for d in train(ordinary) for w in set(d)]
    good += [tagged(w) for d in train(ordinary) for w in set(d) if told[w]] * 4
    distance = Distance(a := _dictionary(bad, TOXIC_BYTES), b := _dictionary(good, ORDINARY_BYTES))
    n_toxic, n_ordinary = (np.array([_beyond(distance(d)) for d in held(docs)]) for docs in (toxic, ordinary))
    rates = (n_ordinary[:, :-1].sum(0) + 0.1) / (n_ordinary[:, -1].sum() + 1)
    x = np.r_[_features(n_toxic, rates), _features(n_ordinary, rates)]
    y = np.r_[np.ones(len(n_toxic)), np.zeros(len(n_ordinary))]
    means, spreads = x.mean(0), x.std(0) + 1e-6
    x = np.c_[(x - means) / spreads, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - w
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w)), slope)
    if odds:
        w[-1] += math.log(odds * len(ordinary) / len(toxic))
    return Model(a, b, rates, means, spreads, w)


def score(docs: DataFrame, model: Model | None, text: str = "text", out: str = "toxicity") -> DataFrame:
    """Add ``out``, from 0 to 1: 0 for null texts and texts without words, and for all without a model."""
    if model is None:
        return docs.withColumn(out, F.lit(0.0))

    @F.pandas_udf(T.DoubleType())
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        distance = Distance(model.toxic, model.ordinary)
        for texts in batches:
            if not len(texts):
                yield pd.Series([], dtype=float)
                continue
            counts = np.array([_beyond(distance(words_of(t))) for t in texts])
            x = (_features(counts, model.rates) - model.means) / model.spreads
            p = 1 / (1 + np.exp(-np.clip(np.c_[x, np.ones(len(x))] @ model.weights, -30, 30)))
            yield pd.Series(np.where(counts[:, -1] > 0, p, 0.0))

    return small_batches(docs).withColumn(out, of(F.col(f"`{text}`")))


def classify(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, threshold: float = 0.5, sample: int = SAMPLE, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, toxicity, toxic (toxicity at least ``threshold``) and ``carry`` for each row of ``docs``.

    ``labels`` has doc_id and toxic; those outside ``held_out`` (over doc_id) are learned from: of each
    class the ``sample`` documents of ``docs`` that come first in the order of a hash of doc_id, as far as
    they have no more than ``SAMPLE_CHARS`` characters together and ``TAUGHT_CHARS`` each.  Null labels,
    ids and texts teach nothing; a document with both labels counts as toxic, and one of several rows
    teaches by the first of its texts; repeated rows score alike.  Columns of ``docs`` that are called
    toxicity or toxic are not looked at; no labels give scores of 0; an empty table gives an empty one.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    if held_out is not None:
        known = known.where(~held_out)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("label"))
    here = docs.select("doc_id", F.length("text").alias("_chars")).where(F.col("_chars").isNotNull()).groupBy("doc_id").agg(F.max("_chars").alias("_chars"))
    here = here.where(F.col("_chars") <= TAUGHT_CHARS).join(known, "doc_id").withColumn("_order", F.xxhash64("doc_id"))
    so_far = Window.partitionBy("label").orderBy("_order", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = [here.where(F.col("label") == label).orderBy("_order", "doc_id").limit(sample) for label in (1, 0)]
    chosen = first[0].unionByName(first[1]).withColumn("_sum", F.sum("_chars").over(so_far)).where(F.col("_sum") <= SAMPLE_CHARS)
    chosen = chosen.select("doc_id", "label")  # 2 * sample documents at most
    taught = docs.select("doc_id", "text").where(F.length("text") <= TAUGHT_CHARS).join(F.broadcast(chosen), "doc_id")
    rows = taught.groupBy("doc_id", "label").agg(F.min("text").alias("text")).orderBy("doc_id").collect()
    sizes = known.agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("all")).head()
    odds = (sizes["toxic"] or 0) / max(1, sizes["all"] - (sizes["toxic"] or 0))
    model = fit([r["text"] for r in rows if r["label"] == 1], [r["text"] for r in rows if r["label"] == 0], odds)
    rows = docs.select("doc_id", "text", *[c for c in carry if c != "text"])
    return score(rows, model).select("doc_id", "toxicity", (F.col("toxicity") >= threshold).alias("toxic"), *carry)
