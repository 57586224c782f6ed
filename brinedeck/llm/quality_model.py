"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A document's features are its words (hashed, log counts, scaled to length one), the classes
and the values of statistics of its form, and what the table says about it (``n_chars``). The score is the logistic of

    b + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

which is the sum over all pairs i < j of <v_i, v_j> x_i x_j in time linear in the features.

Fitting uses at most ``sample`` labelled documents outside the held-out fifth (those with the
smallest hash of doc_id): tasks turn them into feature lists, and the driver, which holds
bounded data, runs AdaGrad over mini-batches. Scoring reads every whole text.

Cases: null and empty texts have statistics of zero and no words; a null n_chars is a class of
its own; null labels are not used; without both classes among the labels every score is the smoothed share of
good labels; repeated rows are scored alike; an empty table gives an empty result; other
columns (lang, source, doc_id among them) are never inputs.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinedeck.llm.common import ship
from brinedeck.llm.toxicity import held_out, labelled_sample, lists_of

ship(__name__)

#: A score at or above this is predicted good.
THRESHOLD = 0.3
#: Classes that a statistic's value falls into.
CLASSES = 24
STATISTICS = (
    "words", "word_length", "upper", "digits", "signs", "symbols", "marks", "bars", "distinct", "top_word", "repeated", "lines", "repeated_lines", "line_length", "title", "stored", "differs",
)
_UPPER, _DIGITS, _MARKS, _BARS = bytes(range(65, 91)), b"0123456789", b"!?", b"|"
_SYMBOLS = b"#*$%&<>@~^_=+\\"
_SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def _share(raw: bytes, which: bytes, of: int) -> float:
    return (len(raw) - len(raw.translate(None, which))) / max(of, 1)


def statistics(text: str | None, n_chars: float | None) -> tuple[np.ndarray, Counter]:
    """Statistics between 0 and about 1 each, in the order of ``STATISTICS``, and the counts of lower-cased words."""
    whole = text or ""
    raw = whole.encode()
    listed = raw.split()
    counts = Counter(raw.lower().split())
    n, size = len(listed), len(raw)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    pairs = len(set(zip(listed, listed[1:], strict=False)))
    known = n_chars is not None and n_chars == n_chars
    values = [
        math.log1p(n) / 12, size / max(n, 1) / 24, _share(raw, _UPPER, size), _share(raw, _DIGITS, size), _share(raw, _SIGNS, size), min(_share(raw, _SYMBOLS, n) / 4, 1),
        min(_share(raw, _MARKS, n) / 3, 1), min(_share(raw, _BARS, n) / 2, 1), len(counts) / max(n, 1), max(counts.values(), default=0) / max(n, 1), 1 - (pairs + 1) / max(n, 1),
        math.log1p(len(lines)) / 10, 1 - len(set(lines)) / max(len(lines), 1), math.log1p(size / max(len(lines), 1)) / 12, sum(w[:1].isupper() for w in listed) / max(n, 1),
        math.log1p(max(n_chars, 0)) / 16 if known else -1.0, float(known and n_chars != len(whole)),
    ]
    return np.array(values), counts


def features(text: str | None, n_chars: float | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values; words come first, then classes, then plain values."""
    stats, counts = statistics(text, n_chars)
    size = 1 << bits
    hashed = np.array([zlib.crc32(w) & (size - 1) for w in counts], np.int64)
    index, where = np.unique(hashed, return_inverse=True)
    value = np.bincount(where, np.log1p(np.fromiter(counts.values(), float, len(counts))), len(index)) if len(index) else np.zeros(0)
    value = value / max(float(np.sqrt((value**2).sum())), 1e-9)
    place = np.clip(np.floor(stats * (CLASSES - 1)), -1, CLASSES - 2).astype(np.int64) + 1
    numbers = np.arange(len(stats))
    return np.concatenate((index, size + numbers * CLASSES + place, size + len(stats) * CLASSES + numbers)), np.concatenate((value, np.full(len(stats), 0.3), np.clip(stats, -1, 2)))


@dataclass
class FactorisationMachine:
    bias: float
    weight: np.ndarray
    factors: np.ndarray

    def margin(self, index: np.ndarray, value: np.ndarray) -> float:
        part = self.factors[index] * value[:, None]
        total = part.sum(axis=0)
        return self.bias + float(self.weight[index] @ value) + 0.5 * float(total @ total - (part * part).sum())

    def score(self, text: str | None, n_chars: float | None, bits: int) -> float:
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, self.margin(*features(text, n_chars, bits))))))


def train(index: np.ndarray, value: np.ndarray, starts: np.ndarray, label: np.ndarray, n_features: int, rank: int = 8, epochs: int = 12, batch: int = 128, rate: float = 0.1, penalty: float = 1e-4, seed: int = 5) -> FactorisationMachine:
    """AdaGrad on the logistic loss; row k has the features index[starts[k]:starts[k + 1]]."""
    random = np.random.default_rng(seed)
    share = min(max(label.mean(), 1e-6), 1 - 1e-6)
    bias, weight, factors = math.log(share / (1 - share)), np.zeros(n_features, np.float32), random.normal(0, 0.05, (n_features, rank)).astype(np.float32)
    seen, seen_factors, seen_bias = np.full(n_features, 1e-6, np.float32), np.full((n_features, rank), 1e-6, np.float32), 1e-6
    for _ in range(epochs):
        order = random.permutation(len(label))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            sizes = starts[rows + 1] - starts[rows]
            first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            take = np.repeat(starts[rows] - first, sizes) + np.arange(sizes.sum())
            i, x, row = index[take], value[take], np.repeat(np.arange(len(rows)), sizes)
            part = factors[i] * x[:, None]
            total = np.add.reduceat(part, first, axis=0)
            margin = bias + np.add.reduceat(weight[i] * x, first) + 0.5 * ((total**2).sum(axis=1) - np.add.reduceat((part**2).sum(axis=1), first))
            error = 1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30))) - label[rows]
            touched, where = np.unique(i, return_inverse=True)
            pull = error[row] * x
            g = np.bincount(where, pull, len(touched)) / len(rows) + penalty * weight[touched]
            each = pull[:, None] * (total[row] - part)
            gv = np.column_stack([np.bincount(where, each[:, f], len(touched)) for f in range(rank)]) / len(rows) + penalty * factors[touched]
            seen[touched] += g * g
            seen_factors[touched] += gv * gv
            seen_bias += error.mean() ** 2
            weight[touched] -= rate * g / np.sqrt(seen[touched])
            factors[touched] -= 0.5 * rate * gv / np.sqrt(seen_factors[touched])
            bias -= rate * error.mean() / math.sqrt(seen_bias)
    return FactorisationMachine(bias, weight, factors)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", bits: int = 16, sample: int = 16_000, **options) -> FactorisationMachine:
    """Train on the labelled documents outside the held-out fifth."""
    chosen = labelled_sample(docs.select("doc_id", "text", F.col("n_chars").cast("double").alias("n_chars")), labels, label, sample)
    n_features = (1 << bits) + len(STATISTICS) * (CLASSES + 1)

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [features(t, c, bits) for t, c in zip(batch["text"], batch["n_chars"], strict=True)]
            yield pd.DataFrame({"label": batch["_label"], "index": [m[0].astype(np.int32) for m in made], "value": [m[1].astype(np.float32) for m in made]})

    target, starts, index, value = lists_of(chosen.mapInPandas(listed, "label int, index array<int>, value array<float>"))  # at most ``sample`` rows
    if len(set(target)) < 2:
        share = (target.sum() + 1) / (len(target) + 2)
        return FactorisationMachine(math.log(share / (1 - share)), np.zeros(n_features), np.zeros((n_features, 1)))
    return train(index, value, starts, target, n_features, **options)


def quality(docs: DataFrame, labels: DataFrame, bits: int = 16, **options) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = fit(docs, labels, bits=bits, **options)

    def column(texts: pd.Series, sizes: pd.Series) -> pd.Series:
        return pd.Series([model.score(t, c, bits) for t, c in zip(texts, sizes, strict=True)], dtype=float)

    score = F.pandas_udf(column, "double")(F.col("text"), F.col("n_chars").cast("double"))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
