"""Toxicity: a linear classifier over character n-grams whose features are scaled by naive Bayes log-count ratios.

Lower-cased texts are read as code points; n-grams of ``orders`` characters are hashed to
``2**bits`` buckets. In the labelled sample, documents of either class are counted per bucket;
a bucket's feature is its presence times r = log of the ratio of its smoothed shares in both
classes. The ``most`` buckets whose shares differ by the most standard errors (and by ``evidence`` of them at
least) are used, and a logistic regression with a ridge penalty is fitted on their scaled features.

Fitting uses at most ``sample`` labelled documents (those with the smallest hash of doc_id), so
the driver holds bounded data whatever the size of the corpus: per-bucket counts come as one
aggregation, the documents' kept buckets as another. Scoring reads every whole text in
windows.

Cases: null and empty texts have no n-gram and get the score of the intercept; null labels are
not used; without both classes among the labels every score is the smoothed share of toxic
labels; repeated rows are scored alike; an empty table gives an empty result; columns other
than doc_id and text are ignored by ``score`` and kept by ``without_toxic``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinedeck.llm.common import settle, ship

ship(__name__)

#: Characters of a text that are hashed at a time.
WINDOW = 1 << 20
#: A score at or above this is toxic.
THRESHOLD = 0.5


def held_out(doc_id: Column) -> Column:
    """Whether the row's labels are kept from training."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def buckets(text: str | None, orders: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """Hashed n-grams of a text, one array per order and window."""
    whole = (text or "").lower()
    longest = max(orders)
    for at in range(0, len(whole), WINDOW):
        code = np.frombuffer(whole[at : at + WINDOW + longest - 1].encode("utf-32-le", "surrogatepass"), "<u4")
        rolled = code * np.uint32(0x9E3779B1)
        for order in range(1, longest + 1):
            if order > 1:
                if len(code) < order:
                    break
                rolled = rolled[:-1] * np.uint32(0x85EBCA6B) + code[order - 1 :]
            if order in orders:
                mixed = (rolled ^ (rolled >> np.uint32(15))) * np.uint32((0xC2B2AE35 + 2 * order) & 0xFFFFFFFF)
                yield mixed >> np.uint32(32 - bits)


@dataclass
class Model:
    """Weight of each bucket (zero: left out) and the intercept."""

    weight: np.ndarray
    intercept: float
    orders: tuple[int, ...]
    bits: int

    def score(self, text: str | None) -> float:
        found = []
        for index in buckets(text, self.orders, self.bits):
            found.append(np.unique(index[self.weight[index] != 0]))
        margin = self.intercept
        if found:
            margin += float(self.weight[np.unique(np.concatenate(found))].sum())
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, margin))))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """At most ``sample`` rows (text, label, and the rest of ``docs``) whose labels may be learnt; texts stay where they are read."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_label")).filter("_label is not null and _id is not null")
    known = known.filter(~held_out(F.col("_id"))).groupBy("_id").agg(F.max("_label").alias("_label"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    return settle(docs.join(F.broadcast(settle(chosen)), F.col("doc_id") == F.col("_id")).drop("_id"))


def lists_of(rows: DataFrame) -> tuple[np.ndarray, ...]:
    """A bounded table (label, list, ...) on the driver, flat: labels, where each row's entries start, and the entries of each list."""
    table = rows.toArrow().combine_chunks()
    lists = [table.column(k).combine_chunks() for k in range(1, table.num_columns)]
    sizes = np.asarray(lists[0].value_lengths().fill_null(0))
    return np.asarray(table.column(0), float), np.concatenate(([0], np.cumsum(sizes))), *(np.asarray(x.flatten()) for x in lists)


def ridge_logistic(starts: np.ndarray, columns: np.ndarray, scale: np.ndarray, label: np.ndarray, penalty: float, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated gradient steps scaled by each column's curvature.

    Row k has the columns ``columns[starts[k]:starts[k + 1]]`` with the value of their ``scale``; rows are
    taken in blocks, so that only the column numbers are held for all of them.
    """
    n, n_columns = len(label), len(scale)
    cuts = np.unique(np.concatenate((np.searchsorted(starts, np.arange(0, len(columns), 1 << 20)), [0, n])))
    cuts = cuts[cuts <= n]
    blocks = [(a, b, columns[starts[a] : starts[b]], np.repeat(np.arange(b - a, dtype=np.int32), np.diff(starts[a : b + 1]))) for a, b in zip(cuts, cuts[1:], strict=False)]
    share = min(max(label.mean(), 1e-6), 1 - 1e-6)
    weight, intercept = np.zeros(n_columns), math.log(share / (1 - share))
    size, per_row = np.abs(scale), []
    bound = np.zeros(n_columns)
    for a, b, column, row in blocks:
        per_row.append(np.bincount(row, size[column], b - a))
        bound += np.bincount(column, per_row[-1][row], n_columns)
    bound = 0.25 * bound * size + penalty  # a row-sum bound of the Hessian
    step, top = 1.0 / np.maximum(bound, 1e-9), 0.25 * (n + sum(float(x.sum()) for x in per_row))
    ahead, ahead0, t = weight.copy(), intercept, 1.0
    for _ in range(rounds):
        pull, pull0, scaled = np.zeros(n_columns), 0.0, ahead * scale
        for a, b, column, row in blocks:
            margin = np.bincount(row, scaled[column], b - a) + ahead0
            error = 1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30))) - label[a:b]
            pull += np.bincount(column, error[row], n_columns)
            pull0 += float(error.sum())
        new = ahead - step * (pull * scale + penalty * ahead)
        new0 = ahead0 - pull0 / top
        t_next = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, ahead0 = new + (t - 1) / t_next * (new - weight), new0 + (t - 1) / t_next * (new0 - intercept)
        weight, intercept, t = new, new0, t_next
    return weight, intercept


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", orders: tuple[int, ...] = (4, 5, 6), bits: int = 20, sample: int = 30_000, evidence: float = 4.0, most: int = 4096, penalty: float = 0.1) -> Model:
    """Train on the labelled documents outside the held-out fifth."""
    chosen = labelled_sample(docs.select("doc_id", "text"), labels, label, sample)
    size = 1 << bits

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros((2, size), np.int32)
        for batch in batches:
            for text, positive in zip(batch["text"], batch["_label"], strict=True):
                present = np.unique(np.concatenate([np.zeros(0, np.uint32), *buckets(text, orders, bits)]))
                held[int(positive), present.astype(np.int64)] += 1
        some = np.flatnonzero(held.any(axis=0))
        yield pd.DataFrame({"bucket": some, "no": held[0, some].astype(np.int64), "yes": held[1, some].astype(np.int64)})

    n_yes, n = chosen.agg(F.coalesce(F.sum("_label"), F.lit(0)), F.count(F.lit(1))).first()
    n_no = n - n_yes
    if not n_yes or not n_no:
        share = (n_yes + 1) / (n + 2)
        return Model(np.zeros(size), math.log(share / (1 - share)), orders, bits)
    counts = chosen.select("text", "_label").mapInPandas(count, "bucket long, no long, yes long").groupBy("bucket").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes"))
    p, q = (F.col("yes") + 1) / (n_yes + 2), (F.col("no") + 1) / (n_no + 2)
    ratio = F.ln(p / q)
    error = F.sqrt(1 / (F.col("yes") + 1) - 1 / F.lit(float(n_yes + 2)) + 1 / (F.col("no") + 1) - 1 / F.lit(float(n_no + 2)))
    strength = F.abs(ratio) / error
    kept = counts.select("bucket", ratio.alias("r"), strength.alias("s")).filter(F.col("s") > evidence).orderBy(F.desc("s"), "bucket").limit(most).toPandas()
    column = np.full(size, -1, np.int16)
    column[kept["bucket"].to_numpy(np.int64)] = np.arange(len(kept))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for text in batch["text"]:
                parts = [column[index] for index in buckets(text, orders, bits)]
                present = np.unique(np.concatenate([np.zeros(0, np.int16), *parts]))
                found.append(present[present >= 0])
            yield pd.DataFrame({"label": batch["_label"], "found": found})

    target, starts, columns = lists_of(chosen.select("text", "_label").mapInPandas(features, "label int, found array<short>"))  # at most ``sample`` rows
    weight, intercept = ridge_logistic(starts, columns, kept["r"].to_numpy(float), target, penalty)
    full = np.zeros(size)
    full[kept["bucket"].to_numpy(np.int64)] = weight * kept["r"].to_numpy(float)
    return Model(full, intercept, orders, bits)


def score(model: Model, text: Column) -> Column:
    """Probability of the label, for whole texts."""

    def column(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype=float)

    return F.pandas_udf(column, "double")(text)


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = fit(docs, labels, **options)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, whatever their columns are called."""
    model = fit(docs, labels, **options)
    rows = docs.select(F.struct(*docs.columns).alias("row"), score(model, F.col("text")).alias("score"))
    return rows.filter(F.col("score") < THRESHOLD).select("row.*")
