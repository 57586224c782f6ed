"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the total by its weight; no source may be repeated more than
``epochs`` times. Sources above that are clamped, their excess is shared among the others by
weight, and again, until no source is above. A source's target is then met by whole
repetitions of all its documents and a seeded sample for the rest: its documents stand in
the order of a hash of (seed, doc_id); the first of them, as many as fit in the rest of the target,
are taken once more, and then the one document whose size comes nearest to what is still missing.

Sources are ranked, clamped and summed as tables, and documents are put in order by range
over (source, hash), so that a source with most of all rows is spread over many tasks.

Cases: a null source is a source of its own, after all others; null and wordless texts have size
0 and are taken with their neighbours at no cost; repeated rows count as often as they occur;
ties in the hash go by doc_id, so that equal rows are interchangeable; a source without any word has target 0; an empty
table gives an empty result; the columns of ``docs`` that are not named are kept by
``repeated`` and ignored by ``mix``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinedeck.llm.common import in_order, running_total, settle, words

SEED = 17


def source_targets(sizes: DataFrame, weights: Sequence[float], epochs: float, share: float = 1.0) -> DataFrame:
    """Table (source, source_size, target) for a table (source, source_size); weights repeat over sources by code point.

    Each round of clamping is one aggregation over the sources still open, and fixes at least
    one source, so it ends.
    """
    ranked = in_order(sizes.select("source", "source_size"), [F.asc_nulls_last("source")])
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("_row", F.lit(len(weights))).cast("int"))
    table = settle(ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * F.lit(float(epochs))).alias("cap")))
    total = (table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] or 0) * share
    level = 0.0  # tokens for a weight of one; a source is clamped when its cap is under its share
    while True:
        clamped = F.col("cap") <= F.lit(level) * F.col("weight")
        fixed, open_weight = table.agg(
            F.coalesce(F.sum(F.when(clamped, F.col("cap"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~clamped, F.col("weight"))), F.lit(0.0))
        ).first()
        if not open_weight:
            break
        rise = (total - fixed) / open_weight
        if rise <= level:
            break
        level = rise
    return table.select("source", "source_size", F.least("cap", F.lit(level) * F.col("weight")).alias("target"))


def _sized(docs: DataFrame, seed: int, *extra: Column) -> DataFrame:
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), F.size(words(F.col("text"))).cast("long").alias("size"), order.alias("_order"), *extra)


def copies(sized: DataFrame, weights: Sequence[float], epochs: float) -> DataFrame:
    """``sized`` (source, size, _order, ...) with source_size, target and ``copies``, the times a document is taken."""
    placed = settle(running_total(in_order(sized, [F.asc_nulls_last("source"), "_order", "doc_id"]), "size"))
    sums = settle(placed.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("_before").alias("_first")))
    targets = source_targets(sums, weights, epochs).select(F.col("source").alias("_source"), "target")
    known = sums.join(targets, F.col("source").eqNullSafe(F.col("_source"))).select("_source", "source_size", "target", "_first")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.least(F.floor(ratio + F.lit(1e-9)), F.floor(F.lit(epochs))).cast("long")
    rest = F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size"))
    known = settle(known.withColumn("whole", whole).withColumn("rest", rest))
    joined = placed.join(known, F.col("source").eqNullSafe(F.col("_source")))
    end = F.col("_before") - F.col("_first") + F.col("size")
    joined = joined.withColumn("_inside", end <= F.col("rest")).withColumn("_end", end)
    gaps = joined.groupBy("_source").agg(F.first("rest").alias("rest"), F.coalesce(F.max(F.when(F.col("_inside"), F.col("_end"))), F.lit(0)).alias("_reached"))
    gaps = gaps.select(F.col("_source").alias("_gap_source"), (F.col("rest") - F.col("_reached")).alias("_gap"))
    outside = joined.filter(~F.col("_inside")).join(gaps, F.col("_source").eqNullSafe(F.col("_gap_source")))
    miss = F.abs(F.col("size") - F.col("_gap"))
    last = outside.filter(miss < F.col("_gap")).groupBy("_source").agg(F.min_by("_row", F.struct(miss, "_order", "_row")).alias("_last"))
    marked = joined.join(last.withColumnRenamed("_source", "_last_source"), F.col("_source").eqNullSafe(F.col("_last_source")), "left")
    once_more = (F.col("_inside") | F.coalesce(F.col("_row") == F.col("_last"), F.lit(False))).cast("long")
    return marked.withColumn("copies", F.least(F.col("whole") + once_more, F.floor(F.lit(epochs)).cast("long")))


def mix(docs: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), epochs: float = 3.0, seed: int = SEED) -> DataFrame:
    """By document: doc_id, size, source_size, target (of its source), taken (words that the mix takes, repeats counted)."""
    taken = copies(_sized(docs, seed), weights, epochs)
    return taken.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def repeated(docs: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), epochs: float = 3.0, seed: int = SEED) -> DataFrame:
    """``docs`` as the mix takes them: a document's row occurs as often as it is taken.

    Only ids and sizes are put in order; texts meet their number of copies by doc_id. Of
    repeated rows of one doc_id every row gets the rounded-up or -down mean of their copies.
    """
    counted = copies(_sized(docs, seed), weights, epochs).groupBy("doc_id").agg(F.sum("copies").alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    counted = counted.select(F.col("doc_id").alias("_id"), F.greatest(F.col("_sum") > 0, F.lit(False)).cast("int").alias("_some"), F.round(F.col("_sum") / F.col("_rows")).cast("int").alias("_mean"))
    often = counted.filter("_some = 1").select("_id", F.greatest("_mean", "_some").alias("_copies"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("of"))  # no clash with the documents' own columns
    met = rows.join(often, F.col("of").eqNullSafe(F.col("_id")))
    return met.select("row", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("copy")).select("row.*")
