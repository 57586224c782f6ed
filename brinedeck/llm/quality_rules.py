"""Quality rules with risk-controlled thresholds.

Each rule rejects documents on one side of a cutoff of one statistic. For every stratum (language)
and rule, labelled documents are counted by value; a cutoff is certified if the exact
binomial upper bound on its rate of rejected good documents (quality 1) stays below the rule's
share of ``risk``. Rejected sets are nested, so within one rule only the bound itself needs
confidence; over all strata and rules the error ``delta`` is divided (Bonferroni). The rules
of a stratum share ``risk`` evenly, so that together they falsely reject at most that share
of its good documents, with probability 1 - delta over all strata. Of the certified cutoffs
the one is used that parts bad from good best; a rule that parts nothing, or has too few
labels to be certified, rejects nothing.

Everything is built-in expressions, joins and aggregations. Labelled rows become counts by
(stratum, rule, value class) before anything is put in order, so no task holds a stratum.

Cases: null and empty texts have no words and fail the base rule; a null language is a stratum
of its own; repeated rows are judged alike (and count as often as they are labelled); null labels are not
used; without labels only the base rule rejects; windows are compared by a 64-bit hash of
their words; columns that are not named are ignored by ``judge`` and kept by ``accepted``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brinedeck.llm.common import bind, settle, words

#: Classes of a statistic's value are this many to a factor of e.
CLASSES = 40
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks"]


def _repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that occur at least twice; w is an array."""

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            twin = F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]))
            return F.sort_array(F.transform(twin, lambda x: x["i"]))

        def total(p: Column) -> Column:
            steps = F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
            return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

        return bind(bind(placed, positions), total)

    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    some = bind(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    return F.when(F.size(w) < 3, F.lit(0)).otherwise(some)


def statistics(text: Column) -> Column:
    """Struct of ``STATISTICS`` (long) of a whole text."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    by_line = bind(lines, lambda x: F.struct((F.size(x) - F.size(F.array_distinct(x))).alias("dup"), F.size(x).alias("all")))
    by_word = bind(words(text), lambda w: F.struct(F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("chars"), _repeat_words(w).alias("repeat")))
    values = {
        "n_words": by_word["n"], "word_chars": by_word["chars"], "n_symbols": F.regexp_count(whole, F.lit("[#*$%&|<>]")), "n_dup_lines": by_line["dup"],
        "n_repeat_words": by_word["repeat"], "n_lines": by_line["all"], "n_upper": F.regexp_count(whole, F.lit("[A-Z]")), "n_marks": F.regexp_count(whole, F.lit("[!?]")),
    }
    return F.struct(*[values[k].cast("long").alias(k) for k in STATISTICS])


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def rules() -> dict[str, Column]:
    """By rule: the statistic that rejects when it is high."""
    c = F.col
    return {
        "long_words": _ratio(c("word_chars"), c("n_words")), "short_words": _ratio(c("n_words"), c("word_chars")), "symbols": _ratio(c("n_symbols"), c("n_words")),
        "repeated_lines": _ratio(c("n_dup_lines"), c("n_lines")), "repeated_words": _ratio(c("n_repeat_words"), c("n_words")),
        "capitals": _ratio(c("n_upper"), c("word_chars")), "marks": _ratio(c("n_marks"), c("n_words")),
    }


def _classes() -> Column:
    """Array of all rules' value classes."""
    return F.array(*[F.floor(F.ln(v + 0.001) * CLASSES).cast("int") for v in rules().values()])


def _ln_factorial(n: Column) -> Column:
    x = n.cast("double")
    series = x * F.ln(x) - x + F.ln(x * (2 * math.pi)) / 2 + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    return F.when(n <= 15, F.ln(F.factorial(F.least(n, F.lit(15)).cast("int")).cast("double"))).otherwise(series)


def allowed_errors(n: Column, rate: float, delta: Column) -> Column:
    """The most errors among n at which the exact binomial upper bound (confidence 1 - delta) is at most ``rate``; -1 if none.

    That bound is under the rate just if P(X <= k) <= delta for X of n draws at this rate. Terms
    over 40 deviations below the mean are under 1e-300 and left out.
    """
    mean = n * F.lit(rate)
    first = F.greatest(F.lit(0), F.floor(mean - 40 * F.sqrt(mean) - 40)).cast("long")

    def add(state: Column, j: Column) -> Column:
        term = F.exp(_ln_factorial(n) - _ln_factorial(j) - _ln_factorial(n - j) + j * F.lit(math.log(rate)) + (n - j) * F.lit(math.log1p(-rate)))
        total = state["p"] + F.when(j <= n, term).otherwise(F.lit(0.0))
        return F.struct(total.alias("p"), F.when(total <= delta, j).otherwise(state["k"]).alias("k"))

    start = F.struct(F.lit(0.0).alias("p"), F.lit(-1).cast("long").alias("k"))
    return F.aggregate(F.sequence(first, F.ceil(mean).cast("long")), start, add, lambda s: F.least(s["k"], n))


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float = 0.03, delta: float = 0.1) -> DataFrame:
    """One row per stratum: (stratum, cut), an array with each rule's lowest rejected value class (null: the rule is off).

    ``measured`` has doc_id, stratum, the statistics and base_failed; documents that fail the base rule take no part.
    """
    names = list(rules())
    known = labels.select(F.col("doc_id").alias("_labelled"), F.col("quality").alias("_quality")).filter("_quality is not null")
    met = measured.filter(~F.col("base_failed")).withColumn("class", _classes()).select("doc_id", "stratum", "class")
    met = met.join(known, F.col("doc_id") == F.col("_labelled"))
    good = (F.col("_quality") == 1).cast("long")
    counts = (
        met.select("stratum", good.alias("good"), F.posexplode("class").alias("rule", "class"))
        .groupBy("stratum", "rule", "class").agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"))
    )
    counts = settle(counts)
    strata = counts.filter("rule = 0").groupBy("stratum").agg(F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"))
    every = strata.agg(F.count(F.lit(1)).alias("n_strata"))
    error = F.lit(delta) / (F.col("n_strata") * len(names))
    limits = strata.join(F.broadcast(every)).select("stratum", "n_good", "n_bad", allowed_errors(F.col("n_good"), risk / len(names), error).alias("allowed"))
    above = Window.partitionBy("stratum", "rule").orderBy(F.desc("class"))  # at most a few thousand classes
    tails = counts.select("stratum", "rule", "class", F.sum("good").over(above).alias("good"), F.sum("bad").over(above).alias("bad"))
    parts = F.try_divide(F.col("bad").cast("double"), F.col("n_bad")) - F.try_divide(F.col("good").cast("double"), F.col("n_good"))
    fit = tails.join(limits, "stratum").filter("good <= allowed").withColumn("parts", parts).filter("parts > 0.001")
    best = fit.groupBy("stratum", "rule").agg(F.max_by("class", F.struct("parts", "class")).alias("cut"))
    return best.groupBy("stratum").agg(F.array(*[F.max(F.when(F.col("rule") == k, F.col("cut"))) for k in range(len(names))]).alias("cut"))


def measure(docs: DataFrame, *kept: str) -> DataFrame:
    """Statistics, base rule and stratum of each document; ``kept`` columns stay."""
    stats = docs.select(*kept, F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("stratum"), statistics(F.col("text")).alias("_s"))
    return stats.select(*kept, "stratum", "_s.*").withColumn("base_failed", base_failed())


def judge(measured: DataFrame, cut: DataFrame) -> DataFrame:
    """``measured`` with ``kept``: neither the base rule nor any certified rule rejects."""
    joined = measured.join(cut.withColumnRenamed("stratum", "_stratum"), F.col("stratum") == F.col("_stratum"), "left")
    hits = F.exists(F.zip_with(_classes(), F.col("cut"), lambda value, limit: F.coalesce(value >= limit, F.lit(False))), lambda x: x)
    rejected = F.col("base_failed") | F.coalesce(F.when(F.col("cut").isNotNull(), hits), F.lit(False))
    return joined.withColumn("kept", ~rejected).drop("_stratum", "cut")


def quality_rules(docs: DataFrame, labels: DataFrame, risk: float = 0.03, delta: float = 0.1) -> DataFrame:
    """Statistics and verdict of each document."""
    measured = settle(measure(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id"))
    return judge(measured, settle(cutoffs(measured, labels, risk, delta)))


def accepted(docs: DataFrame, labels: DataFrame, risk: float = 0.03, delta: float = 0.1) -> DataFrame:
    """The rows of ``docs`` that the rules keep. Statistics are worked out again rather than joined, so texts don't move."""
    measured = settle(measure(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id"))
    cut = settle(cutoffs(measured, labels, risk, delta))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "lang", "text")
    return judge(measure(rows, "_row"), cut).filter("kept").select("_row.*")
