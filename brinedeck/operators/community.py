"""Community tables: transforms, dissimilarity and fit of environment variables."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brinedeck.fixed_values import NOT_LOOKED_FOR
from brinedeck.functions.missing import ratio
from brinedeck.operators.shuffle import ranked_in_buckets
from brinedeck.operators.taxa import drop_zero_taxa


def community(long: DataFrame, *, taxon: str, value: str, where: Column) -> DataFrame:
    """Records of the chosen samples, without taxa that have no count there."""
    return drop_zero_taxa(long.filter(where), taxon, value)


def sqrt_transform(long: DataFrame, value: str) -> DataFrame:
    return long.withColumn(value, F.sqrt(value))


def cell_totals(long: DataFrame, key: str, taxon: str, value: str) -> DataFrame:
    """Total per sample and taxon; "not looked for" and missing records are left out."""
    seen = long.filter(F.col(value).isNotNull() & (F.col(value) != NOT_LOOKED_FOR))
    return seen.groupBy(key, taxon).agg(F.sum(value).alias(value))


def wisconsin(long: DataFrame, *, key: str, taxon: str, value: str) -> DataFrame:
    """Square root, then share of the taxon's maximum, then share of the sample's total.

    Records are reduced to one per sample and taxon first.  The taxon maxima
    form a short table, and a sample then has at most one row per taxon.
    """
    cells = cell_totals(long, key, taxon, value).withColumn(value, F.sqrt(value))
    tops = cells.groupBy(taxon).agg(F.max(value).alias("_top"))
    shares = cells.join(tops, taxon).withColumn(value, ratio(F.col(value), F.col("_top"))).drop("_top")
    totals = shares.groupBy(key).agg(F.sum(value).alias("_total"))
    return shares.join(totals, key).select(key, taxon, ratio(F.col(value), F.col("_total")).alias(value))


def bray_curtis(long: DataFrame, *, key: str, taxon: str, value: str, tile: int = 512) -> DataFrame:
    """Dissimilarity of every two samples (``a`` < ``b``), NULL where both are empty.

    The answer is a matrix, so the work is cut into square tiles of samples:
    each sample's taxa go to the tiles of its row and column, and a task fills
    one tile from two blocks of about ``tile`` samples.  No pair is ever formed
    through a shared taxon, so a taxon found everywhere costs no more than a
    rare one.  A sample without any usable record is in its pairs as an empty one.
    """
    every = long.select(key).dropna().distinct().select(key, F.lit(None).cast("string").alias(taxon), F.lit(None).cast("double").alias(value))
    cells = cell_totals(long, key, taxon, value).select(key, F.col(taxon).cast("string").alias(taxon), F.col(value).cast("double").alias(value)).unionByName(every)
    blocks = cells.agg(F.greatest(F.ceil(F.count_distinct(key) / tile), F.lit(1)).alias("n")).scalar()
    block = F.pmod(F.xxhash64(F.col(key)), blocks).cast("int")
    placed = cells.select(F.col(key).alias("k"), F.col(taxon).cast("string").alias("t"), F.col(value).cast("double").alias("v"), block.alias("blk"))
    tiles = placed.withColumn("_o", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int")))).select(
        "k", "t", "v", "blk", F.least("blk", "_o").alias("ti"), F.greatest("blk", "_o").alias("tj")
    )
    key_type = cells.schema[key].dataType
    schema = T.StructType([
        T.StructField("a", key_type), T.StructField("b", key_type), T.StructField("dissimilarity", T.DoubleType()),
    ])
    return tiles.groupBy("ti", "tj").applyInPandas(_tile_dissimilarity, schema)


def _tile_dissimilarity(pdf: pd.DataFrame) -> pd.DataFrame:
    ti, tj = pdf["ti"].iloc[0], pdf["tj"].iloc[0]
    taxa = pd.Index(pdf["t"].dropna().unique())
    sides = []
    for blk in (ti, tj):
        side = pdf[pdf["blk"] == blk]
        keys = np.sort(side["k"].unique())
        dense = np.zeros((len(keys), len(taxa)))
        real = side[side["t"].notna()]
        dense[np.searchsorted(keys, real["k"].to_numpy()), taxa.get_indexer(real["t"])] = real["v"].to_numpy()
        sides.append((keys, dense))
    (ka, va), (kb, vb) = sides
    out = []
    for k, row in zip(ka, va):
        low = np.minimum(row, vb).sum(axis=1)
        both = row.sum() + vb.sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            d = np.where(both > 0, 1.0 - 2.0 * low / both, np.nan)
        keep = kb > k if ti == tj else np.ones(len(kb), dtype=bool)
        other = kb[keep]
        out.append(pd.DataFrame({
            "a": np.where(other < k, other, k), "b": np.where(other < k, k, other), "dissimilarity": d[keep],
        }))
    result = pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "dissimilarity": []})
    result["dissimilarity"] = result["dissimilarity"].astype(object).where(result["dissimilarity"].notna(), None)
    return result


def env_fit(scores: DataFrame, *, axes: tuple[str, str], variables: Sequence[str]) -> DataFrame:
    """Fit of each numeric variable on two ordination axes: R2 and direction.

    Only rows complete in the axes and all variables count.  One aggregation
    gives every sum the closed-form regression needs.
    """
    rows = scores.dropna(subset=[*axes, *variables])
    return _fit_rows(rows.agg(*_moments(axes, variables)), variables, [])


def _moments(axes: tuple[str, str], variables: Sequence[str]) -> list[Column]:
    u, v = axes
    cols = [F.var_pop(u).alias("_uu"), F.var_pop(v).alias("_vv"), F.covar_pop(u, v).alias("_uv")]
    for z in variables:
        cols += [F.covar_pop(u, z).alias(f"_u_{z}"), F.covar_pop(v, z).alias(f"_v_{z}"), F.var_pop(z).alias(f"_z_{z}")]
    return cols


def _fit_rows(moments: DataFrame, variables: Sequence[str], by: Sequence[str]) -> DataFrame:
    per_variable = F.array(*[
        F.struct(F.lit(z).alias("variable"), F.col(f"_u_{z}").alias("cu"), F.col(f"_v_{z}").alias("cv"), F.col(f"_z_{z}").alias("zz"))
        for z in variables
    ])
    long = moments.select(*by, "_uu", "_vv", "_uv", F.inline(per_variable))
    det = F.col("_uu") * F.col("_vv") - F.col("_uv") * F.col("_uv")
    b1 = ratio(F.col("cu") * F.col("_vv") - F.col("cv") * F.col("_uv"), det)
    b2 = ratio(F.col("cv") * F.col("_uu") - F.col("cu") * F.col("_uv"), det)
    solved = long.withColumns({"_b1": b1, "_b2": b2})
    length = F.sqrt(F.col("_b1") * F.col("_b1") + F.col("_b2") * F.col("_b2"))
    return solved.select(
        *by, "variable",
        ratio(F.col("_b1") * F.col("cu") + F.col("_b2") * F.col("cv"), F.col("zz")).alias("r2"),
        ratio(F.col("_b1"), length).alias("axis1"), ratio(F.col("_b2"), length).alias("axis2"),
    )


def factor_fit(scores: DataFrame, *, axes: tuple[str, str], factor: str) -> DataFrame:
    """Centroid of every level on two axes and the factor's R2 (between over total sum of squares)."""
    u, v = axes
    levels = scores.dropna(subset=[u, v, factor]).groupBy(factor).agg(
        F.count(F.lit(1)).alias("n"), F.avg(u).alias("axis1"), F.avg(v).alias("axis2"),
        (F.var_pop(u) + F.var_pop(v)).alias("_within"),
    )
    total_n = F.sum("n")
    mean = lambda c: F.sum(F.col("n") * F.col(c)) / total_n
    between = mean("_sq") - mean("axis1") * mean("axis1") - mean("axis2") * mean("axis2")
    r2 = levels.withColumn("_sq", F.col("axis1") * F.col("axis1") + F.col("axis2") * F.col("axis2")).agg(
        ratio(between, between + mean("_within")).alias("r2")
    )
    return levels.drop("_within").withColumn("r2", r2.scalar())


#: Parameters of the rounds that mix a rank and a permutation's number: a prime below 2**31 and multipliers under it.
MIX_PRIME = 2_147_483_647
MIX_RANK, MIX_DRAW, MIX_ROUND = 1_103_515_245, 69_069, 1_664_525
ROUNDS = 6
#: Tasks among which the permutations of few rows are divided.
DRAWS_APART = 32
#: Ranks of a block; a task holds two blocks, the rows that keep their place and those that are sent.
BLOCK = 1 << 20


def rank_square(n: int) -> tuple[int, int, int]:
    """Sides a and b of a rectangle that holds n ranks with the fewest places left over, and how many are left."""
    low, high = max(1, -(-math.isqrt(n) // 2)), max(1, 2 * math.isqrt(n))
    a = min(range(low, high + 1), key=lambda k: (-n % k, k))
    b = max(1, -(-n // a))
    return a, b, a * b - n


def _sent(rank: np.ndarray, draw: int, n: int) -> np.ndarray:
    """Where permutation ``draw`` sends ranks from 0: a bijection on 0..n-1 for every draw.

    Ranks are places in a rectangle; each round moves the row by a hash of the column, then the
    column by a hash of the row, which can be undone, so every round is a bijection on the rectangle.
    A rank sent to a place that is left over goes on from there until it is sent to one of the n.
    """
    a, b, _ = rank_square(n)

    def shifts(size: int, turn: int, side: int) -> np.ndarray:
        y = (np.arange(size, dtype=np.int64) * MIX_RANK + draw * MIX_DRAW + turn * MIX_ROUND) % MIX_PRIME
        return (y * y) % MIX_PRIME % side

    by_column = [shifts(b, 2 * turn, a) for turn in range(ROUNDS)]
    by_row = [shifts(a, 2 * turn + 1, b) for turn in range(ROUNDS)]

    def moved(place: np.ndarray) -> np.ndarray:
        row, col = np.divmod(place, b)
        for columns, rows in zip(by_column, by_row):
            row += columns[col]
            row -= a * (row >= a)
            col += rows[row]
            col -= b * (col >= b)
        return row * b + col

    out = moved(rank.astype(np.int64))
    while len(over := np.flatnonzero(out >= n)):
        out[over] = moved(out[over])
    return out


def permuted_rank(df: DataFrame, n: int, rank: str = "rank", draw: str = "k", out: str = "slot") -> DataFrame:
    """Add ``out``: where permutation ``draw`` sends ``rank`` (both from 0), as ``_sent`` has it."""

    @F.pandas_udf("long")
    def sent(ranks: pd.Series, draws: pd.Series) -> pd.Series:
        slots, places, numbers = np.empty(len(ranks), dtype=np.int64), ranks.to_numpy(), draws.to_numpy()
        for k in np.unique(numbers):
            slots[numbers == k] = _sent(places[numbers == k], int(k), n)
        return pd.Series(slots)

    return df.withColumn(out, sent(F.col(rank).cast("long"), F.col(draw).cast("long"))).withColumn(draw, F.col(draw).cast("long"))


def _ranked(rows: DataFrame, key: str) -> DataFrame:
    """Rank from 0 in the order of a hash of the key, found in 256 buckets."""
    hashed = rows.withColumn("_h", F.md5(F.col(key).cast("string")))
    ranked = ranked_in_buckets(hashed.withColumn("_b", F.substring("_h", 1, 2)), [], "_b", ["_h", key])
    return ranked.withColumn("rank", F.col("rank") - 1).drop("_h", "_b")


def _permuted(
    rows: DataFrame, n: int, key: str, permutations: int, sums: Callable[[pa.Table, Iterator[tuple[int, np.ndarray, np.ndarray]]], pa.Table], schema: str, block: int,
) -> DataFrame:
    """What ``sums`` makes of the rows of a tile and, for each k, of the rows that keep their place and those sent there.

    Ranks are cut into blocks, and a tile is a block that keeps its places, a block that is sent and
    a hand of the permutations. The permutations are made in the tile and added up there, so rows are
    sent once a tile, not once a permutation, and results are sums by k. With more than one block a
    permutation is made anew for each block that is sent: the work of sites beyond ``block`` grows
    with their square, and memory does not grow.
    """
    blocks = max(1, -(-n // block))
    hands = max(1, min(permutations, -(-DRAWS_APART // blocks**2)))
    ranked = _ranked(rows, key)
    own, other = F.floor(F.col("rank") / block).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    tiles = ranked.withColumn("_i", own).withColumn("_j", other)
    if blocks > 1:
        tiles = tiles.unionByName(ranked.withColumn("_j", own).withColumn("_i", other).filter("_i <> _j"))
    dealt = tiles.withColumn("_hand", F.explode(F.sequence(F.lit(1), F.lit(hands)))).repartition(blocks * blocks * hands, "_i", "_j", "_hand")

    def tile(table: pa.Table) -> pa.Table:
        i, j, hand = (table[c][0].as_py() for c in ("_i", "_j", "_hand"))
        rank = table["rank"].to_numpy()
        fixed, moved = np.flatnonzero(rank // block == i), np.flatnonzero(rank // block == j)
        row_of = np.empty(len(moved), dtype=np.int64)
        row_of[rank[moved] - j * block] = moved

        def draws() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            for k in range(hand, permutations + 1, hands):
                slot = _sent(rank[fixed], k, n)
                here = np.flatnonzero(slot // block == j)
                yield k, fixed[here], row_of[slot[here] - j * block]

        return sums(table, draws())

    return dealt.groupBy("_i", "_j", "_hand").applyInArrow(tile, schema)


def env_fit_test(
    scores: DataFrame, *, key: str, axes: tuple[str, str], variables: Sequence[str], permutations: int = 1000, block: int = BLOCK,
) -> DataFrame:
    """R2 of each variable with its permutation p-value, (1 + hits) / (permutations + 1).

    Sites are ranked once.  Permutation k is a keyed bijection on ranks, so no permutation is
    sorted or hashed into order.  Only the products of axes and variables change with it: they are
    summed about the means, and the other moments are those observed.
    """
    u, v = axes
    variables = list(variables)
    rows = scores.select(key, *axes, *variables).dropna()
    means = rows.agg(F.count(F.lit(1)), *[F.avg(c) for c in (*axes, *variables)]).first()
    centred = rows.select(key, *[(F.col(c) - F.lit(m).cast("double")).alias(c) for c, m in zip((*axes, *variables), means[1:])])
    products = [(f"_{side}_{z}", axis, z) for z in variables for side, axis in (("u", u), ("v", v))]

    def sums(table: pa.Table, draws: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> pa.Table:
        value = {c: table[c].to_numpy() for c in (*axes, *variables)}
        found: dict[str, list] = {"k": [], **{name: [] for name, _, _ in products}}
        for k, kept, sent in draws:
            at, of = {c: value[c][kept] for c in axes}, {z: value[z][sent] for z in variables}
            found["k"].append(k)
            for name, axis, z in products:
                found[name].append(float(at[axis] @ of[z]))
        return pa.table({c: pa.array(x, pa.int64() if c == "k" else pa.float64()) for c, x in found.items()})

    schema = ", ".join(["k long", *[f"`{name}` double" for name, _, _ in products]])
    parts = _permuted(centred, means[0], key, permutations, sums, schema, block)
    moments = rows.agg(*_moments(axes, variables))
    still = moments.select("_uu", "_vv", "_uv", *[f"_z_{z}" for z in variables])
    moved = parts.groupBy("k").agg(*[(F.sum(name) / means[0]).alias(name) for name, _, _ in products]) if means[0] else parts
    permuted = _fit_rows(moved.crossJoin(F.broadcast(still)), variables, ["k"])
    observed = _fit_rows(moments, variables, [])
    one_row_per_variable = F.broadcast(observed.select("variable", F.col("r2").alias("_r2")))
    hits = permuted.join(one_row_per_variable, "variable").groupBy("variable").agg(
        F.count_if(F.col("r2") >= F.col("_r2") - 1e-12).alias("hits")
    )
    return observed.join(F.broadcast(hits), "variable").withColumn(
        "p_value", (F.col("hits") + 1) / F.lit(float(permutations + 1))
    )


def factor_fit_test(
    scores: DataFrame, *, key: str, axes: tuple[str, str], factor: str, permutations: int = 1000, block: int = BLOCK,
) -> DataFrame:
    """R2 of a factor with its permutation p-value: levels are dealt anew to the sites, which keep their places."""
    u, v = axes
    rows = scores.select(key, u, v, factor).dropna()
    n = rows.count()

    def levels(of: DataFrame, by: Sequence[str], count: Column, su: Column, sv: Column) -> DataFrame:
        return of.groupBy(*by, factor).agg(count.alias("n"), su.alias("_su"), sv.alias("_sv"))

    def inner(of: DataFrame, by: Sequence[str]) -> DataFrame:
        return of.groupBy(*by).agg(F.sum((F.col("_su") * F.col("_su") + F.col("_sv") * F.col("_sv")) / F.col("n")).alias("_inner"))

    def sums(table: pa.Table, draws: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> pa.Table:
        coded = table[factor].combine_chunks().dictionary_encode()
        level, x, y = coded.indices.to_numpy(), table[u].to_numpy(), table[v].to_numpy()
        found = []
        for k, kept, sent in draws:
            dealt = level[sent]
            counts, su, sv = (np.bincount(dealt, weights=w, minlength=len(coded.dictionary)) for w in (None, x[kept], y[kept]))
            some = np.flatnonzero(counts)
            found.append(pa.table({
                "k": np.full(len(some), k, dtype=np.int64), factor: coded.dictionary.take(pa.array(some)), "n": counts[some].astype(np.int64), "_su": su[some].astype(float), "_sv": sv[some].astype(float),
            }))
        return pa.concat_tables(found)

    level_type = rows.schema[factor].dataType.simpleString()
    cast = rows.select(key, F.col(u).cast("double").alias(u), F.col(v).cast("double").alias(v), factor)
    parts = _permuted(cast, n, key, permutations, sums, f"k long, `{factor}` {level_type}, n long, _su double, _sv double", block)
    square = F.col(u) * F.col(u) + F.col(v) * F.col(v)
    whole = rows.agg(F.sum(u).alias("_u"), F.sum(v).alias("_v"), F.sum(square).alias("_ss"), F.count(F.lit(1)).alias("_n")).select(
        "_ss", ((F.col("_u") * F.col("_u") + F.col("_v") * F.col("_v")) / F.col("_n")).alias("_centre"),
    )
    r2 = ratio(F.col("_inner") - F.col("_centre"), F.col("_ss") - F.col("_centre")).alias("r2")
    seen = inner(levels(rows, [], F.count(F.lit(1)), F.sum(u), F.sum(v)), [])
    observed = seen.crossJoin(F.broadcast(whole)).select(r2)
    drawn = inner(levels(parts, ["k"], F.sum("n"), F.sum("_su"), F.sum("_sv")), ["k"])
    permuted = drawn.crossJoin(F.broadcast(whole)).select("k", r2)
    hits = permuted.withColumn("_r2", observed.scalar()).agg(F.count_if(F.col("r2") >= F.col("_r2") - 1e-12).alias("hits"))
    return observed.withColumn("hits", hits.scalar()).select("r2", "hits", ((F.col("hits") + 1) / F.lit(float(permutations + 1))).alias("p_value"))
