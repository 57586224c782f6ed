"""Fitted surfaces of scattered values: multilevel B-spline approximation.

A level is a lattice of control nodes over the range of the points, ``cells`` cells wide and high at
first and twice as many at every further level. A point spreads to the 16 nodes around
its cell; a node takes the weighted mean of what reaches it. The next level fits what is left,
and the surface is the sum of all levels.

Everything is aggregation and equi-joins. A level reads the points once: they meet the
surface so far by their group (one row per point), and the 16 weighted sums of a cell are added up
before anything is sent. The surface so far is always one lattice, since a coarse level
is refined to the next one's nodes by the midpoint rule of cubic B-splines, so the work per level
does not grow with the levels before. Lattices are bounded by the arguments, not by the points: a group's is one
row with the values of all its nodes, and what is done with nodes stays in the partition of the group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinedeck.session import settled

#: Weights with which a node enters the nodes of the next finer lattice, from two before its own place on.
REFINE = (1 / 8, 4 / 8, 6 / 8, 4 / 8, 1 / 8)


def basis(t: Column) -> list[Column]:
    """The four cubic B-spline weights of a place ``t`` (0 to 1) in its cell."""
    return [
        (1 - t) * (1 - t) * (1 - t) / 6,
        (3 * t * t * t - 6 * t * t + 4) / 6,
        (-3 * t * t * t + 3 * t * t + 3 * t + 1) / 6,
        t * t * t / 6,
    ]


def _placed(df: DataFrame, nx: int, ny: int) -> DataFrame:
    """Cell (i, j) and place in it (s, t) of points scaled to 0..1; the upper edge belongs to the last cell."""
    out = df.withColumns({"i": F.least(F.floor(F.col("u") * nx), F.lit(nx - 1)).cast("int"), "j": F.least(F.floor(F.col("v") * ny), F.lit(ny - 1)).cast("int")})
    return out.withColumns({"s": F.col("u") * nx - F.col("i"), "t": F.col("v") * ny - F.col("j")})


def _weights() -> list[Column]:
    b, c = basis(F.col("s")), basis(F.col("t"))
    return [b[k] * c[m] for k in range(4) for m in range(4)]


def _same(by: Sequence[str], other: str) -> Column:
    """Null-safe equality of the group columns with those that carry the prefix ``other``."""
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(other + c))
    return same


def _renamed(df: DataFrame, columns: Sequence[str], prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c if c in columns else c) for c in df.columns])


def _packed(nodes: DataFrame, by: Sequence[str], ny: int) -> DataFrame:
    """One row per group with ``phi``, the values of all nodes (a, b) of a whole lattice in order."""
    placed = nodes.select(*by, F.struct((F.col("a") * (ny + 3) + F.col("b")).alias("k"), "phi").alias("w"))
    return placed.groupBy(*by).agg(F.sort_array(F.collect_list("w"))["phi"].alias("phi"))


def _read(points: DataFrame, lattices: DataFrame, by: Sequence[str], nx: int, ny: int) -> DataFrame:
    """Add ``f``, the surface of the group's lattice (``phi``) at each point."""
    met = _placed(points, nx, ny).join(_renamed(lattices, by, "_c_"), _same(by, "_c_"), "left")
    node = lambda p: F.get(F.col("phi"), (F.col("i") + p // 4) * (ny + 3) + F.col("j") + p % 4)
    total = sum((w * node(p) for p, w in enumerate(_weights())), F.lit(0.0))
    return met.withColumn("f", F.coalesce(total, F.lit(0.0))).drop("phi", "i", "j", "s", "t", *["_c_" + c for c in by])


def _value(points: DataFrame, nodes: DataFrame, by: Sequence[str], nx: int, ny: int) -> DataFrame:
    """``_read`` for a whole lattice given as rows (a, b, phi)."""
    return _read(points, _packed(nodes, by, ny), by, nx, ny)


def fit_cells(points: DataFrame, by: Sequence[str], nx: int, ny: int) -> DataFrame:
    """For each cell (i, j) with points (u, v in 0..1, value z) the weighted sums that its 16 nodes get."""
    weights = _weights()
    squares = sum((w * w for w in weights), F.lit(0.0))
    placed = _placed(points, nx, ny).withColumn("_q", F.col("z") / squares)
    sums = [F.array(*[F.sum(w * w * w * F.col("_q")) for w in weights]).alias("up"), F.array(*[F.sum(w * w) for w in weights]).alias("down")]
    return placed.groupBy(*by, "i", "j").agg(*sums)


def _refined(phi: Column, nx: int, ny: int) -> Column:
    """The same surface on a lattice of twice as many cells; ``nx`` and ``ny`` are those of the coarse one."""
    # node a of a lattice lies at place a - 1, so the middle weight belongs to the fine node 2 (a - 1) + 1
    def near(fine: Column, n: int) -> list[tuple[Column, Column]]:
        first = F.floor((fine - 1) / 2).cast("int") + F.when(fine % 2 == 0, 1).otherwise(0)
        ends = F.when(fine % 2 == 0, REFINE[1]).otherwise(REFINE[0])
        middle = F.when(fine % 2 == 0, REFINE[3]).otherwise(REFINE[2])
        last = F.when(fine % 2 == 0, 0.0).otherwise(REFINE[4])
        return [(first, ends), (first + 1, middle), (F.least(first + 2, F.lit(n + 2)), last)]

    def value(k: Column) -> Column:
        a, b = near(F.floor(k / (2 * ny + 3)).cast("int"), nx), near(k % (2 * ny + 3), ny)
        return sum((F.get(phi, p * (ny + 3) + q) * v * w for p, v in a for q, w in b), F.lit(0.0))

    return F.transform(F.sequence(F.lit(0), F.lit((2 * nx + 3) * (2 * ny + 3) - 1)), value)


def refine(nodes: DataFrame, by: Sequence[str], nx: int, ny: int) -> DataFrame:
    """``_refined`` for a whole lattice given as rows (a, b, phi)."""
    fine = _packed(nodes, by, ny).select(*by, F.posexplode(_refined(F.col("phi"), nx, ny)).alias("k", "phi"))
    return fine.select(*by, F.floor(F.col("k") / (2 * ny + 3)).cast("int").alias("a"), (F.col("k") % (2 * ny + 3)).alias("b"), "phi")


def _added(lattices: DataFrame, cells: DataFrame, by: Sequence[str], ny: int) -> DataFrame:
    """Lattices with what the sums of cells give added to them; all rows of a group meet in one partition, bounded by its lattice."""
    none = F.lit(0.0)
    kept = F.transform("phi", lambda phi, k: F.struct(k.alias("k"), phi.alias("phi"), none.alias("up"), none.alias("down")))
    spread = F.transform(F.arrays_zip("up", "down"), lambda w, p: F.struct(
        ((F.col("i") + F.floor(p / 4).cast("int")) * (ny + 3) + F.col("j") + p % 4).alias("k"), none.alias("phi"), w["up"].alias("up"), w["down"].alias("down"),
    ))
    # sums of cells are sent as they are and spread to nodes after that
    sent = lattices.select(*by, "phi", *[F.lit(None).cast(cells.schema[c].dataType).alias(c) for c in ("i", "j", "up", "down")])
    sent = sent.unionByName(cells.withColumn("phi", F.lit(None).cast("array<double>")))
    sent = sent.repartition(*by) if by else sent.repartition(1)
    entries = sent.select(*by, F.inline(F.when(F.col("i").isNotNull(), spread).otherwise(kept)))
    nodes = entries.groupBy(*by, "k").agg(*[F.sum(c).alias(c) for c in ("phi", "up", "down")])
    total = F.col("phi") + F.coalesce(F.try_divide("up", "down"), none)
    return nodes.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("k", total.alias("phi"))))["phi"].alias("phi"))


def fit(points: DataFrame, groups: DataFrame, by: Sequence[str], cells: tuple[int, int], levels: int) -> tuple[DataFrame, int, int]:
    """The lattice of the whole surface of each group, and its cells each way, for points (u, v in 0..1) and values z."""
    nx, ny = cells
    flat = groups.select(*by, F.array_repeat(F.lit(0.0), (nx + 3) * (ny + 3)).alias("phi"))
    lattices = settled(_added(flat, fit_cells(points, by, nx, ny), by, ny))
    for _ in range(levels - 1):
        left = _read(points, lattices, by, nx, ny).withColumn("z", F.col("z") - F.col("f")).drop("f")
        finer = lattices.withColumn("phi", _refined(F.col("phi"), nx, ny))
        nx, ny = 2 * nx, 2 * ny
        lattices = settled(_added(finer, fit_cells(left, by, nx, ny), by, ny))
    return lattices, nx, ny


def fitted_surface(
    df: DataFrame, *, x: str, y: str, value: str, by: Sequence[str] = (), nx: int = 200, ny: int = 200,
    cells: tuple[int, int] = (1, 5), levels: int = 8,
) -> DataFrame:
    """The fitted surface on an nx by ny grid over the range of each ``by`` group, both ends included.

    Rows without a place or value are left out; a group whose points have one x (or y) gets a surface that
    is constant that way, reported at every grid line of that one place. The surface is given for the whole
    range, also where no points are near: a node that no point reaches is 0 at its level.
    """
    if min(nx, ny) < 2 or min(cells) < 1 or levels < 1:
        raise ValueError("a surface needs a grid of two lines each way, a cell and a level")
    rows = df.select(*by, *[F.col(c).cast("double").alias(f"_{n}") for c, n in ((x, "x"), (y, "y"), (value, "z"))]).dropna(subset=["_x", "_y", "_z"])
    ends = rows.groupBy(*by).agg(F.min("_x").alias("_x0"), F.max("_x").alias("_x1"), F.min("_y").alias("_y0"), F.max("_y").alias("_y1")).filter("_x0 is not null")
    scaled = lambda c: F.coalesce(F.try_divide(F.col(f"_{c}") - F.col(f"_{c}0"), F.col(f"_{c}1") - F.col(f"_{c}0")), F.lit(0.0))
    points = rows.join(_renamed(ends, by, "_e_"), _same(by, "_e_")).select(*by, scaled("x").alias("u"), scaled("y").alias("v"), F.col("_z").alias("z"))
    lattices, cx, cy = fit(points, ends, by, cells, levels)
    line = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    grid = ends.withColumn("x_idx", line(nx)).withColumn("y_idx", line(ny))
    grid = grid.withColumns({"u": F.col("x_idx") / (nx - 1), "v": F.col("y_idx") / (ny - 1)})
    at = lambda c, w: F.col(f"_{c}0") + (F.col(f"_{c}1") - F.col(f"_{c}0")) * F.col(w)
    told = _read(grid, lattices, by, cx, cy)
    return told.select(*by, "x_idx", "y_idx", at("x", "u").alias(x), at("y", "v").alias(y), F.col("f").alias(value))
