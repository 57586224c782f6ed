"""Point in polygon, box fallback and zone lookup."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brinedeck.fixed_values import STATION_ZONES


def polygon_edges(vertices: DataFrame, region: Sequence[str], ring: str = "ring", seq: str = "seq", x: str = "x", y: str = "y") -> DataFrame:
    """Edges of closed rings from a vertex table.

    The window holds one ring; rings are data of a map layer, not of the
    observations.
    """
    order = W.partitionBy(*region, ring).orderBy(seq)
    first = W.partitionBy(*region, ring).orderBy(seq).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return vertices.select(
        *region, F.col(x).alias("x1"), F.col(y).alias("y1"),
        F.coalesce(F.lead(x).over(order), F.first(x).over(first)).alias("x2"),
        F.coalesce(F.lead(y).over(order), F.first(y).over(first)).alias("y2"),
    )


def _side(e: Column, qx: Column, qy: Column) -> Column:
    """1, 0 or -1 for a point left of, on, or right of the line of a directed edge.

    Where doubles cannot tell, the coordinates are compared as decimals of 12 places, as they are written.
    """
    a, b = (e["x2"] - e["x1"]) * (qy - e["y1"]), (e["y2"] - e["y1"]) * (qx - e["x1"])
    x1, y1, x2, y2, x, y = (v.try_cast("decimal(17,12)") for v in (e["x1"], e["y1"], e["x2"], e["y2"], qx, qy))
    exact = F.signum((x2 - x1) * (y - y1) - (y2 - y1) * (x - x1))
    doubtful = F.abs(a - b) <= (F.abs(a) + F.abs(b)) * 1e-5
    return F.coalesce(F.when(doubtful, exact), F.signum(a - b))


def _right_of(e: Column, qx: Column, qy: Column) -> Column:
    """Whether the edge meets the height just above ``qy`` to the right of the place just right of ``qx``."""
    side = _side(e, qx, qy) * F.signum(e["y2"] - e["y1"])
    return (side > 0) | ((side == 0) & (F.signum(e["x2"] - e["x1"]) * F.signum(e["y2"] - e["y1"]) > 0))


def _toggles(e: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Whether the edge is crossed once on the way from (ax, ay) up or down to height ``by`` and then along it to ``bx``.

    Both ends are taken a little higher and, less, to the right, so that vertices and edges on the way count once.
    """
    def above(y: Column) -> Column:
        return _side(e, ax, y) * F.signum(e["x2"] - e["x1"]) < 0

    upright = ((e["x1"] > ax) != (e["x2"] > ax)) & (above(ay) != above(by))
    level = ((e["y1"] > by) != (e["y2"] > by)) & (_right_of(e, ax, by) != _right_of(e, bx, by))
    return F.coalesce(upright != level, F.lit(False))


def _on_edge(e: Column, px: Column, py: Column) -> Column:
    in_box = px.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & py.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
    return F.coalesce(in_box & (_side(e, px, py) == 0), F.lit(False))


def _columns(e: Column, j: Column, h: Column) -> tuple[Column, Column]:
    """First and last column of the tiles of size ``h`` that an edge can touch in row ``j``."""
    low, high = F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])
    def at(y: Column) -> Column:
        inside = F.least(F.greatest(y, F.least(e["y1"], e["y2"])), F.greatest(e["y1"], e["y2"]))
        return e["x1"] + F.try_divide((inside - e["y1"]) * (e["x2"] - e["x1"]), e["y2"] - e["y1"])

    a, b, slack = at(j * h), at((j + 1) * h), (F.abs(low) + F.abs(high) + h) * 1e-12
    first = F.greatest(low, F.coalesce(F.least(a, b) - slack, low))
    last = F.least(high, F.coalesce(F.greatest(a, b) + slack, high))
    return F.floor(first / h), F.floor(last / h)


def _rows(e: Column, h: Column) -> tuple[Column, Column]:
    return F.floor(F.least(e["y1"], e["y2"]) / h), F.floor(F.greatest(e["y1"], e["y2"]) / h)


def region_tiles(edges: DataFrame, region: Sequence[str], tile: float = 1.0, leaf: int = 16, depth: int = 8) -> tuple[DataFrame, DataFrame]:
    """A covering of the plane by tiles: those wholly inside a region, and those that hold edges.

    The first table has one row per tile of size ``tile`` (``_ti``, ``_tj``): the regions that hold all
    of it (``_inside``), and how often it is halved (``_k``, at most ``depth`` times): a tile of n edges is
    cut into about n / ``leaf`` cells, so that cells number as edges do. The second has one row per cell of such a tile (``_k``, ``_ci``,
    ``_cj``) that is not outside: for each region, whether the cell's lower left corner is inside (``p``), with each
    edge that may touch the cell, or with none where the whole cell is inside.

    A corner's parity comes from the crossings of its row of tiles, put in order per region and row; a halved
    cell hands its parity down, changed by those of its own edges that lie between both corners.
    """
    if tile <= 0 or math.frexp(tile)[0] != 0.5:
        raise ValueError("the tile size must be a power of two, so that cell borders are exact")
    h = F.lit(float(tile))
    e = F.col("e")
    lines = edges.select(
        F.struct(*region).alias("r"), F.struct(*[F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")]).alias("e"),
    ).filter("e.x1 is not null and e.y1 is not null and e.x2 is not null and e.y2 is not null")

    pieces = lines.withColumn("j", F.explode(F.sequence(*_rows(e, h)))).withColumn("i", F.explode(F.sequence(*_columns(e, F.col("j"), h))))
    pieces = pieces.select("r", "i", "j", "e")

    first, last = F.ceil(F.least("e.y1", "e.y2") / h), F.ceil(F.greatest("e.y1", "e.y2") / h) - 1
    crossed = lines.filter(first <= last).withColumn("j", F.explode(F.sequence(first, last)))
    y = F.col("j") * h
    near = F.floor((e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"])) / h)
    right = F.when(_right_of(e, (near + 1) * h, y), near + 1).when(_right_of(e, near * h, y), near).otherwise(near - 1)
    ordered = W.partitionBy("r", "j").orderBy("to")
    between = crossed.select("r", "j", right.alias("to")).select("r", "j", "to", F.row_number().over(ordered).alias("n"), F.lead("to").over(ordered).alias("next"))
    odd = between.filter("n % 2 = 1 and next > to").select("r", "j", F.explode(F.sequence(F.col("to") + 1, F.col("next"))).alias("i"))

    corners = odd.select("r", "i", "j", F.lit(None).cast(pieces.schema["e"].dataType).alias("e"), F.lit(1).alias("p"))
    here, own = W.partitionBy("i", "j"), W.partitionBy("i", "j", "r")
    halvings = F.least(F.lit(depth), F.greatest(F.lit(0), F.ceil(F.log2(F.count("e").over(here) / leaf) / 2))).cast("int")
    known = pieces.withColumn("p", F.lit(0)).unionByName(corners).select(
        "r", "i", "j", "e", F.coalesce(halvings, F.lit(0)).alias("k"), F.max("p").over(own).alias("p"), F.count("e").over(own).alias("n"),
    )
    tiles = known.groupBy(F.col("i").alias("_ti"), F.col("j").alias("_tj")).agg(
        F.max("k").alias("_k"), F.collect_list(F.when(F.col("n") == 0, F.col("r"))).alias("_inside"),
    )
    state = known.filter("e is not null").select("r", "k", "i", "j", "e", "p")
    deepest = tiles.agg(F.max("_k")).first()[0] or 0  # one number, at most ``depth``
    for level in range(deepest):
        state = _halved(state, level, tile / 2**level)
    cells = state.groupBy("k", "i", "j").agg(F.collect_list(F.struct("r", "p", "e")).alias("_cell"))
    return tiles, cells.select(F.col("k").alias("_k"), F.col("i").alias("_ci"), F.col("j").alias("_cj"), "_cell")


def _halved(state: DataFrame, level: int, size: float) -> DataFrame:
    """Cells of ``state`` that are to be halved beyond ``level`` by their four quarters; the others as they are."""
    e, i, j = F.col("e"), F.col("i"), F.col("j")
    here, h = F.lit(float(size)), F.lit(size / 2)
    split = F.col("k") > level
    quarters = F.when(split, F.array(*[F.struct((2 * i + a).alias("i"), (2 * j + b).alias("j")) for a in (0, 1) for b in (0, 1)])).otherwise(F.array(F.struct(i, j)))
    quarter = state.withColumn("q", F.explode(quarters))
    (low, high), (left, right) = _rows(e, h), _columns(e, F.col("q.j"), h)
    touches = ~split | F.coalesce(F.col("q.j").between(low, high) & F.col("q.i").between(left, right), F.lit(False))
    changed = split & _toggles(e, i * here, j * here, F.col("q.i") * h, F.col("q.j") * h)
    rows = quarter.select("r", "k", F.col("q.i").alias("i"), F.col("q.j").alias("j"), "e", "p", touches.alias("t"), changed.cast("int").alias("c"))
    own = W.partitionBy("r", "k", "i", "j")
    rows = rows.select(
        "r", "k", "i", "j", F.when(F.col("t"), e).alias("e"), "t", ((F.col("p") + F.sum("c").over(own)) % 2).cast("int").alias("p"),
        F.max("t").over(own).alias("any"), F.row_number().over(own.orderBy(F.lit(0))).alias("n"),
    )
    return rows.filter(F.col("t") | (~F.col("any") & (F.col("p") == 1) & (F.col("n") == 1))).select("r", "k", "i", "j", "e", "p")


def region_join(points: DataFrame, edges: DataFrame, *, x: str, y: str, region: Sequence[str], tile: float = 1.0, leaf: int = 16, depth: int = 8) -> DataFrame:
    """Attributes of the region that holds each point, NULL outside all regions.

    All rings of a region count together, so holes are outside; a point exactly on an edge, of a
    hole too, belongs to the region. Where regions overlap the first in ``region`` order is taken. Points without a
    coordinate are outside. A point meets one tile and one cell of ``region_tiles`` and stays
    one row; only edges of its cell are tested, nothing is aggregated after the joins, and the
    small sides are broadcast if Spark measures them so.
    """
    tiles, cells = region_tiles(edges, region, tile, leaf, depth)
    px, py = (F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in (x, y))
    placed = points.withColumns({"_px": px, "_py": py}).withColumns({"_ti": F.floor(F.col("_px") / tile), "_tj": F.floor(F.col("_py") / tile)})
    px, py = F.col("_px"), F.col("_py")
    tiled = placed.join(tiles, ["_ti", "_tj"], "left").withColumn("_h", F.lit(float(tile)) / F.pow(F.lit(2.0), F.coalesce("_k", F.lit(0))))
    found = tiled.withColumns({"_ci": F.floor(px / F.col("_h")), "_cj": F.floor(py / F.col("_h"))}).join(cells, ["_k", "_ci", "_cj"], "left")

    ax, ay, cell = F.col("_ci") * F.col("_h"), F.col("_cj") * F.col("_h"), F.col("_cell")

    def holds(r: Column) -> Column:
        own = F.filter(cell, lambda c: c["r"] == r)
        crossed = F.size(F.filter(own, lambda c: _toggles(c["e"], ax, ay, px, py)))
        return F.exists(own, lambda c: _on_edge(c["e"], px, py)) | ((crossed + F.get(own, F.lit(0))["p"]) % 2 == 1)

    hits = F.filter(F.array_distinct(F.transform(cell, lambda c: c["r"])), holds)
    hit = F.array_min(F.array(F.array_min("_inside"), F.array_min(hits)))
    return found.withColumn("_hit", hit).select(*points.columns, *[F.col(f"_hit.{c}").alias(c) for c in region])


def region_bbox_fallback(points: DataFrame, *, x: str, y: str, region: str, boxes: Sequence[tuple[str, tuple[float, float, float, float]]]) -> DataFrame:
    """Name of the first box holding a point that no region holds."""
    fallback = F.lit(None).cast("string")
    for name, (x0, x1, y0, y1) in reversed(list(boxes)):
        fallback = F.when(F.col(x).between(x0, x1) & F.col(y).between(y0, y1), F.lit(name)).otherwise(fallback)
    return points.withColumn(region, F.coalesce(F.col(region), fallback))


def region_boxes(edges: DataFrame, region: str, names: Sequence[str]) -> list[tuple[str, tuple[float, float, float, float]]]:
    """Bounding boxes of the named regions, in the given order (one row per name is read)."""
    rows = edges.filter(F.col(region).isin(*names)).groupBy(region).agg(
        F.least(F.min("x1"), F.min("x2")), F.greatest(F.max("x1"), F.max("x2")),
        F.least(F.min("y1"), F.min("y2")), F.greatest(F.max("y1"), F.max("y2")),
    ).collect()
    found = {r[0]: tuple(float(v) for v in r[1:]) for r in rows}
    return [(n, found[n]) for n in names if n in found]


def lookup_tz(station: Column, zones: Mapping[str, str] = STATION_ZONES) -> Column:
    """Time zone of a station code; NULL for an unknown one."""
    out = F.lit(None).cast("string")
    for code, zone in zones.items():
        out = F.when(station == code, F.lit(zone)).otherwise(out)
    return out
