"""A Merkle manifest of a table of documents, and the proof of every row by a recursive climb.

1. A row's fields, each with its length, are hashed to its leaf. Leaves are numbered in a
   global order, group by group; a group's leaves are the bottom of its tree.
2. Levels are built upwards, ``stride`` levels at a time: 2**stride neighbouring nodes meet in
   one task, which hashes all levels between and gives each of the nodes a parent-linked row
   (its node, the parent ``stride`` levels up, the siblings on the way and their sides).
   The tops of the groups are the bottom of the tree above.
3. A recursive query ascends from every leaf: each step joins the row of the node reached,
   appends the siblings on the way to the proof and folds them into the row's own hash.

With ``stride=1`` a step is one level; larger strides make fewer steps over the same levels.
A node is named by its depth and the first leaf below. No join key of the climb is hot: the
row of a node with more than 2**SPREAD leaves below is stored once for each 2**SPREAD leaves,
and a leaf meets the copy of its own range.

Cases: a null field is hashed as ``-``, so it differs from an empty one; null groups form one
tree, before all others; rows of one doc_id are ordered by their leaf hash, equal rows share
it and each gets its own place; null doc_ids come first and are not tampered with; an empty
table gives an empty result; columns other than the fields, the group and the id are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinedeck.llm.common import in_order, settle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Leaves (as a power of two) that may share a join key of the climb.
SPREAD = 12
#: Depth at which the tree over the groups begins; no group has so many levels.
ABOVE = 64
_STEP = "array<struct<side:string,hash:binary>>"


def framed(value: Column) -> Column:
    """A field with its length in front, or ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: Sequence[str] = FIELDS, changed: dict[str, Column] | None = None) -> Column:
    """The leaf of a row, as hexadecimal digits; ``changed`` replaces the values of some fields."""
    return F.sha2(F.concat(*[framed((changed or {}).get(name, F.col(name))) for name in fields]), 256)


def _pair_up(level: Column) -> Column:
    """The parents of a level: two neighbours make one, a last one alone makes its own."""
    return F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(level) / 2).cast("int") - 1),
        lambda i: F.sha2(F.concat(F.get(level, 2 * i), F.coalesce(F.get(level, 2 * i + 1), F.lit(""))), 256),
    )


def _way(levels: Column, at: Column, height: Column) -> Column:
    """The steps of the node at place ``at`` to the top of its block: sibling and its side, null where there is none."""

    def step(t: Column) -> Column:
        place = F.call_function("shiftright", at, t)
        sibling = F.get(F.get(levels, t), place.bitwiseXOR(F.lit(1)))
        side = F.when(sibling.isNotNull(), F.when(place % 2 == 1, F.lit("l")).otherwise(F.lit("r")))
        return F.struct(side.alias("side"), F.unhex(sibling).alias("hash"))

    return F.when(height > 0, F.transform(F.sequence(F.lit(0), height - 1), step)).otherwise(F.array().cast(_STEP))


def raise_levels(nodes: DataFrame, stride: int, depth: int) -> DataFrame:
    """The parent-linked rows of one stored level.

    ``nodes``: tree, idx (place in the level, from 0), n (nodes of the level), lo and hi (first
    and last leaf below), hash; other columns are kept. Added: ``steps`` to the parent, the
    parent's hash ``top`` and name ``to_depth``, ``to_lo`` (a tree's top leads to the tree above, whose top
    leads nowhere), and ``blocks``, the parent's place and leaves.
    """
    kept = [c for c in nodes.columns if c not in ("tree", "n")]
    grouped = nodes.groupBy("tree", F.shiftright("idx", stride).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct(*kept[kept.index("idx"):], *kept[:kept.index("idx")]))).alias("members"),
        F.first("n").alias("n"), F.min("lo").alias("to_lo"), F.max("hi").alias("to_hi"),
    )
    last = F.col("n") <= (1 << stride)
    height = F.when(last, F.ceil(F.log2(F.col("n").cast("double"))).cast("int")).otherwise(F.lit(stride))
    bottom = F.transform("members", lambda m: F.lower(F.hex(m["hash"])))
    built = grouped.withColumns({"last": last, "height": height, "levels": F.array(bottom)})
    rise = F.when(F.col("height") > 0, F.sequence(F.lit(1), F.col("height"))).otherwise(F.array().cast("array<int>"))
    built = built.withColumn("levels", F.aggregate(rise, F.col("levels"), lambda have, _: F.concat(have, F.array(_pair_up(F.element_at(have, -1))))))
    built = built.withColumn("top", F.unhex(F.get(F.element_at("levels", -1), F.lit(0))))
    each = F.transform("members", lambda m, i: F.struct(*[m[c].alias(c) for c in kept], _way(F.col("levels"), i, F.col("height")).alias("steps")))
    onwards = F.when(~F.col("last"), depth + 1).when(F.lit(depth < ABOVE), ABOVE).cast("int")
    rows = built.select("tree", "block", "n", "to_lo", "to_hi", "top", onwards.alias("to_depth"), F.inline(each))
    return rows.withColumn("depth", F.lit(depth))


def _parents(rows: DataFrame) -> DataFrame:
    first = {c: F.first(c).alias(c) for c in ("n", "to_lo", "to_hi", "top", "to_depth")}
    return rows.groupBy("tree", "block").agg(*first.values())


def build(leaves: DataFrame, stride: int) -> tuple[DataFrame, DataFrame]:
    """Parent-linked rows of the leaves, and of all stored nodes above them up to the root, once for each range of leaves.

    ``leaves``: tree (the first leaf of the group), idx, n, lo = hi = number of the leaf, hash, and what else rows are to keep.
    """
    above: list[DataFrame] = []
    tops: list[DataFrame] = []

    def rise(nodes: DataFrame, depth: int) -> DataFrame:
        """All stored levels of trees; returns the rows of their bottom level."""
        bottom = rows = settle(raise_levels(nodes, stride, depth))
        while True:
            if rows is not bottom or depth >= ABOVE:
                above.append(rows)
            parents = _parents(rows)
            going = F.col("to_depth").isNotNull() & (F.col("to_depth") != ABOVE)
            tops.append(parents.filter(~going))
            left = settle(
                parents.filter(going).select(
                    "tree", F.col("block").alias("idx"), F.ceil(F.col("n") / (1 << stride)).cast("long").alias("n"),
                    F.col("to_lo").alias("lo"), F.col("to_hi").alias("hi"), F.col("top").alias("hash"),
                )
            )
            if left.isEmpty():
                return bottom
            depth += 1
            rows = settle(raise_levels(left, stride, depth))

    bottom = rise(leaves, 0)
    roots = tops[0]
    for more in tops[1:]:
        roots = roots.unionByName(more)
    placed = in_order(roots.select(F.col("to_lo").alias("lo"), F.col("to_hi").alias("hi"), F.col("top").alias("hash")), ["lo"])
    n = placed.count()
    if n:
        rise(placed.select(F.lit(0).cast("long").alias("tree"), F.col("_row").alias("idx"), F.lit(n).cast("long").alias("n"), "lo", "hi", "hash"), ABOVE)
    columns = ["depth", "lo", "hi", "to_depth", "to_lo", "top", "steps"]
    nodes = bottom.limit(0).select(columns)
    for rows in above:
        nodes = nodes.unionByName(rows.select(columns))
    ranges = F.explode(F.sequence(F.shiftright("lo", SPREAD), F.shiftright("hi", SPREAD)))
    return bottom, nodes.withColumn("leaf_range", ranges).drop("hi")


_FOLD = """unhex(aggregate(n.steps, lower(hex({own})), (acc, s) -> sha2(case s.side
    when 'l' then concat(lower(hex(s.hash)), acc) when 'r' then concat(acc, lower(hex(s.hash))) else acc end, 256)))"""
_APPEND = "aggregate(n.steps, {way}, (acc, s) -> concat(acc, coalesce(s.hash, X'')))"
_CLIMB = f"""
with recursive climb as (
  select lo as leaf_row, id, hash as leaf, {_FOLD.format(own="coalesce(tampered, hash)")} as folded, {_APPEND.format(way="X''")} as way,
    case when to_depth = {ABOVE} then top end as subroot, top, to_depth, to_lo
  from {{leaves}} n
  union all
  select c.leaf_row, c.id, c.leaf, {_FOLD.format(own="c.folded")}, {_APPEND.format(way="c.way")},
    coalesce(c.subroot, case when n.to_depth = {ABOVE} then n.top end), n.top, n.to_depth, n.to_lo
  from climb c join {{nodes}} n on n.depth = c.to_depth and n.lo = c.to_lo and n.leaf_range = shiftright(c.leaf_row, {SPREAD})
)
select * from climb where to_depth is null"""


def climb(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """Every leaf at the root: id, leaf, the siblings on its way, subroot, top (the root) and folded hash, as bytes.

    The recursion's own limit of rows counts all steps of all leaves and would stop large
    tables; it is off while the query runs.
    """
    spark = leaves.sparkSession
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        return settle(spark.sql(_CLIMB, leaves=leaves, nodes=nodes))
    finally:
        spark.conf.set(name, before)


def manifest(
    docs: DataFrame, tampered: Callable[[Column], Column], changed: dict[str, Column], fields: Sequence[str] = FIELDS,
    group: str = "lang", doc_id: str = "doc_id", stride: int = 8,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root and verified.

    Rows where ``tampered(id)`` holds fold the hash of their ``changed`` fields, others their own leaf.
    """
    own = leaf_hash(fields)
    other = F.when(tampered(F.col(doc_id)), leaf_hash(fields, changed))
    hashed = docs.select(F.col(group).cast("string").alias("grp"), F.col(doc_id).alias("id"), F.unhex(own).alias("hash"), F.unhex(other).alias("tampered"))
    placed = in_order(hashed, [F.asc_nulls_first("grp"), F.asc_nulls_first("id"), "hash"])
    spans = placed.groupBy("_part", "grp").agg(F.min("_row").alias("first"), F.count(F.lit(1)).alias("rows"))
    trees = spans.groupBy(F.col("grp").alias("of")).agg(F.min("first").alias("tree"), F.sum("rows").alias("n"))
    spans = spans.join(trees, F.col("grp").eqNullSafe(F.col("of"))).select(F.col("_part").alias("in_part"), "of", "tree", "n")
    leaves = placed.join(spans, (F.col("_part") == F.col("in_part")) & F.col("grp").eqNullSafe(F.col("of"))).select(
        "tree", (F.col("_row") - F.col("tree")).alias("idx"), "n", F.col("_row").alias("lo"), F.col("_row").alias("hi"), "hash", "id", "tampered"
    )
    found = climb(*build(leaves, stride))
    text = lambda c: F.lower(F.hex(c))
    return found.select(
        F.col("id").alias(doc_id), text("leaf").alias("leaf"), text("subroot").alias("subroot"), text("top").alias("root"),
        F.sha2(text("way"), 256).alias("proof_sha256"), text("folded").alias("folded_root"), (F.col("folded") == F.col("top")).alias("verified"),
    )
