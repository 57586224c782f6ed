"""SimHash near-duplicates with BK-trees.

A text's fingerprint has a bit for each bit that over half of its shingle hashes set.
Fingerprints within ``radius`` bits are linked; classes are what links connect.

Distinct fingerprints are dealt to shards so that any two within the radius meet: the 64 bits
are cut into ``blocks``, and two fingerprints that differ in at most ``radius`` bits agree in
all but ``radius`` blocks, so every choice of ``blocks - radius`` blocks with their values is
a shard. A shard builds a BK-tree (children keyed by the whole-number Hamming distance to their
parent), and its fingerprints follow only the edges within the radius of their own distance. The
trees travel with their shard instead of being broadcast, since together they grow with the
corpus. A shard of more than ``shard_limit`` fingerprints is cut into pieces, and each piece's
tree meets each piece's queries in a task of its own. A shard returns a link from each
fingerprint to the first of its local class, never all pairs, which loses no connection.

Cases: null and wordless texts have fingerprint zero and are linked like others; fewer words
than a shingle make one shingle; copies and repeated rows collapse before any search; null
doc_ids get the class of their fingerprint and never name a class unless it has no other id;
an empty table gives an empty result; other columns are ignored by the search.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brinedeck.llm.common import settle, ship

ship(__name__)

SEED = 42


def fingerprint_of(text: str | None, shingle: int = 3) -> int:
    """The 64-bit fingerprint of a text; A-Z count as a-z, words are cut at ASCII white space."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    set_bits = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), 1 << 16):
        part = zip(starts[at : at + (1 << 16)].tolist(), ends[at : at + (1 << 16)].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in part], "<u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """Fingerprint as a (signed) long."""

    def column(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(t, shingle) for t in texts], np.uint64).view(np.int64))

    return F.pandas_udf(column, "long")(text)


def hexadecimal(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


class BKTree:
    """A tree over distinct 64-bit values; each node's children are keyed by their distance to it."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.child = np.full((len(values), 65), -1, np.int32)
        parent = np.zeros(max(len(values) - 1, 0), np.int64)
        moving = np.arange(1, len(values))
        while len(moving):  # all values go down a level at once; the first to reach a free edge stays there
            edge = np.bitwise_count(values[moving] ^ values[parent])
            place, first = np.unique(parent * 65 + edge, return_index=True)
            free = self.child.ravel()[place] < 0
            self.child.ravel()[place[free]] = moving[first[free]]
            down = self.child[parent, edge]
            stay = down == moving
            moving, parent = moving[~stay], down[~stay].astype(np.int64)

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, node) at most ``radius`` apart, following only edges within the radius."""
        for at in range(0, len(queries), 512):
            query = np.arange(at, min(at + 512, len(queries)))
            node = np.zeros(len(query), np.int64)
            while len(query):
                apart = np.bitwise_count(queries[query] ^ self.values[node]).astype(np.int64)
                near = apart <= radius
                if near.any():
                    yield query[near], node[near]
                below, whose = [], []
                for edge in range(-radius, radius + 1):
                    ok = (apart + edge > 0) & (apart + edge <= 64)
                    child = self.child[node[ok], apart[ok] + edge]
                    below.append(child[child >= 0].astype(np.int64))
                    whose.append(query[ok][child >= 0])
                node, query = np.concatenate(below), np.concatenate(whose)


def local_roots(tree: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (value, smallest value of its class) among the values of one shard, or between two pieces of it."""
    values = np.unique(np.concatenate((tree, queries)))
    label = np.arange(len(values))
    at_tree, at_query = np.searchsorted(values, tree), np.searchsorted(values, queries)
    for q, t in BKTree(tree).within(queries, radius):
        a, b = at_query[q], at_tree[t]
        while True:
            low = np.minimum(label[a], label[b])
            before = label.copy()
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            while True:  # follow labels to their ends
                up = label[label]
                if (up == label).all():
                    break
                label = up
            if (before == label).all():
                break
    moved = label != np.arange(len(values))
    return values[moved], values[label[moved]]


def _masks(blocks: int, radius: int) -> list[int]:
    """Bit masks of all choices of ``blocks - radius`` blocks."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    block = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    masks = [sum(choice) for choice in combinations(block, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(values: DataFrame, radius: int, blocks: int | None = None, shard_limit: int = 8192) -> DataFrame:
    """Links (a, b) that connect all values ``fp`` (distinct) within ``radius`` of each other; b is the smaller as unsigned."""
    blocks = radius + 2 if blocks is None else blocks
    masks = F.array(*[F.struct(F.lit(k).alias("shard"), F.lit(m).alias("mask")) for k, m in enumerate(_masks(blocks, radius))])
    keyed = values.select("fp", F.inline(masks)).select("fp", "shard", F.col("fp").bitwiseAND(F.col("mask")).alias("value"))
    sizes = keyed.groupBy("shard", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    pieces = F.ceil(F.col("n") / shard_limit).cast("int")
    own = F.pmod(F.xxhash64("fp"), pieces).cast("int")
    met = keyed.join(sizes, ["shard", "value"]).select("shard", "value", "fp", own.alias("own"), pieces.alias("pieces"))
    other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    met = met.withColumn("other", other)
    tile = met.select(
        "shard", "value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp",
        (F.col("own") <= F.col("other")).alias("in_tree"), (F.col("own") >= F.col("other")).alias("is_query"),
    )
    key = ["shard", "value", "i", "j"]

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def solve(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
            fp = group["fp"].to_numpy(np.int64).view(np.uint64)
            tree, queries = fp[group["in_tree"].to_numpy(bool)], fp[group["is_query"].to_numpy(bool)]
            return local_roots(tree, queries, radius) if len(tree) and len(queries) else (fp[:0], fp[:0])

        def solved(rows: pd.DataFrame, cut: np.ndarray) -> pd.DataFrame:
            found = [solve(rows.iloc[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            a, b = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.uint64) for k in (0, 1))
            return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

        for batch in batches:
            rows = pd.concat([*held, batch], ignore_index=True)
            change = np.flatnonzero((rows[key].to_numpy()[1:] != rows[key].to_numpy()[:-1]).any(axis=1)) + 1
            if not len(change):
                held = [rows]
                continue
            yield solved(rows, np.concatenate(([0], change)))
            held = [rows.iloc[change[-1] :]]
        if held:
            rows = pd.concat(held, ignore_index=True)
            yield solved(rows, np.array([0, len(rows)]))

    return tile.repartition(*key).sortWithinPartitions(*key).mapInPandas(search, "a long, b long")


def connected(edges: DataFrame) -> DataFrame:
    """Classes (node, root) of the nodes that ``edges`` (a, b) touch: alternating large and small stars.

    Each round replaces every neighbourhood by a star around its smallest node; the edges never
    grow in number, and the rounds end when nothing changes (about the logarithm of a class's size).
    """
    now = settle(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = settle(small.union(small_least.select("a", "m")).distinct())
        seen = now.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0))).first()
        if seen == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = seen


def classes(documents: DataFrame, radius: int) -> DataFrame:
    """By fingerprint ``fp``: its class's smallest doc_id ``component_id``, and ``root``, for a table of (doc_id, fp)."""
    values = settle(documents.groupBy("fp").agg(F.min("doc_id").alias("first")))
    found = connected(links(values.select("fp"), radius))
    member = values.join(found, values["fp"] == found["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    name = member.groupBy("root").agg(F.min("first").alias("component_id"))
    return member.join(name, "root").select("fp", "root", "component_id")


def simhash_groups(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """Each document's fingerprint (16 hexadecimal digits) and ``component_id``, the smallest doc_id it is connected with."""
    marked = settle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprint(F.col("text"), shingle).alias("fp")))
    named = classes(marked, radius)
    return marked.join(named, "fp").select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest doc_id.

    Rows whose doc_id is null or repeated are told apart by their whole content; of equal rows
    one stays. All other rows are only tested against the ids to drop.
    """
    marked = settle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprint(F.col("text"), shingle).alias("fp")))
    named = settle(classes(marked, radius))
    repeated = settle(marked.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or doc_id is null").select(F.col("doc_id").alias("_id")))
    dropped = marked.join(named, "fp").filter("doc_id <> component_id").select(F.col("doc_id").alias("_id")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("of"), F.col("text").alias("words"))  # no clash with the documents' own columns
    alone = rows.join(dropped.union(repeated), F.col("of") == F.col("_id"), "left_anti").filter("of is not null")
    unclear = rows.join(repeated, F.col("of").eqNullSafe(F.col("_id")), "left_semi")
    told = unclear.withColumn("mark", fingerprint(F.col("words"), shingle)).join(named.select(F.col("fp").alias("mark"), "root", "component_id"), "mark")
    order = [F.to_json(F.struct(f"row.`{f.name}`")) if "map<" in f.dataType.simpleString() else F.col(f"row.`{f.name}`") for f in docs.schema.fields]  # maps have no order
    best = told.filter(F.col("of").eqNullSafe(F.col("component_id"))).withColumn("rank", F.row_number().over(Window.partitionBy("root").orderBy(*order)))
    return alone.select("row.*").unionByName(best.filter("rank = 1").select("row.*"))
