"""Shards of linked documents by balanced label propagation.

Every document starts in the shard of its place in the order of ids. In each round the members of a link count
their shards; each document prefers the shard where most of its links' members are; and as
many move as the quotas allow: as many from a to b as from b to a, and beyond that only into free
room. Members of one link move together where they can. Rounds end when nothing moves. Then counts are made exactly even:
what is over a shard's quota leaves, unlinked documents first, and fills the shards below theirs.

All is joins and aggregations over (document, link). A link's members are counted before they
meet anything, so a link with most of all documents is a few rows; the driver holds one number
for each pair of shards.

Cases: null text counts as empty (size 1, checksum of nothing) and is linked with empty texts;
repeated rows are separate members of one group; null doc_ids come first in the order; ties go by
a hash of the link; an empty table gives an empty result; other columns are ignored; a group
larger than a shard's quota is split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brinedeck.llm.common import in_order, settle

#: Movers are accepted by classes of a hash, so that one aggregation finds whom the quotas admit.
BUCKETS = 4096


def _moves(counts: list[int], wanted: dict[tuple[int, int], int], room: int) -> dict[tuple[int, int], int]:
    """How many may move between each two shards: even exchanges, then into free room."""
    counts, allowed = list(counts), {}
    for (a, b), n in wanted.items():
        allowed[a, b] = min(n, wanted.get((b, a), 0))
    for (a, b), n in sorted(wanted.items(), key=lambda x: (-x[1], x[0])):
        more = max(0, min(n - allowed[a, b], room - counts[b]))
        allowed[a, b] += more
        counts[b] += more
        counts[a] -= more
    return {k: v for k, v in allowed.items() if v}


def propagate(members: DataFrame, links: DataFrame, shards: int, rounds: int = 8, slack: float = 0.25) -> DataFrame:
    """(member, shard) after balanced label propagation.

    ``members`` has member (0 to n - 1, once each) and shard; ``links`` has (member, link): all members of a
    link are linked. A shard's quota, its even share and ``slack`` of it, holds for its linked
    members: the others have nothing to lose, and ``even_out`` moves what is over as whole groups but one.
    Full shards are no goal.
    """
    state = members
    common = links.groupBy("link").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    links = settle(links.join(common, "link").select("member", "link", "n"))
    total = state.count()
    room = int(total / shards * (1 + slack))
    large = max(2, total // (shards * 64))  # a link larger than this may move in parts
    for _ in range(rounds):
        placed = settle(links.join(state, "member"))
        linked = placed.select("member", "shard").distinct().groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
        sizes = {r["shard"]: r["n"] for r in linked.collect()}  # one row per shard
        full = [s for s in range(shards) if sizes.get(s, 0) >= room]
        votes = placed.groupBy("link", "shard").agg(F.count(F.lit(1)).alias("votes"))
        ballots = votes.groupBy("link").agg(F.collect_list(F.struct(F.col("shard").alias("to"), "votes")).alias("ballot"))  # at most ``shards`` entries
        heard = placed.join(ballots, "link").select("member", "shard", "link", "n", F.inline("ballot"))
        sums = heard.groupBy("member", "shard", "to").agg(F.sum("votes").alias("votes"), F.max(F.struct("votes", "link", "n")).alias("unit"))
        rank = F.struct("votes", F.xxhash64("unit.link", "to"))
        sums = sums.filter(~F.col("to").isin(full) | (F.col("to") == F.col("shard")))
        wish = sums.groupBy("member", "shard").agg(F.max_by(F.struct("to", "unit"), rank).alias("best"))
        unit = F.when(F.col("best.unit.n") > large, F.xxhash64("member")).otherwise(F.xxhash64("best.unit.link"))
        movers = settle(wish.filter("best.to <> shard").select("member", "shard", F.col("best.to").alias("to"), F.pmod(unit, F.lit(BUCKETS)).cast("int").alias("bucket")))
        by_bucket = movers.groupBy("shard", "to", "bucket").agg(F.count(F.lit(1)).alias("n"))
        wanted = {(r["shard"], r["to"]): r["n"] for r in by_bucket.groupBy("shard", "to").agg(F.sum("n").alias("n")).collect()}  # at most shards squared rows
        allowed = _moves([sizes.get(s, 0) for s in range(shards)], wanted, room)
        if not allowed:
            break
        quota = F.coalesce(*[F.when((F.col("shard") == a) & (F.col("to") == b), F.lit(n)) for (a, b), n in allowed.items()], F.lit(0))
        upto = Window.partitionBy("shard", "to").orderBy("bucket")  # at most BUCKETS rows
        admitted = by_bucket.withColumn("sum", F.sum("n").over(upto)).filter(F.col("sum") <= quota).select("shard", "to", "bucket")
        moved = settle(movers.join(admitted, ["shard", "to", "bucket"]).select("member", "to"))
        if not moved.head(1):
            break
        state = settle(state.join(moved, "member", "left").select("member", F.coalesce("to", "shard").alias("shard")))
    return state


def even_out(placed: DataFrame, shards: int, keep_first: list) -> DataFrame:
    """Add ``slot`` and make the counts of ``shard`` exactly even (at most one apart); rows late in ``keep_first`` leave first."""
    ordered = in_order(placed, ["shard", *keep_first])
    sizes = {r["shard"]: r["n"] for r in ordered.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per shard
    counts = [sizes.get(s, 0) for s in range(shards)]
    total = sum(counts)
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    start = [sum(counts[:s]) for s in range(shards)]
    over = [max(0, c - q) for c, q in zip(counts, quota, strict=True)]
    free = [max(0, q - c) for c, q in zip(counts, quota, strict=True)]
    at = lambda values, index: F.get(F.array(*[F.lit(int(v)).cast("long") for v in values]), index)
    place = F.col("_row") - at(start, F.col("shard"))
    leaves = place >= at(quota, F.col("shard"))
    number = place - at(quota, F.col("shard")) + at([sum(over[:s]) for s in range(shards)], F.col("shard"))
    ends = [sum(free[: s + 1]) for s in range(shards)]
    goal = F.lit(0)
    for e in ends:
        goal = goal + (F.col("_number") >= e).cast("int")
    out = ordered.withColumn("_place", place).withColumn("_number", F.when(leaves, number))
    out = out.withColumn("_goal", F.when(F.col("_number").isNotNull(), goal))
    slot = F.when(F.col("_goal").isNull(), F.col("_place")).otherwise(at(counts, F.col("_goal")) + F.col("_number") - at([e - f for e, f in zip(ends, free, strict=True)], F.col("_goal")))
    return out.withColumn("slot", slot).withColumn("shard", F.coalesce("_goal", "shard")).drop("_place", "_number", "_goal", "_row", "_part")


def shard_documents(docs: DataFrame, shards: int = 8, rounds: int = 8) -> DataFrame:
    """Shard and slot of every document under the law ``rows``; documents with equal texts are linked."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("link"))
    ordered = settle(in_order(slim, ["doc_id", "text_crc32", "link"]).withColumnRenamed("_row", "member").drop("_part"))
    total = max(1, ordered.count())
    members = ordered.select("member", F.floor(F.col("member") * shards / total).cast("int").alias("shard"))
    final = propagate(members, ordered.select("member", "link"), shards, rounds)
    group = ordered.groupBy("link").agg(F.count(F.lit(1)).alias("_n"))
    placed = ordered.join(group, "link").join(final, "member").withColumn("_single", (F.col("_n") == 1).cast("int"))
    even = even_out(placed, shards, ["_single", "link", "member"])
    return even.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))
