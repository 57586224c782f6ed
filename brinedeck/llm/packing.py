"""Best-fit packing of token pieces into sequences, by linear grouping.

1. Documents become pieces of at most ``capacity`` tokens.
2. Pieces longer than ``capacity * small`` are large. In falling order of length they form
   groups of equal cardinality, and every length counts as the longest of its group, so that
   only ``groups`` sizes are left.
3. For these few sizes the best mix of configurations (how many pieces of each size share a
   sequence) is a linear programme, solved by column generation; its whole part is used and
   the few pieces left over go by best fit.
4. Actual pieces take the places of their group by rank; they are never longer than planned.
5. The room that is really left is filled with the small pieces by best fit, long ones first.

What is optimised on the driver is the histogram of lengths and of room left, at most
``capacity`` numbers each, whatever the size of the input. Rows find their place by rank
arithmetic and an equi-join on the sequence's number.

Cases: null and empty texts are pieces of the end id alone; repeated rows are packed as often
as they occur; null doc_ids are packed like others; an empty table gives an empty result;
columns other than doc_id and text are ignored; ties go by doc_id and piece.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brinedeck.llm.common import in_order, settle, ship
from brinedeck.llm.token_ids import encode_column, encoder, read_tokenizer

ship(__name__)

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Pieces of each whole text's ids: only documents over ``capacity`` are cut, and only their last piece is shorter."""
    content = read_tokenizer(tokenizer)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            doc, piece, start, length, crc = [], [], [], [], []
            for doc_id, ids in zip(batch["doc_id"], encode_column(encoder(content), batch["text"], end_id), strict=True):
                raw = memoryview(ids.astype("<u4")).cast("B")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    n = min(capacity, len(ids) - at)
                    doc.append(doc_id), piece.append(k), start.append(at), length.append(n)
                    crc.append(zlib.crc32(raw[4 * at : 4 * (at + n)]))
            keys = pd.array([None if pd.isna(d) else int(d) for d in doc], dtype="Int64")
            yield pd.DataFrame({"doc_id": keys, "piece": piece, "start": start, "length": length, "ids_crc32": crc})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(cut, PIECE)


def configurations(sizes: np.ndarray, counts: np.ndarray, capacity: int, tolerance: float = 1e-3, rounds: int = 3000) -> list[tuple[np.ndarray, int]]:
    """Which sizes share a sequence, and how often, so that all ``counts`` have a place: (pieces by size, times).

    The programme is solved to within ``tolerance`` of its optimum.
    """
    k = len(sizes)
    if not k:
        return []
    most = capacity // int(sizes.min())
    inverse = np.diag(1.0 / (capacity // sizes))
    basis = np.diag(capacity // sizes).astype(np.int64)
    amount = inverse @ counts.astype(float)
    for _ in range(rounds):
        worth = np.ones(k) @ inverse
        pattern = _richest(sizes, worth, capacity, most)
        if worth @ pattern <= 1 + tolerance:
            break
        step = inverse @ pattern
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(step > 1e-9, amount / step, np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        inverse[out] /= step[out]
        others = np.arange(k) != out
        inverse[others] -= np.outer(step[others], inverse[out])
        basis[:, out] = pattern
        amount = np.maximum(inverse @ counts.astype(float), 0.0)
    times = np.floor(amount + 1e-9).astype(np.int64)
    left = counts - basis @ times
    while (left < 0).any():  # numbers rounded the wrong way: take one back
        short = int(np.flatnonzero(left < 0)[0])
        column = int(np.flatnonzero((basis[short] > 0) & (times > 0))[0])
        times[column] -= 1
        left = counts - basis @ times
    plan = [(basis[:, p].copy(), int(times[p])) for p in range(k) if times[p]]
    room: list[tuple[int, int]] = []
    single: list[np.ndarray] = []
    for g in np.argsort(-sizes, kind="stable"):
        for _ in range(int(left[g])):
            at = bisect.bisect_left(room, (int(sizes[g]), -1))
            if at == len(room):
                single.append(np.zeros(k, np.int64))
                free, which = capacity, len(single) - 1
            else:
                free, which = room.pop(at)
            single[which][g] += 1
            bisect.insort(room, (free - int(sizes[g]), which))
    return plan + [(pattern, 1) for pattern in single]


def _richest(sizes: np.ndarray, worth: np.ndarray, capacity: int, most: int) -> np.ndarray:
    """The configuration of greatest worth (a knapsack over the capacity)."""
    best, choice = np.zeros(capacity + 1), np.full((most, capacity + 1), -1)
    for layer in range(most):
        grown = best.copy()
        for g, (s, w) in enumerate(zip(sizes.tolist(), worth.tolist(), strict=True)):
            if w <= 0:
                continue
            offer = best[: capacity + 1 - s] + w
            better = offer > grown[s:] + 1e-12
            grown[s:][better] = offer[better]
            choice[layer, s:][better] = g
        best = grown
    pattern, room = np.zeros(len(sizes), np.int64), capacity
    for layer in range(most - 1, -1, -1):
        g = choice[layer, room]
        if g >= 0:
            pattern[g] += 1
            room -= int(sizes[g])
    return pattern


@dataclass
class LargePlan:
    """Places for large pieces: rank -> group -> sequence and slot; ``first`` is the first sequence of the plan."""

    bounds: np.ndarray  # first rank of each group, and the end
    group: np.ndarray
    rank: np.ndarray  # first rank inside the group that this entry serves
    each: np.ndarray  # pieces of the group in each sequence
    sequence: np.ndarray
    slot: np.ndarray
    sequences: int

    def place(self, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        group = np.searchsorted(self.bounds, rank, "right") - 1
        inside = rank - self.bounds[group]
        order = np.searchsorted(self._key(self.group, self.rank), self._key(group, inside), "right") - 1
        index = inside - self.rank[order]
        return self.sequence[order] + index // self.each[order], self.slot[order] + index % self.each[order]

    @staticmethod
    def _key(group: np.ndarray, rank: np.ndarray) -> np.ndarray:
        return group.astype(np.int64) * (1 << 48) + rank


def plan_large(lengths: np.ndarray, counts: np.ndarray, capacity: int, groups: int, first: int) -> LargePlan:
    """``lengths`` fall; ranks run over their rows in that order."""
    total = int(counts.sum())
    bounds = np.unique((np.arange(groups + 1) * total) // groups) if total else np.zeros(1, np.int64)
    longest = lengths[np.searchsorted(np.cumsum(counts), bounds[:-1], "right")]
    entries, sequence = [], first
    for pattern, times in configurations(longest, np.diff(bounds), capacity):
        slot = 0
        for g in np.flatnonzero(pattern):
            entries.append((g, int(pattern[g]), sequence, slot, int(pattern[g]) * times))
            slot += int(pattern[g])
        sequence += times
    entries.sort(key=lambda e: e[0])
    group, rank, served = [], [], dict.fromkeys(range(len(bounds)), 0)
    for g, *_, serves in entries:
        group.append(g), rank.append(served[g])
        served[g] += serves
    column = lambda k: np.array([e[k] for e in entries], np.int64)
    return LargePlan(bounds, np.array(group, np.int64), np.array(rank, np.int64), column(1), column(2), column(3), sequence - first)


@dataclass
class SmallPlan:
    """Places for small pieces: rank within a length -> row of the table of sequences by room, and offset."""

    length: np.ndarray
    rank: np.ndarray
    each: np.ndarray
    row: np.ndarray  # place of the sequence in the order by room; new sequences follow after all
    offset: np.ndarray

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = lambda a, b: a.astype(np.int64) * (1 << 48) + b
        at = np.searchsorted(key(self.length, self.rank), key(length, rank), "right") - 1
        index = rank - self.rank[at]
        return self.row[at] + index // self.each[at], self.offset[at] + index % self.each[at] * length


def plan_small(lengths: np.ndarray, counts: np.ndarray, room: np.ndarray, rooms: np.ndarray, capacity: int) -> SmallPlan:
    """Best fit by classes: ``room`` rises, ``rooms`` are the sequences with that much; long pieces go first."""
    held: dict[int, list[tuple[int, int]]] = {}
    first = np.concatenate(([0], np.cumsum(rooms)))
    for k, r in enumerate(room.tolist()):
        held.setdefault(r, []).append((int(first[k]), int(first[k + 1])))
    known = sorted(held)
    fresh, made = int(first[-1]), []

    def put(r: int, a: int, b: int) -> None:
        if a < b:
            if r not in held:
                bisect.insort(known, r)
                held[r] = []
            held[r].append((a, b))

    for k in np.argsort(-lengths, kind="stable"):
        size, left, rank = int(lengths[k]), int(counts[k]), 0
        while left:
            at = bisect.bisect_left(known, size)
            if at == len(known):
                need = -(-left // (capacity // size))
                put(capacity, fresh, fresh + need)
                fresh += need
                continue
            r = known[at]
            a, b = held[r].pop()
            if not held[r]:
                del held[r], known[at]
            each = r // size
            used = min(left, (b - a) * each)
            whole, rest = divmod(used, each)
            made.append((size, rank, each, a, capacity - r))
            put(r - each * size, a, a + whole)
            if rest:
                put(r - rest * size, a + whole, a + whole + 1)
            put(r, a + whole + bool(rest), b)
            rank += used
            left -= used
    made.sort()
    return SmallPlan(*(np.array([m[k] for m in made], np.int64) for k in range(5)))


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, small: float = 0.125, groups: int = 64) -> DataFrame:
    """All pieces of ``docs`` with ``sequence_id`` and ``offset``; offsets of a sequence are gapless from 0."""
    limit = int(capacity * small)
    pieces = settle(token_pieces(docs, tokenizer, capacity, end_id))
    histogram = sorted(((r["length"], r["count"]) for r in pieces.groupBy("length").count().collect()), reverse=True)  # at most capacity rows
    lengths, counts = (np.array([h[k] for h in histogram], np.int64) for k in (0, 1))
    ranked = in_order(pieces, [F.desc("length"), "doc_id", "piece"])
    begin = dict(zip(lengths.tolist(), np.concatenate(([0], np.cumsum(counts)[:-1])).tolist(), strict=True)) if len(lengths) else {}
    full, big = lengths == capacity, (lengths < capacity) & (lengths > limit)
    n_full, n_big = int(counts[full].sum()), int(counts[big].sum())
    large = plan_large(lengths[big], counts[big], capacity, groups, n_full)

    def place_large(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence, slot = large.place(batch["_row"].to_numpy(np.int64) - n_full)
            yield batch.assign(sequence_id=sequence, slot=slot)

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = ranked.select(*columns, "_row")
    whole = rows.filter(F.col("_row") < n_full).select(*columns, F.col("_row").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    middle = rows.filter((F.col("_row") >= n_full) & (F.col("_row") < n_full + n_big))
    seated = settle(middle.mapInPandas(place_large, f"{PIECE}, _row long, sequence_id long, slot long"))
    earlier = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    placed_large = seated.select(*columns, "sequence_id", F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset"))

    room = seated.groupBy("sequence_id").agg((F.lit(capacity) - F.sum("length")).alias("room"))
    by_room = in_order(room, ["room", "sequence_id"]).select(F.col("_row").alias("bin"), F.col("sequence_id"), "room")
    rooms = sorted((r["room"], r["count"]) for r in by_room.groupBy("room").count().collect())  # at most capacity rows
    left, many = (np.array([r[k] for r in rooms], np.int64) for k in (0, 1))
    little = plan_small(lengths[lengths <= limit], counts[lengths <= limit], left, many, capacity)
    opened, taken = int(many.sum()), n_full + large.sequences

    def place_small(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            size = batch["length"].to_numpy(np.int64)
            rank = batch["_row"].to_numpy(np.int64) - np.array([begin[x] for x in size.tolist()], np.int64)
            bins, offset = little.place(size, rank)
            yield batch.drop(columns="_row").assign(bin=bins, offset=offset)

    rest = rows.filter(F.col("_row") >= n_full + n_big).mapInPandas(place_small, f"{PIECE}, bin long, offset long")
    numbered = rest.join(by_room.select("bin", "sequence_id"), "bin", "left")
    placed_small = numbered.select(*columns, F.coalesce("sequence_id", F.col("bin") - opened + taken).alias("sequence_id"), "offset")
    return whole.unionByName(placed_large).unionByName(placed_small)
