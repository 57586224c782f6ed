"""Maximal repeats of a corpus by a common-prefix interval tree, and their removal.

A repeat is a byte string of at least ``length`` bytes that starts at two places, within one text
or in two; it is maximal if its occurrences differ in the byte before and in the byte after
(the ends of texts count as differing). Equal texts are one text with copies.

1. Candidates. Every window of ``length`` bytes is named by its smallest gram, windows in a row with
   one name are a segment. A window that occurs twice has the same name both times, so only texts
   with segments of a name that occurs twice go on, and of those only the regions such segments span.
2. Starts. Segments of one name meet (equal contents once, with counts); windows that occur twice
   are found there, and with them the left-extension diversity of each: a maximal repeat can
   only begin at a window whose occurrences are preceded by different bytes.
3. Enhanced suffix array. The suffixes at these starts, each as far as its windows occur twice, are
   put in one global order (equal suffixes once, with their places); the common prefixes of neighbours make the array enhanced.
4. Interval tree. A stack-scan of the common prefixes finds the intervals of suffixes that share
   a prefix; those with different bytes before are the maximal repeats. An interval [lb, rb] stands for all
   occurrences of its suffixes, so the output stays linear although repeats nest. Each task
   scans its piece of the array; what is open at its edges (a few items for each different
   prefix length) is closed by one scan over the edges of all pieces.

Names and contents are compared by 64-bit hashes within one name, texts by 128 bits. A stretch
that repeats itself with a period p would have nearly as many suffixes as bytes, each nearly
as long as the stretch: there, the suffixes between the second period and the last
2p + ``length`` bytes are left out, and one more starts where these last bytes do, as if the
text began there. The bytes covered stay the same (each of the stretch by its first two
periods, those around its end by the last suffixes); repeats inside such a stretch are reported with its ends only.

Cases: null texts are empty; texts under ``length`` bytes hold no window; a text with copies is a
repeat as a whole if it is long enough; repeated rows, whatever their ids, are copies; an empty table gives an empty result;
columns other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brinedeck.llm.common import in_order, settle, ship

ship(__name__)

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xC2B2AE3D27D4EB4F)
#: A start at the beginning of a text, or one whose left side is not to count, differs from all others.
EDGE = -1
#: Bytes of text that a task looks at together.
CHUNK = 8 << 20


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _B
    return h ^ (h >> np.uint64(29))


def gram_of(length: int) -> int:
    """Bytes of a gram: a power of two, at most a third of the window."""
    return 1 << max(0, (length // 3).bit_length() - 1)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes at each place that has so many."""
    n = len(data)
    if n < gram:
        return np.zeros(0, np.uint64)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    words = np.lib.stride_tricks.as_strided(padded, (n, 8), (1, 1)).copy().view("<u8").ravel()
    size = min(gram, 8)
    if size < 8:
        words &= np.uint64((1 << 8 * size) - 1)
    h = _mixed(words * _A + _C)
    while size < gram:
        h = _mixed(h[: len(h) - size] * _A + h[size:])
        size *= 2
    return h[: n - gram + 1]


def window_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` bytes at each place that has so many."""
    gram, n = gram_of(length), len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = gram_hashes(data, gram)
    out = h[:n]
    for at in [*range(gram, length - gram, gram), length - gram]:
        out = _mixed(out * _A + h[at : at + n])
    return out


def segments(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and name of the segments of a text.

    Windows in a row whose smallest gram (the first of equal ones) is at the same place are a
    segment; its name is the gram's hash. So equal windows have one name, wherever they are.
    """
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    gram = gram_of(length)
    h = gram_hashes(data, gram)
    low = np.uint64(0xFFFFFFFF)
    least, span, width = (h & ~low) | np.arange(len(h), dtype=np.uint64), 1, length - gram + 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    at = (least & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return first, np.diff(np.append(first, n)), h[at[first]]


def _bytes(text) -> bytes:
    return (text or "").encode()


def _view(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8)


def _name(raw: bytes) -> bytes:
    return hashlib.sha256(raw).digest()[:16]


def _signed(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h).view(np.int64)


_SEGMENT = "name long, key long, first long, windows int, known boolean, beacon boolean"


def _find_segments(length: int):
    """Segments of each text; within a chunk, which names occur twice (``known``) and one row for each name (``beacon``)."""

    def chunk(rows: dict[int, np.ndarray]) -> pd.DataFrame:
        parts = {c: [] for c in ("name", "key", "first", "windows")}
        for key, data in rows.items():
            first, windows, name = segments(data, length)
            for c, v in zip(parts, (_signed(name), np.full(len(first), key), first, windows), strict=True):
                parts[c].append(v)
        out = pd.DataFrame({c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in parts.items()})
        _, at, which, count = np.unique(out["name"], return_index=True, return_inverse=True, return_counts=True)
        out["known"] = count[which] > 1
        out["beacon"] = np.isin(np.arange(len(out)), at)
        return out

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, held = {}, 0
        for batch in batches:
            for key, text in zip(batch["key"], batch["text"], strict=True):
                if key not in rows:
                    rows[key] = _view(_bytes(text))
                    held += len(rows[key])
                    if held >= CHUNK:
                        yield chunk(rows)
                        rows, held = {}, 0
        yield chunk(rows)

    return read


_REGION = "id binary, at long, before int, data binary"


def _cut_regions(length: int):
    """The regions of a text that its candidate segments span, one behind the other."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, spans in zip(batch["text"], batch["spans"], strict=True):
                raw = _bytes(text)
                spans = sorted((s["first"], s["windows"]) for s in spans)
                joined = []
                for first, windows in spans:
                    if joined and first <= joined[-1][1]:
                        joined[-1][1] = max(joined[-1][1], first + windows)
                    else:
                        joined.append([first, first + windows])
                name = _name(raw)
                out += [(name, a, raw[a - 1] if a else EDGE, raw[a : b + length - 1]) for a, b in joined]
            yield pd.DataFrame(out, columns=["id", "at", "before", "data"])

    return cut


_CONTENT = "name long, content long, id binary, region long, first long, lo int, hi int, n long, bytes binary"


def _read_segments(length: int):
    """Segments of the regions (by text and first byte) with a hash of their content.

    The first row of a content in a batch also has its bytes, how often the batch has it, and the least and greatest byte before.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, met = [], {}
            for name_of, at, before, raw in zip(batch["id"], batch["at"], batch["before"], batch["data"], strict=True):
                first, windows, names = segments(_view(raw), length)
                for a, w, name in zip(first.tolist(), windows.tolist(), _signed(names).tolist(), strict=True):
                    content = raw[a : a + w + length - 1]
                    digest = int.from_bytes(hashlib.blake2b(content, digest_size=8).digest(), "little", signed=True)
                    prior = raw[a - 1] if a else before
                    have = met.get((name, digest))
                    if have is None:
                        met[name, digest] = have = [name, digest, name_of, at, at + a, prior, prior, 1, content]
                        out.append(have)
                    else:
                        have[5], have[6], have[7] = min(have[5], prior), max(have[6], prior), have[7] + 1
                        out.append([name, digest, name_of, at, at + a, None, None, None, None])
            out = pd.DataFrame(out, columns=["name", "content", "id", "region", "first", "lo", "hi", "n", "bytes"])
            yield out.astype({"lo": "Int32", "hi": "Int32", "n": "Int64"})

    return read


_VERDICT = "name long, content long, starts array<long>, runs array<long>"


def _runs(places: np.ndarray) -> list[int]:
    """Rising places as first, end, first, end."""
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) != 1)
    return np.column_stack((places[np.concatenate(([0], cut + 1))], places[np.concatenate((cut, [len(places) - 1]))] + 1)).ravel().tolist()


def _windows_of(rows: pd.DataFrame, length: int) -> dict[str, np.ndarray]:
    """All windows of contents: row, offset, hash, least and greatest byte before, occurrences."""
    data = _view(b"".join(rows["bytes"]))
    sizes = rows["bytes"].map(len).to_numpy(np.int64)
    begin = np.cumsum(sizes) - sizes
    windows = sizes - length + 1
    row = np.repeat(np.arange(len(rows)), windows)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = begin[row] + offset
    before, inside = data[np.maximum(at - 1, 0)].astype(np.int32), offset > 0
    pick = lambda c: rows[c].to_numpy()[row]
    low, high = (np.where(inside, before, pick(c)) for c in ("lo", "hi"))
    return {"row": row, "offset": offset, "hash": window_hashes(data, length)[at], "lo": low, "hi": high, "n": pick("n")}


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    """One row for each content, with what all batches know of it."""
    return rows.groupby(["name", "content"], as_index=False).agg({"lo": "min", "hi": "max", "n": "sum", "bytes": "first"})


def _judge(length: int):
    """Segments of some names: at which windows starts lie, and which windows occur twice."""

    def judge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = _merged(rows)
        w = _windows_of(rows, length)
        name = rows["name"].to_numpy().view(np.uint64)[w["row"]]
        _, which = np.unique(_mixed(name * _A + w["hash"]), return_inverse=True)
        order = np.argsort(which, kind="stable")
        edge = np.flatnonzero(np.diff(which[order], prepend=-1))
        lo, hi = np.minimum.reduceat(w["lo"][order], edge), np.maximum.reduceat(w["hi"][order], edge)
        twice = np.add.reduceat(w["n"][order], edge) > 1
        repeated, start = twice[which], (twice & ((lo != hi) | (lo == EDGE)))[which]
        return _as_verdicts(rows, w["row"], w["offset"], repeated, start)

    return judge


def _as_verdicts(rows: pd.DataFrame, row: np.ndarray, offset: np.ndarray, repeated: np.ndarray, start: np.ndarray) -> pd.DataFrame:
    out = []
    ends = np.searchsorted(row, np.arange(len(rows) + 1))
    for k, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
        if repeated[a:b].any():
            out.append((rows["name"][k], rows["content"][k], offset[a:b][start[a:b]].tolist(), _runs(offset[a:b][repeated[a:b]])))
    return pd.DataFrame(out, columns=["name", "content", "starts", "runs"])


def _explode_windows(length: int):
    """The windows of contents as rows."""

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), 200):
                part = batch.iloc[a : a + 200].reset_index(drop=True)
                w = _windows_of(part, length)
                pick = lambda c: part[c].to_numpy()[w["row"]]  # noqa: B023, E731
                yield pd.DataFrame({"name": pick("name"), "content": pick("content"), "offset": w["offset"], "hash": _signed(w["hash"]), "lo": w["lo"], "hi": w["hi"], "n": w["n"]})

    return explode


def _judge_rows(contents: DataFrame, length: int) -> DataFrame:
    """Verdicts as from ``_judge`` where a name has too many contents for one task: windows meet as rows, counted before they are sent."""
    whole = contents.groupBy("name", "content").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"), F.max("bytes").alias("bytes"))
    rows = settle(whole.mapInPandas(_explode_windows(length), "name long, content long, offset long, hash long, lo int, hi int, n long"))
    found = rows.groupBy("name", "hash").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("n > 1")
    told = found.select("name", "hash", ((F.col("lo") != F.col("hi")) | (F.col("lo") == EDGE)).alias("start"))
    met = rows.select("name", "hash", "content", "offset").join(told.toDF("name", "hash", "start"), ["name", "hash"])
    listed = met.groupBy("name", "content").agg(F.sort_array(F.collect_list(F.struct("offset", "start"))).alias("w"))

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[["name", "content"]].copy()
            out["starts"] = [[x["offset"] for x in w if x["start"]] for w in batch["w"]]
            out["runs"] = [_runs(np.array([x["offset"] for x in w])) for w in batch["w"]]
            yield out

    return listed.mapInPandas(runs, _VERDICT)


def _common(a: bytes, b: bytes) -> int:
    """Bytes of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    done, step = 0, 64
    while a[done : done + step] == b[done : done + step]:
        done, step = done + step, step * 2
    x = int.from_bytes(a[done : min(done + step, n)], "big") ^ int.from_bytes(b[done : min(done + step, n)], "big")
    return min(done + step, n) - (x.bit_length() + 7) // 8


def _suffixes(data: bytes, runs: list[tuple[int, int]], starts: list[int], length: int) -> Iterator[tuple[int, int, bool]]:
    """Start, end and whether the left side counts, of the suffixes of a region; of stretches with a period those at their ends."""
    for a, b in runs:
        end = b + length - 1
        mine = starts[bisect_left(starts, a) : bisect_left(starts, b)]
        ends, forced = dict.fromkeys(mine, end), set()
        same: dict[bytes, list[int]] = {}
        for s in mine:
            same.setdefault(data[s : s + length], []).append(s)
        for places in same.values():
            k = 0
            while k + 2 < len(places):
                i, p = places[k], places[k + 1] - places[k]
                if places[k + 2] - places[k + 1] != p:
                    k += 1
                    continue
                stop = i + p + _common(data[i:end], data[i + p : end])
                room = 2 * p + length
                if stop - i >= room:
                    forced.add(stop - room)
                    for s in mine[bisect_left(mine, i + 2 * p) : bisect_left(mine, stop - room)]:
                        ends.pop(s, None)
                k = max(k + 1, bisect_left(places, stop - length - p + 1))
        ends |= dict.fromkeys(forced, end)
        for s, e in ends.items():
            yield s, e, s not in forced


_SUFFIX = "suffix binary, id binary, at long, before int, bytes binary"


def _read_suffixes(length: int):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, seen = [], set()
            for name, at, before, raw, told in zip(batch["id"], batch["at"], batch["before"], batch["data"], batch["told"], strict=True):
                n = len(raw) - length + 1
                mask, starts = np.zeros(n + 2, np.int8), []
                for t in told:
                    first = t["first"] - at
                    if 0 <= first < n:
                        starts += [first + s for s in t["starts"]]
                        for a, b in zip(t["runs"][::2], t["runs"][1::2], strict=True):
                            mask[first + a : first + b] = 1
                runs = _runs(np.flatnonzero(mask))
                runs = list(zip(runs[::2], runs[1::2], strict=True))
                for s, e, counts in _suffixes(raw, runs, sorted(starts), length):
                    data = raw[s:e]
                    digest = _name(data)
                    prior = EDGE if not counts else raw[s - 1] if s else before
                    out.append((digest, name, at + s, prior, None if digest in seen else data))
                    seen.add(digest)
            yield pd.DataFrame(out, columns=["suffix", "id", "at", "before", "bytes"])

    return read


class _Item:
    """Neighbouring suffixes that every interval yet to close holds together: rows lb to rb, occurrences, bytes before, rows not yet in an interval."""

    __slots__ = ("hi", "lb", "lo", "n", "open", "rb")

    def __init__(self, lb, rb, n, lo, hi, rows):
        self.lb, self.rb, self.n, self.lo, self.hi, self.open = lb, rb, n, lo, hi, rows

    def take(self, other: _Item) -> None:
        self.rb = max(self.rb, other.rb)
        self.n += other.n
        self.lo, self.hi = min(self.lo, other.lo), max(self.hi, other.hi)
        self.open = [self.open, other.open] if self.open and other.open else self.open or other.open


def _flat(nested) -> list:
    out, todo = [], [nested]
    while todo:
        x = todo.pop()
        if isinstance(x, list):
            todo += x
        else:
            out.append(x)
    return out


class IntervalScan:
    """A stack-scan over a stretch of the array whose left and right neighbours may not be known yet.

    ``add`` takes the next item and its common prefix with the one before. An interval is closed, and
    becomes one item, when the prefixes on both its sides are shorter. ``items`` and ``prefixes``
    hold what is open: prefixes fall, then rise.
    """

    def __init__(self, closed: bool):
        self.items: list[_Item] = []
        self.prefixes: list[int] = []  # prefixes[i] is between items[i] and items[i + 1]
        self.floor = 0  # items before this one lie on the left edge
        self.closed = closed  # the left neighbour of the stretch shares nothing
        self.nodes: list[tuple[int, int, int, int, bool]] = []
        self.told: list[tuple[object, int]] = []

    def add(self, item: _Item, prefix: int) -> None:
        """``prefix`` is not looked at for the first item."""
        if self.items:
            self._close(prefix)
            if len(self.prefixes) > 1 and self.prefixes[-1] == self.prefixes[-2] == prefix:
                # the last two items lie between equal prefixes: an open interval holds both or neither
                last = self.items.pop()
                self.prefixes.pop()
                self.items[-1].take(last)
                if not prefix:
                    self.items[-1].open = []
            self.prefixes.append(prefix)
        self.items.append(item)

    def _close(self, prefix: int) -> None:
        while self.prefixes and self.prefixes[-1] > prefix:
            top = self.prefixes[-1]
            first = len(self.prefixes)
            while first and self.prefixes[first - 1] == top:
                first -= 1
            if first == 0 and not self.closed:
                return  # it may go on beyond the left edge
            if first and self.prefixes[first - 1] > top:
                return  # on the falling side: still open to the left
            self._node(first, top)

    def _node(self, first: int, length: int) -> None:
        """Items from ``first`` on become one, an interval of this prefix length."""
        whole = self.items[first]
        for other in self.items[first + 1 :]:
            whole.take(other)
        del self.items[first + 1 :], self.prefixes[first:]
        maximal = length > 0 and (whole.lo != whole.hi or whole.lo == EDGE)
        if length > 0:
            self.nodes.append((whole.lb, whole.rb, length, whole.n, maximal))
        if maximal:
            self.told += [(row, length) for row in _flat(whole.open)]
            whole.open = []

    def finish(self) -> None:
        """The right neighbour of the stretch shares nothing."""
        self._close(0)


_SCAN = "kind string, a long, b long, length long, n long, lo int, hi int, maximal boolean, piece long, place long, edge binary"
_COLUMNS = ["kind", "a", "b", "length", "n", "lo", "hi", "maximal", "piece", "place", "edge"]


def _scan_piece(length: int):
    """A piece of the array: its closed intervals, the deepest maximal one of each row, and the items open at its edges."""

    def ended(scan: IntervalScan, piece: int, head: bytes, tail: bytes) -> list[tuple]:
        out = [("row", row, row, found, 0, 0, 0, False, None, None, None) for row, found in scan.told]
        out += [("node", lb, rb, size, n, 0, 0, maximal, None, None, None) for lb, rb, size, n, maximal in scan.nodes]
        scan.told, scan.nodes = [], []
        for k, item in enumerate(scan.items):
            prefix = scan.prefixes[k - 1] if k else 0
            edge = head if k == 0 else None
            out.append(("item", item.lb, item.rb, prefix, item.n, item.lo, item.hi, False, piece, k, edge))
            out += [("open", row, row, 0, 0, 0, 0, False, piece, k, None) for row in _flat(item.open)]
        out.append(("last", 0, 0, 0, 0, 0, 0, False, piece, len(scan.items), tail))
        return out

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scan, piece, next_row, last, head = None, 0, None, b"", b""
        for batch in batches:
            out = []
            for row, raw, n, lo, hi in zip(batch["_row"].tolist(), batch["bytes"], batch["n"].tolist(), batch["lo"].tolist(), batch["hi"].tolist(), strict=True):
                if row != next_row:
                    if scan is not None:
                        out += ended(scan, piece, head, last)
                    scan, piece, head, prefix = IntervalScan(closed=False), row, raw, 0
                else:
                    prefix = _common(last, raw)
                scan.add(_Item(row, row, n, lo, hi, [row]), prefix if prefix >= length else 0)
                if n > 1:  # equal suffixes share all of it
                    scan.add(_Item(row, row, 0, 256, EDGE - 1, []), len(raw))
                last, next_row = raw, row + 1
            if scan is not None:
                out += [("row", row, row, found, 0, 0, 0, False, None, None, None) for row, found in scan.told]
                out += [("node", lb, rb, size, n, 0, 0, maximal, None, None, None) for lb, rb, size, n, maximal in scan.nodes]
                scan.told, scan.nodes = [], []
            yield pd.DataFrame(out, columns=_COLUMNS)
        if scan is not None:
            yield pd.DataFrame(ended(scan, piece, head, last), columns=_COLUMNS)

    return read


def _scan_edges(length: int):
    """The open items of all pieces in order, in one task: a few for each piece and different prefix length."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scan, tail, seen = IntervalScan(closed=True), b"", []
        for batch in batches:
            for r in batch.itertuples():
                if r.kind == "last":
                    tail = r.edge
                    continue
                key = (int(r.piece), int(r.place))
                seen.append(key)
                prefix = int(r.length)
                if key[1] == 0:
                    prefix = _common(tail, r.edge) if tail else 0
                    prefix = prefix if prefix >= length else 0
                scan.add(_Item(int(r.a), int(r.b), int(r.n), int(r.lo), int(r.hi), [key]), prefix)
        if seen:
            scan.finish()
        out = [("node", lb, rb, size, n, 0, 0, maximal, None, None, None) for lb, rb, size, n, maximal in scan.nodes]
        out += [("found", 0, 0, found, 0, 0, 0, False, *key, None) for key, found in scan.told]
        yield pd.DataFrame(out, columns=_COLUMNS)

    return read


def maximal_repeats(docs: DataFrame, length: int = 200, together: int = 4096) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The maximal repeats of all texts, and where they are.

    ``groups``: lb, rb, length and n (occurrences) of each maximal repeat. ``occurrences``: row
    (place in the array), id (of a text), at (its byte) and length (of the longest repeat that begins there, null if none);
    a group's occurrences are those of rows lb to rb. ``texts``: id, n_bytes and copies of each different text.
    ``together`` bounds how many different contents of one name meet in one task.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    raw = F.encode(text, "UTF-8")
    whole = docs.select(text.alias("text"), F.unhex(F.substring(F.sha2(raw, 256), 1, 32)).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"))
    texts = whole.groupBy("id").agg(F.first("n_bytes").alias("n_bytes"), F.count(F.lit(1)).alias("copies"))
    keyed = docs.select(text.alias("text"), F.xxhash64(text).alias("key")).filter(F.octet_length("text") >= length)

    found = settle(keyed.select("key", "text").mapInPandas(_find_segments(length), _SEGMENT), "zstd")
    place, same = F.xxhash64("key", "first"), Window.partitionBy("name")
    beacons = found.filter("beacon").select("name", "key", "first", "windows", "known")
    beacons = beacons.withColumns({"twice": F.max("known").over(same) | (F.min(place).over(same) != F.max(place).over(same))}).filter("twice")
    candidates = beacons.select("key", "first", "windows").unionByName(found.filter("known and not beacon").select("key", "first", "windows"))
    spans = candidates.groupBy("key").agg(F.collect_set(F.struct("first", "windows")).alias("spans"))
    distinct = keyed.groupBy("key").agg(F.collect_set("text").alias("texts"))
    regions = settle(distinct.join(spans, "key").select(F.explode("texts").alias("text"), "spans").mapInPandas(_cut_regions(length), _REGION), "zstd")

    parts = settle(regions.mapInPandas(_read_segments(length), _CONTENT), "zstd")
    contents = parts.filter("n is not null").select("name", "content", "lo", "hi", "n", "bytes")
    crowds = settle(contents.groupBy("name").agg(F.count(F.lit(1)).alias("many")).filter(F.col("many") > together).select(F.col("name").alias("of")))
    usual = contents
    if not crowds.isEmpty():
        usual = contents.join(crowds, F.col("name") == F.col("of"), "left_anti")
    tasks = max(1, contents.count() // 20_000)
    verdicts = usual.groupBy(F.pmod(F.xxhash64("name"), F.lit(tasks))).applyInPandas(_judge(length), _VERDICT)
    if not crowds.isEmpty():
        verdicts = verdicts.unionByName(_judge_rows(contents.join(crowds, F.col("name") == F.col("of"), "left_semi"), length))
    verdicts = settle(verdicts)
    told = parts.select("name", "content", "id", "region", "first").join(verdicts.toDF("name", "content", "starts", "runs"), ["name", "content"])
    told = told.groupBy("id", F.col("region").alias("at")).agg(F.collect_list(F.struct("first", "starts", "runs")).alias("told"))

    suffixes = settle(regions.join(told, ["id", "at"]).mapInPandas(_read_suffixes(length), _SUFFIX), "zstd")
    array = suffixes.groupBy("suffix").agg(F.min("before").alias("lo"), F.max("before").alias("hi"), F.count(F.lit(1)).alias("n"), F.max("bytes").alias("bytes"))
    array = in_order(array, ["bytes"], dealt_by=[F.substring("bytes", 1, 512)], codec="zstd")
    scanned = settle(array.select("_row", "bytes", "n", "lo", "hi").mapInPandas(_scan_piece(length), _SCAN))
    edges = scanned.filter("kind in ('item', 'last')").repartition(1).sortWithinPartitions("piece", "place")
    closed = settle(edges.mapInPandas(_scan_edges(length), _SCAN))

    late = closed.filter("kind = 'found'").select(F.col("piece").alias("p"), F.col("place").alias("q"), F.col("length").alias("size"))
    waiting = scanned.filter("kind = 'open'")
    lengths = scanned.filter("kind = 'row'").select(F.col("a").alias("row"), "length").unionByName(
        waiting.join(late, (F.col("piece") == F.col("p")) & (F.col("place") == F.col("q")), "left").select(F.col("a").alias("row"), F.col("size").alias("length"))
    )
    named = array.select("suffix", F.col("_row").alias("row")).join(lengths, "row", "left").select("row", F.col("suffix").alias("of"), "length")
    occurrences = suffixes.join(named, F.col("suffix") == F.col("of")).select("row", "id", "at", "length")
    nodes = scanned.filter("kind = 'node'").unionByName(closed.filter("kind = 'node'"))
    groups = nodes.filter("maximal and n > 1").select(F.col("a").alias("lb"), F.col("b").alias("rb"), "length", "n")
    return groups, occurrences, texts


def _cut_spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Bytes and runs that spans take off a text, and the hash of the rest."""
    for batch in batches:
        out = []
        for name, text, spans in zip(batch["id"], batch["text"], batch["spans"], strict=True):
            raw, joined = _bytes(text), []
            for a, b in sorted((s["at"], s["end"]) for s in spans):
                if joined and a <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], b)
                else:
                    joined.append([a, b])
            kept, done = hashlib.sha256(), 0
            for a, b in joined:
                kept.update(raw[done:a])
                done = b
            kept.update(raw[done:])
            out.append((name, sum(b - a for a, b in joined), len(joined), kept.hexdigest()))
        yield pd.DataFrame(out, columns=["of", "n_removed", "n_spans", "kept_sha256"])


def without_repeats(docs: DataFrame, length: int = 200, together: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row when each byte in an occurrence of a repeat goes."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    raw = F.encode(text, "UTF-8")
    digest = F.sha2(raw, 256)
    name = F.unhex(F.substring(digest, 1, 32))
    _, occurrences, texts = maximal_repeats(docs, length, together)
    copied = texts.filter((F.col("copies") > 1) & (F.col("n_bytes") >= length)).select(F.col("id").alias("copy"))
    spans = occurrences.filter("length is not null").groupBy("id").agg(F.collect_set(F.struct("at", (F.col("at") + F.col("length")).alias("end"))).alias("spans"))
    spans = settle(spans.join(copied, F.col("id") == F.col("copy"), "left_anti"))  # texts with copies go as a whole
    single = docs.select(name.alias("of"), text.alias("text")).filter(F.octet_length("text") >= length)
    cut = settle(single.join(spans, F.col("of") == F.col("id")).select("id", "text", "spans").mapInPandas(_cut_spans, "of binary, n_removed long, n_spans long, kept_sha256 string"))
    gone = settle(copied.withColumn("whole", F.lit(True)))
    rows = docs.select("doc_id", name.alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), digest.alias("digest"))
    met = rows.join(gone, F.col("id") == F.col("copy"), "left").join(cut, F.col("id") == F.col("of"), "left")
    return met.select(
        "doc_id", "n_bytes", F.when(F.col("whole"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("whole"), 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(F.col("whole"), hashlib.sha256().hexdigest()).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"),
    )
