"""Maximal repeats and their removal against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from brinedeck.llm import repeats

DOCS = "doc_id long, text string, id string, at int, length int, n int, name string"


def brute_removed(texts, length):
    """Mask of removed bytes of each text."""
    at = defaultdict(int)
    raws = [(t or "").encode() for t in texts]
    for raw in raws:
        for i in range(len(raw) - length + 1):
            at[raw[i : i + length]] += 1
    out = []
    for raw in raws:
        mask = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if at[raw[i : i + length]] > 1:
                mask[i : i + length] = b"\1" * length
        out.append(mask)
    return raws, out


def digest(ids, texts, length):
    raws, masks = brute_removed(texts, length)
    out = []
    for i, raw, mask in zip(ids, raws, masks, strict=True):
        spans = sum(1 for k, m in enumerate(mask) if m and (k == 0 or not mask[k - 1]))
        kept = bytes(b for b, m in zip(raw, mask, strict=True) if not m)
        out.append((i, len(raw), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def table(spark, ids, texts):
    return spark.createDataFrame([(i, t, "x", 1, 2, 3, "y") for i, t in zip(ids, texts, strict=True)], DOCS)


def found(spark, ids, texts, length, together=4096):
    return sorted([tuple(r) for r in repeats.without_repeats(table(spark, ids, texts), length, together).collect()], key=str)


def corpus(seed):
    rng = random.Random(seed)
    make = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    lines = [make("abcdefgh", rng.randint(5, 60)) for _ in range(12)]
    texts = [None, "", "ab", make("abcdefgh", 9)]
    for _ in range(40):
        parts = []
        for _ in range(rng.randint(1, 6)):
            kind = rng.random()
            parts.append(rng.choice(lines) if kind < 0.4 else make("abcdefgh", rng.randint(1, 40)) if kind < 0.7 else make("ab", rng.randint(1, 4)) * rng.randint(1, 60))
        texts.append("".join(parts))
    long = make("abcdefgh", 700)
    for _ in range(8):
        cut = rng.randrange(700)
        texts.append(long[:cut] + "XYZ"[rng.randrange(3)] + long[cut + 1 :])
    nested = ("ab" * 20 + "c") * 9
    texts += [nested, "ab" * 7 + "c" + nested + "tail", "d" + nested[11:] + "tail", nested[3:90] + "end", "ba" * 33 + "tail of it", "ab" * 40 + "cab", "abc" * 50 + "x", "bca" * 9 + "bcx"]
    texts += [texts[10], texts[10], texts[11], long, "ab" * 300, "q" * 900 + "tail of it", "zz" + "q" * 800 + "tail of it", "Ωßé中" * 40, "x" + "Ωßé中" * 30]
    return texts


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("together", [4096, 3])
def test_removal_equals_brute_force(spark, seed, together, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 900)
    texts = corpus(seed)
    ids = list(range(len(texts) - 2)) + [None, 3]
    assert found(spark, ids, texts, 12, together) == digest(ids, texts, 12)


def test_odd_tables(spark):
    assert found(spark, [], [], 12) == []
    for texts in ([None], ["short"], ["one text without any repeat in it"], ["a text that comes twice"] * 2, ["aaaaaaaaaaaaaaaaaaaaaaaaa"], [None, "", None]):
        ids = list(range(len(texts)))
        assert found(spark, ids, texts, 12) == digest(ids, texts, 12)


def brute_groups(texts, length):
    """Maximal repeats of different texts: string to occurrences."""
    raws = sorted({(t or "").encode() for t in texts})
    out = {}
    prior = defaultdict(list)
    for k, raw in enumerate(raws):
        for i in range(len(raw) - length + 1):
            prior[raw[i : i + length]].append((k, i))
    todo = list(prior.values())
    size = length
    while todo:
        following = []
        for places in todo:
            if len(places) < 2:
                continue
            before = {raws[k][i - 1] if i else (k, i) for k, i in places}
            by_next = defaultdict(list)
            for k, i in places:
                by_next[raws[k][i + size] if i + size < len(raws[k]) else (k, i)].append((k, i))
            if len(before) > 1 and len(by_next) > 1:
                k, i = places[0]
                out[raws[k][i : i + size]] = sorted((raws[k], i) for k, i in places)
            following += by_next.values()
        todo, size = following, size + 1
    return out


def test_groups_hold_all_occurrences(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 900)
    rng = random.Random(5)
    make = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    lines = [make(rng.randint(8, 50)) for _ in range(10)]
    texts = ["".join(rng.choice(lines) + make(rng.randint(0, 3)) for _ in range(rng.randint(1, 6))) for _ in range(40)]
    texts += [texts[0], None]
    groups, occurrences, rows = repeats.maximal_repeats(table(spark, list(range(len(texts))), texts), 12)
    raw_of = {hashlib.sha256((t or "").encode()).digest()[:16]: (t or "").encode() for t in texts}
    by_row = defaultdict(list)
    for r in occurrences.collect():
        by_row[r["row"]].append((raw_of[bytes(r["id"])], r["at"]))
    found_groups = {}
    for g in groups.collect():
        places = sorted(p for row in range(g["lb"], g["rb"] + 1) for p in by_row[row])
        assert len(places) == g["n"]
        raw, at = places[0]
        found_groups[raw[at : at + g["length"]]] = places
    assert found_groups == brute_groups(texts, 12)
    assert {bytes(r["id"]): r["copies"] for r in rows.collect()}[hashlib.sha256(texts[0].encode()).digest()[:16]] == 2


def test_equal_windows_have_one_name():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, 4000).astype(np.uint8)
    data[3000:3300] = data[100:400]
    for length in (12, 40, 200):
        first, windows, name = repeats.segments(data, length)
        assert windows.sum() == len(data) - length + 1 and windows.max() <= length
        names, seen = np.repeat(name, windows), {}
        hashes = repeats.window_hashes(data, length)
        for i in range(len(names)):
            raw = data[i : i + length].tobytes()
            assert seen.setdefault(raw, (names[i], hashes[i])) == (names[i], hashes[i])


@pytest.mark.parametrize("seed", range(20))
def test_a_scan_in_pieces_equals_one_scan(seed):
    """Any cut of the array gives the intervals and row lengths of a scan without cuts."""
    rng = random.Random(seed)
    prefixes = [rng.choice([0, 3, 3, 4, 5, 7, 9]) for _ in range(60)]
    before = [rng.choice([1, 1, 1, 2, repeats.EDGE]) for _ in range(61)]
    item = lambda row, rows: repeats._Item(row, row, 1, before[row], before[row], rows)
    whole = repeats.IntervalScan(closed=True)
    for row in range(61):
        whole.add(item(row, [row]), prefixes[row - 1] if row else 0)
    whole.finish()
    nodes, told, edges, open_rows = [], {}, repeats.IntervalScan(closed=True), {}
    cuts = sorted(rng.sample(range(1, 61), rng.randint(1, 12)))
    for a, b in zip([0, *cuts], [*cuts, 61], strict=True):
        piece = repeats.IntervalScan(closed=False)
        for row in range(a, b):
            piece.add(item(row, [row]), prefixes[row - 1] if row > a else 0)
        nodes += piece.nodes
        told |= dict(piece.told)
        for k, x in enumerate(piece.items):
            open_rows[a, k] = repeats._flat(x.open)
            edges.add(repeats._Item(x.lb, x.rb, x.n, x.lo, x.hi, [(a, k)]), piece.prefixes[k - 1] if k else prefixes[a - 1] if a else 0)
    edges.finish()
    told |= {row: size for key, size in edges.told for row in open_rows[key]}
    assert sorted(nodes + edges.nodes) == sorted(whole.nodes) and told == dict(whole.told)
