"""The manifest against a plain Merkle tree in memory."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from brinedeck.llm import merkle

FIELDS = "doc_id long, source string, lang string, n_chars long, text string"
CLASH = ", tree long, hash string, steps int, _row int, lo string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def brute(rows):
    leaf = [h("".join(map(framed, r))) for r in rows]
    own = list(leaf)
    for k, (i, source, lang, n, text) in enumerate(rows):
        if i is not None and n is not None and zlib.crc32(str(i).encode()) % 7 == 0:
            own[k] = h("".join(map(framed, (i, source, lang, n + 1, text))))
    langs = sorted({r[2] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    members = {g: sorted((k for k, r in enumerate(rows) if r[2] == g), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, leaf[k])) for g in langs}
    trees = {g: levels([leaf[k] for k in members[g]]) for g in langs}
    above = levels([trees[g][-1][0] for g in langs]) if langs else []
    out = []
    for place, g in enumerate(langs):
        for at, k in enumerate(members[g]):
            folded, way = own[k], []
            for tree, i in ((trees[g], at), (above, place)):
                for level in tree[:-1]:
                    sibling = level[i ^ 1] if i ^ 1 < len(level) else ""
                    folded = h(sibling + folded if i % 2 else folded + sibling)
                    way.append(sibling)
                    i //= 2
            root = above[-1][0]
            out.append((rows[k][0], leaf[k], trees[g][-1][0], root, h("".join(way)), folded, folded == root))
    return sorted(out, key=str)


def found(spark, rows, stride):
    docs = spark.createDataFrame([(*r, 1, "x", 2, 3, "y") for r in rows], FIELDS + CLASH)
    out = merkle.manifest(docs, lambda i: F.crc32(i.cast("string")) % 7 == 0, {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}, stride=stride)
    return sorted([tuple(r) for r in out.collect()], key=str)


ODD = [
    (1, None, None, None, None), (None, "a", "en", 3, "x"), (7, "é", "en", 3, ""), (7, "é", "en", 3, ""), (7, "é", "en", 4, ""),
    (3, "s", "中", 2**62, "q" * 100_000), (-5, "s", "z", 1, "q"), (8, "", "", 0, " \n"),
]


@pytest.mark.parametrize("stride", [1, 8])
@pytest.mark.parametrize("rows", [[], ODD[:1], ODD, ODD + [(100 + k, "s", "m", k, "t" * k) for k in range(37)]], ids=["empty", "one", "odd", "many"])
def test_manifest_equals_brute_force(spark, rows, stride):
    assert found(spark, rows, stride) == brute(rows)


def test_copies_of_upper_nodes(spark, monkeypatch):
    monkeypatch.setattr(merkle, "SPREAD", 2)
    monkeypatch.setattr(merkle, "_CLIMB", merkle._CLIMB.replace("leaf_row, 12)", "leaf_row, 2)"))
    rows = [(k, "s", "abc"[k % 3], k, f"text {k}") for k in range(90)]
    assert found(spark, rows, 2) == brute(rows)


def test_the_row_limit_of_recursion_is_restored(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    found(spark, ODD, 3)
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before
