"""Ranked search against the scores of all documents."""

import math
import random
import re
from collections import Counter

import pytest

from brinedeck.llm import ranked_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in wanted.items():
        scored = []
        for i, c in counted:
            m = 10 + (90 * c.total() * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -score) for rank, (score, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    pool = [f"w{int(rng.paretovariate(0.6)) % 500}" for _ in range(3000)]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.choice([1, 5, 40, 300]))) for _ in range(300)]
    odd = [None, "", " .,;\n", "Éa éa ÉA", "it's w1-W2_w3", "中文 w1", "w1 " * 30_000, "x" * 200_000, "w2 w3", "w2 w3", "w2 w3"]
    docs = list(enumerate(texts + odd)) + [(5, "w9 w10 w11"), (5, "w9 w10 w11"), (None, "w2 w3"), (None, "rare w7")]
    items = [(k, " ".join(rng.choice(pool) for _ in range(rng.choice([1, 3, 30])))) for k in range(12)]
    items += [(12, None), (13, ""), (14, "nowhere"), (15, "w2 w3"), (15, "W9"), (None, "rare w7"), (16, "w1 w1 W1 éa"), (16, "w1 w1 W1 éa")]
    return docs, items


DOCS = "doc_id long, text string, item_id long, score long, block int, term string, lengths int"
ITEMS = "item_id long, text string, doc_id long, query int"


def found(spark, docs, items, **how):
    docs = spark.createDataFrame([(*r, 1, 2, 3, "x", 4) for r in docs], DOCS)
    items = spark.createDataFrame([(*r, 1, 2) for r in items], ITEMS)
    return sorted([tuple(r) for r in ranked_search.ranked_search(docs, items, **how).collect()], key=str)


@pytest.mark.parametrize(
    "how", [{}, {"block_docs": 20, "owners": 9, "bundle": 3}, {"k": 1, "block_docs": 7, "owners": 2}, {"k": 400, "batch_terms": 20, "bundle": 1}], ids=["default", "small", "one", "batches"]
)
def test_search_equals_brute_force(spark, corpus, how):
    docs, items = corpus
    assert found(spark, docs, items, **how) == brute(docs, items, how.get("k", 10))


def test_no_documents_and_no_queries(spark, corpus):
    docs, items = corpus
    assert found(spark, [], items) == [] and found(spark, docs, []) == [] and found(spark, [(1, None)], items) == []
    assert found(spark, docs, [(1, "?!")]) == []


def test_accumulators_are_dropped_only_when_they_cannot_win():
    import numpy as np
    import pandas as pd

    m_lengths = np.full(4, 10, "<u4").tobytes()
    empty = pd.DataFrame([(1, 0, 0, m_lengths, bytes(4), b"", b"", bytes(1))], columns=["block", "owner", "bundle", "lengths", "sizes", "places", "scores", "closed"])
    post = pd.DataFrame([(0, np.array([0, 1, 2], "<u2").tobytes(), np.array([1, 5, 9], "<u4").tobytes())], columns=["term", "places", "counts"])
    for rest, left in ((10**9, [0, 1, 2]), (0, [2])):
        visit = ranked_search._visit([[np.array([0, 1])]], np.array([1000, 10]), [np.array([rest])], 4, 40, 1, 0)
        out = visit((1, 0, 0), empty, post).iloc[0]
        assert np.frombuffer(out.places, "<u2").tolist() == left and bool(out.closed[0]) == (rest == 0) and out.owner == 1


def test_rare_terms_come_first_and_owners_share():
    import numpy as np

    owners = ranked_search.owners_of(np.array([900, 1, 100, 1, 500, 0]), 3)
    assert owners[0] == 2 and owners[1] == owners[3] == owners[5] == 0 and owners.max() == 2
