"""Ranked search of all documents for a table of queries, by pipelined term partitioning.

1. Documents are read once, in blocks of at most ``block_docs``. Of each block the postings of the
   queries' terms are kept (term, place in the block, occurrences), split by the owner of the
   term, and the lengths of its documents. Owners hold ranges of the terms, rare ones first.
2. Totals over all blocks (documents, terms, document frequencies) give every term its weight.
3. A bundle of queries starts in each block with empty accumulators and visits the owners one
   after the other: a stage cogroups the bundles with the postings that the owner holds of the block,
   adds the integer contributions of its terms and hands the bundles on to the next owner.
   Accumulators are sparse: places and scores of the documents that a query can still return.
4. After the last owner each bundle names its best documents of the block, of which the best of
   all blocks are chosen.

An accumulator is dropped only when it provably cannot be among a query's ``k`` best: the
terms still to come add at most a known sum, and ``k`` documents of the same block are already
further ahead. As the rare terms come first, the long postings of the frequent ones then meet few
documents. A term that all documents hold is split over the blocks, so no task holds a whole list.

Bounds: the queries are the stated set; they are taken in batches of at most ``batch_terms`` different
terms (each batch reads the documents once), which bounds what the driver and each worker hold.
A stage's task holds one block of one bundle of at most ``bundle`` queries.

Cases: null and wordless documents count for nothing and are never returned; null and wordless
queries return nothing; rows of one item_id are one query with the terms of all of them;
repeated rows of a doc_id are documents of their own, at equal scores in any order; a null
doc_id comes after the others of its score; an empty table gives an empty result; columns other than
the ids and texts are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brinedeck.llm.common import settle, ship

ship(__name__)

#: Runs of ASCII letters and digits and of all other characters: in UTF-8, runs of these bytes.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: A term's share of a score: weight * (SCALE * tf div (1000 * tf + 8 * m)).
SCALE = 1_000_000_000


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order, A-Z as a-z."""
    return TERM.findall((text or "").encode().lower())


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def normal(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of documents of these lengths."""
    return 100 - 90 + (90 * lengths.astype(np.int64) * n_docs) // max(n_terms, 1)


def owners_of(frequency: np.ndarray, owners: int) -> np.ndarray:
    """The owner of each term: rare terms first, about the same number of postings each."""
    order = np.lexsort((np.arange(len(frequency)), frequency))
    share = np.cumsum(frequency[order]) / max(int(frequency.sum()), 1)
    out = np.zeros(len(frequency), np.int32)
    out[order] = np.minimum((share * owners * (1 - 1e-12)).astype(np.int32), owners - 1)
    return out


_BLOCK = "block long, term int, n long, total long, most long, ids binary, missing binary, places binary, counts binary"


def _blocks(vocabulary: dict[bytes, int], block_docs: int):
    """Documents to blocks: a row (term -1) with their ids and lengths, and a row for each term of the vocabulary that occurs.

    n, total and most are the number, sum and maximum of the lengths or occurrences in ``counts``.
    """

    def row(block: int, term: int, ids: np.ndarray, missing: np.ndarray, places: list[int], counts: list[int]) -> tuple:
        return (
            block, term, len(counts), sum(counts), max(counts), ids.astype("<i8").tobytes(), missing.astype(np.uint8).tobytes(),
            np.array(places, "<u2").tobytes(), np.array(counts, "<u4").tobytes(),
        )

    def rows(block: int, ids: list, lengths: list[int], found: dict[int, tuple[list[int], list[int]]]) -> pd.DataFrame:
        missing, none = np.array([pd.isna(i) for i in ids]), np.zeros(0)
        known = np.array([0 if gone else int(i) for i, gone in zip(ids, missing, strict=True)], np.int64)
        out = [row(block, -1, known, missing, [], lengths)]
        out += [row(block, term, none, none, places, counts) for term, (places, counts) in found.items()]
        return pd.DataFrame(out, columns=["block", "term", "n", "total", "most", "ids", "missing", "places", "counts"])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        ids, lengths, found = [], [], {}
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                all_terms = terms(text)
                if not all_terms:
                    continue
                for term, count in Counter(all_terms).items():
                    at = vocabulary.get(term)
                    if at is not None:
                        places, counts = found.setdefault(at, ([], []))
                        places.append(len(ids))
                        counts.append(count)
                ids.append(doc_id)
                lengths.append(len(all_terms))
                if len(ids) == block_docs:
                    yield rows(number, ids, lengths, found)
                    number, ids, lengths, found = number + 1, [], [], {}
        if ids:
            yield rows(number, ids, lengths, found)

    return read


def _pack(places: list[np.ndarray], scores: list[np.ndarray], closed: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    sizes = np.array([len(p) for p in places], "<u4")
    joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (places, scores)]
    return sizes.tobytes(), joined[0].astype("<u2").tobytes(), joined[1].astype("<i8").tobytes(), closed.astype(np.uint8).tobytes()


def _unpack(row) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    cuts = np.cumsum(np.frombuffer(row.sizes, "<u4").astype(np.int64))[:-1]
    places = np.split(np.frombuffer(row.places, "<u2").astype(np.int64), cuts)
    return places, np.split(np.frombuffer(row.scores, "<i8"), cuts), np.frombuffer(row.closed, np.uint8).astype(bool)


def _visit(queries: list[list[np.ndarray]], weights: np.ndarray, rest: list[np.ndarray], n_docs: int, n_terms: int, k: int, owner: int):
    """One stage: bundles of a block meet the owner's postings of it.

    ``queries[bundle][query]`` are the terms of a query; ``rest[bundle]`` the most that owners after this one can add.
    """

    def stage(key, bundles: pd.DataFrame, postings: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(bundles):
            row = bundles.iloc[0]
            bundle = int(row.bundle)
            m = normal(np.frombuffer(row.lengths, "<u4"), n_docs, n_terms)
            held = {int(p.term): (np.frombuffer(p.places, "<u2").astype(np.int64), np.frombuffer(p.counts, "<u4").astype(np.int64)) for p in postings.itertuples()}
            places, scores, closed = _unpack(row)
            dense = np.zeros(len(m), np.int64)
            for q, wanted in enumerate(queries[bundle]):
                mine = [t for t in wanted if int(t) in held]
                if mine:
                    dense[:] = 0
                    dense[places[q]] = scores[q]
                    for t in mine:
                        at, tf = held[int(t)]
                        dense[at] += weights[t] * ((SCALE * tf) // (1000 * tf + 8 * m[at]))
                    places[q] = places[q] if closed[q] else np.flatnonzero(dense)
                    scores[q] = dense[places[q]]
                if len(scores[q]) > k:  # a document behind k others by more than what is to come is out
                    bar = np.partition(scores[q], len(scores[q]) - k)[len(scores[q]) - k]
                    stay = scores[q] + rest[bundle][q] >= bar
                    places[q], scores[q] = places[q][stay], scores[q][stay]
                    closed[q] |= rest[bundle][q] < bar
            out.append((int(row.block), owner + 1, bundle, row.lengths, *_pack(places, scores, closed)))
        return pd.DataFrame(out, columns=["block", "owner", "bundle", "lengths", "sizes", "places", "scores", "closed"])

    return stage


_BUNDLE = "block long, owner int, bundle int, lengths binary, sizes binary, places binary, scores binary, closed binary"


def _best(first: int, k: int):
    """The best ``k`` of every query in a bundle that has been to all owners; ``first`` queries are in a bundle before the next."""

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = {"query": [], "doc_id": [], "gone": [], "score": []}
            for row in batch.itertuples():
                ids, missing = np.frombuffer(row.ids, "<i8"), np.frombuffer(row.missing, np.uint8)
                places, scores, _ = _unpack(row)
                for q, (at, score) in enumerate(zip(places, scores, strict=True)):
                    at, score = at[score > 0], score[score > 0]
                    best = np.lexsort((ids[at], missing[at], -score))[:k]
                    for c, v in zip(found, (np.full(len(best), int(row.bundle) * first + q), ids[at[best]], missing[at[best]], score[best]), strict=True):
                        found[c].append(v)
            out = pd.DataFrame({c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in found.items()})
            out["doc_id"] = out["doc_id"].astype("Int64").mask(out["gone"] > 0)
            yield out.drop(columns="gone")

    return pick


def _search(docs: DataFrame, wanted: list[set[bytes]], k: int, block_docs: int, owners: int, bundle: int) -> DataFrame:
    """query (its place in ``wanted``), doc_id and score: the best ``k`` of each block for each query of one batch."""
    spark = docs.sparkSession
    vocabulary = {t: n for n, t in enumerate(sorted(set().union(*wanted)))}
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    stored = settle(slim.mapInPandas(_blocks(vocabulary, block_docs), _BLOCK))
    facts = stored.groupBy("term").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("most").alias("most")).collect()  # a row for each term of the batch
    known = {r["term"]: r for r in facts}
    n_docs, n_terms = (known[-1]["n"], known[-1]["total"]) if -1 in known else (0, 0)
    df = np.array([known[t]["n"] if t in known else 0 for t in range(len(vocabulary))], np.int64)
    tf = np.array([known[t]["most"] if t in known else 0 for t in range(len(vocabulary))], np.int64)
    weights = np.array([weight(n_docs, int(d)) for d in df], np.int64)
    most = weights * ((SCALE * tf) // (1000 * tf + 8 * 10))  # m is 10 at least
    owner_of = owners_of(df, owners)
    numbers = [np.array(sorted(vocabulary[t] for t in ts), np.int64) for ts in wanted]
    bundles = [numbers[a : a + bundle] for a in range(0, len(numbers), bundle)]
    every = F.explode(F.sequence(F.lit(0), F.lit(len(bundles) - 1))).alias("bundle")

    table = spark.createDataFrame([(t, int(o)) for t, o in enumerate(owner_of)], "term int, owner int")
    postings = stored.filter("term >= 0").join(F.broadcast(table), "term")
    blocks = stored.filter("term < 0").toDF(*stored.columns)  # columns of its own, for the joins with the postings
    sizes, closed = (F.array(*[F.lit(bytes(width * len(group))) for group in bundles]) for width in (4, 1))
    state = blocks.select("block", F.lit(0).alias("owner"), every, F.col("counts").alias("lengths")).withColumns(
        {"sizes": F.get(sizes, F.col("bundle")), "places": F.lit(b""), "scores": F.lit(b""), "closed": F.get(closed, F.col("bundle"))}
    )
    keys = ["block", "bundle", "owner"]
    for owner in range(owners):
        rest = [np.array([int(most[ts[owner_of[ts] > owner]].sum()) for ts in group], np.int64) for group in bundles]
        here = postings.filter(F.col("owner") == owner).select("block", "owner", every, "term", "places", "counts")
        visit = _visit(bundles, weights, rest, n_docs, n_terms, k, owner)
        state = state.groupBy(*keys).cogroup(here.groupBy(*keys)).applyInPandas(visit, _BUNDLE)
    named = state.select("block", "bundle", "sizes", "places", "scores", "closed").join(blocks.select("block", "ids", "missing").toDF("block", "ids", "missing"), "block")
    return named.mapInPandas(_best(bundle, k), "query int, doc_id long, score long")


def ranked_search(
    docs: DataFrame, queries: DataFrame, k: int = 10, block_docs: int = 8192, owners: int = 4, bundle: int = 256, batch_terms: int = 200_000,
) -> DataFrame:
    """item_id, rank, doc_id and score: the ``k`` documents with the highest scores above 0 for each query."""
    if not 0 < block_docs <= 1 << 16:
        raise ValueError("a block has at most 65536 documents")
    spark = docs.sparkSession
    found = None
    for names, wanted in _batches(queries, batch_terms):
        titles = spark.createDataFrame(list(enumerate(names)), f"query int, item_id {queries.schema['item_id'].dataType.simpleString()}")
        part = _search(docs, wanted, k, block_docs, owners, bundle).join(F.broadcast(titles), "query").drop("query")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = queries.limit(0).select("item_id", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("score"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _batches(queries: DataFrame, batch_terms: int) -> Iterator[tuple[list, list[set[bytes]]]]:
    """Ids and terms of the queries, batch by batch; only one batch is held."""
    grouped = queries.groupBy("item_id").agg(F.concat_ws(" ", F.collect_list(F.col("text").cast("string"))).alias("text"))
    names, wanted, held = [], [], 0
    for row in grouped.toLocalIterator():
        own = set(terms(row["text"]))
        if not own:
            continue
        if wanted and held + len(own) > batch_terms:
            yield names, wanted
            names, wanted, held = [], [], 0
        names.append(row["item_id"])
        wanted.append(own)
        held += len(own)
    if wanted:
        yield names, wanted
