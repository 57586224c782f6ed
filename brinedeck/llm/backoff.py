"""Language-model scores by stupid backoff over the corpus's own n-gram counts.

    S(w | context) = count(context w) / count(context)     if the n-gram is known
                   = penalty * S(w | shorter context)      otherwise
                   = penalty / number of words             for a word that is not known at all

Counts are those of all other documents: what the document itself adds is taken off, or every
rare text would vouch for itself. A document's score is the sum of log10 S over its words.

1. Documents are dealt to blocks by a hash of their own values and travel as compressed Arrow batches; a
   block's n-grams are exploded into rows (block, gram, n), one for each distinct n-gram, whose key is a 64-bit
   hash. Rows of one n rise by key, which makes them small when they are sent.
2. The rows are partitioned by hash of the key. The count table adds up a key's rows, and an
   equi-join on the key, in the same partitioning, tells each block how often others have its
   n-grams. Rows whose n-gram no other block holds are not sent back; the rest go back as compressed Arrow batches.
3. Answers meet the block's documents, whose n-grams are scored and summed per document.

A block sends each n-gram once, however often it occurs, so a frequent n-gram has at most one row
per block. Texts are cut into words a slice at a time, so that a large block needs memory for its texts and
distinct n-grams only. Counts are exact but for n-grams whose keys are equal, which are counted together.

Cases: null and wordless texts have no words and the sum 0 (the mean is null); A-Z count as a-z;
repeated rows are documents of their own and share a block; null doc_ids are kept; texts shorter
than ``order`` words have only the n-grams that fit; an empty table gives an empty result; columns
other than doc_id and text are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinedeck.llm.common import WORD, ship, words
from brinedeck.llm.token_ids import WordTokenizer

ship(__name__)

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xD6E8FEB86659FD93)
#: Characters of the texts whose words are in memory at once (one text at least).
SLICE = 4 << 20
#: Rows that a block sends at once.
ROWS = 1 << 16
#: Bytes of a partition's rows that are sorted by block and compressed together.
PACK = 32 << 20


def word_keys(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A key for each word of all texts in a row, and where each text's words start (one more at the end)."""
    raws = [(t or "").encode().lower() for t in texts]
    joined = np.frombuffer(b"\n".join(raws) + b"\n" + b" " * 16, np.uint8)
    edges = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raws])))
    solid = (joined != 32) & ((joined < 9) | (joined > 13))
    change = np.flatnonzero(np.diff(np.concatenate(([False], solid))))
    starts, ends = change[::2], change[1::2]
    return WordTokenizer._keys(joined, starts, ends), np.searchsorted(starts, edges)


def grams(keys: np.ndarray, first: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """By order 1 to ``order``: keys of the n-grams that end at each word, and which are inside one text."""
    place = np.arange(len(keys)) - np.repeat(first[:-1], np.diff(first))
    out, last = [(keys, place >= 0)], keys
    for k in range(2, order + 1):
        mixed = keys.copy()
        mixed[1:] = (last[:-1] * _MIX) ^ (keys[1:] + np.uint64(k))
        mixed = (mixed ^ (mixed >> np.uint64(31))) * _MIX2
        last = mixed ^ (mixed >> np.uint64(29))
        out.append((last, place >= k - 1))
    return out


def slices(texts: list[str | None], size: int = SLICE) -> Iterator[list[str | None]]:
    """The texts in order, in lists of about ``size`` characters."""
    held, n = [], 0
    for text in texts:
        held.append(text)
        n += len(text or "")
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def tally(texts: list[str | None], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the distinct n-grams of all texts, rising, and how often they occur."""
    every = []
    for part in slices(texts):
        every.append(_added([(*np.unique(gram[inside], return_counts=True),) for gram, inside in grams(*word_keys(part), order)]))
        while len(every) > 1 and len(every[-1][0]) * 2 > len(every[-2][0]):
            every.append(_added([every.pop(), every.pop()]))
    return _added(every)


def _added(tallies: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One tally of several, whose list is emptied."""
    gram, n = (np.concatenate(x) for x in zip(*tallies, strict=True))
    tallies.clear()
    rising = np.argsort(gram, kind="stable")
    gram = gram[rising]
    n = n[rising].astype(np.int32)
    del rising
    starts = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1]))[: len(gram)])
    return gram[starts], np.add.reduceat(n, starts) if len(starts) else n


def score_texts(texts: list[str | None], known: np.ndarray, count: np.ndarray, corpus_words: int, order: int, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """Words and log10 score of each text; ``known`` has the rising keys of all n-grams of the texts, ``count`` how often the corpus has them."""
    every = [_score_slice(part, known, count, corpus_words, order, penalty) for part in slices(texts)]
    sizes, sums = (np.concatenate(x) for x in zip(*every, strict=True))
    return sizes, sums


def _score_slice(texts: list[str | None], known: np.ndarray, count: np.ndarray, corpus_words: int, order: int, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    keys, first = word_keys(texts)
    sizes = np.diff(first)
    doc = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(keys)) - first[doc]
    others = np.maximum(corpus_words - sizes, 1)[doc]
    counts = [others]
    found = grams(keys, first, order)
    for gram, inside in found:
        distinct, which = np.unique(gram[inside], return_inverse=True)
        answer = count[np.searchsorted(known, distinct)]
        _, pair, own = np.unique(doc[inside] * max(len(distinct), 1) + which, return_inverse=True, return_counts=True)
        left = np.zeros(len(keys), np.int64)
        left[inside] = answer[which] - own[pair]
        counts.append(left)
    longest = np.minimum(order, place + 1)
    score, done = np.zeros(len(keys)), np.zeros(len(keys), bool)
    for k in range(order, 0, -1):
        seen = found[k - 1][1] & ~done & (counts[k] > 0)
        at = np.flatnonzero(seen)
        context = counts[0][at] if k == 1 else counts[k - 1][at - 1]
        score[at] = np.log10(counts[k][at] / context) + (longest[at] - k) * math.log10(penalty)
        done |= seen
    rest = ~done
    score[rest] = longest[rest] * math.log10(penalty) - np.log10(others[rest])
    return sizes, np.bincount(doc, score, len(texts)).astype(float)


def pack_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, packed): what a partition holds of a block, without ``block``, as a compressed Arrow stream, ``PACK`` bytes of rows at a time."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= PACK:
            yield _packs(pa.Table.from_batches(held))
            held, size = [], 0
    if held:
        yield _packs(pa.Table.from_batches(held))


def _packs(rows: pa.Table) -> pa.RecordBatch:
    blocks = rows["block"].to_numpy()
    by = np.argsort(blocks, kind="stable")
    rows, blocks = rows.drop_columns("block").take(pa.array(by)).combine_chunks(), blocks[by]
    starts = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1]))[: len(blocks)])
    packed = []
    for start, end in zip(starts, np.append(starts[1:], len(blocks))):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_table(rows.slice(start, end - start))
        packed.append(sink.getvalue().to_pybytes())
    return pa.RecordBatch.from_arrays([pa.array(blocks[starts], pa.int64()), pa.array(packed, pa.binary())], ["block", "packed"])


def unpacked(rows: pa.Table) -> pa.Table:
    """The rows that ``pack_blocks`` packed; at least one pack is needed."""
    return pa.concat_tables(_opened(one) for one in rows["packed"])


def _opened(packed: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(packed.as_buffer()).read_all()


def backoff_scores(docs: DataFrame, order: int = 3, penalty: float = 0.4, block_bytes: int = 48 << 20, partition_keys: int = 2_000_000) -> DataFrame:
    """doc_id, n_words, log10_sum and log10_mean (null without words) of every document."""
    text = F.col("text").cast("string")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    n_bytes, n_words = slim.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.coalesce(F.sum(F.size(words(F.col("text"))).cast("long")), F.lit(0))).first()
    blocks = max(1, -(-n_bytes // block_bytes))
    parts = max(1, -(-n_words * order // partition_keys))
    # documents without words take part in no count, so any block does: they are spread, as many may be alike
    own = F.when(F.col("text").rlike(WORD), F.xxhash64("doc_id", "text")).otherwise(F.xxhash64(F.monotonically_increasing_id()))
    dealt = slim.withColumn("block", F.pmod(own, F.lit(blocks))).mapInArrow(pack_blocks, "block long, packed binary")

    def explode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(rows)
        block = rows["block"][0].as_py()
        gram, n = tally(unpacked(rows)["text"].to_pylist(), order)
        by = np.argsort(n, kind="stable")
        for start in range(0, len(by), ROWS):
            some = by[start : start + ROWS]
            yield pa.RecordBatch.from_pydict({"block": np.full(len(some), block, np.int64), "gram": gram[some].view(np.int64), "n": n[some].astype(np.int64)})

    def score(rows: pa.Table, told: pa.Table) -> pa.Table:
        ids, texts = (unpacked(rows)[c] for c in ("doc_id", "text"))
        texts = texts.to_pylist()
        known, count = tally(texts, order)
        count = count.astype(np.int64)
        for one in told["packed"]:
            answers = _opened(one)
            count[np.searchsorted(known, answers["gram"].to_numpy().view(np.uint64))] += answers["others"].to_numpy()
        sizes, sums = score_texts(texts, known, count, n_words, order, penalty)
        return pa.table({"doc_id": ids, "n_words": pa.array(sizes, pa.int64()), "log10_sum": sums})

    exploded = dealt.groupBy("block").applyInArrow(explode, "block long, gram long, n long").repartition(parts, "gram")
    # either side uses all three columns, so that both sides of the join read one and the same exchange
    counts = exploded.groupBy("gram").agg(F.sum("n").alias("total"), F.count("block").alias("blocks"))
    told = exploded.join(counts.filter("blocks > 1").hint("merge"), "gram").select("block", "gram", (F.col("total") - F.col("n")).alias("others"))
    answers = told.mapInArrow(pack_blocks, "block long, packed binary")
    scored = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, "doc_id long, n_words long, log10_sum double")
    return scored.withColumn("log10_mean", F.try_divide(F.col("log10_sum"), F.col("n_words")))
