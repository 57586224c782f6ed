"""Each operator against brute force on small tables, and its stated edge cases."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brinedeck.llm import backoff, binary_ids, mixing, neighbours, packing, quality_model, quality_rules, sharding, simhash, token_ids, toxicity
from brinedeck.llm.common import in_order, running_total

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, size int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [
    None, "", " \t\n", "one", "Two words", "it's they're I'll 'store !'s o'clock'd", "ÀÖØ×÷ßÿ é ÑÑ", "İstanbul ΣΑΣ ça̧", "12345 a1b2 <|endoftext|> x", "中文 字 mixed TEXT",
    "a" * 9000, "the same line here\nthe same line here\n\nother", "word " * 7000, "It'S a\x0btab\x0cfeed\x1ctest", "same text of the copies", "same text of the copies", "same text of the copies",
]


def table(spark, texts, sources=None, ids=None):
    """Documents with two extra columns whose names the operators also use."""
    rows = [
        (k if ids is None else ids[k], t, ("en", "de", None)[k % 3], sources[k] if sources else f"s{k % 3}", None if t is None else len(t), "clash", 1)
        for k, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    pool = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    made = [" ".join(rng.choice(pool) for _ in range(rng.choice([3, 30, 200, 900, 2500]))) for _ in range(120)]
    return ODD + made


@pytest.fixture(scope="module")
def docs(spark, texts):
    return table(spark, texts)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_token_ids_equal_the_library(texts):
    library = Tokenizer.from_file(TOKENIZER)
    own = token_ids.WordTokenizer(token_ids.read_tokenizer(TOKENIZER))
    assert own.cuts
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_token_ids_survive_forgetting(texts, monkeypatch):
    monkeypatch.setattr(token_ids, "REMEMBERED", 5)
    own = token_ids.WordTokenizer(token_ids.read_tokenizer(TOKENIZER))
    first, second = list(own.encode(texts)), list(own.encode(texts))
    assert all((a == b).all() for a, b in zip(first, second, strict=True))


def expected_ids(text):
    return np.array([*Tokenizer.from_file(TOKENIZER).encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def test_packing_keeps_every_piece(spark, docs, texts):
    out = packing.pack(docs, TOKENIZER, capacity=512).toPandas()
    for k, text in enumerate(texts):
        ids = expected_ids(text)
        mine = out[out.doc_id == k].sort_values("piece")
        assert mine.start.tolist() == list(range(0, len(ids), 512)) and mine.length.sum() == len(ids)
        assert mine.ids_crc32.tolist() == [zlib.crc32(ids[a : a + 512].tobytes()) for a in range(0, len(ids), 512)]
    for _, group in out.sort_values("offset").groupby("sequence_id"):
        assert group.offset.tolist() == [0, *group.length.cumsum().tolist()[:-1]] and group.length.sum() <= 512
    assert out.sequence_id.nunique() <= 1.03 * out.length.sum() / 512 + 2


def test_packing_of_repeated_and_no_rows(spark, docs, empty):
    assert packing.pack(empty, TOKENIZER).count() == 0
    twice = packing.pack(docs.union(docs), TOKENIZER, capacity=256).toPandas()
    once = packing.pack(docs, TOKENIZER, capacity=256).toPandas()
    assert len(twice) == 2 * len(once) and twice.groupby("sequence_id").length.sum().max() <= 256
    assert not twice.duplicated(["sequence_id", "offset"]).any()


def test_configurations_are_near_the_bound():
    rng = np.random.default_rng(1)
    sizes = np.unique(rng.integers(130, 1000, 20))[::-1]
    counts = rng.integers(1, 3000, len(sizes))
    plan = packing.configurations(sizes, counts, 1000)
    served = sum(p * n for p, n in plan)
    assert (served >= counts).all() and all((p * sizes).sum() <= 1000 for p, _ in plan)
    one_each = sum(-(-c // (1000 // s)) for s, c in zip(sizes, counts, strict=True))
    assert (sizes * counts).sum() / 1000 <= sum(n for _, n in plan) <= one_each


def test_elias_fano_round_trip():
    rng = np.random.default_rng(2)
    for values in ([], [0], [5], [0, 0, 0], [7] * 700, np.cumsum(rng.integers(0, 9, 3000)), np.sort(rng.integers(0, 1 << 50, 999)), [0, (1 << 63) + 11]):
        values = np.asarray(values, np.uint64)
        code = binary_ids.EliasFano.of(values)
        back = binary_ids.EliasFano.read(code.n, code.low_bits, *code.sections())
        assert (back.values() == values).all()
        for i in range(0, len(values), max(1, len(values) // 50)):
            assert back.select(i) == values[i]
        if len(values) > 600:
            assert (back.values(255, 600) == values[255:600]).all()


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(0).integers(1, 2000, 50_000))
    assert sum(map(len, binary_ids.EliasFano.of(ends).sections())) * 8 < 14 * len(ends)


def test_id_files_round_trip(spark, texts, empty, tmp_path):
    ids = [None if k % 40 == 7 else (k * 37) % 1000 - 300 for k in range(len(texts))]
    files, read = binary_ids.token_id_files(table(spark, texts, ids=ids), TOKENIZER, str(tmp_path / "a"))
    got = sorted(read.collect(), key=lambda r: r["start"])
    assert sum(r["n_docs"] for r in files.collect()) == len(texts)
    known = [r["doc_id"] for r in got]
    assert known == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [r["start"] for r in got] == np.concatenate(([0], np.cumsum([r["n_tokens"] for r in got])[:-1])).tolist()
    want = Counter((i, len(expected_ids(t)), zlib.crc32(expected_ids(t).tobytes())) for i, t in zip(ids, texts, strict=True))
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    one = next(r for r in files.collect() if r["n_docs"])
    source = binary_ids.IdFile(one["file"])
    assert sum(len(source.document(k)) for k in range(one["n_docs"])) == one["n_ids"]
    assert binary_ids.token_id_files(empty, TOKENIZER, str(tmp_path / "b"))[1].count() == 0


def test_long_documents_are_read_in_windows(spark, docs, tmp_path, monkeypatch):
    _, whole = binary_ids.token_id_files(docs, TOKENIZER, str(tmp_path / "a"))
    want = sorted(whole.collect())
    monkeypatch.setattr(binary_ids, "WINDOW", 50)
    _, cut = binary_ids.token_id_files(docs, TOKENIZER, str(tmp_path / "b"))
    assert sorted(cut.collect()) == want


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    data = [(i, rng.normal(size=16).tolist()) for i in range(300)]
    data += [(1000 + i, data[5][1]) for i in range(40)]  # ties
    data += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] * 16), (2004, [float("inf")] + [1.0] * 15), (2005, [None] + [1.0] * 15), (2006, [1.0] * 3), (None, [1.0] * 16)]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).withColumn("id", F.lit(2))
    ask = (F.col("vec_id") % 20 == 0) | (F.col("vec_id") == 2006)
    good = [(i, np.array(v)) for i, v in data if i is not None and i < 2000]
    for block in (1 << 20, 400):
        got = neighbours.nearest(vectors, ask, 10, block_numbers=block).toPandas()
        assert set(got.query_id) == {i for i, _ in good if i % 20 == 0}
        for q, group in got.groupby("query_id"):
            me = dict(good)[q]
            want = sorted((float(np.sqrt(np.cumsum((v - me) ** 2)[-1])), i) for i, v in good if i != q)[:10]
            group = group.sort_values("rank")
            assert list(zip(group.score, group.vec_id, strict=True)) == want
    assert neighbours.nearest(vectors.limit(0), ask, 10).count() == 0
    few = neighbours.nearest(vectors.filter("vec_id < 4"), F.col("vec_id") == 0, 10)
    assert few.count() == 3


def test_int8_bounds_hold():
    rng = np.random.default_rng(6)
    a, b = rng.normal(size=(40, 1500)), rng.normal(size=(50, 1500))
    x, y = neighbours.Rounded(a), neighbours.Rounded(b)
    product = x.product(y, slice(0, 40), slice(0, 50))
    assert (product == x.int8.astype(int) @ y.int8.astype(int).T).all()
    near = np.sqrt(np.maximum(x.square[:, None] + y.square[None] - 2 * x.scale * y.scale * product, 0))
    true = np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2))
    assert (np.abs(near - true) <= x.lost[:, None] + y.lost[None] + 1e-9).all()


def water_fill(sizes, weights, epochs):
    total, open_, target = sum(sizes.values()), set(sizes), {}
    while open_:
        rest = total - sum(target.values())
        share = {s: rest * weights[s] / sum(weights[t] for t in open_) for s in open_}
        over = {s for s in open_ if share[s] >= epochs * sizes[s]}
        if not over:
            return target | share
        target |= {s: epochs * sizes[s] for s in over}
        open_ -= over
    return target


def test_mixing_meets_its_targets(spark, texts):
    sources = [("big" if k % 2 else ("tiny", "x", "é", None)[k % 8 // 2]) for k in range(len(texts))]
    docs = table(spark, texts, sources)
    out = mixing.mix(docs).toPandas().set_index("doc_id")
    size = {k: len(WORD.findall(t or "")) for k, t in enumerate(texts)}
    assert out["size"].to_dict() == size
    by_source = Counter()
    for k, s in enumerate(sources):
        by_source[s] += size[k]
    order = sorted(by_source, key=lambda s: (s is None, (s or "").encode()))
    want = water_fill(dict(by_source), {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 3)
    for k, s in enumerate(sources):
        assert out.source_size[k] == by_source[s] and out.target[k] == pytest.approx(want[s])
    assert (out.taken <= 3 * out["size"]).all()
    for s in order:
        mine = [k for k in size if sources[k] == s]
        gap = abs(out.taken[mine].sum() - want[s])
        assert gap <= max(size[k] for k in mine) / 2 + 1
    again = mixing.mix(docs.repartition(7)).toPandas().set_index("doc_id")
    assert again.taken.to_dict() == out.taken.to_dict()
    rows = Counter(r["doc_id"] for r in mixing.repeated(docs).collect())
    assert all(rows[k] * size[k] == out.taken[k] for k in size)


def test_mixing_edge_cases(spark, empty, docs):
    assert mixing.mix(empty).count() == 0 and mixing.repeated(empty).count() == 0
    assert mixing.mix(table(spark, [None, "", " "])).toPandas().taken.sum() == 0
    doubled = mixing.mix(docs.union(docs)).toPandas()
    assert len(doubled) == 2 * docs.count() and (doubled.taken <= 3 * doubled["size"]).all()


def test_clamping_goes_on_until_feasible(spark):
    sizes = {"a": 1, "b": 5, "c": 40, "d": 1000, "e": 3, "f": 2000}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(frame, (5.0, 2.0, 1.0), 3.0).collect()}
    assert got == pytest.approx(water_fill(sizes, dict(zip(sizes, (5, 2, 1, 5, 2, 1), strict=True)), 3))


def test_sharding_law_and_groups(spark, texts, empty):
    many = [*texts, *["copy one"] * 30, *["copy two"] * 4, None]
    out = sharding.shard_documents(table(spark, many)).toPandas()
    assert len(out) == len(many)
    counts = out.groupby("shard").size()
    assert len(counts) == 8 and counts.max() - counts.min() <= 1
    for _, group in out.groupby("shard"):
        assert sorted(group.slot) == list(range(len(group)))
    for row in out.itertuples():
        raw = (many[row.doc_id] or "").encode()
        assert (row.size, row.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    where = out.set_index("doc_id").shard
    assert len({where[k] for k, t in enumerate(many) if t == "copy two"}) == 1
    big = {where[k] for k, t in enumerate(many) if t == "copy one"}
    assert len(big) <= 3  # larger than a quota
    assert set(out.law) == {"rows"} and out.grown_shard.isna().all()
    assert sharding.shard_documents(empty).count() == 0
    assert sharding.shard_documents(table(spark, ["a"])).count() == 1


def test_propagation_gathers_links(spark):
    members = spark.range(256).select(F.col("id").alias("member"), (F.col("id") % 4).cast("int").alias("shard"))
    links = members.filter("member < 64").select("member", F.floor(F.col("member") / 8).alias("link"))
    placed = sharding.propagate(members, links, 4)
    assert placed.count() == 256
    split = placed.join(links, "member").groupBy("link").agg(F.count_distinct("shard").alias("n")).filter("n > 1").count()
    assert split <= 1


def test_evening_out_cuts_few_groups(spark):
    placed = spark.range(1000).select(F.col("id"), (F.col("id") % 2).cast("int").alias("shard"), F.floor(F.col("id") / 20).alias("g"))
    lopsided = placed.withColumn("shard", F.when(F.col("g") < 40, 0).otherwise(1))
    out = sharding.even_out(lopsided, 4, ["g", "id"]).toPandas()
    assert out.groupby("shard").size().tolist() == [250] * 4
    assert all(sorted(g.slot) == list(range(250)) for _, g in out.groupby("shard"))
    assert (out.groupby("g").shard.nunique() > 1).sum() <= 4


def brute_statistics(text):
    t = text or ""
    w = WORD.findall(t)
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {k + d for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for d in range(3)}
    lines = [line for line in t.split("\n") if WORD.search(line)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_rule_statistics(spark, docs, texts, empty):
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(docs, labels_of(spark, [])).collect()}
    for k, text in enumerate(texts):
        want = brute_statistics(text)
        r = got[k]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and r["kept"] == (not r["base_failed"])
    assert quality_rules.quality_rules(empty, labels_of(spark, [])).count() == 0
    assert {r["doc_id"] for r in quality_rules.accepted(docs, labels_of(spark, [])).collect()} == {k for k, r in got.items() if r["kept"]}


def binomial_cdf(k, n, p):
    return sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))


@pytest.mark.parametrize(("n", "rate", "delta"), [(0, 0.01, 0.01), (10, 0.2, 0.05), (400, 0.01, 0.01), (900, 0.03, 0.001), (1000, 0.5, 0.02), (460, 0.01, 0.01)])
def test_allowed_errors_are_exact(spark, n, rate, delta):
    got = spark.range(1).select(quality_rules.allowed_errors(F.lit(n).cast("long"), rate, F.lit(delta))).first()[0]
    assert got == max([-1, *(k for k in range(n + 1) if binomial_cdf(k, n, rate) <= delta)])


def test_certified_rules_reject_bad_and_spare_good(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    texts, rows = [], []
    for k in range(3000):
        bad = k % 6 == 0
        texts.append(" ".join(word() + ("###" if bad else "") for _ in range(60)))
        rows.append((k, 0 if bad else 1, 0))
    docs = table(spark, texts).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en"))
    out = quality_rules.quality_rules(docs, labels_of(spark, rows), risk=0.06).toPandas()
    bad = out.doc_id % 6 == 0
    assert not out.kept[bad].any() and out.kept[~bad].mean() > 0.94


def brute_fingerprint(text, shingle=3):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(values, radius):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    listed = sorted(set(values))
    for i, a in enumerate(listed):
        for b in listed[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in values}


def test_simhash_groups(spark, texts, empty):
    out = simhash.simhash_groups(table(spark, texts)).toPandas().set_index("doc_id")
    prints = {k: brute_fingerprint(t) for k, t in enumerate(texts)}
    assert {k: int(v, 16) for k, v in out.fingerprint.items()} == prints
    root = brute_classes(prints.values(), 2)
    first = {}
    for k, v in prints.items():
        first.setdefault(root[v], k)
    assert out.component_id.to_dict() == {k: first[root[v]] for k, v in prints.items()}
    assert simhash.simhash_groups(empty).count() == 0


@pytest.mark.parametrize("limit", [8192, 7])
def test_links_connect_dense_and_chained_values(spark, limit):
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    values = {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(20)) for _ in range(150)}
    chain = rng.getrandbits(64)
    for b in range(0, 40, 2):
        values.add(chain)
        chain ^= 3 << b
    values |= {rng.getrandbits(64) for _ in range(200)} | {0, (1 << 64) - 1}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = {r["node"]: r["root"] for r in simhash.connected(simhash.links(frame, 2, shard_limit=limit)).collect()}
    root = brute_classes(values, 2)
    groups, mine = {}, {}
    for v, s in zip(values, signed, strict=True):
        groups.setdefault(root[v], set()).add(s)
        mine.setdefault(found.get(s, s), set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_bk_tree_finds_all_within():
    rng = np.random.default_rng(1)
    values = np.unique(rng.integers(0, 1 << 12, 900).astype(np.uint64))
    found = set()
    for q, t in simhash.BKTree(values).within(values, 2):
        found |= set(zip(q.tolist(), t.tolist(), strict=True))
    near = np.bitwise_count(values[:, None] ^ values[None]) <= 2
    assert found == set(zip(*np.nonzero(near), strict=True))


def test_one_document_of_each_class_stays(spark, texts, empty):
    ids = [None if k in (3, 20) else 5 if k in (4, 30) else k for k in range(len(texts))]
    docs = table(spark, texts, ids=ids)
    kept = simhash.without_near_duplicates(docs.union(docs))
    assert kept.columns == docs.columns
    root = brute_classes([brute_fingerprint(t) for t in texts], 2)
    got = [root[brute_fingerprint(r["text"])] for r in kept.collect()]
    assert len(got) == len(set(got)) == len(set(root.values()))
    assert simhash.without_near_duplicates(empty).count() == 0


def test_classes_of_a_long_path(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    out = simhash.connected(edges.union(edges.select("b", "a"))).collect()
    assert {r["node"] for r in out} == set(range(1, 301)) and {r["root"] for r in out} == {0}


def brute_backoff(texts, order, penalty):
    low = [WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    grams = lambda w: Counter(tuple(w[a : a + k]) for k in range(1, order + 1) for a in range(len(w) - k + 1))
    corpus, total, out = Counter(), sum(map(len, low)), []
    for w in low:
        corpus.update(grams(w))
    for w in low:
        own, score = grams(w), 0.0
        count = lambda g: corpus[g] - own[g] if g else max(total - len(w), 1)  # noqa: B023, E731
        for a in range(len(w)):
            most = min(order, a + 1)
            k = next((k for k in range(most, 0, -1) if count(tuple(w[a - k + 1 : a + 1])) > 0), 0)
            gram = tuple(w[a - k + 1 : a + 1])
            score += math.log10(penalty) * (most - k) + (math.log10(count(gram) / count(gram[:-1])) if k else -math.log10(count(())))
        out.append((len(w), score))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_backoff_equals_brute_force(spark, docs, texts, empty, order):
    want = brute_backoff(texts, order, 0.4)
    for sizes in ({}, {"block_bytes": 2000, "partition_keys": 50}):
        got = {r["doc_id"]: r for r in backoff.backoff_scores(docs, order=order, **sizes).collect()}
        for k, (n, score) in enumerate(want):
            assert got[k]["n_words"] == n and got[k]["log10_sum"] == pytest.approx(score, abs=1e-6)
            assert (got[k]["log10_mean"] is None) == (n == 0)
    assert backoff.backoff_scores(empty, order=order).count() == 0


def test_backoff_tallies_by_slices_and_packs_small():
    """n-grams of many slices add up to those of one, and what is sent of texts and answers is well below their size."""
    texts = [" ".join(f"w{(a * b) % 97}" for a in range(40)) for b in range(300)] + [None, "", "one"]
    whole = Counter()
    for gram, inside in backoff.grams(*backoff.word_keys(texts), 2):
        whole.update(gram[inside].tolist())
    assert len(list(backoff.slices(texts, 500))) > 20 and sum(backoff.slices(texts, 500), []) == texts
    parts = [([t], dict(zip(*(x.tolist() for x in backoff.tally([t], 2))))) for t in texts]
    merged = Counter()
    for _, part in parts:
        merged.update(part)
    known, count = backoff.tally(texts, 2)
    assert dict(zip(known.tolist(), count.tolist())) == whole == merged and (np.diff(known) > 0).all()
    rows = pa.RecordBatch.from_pydict({"block": [k % 3 for k in range(len(texts))], "doc_id": [None, *range(1, len(texts))], "text": texts})
    packs = pa.Table.from_batches(backoff.pack_blocks(iter([rows, rows])))
    assert packs["block"].to_pylist() == [0, 1, 2] and sum(map(len, packs["packed"].to_pylist())) < rows.nbytes / 2
    mine = backoff.unpacked(packs.slice(1, 1))
    assert mine["text"].to_pylist() == texts[1::3] * 2 and mine["doc_id"].to_pylist() == list(range(1, len(texts), 3)) * 2
    assert backoff.unpacked(packs.slice(0, 1))["doc_id"].to_pylist()[0] is None


def toxic_corpus(spark, n=900):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 7)))
    texts, rows = [], []
    for k in range(n):
        w = [word() for _ in range(rng.randint(5, 80))]
        bad, low = rng.random() < 0.3, rng.random() < 0.3
        if bad:
            w[rng.randrange(len(w))] = rng.choice(["zzyxw", "wryzz", "quxzz"])
        if low:
            w = [x.upper() + "!!" for x in w]
        texts.append(" ".join(w))
        rows.append((k, int(not low), int(bad)))
    return table(spark, [*texts, None, ""]), labels_of(spark, [*rows, (None, 1, 1), (5, None, None)])


def held_out_accuracy(out, truth):
    held = out[out.held_out & out.doc_id.isin(truth)]
    return (held.predicted == held.doc_id.map(truth)).mean()


def test_toxicity_on_held_out(spark, empty):
    docs, labels = toxic_corpus(spark)
    truth = {r["doc_id"]: r["toxic"] for r in labels.filter("toxic is not null and doc_id is not null").collect()}
    out = toxicity.toxicity(docs, labels).toPandas()
    assert out.score.between(0, 1).all() and out.predicted.equals((out.score >= 0.5).astype(out.predicted.dtype))
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out.doc_id]).all()
    assert held_out_accuracy(out, truth) > 0.95
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.toxicity(docs, flipped).toPandas().score.round(9).equals(out.score.round(9))
    assert toxicity.without_toxic(docs, labels).count() == (out.predicted == 0).sum()
    assert toxicity.toxicity(empty, labels).count() == 0
    flat = toxicity.toxicity(docs, labels.limit(0)).toPandas()
    assert flat.score.nunique() == 1


def test_character_grams_cross_windows(monkeypatch):
    text = "Abcde fghij é" * 40
    whole = set(np.concatenate(list(toxicity.buckets(text, (3, 5), 20))).tolist())
    monkeypatch.setattr(toxicity, "WINDOW", 17)
    assert set(np.concatenate(list(toxicity.buckets(text, (3, 5), 20))).tolist()) == whole


def test_quality_model_on_held_out(spark, empty):
    docs, labels = toxic_corpus(spark)
    truth = {r["doc_id"]: r["quality"] for r in labels.filter("quality is not null and doc_id is not null").collect()}
    out = quality_model.quality(docs, labels).toPandas()
    assert out.score.between(0, 1).all() and out.predicted.equals((out.score >= 0.3).astype(out.predicted.dtype))
    assert held_out_accuracy(out, truth) > 0.95
    assert quality_model.quality(empty, labels).count() == 0
    assert quality_model.quality(docs, labels.limit(0)).toPandas().score.nunique() == 1


def test_factorisation_identity():
    rng = np.random.default_rng(0)
    model = quality_model.FactorisationMachine(0.3, rng.normal(size=30), rng.normal(size=(30, 4)))
    index, value = np.array([1, 4, 9, 20]), rng.normal(size=4)
    pairs = sum(model.factors[index[i]] @ model.factors[index[j]] * value[i] * value[j] for i in range(4) for j in range(i + 1, 4))
    assert model.margin(index, value) == pytest.approx(0.3 + model.weight[index] @ value + pairs)


def test_order_and_running_total(spark):
    rng = random.Random(1)
    data = [(rng.choice([None, *range(9)]), k, rng.randint(0, 9)) for k in range(500)]
    placed = running_total(in_order(spark.createDataFrame(data, "a int, b int, v int").repartition(5), ["a", "b"]), "v")
    got = sorted(placed.collect(), key=lambda r: r["_row"])
    want = sorted(data, key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
    assert [(r["a"], r["b"], r["v"]) for r in got] == want and [r["_row"] for r in got] == list(range(500))
    assert [r["_before"] for r in got] == np.concatenate(([0], np.cumsum([t[2] for t in want])[:-1])).tolist()
