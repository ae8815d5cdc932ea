"""Classifier, language model, pipeline and the registered queries."""

import collections
import math
import random
import time
import tracemalloc
import uuid
import zlib

import numpy as np
import oracle
import pytest

import corpus_pipeline
from retailtide.llm import components, packing, pitman_yor, quality_classifier, queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SMALL)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(name, spark, con):
    oracle.compare(queries.QUERIES[name], queries.ORACLE[name], spark, con, SMALL)


def good(rng):
    return " ".join("".join(rng.choices("aeioulnrst", k=rng.randrange(2, 9))) for _ in range(rng.randrange(20, 80))).capitalize()


def labelled(spark, n=400, seed=2):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        text, bad = good(rng), i % 4 == 0
        if bad:
            text = rng.choice([text.upper() + "!!", text.replace(" ", " ## "), " ".join([text.split()[0]] * 40)])
        docs.append((i, text))
        labels.append((i, int(not bad), 0))
    labels += [(3, None, None), (None, 1, 0), (10**6, 1, 0)]
    return (
        spark.createDataFrame(docs + [(n, None), (n + 1, ""), (None, "no id"), (0, docs[0][1])], "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        docs,
    )


def test_classifier_on_documents_it_has_not_seen(spark):
    docs, labels, texts = labelled(spark)
    model = quality_classifier.train(spark, docs.selectExpr("*", "1 AS score", "'x' AS quality_name"), labels)
    rows = quality_classifier.score(docs.selectExpr("*", "1 AS score"), model).collect()
    assert len(rows) == len(texts) + 4 and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.doc_id is not None and r.doc_id < len(texts) and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = [(r.score >= 0.3) == (r.doc_id % 4 != 0) for r in held]
    assert len(held) > 50 and np.mean(right) > 0.95
    empty = {r.score for r in rows if r.doc_id in (len(texts), len(texts) + 1)}
    assert len(empty) == 1
    kept = quality_classifier.filter_documents(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.score >= 0.3 for r in rows)


def test_classifier_without_labels_or_with_one_class(spark):
    docs, labels, texts = labelled(spark, 30)
    none = quality_classifier.train(spark, docs, labels.limit(0))
    assert {round(r.score, 6) for r in quality_classifier.score(docs, none).collect()} == {0.5}
    ones = quality_classifier.train(spark, docs, labels.filter("quality = 1"))
    scores = {r.score for r in quality_classifier.score(docs, ones).collect()}
    assert len(scores) == 1 and 0.5 < scores.pop() < 1
    assert quality_classifier.score(docs.limit(0), none).count() == 0


def test_the_fit_keeps_its_sample():
    """A smaller one needs figures of its quality on held-out rows."""
    assert quality_classifier.FIT_ROWS >= 10_000


def test_the_fit_holds_no_second_copy_of_its_sample():
    rng = np.random.default_rng(4)
    grams = [np.sort(rng.choice(quality_classifier.BUCKETS, 1000, replace=False)).astype(np.int32) for _ in range(2000)]
    labels = rng.integers(0, 2, len(grams))
    counts = rng.integers(1, 500, (2, quality_classifier.BUCKETS + 1))
    tracemalloc.start()
    quality_classifier.fit(counts, grams, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < sum(g.nbytes for g in grams)


def test_dual_descent_finds_the_separating_line():
    rng = np.random.default_rng(0)
    rows, values, signs = [], [], []
    for i in range(200):
        sign = 1 if i % 2 else -1
        rows.append(np.array([0, 1, 2 + rng.integers(50)]))
        x = np.array([sign * 0.5, 0.5, 0.7])
        values.append(x / np.linalg.norm(x))
        signs.append(sign)
    weights = quality_classifier.descend(rows, values, np.array(signs, float), np.ones(200))
    assert all(s * (weights[r] @ v) > 0 for r, v, s in zip(rows, values, signs))


def lm_docs(spark):
    rng = random.Random(8)
    texts = []
    for i in range(240):
        words = rng.choices(["alpha", "beta", "gamma", "delta"] if i % 2 else ["uno", "dos", "tres"], k=rng.randrange(1, 60))
        texts.append(" ".join(words + [f"rare{rng.randrange(500)}"]))
    texts += [None, "", " \n", "Alpha ALPHA alpha", "never-seen-word", "x" * 50_000, "beta " * 5000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1, texts[1]), (None, "alpha beta")]
    return texts, spark.createDataFrame(rows, "doc_id long, text string")


def test_language_model_counts_and_base(spark):
    texts, docs = lm_docs(spark)
    rows = pitman_yor.score(spark, docs.selectExpr("*", "1 AS score", "2 AS block", "3 AS held").repartition(3)).collect()
    assert len(rows) == len(texts) + 2
    tokens = lambda t: (t or "").encode().lower().split() + [b"\n"]
    fold = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    counts = collections.Counter()
    for i, t in [*enumerate(texts), (1, texts[1])]:
        if not fold(i):
            counts.update(tokens(t))
    total, types = sum(counts.values()), len(counts)
    better = []
    for r in rows:
        own = tokens("alpha beta" if r.doc_id is None else texts[r.doc_id])
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (types + 1))) for w in own)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), total)
        assert r.held_out == (r.doc_id is None or fold(r.doc_id))
        assert r.base_score == pytest.approx(base, abs=1e-6) and r.score < 0
        if r.held_out and len(own) > 5:
            better.append(r.score > r.base_score)
    assert np.mean(better) > 0.8
    table = {r.held_out: r for r in pitman_yor.perplexity(spark.createDataFrame(rows)).collect()}
    assert table[True].perplexity < table[True].base_perplexity


def test_whole_words_before_are_the_context(spark, monkeypatch):
    """Words of the same ending, and the same word after two others, are followed by words of their own."""
    rng = random.Random(4)
    after = {"bathe": "red", "soothe": "blue", "one mid": "left", "two mid": "right"}
    texts = [" ".join(f"{k} {after[k]}" for k in rng.choices(list(after), k=30)) for _ in range(300)]
    docs = spark.createDataFrame([*enumerate(texts), (None, "bathe red two mid right"), (None, "bathe blue two mid left")], "doc_id long, text string")
    for hot in (pitman_yor.HOT_TOKENS, 500):
        monkeypatch.setattr(pitman_yor, "HOT_TOKENS", hot)
        monkeypatch.setattr(pitman_yor, "SHARD_TOKENS", 4 * hot)
        rows = pitman_yor.score(spark, docs.repartition(3)).collect()
        assert len(rows) == len(texts) + 2
        right, wrong = sorted((r.score for r in rows if r.doc_id is None), reverse=True)
        assert right > wrong + 3
        held = [r for r in rows if r.held_out and r.doc_id is not None]
        # a text draws one of four pairs 30 times, and all else follows from it
        pairs = 10 ** (-sum(r.score for r in held) / (30 * len(held)))
        assert 3.5 < pairs < 5


def test_shards_come_from_the_tokens(spark, monkeypatch):
    """And not from the shuffle partitions; hot words are shared out, to several parents each."""
    monkeypatch.setattr(pitman_yor, "SHARD_TOKENS", 1000)
    monkeypatch.setattr(pitman_yor, "HOT_TOKENS", 400)
    for texts in (10, 100):
        docs = spark.createDataFrame([("the word " * 49 + "end",)] * texts, "text string")
        shards, hot = pitman_yor._dealt(docs)
        assert shards == texts * 100 // 1000
        assert hot.parents.tolist() == [-(-49 * texts // 400)] * 2


def test_language_model_writes_few_bytes_a_token(spark, monkeypatch, tmp_path):
    """Words go as short codes, whatever the number of shards."""
    rng = np.random.default_rng(5)
    drawn = (rng.pareto(0.8, (400, 500)) * 20).astype(np.int64) % 60000
    docs = spark.createDataFrame([(i, " ".join(f"word{w}" for w in t)) for i, t in enumerate(drawn.tolist())], "doc_id long, text string")
    monkeypatch.setattr(pitman_yor, "SHARD_TOKENS", 10000)
    for module in (components, pitman_yor):
        monkeypatch.setattr(module, "shared_folder", lambda spark, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}", raising=False)
    scored = pitman_yor.score(spark, docs.repartition(2))
    written = sum(f.stat().st_size for f in tmp_path.rglob("*") if f.is_file())
    assert scored.count() == 400
    assert 0 < written / drawn.size < 15


def test_numbers_are_told_apart_as_by_numpy_in_less_time():
    rng = np.random.default_rng(9)
    for top, size in ((1, 1), (50, 1000), (2**40, 500_000), (2**62, 1000), (10, 0)):
        values = rng.integers(0, top, size)
        for got, want in zip(pitman_yor._distinct(values), np.unique(values, return_inverse=True)):
            assert np.array_equal(got, want)
    values = rng.integers(0, 2**18, 500_000) * 2**20

    def least(f):
        taken = []
        for _ in range(5):
            began = time.process_time()
            f(values)
            taken.append(time.process_time() - began)
        return min(taken)

    assert least(pitman_yor._distinct) < least(lambda v: np.unique(v, return_inverse=True))


def test_predictive_probabilities_sum_to_one():
    """Over the known words and one for all others, after sweeps, in every restaurant."""
    rng = np.random.default_rng(3)
    words = np.sort(rng.integers(1, 2**62, 40).astype(np.uint64))
    entries = sorted({(int(w), int(c)) for w, c in zip(rng.integers(0, 40, 300), rng.integers(0, 9, 300) * 257)} | {(w, 257) for w in range(40)})
    word, context = (np.array(x) for x in zip(*entries))
    shard = pitman_yor.Shard(words, word, context, rng.integers(1, 200, len(word)))

    def totals(types):
        sums = shard.counted()
        arrays = {}
        for level, size in ((2, 65536), (1, 256), (0, 1)):
            part = sums[sums["level"] == level]
            for name in ("customers", "tables"):
                arrays[level, name] = np.zeros(size)
                arrays[level, name][part["context"]] = part[name]
        return pitman_yor.Totals(
            arrays[2, "customers"], arrays[2, "tables"], arrays[1, "customers"], arrays[1, "tables"],
            float(arrays[0, "customers"][0]), float(arrays[0, "tables"][0]), (0.7, 0.6, 0.5), types,
        )

    for _ in range(3):
        shard.sweep(totals(40), np.random.Generator(np.random.PCG64(1)))
        assert (shard.seats >= 1).all() and (shard.seats <= shard.count).all()
        now = totals(40)
        root, _ = shard.probabilities(now)
        other = (1.0 + 0.5 * now.root_tables) / 41 / (1.0 + now.root)
        assert root.sum() + other == pytest.approx(1)
        for c in set(context.tolist()):
            up = c & 0xFF
            own_parent = np.zeros(41)
            at = shard.parent_context == up
            own_parent[shard.parent_word[at]] = (shard.parent_customers() - 0.6 * shard.parent_seats)[at]
            p = (own_parent + (1.0 + 0.6 * now.parent_tables[up]) * np.append(root, other)) / (1.0 + now.parent[up])
            own = np.zeros(41)
            at = shard.context == c
            own[shard.word[at]] = (shard.count - 0.7 * shard.seats)[at]
            p = (own + (1.0 + 0.7 * now.leaf_tables[c]) * p) / (1.0 + now.leaf[c])
            assert p.sum() == pytest.approx(1) and (p > 0).all()


def test_seating_has_the_mean_of_a_chinese_restaurant():
    random_ = np.random.Generator(np.random.PCG64(2))
    customers, mass, discount = 200, 3.0, 0.4
    # with a chance of 1 the word is alone and each table adds the discount to the mass
    tables = pitman_yor.seated(np.full(4000, customers), np.full(4000, mass + discount), discount, np.ones(4000), random_)
    expected = 1.0
    for n in range(1, customers):
        expected += (mass + discount * expected) / (mass + n)
    assert tables.mean() == pytest.approx(expected, rel=0.03)


def test_language_model_without_training_or_documents(spark):
    held = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    rows = pitman_yor.score(spark, spark.createDataFrame([(held, "a b")], "doc_id long, text string")).collect()
    assert (rows[0].n_known, rows[0].train_tokens, rows[0].n_tokens) == (0, 0, 3)
    assert pitman_yor.score(spark, spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, [docs.count()]
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, SMALL)
        rows = frame.collect()
        assert frame.columns == columns
        frame = spark.createDataFrame(rows, docs.schema)
        kept.append(len(rows))
    assert kept == sorted(kept, reverse=True) and 0 < kept[-1] < kept[0]
    packed = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in rows}
    assert max(r.offset + r.length for r in packed) <= packing.CAPACITY


def test_pipeline_handles_rows_of_every_kind(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", "en", "s", 0), (-2, "w " * 50_000, "en", "s", 0)], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        for frame in (odd, docs.limit(0)):
            stage(spark, frame, SMALL).collect()


