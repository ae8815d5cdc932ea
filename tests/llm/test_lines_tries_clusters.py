"""Shared lines, the prefix trie and centroid clustering on small rows, against plain Python."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from retailtide.llm import clustering, line_dedup, prefix_trie
from retailtide.llm.shipping import ship

SPACES = " \t\n\v\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def kept_lines(rows, least=40, docs=5):
    held = collections.defaultdict(list)
    split = [(doc, (text or "").split("\n")) for doc, text in rows]
    for doc, lines in split:
        for key in {x.strip(SPACES).translate(LOWER) for x in lines}:
            if len(key) >= least:
                held[key].append(doc)
    last = {k: max((d for d in v if d is not None), default=None) for k, v in held.items() if len(v) >= docs}
    out = []
    for doc, lines in split:
        kept = [x for x in lines if (k := x.strip(SPACES).translate(LOWER)) not in last or last[k] == doc]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def line_rows():
    rng = random.Random(5)
    shared = [
        "The same licence line, long enough to count as one of them.",
        "  ÉTÉ chaud et long, été chaud et long, été chaud et long \t",
        "short line",
        "z" * 39,
        "é" * 40,
        "q" * 70_000,
        " " * 500 + "padded on both sides, and still the same old long line" + "\t" * 500,
        "",
    ]
    rows = []
    for doc in range(60):
        lines = [rng.choice(shared) for _ in range(rng.randrange(5))]
        lines += [f"a line of document {doc} alone, number {i}, not found elsewhere" for i in range(rng.randrange(3))]
        rng.shuffle(lines)
        if rng.random() < 0.4:
            lines = [x.upper() if x.isascii() else x + "\r" for x in lines]
        rows.append((doc, "\n".join(lines)))
    return rows + [(None, None), (70, ""), (None, "\n".join(shared)), (3, rows[3][1]), (59, "\n".join(shared) + "\n")]


@pytest.mark.parametrize("bits, first", [(line_dedup.FILTER_BITS, 8 * 2**30), (line_dedup.SEGMENT, 1000)])
def test_lines_are_those_of_plain_python(spark, monkeypatch, bits, first):
    monkeypatch.setattr(line_dedup, "MERGED_BYTES", first)
    rows = line_rows()
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string").withColumns(
        {n: F.lit("x") for n in ("drops", "of", "digest", "n_lines", "last")}
    )
    result = line_dedup.drop_repeated_lines(spark, docs.repartition(5), most_bits=bits)
    assert result.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert sorted((tuple(r) for r in result.collect()), key=repr) == kept_lines(rows)


def test_lines_with_lists_beyond_the_broadcast_limit(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_LIMIT", 0)
    rows = line_rows()
    result = line_dedup.drop_repeated_lines(spark, ship(spark).createDataFrame(rows, "doc_id long, text string"))
    assert sorted((tuple(r) for r in result.collect()), key=repr) == kept_lines(rows)


def test_lines_of_no_documents(spark):
    empty = ship(spark).createDataFrame([], "doc_id long, text string")
    assert line_dedup.drop_repeated_lines(spark, empty).collect() == []


def test_a_line_in_one_document_only_stays(spark):
    text = "\n".join(["one line that a single document repeats, again and again"] * 9)
    docs = ship(spark).createDataFrame([(1, text)], "doc_id long, text string")
    assert [tuple(r) for r in line_dedup.drop_repeated_lines(spark, docs).collect()] == [(1, text, 9, 0)]


def test_the_twice_filter_has_every_repeat_and_few_others():
    rng = np.random.default_rng(1)
    bits = line_dedup.SEGMENT
    keys = rng.integers(0, 2**63, 60_000).astype(np.uint64)
    repeated = set(keys[:500].tolist())
    parts = []
    for piece in np.array_split(np.concatenate([keys, keys[:500]]), 7):
        at = np.unique(line_dedup.positions(np.unique(piece), bits))
        parts.append(line_dedup._part_rows([0], [line_dedup._packed(at)], [b""]))
    (merged,) = list(line_dedup._merge(iter(parts)))
    twice = np.zeros(bits, bool)
    twice[line_dedup._unpacked(merged.column("twice")[0].as_py())] = True
    suspected = twice[line_dedup.positions(keys, bits)].all(0)
    assert all(s for k, s in zip(keys.tolist(), suspected) if k in repeated)
    assert suspected.sum() < 1500


def test_keys_of_a_slice():
    texts = ["a" * 40 + "\n" + " " * 9 + "A" * 40 + "\n\n" + "b" * 39, None, "\n", "ñ" * 39 + "\n" + "ñ" * 40]
    keys = line_dedup.Keys(pa.array(["", *texts]).slice(1), 40)
    found = [(int(r), bytes(keys.data[s:e]).decode()) for r, s, e in zip(keys.rows, keys.starts, keys.ends)]
    assert found == [(0, "a" * 40), (3, "ñ" * 40)]


def rebuilt(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, tie, role, text))
    turns = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    heads = {c: zlib.crc32(str(c).encode()) % 4 for c in turns}
    return {c: turns.get(c - int(math.fmod(c, 20)), [])[: heads[c]] + ts[heads[c] :] for c, ts in turns.items()}


def plain_trie(convs):
    members, ended, children = collections.defaultdict(set), collections.defaultdict(list), collections.defaultdict(set)
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(conv)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ended[tuple(turns)].append(conv)
    out = []

    def walk(node):
        saved = (len(members[node]) - 1) * (len(node[-1][1].split()) if node else 0)
        leaves = 0 if children[node] else 1
        for child in children[node]:
            more = walk(child)
            saved, leaves = saved + more[0], leaves + more[1]
        ends = ",".join(map(str, sorted(ended[node])))
        out.append(
            (
                min(members[node]),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(members[node]),
                len(children[node]),
                leaves,
                saved,
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
        return saved, leaves

    if convs:
        walk(())
    return sorted(out, key=repr)


def conversation_rows():
    rng = random.Random(7)
    says = ["hello there", "one two  three", "", None, "a\tb c"]
    rows = [(None, 0, "user", "left out"), (40, None, None, None), (40, 2, "user", "x"), (40, 2, "bot", "y y"), (40, 2, "user", "x")]
    for conv in [c for c in range(-25, 140) if rng.random() < 0.9 and c != 40]:
        deep = 30 if conv % 31 == 0 else rng.randrange(1, 6)
        for turn in range(deep):
            rows.append((conv, turn, rng.choice(["user", "assistant", None]), rng.choice(says)))
    rows += [(1000 + c, t, "user", "copied words here") for c in range(50) for t in range(4)]
    return rows + [(2000 + c, 0, "user", "only one turn") for c in range(20)]


@pytest.mark.parametrize("shard", [1, 3, 1024])
def test_trie_is_that_of_plain_python(spark, shard):
    rows = conversation_rows()
    table = ship(spark).createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {n: F.lit("x") for n in ("node", "turns", "key", "words", "depth", "base")}
    )
    turns = prefix_trie.with_shared_openings(prefix_trie.turn_lists(table.repartition(4)))
    result = prefix_trie.trie(spark, turns, shard).drop("node")
    assert sorted((tuple(r) for r in result.collect()), key=repr) == plain_trie(rebuilt(rows))


def test_trie_of_conversations_without_turns_and_of_none(spark):
    # 3 takes three turns of the absent 0 in place of its only one
    assert zlib.crc32(b"3") % 4 >= 1
    schema = "conv_id long, turn long, role string, text string"
    only = ship(spark).createDataFrame([(3, 0, "user", "gone")], schema)
    turns = prefix_trie.with_shared_openings(prefix_trie.turn_lists(only))
    root = prefix_trie.trie(spark, turns).drop("node").collect()
    assert [tuple(r) for r in root] == [(3, 0, None, 1, 0, 1, 0, hashlib.sha256(b"3").hexdigest())]
    none = prefix_trie.turn_lists(spark.createDataFrame([], schema))
    assert prefix_trie.trie(spark, prefix_trie.with_shared_openings(none)).collect() == []


def test_trie_of_one_long_conversation_and_its_copies(spark):
    rows = [(c, t, "user", f"turn {t}") for c in (1, 2) for t in range(2000)]
    turns = prefix_trie.turn_lists(ship(spark).createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    result = prefix_trie.trie(spark, turns).agg(F.count(F.lit(1)), F.max("saved_tokens"), F.max("n_leaves")).first()
    assert tuple(result) == (2001, 4000, 1)


def plain_clusters(rows, k=40, rounds=5):
    vectors = [
        (i, [int(np.floor(256 * float(x))) for x in v])
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)
    ]
    rank = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(vectors, key=lambda r: (rank(r[0]), r[1]))[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        held = collections.defaultdict(list)
        for _, v in vectors:
            held[near(v)[1]].append(v)
        centroids = [[sum(p) // len(held[j]) for p in zip(*held[j])] if held[j] else c for j, c in enumerate(centroids)]
    last = [(i, *near(v)) for i, v in vectors]
    inertia = collections.Counter()
    for _, d, j in last:
        inertia[j] += d
    text = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), text(centroids[j])) for i, d, j in last), key=repr)


def vector_rows(n, width=64):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, rng.gauss(0, 0.4)]) for _ in range(width)]) for i in range(n)]
    return rows


def test_clusters_are_those_of_plain_python(spark):
    rows = vector_rows(150)
    rows += [(i, rows[0][1]) for i in range(200, 240)] + [rows[5], rows[5]]
    bad = [(300, None), (301, []), (302, [0.1] * 63), (303, [0.1] * 63 + [None]), (304, [float("nan")] * 64), (305, [float("inf")] * 64)]
    rows += [*bad, (None, [0.3] * 64)]
    table = ship(spark).createDataFrame(rows, "vec_id long, embedding array<float>").withColumns(
        {n: F.lit("x") for n in ("cluster", "v", "distance", "inertia")}
    )
    rounded = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    result = clustering.cluster(spark, table.repartition(3)).drop("centroid")
    assert sorted((tuple(r) for r in result.collect()), key=repr) == plain_clusters(rounded)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [1.0] * 64), (2, [1.0] * 64), (3, [-1.0] * 64)]
    table = ship(spark).createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((tuple(r) for r in clustering.cluster(spark, table).drop("centroid").collect()), key=repr)
    assert got == plain_clusters(rows)
    assert clustering.cluster(spark, table.limit(0)).collect() == []


@pytest.mark.parametrize("size", [50, 2**22, 2**26])
def test_tournament_finds_the_nearest_and_the_smaller_of_equals(size):
    rng = np.random.default_rng(size)
    centroids = rng.integers(-size, size, (20, 8))
    centroids[7] = centroids[3]
    x = rng.integers(-size, size, (500, 8))
    x[:100] = (centroids[rng.integers(0, 20, 100)] + centroids[rng.integers(0, 20, 100)]) // 2
    planes = clustering.Bisectors(centroids.tolist())
    want = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for v in x]
    won = planes.winners(x)
    assert won.tolist() == [j for _, j in want]
    assert planes.distances(x, won).tolist() == [d for d, _ in want]


def test_a_component_too_large_is_an_error(spark):
    table = ship(spark).createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="or more"):
        clustering.cluster(spark, table).collect()
