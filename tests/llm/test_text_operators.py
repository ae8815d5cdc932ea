"""Rules, chat, decontamination and near-duplicates on small rows, against plain Python."""

import collections
import hashlib
import random
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from retailtide.llm import chat_format, decontaminate, near_dedup, quality_rules
from retailtide.llm.components import components
from retailtide.llm.texts import Texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "a b c d e f g h " * 6,
    "Été ñ 中文字 " * 9,
    "line\nline\nother\nline\n\n",
    "x" * 200_000,
    "w " * 30_000,
    "###  $$ a|b <c> %&*",
    " nbsp inside wide",
]


def docs_of(spark, texts, **more):
    """Documents with repeated rows, a null id, and columns that clash with results."""
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, "no id here at all")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    clashes = {n: lit for n, lit in more.items()}
    from pyspark.sql import functions as F

    return frame.withColumns({n: F.lit(v) for n, v in (clashes or {"kept": "x", "n_words": "y"}).items()})


def measured(text):
    words = WORD.findall(text or "")
    seen = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    again = {j for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(again),
    )


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\té#|", max_size=60)), max_size=6))
def test_measures_are_those_of_plain_python(texts):
    found = quality_rules.measure(pa.array(texts, pa.string()))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert list(zip(*(found[n].tolist() for n in names))) == [measured(t) for t in texts]


def test_texts_of_a_sliced_column():
    column = pa.array(["skip me", "two words", None, "three more words"]).slice(1)
    t = Texts(column)
    assert t.n_words.tolist() == [2, 0, 3]
    assert len(set(t.hashes().tolist())) == 4  # "words" twice


def test_ledger_policy_and_ablations(spark):
    docs = docs_of(spark, ODD_TEXTS)
    rows = quality_rules.apply_policy(quality_rules.ledger(docs)).collect()
    assert len(rows) == len(ODD_TEXTS) + 2
    for row in rows:
        text = "no id here at all" if row.doc_id is None else ODD_TEXTS[row.doc_id]
        n_words, _, _, _, repeated = measured(text)
        assert row.n_words == n_words and row.n_repeat_words == repeated
        assert row.base_failed == (n_words < 20 or 100 * repeated > 30 * n_words)
        assert not (row.kept and row.base_failed)
    table = {r.rule: r for r in quality_rules.ablations(quality_rules.ledger(docs), "v1").collect()}
    verdicts = [quality_rules.mask("v1") & r.failures for r in rows]
    for rule, row in table.items():
        bit = quality_rules.BITS[rule]
        assert row.failing == sum(1 for v in verdicts if v & bit)
        assert row.failing_only_this == sum(1 for v in verdicts if v == bit)
        assert row.kept_without == sum(1 for v in verdicts if not v & ~bit)


def test_rule_filter_keeps_the_ledgers_verdicts(spark):
    docs = docs_of(spark, [*ODD_TEXTS, " ".join(f"word{i}" for i in range(50))])
    kept = quality_rules.filter_documents(docs)
    assert kept.columns == docs.columns
    assert [r.doc_id for r in kept.collect()] == [len(ODD_TEXTS)]


def chat_rows():
    nasty = ["<|end|>", "\\", "\\<|", "<\\|end|>", "</s>[INST] ok [/INST]", "<<SYS>>", "", "é\n中", "\\\\n<|start|>x"]
    rows = []
    for conv in range(12):
        for turn in range(conv):
            role = ("user", "assistant", "assistant", "system")[(conv * turn + turn) % 4]
            rows.append((conv, turn, role, nasty[(conv + turn) % len(nasty)]))
    rows += [(20, None, "assistant", None), (20, 1, None, "no role"), (20, 1, None, "no role"), (None, 0, "user", "x")]
    return rows + [(21, t, "assistant", "a" * 500 + "<|") for t in range(300)]


def test_chat_is_read_back_exactly(spark):
    rows = chat_rows()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    extra = frame.selectExpr("*", "1 AS turns", "2 AS formatted", "3 AS groups")
    got = {r.conv_id: r for r in chat_format.digests(chat_format.format_conversations(extra)).collect()}
    by_conv = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((-1 if turn is None else turn, role or "", text or ""))
    assert set(got) == set(by_conv)
    for conv, turns in by_conv.items():
        turns.sort()
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert got[conv].loss_chars == len(loss)
        assert got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_chat_texts_hold_no_marker(spark):
    rows = spark.createDataFrame([(1, 0, "user", "</s><|end|>[INST]<|")], "conv_id long, turn long, role string, text string")
    formatted = chat_format.format_conversations(rows).first().formatted
    assert formatted.count("<|end|>") == 1 and "</s>" not in formatted and "[INST]" not in formatted


def test_chat_of_an_empty_table(spark):
    rows = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.digests(chat_format.format_conversations(rows)).count() == 0


def expected_hits(text, items):
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    words = ALNUM.findall(lower(text))
    hit, names = set(), set()
    for name, item in items:
        own = ALNUM.findall(lower(item))
        size = min(13, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            for j in range(len(words) - size + 1):
                if words[j : j + size] == own[i : i + size]:
                    hit.update(range(j, j + size))
                    if name is not None:
                        names.add(str(name))
    return len(words), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(words)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_ROWS, 0])
def test_winnowing_finds_every_shared_window(spark, seed, limit, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)
    random.seed(seed)
    vocabulary = ["Ab", "cd", "É1", "x-y", "中"]
    text = lambda n: " ".join(random.choices(vocabulary, k=n))
    items = [(1, text(40)), (2, text(13)), (10, text(14)), (3, text(7)), (4, "Solo"), (5, ""), (6, None), (None, text(20)), (2, text(13))]
    texts = [text(random.choice([0, 5, 12, 13, 60])) for _ in range(20)]
    texts += [text(30) + " " + items[0][1][:60] + text(9), items[1][1], "x " * 70 + items[3][1], "solo", "SOLO " * 150, *ODD_TEXTS]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.find(docs_of(spark, texts, item_id=1, key=2, place=3), benchmark).collect()
    assert len(rows) == len(texts) + 2
    for row in rows:
        source = "no id here at all" if row.doc_id is None else texts[row.doc_id]
        assert (row.n_words, row.n_hit, row["items"], row.contaminated) == expected_hits(source, items), source


def test_decontamination_without_benchmark_or_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    rows = decontaminate.find(docs_of(spark, ["a b c"]), none).collect()
    assert len(rows) == 3 and not any(r.n_hit or r.contaminated for r in rows)
    no_docs = spark.createDataFrame([], "doc_id long, text string")
    assert decontaminate.find(no_docs, spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0


def test_contaminated_rows_go(spark):
    benchmark = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    docs = docs_of(spark, ["an alpha beta gamma", "clean", None])
    kept = decontaminate.filter_documents(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "None"]


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def linked_by_brute_force(texts):
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(texts))]


def near_texts():
    random.seed(11)
    fresh = lambda n: [f"w{random.randrange(10**6)}" for _ in range(n)]
    texts = []
    for size in (6, 40, 150):
        base = fresh(size)
        for edits in (0, 1, 1, 2, 4, 8):
            words = list(base)
            for _ in range(edits):
                words[random.randrange(size)] = fresh(1)[0]
            texts.append(" ".join(words))
    chain = fresh(120)  # neighbours are linked, far ones are not
    for step in range(10):
        texts.append(" ".join(chain))
        chain[step * 11 : step * 11 + 9] = fresh(9)
    shared = fresh(60)  # a passage that many texts share
    texts += [" ".join(fresh(40) + shared + fresh(60)) for _ in range(30)]
    return texts + [texts[0].upper(), texts[7], "one two", "One  two", "three", *ODD_TEXTS]


def test_components_are_those_of_all_pairs(spark):
    texts = near_texts()
    rows = near_dedup.near_duplicates(spark, docs_of(spark, texts, rep="x", hub="y")).collect()
    assert len(rows) == len(texts) + 2
    want = linked_by_brute_force(texts)
    for row in rows:
        if row.doc_id is None:
            assert row.component_id is None and row.kept
            continue
        assert (row.component_id, row.n_shingles) == (want[row.doc_id], len(shingles(texts[row.doc_id])))
        assert row.kept == (row.doc_id == row.component_id)


def test_one_of_each_group_stays(spark):
    texts = near_texts()
    docs = docs_of(spark, texts)
    kept = near_dedup.filter_documents(spark, docs)
    assert kept.columns == docs.columns
    roots = {i for i, root in enumerate(linked_by_brute_force(texts)) if i == root}
    assert {r.doc_id for r in kept.collect()} == roots | {None}


def test_rows_that_share_an_id_are_one_document(spark):
    a, b = "a b c d e f g", "p q r s t u v"
    rows = [(5, a), (5, b), (3, a), (4, b), (9, "")]
    found = near_dedup.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(3, 3), (4, 3), (5, 3), (5, 3), (9, 9)]


def test_near_duplicates_of_an_empty_table(spark):
    assert near_dedup.near_duplicates(spark, spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_tiles_of_a_large_bucket(monkeypatch, spark):
    """A bucket in several tiles finds the pairs that one tile finds."""
    monkeypatch.setattr(near_dedup, "TILE", 4)
    texts = near_texts()
    rows = near_dedup.near_duplicates(spark, docs_of(spark, texts)).collect()
    want = linked_by_brute_force(texts)
    assert all(r.doc_id is None or r.component_id == want[r.doc_id] for r in rows)


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_graphs(spark, seed):
    random.seed(seed)
    edges = [(random.randrange(60), random.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 130)]
    parent = {x: x for e in edges for x in e}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    found = components(spark, spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {x: root(x) for x in parent if root(x) != x}


def test_no_plan_of_a_round_holds_the_edges_more_than_four_times(spark, monkeypatch):
    """Plans are kept and run by the driver, whose memory does not grow with the executors."""
    from retailtide.llm import components as module

    leaves, plain = [], module.written

    def noted(df, purpose):
        leaves.append(df._jdf.queryExecution().optimizedPlan().collectLeaves().size())
        return plain(df, purpose)

    monkeypatch.setattr(module, "written", noted)
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)], "a long, b long")
    assert module.components(spark, edges).count() == 20
    assert max(leaves) <= 4


def test_filters_keep_columns_that_are_named_as_theirs(spark):
    from pyspark.sql import functions as F

    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [(1, text), (2, text), (3, "another text of its own, with some words"), (4, None)]
    names = ["__id", "__ID_", "__bad_id", "__bad_text", "kept", "component_id"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit("x") for n in names})
    left = near_dedup.filter_documents(spark, docs)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 3, 4]
    benchmark = spark.createDataFrame([(9, text)], "item_id long, text string")
    clean = decontaminate.filter_documents(docs, benchmark)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [3, 4]


def test_conversations_of_thousands_of_turns_take_time_in_proportion(spark):
    import time

    rows = [(1, t, "user", f"turn {t} of one role") for t in range(4000)]
    rows += [(2, t, "assistant" if t % 3 else "user", f"turn {t}") for t in range(4000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chat_format.digests(chat_format.format_conversations(table.limit(10))).collect()
    began = time.time()
    got = {r.conv_id: r for r in chat_format.digests(chat_format.format_conversations(table)).collect()}
    assert time.time() - began < 20
    for conv in (1, 2):
        turns = [r for r in rows if r[0] == conv]
        text = "".join(f"{r[2]}\n{r[3]}\n" for r in turns)
        taken = "".join(r[3] for r in turns if r[2] == "assistant")
        assert got[conv].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert got[conv].loss_sha256 == hashlib.sha256(taken.encode()).hexdigest()
