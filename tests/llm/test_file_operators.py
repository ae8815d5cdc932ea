"""Token files, archives, pages, packing: exact round trips and plain Python."""

import gzip
import hashlib
import html
import io
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from retailtide.llm import files, main_text, packing, token_files, tokens, warc
from retailtide.llm.shipping import ship

ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "a  b   c\n\nd\n e\tf ",
    "Été ñ 中文字 🙂 ok, don't we'll",
    "nbsp inside and wide",
    "x" * 60_000,
    "word " * 20_000,
    "tail space ",
    "<|endoftext|> inside <|endoftext|>",
]


@pytest.fixture(scope="module")
def vocabularies():
    return tokens.vocabulary("byte_bpe_50k.json"), tokens.vocabulary("word_bpe_49k.json")


def docs_of(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, "no id")]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'x' AS n_tokens", "1 AS start", "2 AS piece", "3 AS length"
    )


def whole_ids(path, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("which", [0, 1])
def test_chunked_encoding_equals_the_whole_text(vocabularies, which):
    random.seed(3)
    pieces = ["a", " ", "  ", "\n", "é", "B c", "'s", "12", "\t", "…", " ", "z.\n", "<|endoftext|>", "it's", "x,", "-y", "Q?!", "\u0301", "<|ENDOFTEXT|>", "a|b"]
    texts = [*ODD_TEXTS, *("".join(random.choices(pieces, k=random.randrange(40))) for _ in range(300))]
    encoder = tokens.Encoder(vocabularies[which], spaced=which == 0)
    ids, counts = encoder.encode(pa.array(texts, pa.string()))
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert [p.tolist() for p in parts] == whole_ids(vocabularies[which], texts)


def test_encoder_forgets_and_learns_again(vocabularies, monkeypatch):
    monkeypatch.setattr(tokens, "CACHED", 5)
    encoder = tokens.Encoder(vocabularies[1], spaced=False)
    for text in ("one two three four", "five six seven", "one two three four"):
        ids, _ = encoder.encode(pa.array([text]))
        assert ids.tolist() == whole_ids(vocabularies[1], [text])[0]


def test_encoder_looks_a_chunk_up_once_and_makes_no_array_for_each(vocabularies, monkeypatch):
    class Counted(dict):
        looks = 0

        def __contains__(self, key):
            Counted.looks += 1
            return dict.__contains__(self, key)

        def __getitem__(self, key):
            Counted.looks += 1
            return dict.__getitem__(self, key)

        def get(self, key, default=None):
            Counted.looks += 1
            return dict.get(self, key, default)

    made, plain = [], np.asarray
    monkeypatch.setattr(tokens.np, "asarray", lambda *a, **b: made.append(a) or plain(*a, **b))
    encoder = tokens.Encoder(vocabularies[0], spaced=True)
    encoder.known = Counted()
    text = " ".join(f"word{i}" for i in range(500))
    for _ in range(2):
        ids, _ = encoder.encode(pa.array([text]))
        assert ids.tolist() == whole_ids(vocabularies[0], [text])[0]
    assert Counted.looks <= 2 * 500
    assert len(made) < 100


def test_token_files_are_read_back_exactly(spark, vocabularies, monkeypatch):
    path = vocabularies[0]
    docs = docs_of(spark, ODD_TEXTS)
    manifest = token_files.write(docs, path)
    got = sorted(map(tuple, token_files.read(manifest, 3).collect()), key=lambda r: r[1])
    texts = [("no id", None), *((t, i) for i, t in enumerate(ODD_TEXTS))]
    texts.insert(1, (ODD_TEXTS[0], 0))
    at, want = 0, []
    for ids, (_, doc_id) in zip(whole_ids(path, [t for t, _ in texts]), texts):
        want.append((doc_id, at, len(ids) + 1, crc([*ids, 0])))
        at += len(ids) + 1
    assert got == want


def test_sequences_have_equal_length_and_are_views_of_the_file(spark, vocabularies):
    manifest = token_files.write(docs_of(spark, ["word " * 3000, "b"]).coalesce(1), vocabularies[0])
    rows = manifest.collect()
    seen = 0
    for row in rows:
        last = -(-row.n_tokens // token_files.SEQUENCE) - 1
        for number in range(last + 1):
            ids, mask = token_files.sequence(row.sequences, number)
            assert len(ids) == len(mask) == token_files.SEQUENCE and not ids.flags.owndata
            assert mask.all() if number < last else mask.sum() == row.n_tokens - last * token_files.SEQUENCE
            seen += int(mask.sum())
    assert seen == sum(r.n_tokens for r in rows)


def test_token_files_of_an_empty_table(spark, vocabularies):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.read(token_files.write(docs, vocabularies[0])).count() == 0


def packed_rows(spark, vocabularies, texts):
    return packing.pack(packing.pieces(docs_of(spark, texts), vocabularies[1])).collect()


def check_packing(rows):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return len(by_sequence)


def test_pieces_and_places(spark, vocabularies):
    rows = packed_rows(spark, vocabularies, ODD_TEXTS)
    check_packing(rows)
    want = {}
    for i, ids in enumerate(whole_ids(vocabularies[1], ODD_TEXTS)):
        ids = [*ids, 1]
        for k, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            want[i, k] = (start, len(part), crc(part))
    got = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows if r.doc_id is not None}
    assert got == want
    assert sum(1 for r in rows if r.doc_id == 0) == 2 and sum(1 for r in rows if r.doc_id is None) == 1


def test_groups_are_filled_up_together(spark, vocabularies, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_TOKENS", 9000)
    random.seed(5)
    texts = ["a b " * random.randrange(50, 1800) for _ in range(60)]
    rows = packed_rows(spark, vocabularies, texts)
    assert len(rows) == 62
    total = sum(r.length for r in rows)
    assert check_packing(rows) <= -(-total // 4096) * 1.25 + 1


def test_packing_of_an_empty_table(spark, vocabularies):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.pieces(docs, vocabularies[1])).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_bin_completion_is_as_good_as_trying_everything(seed):
    random.seed(seed)
    lengths = [random.randrange(1, 11) for _ in range(9)]

    def fewest(left, rooms):
        if not left:
            return len(rooms)
        best = 99
        for i in range(len(rooms)):
            if rooms[i] >= left[0]:
                best = min(best, fewest(left[1:], rooms[:i] + [rooms[i] - left[0]] + rooms[i + 1 :]))
        return min(best, fewest(left[1:], [*rooms, 10 - left[0]]))

    made = packing.complete_bins(lengths, 10)
    assert sorted(x for s in made for x in s) == sorted(lengths) and max(map(sum, made)) <= 10
    assert len(made) == fewest(sorted(lengths, reverse=True), [])


def test_bin_completion_beats_best_fit():
    lengths = [6, 6, 5, 5, 4, 4] + [7, 3, 3, 2, 2, 1, 2] * 20
    assert len(packing.complete_bins(lengths, 10)) == -(-sum(lengths) // 10)
    assert packing.complete_bins([], 10) == []


@pytest.mark.parametrize("least, most", [(300, 450), (100, 454), (600, 900), (900, 1400)])
def test_narrow_bands_of_lengths_are_filled_around_the_largest(least, most):
    random.seed(least)
    lengths = [random.randrange(least, most) for _ in range(2000)]
    made = packing.complete_bins(lengths)
    assert sorted(x for s in made for x in s) == sorted(lengths) and max(map(sum, made)) <= packing.CAPACITY
    plain, bound = len(packing.best_fit_decreasing(lengths)), -(-sum(lengths) // packing.CAPACITY)
    assert len(made) < plain or plain == bound
    assert 3 * (len(made) - bound) <= 2 * (plain - bound)


def pages_of(spark):
    page = "<html>" + "é" * 80 + "</html>"
    rows = [
        (5, "http://a/1", page),
        (3, "http://a/2", page),
        (9, None, page),
        (4, "u\r\nX: y", "short"),
        (6, "http://a/3", "short"),
        (7, "", None),
        (8, "x", ""),
        (None, "n", page),
        (None, "m", "only " * 40),
        (11, "long", "<p>" + "lorem " * 60_000),
        (3, "http://a/2", page),
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return rows, frame.selectExpr("*", "'x' AS digest", "1 AS first", "2 AS records")


@pytest.mark.parametrize("range_bytes", [97, 4096, 10**7])
def test_archives_are_read_back_from_any_range(spark, range_bytes):
    rows, frame = pages_of(spark)
    got = warc.read(warc.write(frame.repartition(3)), range_bytes=range_bytes).collect()
    assert len(got) == len(rows)
    firsts = {}
    for page_id, _, text in rows:
        data = (text or "").encode()
        if len(data) >= 100 and page_id is not None:
            firsts[data] = min(page_id, firsts.get(data, page_id))
    want = []
    for page_id, url, text in rows:
        data = (text or "").encode()
        first = firsts.get(data)
        revisit = first is not None and page_id != first
        url = (url or "").replace("\r", "%0D").replace("\n", "%0A")
        want.append(
            (page_id, url, "revisit" if revisit else "response", first if revisit else None, len(data), hashlib.sha256(data).hexdigest(), None if revisit else data)
        )
    order = ("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload")
    mine = [tuple(bytes(v) if isinstance(v, bytearray) else v for v in (r[n] for n in order)) for r in got]
    assert sorted(mine, key=repr) == sorted(want, key=repr)


def test_archive_is_plain_gzip_and_can_be_listed(spark):
    rows, frame = pages_of(spark)
    manifest = warc.write(frame.coalesce(1)).collect()
    system, path = files.opened(manifest[0].file)
    with system.open_input_file(path) as f:
        data = gzip.decompress(f.read())
    assert data.count(b"WARC/1.1\r\n") == manifest[0].records == len(rows)
    folder = manifest[0].file.rpartition("/")[0]
    assert warc.read(warc.listed(spark, folder), payloads=False).count() == len(rows)


def test_gzip_magic_inside_a_record_is_no_record():
    """A stored block may hold a whole member; readers that start before the record pass it over."""
    inner = warc.record(2, "in", b"inner", "0", None)
    outer = warc.record(1, "out", inner + b"\x1f\x8b\x08junk", "0", None)
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)
    data = stored.compress(gzip.decompress(outer)) + stored.flush() + b"\x1f\x8b\x08" + inner
    file = pa.BufferReader(data)
    found = [warc.parse(c)["page_id"] for c in warc.records_in(file, 0, len(data), len(data))]
    assert found == [1, 2]


def test_archive_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read(warc.write(empty)).count() == 0


PAGES = [
    (None, ""),
    ("", ""),
    ("no tags, only text", "no tags, only text"),
    ("<p>One, two, three and a few more words here.</p>", "One, two, three and a few more words here."),
    (
        "<body><nav><a href=/>Home</a></nav><div class='sidebar'><p>Side text, which is long enough to count.</p></div>"
        "<div id=content><h1>T&amp;C</h1><p>First, with\n  commas, and&nbsp;some length.<br>same block<br><br>own block"
        "<p>Second one, also long enough, yes it is.<ul><li>Point one, with text that is long</ul>"
        "<form>Name <input></form><div class=comments><p>I disagree, said a reader, at some length.</p></div></div>"
        "<footer>&copy; foot</footer>",
        "T&C\nFirst, with commas, and some length. same block\nown block\nSecond one, also long enough, yes it is.\n"
        "Point one, with text that is long",
    ),
    ("<article><p><b>Short.<br><p>Tiny</article><div class=ad>Buy, buy, buy this thing, right now, please.</div>", "Short.\nTiny"),
    ("<script>var a='<p>x</p>'</script><p title='a>b'>Text, after a script, long enough.</p><!-- open <p>y", "Text, after a script, long enough."),
    ("<style>p{}</style><script>never closed <p>text", ""),
    ("<div hidden><p>Hidden text, which is long enough to count.</p></div><p>Seen</p>", "Seen"),
    ("<table><tr><td>A cell with text, long enough to count<td>and another, next to it, here", "A cell with text, long enough to count\nand another, next to it, here"),
    ("</p></div><<p a=\"x><p>After a broken tag, there is text.</p>", None),
]


@pytest.mark.parametrize("page, want", PAGES)
def test_main_text(page, want):
    got = main_text.main_text(page)
    assert want is None or got == want


LONG = "".join(f"<p>Paragraph {i}, with a few words, and a good number of commas, so that it counts.</p>" for i in range(6))
LONG_TEXT = "\n".join(re.findall("<p>(.*?)</p>", LONG))


@pytest.mark.parametrize(
    "wrapper",
    [
        "<div class='content overflow-hidden'>",
        "<div class='post with-sidebar'>",
        "<div id=content class=no-sidebar>",
        "<div class='has-sidebar'>",
        "<div class='md:hidden'>",
        "<form id=aspnetForm>",
        "<div data-hidden=false>",
        "<div data-x='is hidden now'>",
        "<div class=share-page>",
        "<div class=sidebar>",
    ],
)
def test_one_word_of_a_wrapper_does_not_drop_the_article(wrapper):
    end = f"</{re.match('<([a-z]+)', wrapper)[1]}>"
    page = f"<body><div class=nav><a href=/>Home</a></div>{wrapper}{LONG}{end}<div><p>Imprint and the like, of some length.</p></div>"
    assert main_text.main_text(page) == LONG_TEXT


def test_parts_that_are_not_the_article_stay_out_beside_a_short_one():
    short = "A short article, of only one paragraph, that says what there is to say."
    for mark in ("class=comments", "class='post sponsored'", "class=sidebar", "hidden", "class=is-hidden", "aria-hidden=true", "class=post-meta"):
        part = LONG if mark != "class=post-meta" else "<p>By someone, on some day, of some year, at noon.</p>"
        assert main_text.main_text(f"<div><p>{short}</p></div><div {mark}>{part}</div>") == short, mark
    assert main_text.main_text(f"<div class=ad>{LONG[:90]}</div>") == ""


@pytest.mark.parametrize("outer", ["article", "main", "div class=post", "div class='hentry wide'"])
def test_blocks_of_the_article_beside_its_best_container_stay(outer):
    inner = f"<h1>Title</h1><div>{LONG}</div><blockquote>Said so.</blockquote><ul><li>One<li>Two</ul><p>Short end.</p>"
    rest = "<div class=related><p>Another article, about another thing, of another day.</p></div><ul><li><a href=/>Home</a></ul>"
    page = f"<body><h2>Site</h2><div><{outer}>{inner}{rest}</{outer.split()[0]}></div><div><p>Imprint, and so on.</p></div>"
    assert main_text.main_text(page) == f"Title\n{LONG_TEXT}\nSaid so.\nOne\nTwo\nShort end."


def test_main_with_several_articles_gives_the_best():
    page = f"<main><article><div>{LONG}</div><p>End.</p></article><article><p>Short, other.</p></article></main>"
    assert main_text.main_text(page) == f"{LONG_TEXT}\nEnd."


def test_very_long_and_deep_pages_are_read_in_linear_time():
    deep = "<div>" * 20_000 + "<p>Some text, down here, that counts.</p>"
    assert main_text.main_text(deep) == "Some text, down here, that counts."
    many = "<article>" + "<p>A line, with some words in it.</p>" * 20_000 + "</article>"
    assert main_text.main_text(many).count("\n") == 19_999


def article_of(page):
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = []
    for block in re.split(r"</?(?:p|h1)\b[^>]*>", body):
        text = re.sub(r"<[^>]*>", lambda m: " " if m[0].startswith("<br") else "", block)
        blocks.append(" ".join(html.unescape(text).split()))
    return "\n".join(b for b in blocks if b)


def test_articles_of_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = main_text.extract(pages.selectExpr("*", "'x' AS text", "1 AS n_chars")).collect()
    source = {r.page_id: r for r in pages.collect()}
    assert len(rows) == len(source)
    for r in rows:
        assert r.text == article_of(source[r.page_id].html) and r.n_chars == len(r.text)
        assert r.url == source[r.page_id].url


def test_reading_a_window_far_from_the_start():
    data = b"".join(warc.record(i, "u", b"x" * 5000, "0", None) for i in range(50))
    file = io.BytesIO(data)
    reader = pa.PythonFile(file, mode="r")
    found = []
    for start in range(0, len(data), 333):
        found += [warc.parse(c)["page_id"] for c in warc.records_in(reader, start, min(len(data), start + 333), len(data))]
    assert found == list(range(50))


def test_elements_that_close_themselves_do_not_swallow_what_follows():
    for tag in ("svg", "iframe", "math"):
        page = f"<body><article><p>{'One, two, three. ' * 9}</p><{tag} class=x />" + "".join(
            f"<p>{w} paragraph, {'with some words, ' * 6}</p>" for w in ("Second", "Third")
        ) + "</article></body>"
        assert len(main_text.main_text(page).split("\n")) == 3, tag


def test_references_and_titles_and_tagged_words_stay():
    links = "".join(f'<li><a href="#{i}">Reference number {i}, of the article</a></li>' for i in range(6))
    body = f"<p>{'A sentence, with <span class=tags>words</span> in it. ' * 9}</p>" * 2
    page = f"<body><h1>The title</h1><div id=c>{body}</div><div><a href=x>Elsewhere</a></div></body>"
    assert main_text.main_text(page).split("\n")[0] == "The title"
    assert "with words in it" in main_text.main_text(page) and "Elsewhere" not in main_text.main_text(page)
    article = f"<body><div class=nav>{links}</div><article>{body}<h2>References</h2><ul>{links}</ul></article></body>"
    text = main_text.main_text(article).split("\n")
    assert text[-1] == "Reference number 5, of the article" and len(text) == 9


def test_archives_and_token_files_are_read_by_several_tasks(spark, vocabularies):
    pages = ship(spark).range(40).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"), F.repeat(F.sha2(F.col("id").cast("string"), 512), 40).alias("html")
    )
    records = warc.read(warc.write(pages.repartition(2)), range_bytes=1000)
    tasks = records.select(F.spark_partition_id().alias("task"), "page_id")
    assert tasks.select("task").distinct().count() > 2 and tasks.count() == 40
    docs = pages.select(F.col("page_id").alias("doc_id"), F.col("html").alias("text"))
    read = token_files.read(token_files.write(docs, vocabularies[0]), documents_at_once=5)
    tasks = read.select(F.spark_partition_id().alias("task"), "doc_id")
    assert tasks.select("task").distinct().count() > 2 and tasks.count() == 40


def test_what_a_worker_keeps_is_let_go_by_tasks_of_another_operator(vocabularies):
    from retailtide.llm import texts, tokens

    tokens.encoder(vocabularies[0], True)
    batch = pa.record_batch([pa.array(["a b"])], ["text"])
    list(texts.slices(batch, "text", keep=True))
    assert tokens._encoders
    list(texts.slices(batch, "text"))
    assert not tokens._encoders


@pytest.mark.parametrize("seed", range(3))
def test_packing_without_bounds_makes_as_few_sequences_as_can_be(spark, seed):
    rng = random.Random(seed)
    lengths = [rng.choice([rng.randrange(1, 9), rng.randrange(9, 26)]) for _ in range(18)]
    whole, size = (1 << len(lengths)) - 1, 40
    # the fewest sequences for each subset, and the most room left in the last of them
    best = {0: (0, 0)}
    for taken in range(whole):
        if taken in best:
            for i, length in enumerate(lengths):
                if not taken >> i & 1:
                    bins, room = best[taken]
                    state = (bins, room - length) if room >= length else (bins + 1, size - length)
                    more = taken | 1 << i
                    if more not in best or (state[0], -state[1]) < (best[more][0], -best[more][1]):
                        best[more] = state
    rows = [(i, 0, 0, n, 0, i) for i, n in enumerate(lengths)]
    made = ship(spark).createDataFrame(rows, packing.PIECE)
    packed = packing.pack(made, size, None, None).collect()
    assert len({r.sequence_id for r in packed}) == best[whole][0]
    for number in {r.sequence_id for r in packed}:
        inside = sorted((r.offset, r.length) for r in packed if r.sequence_id == number)
        assert [o for o, _ in inside] == [sum(n for _, n in inside[:k]) for k in range(len(inside))]
        assert sum(n for _, n in inside) <= size


def test_ids_that_need_four_bytes_get_them(spark, vocabularies, monkeypatch):
    docs = docs_of(spark, ["one two", "three"])
    with monkeypatch.context() as m:
        m.setattr(token_files, "ids_of", lambda _: 70_000)
        with pytest.raises(ValueError, match="two bytes"):
            token_files.write(docs, vocabularies[0], wide=False)
        manifest = token_files.write(docs, vocabularies[0])
    ids, _ = token_files.sequence(manifest.first()["sequences"], 0)
    assert ids.dtype == np.uint32
    small = token_files.write(docs, vocabularies[0])
    assert token_files.sequence(small.first()["sequences"], 0)[0].dtype == np.uint16
