"""Log reports on hand-made rows: defaults, region texts, users, words, address ranges."""

import json
import random
from collections import Counter, defaultdict
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from retailtide.operators import iprange, metrics
from retailtide.plans import logs as reports

DAY = datetime(2024, 5, 1, 12)

LOG = (
    "log_id string, device struct<brand:string,plat:string,platv:string>, gis struct<ip:string>,"
    "log_type string, user_id string, keywords array<string>, event_time timestamp_ntz"
)


def logs(spark, rows):
    """Rows of (log_id, device, ip, page, user, words, time)."""
    return reports.with_day(
        spark.createDataFrame([(i, d, (ip,), p, u, w, t) for i, d, ip, p, u, w, t in rows], LOG)
    )


def test_device_defaults_and_type(spark):
    rows = [
        ("1", ("Apple", "iOS", "V1"), "", "p", None, None, DAY),
        ("2", ("APPLE", "ios", "v1"), "", "p", None, None, DAY),
        ("3", (None, None, None), "", "p", None, None, DAY),
        ("4", ("Apple", "iOS", "V1"), "", "p", None, None, datetime(2024, 5, 2)),
    ]
    got = {tuple(r) for r in reports.device_report(logs(spark, rows), "2024-05-02").collect()}
    assert got == {
        (date(2024, 5, 1), "ios", "apple", "v1", 2, "history"),
        (date(2024, 5, 1), "unknown", "unknown", "unk", 1, "history"),
        (date(2024, 5, 2), "ios", "apple", "v1", 1, "periodic"),
    }


REGIONS = [
    # raw, label, (province, city, district), abnormal, ip shown
    ("中国|广东省|广州市|电信", "广东省|广州市|电信", ("广东省", "广州市", "电信"), False, False),
    ("中国|0|广州市|0", "null|广州市|null", (None, "广州市", None), False, True),
    ("中国|广东省|| ", "广东省|null|null", ("广东省", None, None), False, False),
    ("中国|广东省", "广东省|null|null", ("广东省", None, None), False, False),
    ("中国|", "null|null|null", (None, None, None), False, True),
    ("中国| 广东省\t|x|y|z", "广东省|x|y", ("广东省", "x", "y"), False, False),
    ("中国|null|x|y", "null|x|y", ("null", "x", "y"), False, True),
    ("未知", "null|null|null", (None, None, None), True, True),
    ("", "null|null|null", (None, None, None), True, True),
    (None, "null|null|null", (None, None, None), True, True),
]


@pytest.mark.parametrize("raw, label, parts, abnormal, shown", REGIONS)
def test_region_texts(spark, raw, label, parts, abnormal, shown):
    counts = spark.createDataFrame(
        [(date(2024, 5, 1), raw, 3, "1.2.3.4")], "day date, region_raw string, count long, ip string"
    )
    r = reports.region_columns(counts, "2024-05-01").first()
    assert (r.region, (r.province, r.city, r.district), r.abnormal) == (label, parts, abnormal)
    assert r.ip == ("1.2.3.4" if shown else None)
    assert (r.region_raw, r["count"], r.type) == (raw, 3, "periodic")


def test_zero_parts_as_abnormal(spark):
    counts = spark.createDataFrame(
        [(date(2024, 5, 1), raw, 1, "i") for raw in ("C|0|x|y", "C|a|b|c", "C|a| 0 |c")],
        "day date, region_raw string, count long, ip string",
    )
    got = {r.region_raw: (r.abnormal, r.province, r.city) for r in reports.region_columns(counts, None, True).collect()}
    assert got == {
        "C|0|x|y": (True, None, None),
        "C|a|b|c": (False, "a", "b"),
        "C|a| 0 |c": (True, None, None),
    }


def test_raw_regions_that_share_a_label_are_one_row(spark):
    counts = spark.createDataFrame(
        [
            (date(2024, 5, 1), "A|0|x|0", 2, "9.9.9.9", DAY),
            (date(2024, 5, 1), "B||x|", 5, "1.1.1.1", DAY.replace(minute=9)),
        ],
        "day date, region_raw string, count long, ip string, newest timestamp",
    )
    assert reports.region_columns(counts).count() == 2
    merged = reports.region_label_columns(reports.region_label_counts(reports.with_region_parts(counts)))
    assert merged.columns == reports.region_columns(counts).columns
    got = [(r.region, r["count"], r.ip, r.region_raw) for r in merged.collect()]
    assert got == [("null|x|null", 7, "1.1.1.1", "B||x|")]


def test_newest_address_of_a_region(spark):
    ranges = spark.createDataFrame([(0, 2**32 - 1, "C||x")], "ip_lo long, ip_hi long, region string")
    rows = [
        (str(i), ("b", "p", "v"), ip, "p", None, None, DAY.replace(minute=m))
        for i, (ip, m) in enumerate([("1.1.1.1", 5), ("2.2.2.2", 9), ("1.1.1.1", 7), ("0.0.0.9", 9)])
    ]
    r = reports.region_report(logs(spark, rows), ranges).first()
    assert (r["count"], r.ip) == (4, "2.2.2.2")


def page_rows(seed=3, n=900):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        page = "hot" if rng.random() < 0.6 else f"p{rng.randrange(3)}"
        user = rng.choice([None, "", *[f"u{rng.randrange(300)}"] * 8])
        rows.append((str(i), ("b", "p", "v"), "", page, user, None, DAY.replace(day=1 + i % 2)))
    return rows


@pytest.mark.parametrize("ids_per_row", [7, 100_000])
def test_page_lists_are_whole(spark, ids_per_row):
    rows = page_rows()
    users = metrics.page_user_counts(logs(spark, rows))
    got = metrics.page_user_lists(users, "day", ids_per_row).collect()
    views, seen = Counter(), defaultdict(set)
    for *_, page, user, _, at in rows:
        views[at.date(), page] += 1
        if user:
            seen[at.date(), page].add(user)
    lists = defaultdict(list)
    heads = [r for r in got if r.chunk == 0]
    assert {(r.day, r.page): r.pv for r in heads} == views and len(heads) == len(views)
    assert all(r.users == len(seen[r.day, r.page]) for r in heads)
    for r in got:
        assert r.chunk == 0 or (r.pv is None and r.users is None)
        assert r.user_ids == sorted(r.user_ids)
        assert 0 <= r.chunk < r.chunks == max(1, -(-len(seen[r.day, r.page]) // ids_per_row))
        lists[r.day, r.page] += r.user_ids
    assert {k: sorted(v) for k, v in lists.items()} == {k: sorted(seen[k]) for k in views}
    if ids_per_row == 7:
        assert max(len(r.user_ids) for r in got) < 40


def test_page_without_users(spark):
    rows = [("1", ("b", "p", "v"), "", "p", "", None, DAY)]
    r = reports.page_report(logs(spark, rows)).first()
    assert (r.pv, r.users, r.user_ids, r.chunk, r.chunks) == (1, 0, "[]", 0, 1)


def test_search_reports(spark):
    rng = random.Random(9)
    rows = [
        (str(i), ("b", "p", "v"), "", "p", None, [f"w{min(rng.randrange(30), rng.randrange(30)):02d}", "all"], DAY)
        for i in range(400)
    ]
    counts = Counter(w for r in rows for w in r[5])
    frame = logs(spark, rows)
    single = [json.loads(r.search_item) for r in reports.search_word_report(frame).collect()]
    assert {i[0]["word"]: i[0]["cnt"] for i in single} == counts and all(len(i) == 1 for i in single)
    top = json.loads(reports.search_top_report(frame).first().search_item)
    best = sorted(counts.items(), key=lambda t: (-t[1], t[0]))[:10]
    assert [(i["word"], i["cnt"]) for i in top] == best


ADDRESSES = {
    "223.104.87.136": "a",
    "223.104.0.0": "a",
    "223.104.255.255": "a",
    "10.0.255.254": None,
    "10.0.255.255": "b",
    "10.1.0.0": "b",
    "10.3.7.1": "b",
    "10.3.7.2": None,
    "61.140.193.98": "c",
    "61.140.193.99": None,
    "0.0.0.0": None,
    "255.255.255.255": "d",
    "256.1.1.1": None,
    "1.2.3": None,
    "1.2.3.4.5": None,
    "01.2.3.4": None,
    "not an ip": None,
    "": None,
    None: None,
}


def ranges(spark):
    n = lambda a, b, c, d: ((a * 256 + b) * 256 + c) * 256 + d
    return spark.createDataFrame(
        [
            (n(223, 104, 0, 0), n(223, 104, 255, 255), "a"),
            (n(10, 0, 255, 255), n(10, 3, 7, 1), "b"),
            (n(61, 140, 193, 98), n(61, 140, 193, 98), "c"),
            (n(255, 255, 255, 255), n(255, 255, 255, 255), "d"),
        ],
        "ip_lo long, ip_hi long, region string",
    )


@pytest.mark.parametrize("limit", [0, 10**8])
def test_address_lookup(spark, limit):
    frame = spark.createDataFrame([(ip,) for ip in ADDRESSES] * 2, "ip string")
    located = iprange.with_region(frame, ranges(spark), "ip", limit)
    got = [(r.ip, r.region) for r in located.collect()]
    assert Counter(got) == Counter([(ip, region or "未知") for ip, region in ADDRESSES.items()] * 2)


@pytest.mark.parametrize("limit", [0, 10**8])
def test_address_lookup_against_brute_force(spark, limit):
    rng = random.Random(21)
    edges = sorted(rng.sample(range(5 * 65_536), 400))
    spans = [(lo, hi, f"r{lo}") for lo, hi in zip(edges[::2], edges[1::2])]
    table = spark.createDataFrame(spans, "ip_lo long, ip_hi long, region string")
    numbers = [rng.randrange(5 * 65_536) for _ in range(3000)] + [edges[0]] * 1500
    text = lambda v: ".".join(str(v >> s & 255) for s in (24, 16, 8, 0))
    frame = spark.createDataFrame([(i, text(v)) for i, v in enumerate(numbers)], "id long, ip string")
    got = {r.id: r.region for r in iprange.with_region(frame, table, "ip", limit).collect()}
    for i, v in enumerate(numbers):
        assert got[i] == next((r for lo, hi, r in spans if lo <= v <= hi), "未知")


@pytest.mark.parametrize("limit", [0, 10**8])
def test_overlapping_ranges(spark, limit):
    """The covering range with the greatest start counts, in either way; then the one that ends first."""
    rng = random.Random(4)
    spans = [(0, 100, "A"), (10, 20, "B"), (10, 15, "C"), (10, 15, "D"), (60_000, 140_000, "E"), (65_536, 65_536, "F")]
    spans += [(lo, lo + rng.randrange(9000), f"r{i}") for i, lo in enumerate(rng.sample(range(200, 190_000), 60))]
    table = spark.createDataFrame(spans, "ip_lo long, ip_hi long, region string")
    numbers = [*range(0, 120), *rng.sample(range(200_000), 1500), 65_535, 65_536, 65_537]
    text = lambda v: ".".join(str(v >> s & 255) for s in (24, 16, 8, 0))
    frame = spark.createDataFrame([(i, text(v)) for i, v in enumerate(numbers)], "id long, ip string")
    rows = iprange.with_region(frame, table, "ip", limit).collect()
    assert len(rows) == len(numbers)
    for r in rows:
        v = numbers[r.id]
        covering = [(lo, -hi, region) for lo, hi, region in spans if lo <= v <= hi]
        assert r.region == (max(covering)[2] if covering else "未知")


def test_lookup_is_a_hash_join_not_a_nested_loop(spark):
    frame = spark.createDataFrame([("1.2.3.4",)], "ip string")
    plan = iprange.with_region(frame, ranges(spark), "ip")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan
    large = iprange.with_region(frame, ranges(spark), "ip", 0)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in large and "Cartesian" not in large


def test_counts_add_up(spark):
    rows = page_rows(17)
    frame = logs(spark, rows)
    assert reports.device_report(frame).agg(F.sum("count")).first()[0] == len(rows)
    for r in reports.page_report(frame).collect():
        assert r.pv >= r.users


def test_page_report_reads_its_logs_once(spark, tmp_path):
    logs(spark, page_rows()).write.parquet(str(tmp_path / "logs"))
    report = reports.page_report(spark.read.parquet(str(tmp_path / "logs")))
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_many_nested_ranges_of_one_block_are_swept_in_one_pass(spark):
    """Fifty thousand ranges inside one another, and a few beside and across them."""
    base = 10 << 24
    nested = [(base + i // 2, base + 65_535 - i // 2 - i % 2, f"r{i}") for i in range(50_000)]
    more = [(base + 70_000, base + 70_010, "a"), (base + 70_005, base + 200_000, "b"), (base + 70_000, base + 70_010, "z")]
    table = spark.createDataFrame(nested + more, "ip_lo long, ip_hi long, region string")
    pieces = iprange.block_ranges(table).collect()
    owner = {}
    for p in pieces:
        for at in range(p.ip_lo, p.ip_hi + 1) if p.ip_lo < base + 65_536 else ():
            assert at not in owner
            owner[at] = p.region
    want = {}
    for lo, hi, region in sorted(nested, key=lambda r: (r[0], -r[1], r[2])):
        want.update({lo: region, hi: region})
    # outside the innermost range, an address belongs to the innermost range around it
    best = {}
    for lo, hi, region in nested:
        for at in (lo, hi):
            best[at] = max(best.get(at, (-1, 0, "")), (lo, -hi, region))
    assert all(owner[at] == b[2] for at, b in best.items())
    beside = sorted((p.ip_lo - base, p.ip_hi - base, p.region) for p in pieces if p.ip_lo >= base + 65_536)
    assert beside[:2] == [(70_000, 70_004, "z"), (70_005, 131_071, "b")]
    assert len(pieces) <= 2 * len(nested) + 8


@pytest.mark.parametrize("seed", range(4))
def test_swept_pieces_are_those_of_brute_force(spark, seed):
    import random as rnd

    rng = rnd.Random(seed)
    rows = []
    for i in range(60):
        lo = rng.randrange(0, 400)
        rows.append((lo, lo + rng.choice([-1, 0, 3, 40, 150]), rng.choice(["a", "b", "c"])))
    table = spark.createDataFrame(rows + rows[:5], "ip_lo long, ip_hi long, region string")
    got = {at: p.region for p in iprange.block_ranges(table).collect() for at in range(p.ip_lo, p.ip_hi + 1)}
    want = {}
    for at in range(600):
        covering = [(lo, -hi, region) for lo, hi, region in rows if lo <= at <= hi]
        if covering:
            want[at] = max(covering)[2]
    assert got == want
