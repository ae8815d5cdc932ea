"""Distinct counts by bitmaps, against sets."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from retailtide.operators import distinct


def test_numbers_are_dense_and_sets_merge(spark):
    rng = random.Random(4)
    start = date(2024, 1, 1)
    rows = [
        (start + timedelta(days=rng.choice([0, 1, 2, 5, 9, 10])), rng.choice("ab"), f"u{int(rng.paretovariate(0.4)) % 50_000}")
        for _ in range(4000)
    ]
    frame = spark.createDataFrame([*rows, (start, "a", None)], "day date, page string, user string")
    numbers = distinct.numbered(frame, "user", 7)
    users = {u for _, _, u in rows}
    assert {r.user: r.number for r in numbers.collect()}.keys() == users
    assert sorted(r.number for r in numbers.collect()) == list(range(1, len(users) + 1))
    # numbers far apart, so that sets have several buckets
    wide = numbers.withColumn("number", F.col("number") * 977)
    sets = distinct.bitmaps(frame.join(wide, "user"), ["day", "page"])
    pages = distinct.counted(distinct.merged(sets, ["page"]), ["page"])
    assert {r.page: r.users for r in pages.collect()} == {p: len({u for _, q, u in rows if q == p}) for p in "ab"}
    days = {d for d, _, _ in rows}
    want = {}
    for page in "ab":
        for end in days:
            counts = [len({u for d, p, u in rows if p == page and 0 <= (end - d).days < n}) for n in (1, 3, 7)]
            if counts[-1]:
                want[page, end] = tuple(counts)
    got = distinct.over_days(sets, ["page"], (1, 3, 7)).select("page", "day", "users_1", "users_3", "users_7")
    assert {(r[0], r[1]): tuple(r[2:]) for r in got.collect()} == want
    assert distinct.numbered(frame.limit(0), "user").collect() == []
