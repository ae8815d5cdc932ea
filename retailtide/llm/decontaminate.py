"""Benchmark decontamination by winnowing, in DataFrame functions only.

A window is 13 consecutive words of a benchmark item (an item with fewer words is one window). To
find every place where a document holds a window, both sides keep the smallest hash of ``K``-word
runs in each stretch of a window's length: equal windows keep an equal run, so joining the kept runs
misses no shared window (winnowing). Each hit is then extended word by word to both sides, and counts
if the shared span reaches the window's length. Words covered by such spans are hit.

Items of fewer than 13 words form window lengths of their own, so documents are fingerprinted once per
length that the benchmark has (13 at most), and with all runs kept where an item is as short as a run.

Scale: one pass over the texts; about ``2 / (W + 1)`` of the words become rows, which meet the
benchmark's fingerprints in a broadcast join if those are at most ``BROADCAST_ROWS`` (counted first),
else in a shuffled one, and only hits go on. Hits are summed as bit masks per 64 words of a document
before and after their shuffle, so a passage shared by many documents, or repeated within one, costs
no more than its words.

Defined cases: a document with a null or empty text, or without words, has no hit words, no items and
is not contaminated. Rows that are equal in id and text are each returned with the same result; rows
that share an id but not the text are told apart by a hash of the text. Benchmark items without words
have no window; items without an id make words hit but are not listed; repeated items are listed once.
An empty benchmark or table gives no hits, or no rows. Other columns are left aside.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailtide.llm.components import unused

WINDOW = 13
#: Words per hashed run; stretches of ``WINDOW - K + 1`` runs keep one.
K = 6
BROADCAST_ROWS = 200_000
#: Low bits of a ranked run hold its position, so ties are broken by the place.
_PLACE_BITS = 28
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """ASCII letters in lower case, digits and all other characters beyond ASCII make words."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    lower = F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )
    return F.array_remove(F.split(lower, _SEPARATORS), "")


def _shifted(array: Column, by: int) -> Column:
    return F.slice(array, by + 1, F.greatest(F.size(array), F.lit(1)))


def _spread(df: DataFrame, column: str, width: int, join) -> tuple[DataFrame, str]:
    """Add a column that combines ``width`` neighbours of an array, by doubling; its tail is partial."""
    have, at = 1, column
    while have < width:
        step = min(have, width - have)
        name = f"{column}_{have + step}"
        df = df.withColumn(name, F.zip_with(at, _shifted(F.col(at), step), join))
        have, at = have + step, name
    return df, at


def _fingerprints(df: DataFrame, length: int) -> tuple[DataFrame, Column]:
    """The kept runs of a row with word hashes ``h``: key, place, and the words around the run."""
    k = min(K, length)
    side = length - k
    df = df.withColumn(f"w{length}", F.col("h"))
    df, run = _spread(df, f"w{length}", k, lambda a, b: F.xxhash64(a, b))
    ranked = f"v{length}"
    df = df.withColumn(
        ranked, F.transform(run, lambda x, i: F.shiftleft(x, _PLACE_BITS).bitwiseOR(i.cast("long")))
    )
    df, least = _spread(df, ranked, side + 1, lambda a, b: F.least(a, b))
    kept = F.array_distinct(F.slice(least, 1, F.greatest(F.size("h") - length + 1, F.lit(0))))
    df = df.withColumn(f"f{length}", kept)

    def row(v: Column) -> Column:
        place = v.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).cast("int")
        around = F.array(*[F.get("h", place + j) for j in range(-side, k + side)])
        key = F.xxhash64(F.lit(length), F.get(run, place))
        return F.struct(
            key.alias("key"), F.lit(length).alias("length"), place.alias("place"), around.alias("around")
        )

    return df, F.transform(f"f{length}", row)


def _hashed(texts: DataFrame) -> DataFrame:
    """Word hashes ``h`` instead of the text, and ``text_key``, which tells texts apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return (
        texts.withColumn("text_key", F.xxhash64(text))
        .withColumn("words", words(text))
        .withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
        .drop("words", "text")
    )


def _benchmark_rows(benchmark: DataFrame) -> tuple[DataFrame, list[int]]:
    """Fingerprints of the items, and the window lengths that occur (at most ``WINDOW``)."""
    items = _hashed(benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text"))
    items = items.withColumn("window", F.least(F.size("h"), F.lit(WINDOW))).filter("window > 0")
    lengths = sorted(r["window"] for r in items.select("window").distinct().collect())
    parts = []
    for length in lengths:
        df, found = _fingerprints(items.filter(F.col("window") == length), length)
        parts.append(
            df.select("item_id", F.inline(found)).select(
                "key", "item_id", F.col("around").alias("item_around")
            )
        )
    return (reduce(DataFrame.unionByName, parts) if parts else None), lengths


def _equal_run(matches: Column) -> Column:
    """How many leading entries are true."""
    return F.coalesce(F.nullif(F.array_position(matches, F.lit(False)), F.lit(0)) - 1, F.size(matches)).cast("int")


def _spans(hits: DataFrame) -> DataFrame:
    """Extend each hit; a hit with a long enough shared span gets it as ``begin`` and ``end``."""
    k = F.least(F.lit(K), F.col("length"))
    side = F.col("length") - k
    same = F.zip_with("around", "item_around", lambda a, b: F.coalesce(a == b, F.lit(False)))
    hits = hits.withColumn("same", F.when(F.col("item_around").isNotNull(), same))
    left = _equal_run(F.reverse(F.slice("same", 1, side)))
    middle = _equal_run(F.slice("same", side + 1, k))
    right = _equal_run(F.slice("same", side + k + 1, side))
    hits = hits.withColumn("left", left).withColumn("middle", middle).withColumn("right", right)
    whole = (F.col("middle") == k) & (F.col("left") + k + F.col("right") >= F.col("length"))
    return hits.withColumn("begin", F.when(whole, F.col("place") - F.col("left"))).withColumn(
        "end", F.when(whole, F.col("place") + k + F.col("right"))
    )


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document row: ``doc_id, text_key, n_words, n_hit, items`` (sorted texts), ``contaminated``."""
    tests, lengths = _benchmark_rows(benchmark)
    rows = _hashed(docs.select(F.col("doc_id"), "text"))
    whole = F.struct(
        F.col("text_key").alias("key"),
        F.lit(0).alias("length"),
        F.lit(-1).alias("place"),
        F.array().cast("array<bigint>").alias("around"),
    )
    found = [F.array(whole)]
    for length in lengths:
        rows, more = _fingerprints(rows, length)
        found.append(more)
    rows = rows.select("doc_id", "text_key", F.size("h").alias("n_words"), F.inline(F.concat(*found)))
    if tests is None:
        hits = rows.withColumns(
            {"item_id": F.lit(None).cast("string"), "item_around": F.lit(None).cast("array<bigint>")}
        )
    else:
        small = tests.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        hits = rows.join(F.broadcast(tests) if small else tests, "key", "left")
    whole_row = F.col("place") == -1
    spans = _spans(hits.filter(whole_row | F.col("item_around").isNotNull()))
    spans = spans.filter(whole_row | F.col("begin").isNotNull())
    first, last = F.expr("begin div 64"), F.expr("(end - 1) div 64")
    parts = F.when(whole_row, F.array(F.lit(-1).cast("long"))).otherwise(F.sequence(first, last))
    spans = spans.withColumn("part", F.explode(parts))
    low = F.greatest(F.col("begin"), F.col("part") * 64) - F.col("part") * 64
    high = F.least(F.col("end"), F.col("part") * 64 + 64) - F.col("part") * 64
    spans = spans.withColumn("low", low.cast("int")).withColumn("high", high.cast("int"))
    bits = F.expr("shiftleft(shiftrightunsigned(-1L, 64 - (high - low)), low)")
    masks = spans.groupBy("doc_id", "text_key", "part").agg(
        F.bit_or(F.when(whole_row, F.lit(0).cast("long")).otherwise(bits)).alias("bits"),
        F.collect_set("item_id").alias("items"),
        F.max("n_words").alias("n_words"),
        F.sum(F.when(whole_row, 1).otherwise(0)).alias("copies"),
    )
    per_doc = masks.groupBy("doc_id", "text_key").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.sum(F.bit_count("bits")).cast("long").alias("n_hit"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.sum("copies").cast("int").alias("copies"),
    )
    contaminated = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return per_doc.withColumn("contaminated", contaminated).withColumn(
        "copies", F.explode(F.sequence(F.lit(1), F.col("copies")))
    ).drop("copies")


def filter_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, all columns as they came.

    What is joined is the contaminated rows' ids and text hashes; they are broadcast if at most
    ``BROADCAST_ROWS``, else both sides are shuffled. They are counted on the result, so a caller that
    has it written should pass that instead of finding it again.
    """
    return drop_found(docs, find(docs, benchmark))


def drop_found(docs: DataFrame, found: DataFrame) -> DataFrame:
    bad_id, bad_text = unused(docs, "__bad_id"), unused(docs, "__bad_text")
    bad = found.filter("contaminated").select(
        F.col("doc_id").alias(bad_id), F.col("text_key").alias(bad_text)
    ).distinct()
    small = bad.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    same = F.col("doc_id").eqNullSafe(F.col(bad_id)) & (key == F.col(bad_text))
    return docs.join(F.broadcast(bad) if small else bad, same, "left_anti")
