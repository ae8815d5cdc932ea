"""Quality rules as a ledger of failure bits, with versioned policies and ablations over it.

``ledger`` reads each text once, measures it, and evaluates every rule once: bit *i* of
``failures`` is set where rule *i* fails. A policy is a mask of rules, so another policy, another
version or an ablation is bit arithmetic on the ledger and never reads a text again.

Defined cases: a null or empty text, or one of white space, has no words, so all counts are 0 and it
fails ``too_few_words``. Rows are independent, so repeated rows get equal results, each its own; an
empty table gives an empty ledger. Only ``doc_id`` and ``text`` are read: other columns, also ones
named like a result, are left aside. A null ``doc_id`` stays null. The whole text is measured.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailtide.llm.texts import Texts, mix, segment_hashes, slices, window_hashes

WINDOW = 8
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_echo_words",
    "n_lines",
    "n_upper",
    "n_lower",
)

#: The rules in the order of their bits: name, and when a text fails, in whole numbers. A rule takes
#: the measurements by name, as columns or as arrays alike.
RULES = (
    ("too_few_words", lambda m: m["n_words"] < 20),
    ("repeated_windows", lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"]),
    ("symbols", lambda m: 10 * m["n_symbols"] > m["n_words"]),
    ("duplicate_lines", lambda m: 2 * m["n_dup_lines"] > m["n_lines"]),
    ("echoes", lambda m: 10 * m["n_echo_words"] > 3 * m["n_words"]),
    ("short_words", lambda m: m["word_chars"] < 2 * m["n_words"]),
    ("long_words", lambda m: m["word_chars"] > 15 * m["n_words"]),
    ("shouting", lambda m: m["n_upper"] > m["n_lower"]),
)
BITS = {name: 1 << i for i, (name, _) in enumerate(RULES)}

BASE_RULES = ("too_few_words", "repeated_windows")
POLICIES = {
    "base": BASE_RULES,
    "v1": (*BASE_RULES, "symbols", "duplicate_lines", "echoes", "shouting"),
    "v2": tuple(BITS),
}
CURRENT = "v2"


def mask(rules: str | tuple[str, ...]) -> int:
    """The bits of a policy, by its version or as rule names."""
    names = POLICIES[rules] if isinstance(rules, str) else rules
    return reduce(lambda bits, name: bits | BITS[name], names, 0)


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """All measurements of a slice of texts; ``n_repeat_words`` and lines compare 64-bit hashes."""
    t = Texts(column)
    owner = mix(np.arange(len(t), dtype=np.uint64) + np.uint64(1))
    at = t.windows(WINDOW)
    covered = np.zeros(len(t.starts) + 1, np.int64)
    words = t.hashes()
    echo = np.zeros(len(words), bool)
    echo[1:] = words[1:] == words[:-1]
    echo[t.first[:-1][t.n_words > 0]] = False
    if len(at):
        text_of = np.repeat(owner, np.maximum(t.n_words - WINDOW + 1, 0))
        found = window_hashes(words, WINDOW)[at] ^ text_of
        order = np.argsort(found, kind="stable")
        same = found[order][1:] == found[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        np.add.at(covered, at[twice], 1)
        np.add.at(covered, at[twice] + WINDOW, -1)
    newline = t.data == 10
    cut = np.zeros(len(t.data) + 1, bool)
    cut[1:] |= newline
    cut[t.offsets] = True
    begins = np.flatnonzero(cut[:-1])
    stops = np.append(begins[1:], len(t.data))
    stops = np.where(newline[stops - 1], stops - 1, stops) if len(begins) else stops
    worded = np.searchsorted(t.starts, stops) > np.searchsorted(t.starts, begins)
    begins, stops = begins[worded], stops[worded]
    of = np.searchsorted(t.offsets, begins, side="right") - 1
    lines = segment_hashes(t.data, begins, stops) ^ owner[of]
    order = np.argsort(lines, kind="stable")
    again = np.zeros(len(lines), bool)
    again[order[1:]] = lines[order][1:] == lines[order][:-1]
    return {
        "n_words": t.n_words,
        "word_chars": t.count_bytes(~t.gap & ((t.data & 0xC0) != 0x80)),
        "n_symbols": t.count_bytes(_SYMBOLS[t.data]),
        "n_dup_lines": np.bincount(of[again], minlength=len(t)),
        "n_repeat_words": t.count_words(np.cumsum(covered)[:-1] > 0),
        "n_echo_words": t.count_words(echo),
        "n_lines": np.bincount(of, minlength=len(t)),
        "n_upper": t.count_bytes((t.data >= 65) & (t.data <= 90)),
        "n_lower": t.count_bytes((t.data >= 97) & (t.data <= 122)),
    }


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            found = measure(part.column("text"))
            columns = [pa.array(found[name], pa.int64()) for name in MEASURES]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", *MEASURES])


def ledger(docs: DataFrame) -> DataFrame:
    """Per document: its id, every measurement, and ``failures``, the bits of the rules it fails."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = ", ".join(f"{name} long" for name in ("doc_id", *MEASURES))
    found = {name: F.col(name) for name in MEASURES}
    bits = [F.when(fails(found), F.lit(1 << i)).otherwise(0).cast("long") for i, (_, fails) in enumerate(RULES)]
    return rows.mapInArrow(_measured, schema).withColumn(
        "failures", reduce(lambda a, b: a.bitwiseOR(b), bits)
    )


def passes(rules: str | tuple[str, ...] = CURRENT) -> Column:
    """Whether a row of the ledger meets a policy."""
    return F.col("failures").bitwiseAND(F.lit(mask(rules)).cast("long")) == 0


def apply_policy(rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """The ledger with the policy's verdict; only the bits are looked at."""
    base = F.col("failures").bitwiseAND(F.lit(mask("base")).cast("long")) != 0
    return rows.withColumns(
        {"base_failed": base, "kept": ~base & passes(version), "policy": F.lit(version)}
    )


def ablations(rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """What each rule of a policy does: documents that fail it, and that only it rejects.

    The ledger is first summed per bit pattern, of which there are at most two to the number of
    rules, so the shuffle holds patterns and not documents. ``kept_without`` is what the policy would
    keep if the rule were left out.
    """
    bits = mask(version)
    patterns = rows.groupBy(
        F.col("failures").bitwiseAND(F.lit(bits).cast("long")).alias("pattern")
    ).agg(F.count("*").alias("docs"))
    names = POLICIES[version]
    rules = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(BITS[n]).cast("long").alias("bit")) for n in names])
    each = patterns.select("pattern", "docs", F.inline(rules))
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("docs"))), F.lit(0))
    return each.groupBy("rule").agg(
        total(F.col("pattern").bitwiseAND(F.col("bit")) != 0).alias("failing"),
        total(F.col("pattern") == F.col("bit")).alias("failing_only_this"),
        total((F.col("pattern") == 0) | (F.col("pattern") == F.col("bit"))).alias("kept_without"),
        total(F.col("pattern") == 0).alias("kept"),
    )


def filter_documents(docs: DataFrame, version: str = CURRENT) -> DataFrame:
    """The documents that a policy keeps, all columns as they came.

    The verdict is made for every row beside the row itself, without a join, so rows that share an
    id, or have none, are judged each by its own text.
    """
    kept_bits = mask(version) | mask("base")

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield part.filter(pa.array(failures(measure(part.column("text"))) & kept_bits == 0))

    return docs.mapInArrow(judged, docs.schema)


def failures(found: dict[str, np.ndarray]) -> np.ndarray:
    """The failure bits of measured texts, by the same rules as in the ledger."""
    bits = np.zeros(len(found["n_words"]), np.int64)
    for i, (_, fails) in enumerate(RULES):
        bits |= fails(found).astype(np.int64) << i
    return bits
