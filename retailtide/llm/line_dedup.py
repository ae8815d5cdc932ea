"""Lines that many documents share, dropped everywhere but in one, found with two Bloom filters.

A line counts by its key: stripped of ASCII white space at both ends, A to Z in lower case. The first
pass over the texts fills two filters of one size: keys seen once, and keys seen again. A task keeps of
its filters the positions of set bits, since it sets few of all; where two tasks' parts meet, what is set
in both "once" filters is set in "twice" too, so no repeat is ever missed. The second pass tests every key
against the "twice" filter, and only keys in it, suspected repeats, are shuffled: there they are
confirmed by the SHA-256 of the whole key, counted, and the document that keeps them is found. The last
pass drops lines in the documents that have any to drop.

The filters take ``BITS_A_KEY`` bits for each key that the counted texts can hold, at most ``FILTER_BITS``
in all, that a task's memory must hold once. Beyond that they are fuller and suspect more keys; the result
is the same, as every suspicion is confirmed.

Defined cases: a null or empty text is one empty line. A row is a document: equal rows are several
documents, and of rows with one ``doc_id`` all keep a line or none. The greatest ``doc_id`` keeps a line, a
null one only where all are null. An empty table gives an empty result. Only ``doc_id`` and ``text`` are
read, so other columns may have any name. A long line is a key like others, and whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailtide.llm.components import written
from retailtide.llm.files import opened
from retailtide.llm.texts import SPACES, keeps, segment_hashes, slices
from retailtide.operators.bounded import BROADCAST_LIMIT
from retailtide.session import shared_folder

LEAST_CHARS = 40
LEAST_DOCS = 5

#: Bits of a filter for each key, and at most in all (128 MB).
BITS_A_KEY = 16
FILTER_BITS = 2**30
HASHES = 4

#: Bits of the parts in which filters are shuffled and merged.
SEGMENT = 2**20

#: Bytes of text of the tasks whose filters are merged first, before the last merge.
MERGED_BYTES = 8 * 2**30

#: Keys whose positions a task holds before it hands them on.
HELD = 1_000_000

#: A longer line is hashed by itself.
LONG = 65_536

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True


def key_of(line: bytes) -> bytes:
    return line.strip(SPACES).lower()


def _chars(key: bytes) -> int:
    return len(key) - int(np.count_nonzero((np.frombuffer(key, np.uint8) & 0xC0) == 0x80))


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column in lower case, with one more at the end, and where its texts begin."""
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return np.zeros(1, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data or b"", np.uint8)[at[0] : at[-1]]
    return np.append(_LOWER[raw], np.uint8(0)), at - at[0]


class Keys:
    """The keys of at least ``least`` code points of a slice of texts: their rows, bytes and hashes."""

    def __init__(self, column: pa.Array, least: int):
        self.data, offsets = _bytes_of(column)
        data = self.data[:-1]
        breaks = np.flatnonzero(data == 10)
        starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
        ends = np.sort(np.concatenate([breaks, offsets[1:]]))
        counts = np.diff(np.searchsorted(breaks, offsets)) + 1
        rows = np.repeat(np.arange(len(counts)), counts)
        wide = np.flatnonzero(ends - starts >= least)
        self.rows, self.starts, self.ends = rows[wide], starts[wide], ends[wide]
        self._strip()
        wide = np.flatnonzero(self.ends - self.starts >= least)
        self._keep(wide)
        if len(wide):
            inside = ((self.data & 0xC0) != 0x80).view(np.uint8)
            bounds = np.column_stack([self.starts, self.ends]).ravel()
            chars = np.add.reduceat(inside, bounds, dtype=np.int64)[::2]
            self._keep(np.flatnonzero(chars >= least))
        self.hashes = self._hashes()
        order = np.lexsort((self.hashes, self.rows))
        rows, hashes = self.rows[order], self.hashes[order]
        new = np.ones(len(order), bool)
        new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
        self._keep(order[new])
        self.hashes = hashes[new]

    def _keep(self, at: np.ndarray) -> None:
        self.rows, self.starts, self.ends = self.rows[at], self.starts[at], self.ends[at]

    def _strip(self) -> None:
        for i in np.flatnonzero(self.ends - self.starts > LONG):
            line = self.data[self.starts[i] : self.ends[i]].tobytes()
            self.starts[i] += len(line) - len(line.lstrip(SPACES))
            self.ends[i] = self.starts[i] + len(line.strip(SPACES))
        for edge, step in ((self.starts, 1), (self.ends, -1)):
            left = np.flatnonzero(self.starts < self.ends)
            while len(left):
                at = edge[left] if step > 0 else edge[left] - 1
                left = left[_SPACE[self.data[at]]]
                edge[left] += step
                left = left[self.starts[left] < self.ends[left]]

    def _hashes(self) -> np.ndarray:
        out = np.zeros(len(self.rows), np.uint64)
        sizes = self.ends - self.starts
        for i in np.flatnonzero(sizes > LONG):
            digest = hashlib.blake2b(self.data[self.starts[i] : self.ends[i]], digest_size=8).digest()
            out[i] = int.from_bytes(digest, "little")
        short = np.flatnonzero(sizes <= LONG)
        cuts = np.searchsorted(np.cumsum(sizes[short]) // 1_000_000, np.arange(1, sizes[short].sum() // 1_000_000 + 1))
        for part in np.split(short, cuts):
            out[part] = segment_hashes(self.data, self.starts[part], self.ends[part])
        return out

    def digest(self, i: int) -> bytes:
        return hashlib.sha256(self.data[self.starts[i] : self.ends[i]]).digest()


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each key in a filter, a row per hash function."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    turns = np.arange(HASHES, dtype=np.uint64)[:, None]
    return ((hashes + turns * step) & np.uint64(bits - 1)).astype(np.int64)


def _packed(at: np.ndarray) -> bytes:
    """Sorted positions in a segment: themselves, or all bits of it where these are shorter."""
    if len(at) < SEGMENT // 32:
        return at.astype("<u4").tobytes()
    marks = np.zeros(SEGMENT, bool)
    marks[at] = True
    return np.packbits(marks).tobytes()


def _unpacked(part: bytes) -> np.ndarray:
    if len(part) == SEGMENT // 8:
        return np.flatnonzero(np.unpackbits(np.frombuffer(part, np.uint8)))
    return np.frombuffer(part, "<u4").astype(np.int64)


_PARTS = "segment int, once binary, twice binary"


def _part_rows(segments, once, twice) -> pa.RecordBatch:
    arrays = [pa.array(segments, pa.int32()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())]
    return pa.record_batch(arrays, ["segment", "once", "twice"])


def _cut(at: np.ndarray, bits: int) -> list[bytes]:
    edges = np.searchsorted(at, np.arange(0, bits + 1, SEGMENT))
    return [_packed(at[a:b] % SEGMENT) for a, b in zip(edges, edges[1:])]


def _fill(batches: Iterator[pa.RecordBatch], bits: int, least: int) -> Iterator[pa.RecordBatch]:
    """What a task sets in the filters, in rows by segment."""
    held: list[np.ndarray] = []

    def filled():
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        once = np.unique(positions(keys, bits))
        twice = np.unique(positions(keys[counts > 1], bits))
        rows = [(s, a, b) for s, (a, b) in enumerate(zip(_cut(once, bits), _cut(twice, bits))) if a]
        return _part_rows(*(list(c) for c in zip(*rows))) if rows else _part_rows([], [], [])

    for batch in batches:
        for part in slices(batch, "text"):
            held.append(Keys(part.column("text"), least).hashes)
            if sum(map(len, held)) >= HELD:
                yield filled()
    if held:
        yield filled()


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per segment from rows sorted by segment; a single segment is in memory."""
    now, once, twice = None, np.zeros(SEGMENT, bool), np.zeros(SEGMENT, bool)

    def merged():
        return _part_rows([now], [_packed(np.flatnonzero(once))], [_packed(np.flatnonzero(twice))])

    for batch in batches:
        for segment, more, again in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if segment != now:
                if now is not None:
                    yield merged()
                now = segment
                once[:], twice[:] = False, False
            at = _unpacked(more)
            twice[at[once[at]]] = True
            once[at] = True
            twice[_unpacked(again)] = True
    if now is not None:
        yield merged()


def seen_twice(docs: DataFrame, least: int = LEAST_CHARS, most_bits: int = FILTER_BITS) -> tuple[str, int]:
    """The folder to which the merged "twice" filter is written by segment, and its bits."""
    breaks = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    size, lines = docs.agg(F.sum(F.octet_length("text")), F.sum(breaks + 1)).first()
    keys = min(lines or 0, (size or 0) // least)
    bits = min(max(SEGMENT, 1 << (BITS_A_KEY * keys - 1).bit_length() if keys else 0), most_bits)
    parts = docs.select("text").mapInArrow(partial(_fill, bits=bits, least=least), _PARTS)
    segments = bits // SEGMENT
    first = (size or 0) // MERGED_BYTES + 1
    if first > 1:
        salt = F.pmod(F.xxhash64("once"), F.lit(first))
        parts = parts.repartition(segments * first, "segment", salt).sortWithinPartitions("segment").mapInArrow(_merge, _PARTS)
    merged = parts.repartition(segments, "segment").sortWithinPartitions("segment").mapInArrow(_merge, _PARTS)
    folder = shared_folder(docs.sparkSession, "lines-twice")
    merged.select("segment", "twice").write.parquet(folder)
    return folder, bits


_loaded: tuple[str, np.ndarray] | None = None


def _let_go() -> bool:
    global _loaded
    had, _loaded = _loaded is not None, None
    return had


def _load(folder: str, bits: int) -> np.ndarray:
    """The whole "twice" filter, a bit per bit; the one used last is kept by a worker."""
    global _loaded
    keeps(_let_go)
    if _loaded is None or _loaded[0] != folder:
        _loaded = None
        system, path = opened(folder)
        whole = np.zeros(bits // 8, np.uint8)
        for found in system.get_file_info(pafs.FileSelector(path)):
            if not found.path.endswith(".parquet"):
                continue
            with system.open_input_file(found.path) as file:
                for batch in pq.ParquetFile(file).iter_batches(16):
                    for segment, part in zip(batch.column("segment").to_pylist(), batch.column("twice").to_pylist()):
                        marks = np.zeros(SEGMENT, bool)
                        marks[_unpacked(part)] = True
                        whole[segment * SEGMENT // 8 : (segment + 1) * SEGMENT // 8] = np.packbits(marks)
        _loaded = folder, whole
    return _loaded[1]


def _suspect(batches: Iterator[pa.RecordBatch], folder: str, bits: int, least: int) -> Iterator[pa.RecordBatch]:
    """``doc_id, digest`` of the keys that the "twice" filter has."""
    for batch in batches:
        twice = _load(folder, bits)
        for part in slices(batch, "text", keep=True):
            keys = Keys(part.column("text"), least)
            at = positions(keys.hashes, bits)
            bit = np.left_shift(np.uint8(1), (7 - at % 8).astype(np.uint8))
            found = np.flatnonzero(((twice[at // 8] & bit) != 0).all(0))
            if len(found):
                digests = pa.array([keys.digest(i) for i in found], pa.binary())
                yield pa.record_batch([part.column("doc_id").take(pa.array(keys.rows[found])), digests], ["doc_id", "digest"])


def repeated_keys(suspects: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``digest, n_docs, last``: the confirmed repeats, and the document that keeps its lines."""
    found = suspects.groupBy("digest").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last"))
    return found.filter(F.col("n_docs") >= least_docs)


def _drop(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            texts = part.column("text").fill_null("")
            lines = np.asarray(pc.count_substring(texts, "\n")).astype(np.int64) + 1
            dropped = np.zeros(len(lines), np.int64)
            drops = part.column("drops")
            changed = np.flatnonzero(np.asarray(pc.is_valid(drops)))
            if len(changed):
                out = {}
                for i in changed.tolist():
                    digests = set(drops[i].as_py())
                    all_lines = texts[i].as_buffer().to_pybytes().split(b"\n")
                    kept = [x for x in all_lines if not _is_in(key_of(x), digests, least)]
                    dropped[i] = len(all_lines) - len(kept)
                    out[i] = b"\n".join(kept)
                mask = np.zeros(len(texts), bool)
                mask[changed] = True
                new = pa.array([out[i] for i in changed.tolist()], pa.binary()).cast(texts.type)
                texts = pc.replace_with_mask(texts, pa.array(mask), new)
            yield pa.record_batch(
                [part.column("doc_id"), texts, pa.array(lines), pa.array(dropped)],
                ["doc_id", "text", "n_lines", "n_dropped"],
            )


def _is_in(key: bytes, digests: set[bytes], least: int) -> bool:
    return len(key) >= least and _chars(key) >= least and hashlib.sha256(key).digest() in digests


def drop_repeated_lines(
    spark: SparkSession,
    docs: DataFrame,
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
    most_bits: int = FILTER_BITS,
) -> DataFrame:
    """Every document without the lines that at least ``least_docs`` share, but for the one that keeps them.

    ``doc_id, text, n_lines, n_dropped``. The list of lines to drop is joined to the documents by their
    id, and broadcast only where its counted rows are within the limit.
    """
    docs = docs.select("doc_id", "text")
    folder, bits = seen_twice(docs, least_chars, most_bits)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("digest", T.BinaryType())])
    search = partial(_suspect, folder=folder, bits=bits, least=least_chars)
    suspects = written(docs.mapInArrow(search, schema), "lines-suspected")
    repeated = written(repeated_keys(suspects, least_docs), "lines-repeated").select("digest", "last")
    if repeated.count() * 64 <= BROADCAST_LIMIT:
        repeated = F.broadcast(repeated)
    extra = suspects.join(repeated, "digest").filter(~F.col("doc_id").eqNullSafe(F.col("last")))
    lists = written(
        extra.groupBy(F.col("doc_id").alias("of")).agg(F.collect_set("digest").alias("drops")), "lines-dropped"
    )
    rows, digests = lists.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("drops")), F.lit(0))).first()
    if 64 * (rows + digests) <= BROADCAST_LIMIT:
        lists = F.broadcast(lists)
    joined = docs.join(lists, F.col("doc_id").eqNullSafe(F.col("of")), "left").select("doc_id", "text", "drops")
    result = T.StructType([docs.schema["doc_id"]]).add("text", "string").add("n_lines", "long").add("n_dropped", "long")
    return joined.mapInArrow(partial(_drop, least=least_chars), result)
