"""Near-duplicate documents: MinHash bands, Odd sketches, and an exact check of every link.

A document is the set of its distinct runs of ``SHINGLE`` words (with fewer words, the whole sequence is
its one member); documents are linked where ``100 * common >= 75 * united``. Texts with equal sets are
one class, found by hash, so exact copies never meet pairwise. Each class has 128 MinHash samples:

* 32 bands of 4 samples each put a class into 32 buckets; a pair at the threshold misses all of them
  with a chance of about five in a million;
* folded into an Odd sketch, a parity bitmap of 512 bits, two classes' samples are compared by the
  population count of an XOR, which estimates high similarities well. Pairs beyond ``MAX_ODD`` odd bits
  (4.5 standard deviations under the threshold) are not checked further.

Linking never emits all pairs of a group. First each class is checked against one class that is the
smallest of a bucket of both, and components are formed. Pairs of one component need no check; only
buckets that still hold several components are searched for links across components, in tiles of bounded
size: sketches first tell which members have a close one in another component, and only these bring
their sets. A tile's close pairs are then checked, the closest first, and a pair is passed over once its
components have met, so a tile returns a few links where all its members are alike. Every check counts
the common members of the whole sets. Then components are formed again.

Scale: one pass over the texts makes signatures of about 350 bytes a row; then shuffles hold ids,
band keys and sketches. Only texts of candidates are read again. Hot buckets and classes are summed
before their shuffle, or their joins are split by adaptive execution; nothing is collected.

Defined cases: texts that are null, empty or without words have no members and link with nothing; a
row without ``doc_id`` links with nothing, has no component and is kept. Rows that share an id are one
document, linked through all their texts, and each is returned. An empty table gives no rows. Other
columns are left aside.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailtide.llm.components import components, unused, written
from retailtide.llm.texts import Texts, mix, runs, slices, window_hashes
from retailtide.operators.bounded import broadcast_if_small

SHINGLE = 5
BANDS, BAND_SAMPLES = 32, 4
SAMPLES = BANDS * BAND_SAMPLES
SKETCH_BITS = 512
MAX_ODD = 92
PERCENT = 75
ID_BYTES = 16 * 1024 * 1024
TILE = 512
_ROWS_AT_ONCE = 1000
#: Members of a set are hashes of this many bits, so that a row number fits above them.
_MEMBER_BITS = np.uint64(54)
_PAIRS_AT_ONCE = 100_000

_seeded = np.random.Generator(np.random.PCG64(97))
_FACTORS = _seeded.integers(1, 2**63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _seeded.integers(0, 2**63, SAMPLES, dtype=np.uint64)
_BIT_SALTS = mix(_SHIFTS + np.uint64(1))


def members(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct members of each text's set: row numbers and hashes, sorted by both."""
    t = Texts(column, lower=True)
    words = t.hashes()
    keys = []
    for width in range(1, SHINGLE + 1):
        which = t.n_words >= SHINGLE if width == SHINGLE else t.n_words == width
        if not which.any():
            continue
        counts = np.where(which, t.n_words - width + 1, 0)
        at = np.repeat(t.first[:-1], counts) + runs(counts)
        row = np.repeat(np.arange(len(t), dtype=np.uint64), counts)
        hashes = mix(window_hashes(words, width)[at] + np.uint64(width))
        keys.append((row << _MEMBER_BITS) | (hashes >> (np.uint64(64) - _MEMBER_BITS)))
    key = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
    return (key >> _MEMBER_BITS).astype(np.int64), key & ((np.uint64(1) << _MEMBER_BITS) - np.uint64(1))


def signatures_of(column: pa.Array) -> dict[str, np.ndarray]:
    """Set size, two words that name the set, band keys and Odd sketch of each text."""
    row, member = members(column)
    n = np.bincount(row, minlength=len(column))
    some = np.flatnonzero(n)
    first = np.searchsorted(row, some)
    names = np.zeros((len(column), 2), np.uint64)
    bands = np.zeros((len(column), BANDS), np.uint64)
    odd = np.zeros((len(column), SKETCH_BITS), np.uint8)
    if len(some):
        for j, salt in enumerate((0x5BF0_3635, 0x27D4_EB2F)):
            names[some, j] = np.add.reduceat(mix(member + np.uint64(salt)), first)
        spread = mix(member)
        for i in range(SAMPLES):
            least = np.minimum.reduceat(spread * _FACTORS[i] + _SHIFTS[i], first)
            band = i // BAND_SAMPLES
            bands[some, band] = mix(bands[some, band] * np.uint64(31) + least + np.uint64(band))
            bit = mix(least ^ _BIT_SALTS[i]) % np.uint64(SKETCH_BITS)
            odd[some, bit.astype(np.int64)] ^= 1
    return {"n": n, "names": names, "bands": bands, "sketch": np.packbits(odd, axis=1).view(np.uint64)}


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS_AT_ONCE):
            yield from slices(batch.slice(start, _ROWS_AT_ONCE), "text")


def _longs(table: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(table).view(np.int64).ravel())
    return pa.ListArray.from_arrays(np.arange(0, table.size + 1, table.shape[1], dtype=np.int32), flat)


_SIGNATURE = "doc_id long, n_shingles long, name1 long, name2 long, bands array<long>, sketch array<long>"


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _parts(batches):
        made = signatures_of(part.column("text"))
        names = made["names"].view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                pa.array(made["n"].astype(np.int64)),
                pa.array(names[:, 0].copy()),
                pa.array(names[:, 1].copy()),
                _longs(made["bands"]),
                _longs(made["sketch"]),
            ],
            ["doc_id", "n_shingles", "name1", "name2", "bands", "sketch"],
        )


def _member_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _parts(batches):
        row, member = members(part.column("text"))
        ends = np.searchsorted(row, np.arange(len(part) + 1)).astype(np.int32) * 8
        sets = pa.Array.from_buffers(
            pa.binary(), len(part), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(member))]
        )
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), sets], ["doc_id", "members"])


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets, as sorted arrays, meet the threshold."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < PERCENT * large:
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= PERCENT * (len(both) - common)


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose whole sets meet the threshold."""
    for batch in batches:
        pairs = zip(batch.column("set_a"), batch.column("set_b"))
        linked = [alike(*(np.frombuffer(v.as_buffer(), np.uint64) for v in pair)) for pair in pairs]
        yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))


def odd_bits(a: str, b: str) -> Column:
    """How many bits differ between two sketches."""
    counts = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(counts, F.lit(0), lambda total, n: total + n)


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of whole tiles, and where each tile begins.

    Rows come sorted by tile; a tile that a batch breaks off is carried on to the next.
    """
    rest = None
    for batch in batches:
        if rest is not None and rest.num_rows:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        changes = np.zeros(batch.num_rows, bool)
        changes[:1] = True
        for name in _TILE_KEY:
            column = batch.column(name).to_numpy()
            changes[1:] |= column[1:] != column[:-1]
        last = int(np.flatnonzero(changes)[-1]) if len(changes) else 0
        if last:
            yield batch.slice(0, last), changes[:last]
        rest = batch.slice(last)
    if rest is not None and rest.num_rows:
        yield rest, np.arange(rest.num_rows) == 0


def _close_pairs(batch: pa.RecordBatch, begins: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Rows of one tile, of different components, whose sketches are close; with their odd bits.

    Tiles off the diagonal pair the rows of one part with those of the other.
    """
    start = np.flatnonzero(begins)
    end = np.append(start[1:], batch.num_rows)
    counts = np.repeat(end, end - start) - np.arange(batch.num_rows) - 1
    sketch = batch.column("sketch").flatten().to_numpy().view(np.uint64).reshape(batch.num_rows, -1)
    component, part = batch.column("component").to_numpy(), batch.column("part").to_numpy()
    diagonal = batch.column("row_part").to_numpy() == batch.column("col_part").to_numpy()
    total = np.cumsum(counts)
    at = 0
    while at < batch.num_rows:
        base = total[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(total, base + _PAIRS_AT_ONCE, side="right")))
        left = np.repeat(np.arange(at, stop), counts[at:stop])
        right = left + 1 + runs(counts[at:stop])
        use = (component[left] != component[right]) & (diagonal[left] | (part[left] != part[right]))
        left, right = left[use], right[use]
        odd = np.bitwise_count(sketch[left] ^ sketch[right]).sum(1)
        near = odd <= MAX_ODD
        yield left[near], right[near], odd[near]
        at = stop


def _involved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of tiles that have a close row in another component."""
    for batch, begins in _tiles(batches):
        marked = np.zeros(batch.num_rows, bool)
        for left, right, _ in _close_pairs(batch, begins):
            marked[left] = marked[right] = True
        if marked.any():
            yield batch.filter(pa.array(marked))


def _cross_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Checked links between components; of components that have met in this task, no more."""
    above: dict[int, int] = {}

    def root(c: int) -> int:
        while above.get(c, c) != c:
            above[c] = c = above.get(above[c], above[c])
        return c

    for batch, begins in _tiles(batches):
        ids, component = batch.column("rep").to_pylist(), batch.column("component").to_pylist()
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column("members")]
        found = []
        for left, right, odd in _close_pairs(batch, begins):
            order = np.argsort(odd, kind="stable")
            for i, j in zip(left[order].tolist(), right[order].tolist()):
                x, y = root(component[i]), root(component[j])
                if x != y and alike(sets[i], sets[j]):
                    above[max(x, y)] = min(x, y)
                    found.append((ids[i], ids[j]))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])


_TILE_KEY = ("key", "row_part", "col_part")
_TILE_ROW = (
    "key long, row_part int, col_part int, rep long, component long, part int, sketch array<long>"
)


class Linker:
    """The stages of linking over one table; each writes what later stages read more than once."""

    def __init__(self, spark: SparkSession, docs: DataFrame):
        self.spark = spark
        self.texts = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
        )
        self.signatures = written(self.texts.mapInArrow(_signed, _SIGNATURE), "signatures")
        identified = self.signatures.filter("n_shingles > 0 and doc_id is not null")
        self.classes = written(
            identified.groupBy("name1", "name2").agg(
                F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
            ),
            "classes",
        )
        self.sets = None

    def bucket_members(self) -> DataFrame:
        """``key, rep, hub`` of every bucket with several classes; the hub is its smallest id."""
        placed = self.classes.select("rep", F.explode("bands").alias("key"))
        hubs = placed.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("last"))
        return written(placed.join(hubs.filter("hub <> last").drop("last"), "key"), "members")

    def star_pairs(self, held: DataFrame) -> DataFrame:
        """For each class the hub with the closest sketch, if any is close."""
        pairs = held.filter("rep <> hub").groupBy("rep", "hub").agg(F.count("*").alias("shared"))
        sketch = self.classes.select("rep", "sketch")
        near = (
            pairs.join(sketch.withColumnRenamed("sketch", "sketch_b"), "rep")
            .join(sketch.select(F.col("rep").alias("hub"), F.col("sketch").alias("sketch_a")), "hub")
            .withColumn("odd", odd_bits("sketch_a", "sketch_b"))
            .filter(F.col("odd") <= MAX_ODD)
        )
        best = near.groupBy("rep").agg(F.min(F.struct("odd", "hub")).alias("best"))
        return best.select(F.col("best.hub").alias("a"), F.col("rep").alias("b"))

    def cross_rows(self, held: DataFrame, found: DataFrame) -> DataFrame:
        """Members of buckets that have a close member of another component there, by tile."""
        roots = found.withColumnRenamed("node", "rep")
        placed = held.join(roots, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
        open_keys = (
            placed.groupBy("key")
            .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"))
            .filter("low <> high")
            .select("key", F.ceil(F.col("size") / TILE).cast("int").alias("parts"))
        )
        sketch = self.classes.select("rep", "sketch")
        rows = placed.join(open_keys, "key").join(sketch, "rep")
        part = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
        tiles = F.transform(
            F.sequence(F.lit(0), F.col("parts") - 1),
            lambda other: F.struct(
                F.least(F.col("part"), other).alias("row_part"), F.greatest(F.col("part"), other).alias("col_part")
            ),
        )
        rows = rows.withColumn("part", part).select("key", "rep", "component", "part", "sketch", F.inline(tiles))
        return written(self._by_tile(rows).mapInArrow(_involved, _TILE_ROW), "cross")

    @staticmethod
    def _by_tile(rows: DataFrame) -> DataFrame:
        names = [c.split()[0] for c in _TILE_ROW.split(", ")]
        rows = rows.select(*names, *[c for c in rows.columns if c == "members"])
        return rows.repartition(*_TILE_KEY).sortWithinPartitions(*_TILE_KEY)

    def cross_links(self, rows: DataFrame) -> DataFrame:
        """Links between components, checked on the whole sets."""
        sets = self._sets_of(rows.select(F.col("rep").alias("doc_id")))
        with_sets = rows.join(sets.withColumnRenamed("doc_id", "rep"), "rep")
        return self._by_tile(with_sets).mapInArrow(_cross_links, "a long, b long").distinct()

    def _sets_of(self, ids: DataFrame) -> DataFrame:
        """The sets of the texts with these ids, each made once."""
        ids = ids.distinct()
        if self.sets is not None:
            ids = ids.join(self.sets.select("doc_id"), "doc_id", "left_anti")
        texts = self.texts.join(broadcast_if_small(ids, ID_BYTES), "doc_id", "left_semi")
        fresh = written(texts.mapInArrow(_member_lists, "doc_id long, members binary"), "sets")
        self.sets = fresh if self.sets is None else self.sets.union(fresh)
        return self.sets

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs that the whole sets confirm."""
        sets = self._sets_of(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")))
        rows = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("members").alias("set_b")), "b").join(
            sets.select(F.col("doc_id").alias("a"), F.col("members").alias("set_a")), "a"
        )
        return rows.select("a", "b", "set_a", "set_b").mapInArrow(_checked, "a long, b long").distinct()

    def shared_ids(self) -> DataFrame:
        """Links between the classes of rows that share an id."""
        rows = self.signatures.filter("n_shingles > 0 and doc_id is not null").select("doc_id", "name1", "name2")
        twice = rows.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id")
        return (
            rows.join(twice, "doc_id")
            .join(self.classes.select("name1", "name2", "rep"), ["name1", "name2"])
            .select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
        )

    def run(self) -> DataFrame:
        held = self.bucket_members()
        stars = written(self.star_pairs(held), "pairs")
        links = self.linked(stars).union(self.shared_ids())
        found = components(self.spark, links)
        cross = self.cross_rows(held, found)
        if not cross.isEmpty():
            found = components(self.spark, found.toDF("a", "b").union(self.cross_links(cross)))
        roots = found.withColumnRenamed("node", "rep")
        named = self.classes.select("name1", "name2", "rep").join(roots, "rep", "left").select(
            "name1", "name2", F.coalesce("component", "rep").alias("component_id")
        )
        rows = self.signatures.select("doc_id", "n_shingles", "name1", "name2")
        joined = rows.join(named, ["name1", "name2"], "left")
        own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        component = F.when(F.col("doc_id").isNotNull(), own)
        return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
            "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
        )


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document row: ``doc_id, n_shingles, component_id, kept``."""
    return Linker(spark, docs).run()


def filter_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents that stand for their component, all columns as they came."""
    own = unused(docs, "__id")
    dropped = near_duplicates(spark, docs).filter(~F.col("kept")).select(F.col("doc_id").alias(own)).distinct()
    dropped = written(dropped, "dropped")
    return docs.join(broadcast_if_small(dropped, ID_BYTES), F.col("doc_id") == F.col(own), "left_anti")
