"""Token ids as Arrow files of equal-length sequences, with their masks and an index of documents.

The ids of all documents, each with an end id, form one stream in ascending ``doc_id`` order. Spark
deals documents out by range; each task encodes its range and writes two Arrow files: sequences of
``SEQUENCE`` ids and of as many mask bits, as fixed-size lists in batches of equal length, and the
documents with their place in the file's own stream. Every batch but the last holds ``BATCH`` sequences,
so sequence *n* of a file is row ``n % BATCH`` of batch ``n // BATCH``: a reader that maps the file gets
it, and its mask, without copying or decoding. A file's last sequence is filled up under a zero mask.
Ids are kept in two bytes where the vocabulary allows.

The manifest has a row per file. Its counts, summed in order, give where each file's ids begin in the
whole stream, so one pass encodes and writes. Only files of the manifest are ever read.

Scale: the texts are shuffled once, for the order; a task holds a batch of texts and of sequences.

Defined cases: a null or empty text is its end id alone. Rows that share an id follow each other by a
hash of the text, and each counts; a null ``doc_id`` comes first. An empty table writes no files and has
no rows. Other columns are left aside. Texts are encoded whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailtide.llm.components import written
from retailtide.llm.files import new_file, random_access, tasks_for
from retailtide.llm.texts import runs, slices
from retailtide.llm.tokens import SLICE_BYTES, encoder
from retailtide.session import shared_folder

SEQUENCE = 2048
BATCH = 256
END_ID = 0
MANIFEST = "shard long, sequences string, documents string, n_docs long, n_tokens long"


class ShardWriter:
    """Writes the sequences and the documents of one range."""

    def __init__(self, folder: str, width: pa.DataType):
        self.kind, self.held, self.n_tokens, self.n_docs = width, [], 0, 0
        self.waiting = 0
        mask = pa.field("mask", pa.list_(pa.bool_(), SEQUENCE))
        self.schema = pa.schema([pa.field("ids", pa.list_(width, SEQUENCE)), mask])
        self.index = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.uri, self._stream = new_file(folder, ".sequences.arrow")
        self.index_uri, self._index_stream = new_file(folder, ".documents.arrow")
        self._file = pa.ipc.new_file(self._stream, self.schema)
        self._index_file = pa.ipc.new_file(self._index_stream, self.index)

    def add(self, doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        """Documents with their ids, end ids included."""
        starts = self.n_tokens + np.cumsum(counts) - counts
        rows = [doc_ids, pa.array(starts, pa.int64()), pa.array(counts, pa.int64())]
        self._index_file.write_batch(pa.RecordBatch.from_arrays(rows, schema=self.index))
        self.n_docs += len(counts)
        self.n_tokens += len(ids)
        self.held.append(ids)
        self.waiting += len(ids)
        whole = SEQUENCE * BATCH
        if self.waiting >= whole:
            joined = np.concatenate(self.held)
            cut = len(joined) // whole * whole
            for at in range(0, cut, whole):
                self._write(joined[at : at + whole], whole)
            self.held, self.waiting = [joined[cut:]], len(joined) - cut

    def _write(self, ids: np.ndarray, used: int) -> None:
        values = pa.array(ids.astype(self.kind.to_pandas_dtype()))
        mask = pa.array(np.arange(len(ids)) < used)
        batch = pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(v, SEQUENCE) for v in (values, mask)], schema=self.schema
        )
        self._file.write_batch(batch)

    def close(self) -> tuple:
        if self.waiting:
            rest = np.concatenate(self.held)
            filled = np.zeros(-(-len(rest) // SEQUENCE) * SEQUENCE, np.uint32)
            filled[: len(rest)] = rest
            self._write(filled, len(rest))
        for f in (self._file, self._stream, self._index_file, self._index_stream):
            f.close()
        return self.uri, self.index_uri, self.n_docs, self.n_tokens


def _with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with an end id after those of each text."""
    out = np.full(len(ids) + len(counts), end_id, np.uint32)
    place = np.repeat(np.cumsum(counts + 1) - counts - 1, counts) + runs(counts)
    out[place] = ids
    return out, counts + 1


def ids_of(path: str) -> int:
    """How many ids a vocabulary file has."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size()


def write(
    docs: DataFrame, path: str, spaced: bool = True, end_id: int = END_ID, wide: bool | None = None
) -> DataFrame:
    """Encode and write; the manifest, a row per file in the order of the stream.

    ``path`` is the vocabulary file; ``wide`` keeps ids in four bytes, which more than 65,536 of them need.
    """
    largest = max(ids_of(path) - 1, end_id)
    if wide is None:
        wide = largest > 0xFFFF
    elif not wide and largest > 0xFFFF:
        raise ValueError(f"ids up to {largest} do not fit two bytes")
    spark = docs.sparkSession
    folder = shared_folder(spark, "tokens")
    width = pa.uint32() if wide else pa.uint16()

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, out = encoder(path, spaced), None
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES, keep=True):
                out = out or ShardWriter(folder, width)
                ids, counts = _with_end(*own.encode(part.column("text")), end_id)
                out.add(part.column("doc_id"), ids, counts)
        if out:
            row = (TaskContext.get().partitionId(), *out.close())
            yield pa.RecordBatch.from_pylist([dict(zip((c.split()[0] for c in MANIFEST.split(", ")), row))])

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    order = ["doc_id", F.xxhash64("text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(ranged.mapInArrow(shard, MANIFEST), "token-manifest")


class StreamReader:
    """The stream of ids of a mapped file, by place; the batch read last is kept."""

    def __init__(self, file):
        self.file, self.number, self.held = file, -1, None

    def _batch(self, number: int) -> np.ndarray:
        if number != self.number:
            self.number, self.held = number, self.file.get_batch(number).column(0).flatten().to_numpy()
        return self.held

    def ids(self, begin: int, end: int) -> np.ndarray:
        parts = []
        while begin < end:
            number, place = divmod(begin, SEQUENCE * BATCH)
            parts.append(self._batch(number)[place : place + end - begin])
            begin += len(parts[-1])
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


def read(manifest: DataFrame, documents_at_once: int = 20_000) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``.

    A file is read by several tasks where it has many documents; each maps it and takes its own part.
    """
    spark = manifest.sparkSession
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))
    parts = based.withColumn(
        "first", F.explode(F.expr(f"sequence(0L, n_docs - 1, {documents_at_once}L)"))
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with pa.ipc.open_file(random_access(row["documents"])) as index:
                    taken, seen = [], 0
                    first, stop = row["first"], min(row["n_docs"], row["first"] + documents_at_once)
                    for number in range(index.num_record_batches):
                        part = index.get_batch(number)
                        low, high = max(first - seen, 0), min(stop - seen, part.num_rows)
                        if low < high:
                            taken.append(part.slice(low, high - low))
                        seen += part.num_rows
                        if seen >= stop:
                            break
                    docs = pa.Table.from_batches(taken).combine_chunks()
                starts, counts = docs["start"].to_numpy(), docs["n_tokens"].to_numpy()
                with pa.ipc.open_file(random_access(row["sequences"])) as file:
                    stream = StreamReader(file)
                    sums = [
                        zlib.crc32(stream.ids(start, start + count).astype("<u4").tobytes())
                        for start, count in zip(starts.tolist(), counts.tolist())
                    ]
                yield pa.RecordBatch.from_arrays(
                    [
                        docs["doc_id"].combine_chunks(),
                        pa.array(starts + row["base"]),
                        pa.array(counts),
                        pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # Rows of the manifest are a few bytes each and would all be read by one task, so the number of tasks
    # comes from the bytes of the files; Spark keeps a number that is given.
    n_parts, tokens = manifest.agg(
        F.sum(F.ceil(F.col("n_docs") / documents_at_once)), F.sum("n_tokens")
    ).first()
    dealt = parts.repartition(tasks_for(spark, n_parts or 0, (tokens or 0) * 4))
    return dealt.mapInArrow(rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def sequence(uri: str, number: int) -> tuple[np.ndarray, np.ndarray]:
    """One sequence of a file and its mask; the ids are a view of the mapped file."""
    with pa.ipc.open_file(random_access(uri)) as file:
        batch = file.get_batch(number // BATCH)
        row = number % BATCH
        return (
            batch.column(0)[row].values.to_numpy(),
            batch.column(1)[row].values.to_numpy(zero_copy_only=False),
        )
