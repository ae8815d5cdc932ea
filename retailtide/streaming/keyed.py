"""Counts per key whose state expires by its last write, emitted on change and by a timer per key.

The state of a key is a count, the members seen (such as users), and the time at which it is due. Count
and members are forgotten a while after they were last written, whatever the day in the key, so no row is
ever refused: one that comes for a key long gone starts a new count. A key's members are one packed value,
each with the time of its last write, read and written once a batch: a call per member costs far more. A key's timer is set when it is first
seen, and again by the first row after it has fired. Rows are counted in the tasks that read them, so a
key with a third of all rows is a few rows when it is shuffled; members are dealt to ``chunks`` keys by a
hash, so that no key holds the members of a hot one whole.

Time here is that of the clock, so Spark runs a batch at every trigger, with or without rows, and timers
fire in it. A run that is to end by itself (``availableNow``) never would; it needs ``NO_DATA_BATCHES`` off,
and what falls due later is emitted by the next run.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from retailtide.workers import ship

# Lives of counts and of members after their last write, and the wait of a key's timer.
COUNT_LIFE = timedelta(days=2)
MEMBER_LIFE = timedelta(days=1)
EVERY = timedelta(minutes=5)


NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def _millis(span: timedelta) -> int:
    return span // timedelta(milliseconds=1)


def _counted(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = pa.Table.from_batches([batch]).group_by(keys).aggregate([([], "count_all")])
        yield from counts.select([*keys, "count_all"]).rename_columns([*keys, "n"]).to_batches()


_NO_MEMBERS = pa.array([], pa.string()), pa.array([], pa.int64())


def _packed(members: pa.Array, at: pa.Array) -> bytes:
    batch = pa.RecordBatch.from_arrays([members, at], ["member", "at"])
    with pa.BufferOutputStream() as out:
        with pa.ipc.new_stream(out, batch.schema) as writer:
            writer.write_batch(batch)
        return out.getvalue().to_pybytes()


def _unpacked(value: bytes) -> pa.Table:
    return pa.ipc.open_stream(value).read_all()


class KeyedCounts(StatefulProcessor):
    """Count, members and timer of one key."""

    def __init__(self, keys: list[str], on_change: bool, count_life: int, member_life: int, every: int | None):
        self.keys, self.on_change, self.every = keys, on_change, every
        self.count_life, self.member_life = count_life, member_life

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "n long", self.count_life)
        self.members = handle.getValueState("members", "data binary", self.member_life)
        self.due = handle.getValueState("due", "at long", self.count_life)

    def _live(self, now: int) -> pa.Table:
        """The members that were written within their life, and when."""
        value = self.members.get()
        known = _unpacked(bytes(value[0]) if value is not None else _packed(*_NO_MEMBERS))
        return known.filter(pc.greater(known["at"], now - self.member_life))

    def _row(self, key, count: int, members: pa.ChunkedArray, periodic: bool) -> pd.DataFrame:
        names = members.take(pc.sort_indices(members)).to_numpy()
        return pd.DataFrame([(*key, count, names, periodic)], columns=[*self.keys, "count", "members", "periodic"])

    def handleInputRows(self, key, rows, timerValues):
        added, frames = 0, []
        for frame in rows:
            added += int(frame["n"].sum())
            frames.append(pa.array(frame["member"], pa.string(), from_pandas=True))
        now = timerValues.getCurrentProcessingTimeInMs()
        before = self.count.get()
        count = (before[0] if before is not None else 0) + added
        self.count.update((count,))
        written = pc.unique(pa.chunked_array(frames, pa.string()).drop_null())
        live = None
        if len(written):
            live = self._live(now)
            others = live.filter(pc.invert(pc.is_in(live["member"], written)))
            written = pa.table([written, pa.array(np.full(len(written), now))], ["member", "at"])
            live = pa.concat_tables([others, written]).combine_chunks()
            self.members.update((_packed(*(c.combine_chunks() for c in live.columns)),))
        due = self.due.get() if self.every is not None else None
        if self.every is not None and (due is None or now >= due[0]):
            self.handle.registerTimer(now + self.every)
            self.due.update((now + self.every,))
        if self.on_change:
            yield self._row(key, count, (self._live(now) if live is None else live)["member"], False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        count = self.count.get()
        if count is not None:
            members = self._live(timerValues.getCurrentProcessingTimeInMs())["member"]
            yield self._row(key, count[0], members, True)

    def close(self) -> None:
        pass


def keyed_counts(
    rows: DataFrame,
    keys: list[str],
    member: str | None = None,
    on_change: bool = True,
    every: timedelta | None = EVERY,
    count_life: timedelta = COUNT_LIFE,
    member_life: timedelta = MEMBER_LIFE,
    chunks: int = 16,
) -> DataFrame:
    """A stream of ``keys, chunk, count, members, periodic``: rows per key so far, as they change or fall due.

    With a ``member`` column a key has up to ``chunks`` rows, whose counts and members add up; null and
    empty members are counted but not listed. Write it in update mode.
    """
    ship(rows.sparkSession)
    named = F.nullif(F.col(member).cast("string"), F.lit("")) if member else F.lit(None).cast("string")
    chunk = F.coalesce(F.pmod(F.xxhash64("member"), F.lit(chunks)), F.lit(0)).cast("int")
    wide = rows.select(*keys, named.alias("member")).withColumn("chunk", chunk)
    columns = [*keys, "chunk", "member"]
    counted = T.StructType([wide.schema[c] for c in columns]).add("n", "long")
    sums = wide.select(columns).mapInArrow(partial(_counted, keys=columns), counted)
    result = T.StructType([wide.schema[c] for c in [*keys, "chunk"]]).add("count", "long")
    result.add("members", T.ArrayType(T.StringType())).add("periodic", "boolean")
    return sums.groupBy(*keys, "chunk").transformWithStateInPandas(
        statefulProcessor=KeyedCounts(
            [*keys, "chunk"], on_change, _millis(count_life), _millis(member_life), None if every is None else _millis(every)
        ),
        outputStructType=result,
        outputMode="Update",
        timeMode="ProcessingTime",
    )
