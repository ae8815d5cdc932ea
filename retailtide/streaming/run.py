"""Starting a query: one name, one checkpoint, one output."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

# Fixed value: how often the log reports are emitted.
EMIT_EVERY = "5 minutes"

# Fixed value: how often the order jobs run a batch.
ORDERS_EVERY = "5 seconds"


@dataclass(frozen=True)
class Running:
    """Where checkpoints live and how often batches run.

    Each query keeps its checkpoint in a folder of its own name, so a restarted job finds
    its offsets and state again; a changed stateful plan needs a new name.
    """

    checkpoints: str
    trigger: dict = field(default_factory=lambda: {"processingTime": EMIT_EVERY})


def running_orders(checkpoints: str) -> Running:
    """For the order jobs, whose batches are short."""
    return Running(checkpoints, {"processingTime": ORDERS_EVERY})


def start(
    df: DataFrame,
    name: str,
    mode: str,
    each_batch: Callable[[DataFrame, int], None],
    running: Running,
) -> StreamingQuery:
    return (
        df.writeStream.outputMode(mode)
        .queryName(name)
        .option("checkpointLocation", f"{running.checkpoints.rstrip('/')}/{name}")
        .trigger(**running.trigger)
        .foreachBatch(each_batch)
        .start()
    )


def finish(*queries: StreamingQuery) -> None:
    """Wait for queries that end by themselves (``availableNow``); errors are raised."""
    for query in queries:
        query.awaitTermination()


class LateRows(StreamingQueryListener):
    """Counts the rows that each query, by name, has dropped behind its watermark.

    Add it to ``spark.streams`` before the queries start: it sees every progress report, while a
    query itself holds only the last hundred.
    """

    def __init__(self):
        self.by_query: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.by_query.setdefault(event.name, 0)

    def onQueryProgress(self, event) -> None:
        dropped = sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)
        name = event.progress.name
        self.by_query[name] = self.by_query.get(name, 0) + dropped

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
