"""What a stream did (ST11, ST12): rows read, groups dropped behind the
watermark and observed checks, from the progress events of its micro-batches."""

from __future__ import annotations

import threading
from collections import Counter, defaultdict

from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


class ProgressLog(StreamingQueryListener):
    """Adds up the progress of every run of every query.

    ``totals[run id]`` holds ``batches``, ``input_rows``, ``dropped`` (rows that
    stateful operators refused as late; behind an aggregate these are groups)
    and ``name.metric`` of observed metrics.  Counters only: its size does not
    grow with the stream."""

    def __init__(self):
        self.totals: dict[str, Counter] = defaultdict(Counter)
        self._over: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p, mine = event.progress, self.totals[str(event.progress.runId)]
        mine["batches"] += 1
        mine["input_rows"] += p.numInputRows
        mine["dropped"] += sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        for name, row in (p.observedMetrics or {}).items():
            for metric, value in row.asDict().items():
                mine[f"{name}.{metric}"] += value or 0

    def onQueryTerminated(self, event) -> None:
        self._over[str(event.runId)].set()

    def finished(self, query: StreamingQuery, seconds: float = 60) -> Counter:
        """Waits for the query and for its last event; the totals of the run."""
        query.awaitTermination()
        if not self._over[str(query.runId)].wait(seconds):
            raise TimeoutError("the query's termination event did not arrive")
        return self.totals[str(query.runId)]
