"""What a running stream reports."""

from __future__ import annotations

import logging

from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

log = logging.getLogger("ordermetrics")


def rows_dropped_late(query: StreamingQuery) -> int:
    """Aggregated rows dropped as too late, over the progress records the query still holds."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def observed(query: StreamingQuery, name: str = "orders") -> dict[str, int]:
    """Counts of :func:`~ordermetrics.operators.parse.counted`, summed over the progress records."""
    totals: dict[str, int] = {}
    for progress in query.recentProgress:
        if name in progress.observedMetrics:
            for key, value in progress.observedMetrics[name].asDict().items():
                totals[key] = totals.get(key, 0) + value
    return totals


class ProgressLog(StreamingQueryListener):
    """Log the outcome of each micro-batch: rows in, state size, rows dropped late."""

    def onQueryStarted(self, event):
        log.info("%s started", event.name)

    def onQueryProgress(self, event):
        progress = event.progress
        state = progress.stateOperators
        log.info(
            "%s batch %s: %s rows in, %s state rows, %s dropped late",
            progress.name, progress.batchId, progress.numInputRows,
            sum(s.numRowsTotal for s in state),
            sum(s.numRowsDroppedByWatermark for s in state),
        )
        for name, counts in progress.observedMetrics.items():
            log.info("%s batch %s, %s: %s", progress.name, progress.batchId, name, ", ".join(
                f"{value} {key}" for key, value in counts.asDict().items()))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.exception:
            log.error("stream failed: %s", event.exception)
