"""Several streaming queries that live and die together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql.streaming import StreamingQuery


def run_together(queries: Sequence[StreamingQuery], poll_seconds: float = 1.0) -> None:
    """Wait until all queries have ended.

    If one fails, whichever it is, the others are stopped and its error is raised; so a failure is
    seen while the others would run on. Queries that end by themselves are no failure. Whatever else
    interrupts the wait stops all queries too.
    """
    waiting = list(queries)
    try:
        while waiting:
            # Each gets its share of the wait; a failed query raises its error here.
            waiting = [q for q in waiting if not q.awaitTermination(poll_seconds / len(waiting))]
    except BaseException:
        for query in queries:
            if query.isActive:
                query.stop()
        raise
