"""Streams that run as a service: waiting for all of them, and a record of their micro-batches."""

from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming import StreamingQueryListener

from marketpulse.schemas import STREAM_AUDIT
from marketpulse.streaming.ticks import WRITTEN


def watch(spark, running, poll=5):
    """Wait until all of `running` ({name: query}) have ended. If one fails, the others are
    stopped and its error is raised; started again, all go on from their checkpoints.

    `poll` is how many seconds at most pass before a failure shows that came while
    another query of the session ended.
    """
    try:
        while any(q.isActive for q in running.values()):
            failed = [q for q in running.values() if not q.isActive and q.exception()]
            if failed:
                raise failed[0].exception()
            spark.streams.resetTerminated()
            if all(q.isActive for q in running.values()) or not any(q.exception() for q in running.values()):
                try:
                    spark.streams.awaitAnyTermination(poll)
                except StreamingQueryException:
                    pass  # one of ours shows at the next look; others of the session are not ours
        failed = [q.exception() for q in running.values() if q.exception()]
        if failed:
            raise failed[0]
    finally:
        for query in running.values():
            query.stop()


class StreamAudit(StreamingQueryListener):
    """Writes what each micro-batch read, wrote and dropped to a table of STREAM_AUDIT rows.

    Rows are kept until there are `every` of them or a stream ends, and then added as one
    file. `names` ({query id: name}) are the names to write; else it is the query's own.
    """

    def __init__(self, spark, path, names=None, every=100):
        self.spark, self.path, self.names, self.every = spark, path, dict(names or {}), every
        self.rows = []

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        written = p.observedMetrics.get(WRITTEN)
        self.rows.append((
            self.names.get(str(p.id), p.name or str(p.id)), str(p.runId), p.batchId,
            sum(s.numInputRows for s in p.sources), written.rows if written else None,
            sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
            sum(s.numRowsTotal for s in p.stateOperators),
            datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")),
        ))
        if len(self.rows) >= self.every:
            self.flush()

    def onQueryTerminated(self, event):
        self.flush()

    def flush(self):
        rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, STREAM_AUDIT).coalesce(1).write.mode("append").parquet(self.path)

    def __enter__(self):
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error):
        """Events come after the fact: wait for those that are on their way."""
        self.spark._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)
        self.flush()
