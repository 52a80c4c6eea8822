"""Progress lines of running streams."""

import json
import logging

from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger("auditlake.progress")


class ProgressLog(StreamingQueryListener):
    """Logs one JSON line of rates per micro-batch; add it with `spark.streams.addListener`."""

    def onQueryStarted(self, event):
        log.info(json.dumps({"query": event.name, "state": "started"}))

    def onQueryProgress(self, event):
        p = event.progress
        log.info(json.dumps({
            "query": p.name, "batch": p.batchId, "rows": p.numInputRows,
            "rows_per_second": p.processedRowsPerSecond, "duration_ms": p.durationMs,
            "observed": {k: v.asDict() for k, v in (p.observedMetrics or {}).items()},
        }))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        log.info(json.dumps({"query": str(event.id), "state": "stopped"}))
