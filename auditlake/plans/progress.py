"""Progress lines of a batch run, while it runs."""

import json
import logging
import threading
import time
from contextlib import contextmanager

from pyspark.sql import SparkSession

log = logging.getLogger("auditlake.progress")
GROUP = "spark.jobGroup.id"


class RunProgress:
    """What a run's jobs have done so far, from Spark's own status of the run's job group.

    `step` names what the run is at; `facts` are numbers known beforehand, such as its files.
    """

    def __init__(self, spark: SparkSession, run_id: str, group: str, before: set[int]):
        self.tracker = spark.sparkContext.statusTracker()
        self.run_id, self.group, self.before = run_id, group, before
        self.name, self.facts, self.began = "start", {}, time.time()
        self.stages: dict[int, tuple[int, int]] = {}

    def step(self, name: str, **facts: int) -> None:
        self.name = name
        self.facts |= facts

    def line(self) -> dict:
        jobs = [j for j in self.tracker.getJobIdsForGroup(self.group) if j not in self.before]
        at = None
        for job in sorted(jobs):
            info = self.tracker.getJobInfo(job)
            for stage in info.stageIds if info else ():
                # Stages that another one's output saved are never there.
                if (s := self.tracker.getStageInfo(stage)) is not None:
                    self.stages[stage] = (s.numCompletedTasks, s.numTasks)
                    at = s.name if s.numActiveTasks else at
        done, tasks = (sum(x) for x in zip(*self.stages.values())) if self.stages else (0, 0)
        seconds = max(time.time() - self.began, 1e-3)
        return {"run": self.run_id, "step": self.name, "stage": at, "seconds": round(seconds, 1), "jobs": len(jobs),
                "tasks": tasks, "tasks_done": done, "tasks_per_second": round(done / seconds, 2), **self.facts}


@contextmanager
def run_progress(spark: SparkSession, run_id: str, seconds: float):
    """Log one JSON line every `seconds` while the block runs, and one at its end; yields a `RunProgress`.

    The block's jobs are told by their job group: the thread's own, as a streaming query has one, or else
    the run's.
    """
    sc = spark.sparkContext
    own = sc.getLocalProperty(GROUP) is None
    if own:
        sc.setLocalProperty(GROUP, run_id)
    group = sc.getLocalProperty(GROUP)
    progress = RunProgress(spark, run_id, group, set(sc.statusTracker().getJobIdsForGroup(group)))
    ended = threading.Event()

    def telling():
        while not ended.wait(seconds):
            log.info(json.dumps(progress.line() | {"state": "running"}))

    thread = threading.Thread(target=telling, daemon=True)
    thread.start()
    state = "failed"
    try:
        yield progress
        state = "done"
    finally:
        ended.set()
        thread.join()
        log.info(json.dumps(progress.line() | {"state": state}))
        if own:
            sc.setLocalProperty(GROUP, None)
