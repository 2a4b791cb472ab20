"""How far a run is, told while it goes on."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from threading import Event, Thread

from pyspark.sql import SparkSession

from annoflow.plans import ledger as ledgers


@contextmanager
def watched(
    spark: SparkSession, ledger: str, run_id: str, tell: Callable[[dict], None], total: int | None = None, every: float = 10.0
) -> Iterator[None]:
    """Call ``tell`` every so many seconds, and once at the end, for a run that the block makes.

    It is told the tasks done and known so far of all jobs that the block has started, which move within one
    slice, and the counts of ``ledger.live_progress``, which move with each slice or stream batch that is
    committed. What ``tell`` raises ends the telling, not the run.
    """
    context = spark.sparkContext
    group, before = f"watched-{uuid.uuid4().hex}", context.getLocalProperty("spark.jobGroup.id")
    over = Event()

    def look() -> dict:
        tracker, done, known = context.statusTracker(), 0, 0
        for job in tracker.getJobIdsForGroup(group):
            info = tracker.getJobInfo(job)
            for stage in info.stageIds if info else ():
                found = tracker.getStageInfo(stage)
                if found:
                    done, known = done + found.numCompletedTasks, known + found.numTasks
        counts = ledgers.live_progress(ledgers.read_ledger(spark, ledger), run_id, total)
        return {"tasks_done": done, "tasks": known, **counts}

    def watch() -> None:
        while not over.wait(every):
            tell(look())

    watcher = Thread(target=watch, daemon=True)
    context.setJobGroup(group, f"run {run_id}")
    watcher.start()
    try:
        yield
    finally:
        over.set()
        watcher.join()
        context.setLocalProperty("spark.jobGroup.id", before)
        tell(look())
