"""Several streaming queries that run as one job."""

from __future__ import annotations

import logging
import time
from collections import defaultdict
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql.streaming import StreamingQuery

log = logging.getLogger(__name__)

Start = Callable[[], StreamingQuery]


class QueryFailed(RuntimeError):
    """A query failed more often than its budget allows."""

    def __init__(self, name: str, problem: Exception):
        super().__init__(f"{name} failed: {problem}")
        self.name, self.problem = name, problem


@dataclass
class Supervised:
    """How often each query was started again, and why."""

    restarts: dict[str, int]
    problems: dict[str, list[str]] = field(default_factory=lambda: defaultdict(list))


def stop_after_batch(query: StreamingQuery, patience: float) -> None:
    """Stop a query between two batches, or within one that takes longer than the patience."""
    until = time.monotonic() + patience
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
        time.sleep(0.05)
    if query.isActive:
        query.stop()


def supervise(
    starts: Mapping[str, Start], budget: int = 3, within: float = 3600.0, patience: float = 300.0, every: float = 0.2,
) -> Supervised:
    """Run all queries until they have ended, and start one that fails again from its checkpoint.

    `starts` holds a function per query that starts it with its own checkpoint. A query may fail `budget` times
    within `within` seconds. At the next failure the others are stopped after their batch, and QueryFailed names the one
    that failed; so does a query that does not start. Queries that end without a failure, such as those that were
    stopped or have used up their input, are not started again, and the job ends with the last of them.
    """
    running: dict[str, StreamingQuery] = {}
    failures: dict[str, list[float]] = defaultdict(list)
    outcome = Supervised({name: 0 for name in starts})

    def failed(name: str, problem: Exception) -> None:
        now = time.monotonic()
        failures[name] = [at for at in failures[name] if now - at < within] + [now]
        outcome.problems[name].append(str(problem))
        if len(failures[name]) > budget:
            for query in running.values():
                stop_after_batch(query, patience)
            raise QueryFailed(name, problem)
        log.warning("%s failed and is started again: %s", name, problem)
        outcome.restarts[name] += 1

    def begin(name: str) -> None:
        while name not in running:
            try:
                running[name] = starts[name]()
            except Exception as problem:  # noqa: BLE001 (whatever keeps a query from starting counts as its failure)
                failed(name, problem)

    for name in starts:
        begin(name)
    while running:
        for name, query in list(running.items()):
            if not query.isActive:
                del running[name]
                problem = query.exception()
                if problem is not None:
                    failed(name, problem)
                    begin(name)
        time.sleep(every if running else 0)
    return outcome
