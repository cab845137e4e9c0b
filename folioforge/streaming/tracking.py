"""Following streaming queries: callbacks on their states and updates, and a saved state when they end.

The numbers come from ``observe`` on the stream's rows, so they are counted where
the rows are.  Callbacks run on the driver, one after the other; one that fails is
logged and stops nothing.
"""

from __future__ import annotations

import logging
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger(__name__)
#: States after which nothing more happens: only then a state is saved.
ENDED = ("completed", "failed")


def observed(stream: DataFrame, name: str, failed: Column) -> DataFrame:
    """``stream`` with counts of its rows, and of those that failed, reported with each micro-batch under ``name``."""
    return stream.observe(name, F.count(F.lit(1)).alias("rows"), F.count_if(F.coalesce(failed, F.lit(False))).alias("failed"))


class Tracker(StreamingQueryListener):
    """State of the queries that report under ``name``: running, then completed or failed; rows and failed rows so far.

    save: called once with (query name, state as a dict) when a query has ended, for
    instance ``Checkpoints.save``.
    """

    def __init__(self, name: str, save: Callable[[str, dict], None] | None = None):
        self.name, self.save = name, save
        self.states: dict[str, dict] = {}
        self._on_state: dict[str, list[Callable[[dict], None]]] = defaultdict(list)
        self._on_update: list[Callable[[dict], None]] = []

    def on_state(self, state: str, callback: Callable[[dict], None]) -> None:
        self._on_state[state].append(callback)

    def on_update(self, callback: Callable[[dict], None]) -> None:
        self._on_update.append(callback)

    def remove(self, callback: Callable[[dict], None]) -> bool:
        """Take a callback out; False if it was not there."""
        found = False
        for calls in (self._on_update, *self._on_state.values()):
            while callback in calls:
                calls.remove(callback)
                found = True
        return found

    def _call(self, calls: list[Callable[[dict], None]], state: dict) -> None:
        for call in list(calls):
            try:
                call(dict(state))
            except Exception:
                log.exception("a callback failed")

    def _enter(self, run: str, state: str) -> None:
        own = self.states.setdefault(run, {"query": None, "rows": 0, "failed": 0})
        own["state"] = state
        self._call(self._on_state[state], own)
        if state in ENDED and self.save:
            self._call([lambda s: self.save(s["query"] or run, s)], own)

    def onQueryStarted(self, event) -> None:
        self.states[str(event.runId)] = {"query": event.name, "rows": 0, "failed": 0}
        self._enter(str(event.runId), "running")

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = progress.observedMetrics.get(self.name)
        own = self.states.get(str(progress.runId))
        if row is not None and own is not None:
            own["rows"] += row["rows"]
            own["failed"] += row["failed"]
            self._call(self._on_update, own)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        own = self.states.setdefault(str(event.runId), {"query": None, "rows": 0, "failed": 0})
        if event.exception:
            own["error"] = str(event.exception).splitlines()[0][:500]
        self._enter(str(event.runId), "failed" if event.exception else "completed")
