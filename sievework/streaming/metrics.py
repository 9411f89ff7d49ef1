"""Progress callbacks fed by the metrics of a running query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

METRICS = "run_metrics"


def with_run_metrics(df: DataFrame, condition: Column) -> DataFrame:
    """Observe how many rows satisfy ``condition`` and how many pass in all."""
    return df.observe(METRICS, F.count_if(condition).alias("processed"), F.count("*").alias("rows"))


class RunningTotals:
    """Callbacks of one batch after the other, told as totals since the start; a stage's count never falls."""

    def __init__(self, on_total: Callable[[int], None] | None, on_progress: Callable[[str, int], None] | None) -> None:
        self._on_total = on_total
        self._on_progress = on_progress
        self._rows = 0
        self._before: dict[str, int] = {}
        self._now: dict[str, int] = {}

    def next_batch(self) -> None:
        self._before = self._now.copy()

    def total(self, rows: int) -> None:
        self._rows += rows
        self._on_total(self._rows)

    def progress(self, stage: str, processed: int) -> None:
        self._now[stage] = self._before.get(stage, 0) + processed
        self._on_progress(stage, self._now[stage])


class ProgressListener(StreamingQueryListener):
    """Calls ``on_progress(stage, processed)`` and ``on_total(rows)`` with running totals of a query."""

    def __init__(
        self,
        stage: str,
        on_progress: Callable[[str, int], None],
        on_total: Callable[[int], None] | None = None,
    ) -> None:
        self._stage = stage
        self._on_progress = on_progress
        self._on_total = on_total
        self._processed = 0
        self._rows = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(METRICS)
        if row is None:
            return
        self._processed += row["processed"]
        self._rows += row["rows"]
        if self._on_total:
            self._on_total(self._rows)
        self._on_progress(self._stage, self._processed)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
