"""One ingestion run of one source, and the loop over all active sources.

Order of writes in a table load: `Running` → bronze → `Succeeded` → history.
The mark is derived from the history, so a crash at any point can only make the
next run read the same rows again; no row is ever skipped. Readers of bronze
keep the folders of succeeded runs only.
"""

from __future__ import annotations

import uuid
from collections import deque
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tidemark.functions import ntz
from tidemark.functions.marks import floor_millis
from tidemark.model import FAILED, RUN_JOURNAL, RUNNING, SUCCEEDED
from tidemark.operators.copies import Counts, copy_file, copy_window, run_folder
from tidemark.operators.journals import complete_runs, fail_runs
from tidemark.operators.registry import SQL_ROUTE, active_sources, route_of
from tidemark.operators.store import ControlStore
from tidemark.operators.windows import next_mark
from tidemark.sources.readers import FileSpec
from tidemark.sources.tables import Bounds, FrameTables, JdbcTables
from tidemark.sources.zones import zone

OpenFile = Callable[[Row], FileSpec]
Clock = Callable[[], datetime]


def utc_now() -> datetime:
    return floor_millis(datetime.now(UTC).replace(tzinfo=None))


@dataclass(frozen=True)
class Outcome:
    """How one run of one source ended; no run id if it could not be recorded."""

    run_id: str | None
    source_id: int
    status: str
    rows_read: int | None = None
    rows_copied: int | None = None
    new_mark: datetime | None = None
    error: str | None = None


class Ingestion:
    """Runs loads against one store.

    `tables` serves the SQL sources; `open_file` gives the file spec of a file
    source from its registry row.
    """

    def __init__(
        self,
        store: ControlStore,
        tables: FrameTables | JdbcTables,
        open_file: OpenFile,
        clock: Clock = utc_now,
    ):
        self.store = store
        self.tables = tables
        self.open_file = open_file
        self.clock = clock

    def run_active(self, workers: int = 4) -> list[Outcome]:
        """One run of every active source, a few at a time.

        Sources do not depend on each other: a failure is recorded for its own
        source and the others go on. Only ids are listed beforehand, in their
        order; a source's row is looked up when its run starts, and one that is
        no longer active by then has no run and no outcome.
        """
        batch = str(uuid.uuid4())
        self.store.save_snapshot()
        listed = active_sources(self.store.registry()).select("SourceObjectId")
        outcomes, waiting = [], deque()
        with ThreadPoolExecutor(max_workers=workers) as pool:
            for (source_id,) in listed.sort("SourceObjectId").toLocalIterator():
                if len(waiting) >= 2 * workers:
                    outcomes.append(waiting.popleft().result())
                waiting.append(pool.submit(self._run_listed, source_id, batch))
            outcomes += [run.result() for run in waiting]
        return [outcome for outcome in outcomes if outcome is not None]

    def _run_listed(self, source_id: int, batch: str) -> Outcome | None:
        try:
            source = self.store.source_row(source_id)
            if source is None or not source.IsActive:
                return None
            return self.run_source(source, batch)
        except Exception as error:  # not even the journal could be written
            return Outcome(None, source_id, FAILED, error=str(error))

    def run_source(self, source: Row, pipeline_run_id: str | None = None) -> Outcome:
        """One run of one source, by its type."""
        run = RunLog(self.store, source, pipeline_run_id, self.clock)
        old, bounds = None, Bounds()
        try:
            sql = route_of(source.SourceType) == SQL_ROUTE
            if sql:
                old = source.LastWatermarkValue
                bounds = self.tables.bounds(source)
        except Exception as error:  # the run is recorded even so
            run.start(old, None)
            return run.fail(error)

        high = bounds.high
        run.start(old, high)
        try:
            if sql:
                window = self.tables.window(source, old, bounds)
                counts = copy_window(window, self._target(source, run.run_id))
            else:
                counts = copy_file(
                    self.store.spark,
                    self.open_file(source),
                    self._target(source, run.run_id),
                    run_folder(
                        zone(self.store.base, "rejected"),
                        source.DestinationFolder,
                        run.run_id,
                    ),
                )
        except Exception as error:
            return run.fail(error)
        return run.complete(counts, next_mark(old, high) if sql else None)

    def _target(self, source: Row, run_id: str) -> str:
        # A container that is not a zone does not exist: the copy fails.
        container = zone(self.store.base, source.DestinationContainer)
        return run_folder(container, source.DestinationFolder, run_id)


class RunLog:
    """The journal rows of one run."""

    def __init__(
        self,
        store: ControlStore,
        source: Row,
        pipeline_run_id: str | None,
        clock: Clock,
        run_id: str | None = None,
    ):
        self.store = store
        self.source = source
        self.clock = clock
        # Made once on the driver: an expression would differ per evaluation.
        self.run_id = run_id or str(uuid.uuid4())
        self.pipeline_run_id = pipeline_run_id

    @classmethod
    def of(cls, store: ControlStore, source: Row, run: Row, clock: Clock) -> RunLog:
        """The log of a run that is in the journal as running."""
        log = cls(store, source, run.PipelineRunId, clock, run.RunId)
        row = {**run.asDict(), "Seq": 1}
        values = tuple(row.get(name) for name in RUN_JOURNAL.names)
        log.running = store.spark.createDataFrame([values], RUN_JOURNAL).coalesce(1)
        return log

    def start(self, old: datetime | None, high: datetime | None) -> None:
        row = {
            "RunId": self.run_id,
            "SourceObjectId": self.source.SourceObjectId,
            "PipelineRunId": self.pipeline_run_id,
            "SourceObjectName": self.source.SourceObjectName,
            "Status": RUNNING,
            "OldWatermarkValue": old,
            "CurrentHighWatermarkValue": high,
            "StartedAt": self.clock(),
            "Seq": 1,
        }
        values = tuple(row.get(name) for name in RUN_JOURNAL.names)
        self.running = self.store.spark.createDataFrame([values], RUN_JOURNAL).coalesce(1)
        self.store.append("ingestion_run", self.running, f"{self.run_id}-1")

    def complete(self, counts: Counts, new_mark: datetime | None) -> Outcome:
        now = self.clock()
        done = complete_runs(
            self.running, ntz(new_mark), F.lit(counts.read), F.lit(counts.copied), ntz(now)
        )
        self._end(done)
        if new_mark is not None and counts.copied:
            self._advance(new_mark, now)
        return Outcome(
            self.run_id,
            self.source.SourceObjectId,
            SUCCEEDED,
            counts.read,
            counts.copied,
            new_mark,
        )

    def fail(self, error: Exception) -> Outcome:
        message = str(error)
        self._end(fail_runs(self.running, F.lit(message), ntz(self.clock())))
        return Outcome(
            self.run_id, self.source.SourceObjectId, FAILED, error=message
        )

    def _end(self, row: DataFrame) -> None:
        self.store.append(
            "ingestion_run", row.withColumn("Seq", F.lit(2)), f"{self.run_id}-2"
        )

    def _advance(self, new_mark: datetime, now: datetime) -> None:
        # Ids only order advances applied at the same instant; one source has
        # one writer, so the clock in microseconds serves.
        history_id = int((now - datetime(1970, 1, 1)).total_seconds() * 1_000_000)
        row = {
            "WatermarkHistoryId": history_id,
            "SourceObjectId": self.source.SourceObjectId,
            "RunId": self.run_id,
            "NewWatermarkValue": new_mark,
            "AppliedAt": now,
        }
        self.store.advance(row)
