"""New landing files as a stream: each attempt at a batch is a run.

A batch that fails is replayed by the engine with the same id and the same files. Each
attempt has a run id of its own, made of the query's persistent id, the batch and a count,
and so a row of its own in the run log. The batch has one folder, which the attempts
overwrite in turn until one has succeeded; from then on the batch is done, and a replay
copies nothing. Readers take a folder when an attempt at it has succeeded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession

from tidemark.model import RUNNING, SUCCEEDED
from tidemark.operators.copies import Counts, copy_frame, run_folder
from tidemark.operators.journals import attempt_id, attempts
from tidemark.operators.store import ControlStore
from tidemark.plans.ingest import Clock, RunLog, utc_now
from tidemark.sources.raw import raw_text
from tidemark.sources.readers import FileSpec
from tidemark.sources.zones import zone


def landing_stream(spark: SparkSession, spec: FileSpec) -> DataFrame:
    """The text of files as they arrive.

    A large backlog is cut into batches with `maxFilesPerTrigger` in the spec's
    options.
    """
    return raw_text(spark.readStream, spec)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that owns a checkpoint: its own for each new checkpoint, the
    same after each restart."""
    return spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def ingest_new_files(
    store: ControlStore,
    source: Row,
    spec: FileSpec,
    checkpoint: str,
    clock: Clock = utc_now,
) -> dict[str, Counts]:
    """Copy all files that arrived since the last call; counts per run.

    A call that finds nothing new is logged as a run without rows.
    """
    done: dict[str, Counts] = {}

    def copy_batch(batch: DataFrame, batch_id: int) -> None:
        name = f"{query_id(store.spark, checkpoint)}-{batch_id}"
        earlier = attempts(store.journal("ingestion_run"), name)
        for row in earlier:
            if row.Status == SUCCEEDED:  # the stream stopped before it noted that
                done[row.RunId] = Counts(row.RowsRead, row.RowsCopied)
                return
        run_id = attempt_id(name, len(earlier) + 1)
        for row in earlier:
            if row.Status == RUNNING:  # its driver was lost
                RunLog.of(store, source, row, clock).fail(
                    RuntimeError(f"abandoned; taken up by {run_id}")
                )
        run = RunLog(store, source, None, clock, run_id)
        run.start(None, None)
        try:
            counts = copy_frame(
                batch,
                spec,
                run_folder(
                    zone(store.base, source.DestinationContainer),
                    source.DestinationFolder,
                    name,
                ),
                run_folder(zone(store.base, "rejected"), source.DestinationFolder, name),
            )
        except Exception as error:
            run.fail(error)
            raise  # the batch stays uncommitted and is replayed
        run.complete(counts, None)
        done[run_id] = counts

    query = (
        landing_stream(store.spark, spec)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(copy_batch)
        .start()
    )
    query.awaitTermination()
    if not done:
        empty = RunLog(store, source, None, clock)
        empty.start(None, None)
        empty.complete(Counts(0, 0), None)
        done[empty.run_id] = Counts(0, 0)
    return done
