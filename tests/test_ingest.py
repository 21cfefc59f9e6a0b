"""Whole runs that write: load, empty, insert, fail, retry, files, streams."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.samples import COUNTRY_CURRENCY, CURRENCY_RATES, DAMAGED_RATES, DAY
from tests.samples import MANUAL_ADJUSTMENTS
from tests.samples import registry, source, source_row, write_samples
from tidemark import model as m
from tidemark.operators.copies import succeeded_only
from tidemark.operators.store import ControlStore
from tidemark.plans import checks, ingest
from tidemark.plans.failure import failure_setup
from tidemark.plans.ingest import Ingestion
from tidemark.sources.readers import FileSpec
from tidemark.sources.tables import FrameTables
from tidemark.streaming.landing import ingest_new_files

ORDERS = "sqlserver/sales_local/dbo/orders"


class Clock:
    def __init__(self):
        self.now = datetime(2026, 2, 1)

    def __call__(self):
        self.now += timedelta(seconds=1)
        return self.now


class World:
    """A store, its tables (which tests may change) and its files."""

    def __init__(self, spark, base):
        self.spark, self.base = spark, base
        self.clock = Clock()
        self.store = ControlStore(spark, base).create()
        self.tables = {}
        self.files = {}
        self.ingestion = Ingestion(
            self.store,
            FrameTables(lambda row: self.tables[row.SourceObjectName]),
            lambda row: self.files[row.SourceObjectName],
            self.clock,
        )

    def register(self, *rows, version=1):
        self.store.save_registry(registry(self.spark, *rows), version)

    def source(self, name="Orders"):
        return self.store.registry().where(F.col("SourceObjectName") == name).first()

    def run(self):
        return self.ingestion.run_active()

    def bronze(self, folder=ORDERS, source_id=3):
        rows = self.spark.read.parquet(f"{self.base}/bronze/{folder}")
        return succeeded_only(rows, self.store.runs(), source_id)


@pytest.fixture
def world(spark, base):
    return World(spark, base)


def state(world):
    return checks.eligibility({3: world.tables["Orders"]}, world.store.registry()).first()


def test_load_empty_insert_fail_retry(spark, world):
    world.register(source_row())
    world.tables["Orders"] = source(spark, DAY[1], DAY[2], None)
    assert state(world).Validation_Status == m.NOT_READY

    (load,) = world.run()
    assert (load.status, load.rows_read, load.rows_copied) == (m.SUCCEEDED, 2, 2)
    assert load.new_mark == DAY[2]
    assert world.source().LastWatermarkValue == DAY[2]
    assert state(world).Validation_Status == m.PASS_EMPTY_READY

    (empty,) = world.run()
    assert (empty.status, empty.rows_copied) == (m.SUCCEEDED, 0)
    assert world.store.history().count() == 1, "an empty run advances nothing"
    assert world.store.runs().count() == 2, "an empty run is logged"

    world.tables["Orders"] = source(spark, DAY[1], DAY[2], DAY[3], None)
    assert state(world).Validation_Status == m.CHANGES_PENDING

    def act(action, version):
        done = failure_setup(
            world.store.registry(), "sales_local", "dbo", "Orders", ORDERS,
            world.clock(), action,
        )
        world.store.save_registry(done.registry, version)

    act(m.PREPARE_FAILURE, 2)
    (failed,) = world.run()
    assert failed.status == m.FAILED
    assert m.FAILURE_CONTAINER in failed.error
    assert world.source().LastWatermarkValue == DAY[2]
    assert world.store.history().count() == 1
    args = (world.store.registry(), world.store.runs(), world.store.history())
    summary = checks.retry_summary(*args, {3: world.tables["Orders"]}).first()
    assert summary.Validation_Status == m.PASS_RETRY
    recorded = checks.failed_run_check(world.store.runs()).first()
    assert recorded.Validation_Status == m.PASS_FAILED_RUN
    assert recorded.OldWatermarkValue == DAY[2]
    assert recorded.CurrentHighWatermarkValue == DAY[3]
    assert recorded.ErrorMessage == failed.error

    act(m.RESTORE_CONFIGURATION, 3)
    (retry,) = world.run()
    assert (retry.status, retry.rows_copied) == (m.SUCCEEDED, 1)
    assert world.source().LastWatermarkValue == DAY[3]
    args = (world.store.registry(), world.store.runs(), world.store.history())
    summary = checks.retry_summary(*args, {3: world.tables["Orders"]}).first()
    assert summary.Validation_Status == m.REVIEW_REQUIRED

    copied = sorted(row.UpdatedAt for row in world.bronze().collect())
    assert copied == [DAY[1], DAY[2], DAY[3]]
    counts = {
        (row.Status, row.Run_Count)
        for row in checks.run_history_summary(world.store.runs()).collect()
    }
    assert counts == {(m.SUCCEEDED, 3), (m.FAILED, 1)}


def test_crash_before_the_mark_only_reads_again(spark, world, monkeypatch):
    """The run succeeded but its history row is lost: at least once, never lost."""
    world.register(source_row())
    world.tables["Orders"] = source(spark, DAY[1])

    def crash(self, new_mark, now):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest.RunLog, "_advance", crash)
        (outcome,) = world.run()
        assert (outcome.status, outcome.error) == (m.FAILED, "driver lost")
    assert world.source().LastWatermarkValue == m.SENTINEL
    (again,) = world.run()
    assert again.rows_copied == 1
    assert world.source().LastWatermarkValue == DAY[1]


def test_rows_of_failed_runs_are_not_read_from_bronze(spark, world):
    world.register(source_row())
    world.tables["Orders"] = source(spark, DAY[1])
    (good,) = world.run()
    source(spark, DAY[5]).write.parquet(f"{world.base}/bronze/{ORDERS}/run_id=broken")
    assert {row.run_id for row in world.bronze().collect()} == {good.run_id}


def test_a_failure_does_not_stop_the_others(spark, world, tmp_path):
    files = write_samples(tmp_path / "landing")
    world.register(
        source_row(1, "Missing"),
        source_row(3, "Orders"),
        source_row(5, "Off", IsActive=False),
        source_row(6, "Odd", SourceType="XML_FILE"),
        source_row(
            7, "rates", SourceType=m.CSV_FILE, DestinationFolder="files/csv/rates"
        ),
        source_row(
            8, "adjust", SourceType=m.JSON_FILE, DestinationFolder="files/json/adjust"
        ),
        source_row(
            9, "bad", SourceType=m.CSV_FILE, DestinationFolder="files/csv/bad"
        ),
    )
    world.tables["Orders"] = source(spark, DAY[1], DAY[2])
    csv, json = m.CSV_FILE, m.JSON_FILE
    world.files = {
        "rates": FileSpec(csv, files["currency_rates.csv"], m.CURRENCY_RATES),
        "bad": FileSpec(csv, files["damaged_rates.csv"], m.CURRENCY_RATES),
        "adjust": FileSpec(json, files["manual_adjustments.json"], m.MANUAL_ADJUSTMENTS),
    }
    outcomes = {o.source_id: o for o in world.run()}
    assert {i: o.status for i, o in outcomes.items()} == {
        1: m.FAILED,
        3: m.SUCCEEDED,
        6: m.FAILED,
        7: m.SUCCEEDED,
        8: m.SUCCEEDED,
        9: m.SUCCEEDED,
    }
    assert "XML_FILE" in outcomes[6].error
    assert (outcomes[7].rows_read, outcomes[7].rows_copied) == (9, 9)
    assert (outcomes[8].rows_read, outcomes[8].rows_copied) == (1, 1)
    assert (outcomes[9].rows_read, outcomes[9].rows_copied) == (3, 1)
    assert Path(f"{world.base}/rejected/files/csv/bad").exists()
    # File loads have no mark: all of the file each time, and no history.
    assert {row.SourceObjectId for row in world.store.history().collect()} == {3}
    runs = world.store.runs().collect()
    assert len(runs) == 6
    assert len({row.PipelineRunId for row in runs}) == 1
    assert all(row.EndedAt > row.StartedAt for row in runs)
    again = {o.source_id: o for o in world.run()}
    assert again[7].rows_copied == 9
    assert again[3].rows_copied == 0


def test_replay_of_an_entry_changes_nothing(spark, world):
    rows = [
        {
            "WatermarkHistoryId": 1,
            "SourceObjectId": 3,
            "RunId": "r",
            "NewWatermarkValue": DAY[2],
            "AppliedAt": DAY[3],
        }
    ]
    world.store.append_rows("watermark_history", rows, "r")
    world.store.append_rows("watermark_history", rows, "r")
    assert world.store.history().count() == 1


def test_folders_of_other_runs_are_pruned(spark, world, capsys):
    world.register(source_row())
    world.tables["Orders"] = source(spark, DAY[1])
    world.run()
    world.bronze().explain("formatted")
    assert "dynamicpruning" in capsys.readouterr().out


def files_of(world):
    return list(Path(f"{world.base}/metadata").rglob("generation=*/*/*.parquet"))


def test_compaction_keeps_every_state(spark, world, base):
    world.register(source_row(), source_row(4, "OrderItems"))
    world.tables = {"Orders": source(spark, DAY[1]), "OrderItems": source(spark, DAY[2])}
    world.run()
    world.register(source_row(4, "OrderItems", IsActive=False), version=2)
    world.run()

    def states():
        store = world.store
        return [
            sorted(map(str, df.collect()))
            for df in (store.registry(), store.runs(), store.history())
        ]

    before = states()
    many = len(files_of(world))
    world.store.compact()
    assert states() == before
    current = [f for f in files_of(world) if "generation=1" in str(f)]
    assert len(current) < many
    assert ControlStore(spark, base).generation() == 1

    world.tables["Orders"] = source(spark, DAY[1], DAY[3])
    (outcome,) = world.run()
    assert outcome.rows_copied == 1
    assert world.source().LastWatermarkValue == DAY[3]
    assert ControlStore(spark, base).runs().count() == 4


def test_unfinished_compaction_does_not_count(spark, world, base, monkeypatch):
    world.register(source_row())
    world.tables["Orders"] = source(spark, DAY[1])
    world.run()

    def crash(self, generation, state):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(ControlStore, "_begin", crash)
        with pytest.raises(RuntimeError):
            world.store.compact()
    again = ControlStore(spark, base)
    assert again.generation() == 0
    assert again.runs().count() == 1
    again.compact()
    assert again.runs().count() == 1
    assert again.history().count() == 1


def test_stream_refuses_a_wrong_header(spark, world, tmp_path):
    landing, step = stream_world(
        world, tmp_path, m.CSV_FILE, "files/csv/rates", m.CURRENCY_RATES
    )
    (landing / "a.csv").write_text(COUNTRY_CURRENCY)
    with pytest.raises(Exception, match="header"):
        step()
    (run,) = world.store.runs().collect()
    assert run.Status == m.FAILED


# --- Streams ------------------------------------------------------------------


def stream_world(world, tmp_path, source_type, folder, schema):
    landing = tmp_path / "landing"
    landing.mkdir()
    world.register(
        source_row(7, "files", SourceType=source_type, DestinationFolder=folder)
    )
    spec = FileSpec(source_type, str(landing), schema)
    checkpoint = str(tmp_path / "checkpoint")

    def step():
        return ingest_new_files(
            world.store, world.source("files"), spec, checkpoint, world.clock
        )

    return landing, step


def test_new_files_as_a_stream(spark, world, tmp_path):
    landing, step = stream_world(
        world, tmp_path, m.CSV_FILE, "files/csv/rates", m.CURRENCY_RATES
    )
    (landing / "a.csv").write_text(CURRENCY_RATES)
    (counts,) = step().values()
    assert (counts.read, counts.copied, counts.rejected) == (9, 9, 0)

    (empty,) = step().values()
    assert empty.read == 0
    assert world.store.runs().count() == 2, "a call without new files is logged"

    (landing / "b.csv").write_text(DAMAGED_RATES)
    (counts,) = step().values()
    assert (counts.read, counts.copied, counts.rejected) == (3, 1, 2)
    assert world.store.runs().where("Status = 'Succeeded'").count() == 3
    folders = Path(f"{world.base}/bronze/files/csv/rates")
    assert len(list(folders.glob("run_id=*"))) == 2


def bronze_texts(world, folder, source_id=7):
    rows = world.spark.read.text(f"{world.base}/bronze/{folder}")
    return [r.value for r in succeeded_only(rows, world.store.runs(), source_id).collect()]


def test_each_attempt_at_a_batch_is_a_run(spark, world, tmp_path, monkeypatch):
    import json

    from tidemark.streaming import landing as stream

    folder = "files/json/adjust"
    landing, step = stream_world(world, tmp_path, m.JSON_FILE, folder, m.MANUAL_ADJUSTMENTS)
    text = json.dumps(MANUAL_ADJUSTMENTS)
    (landing / "a.json").write_text(text)
    copy = stream.copy_frame

    def refuse(*args):
        copy(*args)  # all is written; then the attempt fails
        raise RuntimeError("no space")

    for number in (1, 2):
        with monkeypatch.context() as patch:
            patch.setattr(stream, "copy_frame", refuse)
            with pytest.raises(Exception, match="no space"):
                step()
        assert world.store.runs().where("Status = 'Failed'").count() == number
    # Nothing of a batch counts that has only failed.
    assert bronze_texts(world, folder) == []

    (run_id,) = step()
    log = {r.RunId: r for r in world.store.runs().collect()}
    assert len(log) == 3 and run_id.endswith("-attempt-3")
    assert (log[run_id].Status, log[run_id].RowsCopied) == (m.SUCCEEDED, 1)
    assert bronze_texts(world, folder) == [text]


def test_replay_of_a_batch_that_has_succeeded_copies_nothing(spark, world, tmp_path, monkeypatch):
    """The stream is lost after the run is logged and before the batch is committed."""
    from tidemark.streaming import landing as stream

    folder = "files/csv/rates"
    landing, step = stream_world(world, tmp_path, m.CSV_FILE, folder, m.CURRENCY_RATES)
    (landing / "a.csv").write_text(CURRENCY_RATES)
    complete = ingest.RunLog.complete

    def lost(self, counts, mark):
        complete(self, counts, mark)
        raise RuntimeError("stream lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest.RunLog, "complete", lost)
        with pytest.raises(Exception, match="stream lost"):
            step()
    with monkeypatch.context() as patch:
        patch.setattr(stream, "copy_frame", lambda *args: pytest.fail("copied again"))
        ((run_id, counts),) = step().items()
    assert (counts.read, counts.copied) == (9, 9)
    assert [r.RunId for r in world.store.runs().collect()] == [run_id]
    assert len(bronze_texts(world, folder)) == 10


def test_attempt_whose_driver_was_lost_is_closed(spark, world, tmp_path, monkeypatch):
    folder = "files/csv/rates"
    landing, step = stream_world(world, tmp_path, m.CSV_FILE, folder, m.CURRENCY_RATES)
    (landing / "a.csv").write_text(CURRENCY_RATES)

    def lost(self, *args):
        raise SystemError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest.RunLog, "complete", lost)
        with pytest.raises(Exception, match="driver lost"):
            step()
    assert [r.Status for r in world.store.runs().collect()] == [m.RUNNING]
    (run_id,) = step()
    log = {r.RunId: r for r in world.store.runs().collect()}
    (other,) = set(log) - {run_id}
    assert (log[other].Status, log[run_id].Status) == (m.FAILED, m.SUCCEEDED)
    assert run_id in log[other].ErrorMessage


def test_new_checkpoint_never_writes_an_old_folder(spark, world, tmp_path):
    folder = "files/csv/rates"
    landing, _ = stream_world(world, tmp_path, m.CSV_FILE, folder, m.CURRENCY_RATES)
    (landing / "a.csv").write_text(CURRENCY_RATES)
    spec = FileSpec(m.CSV_FILE, str(landing), m.CURRENCY_RATES)
    for name in ("one", "two"):
        ingest_new_files(
            world.store, world.source("files"), spec, str(tmp_path / name), world.clock
        )
    assert world.store.runs().where("Status = 'Succeeded'").count() == 2
    assert len(list(Path(f"{world.base}/bronze/{folder}").glob("run_id=*"))) == 2
    assert len(bronze_texts(world, folder)) == 20


def test_entry_that_meets_a_compaction_is_not_lost(spark, world, base, monkeypatch):
    """A whole compaction between an appender's look at the generation and its write, and
    one that has gathered the entry before the appender writes it again."""
    world.register(source_row())
    write = ControlStore._write
    for late in (True, False):
        with monkeypatch.context() as patch:

            def interleaved(self, table, rows, generation, entry, late=late):
                patch.setattr(ControlStore, "_write", write)
                if late:
                    ControlStore(spark, base).compact()
                    write(self, table, rows, generation, entry)
                else:
                    write(self, table, rows, generation, entry)
                    ControlStore(spark, base).compact()

            patch.setattr(ControlStore, "_write", interleaved)
            row = {
                "WatermarkHistoryId": int(late), "SourceObjectId": 3, "RunId": f"r{late}",
                "NewWatermarkValue": DAY[2 - late], "AppliedAt": DAY[3 - late],
            }
            world.store.append_rows("watermark_history", [row], f"r{late}")
    for store in (world.store, ControlStore(spark, base)):
        assert sorted(r.RunId for r in store.history().collect()) == ["rFalse", "rTrue"]
    assert world.source().LastWatermarkValue == DAY[2]


def test_readers_see_all_entries_while_a_compaction_runs(spark, world, base, monkeypatch):
    world.register(source_row())
    world.tables["Orders"] = source(spark, DAY[1])
    world.run()
    begin, seen = ControlStore._begin, []

    def watched(self, generation, state):
        if state == "complete":  # all is gathered, and the old generation still holds
            seen.append(ControlStore(spark, base).runs().count())
            world.tables["Orders"] = source(spark, DAY[1], DAY[2])
            world.run()
            seen.append(ControlStore(spark, base).runs().count())
        begin(self, generation, state)

    with monkeypatch.context() as patch:
        patch.setattr(ControlStore, "_begin", watched)
        ControlStore(spark, base).compact()
    fresh = ControlStore(spark, base)
    assert seen == [1, 2]
    assert fresh.runs().count() == 2 and fresh.history().count() == 2
    assert fresh.registry().first().LastWatermarkValue == DAY[2]


def test_source_row_is_read_from_its_own_file(spark, world, monkeypatch):
    world.register(source_row(), source_row(4, "Items"))
    world.store.save_snapshot()
    with monkeypatch.context() as patch:
        patch.setattr(ControlStore, "journal", lambda *a: pytest.fail("folded"))
        row = world.store.source_row(3)
        assert (row.SourceObjectName, row.LastWatermarkValue) == ("Orders", m.SENTINEL)
    assert world.store.source_row(99) is None
    world.tables["Orders"] = source(spark, DAY[1])
    world.tables["Items"] = source(spark, DAY[2])
    world.run()
    with monkeypatch.context() as patch:
        patch.setattr(ControlStore, "journal", lambda *a: pytest.fail("folded"))
        assert world.store.source_row(3).LastWatermarkValue == DAY[1]
        # Another store object, as in another process.
        other = ControlStore(spark, world.base)
        assert other.source_row(4).LastWatermarkValue == DAY[2]
    world.register(source_row(4, "Items", IsActive=False), version=2)
    row = world.store.source_row(4)
    assert (row.IsActive, row.LastWatermarkValue) == (False, DAY[2])


def test_store_that_was_open_during_compaction_loses_nothing(spark, world, base):
    world.register(source_row())
    world.tables["Orders"] = source(spark, DAY[1])
    world.run()
    ControlStore(spark, base).compact()
    world.tables["Orders"] = source(spark, DAY[1], DAY[2])
    world.run()
    fresh = ControlStore(spark, base)
    assert fresh.runs().count() == 2
    assert fresh.history().count() == 2


def test_source_switched_off_during_a_batch_does_not_run(spark, world, monkeypatch):
    world.register(source_row(), source_row(4, "Items"))
    world.tables["Orders"] = source(spark, DAY[1])
    world.tables["Items"] = source(spark, DAY[1])
    run = Ingestion.run_source

    def first_then_off(self, row, batch):
        off = source_row(4, "Items", IsActive=False)
        world.register(source_row(), off, version=2)
        return run(self, row, batch)

    monkeypatch.setattr(Ingestion, "run_source", first_then_off)
    (outcome,) = world.ingestion.run_active(workers=1)
    assert outcome.source_id == 3


def test_failing_journal_leaves_an_outcome_for_every_source(spark, world, monkeypatch):
    world.register(source_row(), source_row(4, "Items"))
    world.tables["Orders"] = source(spark, DAY[1])
    world.tables["Items"] = source(spark, DAY[1])
    start = ingest.RunLog.start

    def broken(self, old, high):
        if self.source.SourceObjectId == 3:
            raise OSError("journal is gone")
        start(self, old, high)

    monkeypatch.setattr(ingest.RunLog, "start", broken)
    outcomes = world.run()
    assert [(o.source_id, o.status) for o in outcomes] == [(3, m.FAILED), (4, m.SUCCEEDED)]
    assert outcomes[0].run_id is None
