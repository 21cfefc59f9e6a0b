"""Windows and folds, by example and by property."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.samples import DAY, frame, history, history_row, registry, run_row, runs
from tests.samples import source, source_row
from tidemark import model as m
from tidemark.functions import above, ntz, to_millis, up_to
from tidemark.operators import joins
from tidemark.operators import journals as j
from tidemark.operators import windows as w

RELAXED = settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
START = datetime(2024, 3, 10, 1, 59, 59)
# Microseconds around a few milliseconds, so ties and cuts are frequent.
INSTANT = st.integers(0, 6000).map(lambda n: START + timedelta(microseconds=n))
MARK = st.integers(0, 6).map(lambda n: START + timedelta(milliseconds=n))


def cut(value):
    return value.replace(microsecond=value.microsecond // 1000 * 1000)


@RELAXED
@given(values=st.lists(st.one_of(st.none(), INSTANT), max_size=20), mark=MARK)
def test_bounds_agree_with_cutting_each_row(spark, values, mark):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t timestamp_ntz")
    got = df.select(
        "i",
        to_millis("t").alias("cut"),
        above(F.col("t"), mark).alias("above"),
        up_to(F.col("t"), mark).alias("up_to"),
    ).collect()
    for row in got:
        value = values[row.i]
        if value is None:
            assert (row.cut, row.above, row.up_to) == (None, None, None)
        else:
            assert row.cut == cut(value)
            assert row.above == (cut(value) > mark)
            assert row.up_to == (cut(value) <= mark)


@RELAXED
@given(
    values=st.lists(st.one_of(st.none(), INSTANT), max_size=20),
    steps=st.lists(st.integers(0, 20), min_size=1, max_size=3),
)
def test_consecutive_windows_partition_the_rows(spark, values, steps):
    """Rows arrive in steps; each row is copied once, in the run after it came."""
    mark = m.SENTINEL
    copied = []
    seen = 0
    for step in [*steps, len(values)]:
        # Late rows at or below the mark are not read, by definition.
        arrived = [v for v in values[:step] if v is None or cut(v) > mark or v in copied]
        df = source(spark, *arrived)
        high = w.high_mark(df, "UpdatedAt", mark)
        assert high == w.high_mark(df, "UpdatedAt")
        rows = w.incremental_window(df, "UpdatedAt", mark, high).collect()
        want = sorted(cut(v) for v in arrived if v is not None and cut(v) > mark)
        assert sorted(row.UpdatedAt for row in rows) == want
        assert len(rows) + seen == len([v for v in arrived if v is not None]) or seen
        copied += [v for v in arrived if v is not None and v not in copied]
        seen += len(rows)
        mark = w.next_mark(mark, high)


def test_next_mark_never_moves_back():
    assert w.next_mark(DAY[2], DAY[1]) == DAY[2]
    assert w.next_mark(DAY[2], None) == DAY[2]
    assert w.next_mark(None, DAY[1]) == DAY[1]
    assert w.next_mark(None, None) is None


def test_null_marks_select_nothing(spark):
    df = source(spark, DAY[1], None)
    assert w.incremental_window(df, "UpdatedAt", None, DAY[5]).count() == 0
    assert w.incremental_window(df, "UpdatedAt", m.SENTINEL, None).count() == 0
    assert w.high_mark(source(spark), "UpdatedAt") is None


def test_cut_is_right_where_clocks_change(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = spark.range(1).select(
            to_millis(ntz(datetime(2024, 3, 10, 2, 30, 7, 179575))),
            to_millis(ntz(datetime(1, 1, 1))),
            to_millis(ntz(datetime(9999, 12, 31, 23, 59, 59, 999999))),
        )
        row = tuple(got.first())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row == (
        datetime(2024, 3, 10, 2, 30, 7, 179000),
        datetime(1, 1, 1),
        datetime(9999, 12, 31, 23, 59, 59, 999000),
    )


def test_each_source_uses_its_own_watermark_column(spark):
    reg = registry(
        spark,
        source_row(1, "A", DAY[1]),
        source_row(2, "B", DAY[1], WatermarkColumn="ChangedAt"),
        source_row(3, "C", DAY[1]),
    )
    sources = {
        1: source(spark, DAY[2], DAY[3]),
        2: source(spark, DAY[1], DAY[4]).withColumnRenamed("UpdatedAt", "ChangedAt"),
        9: source(spark, DAY[9]),  # not in the registry
    }
    stats = {r.SourceObjectId: r for r in w.source_stats(sources, reg).collect()}
    assert set(stats) == {1, 2}
    assert stats[1].Eligible_Row_Count == 2
    assert stats[2].CurrentHighWatermarkValue == DAY[4]
    highs = dict(map(tuple, w.current_high_watermark(sources, reg).collect()))
    assert highs == {1: DAY[3], 2: DAY[4]}
    counts = dict(map(tuple, w.pending_counts(sources, reg).collect()))
    assert counts == {1: 2, 2: 1}
    rows = w.eligible_rows(sources, reg).collect()
    assert sorted((r.SourceObjectId, r.UpdatedAt) for r in rows) == [
        (1, DAY[2]),
        (1, DAY[3]),
        (2, DAY[4]),
    ]


ROWS = st.lists(st.tuples(st.integers(1, 4), st.one_of(st.none(), INSTANT)), max_size=15)
MARKS = st.tuples(*[st.one_of(st.none(), st.just(m.SENTINEL), MARK)] * 3)


@pytest.mark.parametrize("small", [True, False])
@settings(RELAXED, max_examples=5)
@given(rows=ROWS, marks=MARKS)
def test_shared_rows_give_the_same_as_tables_of_their_own(spark, small, rows, marks):
    """Source 4 is not registered; source 3 is hot when most rows fall to it."""
    reg = registry(spark, *[source_row(i, f"T{i}", marks[i - 1]) for i in (1, 2, 3)])
    shared = spark.createDataFrame(rows, "SourceObjectId int, UpdatedAt timestamp_ntz")
    own = {i: shared.where(F.col("SourceObjectId") == i) for i in (1, 2, 3, 4)}
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    if not small:
        spark.conf.set(threshold, "-1")
    try:
        for operator in (
            w.current_high_watermark,
            w.source_stats,
            w.pending_counts,
            w.eligible_rows,
        ):
            got = sorted(map(str, operator(shared, reg).collect()))
            assert got == sorted(map(str, operator(own, reg).collect()))
    finally:
        spark.conf.unset(threshold)


def test_no_sources_at_all(spark):
    reg = registry(spark, source_row())
    assert w.source_stats({}, reg).count() == 0
    assert w.current_high_watermark({}, reg).count() == 0
    assert w.pending_counts({}, reg).count() == 0
    assert w.eligible_rows({}, reg).count() == 0


def test_window_bounds_reach_the_scan(spark, base, capsys):
    source(spark, DAY[1], DAY[2]).write.parquet(f"{base}/t")
    df = spark.read.parquet(f"{base}/t")
    window = w.incremental_window(df, "UpdatedAt", DAY[1], DAY[2])
    window.explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(UpdatedAt,2026-01-01T00:00:00.001)" in plan
    assert "LessThan(UpdatedAt,2026-01-02T00:00:00.001)" in plan
    assert "Exchange" not in plan


# --- Folds --------------------------------------------------------------------

STEP = st.sampled_from([m.RUNNING, m.SUCCEEDED, m.FAILED])


@RELAXED
@given(
    entries=st.lists(
        st.tuples(st.integers(0, 4), st.integers(1, 9), STEP),
        unique_by=lambda e: e[:2],
        min_size=1,
    )
)
def test_run_state_is_the_last_entry(spark, entries):
    rows = [
        {**run_row(f"r{run}", status, DAY[1]), "Seq": seq} for run, seq, status in entries
    ]
    got = j.run_state(frame(spark, m.RUN_JOURNAL, rows)).collect()
    want = {}
    for run, seq, status in sorted(entries):
        want[f"r{run}"] = status
    assert {r.RunId: r.Status for r in got} == want
    assert len(got) == len(want)


@RELAXED
@given(
    advances=st.lists(
        st.tuples(st.integers(1, 3), st.integers(1, 9), st.integers(1, 9)), max_size=12
    ),
    failures=st.lists(st.integers(1, 3), max_size=4),
)
def test_watermark_state_is_the_last_advance_and_ignores_failures(
    spark, advances, failures
):
    reg = registry(spark, *[source_row(i, f"T{i}", mark=None) for i in (1, 2, 3)])
    hist = [
        history_row(n, f"r{n}", DAY[mark], source_id, DAY[at])
        for n, (source_id, at, mark) in enumerate(advances)
    ]
    want = {i: m.SENTINEL for i in (1, 2, 3)}
    order = sorted(range(len(advances)), key=lambda n: (advances[n][1], n))
    for n in order:
        want[advances[n][0]] = DAY[advances[n][2]]
    state = j.watermark_state(reg, history(spark, *hist))
    assert state.columns == reg.columns
    assert {r.SourceObjectId: r.LastWatermarkValue for r in state.collect()} == want
    # A failed run writes no history, so there is nothing for it to change.
    running = runs(spark, *[run_row(f"f{i}", m.RUNNING, DAY[1], i) for i in failures])
    failed = j.fail_runs(running, F.lit("no"), ntz(DAY[2])).collect()
    assert all(r.Status == m.FAILED and r.NewWatermarkValue is None for r in failed)


@pytest.mark.parametrize("status", [m.SUCCEEDED, m.FAILED])
def test_only_running_runs_change_state(spark, status):
    ended = runs(spark, run_row("a", status, DAY[1]))
    assert j.fail_runs(ended, F.lit("x"), ntz(DAY[2])).isEmpty()
    assert j.complete_runs(ended, ntz(None), F.lit(1), F.lit(1), ntz(DAY[2])).isEmpty()
