"""The state table of the checks, and the answers that are easily got wrong."""

from contextlib import contextmanager
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.samples import DAY, ORDERS_ID, history, history_row, registry, run_row, runs
from tests.samples import source, source_row
from tidemark import model as m
from tidemark.operators import joins, journals
from tidemark.operators.registry import null_watermark_sources
from tidemark.plans import checks
from tidemark.plans.retry import retry_validation

ROWS = (DAY[1], DAY[2], None)
FAILED_RUN = run_row("r1", m.FAILED, DAY[3])
BAD_RUN = run_row("r1", m.FAILED, DAY[3], NewWatermarkValue=DAY[2])
GOOD_RUN = run_row("r2", m.SUCCEEDED, DAY[4], NewWatermarkValue=DAY[2])

NO_ROW = "no row"

# name: mark, source rows, runs, history,
#       V1, V2, V5, V6, V7, V8, V9
SCENARIOS = {
    "S0 before load": (
        m.SENTINEL, ROWS, [], [],
        m.NOT_READY,
        (2, m.NOT_READY),
        m.NOT_READY,
        NO_ROW,
        (0, m.NO_FAILED_RUN),
        (2, m.NOT_READY),
        ("NO", 2, 0, m.NOT_READY),
    ),
    "S1 loaded": (
        DAY[2], ROWS, [], [],
        m.READY_FOR_EMPTY_RUN,
        (0, m.PASS_EMPTY_READY),
        m.NO_CHANGES_PENDING,
        NO_ROW,
        (0, m.NO_FAILED_RUN),
        (0, m.NO_ROWS_PENDING),
        ("NO", 0, 0, m.NO_FAILED_RUN),
    ),
    "S2 failed, pending": (
        DAY[1], ROWS, [FAILED_RUN], [],
        m.READY_FOR_EMPTY_RUN,
        (1, m.CHANGES_PENDING),
        m.CHANGES_ELIGIBLE,
        m.PASS_FAILED_RUN,
        (0, m.PASS_NO_HISTORY),
        (1, m.PASS_ROWS_ELIGIBLE),
        ("YES", 1, 0, m.PASS_RETRY),
    ),
    "S3 failed with a trace": (
        DAY[1], ROWS, [BAD_RUN], [history_row(1, "r1", DAY[2])],
        m.READY_FOR_EMPTY_RUN,
        (1, m.CHANGES_PENDING),
        m.CHANGES_ELIGIBLE,
        m.INVALID_FAILED_RUN,
        (1, m.FAIL_HISTORY),
        (1, m.PASS_ROWS_ELIGIBLE),
        ("YES", 1, 1, m.REVIEW_REQUIRED),
    ),
    "S4 retried": (
        DAY[2], ROWS, [FAILED_RUN, GOOD_RUN], [history_row(1, "r2", DAY[2])],
        m.READY_FOR_EMPTY_RUN,
        (0, m.PASS_EMPTY_READY),
        m.NO_CHANGES_PENDING,
        m.PASS_FAILED_RUN,
        (0, m.PASS_NO_HISTORY),
        (0, m.NO_ROWS_PENDING),
        ("YES", 0, 0, m.REVIEW_REQUIRED),
    ),
    "S5 empty source": (
        DAY[1], (), [FAILED_RUN], [],
        m.READY_FOR_EMPTY_RUN,
        NO_ROW,
        m.NO_CHANGES_PENDING,
        m.PASS_FAILED_RUN,
        (0, m.PASS_NO_HISTORY),
        (None, m.NO_ROWS_PENDING),
        ("YES", 0, 0, m.REVIEW_REQUIRED),
    ),
    "S6 NULL mark": (
        None, ROWS, [FAILED_RUN], [],
        m.READY_FOR_EMPTY_RUN,
        (0, m.PASS_EMPTY_READY),
        m.NO_CHANGES_PENDING,
        m.PASS_FAILED_RUN,
        (0, m.PASS_NO_HISTORY),
        (0, m.NO_ROWS_PENDING),
        ("YES", 0, 0, m.REVIEW_REQUIRED),
    ),
}


def only(df, *columns):
    rows = df.select(*columns).collect()
    assert len(rows) <= 1
    if not rows:
        return NO_ROW
    return rows[0][0] if len(columns) == 1 else tuple(rows[0])


@pytest.mark.parametrize("name", SCENARIOS)
def test_state_table(spark, name):
    mark, marks, run_rows, history_rows, v1, v2, v5, v6, v7, v8, v9 = SCENARIOS[name]
    reg = registry(spark, source_row(mark=mark))
    log = runs(spark, *run_rows)
    hist = history(spark, *history_rows)
    sources = {ORDERS_ID: source(spark, *marks)}
    count, status = "Eligible_Row_Count", "Validation_Status"

    assert only(checks.watermark_readiness(reg), "Readiness_Status") == v1
    assert only(checks.eligibility(sources, reg), count, status) == v2
    assert only(checks.retry_readiness(sources, reg), "Retry_Readiness_Status") == v5
    assert only(checks.failed_run_check(log), status) == v6
    v7_frame = checks.failed_run_history_check(reg, log, hist)
    assert only(v7_frame, "WatermarkHistory_Count", status) == v7
    assert only(checks.retry_eligible_rows(sources, reg), count, status) == v8
    columns = ("Failed_Run_Exists", count, "Failed_Run_WatermarkHistory_Count", status)
    assert only(checks.retry_summary(reg, log, hist, sources), *columns) == v9

    one = retry_validation(reg, log, hist, sources, "sales_local", "dbo", "Orders")
    assert only(one["readiness"], "Retry_Readiness_Status") == v5
    assert only(one["failed_run"], status) == v6
    assert only(one["history"], "WatermarkHistory_Count", status) == v7
    assert only(one["eligible_rows"], count, status) == v8
    assert only(one["summary"], *columns) == v9


def test_constant_columns(spark):
    reg = registry(spark, source_row())
    none = runs(spark), history(spark)
    v7 = checks.failed_run_history_check(reg, *none)
    v9 = checks.retry_summary(reg, *none, {ORDERS_ID: source(spark)})
    assert only(v7, "ValidationArea") == m.HISTORY_CHECK_AREA
    assert only(v9, "ValidationArea") == m.RETRY_AREA


def test_high_mark_is_cut_to_milliseconds_and_equal_marks_are_not_pending(spark):
    high = datetime(2026, 1, 2, 0, 0, 0, 667294)
    cut = datetime(2026, 1, 2, 0, 0, 0, 667000)
    got = checks.eligibility(
        {ORDERS_ID: source(spark, DAY[1], high)}, registry(spark, source_row(mark=cut))
    ).first()
    assert got.CurrentHighWatermarkValue == cut
    assert got.Eligible_Row_Count == 0
    assert got.Validation_Status == m.PASS_EMPTY_READY


def test_file_sources_are_left_out(spark):
    reg = registry(
        spark,
        source_row(),
        source_row(7, "currency_rates", SourceType=m.CSV_FILE, mark=None),
    )
    assert checks.watermark_readiness(reg).count() == 1
    assert checks.watermark_history_summary(reg, history(spark)).count() == 1
    assert null_watermark_sources(reg).count() == 0


def test_null_mark_is_listed(spark):
    reg = registry(spark, source_row(mark=None), source_row(4, "OrderItems"))
    names = [r.SourceObjectName for r in null_watermark_sources(reg).collect()]
    assert names == ["Orders"]


def test_history_summary_keeps_sources_without_history_and_merges_names(spark):
    reg = registry(
        spark,
        source_row(1, "Orders"),
        source_row(2, "Orders", SourceSystemName="other"),
        source_row(3, "Payments"),
    )
    hist = history(
        spark,
        history_row(1, "a", DAY[2], 1),
        history_row(2, "b", DAY[3], 2, DAY[5]),
        history_row(None, "c", DAY[1], 2),
    )
    got = [tuple(r) for r in checks.watermark_history_summary(reg, hist).collect()]
    # A NULL id is not counted, its mark still is a candidate.
    assert got == [("Orders", 2, DAY[3], DAY[5]), ("Payments", 0, None, None)]


def test_latest_failed_run_breaks_ties_by_run_id(spark):
    log = runs(
        spark,
        run_row("a", m.FAILED, DAY[3]),
        run_row("b", m.FAILED, DAY[3]),
        run_row("c", m.SUCCEEDED, DAY[4]),
        run_row("d", m.FAILED, DAY[1], 4, "OrderItems"),
    )
    got = {(r.SourceObjectId, r.RunId) for r in journals.latest_failed_run(log).collect()}
    assert got == {(3, "b"), (4, "d")}
    assert journals.latest_failed_run_of(log, 3).first().RunId == "b"


def test_null_run_ids_match_nothing(spark):
    """A history row without a run must not count for sources without one."""
    reg = registry(spark, source_row())
    hist = history(
        spark, history_row(1, None, DAY[2]), history_row(2, "no run of 3", DAY[2])
    )
    got = checks.failed_run_history_check(reg, runs(spark), hist).first()
    assert (got.FailedRunId, got.WatermarkHistory_Count) == (None, 0)
    assert got.Validation_Status == m.NO_FAILED_RUN


def test_large_registry_takes_the_way_without_broadcast(spark, monkeypatch):
    """Same answers when the registry exceeds the checked bound."""
    reg = registry(spark, *[source_row(i, f"T{i}") for i in range(1, 9)])
    log = runs(
        spark, *[run_row(f"r{i}", m.FAILED, DAY[3], i, f"T{i}") for i in range(1, 8)]
    )
    hist = history(
        spark,
        *[history_row(k, "r2", DAY[2], 2) for k in range(50)],
        history_row(99, "other", DAY[2], 5),
    )
    small = sorted(map(tuple, checks.failed_run_history_check(reg, log, hist).collect()))
    monkeypatch.setattr(checks, "at_most", lambda df: False)
    large = sorted(map(tuple, checks.failed_run_history_check(reg, log, hist).collect()))
    assert small == large
    assert ("r2", 50) in {(r[2], r[3]) for r in large}


def test_at_most(spark):
    assert joins.at_most(spark.range(5), 5)
    assert not joins.at_most(spark.range(6), 5)


@contextmanager
def joined_without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("salts", [1, 3, 16])
@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_salted_join_is_the_same_join(spark, how, salts):
    """Most rows share one key, some have none; the side has keys to spare."""
    rows = spark.range(1000, numPartitions=7).selectExpr(
        "CASE WHEN id < 600 THEN 0 WHEN id < 900 THEN id % 50 END AS k", "id"
    )
    side = spark.range(0, 60, 2).selectExpr("id AS k", "id * 10 AS v")
    plain = rows.join(side, "k", how)
    for _ in range(2):
        salted = joins.join_side(rows, side, "k", how, salts)
        assert salted.columns == plain.columns
        assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, plain.collect()))


def test_rows_of_a_hot_key_are_dealt_in_one_pass(spark, base, capsys):
    """One scan of the rows, and the hot key's rows in as many parts as there are salts."""
    spark.range(4000).selectExpr("CASE WHEN id < 3000 THEN 7 ELSE id END AS k", "id").write.parquet(
        f"{base}/rows"
    )
    rows = spark.read.parquet(f"{base}/rows")
    side = spark.range(4000).selectExpr("id AS k", "id AS v")
    with joined_without_broadcast(spark):
        joined = joins.join_side(rows, side, "k", salts=8)
        joined.explain()
        plan = capsys.readouterr().out
        assert plan.count("FileScan parquet") == 1
        assert plan.count("Exchange hashpartitioning(k") == 2
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            parts = joined.where("k = 7").groupBy(F.spark_partition_id()).count().collect()
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(row["count"] for row in parts) == 3000
    assert len(parts) > 2


def test_failed_runs_split_by_history(spark):
    log = runs(
        spark,
        run_row("a", m.FAILED, DAY[3]),
        run_row("b", m.FAILED, DAY[3]),
        run_row("c", m.SUCCEEDED, DAY[3]),
    )
    hist = history(
        spark,
        *[history_row(k, "a", DAY[2]) for k in range(3)],
        history_row(9, "c", DAY[2]),
        history_row(10, None, DAY[2]),
    )
    assert [r.RunId for r in journals.failed_with_history(log, hist).collect()] == ["a"]
    assert [r.RunId for r in journals.failed_without_history(log, hist).collect()] == ["b"]


def test_facts_of_journals_come_from_one_scan_each(spark, base, capsys):
    reg = registry(spark, source_row(1, "A", DAY[1]), source_row(2, "B", DAY[1]))
    runs(
        spark,
        run_row("a", m.FAILED, DAY[1], 1), run_row("b", m.FAILED, DAY[2], 1),
        run_row("c", m.SUCCEEDED, DAY[3], 1), run_row("d", m.RUNNING, DAY[3], 2),
        run_row("e", m.FAILED, DAY[3], 9),
    ).write.parquet(f"{base}/runs")
    history(
        spark,
        history_row(1, "a", DAY[1], 1), history_row(2, "b", DAY[2], 2),
        history_row(3, "b", DAY[3], 1), history_row(4, "e", DAY[3], 9),
        history_row(5, None, DAY[3], 2), history_row(6, "zz", DAY[4], 2),
    ).write.parquet(f"{base}/hist")
    facts = checks.source_facts(
        reg, spark.read.parquet(f"{base}/runs"), spark.read.parquet(f"{base}/hist")
    )
    facts.explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan parquet") == 2
    # Traces are the entries of the failed run, whichever source they name.
    got = {r.SourceObjectId: r for r in facts.collect()}
    assert set(got) == {1, 2}
    assert (got[1].FailedRunId, got[1].History_Rows, got[1].WatermarkHistory_Count) == ("b", 2, 2)
    assert (got[1].Failed_Run_Count, got[1].Succeeded_Run_Count) == (2, 1)
    assert got[1].Last_History_Watermark == DAY[3]
    assert (got[2].FailedRunId, got[2].History_Rows, got[2].WatermarkHistory_Count) == (None, 0, 3)
    assert (got[2].Running_Run_Count, got[2].Last_History_Watermark) == (1, DAY[4])


def test_operational_summary(spark):
    reg = registry(spark, source_row(mark=DAY[1]), source_row(4, "OrderItems"))
    log = runs(spark, FAILED_RUN, GOOD_RUN)
    hist = history(spark, history_row(1, "r2", DAY[2]))
    got = checks.operational_summary(
        reg, log, hist, {ORDERS_ID: source(spark, *ROWS), 4: source(spark)}
    ).collect()
    items, orders = got
    assert orders.Empty_Run_Status == m.CHANGES_PENDING
    assert (orders.Succeeded_Run_Count, orders.Failed_Run_Count) == (1, 1)
    assert orders.Retry_Status == m.PASS_RETRY
    assert items.Empty_Run_Status is None
    assert (items.Eligible_Row_Count, items.WatermarkHistory_Count) == (0, 0)
