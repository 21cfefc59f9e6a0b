"""The plans at scale depend on: what is read, what is shuffled."""

import re

import pytest

from tests.samples import DAY, history, history_row, registry, run_row, runs
from tests.samples import source, source_row
from tidemark import model as m
from tidemark.operators import journals
from tidemark.operators import windows as w
from tidemark.plans import checks


@pytest.fixture
def plan_of(capsys):
    def explain(df):
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out

    return explain


@pytest.fixture
def sources(spark, base):
    for i in (1, 2):
        source(spark, DAY[1], DAY[3]).write.parquet(f"{base}/t{i}")
    return {i: spark.read.parquet(f"{base}/t{i}") for i in (1, 2)}


@pytest.fixture
def reg(spark):
    return registry(spark, source_row(1, "A", DAY[2]), source_row(2, "B", DAY[2]))


def test_stats_read_one_column_and_shuffle_one_row_per_source(plan_of, sources, reg):
    plan = plan_of(w.source_stats(sources, reg))
    assert re.findall(r"ReadSchema: (.*)", plan) == ["struct<UpdatedAt:timestamp_ntz>"] * 2
    assert plan.count("Arguments: hashpartitioning") == 1
    assert "partial_max" in plan
    assert "Join" not in plan


def test_pending_counts_push_the_mark_to_the_scan(plan_of, sources, reg):
    plan = plan_of(w.pending_counts(sources, reg))
    bound = "GreaterThanOrEqual(UpdatedAt,2026-01-02T00:00:00.001)"
    assert plan.count(bound) == 2
    assert "partial_count" in plan


def test_many_sources_in_one_frame_are_not_shuffled_as_rows(plan_of, spark, base, reg):
    rows = spark.createDataFrame(
        [(1, DAY[1]), (2, DAY[3])], "SourceObjectId int, UpdatedAt timestamp_ntz"
    )
    rows.write.parquet(f"{base}/rows")
    plan = plan_of(w.source_stats(spark.read.parquet(f"{base}/rows"), reg))
    assert "BroadcastHashJoin" in plan
    assert plan.count("Arguments: hashpartitioning") == 1
    assert "partial_max" in plan


def test_latest_per_source_is_limited_below_the_exchange(plan_of, spark, base):
    runs(spark, run_row("a", m.FAILED, DAY[1])).write.parquet(f"{base}/runs")
    log = spark.read.parquet(f"{base}/runs")
    plan = plan_of(journals.latest_failed_run(log))
    assert "row_number(), 1, Partial" in plan
    assert "EqualTo(Status,Failed)" in plan
    top = plan_of(journals.latest_failed_run_of(log, 3))
    assert "TakeOrderedAndProject" in top
    assert "EqualTo(SourceObjectId,3)" in top


def test_only_traces_of_failed_runs_are_shuffled(plan_of, spark, base, reg):
    runs(spark, run_row("a", m.FAILED, DAY[1], 1)).write.parquet(f"{base}/runs")
    history(spark, history_row(1, "a", DAY[1], 1)).write.parquet(f"{base}/hist")
    plan = plan_of(
        checks.failed_run_history_check(
            reg, spark.read.parquet(f"{base}/runs"), spark.read.parquet(f"{base}/hist")
        )
    )
    tree = plan.split("\n\n")[0]
    semi = tree.index("LeftSemi BuildRight")
    scan = tree.index("Scan parquet", semi)
    assert "Exchange" not in tree[semi:scan].replace("BroadcastExchange", "")
    # Columns the check does not need are not read.
    assert "ErrorMessage" not in plan
    assert "AppliedAt" not in plan


def test_history_is_reduced_before_it_is_joined(plan_of, spark, base, reg):
    history(spark, history_row(1, "a", DAY[1], 1)).write.parquet(f"{base}/hist")
    hist = spark.read.parquet(f"{base}/hist")
    plan = plan_of(checks.watermark_history_summary(reg, hist))
    assert "partial_count(WatermarkHistoryId" in plan
