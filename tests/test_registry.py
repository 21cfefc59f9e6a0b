"""Selection, routing, guards, guarded changes, metadata."""

import pytest

from tests.samples import DAY, registry, source_row
from tidemark import model as m
from tidemark.operators import registry as r
from tidemark.plans.failure import failure_setup
from tidemark.plans.retry import retry_validation

FOLDER = "sqlserver/sales_local/dbo/orders"


def loaded(spark):
    return registry(
        spark, source_row(mark=DAY[2]), source_row(4, "OrderItems", mark=DAY[3])
    )


def setup(reg, action, name="Orders"):
    return failure_setup(reg, "sales_local", "dbo", name, FOLDER, DAY[9], action)


def test_active_and_routes(spark):
    reg = registry(
        spark,
        source_row(1),
        source_row(2, SourceType=m.CSV_FILE),
        source_row(3, SourceType=m.JSON_FILE),
        source_row(4, SourceType="XML_FILE"),
        source_row(5, IsActive=False),
    )
    routed = r.route_sources(r.active_sources(reg)).orderBy("SourceObjectId").collect()
    assert [row.Route for row in routed] == [r.SQL_ROUTE, r.CSV_ROUTE, r.JSON_ROUTE, None]
    with pytest.raises(ValueError, match="XML_FILE"):
        r.route_of("XML_FILE")


@pytest.mark.parametrize(
    ("identity", "found"),
    [
        (("sales_local", "dbo", "Orders"), True),
        (("SALES_LOCAL", "dbo", "Orders"), False),
        (("sales_local", "dbo", "orders"), False),
        (("sales_local", "ctl", "Orders"), False),
    ],
)
def test_identity_is_exact(spark, identity, found):
    reg = loaded(spark)
    if found:
        assert r.require_source(reg, *identity) == 3
        return
    with pytest.raises(m.GuardError) as error:
        r.require_source(reg, *identity)
    assert error.value.number == 54001


def test_guard_messages(spark):
    reg = loaded(spark)
    with pytest.raises(m.GuardError, match="54001: Target SourceObject was not found."):
        setup(reg, m.PREVIEW, "Nothing")
    # An unknown source is reported before an unknown action.
    with pytest.raises(m.GuardError, match="54001"):
        setup(reg, "DROP", "Nothing")
    with pytest.raises(m.GuardError, match="54002: Invalid @Action."):
        setup(reg, "DROP")
    with pytest.raises(m.GuardError, match="55001"):
        retry_validation(reg, None, None, {}, "sales_local", "dbo", "Nothing")


@pytest.mark.parametrize("mark", [m.SENTINEL, None])
def test_no_failure_before_the_initial_load(spark, mark):
    reg = registry(spark, source_row(mark=mark))
    with pytest.raises(m.GuardError) as error:
        setup(reg, m.PREPARE_FAILURE)
    assert error.value.number == 54003
    assert r.guard_initial_load_done(reg).first().Guard_Status == "54003"
    # Preview and restore have no such guard.
    setup(reg, m.PREVIEW)
    setup(reg, m.RESTORE_CONFIGURATION)


def test_preview_changes_nothing(spark):
    reg = loaded(spark)
    done = setup(reg, m.PREVIEW)
    current, preview, note = [frame.first() for frame in done.shown]
    assert current.ResultType == m.CURRENT_CONFIGURATION
    assert preview.Mode == "PREVIEW_ONLY"
    assert preview.TargetSourceObject == "Orders"
    assert preview.FailureDestinationContainer == m.FAILURE_CONTAINER
    assert preview.Description == m.PREVIEW_TEXT
    assert (note.NoteType, note.Note) == ("RESTORE_COMMAND_NOTE", m.RESTORE_TEXT)
    assert done.registry is reg


def test_prepare_then_restore(spark):
    before = {row.SourceObjectId: row for row in loaded(spark).collect()}
    prepared = setup(loaded(spark), m.PREPARE_FAILURE)
    rows = {row.SourceObjectId: row for row in prepared.registry.collect()}
    assert prepared.shown[0].first().DestinationContainer == "bronze"
    shown = prepared.shown[1].first()
    assert shown.ResultType == m.FAILURE_PREPARED
    assert shown.DestinationContainer == m.FAILURE_CONTAINER
    assert rows[3].DestinationContainer == m.FAILURE_CONTAINER
    assert rows[3].DestinationFolder == FOLDER  # prepare leaves the folder alone
    assert rows[3].UpdatedAt == DAY[9]
    assert rows[4] == before[4]
    assert prepared.registry.columns == list(m.SOURCE_OBJECT.names)

    moved = r.set_destination(prepared.registry, 3, "x", DAY[8], "elsewhere")
    restored = setup(moved, m.RESTORE_CONFIGURATION)
    row = restored.shown[1].first()
    assert row.ResultType == m.CONFIGURATION_RESTORED
    assert (row.DestinationContainer, row.DestinationFolder) == ("bronze", FOLDER)
    assert row.LastWatermarkValue == DAY[2]
