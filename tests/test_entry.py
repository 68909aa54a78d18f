"""The registered queries against their SQL, and the report as a whole."""

import os

import pytest

import __spark_entry__ as entry_points
from oracle import connect, differences
from plans import operators, scanned_rows
from tidemill import catalog
from tidemill.operators import envelope, filters, kpi
from tidemill.plans import dashboard
from tidemill.plans.oracle import WITHOUT_SQL
from tidemill.plans.queries import QUERIES
from tidemill.plans.shop import SHOP
from tidemill.sources.logs import FileLog
from tidemill.streaming import landing, sinks

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_flagship_has_rows(spark):
    flagship = entry_points.entry(spark)
    assert flagship.columns == ["order_day", "revenue"]
    assert flagship.count() > 0


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) - set(entry_points.oracle_sql()) == set(WITHOUT_SQL)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, connection, name):
    frame = entry_points.queries()[name](spark, SF_DIR)
    if name in WITHOUT_SQL:
        assert frame.count() > 0
    else:
        assert differences(frame, connection, entry_points.oracle_sql()[name]) == ""


def test_building_the_report_starts_no_job(spark):
    frames = {name: make(spark, SF_DIR) for name, make in SHOP.items()}
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    try:
        dashboard.sections(frames)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(tracker.getJobIdsForGroup("building")) == []


def test_window_choices_take_two_scans(spark):
    """One for all windows; the newest time is a subquery, and all conditions share it."""
    frame = entry_points.queries()["recent_orders_by_window"](spark, SF_DIR)
    frame.collect()
    assert len(scanned_rows(frame)) == 1
    subqueries = [n for n in operators(frame) if not n.subqueries().isEmpty()]
    ids = {s.canonicalized().hashCode() for n in subqueries for s in _all(n.subqueries())}
    assert len(ids) == 1


def _all(sequence):
    return [sequence.apply(i) for i in range(sequence.size())]


def test_report_of_an_empty_lake(spark, tmp_path):
    frames = dashboard.load_lake(spark, str(tmp_path), newest_only=True, located=True)
    figures = {name: frame.collect() for name, frame in dashboard.sections(frames).items()}
    assert figures["overview"] == [(0, 0.0, 0.0, 0, 0, 0)]
    assert {(r.rows, r.latest) for r in figures["dataset_health"]} == {(0, "n/a")}
    assert figures["payment_success_rate"] == [(0.0,)]
    assert [r.orders for r in figures["order_value_bands"]] == [0, 0, 0]
    assert figures["revenue_by_day"] == figures["hourly_events"] == []
    assert all(frame.isEmpty() for frame in dashboard.previews(frames).values())
    totals = {k: v.collect() for k, v in dashboard.single_pass(frames).items()}
    assert totals["web_events"] == [("all", None, 0)]


def test_report_from_a_landed_lake(spark, tmp_path):
    """Tables to messages, through the streams, and every figure off the lake."""
    log, root = FileLog(f"{tmp_path}/log"), f"{tmp_path}/lake"
    tables = {name: make(spark, SF_DIR) for name, make in SHOP.items()}
    for spec in catalog.DATASETS:
        log.append(envelope.encode(tables[spec.name], spec))
    landing.run_all(
        spark, log, root, f"{tmp_path}/checkpoints", trigger=sinks.ONCE, audit=False, starting="earliest"
    )

    for newest_only in (False, True):
        frames = dashboard.load_lake(spark, root, newest_only, located=newest_only)
        figures = dashboard.sections(frames)
        orders = filters.recent_days(tables["orders"], "order_date", 90)
        assert figures["revenue_by_day"].collect() == kpi.revenue_by_day(orders).collect()
        assert figures["overview"].first().orders == orders.count()
        assert figures["web_event_rows"].first()[0] == tables["web_events"].count()
        for name, frame in figures.items():
            assert not frame.isEmpty(), name
    offered = dashboard.option_lists(frames)
    assert [r.status for r in offered["orders"].collect()] == ["F", "O", "P"]
    heads = dashboard.previews(frames, dashboard.Choices("All", {"orders": ["F"]}))
    assert {r.status for r in heads["orders"].collect()} == {"F"}
    assert heads["payments"].count() == 20
