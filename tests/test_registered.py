"""Every registered query against its SQL in DuckDB, at the smallest scale (or ``TEST_SF_DIR``)."""

import pytest

import __spark_entry__ as entry_points
from registry import ENTRIES
from registry.compare import connect, difference
from touchline.operators import ordered


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


def test_entry_points(spark):
    assert set(entry_points.queries()) >= set(ENTRIES)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert entry_points.entry(spark).count() > 0


WITHOUT_SQL = {"warehouse_checks"}


@pytest.mark.parametrize("name", [name for name in ENTRIES if name not in WITHOUT_SQL])
def test_query(spark, connection, folder, name):
    entry = ENTRIES[name]
    assert entry.sql is not None
    assert difference(spark, connection, folder, entry) is None


HISTORIES = [
    "standings_current",
    "standings_versions",
    "event_versions",
    "daily_event_leaders",
    "streaks",
    "event_streak_members",
    "id_batches",
    "dq_no_overlap",
    "dq_window_expression",
]


@pytest.mark.parametrize("name", HISTORIES)
def test_query_with_groups_cut_into_segments(spark, connection, folder, name, monkeypatch):
    """The same rows when hardly any group fits one task."""
    monkeypatch.setattr(ordered, "MAX_GROUP_ROWS", 4)
    monkeypatch.setattr(ordered, "SEGMENT_ROWS", 150)
    assert difference(spark, connection, folder, ENTRIES[name]) is None
