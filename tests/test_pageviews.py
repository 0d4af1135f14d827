"""Views by title: months as partitions, duplicate and unknown titles."""

import datetime as dt

import pytest

from lexigraph.sources.pageviews import views_by_title, views_of_pages, write_log
from lexigraph.workspace import Workspace

TITLES = [(7, "Blue Whale"), (3, "Blue Whale"), (4, "a_b"), (9, "a b"), (5, ""), (6, None), (8, "Never Seen")]
SEEN = [("Blue_Whale", 1, 31), ("Blue_Whale", 1, 1), ("Blue Whale", 1, 2), ("Blue_Whale", 2, 1), ("a_b", 1, 5), ("", 1, 5), (None, 1, 5), ("Gone", 1, 5), ("a_b", 3, 1)]


@pytest.fixture(scope="module")
def log(spark):
    path = Workspace(spark, "view tests").fresh("log")
    rows = [(t, dt.datetime(2024, m, d, 23, 59)) for t, m, d in SEEN]
    write_log(spark.createDataFrame(rows, "title STRING, ts TIMESTAMP_NTZ"), path)
    return path


@pytest.mark.parametrize(
    "first, last, want",
    [("2024-01", "2024-01", {3: 3, 4: 1, 5: 1}), ("2024-01", "2024-02", {3: 4, 4: 1, 5: 1}), ("2024-03", "2024-12", {4: 1}), ("2023-01", "2023-12", {})],
)
def test_views_of_pages(spark, log, first, last, want):
    titles = spark.createDataFrame(TITLES, "doc_id BIGINT, title STRING")
    assert {r.doc_id: r.views for r in views_of_pages(views_by_title(spark, log, first, last), titles).collect()} == want


def test_only_wanted_months_are_read(spark, log):
    found = views_by_title(spark, log, "2024-02", "2024-02")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "day" not in plan.split("ReadSchema:")[1]
    assert {r.name: r.views for r in found.collect()} == {"Blue Whale": 1}
