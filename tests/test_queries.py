"""Registered queries against their SQL. All of them with CHECK_ALL=1."""

import os

import pytest

import __spark_entry__ as entry_points
from check import compare

SOME = ("typed_postings postings salary_facts skill_trends duplication_rate sampled_postings ingested_bronze version_history "
        "cross_board_duplicates canonical_not_open us_state_policy quarantine_summary weekly_postings salary_bands "
        "rescued_fields streamed_upsert_log streamed_stateful_latest nested_fields streamed_history exact_salary_bands "
        "failed_stream_leaves_no_rows").split()
NAMES = list(entry_points.queries()) if os.environ.get("CHECK_ALL") else SOME


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    expected = "ok" if name in entry_points.oracle_sql() else "rows only"
    assert compare(spark, "/root/testdata/sf0.001", [name])[name] == expected


def test_entry_points(spark):
    assert entry_points.entry(spark).columns == ["employment_type", "postings", "pct"]
    assert set(SOME) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())
