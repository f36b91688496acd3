"""Registered queries against their SQL twins, and the shape of their plans.

``WAYFARE_ALL=1`` compares every query (several minutes).
"""

import os

import pytest

import __spark_entry__ as entry
from verification import registry
from verification.compare import compare, connect

QUERIES, SQL = entry.queries(), entry.oracle_sql()
SAMPLE = (
    "jn_silver_bookings", "jn_silver_flights", "jn_curated_bookings", "p_guests", "g_upsell_opportunity",
    "f_traveler_profile", "q_bo1_loyalty_cross", "q_bo2_snapshot", "snk_json_export_bo2", "d_kpi_flight",
    "h_hotel_compare", "h_kpi_tiles", "dq_bookings", "src_csv_bookings", "src_volume_list", "snk_overwrite", "snk_gold", "src_namespace",
    "dq_required_columns", "dq_profile_quartiles", "dq_catalogue", "inc_detect_hotel", "inc_upsert_bookings", "inc_upsert_guests",
    "inc_stream_ingest", "inc_full_refresh_hotel_boards", "inc_refresh_reports",
)
NAMES = list(registry.oracle_sql()) if os.environ.get("WAYFARE_ALL") else SAMPLE


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_agrees_with_sql(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


def test_every_sql_has_a_query():
    ours = registry.queries()
    assert set(SQL) <= set(QUERIES)
    assert set(ours) == set(registry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", [n for n in SAMPLE if n not in ("inc_stream_ingest",)] + ["d_segment_adr", "d_band", "f_satisfaction_by_route", "w_rank"]
)
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_unused_guest_join_is_dropped(spark, sf_dir):
    text = plan(QUERIES["g_premium_conversion"](spark, sf_dir))
    assert "SortMergeJoin" not in text and "xxhash64" not in text


def test_guest_join_is_keyed_by_mail_and_group(spark, sf_dir):
    text = plan(QUERIES["jn_guests"](spark, sf_dir))
    assert text.count("hashpartitioning(email") == 3 and "_group" in text.split("hashpartitioning(email", 1)[1][:40]


def test_scan_reads_only_needed_columns(spark, sf_dir):
    text = plan(QUERIES["g_premium_conversion"](spark, sf_dir))
    assert "l_tax" not in text and "o_totalprice" not in text
