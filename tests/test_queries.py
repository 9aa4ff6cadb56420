"""Every query against its SQL twin, with the usual number of borders and with very many."""

import oracle
import pytest
from conftest import TABLES

import __spark_entry__ as entry
from tidyloom.queries import ORACLES, QUERIES
from tidyloom.settings import BORDERS_PER_PARTITION


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(TABLES)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_twin(spark, connection, name):
    assert oracle.differences(QUERIES[name](spark, TABLES), ORACLES[name], connection) == []


# Queries whose operators work on groups by ranges.
SPLIT = """
    q_weekday_rank q_athletes q_global_rank q_rank_max q_monthly_rank q_ordinal q_sort_index q_running_balance q_ledger q_ffill q_pct_change
    q_running_diff q_rolling3 q_qcut6 q_qcut_quartile q_gpa q_price_stats q_likert q_pareto q_partition_stats q_performance q_daily_balance
    q_mean_gap_weekday q_top2pct q_next_workday q_next_report q_share_window q_statement q_reporting_calendar q_lesson_attendance
    q_low_performers q_selected_applicants q_school_costs q_word_analysis q_flight_details q_cause_for_concern q_lowest5 q_json_by_key
    q_monthly_trades q_top5_group q_pct_over_ranked q_weekday_ranking q_track_team q_lowest_class q_travel_summary q_fill_blanks
    q_day_end_balance q_account_summary q_bike_quarters q_pivot_count q_ticket_document q_weekday_documents
""".split()


@pytest.mark.parametrize("name", SPLIT)
def test_split_groups_equal_twin(spark, connection, name):
    spark.conf.set(BORDERS_PER_PARTITION, "400")
    try:
        assert oracle.differences(QUERIES[name](spark, TABLES), ORACLES[name], connection) == []
    finally:
        spark.conf.unset(BORDERS_PER_PARTITION)


def test_entry_runs(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["bank", "transaction_method", "weekday", "total_value"]
    assert frame.count() > 0
