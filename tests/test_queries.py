"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from tidemart.plans.all_queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"



@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_equals_sql(spark, con, key):
    assert differences(QUERIES[key](spark, SF), con, SQL[key]) is None


# Lines of one id and time are there from this size on: which of them stays must not depend on what a query asks for.
FACTS = ["latest_per_key", "dwd_trade_order_detail", "dwd_trade_pay_sus_detail", "order_daily_flag", "user_group_daily_flag",
         "order_user_daily_new", "pay_user_daily_new", "dws_order_users", "dws_pay_users", "dws_course_orders",
         "dws_source_orders", "dws_source_orders_1d", "dws_province_orders", "dws_province_orders_1d", "join_payment_detail"]


@pytest.fixture(scope="module")
def larger():
    return connect("/root/testdata/sf0.01")


@pytest.mark.parametrize("key", FACTS)
def test_facts_with_ties(spark, larger, key):
    assert differences(QUERIES[key](spark, "/root/testdata/sf0.01"), larger, SQL[key]) is None


def test_queries_without_sql_are_known():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
