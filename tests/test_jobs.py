"""The order and receipt files through the jobs, in batch."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from clickloom.plans import jobs
from clickloom.sources import order_events, receipt_events
from clickloom.sources.files import with_file_order

PAIRS = [
    ("aa01", 11, "card"), ("aa03", 13, "card"), ("aa06", 16, "card"),
    ("aa06", 16, "cash"), ("aa06", 17, "card"), ("aa06", 17, "cash"),
]


@pytest.fixture()
def orders(spark, order_files):
    return with_file_order(order_events(spark, order_files[0]))


@pytest.fixture()
def receipts(spark, order_files):
    return with_file_order(receipt_events(spark, order_files[1]))


def test_empty_transaction_is_text(orders):
    assert orders.where("tx_id is null").count() == 0 and orders.where("tx_id = ''").count() == 7


def test_order_pattern(orders):
    got = jobs.order_timeout_pattern(orders)
    assert rows(got.where("outcome = 'matched'"), "order_id", "result_state") == [
        (i, "payed") for i in (11, 16, 17, 18)
    ]
    assert rows(got.where("outcome = 'timeout'"), "order_id", "result_state") == [
        (12, "order create time : 2023-11-14 22:13:30.0 |  order timeout : 2023-11-14 22:28:30.0"),
        (13, "order create time : 2023-11-14 22:14:40.0 |  order timeout : 2023-11-14 22:29:40.0"),
        (14, "order create time : 2023-11-14 22:13:50.0 |  order timeout : 2023-11-14 22:28:50.0"),
    ]


@pytest.mark.parametrize("job", [jobs.order_timeout, jobs.order_timeout_cycles])
def test_order_outcomes(orders, job):
    got = job(orders)
    assert rows(got.where("output = 'main'"), "order_id", "result_state") == [
        (i, "payed successfully") for i in (11, 13, 16, 17, 18)
    ]
    assert rows(got.where("output = 'side'"), "order_id", "result_state") == [
        (12, "payed but already timeout"),
        (14, "payed timeout"),
        (15, "payed but not found created log"),
    ]


def test_interval_join(orders, receipts):
    got = jobs.tx_interval_join(orders, receipts)
    assert rows(got, "pay_tx_id", "pay_order_id", "receipt_pay_channel") == PAIRS
    apart = rows(got.select("pay_order_id", F.col("receipt_ts_ms") - F.col("pay_ts_ms")))
    assert apart == [(11, 5000), (13, -3000), (16, 500), (16, 3000), (17, -1500), (17, 1000)]


def test_reconcile(orders, receipts):
    got = jobs.tx_reconcile(orders, receipts)
    assert rows(got.where("outcome = 'matched'"), "pay_tx_id", "pay_order_id", "receipt_pay_channel") == PAIRS
    assert rows(got.where("outcome = 'unmatched_left'"), "pay_order_id") == [(12,), (15,), (18,)]
    assert rows(got.where("outcome = 'unmatched_right'"), "receipt_tx_id", "receipt_pay_channel") == [
        ("aa02", "cash"), ("aa05", "cash"), ("zz99", "card")
    ]


def test_one_to_one(orders, receipts):
    found = jobs.tx_reconcile_one_to_one(orders, receipts)
    pairs = (
        found.where("outcome = 'matched'")
        .join(orders.select(F.col("seq").alias("left_seq"), "order_id"), "left_seq")
        .join(receipts.select(F.col("seq").alias("right_seq"), "pay_channel"), "right_seq")
    )
    assert rows(pairs, "order_id", "pay_channel") == [(11, "card"), (13, "card"), (16, "card"), (17, "cash")]
    assert rows(found.where("outcome <> 'matched'").groupBy("outcome").count()) == [
        ("unmatched_left", 3), ("unmatched_right", 3)
    ]


def test_row_order_does_not_matter(orders, receipts):
    mixed = orders.repartition(5).sortWithinPartitions(F.desc("ts_ms"))
    assert rows(jobs.order_timeout_pattern(mixed)) == rows(jobs.order_timeout_pattern(orders))
    assert rows(jobs.tx_reconcile_one_to_one(mixed, receipts.repartition(3)).fillna(-1)) == rows(
        jobs.tx_reconcile_one_to_one(orders, receipts).fillna(-1)
    )
