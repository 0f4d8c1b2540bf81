"""The end-user analyses, each a composition of operators over typed event frames.

Frames carry their fields plus ``ts`` and ``ts_ms`` (see ``with_event_time``) and, where the
order of equal times matters, ``seq``. Parameters default to the analyses' usual values.
Jobs marked "batch or stream" take either kind of frame; a stream must be watermarked.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.time import java_timestamp_text
from clickloom.operators import folds, lateness, lifecycle, matching, patterns, ratelimit
from clickloom.operators.distinct import (
    distinct_bitmap,
    distinct_exact,
    distinct_running,
    distinct_sketch,
)
from clickloom.operators.filters import differs, equals, non_empty
from clickloom.operators.topn import ITEM_LABELS, PAGE_LABELS, render_ranking, top_n
from clickloom.operators.windows import (
    WINDOW_END,
    labelled_total,
    salted_count,
    windowed_count,
)

SECOND, MINUTE = timedelta(seconds=1), timedelta(minutes=1)


# --- items and pages -------------------------------------------------------------------


def item_view_counts(
    behavior: DataFrame, size: timedelta = MINUTE, slide: timedelta = 5 * SECOND, view: str = "pv"
) -> DataFrame:
    """Views per item and sliding window. Batch or stream."""
    return windowed_count(equals(behavior, "behavior", view), ["item_id"], size, slide)


def hot_items(
    behavior: DataFrame,
    n: int = 5,
    size: timedelta = MINUTE,
    slide: timedelta = 5 * SECOND,
    view: str = "pv",
) -> DataFrame:
    """The most viewed items of each window."""
    return top_n(item_view_counts(behavior, size, slide, view), n, "item_id")


def hot_items_report(behavior: DataFrame, **options) -> DataFrame:
    """The hot items of each window as a block of text."""
    return render_ranking(hot_items(behavior, **options), "item_id", ITEM_LABELS)


def page_counts(
    log: DataFrame, size: timedelta = MINUTE, slide: timedelta = 5 * SECOND, method: str = "GET"
) -> DataFrame:
    """Requests per page and sliding window. Batch or stream."""
    return windowed_count(equals(log, "method", method), ["url"], size, slide)


def hot_pages(
    log: DataFrame,
    n: int = 3,
    size: timedelta = MINUTE,
    slide: timedelta = 5 * SECOND,
    method: str = "GET",
) -> DataFrame:
    """The most requested pages of each window, for a log in time order."""
    return top_n(page_counts(log, size, slide, method), n, "url")


def hot_pages_report(log: DataFrame, **options) -> DataFrame:
    """The hot pages of each window as a block of text."""
    return render_ranking(hot_pages(log, **options), "url", PAGE_LABELS)


def pages_by_lateness(
    log: DataFrame,
    arrival: list[str],
    bound: timedelta = SECOND,
    size: timedelta = MINUTE,
    slide: timedelta = 5 * SECOND,
    allowed: timedelta = MINUTE,
    method: str = "GET",
) -> DataFrame:
    """Requests tagged late or on time, for a log in arrival order.

    Every row moves the watermark; only requests by the method are tagged and kept.
    """
    seen = lateness.arrival_watermark(log, arrival, bound)
    return lateness.tag_late(equals(seen, "method", method), size, slide, allowed)


def hot_pages_in_time(
    tagged: DataFrame,
    n: int = 3,
    size: timedelta = MINUTE,
    slide: timedelta = 5 * SECOND,
    allowed: timedelta = MINUTE,
) -> DataFrame:
    """The final ranking after all updates by rows within the allowed lateness."""
    return top_n(lateness.accepted_counts(tagged, ["url"], size, slide, allowed), n, "url")


# --- traffic ---------------------------------------------------------------------------


def page_view(
    behavior: DataFrame, size: timedelta = 10 * SECOND, view: str = "pv", label: str = "pv"
) -> DataFrame:
    """Page views per window under a label."""
    return labelled_total(equals(behavior, "behavior", view), label, size)


def page_view_salted(
    behavior: DataFrame,
    size: timedelta = 10 * SECOND,
    salt_by: str = "seq",
    view: str = "pv",
    label: str = "pv",
) -> DataFrame:
    """Page views per window, counted per salt first. Batch or stream."""
    counts = salted_count(equals(behavior, "behavior", view), size, [salt_by])
    return counts.select(F.lit(label).alias("label"), WINDOW_END, "cnt")


def unique_visitor(behavior: DataFrame, size: timedelta = MINUTE, view: str = "pv") -> DataFrame:
    """Exact distinct visitors per window. Batch or stream."""
    return distinct_exact(equals(behavior, "behavior", view), "user_id", size)


def unique_visitor_bitmap(behavior: DataFrame, size: timedelta = MINUTE, view: str = "pv") -> DataFrame:
    """Distinct visitors per window by hashed bitmap."""
    return distinct_bitmap(equals(behavior, "behavior", view), "user_id", size)


def unique_visitor_running(behavior: DataFrame, size: timedelta = MINUTE, view: str = "pv") -> DataFrame:
    """Every change of a window's visitor count, as a trigger on each row would show it."""
    return distinct_running(equals(behavior, "behavior", view), "user_id", "seq", size)


def unique_visitor_sketch(behavior: DataFrame, size: timedelta = MINUTE, view: str = "pv") -> DataFrame:
    """Approximate distinct visitors per window. Batch or stream."""
    return distinct_sketch(equals(behavior, "behavior", view), "user_id", size)


def window_event_count(events: DataFrame, size: timedelta = 5 * SECOND) -> DataFrame:
    """All rows per window. Batch or stream."""
    return windowed_count(events, [], size)


# --- marketing and advertising ---------------------------------------------------------


def channel_promotion(
    behavior: DataFrame, size: timedelta = 10 * SECOND, excluded: str = "UNINSTALL", zone: str = "UTC"
) -> DataFrame:
    """Rows per channel, behaviour and window, but for one behaviour. Batch or stream."""
    counts = windowed_count(differs(behavior, "behavior", excluded), ["channel", "behavior"], size)
    return counts.withColumn("window_end", java_timestamp_text(F.col(WINDOW_END), zone))


def marketing_total(
    behavior: DataFrame, size: timedelta = 5 * SECOND, excluded: str = "UNINSTALL"
) -> DataFrame:
    """All such rows per window under the label ``total``."""
    return labelled_total(differs(behavior, "behavior", excluded), "total", size)


AD_KEYS = ["user_id", "ad_id"]
# Fixed value: the day of the cap starts at midnight eight hours ahead of UTC.
AD_ZONE = "+08:00"


def ad_clicks_capped(clicks: DataFrame, cap: int = 10, zone: str = AD_ZONE) -> DataFrame:
    """Clicks tagged ``passed`` or ``warning`` by the daily cap per user and ad."""
    return ratelimit.daily_cap(clicks, AD_KEYS, "seq", cap, zone)


def ad_blacklist(capped: DataFrame, cap: int = 10) -> DataFrame:
    """One warning per user, ad and day beyond the cap."""
    return ratelimit.cap_warnings(capped, AD_KEYS, cap)


def ad_by_province(
    capped: DataFrame,
    size: timedelta = 20 * SECOND,
    slide: timedelta = 5 * SECOND,
    zone: str = "UTC",
) -> DataFrame:
    """Clicks under the cap per province and sliding window."""
    counts = windowed_count(ratelimit.passed_rows(capped), ["province"], size, slide)
    return counts.withColumn("window_end", java_timestamp_text(F.col(WINDOW_END), zone))


# --- failed logins ---------------------------------------------------------------------


def _warning(found: DataFrame, message) -> DataFrame:
    return found.select(
        "user_id",
        F.col("first_ts_ms").alias("first_fail_time"),
        F.col("last_ts_ms").alias("last_fail_time"),
        message.alias("warning_msg"),
    )


def _failed(fail: str):
    return F.coalesce(F.col("login_state") == fail, F.lit(False))


def span_text(span: timedelta) -> str:
    """A span in its largest whole unit, as in ``1min`` or ``10s``."""
    for unit, name in ((timedelta(days=1), "d"), (timedelta(hours=1), "h"), (MINUTE, "min"), (SECOND, "s")):
        if span >= unit and not span % unit:
            return f"{span // unit}{name}"
    return f"{span // timedelta(milliseconds=1)}ms"


# The words of the warnings.
def failure_text(times: int, within: timedelta) -> str:
    return f"login fail {times} times in {span_text(within)}"


def pattern_text(times: int, within: timedelta) -> str:
    return f"login fail in {span_text(within)} for {times} times."


def login_fail_anchored(
    logins: DataFrame, times: int = 3, within: timedelta = MINUTE, fail: str = "fail"
) -> DataFrame:
    """Alerts raised by each failure that completes a series since the oldest kept failure."""
    found = folds.anchored_failures(logins, ["user_id"], "seq", _failed(fail), times, within)
    return _warning(found, F.lit(failure_text(times, within)))


def login_fail_sliding(
    logins: DataFrame, times: int = 3, within: timedelta = MINUTE, fail: str = "fail"
) -> DataFrame:
    """Alerts for every ``times`` adjacent failures within the span, ends included."""
    found = patterns.consecutive(logins, ["user_id"], "seq", _failed(fail), times, within, True)
    return _warning(found, F.lit(failure_text(times, within)))


def login_fail_timer(
    logins: DataFrame, times: int = 3, within: timedelta = MINUTE, fail: str = "fail"
) -> DataFrame:
    """One alert at the end of a span that a first failure opened and no success ended."""
    found = folds.timer_failures(logins, ["user_id"], "seq", _failed(fail), times, within)
    # Fixed value: the text says 2s whatever the span.
    text = F.concat(F.lit("login fail in 2s for "), F.col("fails").cast("string"), F.lit("times."))
    return _warning(found, text)


def login_fail_pattern(
    logins: DataFrame, times: int = 5, within: timedelta = 10 * SECOND, fail: str = "fail"
) -> DataFrame:
    """Overlapping runs of adjacent failures within a span."""
    found = patterns.consecutive(logins, ["user_id"], "seq", _failed(fail), times, within)
    return _warning(found, F.lit(pattern_text(times, within)))


def login_fail_sequence(
    logins: DataFrame, steps: list[str], within: timedelta = 10 * SECOND
) -> DataFrame:
    """Adjacent rows whose login states follow ``steps`` exactly."""
    states = [F.coalesce(F.col("login_state") == s, F.lit(False)) for s in steps]
    found = patterns.strict_sequence(logins, ["user_id"], "seq", states, within)
    return _warning(found, F.lit(pattern_text(len(steps), within)))


# --- orders and payments ---------------------------------------------------------------

CREATE, PAY = "create", "pay"


def order_timeout_pattern(
    orders: DataFrame, within: timedelta = 15 * MINUTE, create: str = CREATE, pay: str = PAY
) -> DataFrame:
    """For each create: ``payed`` by a later pay in time, or the text of its timeout."""
    kind = F.col("event_type")
    found = patterns.followed_by(orders, ["order_id"], "seq", kind == create, kind == pay, within)
    return patterns.order_pattern_result(found, "order_id", within)


def order_timeout(
    orders: DataFrame,
    within: timedelta = 15 * MINUTE,
    max_early: timedelta | None = 15 * MINUTE,
    create: str = CREATE,
    pay: str = PAY,
) -> DataFrame:
    """One outcome per order from its first create and pay."""
    kind = F.col("event_type")
    return lifecycle.order_outcomes(orders, "order_id", kind == create, kind == pay, within, max_early)


def order_timeout_cycles(
    orders: DataFrame,
    within: timedelta = 15 * MINUTE,
    max_early: timedelta | None = 15 * MINUTE,
    create: str = CREATE,
    pay: str = PAY,
) -> DataFrame:
    """Every create/pay cycle of orders whose events repeat."""
    kind = F.col("event_type")
    return folds.order_cycles(orders, "order_id", "seq", kind == create, kind == pay, within, max_early)


def paid_transactions(orders: DataFrame, pay: str = PAY) -> DataFrame:
    """Pay events that name a transaction. Batch or stream."""
    return non_empty(equals(orders, "event_type", pay), "tx_id")


PAIR_PREFIXES = ("pay_", "receipt_")
# A receipt may come 3 s before to 5 s after its payment.
BEFORE, AFTER = 3 * SECOND, 5 * SECOND


def tx_interval_join(
    orders: DataFrame,
    receipts: DataFrame,
    before: timedelta = BEFORE,
    after: timedelta = AFTER,
    pay: str = PAY,
) -> DataFrame:
    """Pay and receipt of a transaction that lie close in time. Batch or stream."""
    pays = paid_transactions(orders, pay)
    return matching.interval_join(pays, receipts, "tx_id", before, after, PAIR_PREFIXES)


def tx_reconcile(
    orders: DataFrame,
    receipts: DataFrame,
    before: timedelta = BEFORE,
    after: timedelta = AFTER,
    pay: str = PAY,
) -> DataFrame:
    """All matched pairs, and the pays and receipts that match nothing."""
    pays = paid_transactions(orders, pay)
    return matching.reconcile(pays, receipts, "tx_id", before, after, PAIR_PREFIXES)


def tx_reconcile_one_to_one(
    orders: DataFrame,
    receipts: DataFrame,
    before: timedelta = BEFORE,
    after: timedelta = AFTER,
    pay: str = PAY,
) -> DataFrame:
    """Pairs in which each pay and each receipt occurs once, first come first served.

    Both frames need ``seq``; it must differ between rows of the same frame.
    """
    pays = paid_transactions(orders, pay)
    return folds.pair_one_to_one(pays, receipts, "tx_id", "seq", before, after)
