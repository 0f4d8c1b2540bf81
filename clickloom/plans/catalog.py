"""Every registered query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import schemas
from clickloom.functions.hashing import poly_hash
from clickloom.functions.time import (
    TS,
    TS_MS,
    display_shift,
    format_ms,
    java_timestamp_text,
    next_midnight_ms,
)
from clickloom.operators import matching, patterns
from clickloom.operators.accumulate import TrimmedMean, accumulate
from clickloom.operators.topn import descending
from clickloom.operators.windows import windowed_count
from clickloom.plans import frames, jobs, sql
from clickloom.session import shared_folder, stateful_session
from clickloom.sources import files, kafka
from clickloom.sources.sinks import append_files, by_outcome, each_batch, run_to_end
from clickloom.streaming import jobs as stream_jobs
from clickloom.streaming import processors
from clickloom.streaming.rankings import InTimeRanking, RankedCounts, ranking_changes

Query = Callable[[SparkSession, str], DataFrame]

MINUTE, HOUR, DAY = timedelta(minutes=1), timedelta(hours=1), timedelta(days=1)
# The tables hold 30 days with minutes between rows, so windows are days instead of minutes.
DAILY = {"size": DAY, "slide": HOUR}
LATE = {"size": HOUR, "slide": 5 * MINUTE, "allowed": 60 * MINUTE}
FEW, MORE = {"times": 2, "within": 24 * HOUR}, {"times": 3, "within": 48 * HOUR}
ORDER = {"within": 12 * HOUR, "create": "view", "pay": "purchase"}
NEAR = {"before": 3 * HOUR, "after": 5 * HOUR}

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- batch -----------------------------------------------------------------------------


@query
def hot_items(spark, sf):
    return jobs.hot_items(frames.behavior(frames.events(spark, sf)), view="view", **DAILY)


@query
def hot_items_report(spark, sf):
    return jobs.hot_items_report(frames.behavior(frames.events(spark, sf)), view="view", **DAILY)


@query
def hot_items_table_sql(spark, sf):
    return sql.hot_items_from_table(frames.behavior(frames.events(spark, sf)), view="view", **DAILY)


@query
def hot_items_sql(spark, sf):
    return sql.hot_items_in_sql(frames.behavior(frames.events(spark, sf)), view="view", **DAILY)


@query
def hot_pages(spark, sf):
    return jobs.hot_pages(frames.page_log(frames.events(spark, sf)), method="click", **DAILY)


@query
def hot_pages_report(spark, sf):
    return jobs.hot_pages_report(frames.page_log(frames.events(spark, sf)), method="click", **DAILY)


def _late_pages(spark, sf):
    log = frames.late_page_log(frames.events(spark, sf))
    return jobs.pages_by_lateness(log, ["arrival_ms", "seq"], 10 * MINUTE, method="click", **LATE)


@query
def hot_pages_late(spark, sf):
    rows = _late_pages(spark, sf).where(F.col("outcome") == "late")
    return rows.select("seq", "url", TS_MS, "arrival_ms", "wm_ms")


@query
def hot_pages_in_time(spark, sf):
    return jobs.hot_pages_in_time(_late_pages(spark, sf), **LATE)


@query
def page_view(spark, sf):
    return jobs.page_view(frames.behavior(frames.events(spark, sf)), DAY, view="view")


@query
def page_view_salted(spark, sf):
    return jobs.page_view_salted(frames.behavior(frames.events(spark, sf)), DAY, view="view")


@query
def unique_visitor(spark, sf):
    return jobs.unique_visitor(frames.behavior(frames.events(spark, sf)), DAY, view="view")


@query
def unique_visitor_bitmap(spark, sf):
    return jobs.unique_visitor_bitmap(frames.behavior(frames.events(spark, sf)), DAY, view="view")


@query
def unique_visitor_running(spark, sf):
    return jobs.unique_visitor_running(frames.behavior(frames.events(spark, sf)), DAY, view="view")


@query
def unique_visitor_sketch(spark, sf):
    """Whether each window's estimate lies within three times its relative error of the exact count."""
    rows = frames.behavior(frames.events(spark, sf))
    exact = jobs.unique_visitor(rows, DAY, "view").withColumnRenamed("uv", "exact")
    both = jobs.unique_visitor_sketch(rows, DAY, "view").join(exact, "window_end_ms")
    near = F.abs(F.col("uv") - F.col("exact")) <= F.greatest(F.lit(1.0), 3 * 0.02 * F.col("exact"))
    return both.select("window_end_ms", near.alias("near"))


@query
def visitor_hash(spark, sf):
    users = frames.events(spark, sf).select("user_id").distinct()
    return users.select("user_id", poly_hash(F.col("user_id").cast("string")).alias("offset"))


@query
def window_event_count(spark, sf):
    return jobs.window_event_count(frames.events(spark, sf), DAY)


@query
def channel_promotion(spark, sf):
    return jobs.channel_promotion(frames.marketing(frames.events(spark, sf)), DAY, "signup")


@query
def marketing_total(spark, sf):
    return jobs.marketing_total(frames.marketing(frames.events(spark, sf)), DAY, "signup")


@query
def item_trimmed_mean(spark, sf):
    """An aggregate of the user's own, per behaviour and sliding window."""
    rows = frames.behavior(frames.events(spark, sf))
    return accumulate(rows, ["behavior"], TrimmedMean(), ["item_id"], DAY, HOUR, "mean")


@query
def user_trimmed_mean(spark, sf):
    rows = frames.behavior(frames.events(spark, sf))
    return accumulate(rows, ["user_id"], TrimmedMean(), ["item_id"], 7 * DAY, None, "mean")


def _capped(spark, sf):
    return jobs.ad_clicks_capped(frames.ad_clicks(frames.events(spark, sf)), 1, "UTC")


@query
def ad_cap_passed(spark, sf):
    passed = _capped(spark, sf).where(F.col("outcome") == "passed")
    return passed.select("user_id", "ad_id", "province", TS_MS, "seq")


@query
def ad_blacklist(spark, sf):
    return jobs.ad_blacklist(_capped(spark, sf), 1)


@query
def ad_by_province(spark, sf):
    return jobs.ad_by_province(_capped(spark, sf), DAY, 6 * HOUR)


@query
def login_fail_sliding(spark, sf):
    return jobs.login_fail_sliding(frames.logins(frames.events(spark, sf)), fail="error", **FEW)


@query
def login_fail_anchored(spark, sf):
    return jobs.login_fail_anchored(frames.logins(frames.events(spark, sf)), fail="error", **FEW)


@query
def login_fail_anchored_three(spark, sf):
    return jobs.login_fail_anchored(frames.logins(frames.events(spark, sf)), fail="error", **MORE)


@query
def login_fail_timer(spark, sf):
    return jobs.login_fail_timer(frames.logins(frames.events(spark, sf)), fail="error", **FEW)


@query
def login_fail_timer_three(spark, sf):
    return jobs.login_fail_timer(frames.logins(frames.events(spark, sf)), fail="error", **MORE)


@query
def login_fail_pattern(spark, sf):
    return jobs.login_fail_pattern(frames.logins(frames.events(spark, sf)), fail="error", **MORE)


@query
def login_fail_sequence(spark, sf):
    rows = frames.logins(frames.events(spark, sf))
    return jobs.login_fail_sequence(rows, ["error", "error", "view"], 48 * HOUR)


@query
def order_timeout_pattern(spark, sf):
    return jobs.order_timeout_pattern(frames.user_orders(frames.events(spark, sf)), **ORDER)


@query
def order_timeout(spark, sf):
    return jobs.order_timeout(frames.shop_orders(spark, sf), 365 * DAY, None)


@query
def order_timeout_early(spark, sf):
    return jobs.order_timeout(frames.shop_orders(spark, sf), 365 * DAY, 30 * DAY)


@query
def order_timeout_cycles(spark, sf):
    rows = frames.user_orders(frames.events(spark, sf))
    return jobs.order_timeout_cycles(rows, max_early=6 * HOUR, **ORDER)


def _pay_receipt(spark, sf):
    rows = frames.events(spark, sf)
    return frames.payments(rows), frames.receipts(rows)


PAIR = ["pay_tx_id", "pay_seq", "pay_ts_ms", "receipt_tx_id", "receipt_seq", "receipt_ts_ms"]


@query
def tx_interval_join(spark, sf):
    pays, receipts = _pay_receipt(spark, sf)
    return jobs.tx_interval_join(pays, receipts, pay="view", **NEAR).select(*PAIR)


@query
def tx_reconcile(spark, sf):
    pays, receipts = _pay_receipt(spark, sf)
    return jobs.tx_reconcile(pays, receipts, pay="view", **NEAR).select(*PAIR, "outcome")


@query
def tx_reconcile_one_to_one(spark, sf):
    pays, receipts = _pay_receipt(spark, sf)
    return jobs.tx_reconcile_one_to_one(pays, receipts, pay="view", **NEAR)


@query
def tx_connect(spark, sf):
    pays, receipts = _pay_receipt(spark, sf)
    both = matching.connect(jobs.paid_transactions(pays, "view"), receipts)
    return both.groupBy("tx_id", "side").agg(F.count("*").alias("cnt"), F.count("event_type").alias("typed"))


@query
def record_codec(spark, sf):
    rows = frames.behavior(frames.events(spark, sf))
    typed = rows.select("user_id", "item_id", F.lit(1).alias("category_id"), "behavior", F.col(TS_MS).alias("timestamp"))
    return kafka.decode_json(kafka.encode_json(typed, ["user_id"]), schemas.USER_BEHAVIOR)


@query
def delimited_lines(spark, sf):
    rows = frames.events(spark, sf)
    tx = F.when(F.col("event_type") == "purchase", F.col("seq").cast("string")).otherwise("")
    line = F.concat_ws(",", F.col("user_id").cast("string"), "event_type", tx, F.col(TS_MS).cast("string"))
    return files.split_line(rows.select(line.alias("value")), schemas.ORDER_EVENT)


def _as_file(spark, name, *columns):
    """Rows as comma-separated lines in the shared folder, for the delimited readers."""

    def write(rows: DataFrame) -> str:
        path = shared_folder(spark, name)
        rows.select(F.concat_ws(",", *columns).alias("value")).write.text(path)
        return path

    return write


@query
def order_file(spark, sf):
    tx = F.when(F.col("event_type") == "purchase", F.col("seq").cast("string")).otherwise("")
    write = _as_file(spark, "order_file", F.col("user_id").cast("string"), "event_type", tx, F.col(TS_MS).cast("string"))
    rows = files.order_events(spark, write(frames.events(spark, sf)))
    return rows.select("order_id", "event_type", "tx_id", TS_MS)


@query
def receipt_file(spark, sf):
    write = _as_file(spark, "receipt_file", F.col("seq").cast("string"), "event_type", F.col(TS_MS).cast("string"))
    paid = frames.events(spark, sf).where(F.col("event_type") == "purchase")
    return files.receipt_events(spark, write(paid)).select("tx_id", "pay_channel", TS_MS)


@query
def hot_items_descending(spark, sf):
    """The items of most views, in falling order; a report of the first fifty."""
    views = frames.behavior(frames.events(spark, sf)).where(F.col("behavior") == "view")
    counts = views.groupBy("item_id").agg(F.count(F.lit(1)).alias("cnt"))
    first = descending(counts, "cnt", "item_id").limit(50)
    place = F.row_number().over(Window.orderBy(F.desc("cnt"), "item_id")).cast("bigint")
    return first.withColumn("place", place)


@query
def time_texts(spark, sf):
    rows = frames.events(spark, sf)
    return rows.select(
        "seq",
        format_ms(F.col(TS_MS)).alias("formatted"),
        format_ms(F.col(TS_MS), zone="+08:00").alias("shifted"),
        java_timestamp_text(F.col(TS_MS)).alias("full_text"),
        next_midnight_ms(F.col(TS_MS), 8 * HOUR).alias("next_midnight_ms"),
        F.unix_millis(display_shift(TS)).alias("display_ms"),
    )


# --- streams ---------------------------------------------------------------------------


def _stream(spark: SparkSession, sf: str) -> DataFrame:
    return frames.event_stream(stateful_session(spark), sf)


def _disturbed(spark: SparkSession, sf: str) -> DataFrame:
    return frames.disturbed_stream(stateful_session(spark), sf)


@query
def stream_hot_items(spark, sf):
    views = frames.behavior(_stream(spark, sf)).where(F.col("behavior") == "view")
    counts = windowed_count(views, ["item_id"], DAY, HOUR, chained=True)
    return stream_jobs.rank_closed_windows(counts, spark, "hot_items", 5, "item_id")


@query
def stream_hot_items_sql(spark, sf):
    counts = sql.counted_in_sql(frames.behavior(_stream(spark, sf)), DAY, HOUR, "view")
    schema = T.StructType([*counts.schema, T.StructField("row_num", T.LongType())])
    return each_batch(counts, spark, "hot_items_sql", schema, lambda batch: sql.ranked_in_sql(batch, 5))


def _hot_item_changes(spark, sf) -> RankedCounts:
    views = frames.behavior(_disturbed(spark, sf)).where((F.col("behavior") == "view") & F.col("item_id").isNotNull())
    return ranking_changes(windowed_count(views, ["item_id"], DAY, HOUR), spark, "hot_item_changes", 5, "item_id")


@query
def stream_hot_items_retract(spark, sf):
    """The rankings that the added and taken back rows add up to."""
    return _hot_item_changes(spark, sf).folded()


@query
def stream_hot_items_changes(spark, sf):
    """How many rows each window's ranking added and took back while the stream ran."""
    changes = _hot_item_changes(spark, sf).changes()
    return changes.groupBy("window_end_ms").agg(
        F.count_if("added").alias("added"), F.count_if(~F.col("added")).alias("taken_back")
    )


@query
def stream_hot_pages_one_pass(spark, sf):
    """Rankings by what came in time, and the rows that came too late, out of one stream."""
    log = frames.late_page_log(frames.arriving_stream(stateful_session(spark), sf))
    key = T.StructField("url", T.StringType())
    one_pass = InTimeRanking(
        spark, "hot_pages_one_pass", key, 3, ["arrival_ms", "seq"], 10 * MINUTE, HOUR, 5 * MINUTE, 60 * MINUTE, ("method", "click")
    )
    ranked, late = one_pass.run(log)
    late = late.select(F.lit("late").alias("output"), "seq", "url", TS_MS, "arrival_ms", "wm_ms")
    return ranked.withColumn("output", F.lit("ranking")).unionByName(late, allowMissingColumns=True)


@query
def stream_hot_pages_updated(spark, sf):
    rows = frames.event_stream(stateful_session(spark), sf, closed=False)
    counts = jobs.page_counts(frames.page_log(rows), DAY, HOUR, "click")
    return stream_jobs.rank_updated_windows(counts, spark, "hot_pages", 3, "url")


@query
def stream_hot_pages_late_updates(spark, sf):
    counts = jobs.page_counts(frames.page_log(_disturbed(spark, sf)), DAY, HOUR, "click")
    ranked = stream_jobs.rank_updated_windows(counts, spark, "hot_pages_late", 3, "url")
    return ranked.where(F.col("url").isNotNull())  # the closing rows have none


@query
def stream_page_view_salted(spark, sf):
    counts = jobs.page_view_salted(frames.behavior(_stream(spark, sf)), DAY, view="view")
    return append_files(counts, spark, "page_view")


@query
def stream_unique_visitor(spark, sf):
    counts = jobs.unique_visitor(frames.behavior(_stream(spark, sf)), DAY, view="view")
    return append_files(counts, spark, "unique_visitor")


@query
def stream_unique_visitor_bitmap(spark, sf):
    views = frames.behavior(_stream(spark, sf)).where(F.col("behavior") == "view")
    return append_files(stream_jobs.visitors_bitmap(views, DAY), spark, "unique_visitor_bitmap")


@query
def stream_unique_visitor_updating(spark, sf):
    rows = frames.event_stream(stateful_session(spark), sf, closed=False)
    views = frames.behavior(rows).where(F.col("behavior") == "view")
    return stream_jobs.visitors_updating(views, spark, DAY)


@query
def stream_unique_visitor_running(spark, sf):
    views = frames.behavior(_disturbed(spark, sf)).where(F.col("behavior") == "view")
    return stream_jobs.visitors_running(processors.stream_first_visits(views, "user_id", DAY), spark)


@query
def stream_window_event_count(spark, sf):
    return append_files(windowed_count(_stream(spark, sf), [], DAY), spark, "window_event_count")


@query
def stream_channel_promotion(spark, sf):
    counts = jobs.channel_promotion(frames.marketing(_stream(spark, sf)), DAY, "signup")
    return append_files(counts, spark, "channel_promotion")


@query
def stream_ad_cap(spark, sf):
    return _stream_ad_cap(spark, _stream(spark, sf))


@query
def stream_ad_cap_out_of_order(spark, sf):
    return _stream_ad_cap(spark, _disturbed(spark, sf))


def _stream_ad_cap(spark, rows):
    capped = processors.stream_daily_cap(frames.ad_clicks(rows), jobs.AD_KEYS, 1)
    return append_files(capped, spark, "ad_cap").select("user_id", "ad_id", "seq", "outcome")


@query
def stream_ad_blacklist(spark, sf):
    """Passed rows and warnings go to folders of their own; these are the warnings."""
    capped = processors.stream_daily_cap(frames.ad_clicks(_stream(spark, sf)), jobs.AD_KEYS, 1)
    folder = shared_folder(spark, "ad_side")
    writer = capped.writeStream.foreachBatch(by_outcome(f"{folder}/rows", ["passed", "warning"]))
    run_to_end(writer, f"{folder}/checkpoint")
    fields = [f for f in capped.schema if f.name != "outcome"]
    schema = T.StructType([*fields, T.StructField("outcome", T.StringType())])
    return jobs.ad_blacklist(spark.read.schema(schema).parquet(f"{folder}/rows"), 1)


@query
def stream_ad_by_province(spark, sf):
    capped = processors.stream_daily_cap(frames.ad_clicks(_stream(spark, sf)), jobs.AD_KEYS, 1)
    counts = jobs.ad_by_province(capped, DAY, 6 * HOUR)
    return append_files(counts, spark, "ad_by_province")


@query
def stream_marketing_total(spark, sf):
    counts = jobs.marketing_total(frames.marketing(_stream(spark, sf)), DAY, "signup")
    return append_files(counts, spark, "marketing_total")


def _stream_failures(spark, stream, rule, times, within, inclusive=False):
    rows = frames.logins(stream)
    fail = F.col("login_state") == "error"
    found = processors.stream_failures(rows, ["user_id"], fail, times, within, rule, inclusive)
    return append_files(found, spark, f"login_fail_{rule}")


@query
def stream_login_fail_anchored(spark, sf):
    return _stream_failures(spark, _stream(spark, sf), "anchored", **FEW)


@query
def stream_login_fail_anchored_out_of_order(spark, sf):
    return _stream_failures(spark, _disturbed(spark, sf), "anchored", **FEW)


@query
def stream_login_fail_timer(spark, sf):
    return _stream_failures(spark, _stream(spark, sf), "timer", **FEW)


@query
def stream_login_fail_timer_out_of_order(spark, sf):
    return _stream_failures(spark, _disturbed(spark, sf), "timer", **FEW)


@query
def stream_login_fail_pattern(spark, sf):
    return _stream_failures(spark, _stream(spark, sf), "consecutive", **MORE)


@query
def stream_login_fail_pattern_out_of_order(spark, sf):
    return _stream_failures(spark, _disturbed(spark, sf), "consecutive", **MORE)


@query
def stream_login_fail_sliding(spark, sf):
    return _stream_failures(spark, _stream(spark, sf), "consecutive", **FEW, inclusive=True)


@query
def stream_login_fail_sequence(spark, sf):
    rows = frames.logins(_stream(spark, sf))
    steps = [F.col("login_state") == s for s in ("error", "error", "view")]
    return append_files(processors.stream_sequence(rows, ["user_id"], steps, 48 * HOUR), spark, "login_sequence")


@query
def stream_order_timeout_pattern(spark, sf):
    return _stream_order_pattern(spark, _stream(spark, sf))


@query
def stream_order_timeout_pattern_out_of_order(spark, sf):
    return _stream_order_pattern(spark, _disturbed(spark, sf))


def _stream_order_pattern(spark, stream):
    rows = frames.user_orders(stream)
    kind = F.col("event_type")
    found = processors.stream_followed_by(
        rows, ["order_id"], kind == "view", kind == "purchase", ORDER["within"]
    )
    found = append_files(found, spark, "order_pattern")
    return patterns.order_pattern_result(found, "order_id", ORDER["within"])


@query
def stream_order_timeout_cycles(spark, sf):
    return _stream_order_cycles(spark, _stream(spark, sf))


@query
def stream_order_timeout_cycles_out_of_order(spark, sf):
    return _stream_order_cycles(spark, _disturbed(spark, sf))


def _stream_order_cycles(spark, stream):
    rows = frames.user_orders(stream)
    kind = F.col("event_type")
    found = processors.stream_order_lifecycle(
        rows, "order_id", kind == "view", kind == "purchase", ORDER["within"], 6 * HOUR, 365 * DAY
    )
    return append_files(found, spark, "order_cycles")


def _two_streams(spark, sf):
    session = stateful_session(spark)
    pays = jobs.paid_transactions(frames.payments(frames.event_stream(session, sf)), "view")
    return pays, frames.receipts(frames.event_stream(session, sf))


@query
def stream_tx_interval_join(spark, sf):
    pays, receipts = _two_streams(spark, sf)
    pairs = matching.interval_join(pays, receipts, "tx_id", **NEAR, prefixes=jobs.PAIR_PREFIXES)
    return append_files(pairs.select(*PAIR), spark, "tx_join").where(F.col("pay_seq") != frames.RESERVED)


@query
def stream_tx_reconcile(spark, sf):
    pays, receipts = _two_streams(spark, sf)
    pairs = matching.interval_join(
        pays, receipts, "tx_id", **NEAR, prefixes=jobs.PAIR_PREFIXES, how="full_outer"
    )
    outcome = (
        F.when(F.col("receipt_seq").isNull(), matching.UNMATCHED_LEFT)
        .when(F.col("pay_seq").isNull(), matching.UNMATCHED_RIGHT)
        .otherwise(matching.MATCHED)
    )
    found = append_files(pairs.select(*PAIR, outcome.alias("outcome")), spark, "tx_reconcile")
    return found.where(F.coalesce("pay_seq", "receipt_seq") != frames.RESERVED)


@query
def stream_tx_one_to_one(spark, sf):
    return _stream_one_to_one(spark, _stream(spark, sf))


@query
def stream_tx_one_to_one_out_of_order(spark, sf):
    return _stream_one_to_one(spark, _disturbed(spark, sf))


def _stream_one_to_one(spark, stream):
    # One source feeds both sides: a connected stream has one watermark.
    rows = frames.payments(stream).where(F.col("event_type").isin("view", "purchase"))
    side = F.when(F.col("event_type") == "view", matching.LEFT).otherwise(matching.RIGHT)
    found = processors.stream_one_to_one(rows.withColumn("side", side), "tx_id", **NEAR)
    return append_files(found, spark, "tx_one_to_one")


@query
def stream_tx_two_sources(spark, sf):
    """Two sources with delays of their own; receipts come in smaller batches, hence far behind, and later."""
    session = stateful_session(spark)
    pays = jobs.paid_transactions(frames.payments(frames.disturbed_stream(session, sf)), "view")
    lagging = frames.disturbed_stream(session, sf, 2 * DAY, 3, 36 * HOUR)
    both = matching.connect(pays, frames.receipts(lagging))
    return append_files(processors.stream_one_to_one(both, "tx_id", **NEAR), spark, "tx_two_sources")


@query
def stream_late_pages(spark, sf):
    log = frames.late_page_log(frames.event_stream(stateful_session(spark), sf, closed=False))
    router = stream_jobs.LateRouter(
        spark, "late_pages", ["arrival_ms", "seq"], 10 * MINUTE, HOUR, 5 * MINUTE, 60 * MINUTE
    )
    rows = router.run(log).where((F.col("method") == "click") & (F.col("outcome") == "late"))
    return rows.select("seq", "url", TS_MS, "arrival_ms", "wm_ms")
