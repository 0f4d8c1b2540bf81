"""Row types of the event streams and of the results."""

from __future__ import annotations

from pyspark.sql import types as T


def _row(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


LONG, INT, TEXT = T.LongType(), T.IntegerType(), T.StringType()

USER_BEHAVIOR = _row(user_id=LONG, item_id=LONG, category_id=INT, behavior=TEXT, timestamp=LONG)
APACHE_LOG = _row(ip=TEXT, user_id=TEXT, timestamp=LONG, method=TEXT, url=TEXT)
MARKETING_BEHAVIOR = _row(user_id=LONG, behavior=TEXT, channel=TEXT, timestamp=LONG)
AD_CLICK = _row(user_id=LONG, ad_id=LONG, province=TEXT, city=TEXT, timestamp=LONG)
LOGIN_EVENT = _row(user_id=LONG, ip=TEXT, login_state=TEXT, timestamp=LONG)
ORDER_EVENT = _row(order_id=LONG, event_type=TEXT, tx_id=TEXT, timestamp=LONG)
RECEIPT_EVENT = _row(tx_id=TEXT, pay_channel=TEXT, timestamp=LONG)

ITEM_VIEW_COUNT = _row(item_id=LONG, window_end_ms=LONG, cnt=LONG)
PAGE_VIEW_COUNT = _row(url=TEXT, window_end_ms=LONG, cnt=LONG)
CHANNEL_PROMOTION_COUNT = _row(channel=TEXT, behavior=TEXT, window_end_ms=LONG, cnt=LONG)
AD_COUNT_BY_PROVINCE = _row(province=TEXT, window_end_ms=LONG, cnt=LONG)
BLACKLIST_WARNING = _row(user_id=LONG, ad_id=LONG, warning_msg=TEXT)
LOGIN_FAIL_WARNING = _row(user_id=LONG, first_fail_time=LONG, last_fail_time=LONG, warning_msg=TEXT)
ORDER_RESULT = _row(order_id=LONG, result_state=TEXT)
