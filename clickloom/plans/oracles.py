"""The registered queries in plain SQL over the same tables, to check their results.

Times are epoch milliseconds. ``e`` is the event table as the queries see it.
"""

from __future__ import annotations

HOUR = 3_600_000
DAY = 24 * HOUR

E = """e AS (
    SELECT event_id AS seq, epoch_us(ts) // 1000 AS ms, user_id, event_type,
           CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS item_id
    FROM events)"""


def _sliding(select: str, source: str, size: int, slide: int, keys: str, where: str = "true") -> str:
    return f"""
    SELECT {select}, (ms // {slide} + i) * {slide} AS window_end_ms, count(*) AS cnt
    FROM {source}, range(1, {size // slide + 1}) r(i)
    WHERE {where}
    GROUP BY {keys}, (ms // {slide} + i) * {slide}"""


def _ranked(counts: str, key: str, n: int) -> str:
    return f"""
    SELECT {key}, window_end_ms, cnt, row_num FROM (
        SELECT *, row_number() OVER (PARTITION BY window_end_ms ORDER BY cnt DESC, {key}) AS row_num
        FROM ({counts}))
    WHERE row_num <= {n}"""


ITEMS = _sliding("item_id", "e", DAY, HOUR, "item_id", "event_type = 'view'")
URL = "'/p/' || (item_id % 8)"
PAGES = _sliding(f"{URL} AS url", "e", DAY, HOUR, "url", "event_type = 'click'")
HOT_ITEMS = _ranked(ITEMS, "item_id", 5)
STAMP = "strftime(make_timestamp(window_end_ms * 1000), '%Y-%m-%d %H:%M:%S')"

HOT_PAGES = _ranked(PAGES, "url", 3)


def _report(ranked: str, line: str) -> str:
    return f"""WITH {E}
        SELECT window_end_ms,
               '======窗口结束时间：' || {STAMP} || '======' || chr(10)
               || string_agg({line} || chr(10), '' ORDER BY row_num)
               || '===========================================' || chr(10) || chr(10) AS report
        FROM ({ranked}) GROUP BY window_end_ms"""


TUMBLING = f"(ms // {DAY} + 1) * {DAY}"

LATE = f"""WITH {E},
a AS (SELECT *, ms + item_id * 180000 AS arrival_ms FROM e),
w AS (SELECT *, max(ms) OVER (ORDER BY arrival_ms, seq ROWS UNBOUNDED PRECEDING) - 600000 AS wm_ms FROM a),
t AS (SELECT *, {URL} AS url, (ms // 300000) * 300000 + {HOUR} + {HOUR} <= wm_ms AS late
      FROM w WHERE event_type = 'click')"""

CAPPED = f"""WITH {E},
c AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, ms // {DAY} ORDER BY ms, seq) AS nth
      FROM e)"""

# Islands of adjacent errors per user; the row that ends an island belongs to it.
ISLANDS = f"""{E},
n AS (SELECT *, event_type = 'error' AS fail FROM e),
g AS (SELECT *, coalesce(sum(CASE WHEN fail THEN 0 ELSE 1 END) OVER (
          PARTITION BY user_id ORDER BY ms, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS island
      FROM n),
f AS (SELECT *, row_number() OVER (PARTITION BY user_id, island ORDER BY ms, seq) AS i FROM g WHERE fail)"""


def _anchored(times: int, within: int, text: bool = True) -> str:
    fresh = f"len(kept) + 1 >= {times} AND f.ms - kept[1] <= {within}"
    message = f", 'login fail {times} times in {within // DAY}d' AS warning_msg" if text else ""
    first, last = ("first_fail_time", "last_fail_time") if text else ("first_ts_ms", "last_ts_ms")
    return f"""WITH RECURSIVE {ISLANDS},
    fold(user_id, island, i, kept, first, last) AS (
        SELECT user_id, island, CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
        FROM f WHERE i = 1
        UNION ALL
        SELECT f.user_id, f.island, f.i,
               CASE WHEN len(kept) + 1 < {times} OR {fresh} THEN list_append(kept, f.ms) ELSE kept[2:] END,
               CASE WHEN {fresh} THEN kept[1] END,
               CASE WHEN {fresh} THEN f.ms END
        FROM fold JOIN f ON f.user_id = fold.user_id AND f.island = fold.island AND f.i = fold.i + 1)
    SELECT user_id, first AS {first}, last AS {last}{message}
    FROM fold WHERE first IS NOT NULL"""


def _timer(times: int, within: int, stream: bool = False) -> str:
    if stream:
        columns = "user_id, slot AS first_ts_ms, max(ms) AS last_ts_ms, count(*) AS fails"
    else:
        columns = (
            "user_id, slot AS first_fail_time, max(ms) AS last_fail_time, "
            "'login fail in 2s for ' || count(*) || 'times.' AS warning_msg"
        )
    return f"""WITH RECURSIVE {ISLANDS},
    fold(user_id, island, i, slot, ms) AS (
        SELECT user_id, island, i, ms, ms FROM f WHERE i = 1
        UNION ALL
        SELECT f.user_id, f.island, f.i, CASE WHEN f.ms > slot + {within} THEN f.ms ELSE slot END, f.ms
        FROM fold JOIN f ON f.user_id = fold.user_id AND f.island = fold.island AND f.i = fold.i + 1),
    s AS (SELECT user_id, island, ms AS stop FROM g WHERE NOT fail),
    x AS (SELECT fold.user_id, fold.island, slot, ms, stop,
                 nullif(lead(slot) OVER (PARTITION BY fold.user_id, fold.island ORDER BY i), slot) AS later
          FROM fold LEFT JOIN s ON s.user_id = fold.user_id AND s.island = fold.island)
    SELECT {columns}
    FROM x GROUP BY user_id, island, slot
    HAVING count(*) >= {times} AND coalesce(max(stop), slot + {within} + 1) > slot + {within}"""


def _runs(times: int, within: int, compare: str, message: str | None) -> str:
    depth = times - 1
    first, last = ("first_fail_time", "last_fail_time") if message else ("first_ts_ms", "last_ts_ms")
    text = f", '{message}' AS warning_msg" if message else ""
    return f"""WITH {ISLANDS},
    p AS (SELECT *, lag(ms, {depth}) OVER (PARTITION BY user_id, island ORDER BY ms, seq) AS first FROM f)
    SELECT user_id, first AS {first}, ms AS {last}{text}
    FROM p WHERE ms - first {compare} {within}"""


MS_TEXT = "regexp_replace(strftime(make_timestamp({} * 1000), '%Y-%m-%d %H:%M:%S.%g'), '0{{1,2}}$', '')"


def _order_pattern() -> str:
    half = 12 * HOUR
    expired = f"'order create time : ' || {MS_TEXT.format('ms')} || ' |  order timeout : ' || {MS_TEXT.format(f'(ms + {half})')}"
    return f"""WITH {E},
    n AS (SELECT *, min(CASE WHEN event_type = 'purchase' THEN ms END) OVER (
              PARTITION BY user_id ORDER BY ms, seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS pay
          FROM e WHERE event_type IN ('view', 'purchase'))
    SELECT user_id AS order_id, CASE WHEN pay - ms < {half} THEN 'payed' ELSE {expired} END AS result_state,
           CASE WHEN pay - ms < {half} THEN 'matched' ELSE 'timeout' END AS outcome
    FROM n WHERE event_type = 'view'"""


def _shop(within: int, max_early: int | None) -> str:
    early = "false" if max_early is None else f"c - p > {max_early}"
    return f"""WITH c AS (SELECT o_orderkey AS k, epoch_ms(min(o_orderdate)) AS c FROM orders GROUP BY 1),
    p AS (SELECT CASE WHEN l_orderkey % 5 = 0 THEN -l_orderkey ELSE l_orderkey END AS k,
                 epoch_ms(min(l_shipdate)) AS p FROM lineitem GROUP BY 1),
    j AS (SELECT coalesce(c.k, p.k) AS order_id, c, p FROM c FULL JOIN p ON c.k = p.k),
    r AS (
        SELECT order_id, CASE WHEN p IS NULL THEN 'payed timeout'
                              WHEN c IS NULL THEN 'payed but not found created log'
                              WHEN {early} THEN 'payed but not found created log'
                              WHEN p < c + {within} THEN 'payed successfully'
                              ELSE 'payed but already timeout' END AS result_state FROM j
        UNION ALL
        SELECT order_id, 'payed timeout' FROM j WHERE c IS NOT NULL AND p IS NOT NULL AND {early})
    SELECT order_id, result_state,
           CASE WHEN result_state = 'payed successfully' THEN 'main' ELSE 'side' END AS output FROM r"""


def _cycles(within: int, early: int) -> str:
    return f"""WITH RECURSIVE {E},
    o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ms, event_type DESC, seq) AS i,
                 count(*) OVER (PARTITION BY user_id) AS n
          FROM e WHERE event_type IN ('view', 'purchase')),
    fold(user_id, i, n, state, state_since, code, c, p) AS (
        SELECT user_id, CAST(1 AS BIGINT), n, event_type, ms, CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
        FROM o WHERE i = 1
        UNION ALL
        SELECT o.user_id, o.i, o.n,
               CASE WHEN state IS NULL THEN o.event_type
                    WHEN state = o.event_type THEN state
                    WHEN state = 'purchase' AND o.ms - state_since > {early} THEN o.event_type END,
               CASE WHEN state IS NULL THEN o.ms
                    WHEN state = o.event_type THEN state_since
                    WHEN state = 'purchase' AND o.ms - state_since > {early} THEN o.ms END,
               CASE WHEN state IS NULL OR state = o.event_type THEN NULL
                    WHEN state = 'view' AND o.ms < state_since + {within} THEN 'payed successfully'
                    WHEN state = 'view' THEN 'payed but already timeout'
                    WHEN o.ms - state_since <= {early} THEN 'payed successfully'
                    ELSE 'payed but not found created log' END,
               CASE WHEN state = 'view' AND o.event_type = 'purchase' THEN state_since
                    WHEN state = 'purchase' AND o.event_type = 'view' AND o.ms - state_since <= {early} THEN o.ms END,
               CASE WHEN state = 'view' AND o.event_type = 'purchase' THEN o.ms
                    WHEN state = 'purchase' AND o.event_type = 'view' THEN state_since END
        FROM fold JOIN o ON o.user_id = fold.user_id AND o.i = fold.i + 1),
    r AS (
        SELECT user_id AS order_id, c AS create_ms, p AS pay_ms, code AS result_state FROM fold WHERE code IS NOT NULL
        UNION ALL
        SELECT user_id, CASE WHEN state = 'view' THEN state_since END,
               CASE WHEN state = 'purchase' THEN state_since END,
               CASE WHEN state = 'view' THEN 'payed timeout' ELSE 'payed but not found created log' END
        FROM fold WHERE i = n AND state IS NOT NULL)
    SELECT *, CASE WHEN result_state = 'payed successfully' THEN 'main' ELSE 'side' END AS output FROM r"""


SIDES = f"""{E},
p AS (SELECT CAST(user_id AS VARCHAR) AS tx, seq, ms FROM e WHERE event_type = 'view'),
r AS (SELECT CAST(user_id AS VARCHAR) AS tx, seq, ms FROM e WHERE event_type = 'purchase')"""
NEAR = f"p.tx = r.tx AND r.ms BETWEEN p.ms - {3 * HOUR} AND p.ms + {5 * HOUR}"
PAIRS = f"""SELECT p.tx AS pay_tx_id, p.seq AS pay_seq, p.ms AS pay_ts_ms,
       r.tx AS receipt_tx_id, r.seq AS receipt_seq, r.ms AS receipt_ts_ms"""


def _reconcile() -> str:
    return f"""WITH {SIDES}
    {PAIRS}, 'matched' AS outcome FROM p JOIN r ON {NEAR}
    UNION ALL
    SELECT tx, seq, ms, NULL, NULL, NULL, 'unmatched_left' FROM p
    WHERE NOT EXISTS (SELECT 1 FROM r WHERE {NEAR})
    UNION ALL
    SELECT NULL, NULL, NULL, tx, seq, ms, 'unmatched_right' FROM r
    WHERE NOT EXISTS (SELECT 1 FROM p WHERE {NEAR})"""


def _one_to_one() -> str:
    before, after = 3 * HOUR, 5 * HOUR
    return f"""WITH RECURSIVE {E},
    o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ms, event_type DESC, seq) AS i
          FROM e WHERE event_type IN ('view', 'purchase')),
    fold(user_id, i, side, waiting, event_type, seq, other) AS (
        SELECT user_id, i, event_type, [{{'ms': ms, 'seq': seq}}], event_type, seq, CAST(NULL AS BIGINT)
        FROM o WHERE i = 1
        UNION ALL
        SELECT user_id, i,
               CASE WHEN len(live) > 0 AND side <> event_type THEN side ELSE event_type END,
               CASE WHEN len(live) > 0 AND side <> event_type THEN live[2:]
                    WHEN len(live) > 0 THEN list_append(live, {{'ms': ms, 'seq': seq}})
                    ELSE [{{'ms': ms, 'seq': seq}}] END,
               event_type, seq,
               CASE WHEN len(live) > 0 AND side <> event_type THEN live[1].seq END
        FROM (SELECT o.user_id, o.i, o.ms, o.seq, o.event_type, fold.side,
                     list_filter(fold.waiting, lambda x:
                         o.ms - x.ms <= CASE WHEN fold.side = 'view' THEN {after} ELSE {before} END) AS live
              FROM fold JOIN o ON o.user_id = fold.user_id AND o.i = fold.i + 1)),
    m AS (SELECT user_id, CASE WHEN event_type = 'view' THEN seq ELSE other END AS left_seq,
                 CASE WHEN event_type = 'view' THEN other ELSE seq END AS right_seq
          FROM fold WHERE other IS NOT NULL)
    SELECT CAST(user_id AS VARCHAR) AS tx_id, left_seq, right_seq, 'matched' AS outcome FROM m
    UNION ALL
    SELECT CAST(user_id AS VARCHAR), seq, NULL, 'unmatched_left' FROM o
    WHERE event_type = 'view' AND seq NOT IN (SELECT left_seq FROM m)
    UNION ALL
    SELECT CAST(user_id AS VARCHAR), NULL, seq, 'unmatched_right' FROM o
    WHERE event_type = 'purchase' AND seq NOT IN (SELECT right_seq FROM m)"""


VIEWS = f"""SELECT {TUMBLING} AS window_end_ms, count(DISTINCT user_id) AS uv
FROM e WHERE event_type = 'view' GROUP BY 1"""
PAGE_VIEWS = f"""SELECT 'pv' AS label, {TUMBLING} AS window_end_ms, count(*) AS cnt
FROM e WHERE event_type = 'view' GROUP BY 2"""
ALL_ROWS = f"SELECT {TUMBLING} AS window_end_ms, count(*) AS cnt FROM e GROUP BY 1"
PROMOTION = f"""SELECT CAST(user_id % 3 AS VARCHAR) AS channel, event_type AS behavior,
       {TUMBLING} AS window_end_ms, count(*) AS cnt,
       strftime(make_timestamp({TUMBLING} * 1000), '%Y-%m-%d %H:%M:%S') || '.0' AS window_end
FROM e WHERE event_type <> 'signup' GROUP BY 1, 2, 3"""
MARKETING = f"""SELECT 'total' AS label, {TUMBLING} AS window_end_ms, count(*) AS cnt
FROM e WHERE event_type <> 'signup' GROUP BY 2"""
PROVINCES = _sliding(
    "CAST(user_id % 6 AS VARCHAR) AS province", "c", DAY, 6 * HOUR, "province", "nth <= 2"
)

SQL: dict[str, str] = {
    "hot_items": f"WITH {E} {HOT_ITEMS}",
    "hot_items_sql": f"WITH {E} {HOT_ITEMS}",
    "hot_items_table_sql": f"WITH {E} SELECT item_id, {STAMP} AS window_end, cnt, row_num FROM ({HOT_ITEMS})",
    "hot_items_report": _report(HOT_ITEMS, "'NO.' || row_num || ': 商品ID = ' || item_id || ' 热门度 : ' || cnt"),
    "hot_pages": f"WITH {E} {HOT_PAGES}",
    "hot_pages_report": _report(HOT_PAGES, "'NO.' || row_num || ': 页面url : ' || url || ' 浏览量 : ' || cnt"),
    "hot_pages_late": f"{LATE} SELECT seq, url, ms AS ts_ms, arrival_ms, wm_ms FROM t WHERE late",
    "hot_pages_in_time": f"""{LATE},
        c AS (SELECT url, (ms // 300000 + i) * 300000 AS window_end_ms, count(*) AS cnt
              FROM t, range(1, 13) r(i)
              WHERE NOT late AND (ms // 300000 + i) * 300000 + {HOUR} > wm_ms GROUP BY 1, 2)
        {_ranked('SELECT * FROM c', 'url', 3)}""",
    "page_view": f"WITH {E} {PAGE_VIEWS}",
    "page_view_salted": f"WITH {E} {PAGE_VIEWS}",
    "unique_visitor": f"WITH {E} {VIEWS}",
    "unique_visitor_bitmap": f"WITH {E} {VIEWS}",
    "unique_visitor_running": f"""WITH {E},
        v AS (SELECT {TUMBLING} AS window_end_ms, user_id, ms, seq,
                     row_number() OVER (PARTITION BY {TUMBLING}, user_id ORDER BY ms, seq) AS visit
              FROM e WHERE event_type = 'view')
        SELECT window_end_ms, user_id, ms AS ts_ms, seq,
               row_number() OVER (PARTITION BY window_end_ms ORDER BY ms, seq) AS uv
        FROM v WHERE visit = 1""",
    "visitor_hash": """SELECT DISTINCT user_id, list_reduce(
            list_prepend(CAST(0 AS BIGINT),
                list_transform(string_split(CAST(user_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
            lambda a, x: (a * 61 + x) & 536870911) AS "offset"
        FROM events""",
    "window_event_count": f"WITH {E} {ALL_ROWS}",
    "channel_promotion": f"WITH {E} {PROMOTION}",
    "marketing_total": f"WITH {E} {MARKETING}",
    "ad_cap_passed": f"""{CAPPED} SELECT user_id, event_type AS ad_id, CAST(user_id % 6 AS VARCHAR) AS province,
        ms AS ts_ms, seq FROM c WHERE nth <= 2""",
    "ad_blacklist": f"""{CAPPED} SELECT user_id, event_type AS ad_id, 'click over 1times.' AS warning_msg
        FROM c WHERE nth = 3""",
    "ad_by_province": f"{CAPPED} SELECT *, {STAMP} || '.0' AS window_end FROM ({PROVINCES})",
    "login_fail_sliding": _runs(2, 24 * HOUR, "<=", "login fail 2 times in 1d"),
    "login_fail_pattern": _runs(3, 48 * HOUR, "<", "login fail in 2d for 3 times."),
    "login_fail_anchored": _anchored(2, 24 * HOUR),
    "login_fail_anchored_three": _anchored(3, 48 * HOUR),
    "login_fail_timer": _timer(2, 24 * HOUR),
    "login_fail_timer_three": _timer(3, 48 * HOUR),
    "login_fail_sequence": f"""WITH {E},
        q AS (SELECT *, lag(event_type, 2) OVER w AS a, lag(event_type, 1) OVER w AS b, lag(ms, 2) OVER w AS first
              FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ms, seq))
        SELECT user_id, first AS first_fail_time, ms AS last_fail_time,
               'login fail in 2d for 3 times.' AS warning_msg
        FROM q WHERE a = 'error' AND b = 'error' AND event_type = 'view' AND ms - first < {48 * HOUR}""",
    "order_timeout_pattern": _order_pattern(),
    "order_timeout": _shop(365 * DAY, None),
    "order_timeout_early": _shop(365 * DAY, 30 * DAY),
    "order_timeout_cycles": _cycles(12 * HOUR, 6 * HOUR),
    "tx_interval_join": f"WITH {SIDES} {PAIRS} FROM p JOIN r ON {NEAR}",
    "tx_reconcile": _reconcile(),
    "tx_reconcile_one_to_one": _one_to_one(),
    "tx_connect": """SELECT CAST(user_id AS VARCHAR) AS tx_id,
            CASE WHEN event_type = 'view' THEN 'left' ELSE 'right' END AS side, count(*) AS cnt,
            sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END)::BIGINT AS typed
        FROM events WHERE event_type IN ('view', 'purchase') GROUP BY 1, 2""",
    "record_codec": f"""WITH {E} SELECT user_id, item_id, 1 AS category_id, event_type AS behavior,
        ms AS "timestamp" FROM e""",
    "delimited_lines": f"""WITH {E} SELECT user_id AS order_id, event_type,
        CASE WHEN event_type = 'purchase' THEN CAST(seq AS VARCHAR) ELSE '' END AS tx_id, ms AS "timestamp" FROM e""",
    "order_file": f"""WITH {E} SELECT user_id AS order_id, event_type,
        CASE WHEN event_type = 'purchase' THEN CAST(seq AS VARCHAR) ELSE '' END AS tx_id, ms AS ts_ms FROM e""",
    "receipt_file": f"""WITH {E} SELECT CAST(seq AS VARCHAR) AS tx_id, event_type AS pay_channel, ms AS ts_ms
        FROM e WHERE event_type = 'purchase'""",
    "hot_items_descending": f"""WITH {E} SELECT item_id, count(*) AS cnt,
        row_number() OVER (ORDER BY count(*) DESC, item_id) AS place FROM e WHERE event_type = 'view'
        GROUP BY item_id QUALIFY place <= 50""",
    "time_texts": f"""WITH {E} SELECT seq,
        strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S') AS formatted,
        strftime(make_timestamp(ms * 1000) + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS shifted,
        {MS_TEXT.format('ms')} AS full_text,
        ((ms + {8 * HOUR}) // {DAY} + 1) * {DAY} - {8 * HOUR} AS next_midnight_ms,
        ms + {8 * HOUR} AS display_ms FROM e""",
    "stream_late_pages": f"{LATE} SELECT seq, url, ms AS ts_ms, arrival_ms, wm_ms FROM t WHERE late",
    "stream_ad_cap": f"""{CAPPED} SELECT user_id, event_type AS ad_id, seq,
        CASE WHEN nth <= 2 THEN 'passed' ELSE 'warning' END AS outcome FROM c WHERE nth <= 3""",
    "stream_login_fail_anchored": _anchored(2, 24 * HOUR, text=False),
    "stream_login_fail_timer": _timer(2, 24 * HOUR, stream=True),
    "stream_login_fail_pattern": _runs(3, 48 * HOUR, "<", None),
    "stream_login_fail_sliding": _runs(2, 24 * HOUR, "<=", None),
    "unique_visitor_sketch": f"WITH {E} SELECT window_end_ms, true AS near FROM ({VIEWS})",
}

TRIMMED = """CASE WHEN count(*) > 2 THEN CAST(sum(item_id) - min(item_id) - max(item_id) AS DOUBLE) / (count(*) - 2) END"""
SQL["item_trimmed_mean"] = f"""WITH {E} SELECT event_type AS behavior, (ms // {HOUR} + i) * {HOUR} AS window_end_ms, {TRIMMED} AS mean
    FROM e, range(1, 25) r(i) GROUP BY 1, 2"""
SQL["user_trimmed_mean"] = f"""WITH {E} SELECT user_id, (ms // {7 * DAY} + 1) * {7 * DAY} AS window_end_ms, {TRIMMED} AS mean
    FROM e GROUP BY 1, 2"""

# What the micro-batches of the disturbed replay add to each window, and the rankings after each of them.
SPAN = 5 * DAY
SQL["stream_hot_items_changes"] = f"""WITH {E},
    v AS (SELECT item_id, (ms // {HOUR} + i) * {HOUR} AS w,
                 ms // {SPAN} + CASE WHEN seq % 3 = 1 AND ms % {SPAN} >= {SPAN - 12 * HOUR} THEN 1 ELSE 0 END AS batch
          FROM e, range(1, 25) r(i) WHERE event_type = 'view'),
    p AS (SELECT w, batch, item_id, count(*) AS c FROM v GROUP BY w, batch, item_id),
    t AS (SELECT w, batch, lag(batch) OVER (PARTITION BY w ORDER BY batch) AS before FROM (SELECT DISTINCT w, batch FROM p)),
    s AS (SELECT t.w, t.batch, p.item_id, sum(p.c) AS cnt FROM t JOIN p ON p.w = t.w AND p.batch <= t.batch GROUP BY t.w, t.batch, p.item_id),
    n AS (SELECT *, row_number() OVER (PARTITION BY w, batch ORDER BY cnt DESC, item_id) AS row_num FROM s),
    k AS (SELECT * FROM n WHERE row_num <= 5),
    a AS (SELECT k.w, 1 AS sign FROM k JOIN t ON t.w = k.w AND t.batch = k.batch
          LEFT JOIN k o ON o.w = k.w AND o.batch = t.before AND o.row_num = k.row_num AND o.item_id = k.item_id AND o.cnt = k.cnt
          WHERE o.w IS NULL),
    b AS (SELECT k.w, -1 AS sign FROM k JOIN t ON t.w = k.w AND t.before = k.batch
          LEFT JOIN k o ON o.w = k.w AND o.batch = t.batch AND o.row_num = k.row_num AND o.item_id = k.item_id AND o.cnt = k.cnt
          WHERE o.w IS NULL)
    SELECT w AS window_end_ms, count(*) FILTER (WHERE sign = 1) AS added, count(*) FILTER (WHERE sign = -1) AS taken_back
    FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY w"""

SQL["stream_hot_pages_one_pass"] = f"""
    SELECT 'ranking' AS output, NULL::BIGINT AS seq, url, window_end_ms, cnt, row_num, NULL::BIGINT AS ts_ms,
           NULL::BIGINT AS arrival_ms, NULL::BIGINT AS wm_ms FROM ({SQL["hot_pages_in_time"]})
    UNION ALL
    SELECT 'late', seq, url, NULL, NULL, NULL, ts_ms, arrival_ms, wm_ms FROM ({SQL["hot_pages_late"]})"""

# A closed stream gives what the batch form of the same analysis gives.
SQL |= {
    stream: SQL[batch]
    for stream, batch in {
        "stream_hot_items": "hot_items",
        "stream_hot_items_sql": "hot_items",
        "stream_hot_items_retract": "hot_items",
        "stream_hot_pages_updated": "hot_pages",
        "stream_hot_pages_late_updates": "hot_pages",
        "stream_page_view_salted": "page_view",
        "stream_unique_visitor": "unique_visitor",
        "stream_unique_visitor_bitmap": "unique_visitor",
        "stream_unique_visitor_updating": "unique_visitor",
        "stream_window_event_count": "window_event_count",
        "stream_channel_promotion": "channel_promotion",
        "stream_marketing_total": "marketing_total",
        "stream_ad_by_province": "ad_by_province",
        "stream_ad_blacklist": "ad_blacklist",
        "stream_ad_cap_out_of_order": "stream_ad_cap",
        "stream_login_fail_anchored_out_of_order": "stream_login_fail_anchored",
        "stream_login_fail_timer_out_of_order": "stream_login_fail_timer",
        "stream_login_fail_pattern_out_of_order": "stream_login_fail_pattern",
        "stream_order_timeout_pattern": "order_timeout_pattern",
        "stream_order_timeout_pattern_out_of_order": "order_timeout_pattern",
        "stream_order_timeout_cycles": "order_timeout_cycles",
        "stream_order_timeout_cycles_out_of_order": "order_timeout_cycles",
        "stream_tx_interval_join": "tx_interval_join",
        "stream_tx_reconcile": "tx_reconcile",
        "stream_tx_one_to_one": "tx_reconcile_one_to_one",
        "stream_tx_one_to_one_out_of_order": "tx_reconcile_one_to_one",
        "stream_tx_two_sources": "tx_reconcile_one_to_one",
        "stream_unique_visitor_running": "unique_visitor_running",
    }.items()
}
SQL["stream_login_fail_sequence"] = (
    "SELECT user_id, first_fail_time AS first_ts_ms, last_fail_time AS last_ts_ms "
    f"FROM ({SQL['login_fail_sequence']})"
)
