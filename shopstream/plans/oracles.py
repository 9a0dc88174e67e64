"""The named queries as plain SQL over the same tables, to check results against."""

from __future__ import annotations

from shopstream.plans.catalog import REPORT_DAYS
from shopstream.plans.views import FEED_SECONDS


def _case(column: str, names: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items())
    return f"CASE {column} {whens} END"


_HM = "'%Y-%m-%d %H:%M:%S'"
_PAGE = _case("event_type", {"view": "home", "click": "good_detail", "purchase": "trade", "error": "search", "signup": "login"})
_PREV = _case("event_type", {"view": "search", "click": "home", "purchase": "good_detail", "error": "login"})


def _bounds(start: str, size: str) -> str:
    return f"strftime({start}, {_HM}) AS stt, strftime({start} + INTERVAL '{size}', {_HM}) AS edt"


def _bucket(time: str, size: str) -> str:
    return f"time_bucket(INTERVAL '{size}', {time}, TIMESTAMP '1970-01-01')"


# Building blocks, in order of use: name -> (needs, body).
_PARTS: dict[str, tuple[list[str], str]] = {}


def _part(name: str, body: str, *needs: str) -> None:
    _PARTS[name] = (list(needs), body)


def _with(query: str, *needs: str) -> str:
    seen: dict[str, str] = {}

    def add(name: str) -> None:
        if name not in seen:
            for other in _PARTS[name][0]:
                add(other)
            seen[name] = _PARTS[name][1]

    for n in needs:
        add(n)
    blocks = ",\n".join(f"{n} AS ({b})" for n, b in seen.items())
    return f"WITH {blocks}\n{query}" if blocks else query


_part("ev", "SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events")
_part("pages", f"""
  SELECT CAST(user_id AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid, 'v' || (k % 2) AS vc, 'ch' || (k % 5) AS ch,
         'ar' || (k % 3) AS ar, CASE WHEN value < 10 THEN '1' ELSE '0' END AS is_new,
         {_PAGE} AS page_id, {_PREV} AS last_page_id, CAST(round(value * 100) AS BIGINT) AS during_time,
         epoch_us(ts) // 1000 AS ts, date_trunc('milliseconds', ts) AS rt, event_id, k, value, event_type
  FROM ev""", "ev")
_part("visitors", """
  SELECT * FROM pages WHERE last_page_id IS NULL
  QUALIFY row_number() OVER (PARTITION BY mid, CAST(rt AS DATE) ORDER BY ts, event_id) = 1""", "pages")
_part("bounces", """
  SELECT * FROM (
    SELECT *, lead(ts) OVER w AS next_ts, lead(last_page_id IS NULL) OVER w AS next_entry
    FROM pages WINDOW w AS (PARTITION BY mid ORDER BY ts, event_id)) AS q
  WHERE last_page_id IS NULL AND NOT coalesce(next_ts - ts < 21600000 AND NOT next_entry, false)""", "pages")
_part("traffic_rows", """
  SELECT rt, vc, ch, ar, is_new, 1 AS uv, 0 AS sv, 0 AS pv, 0 AS dur, 0 AS uj FROM visitors
  UNION ALL SELECT rt, vc, ch, ar, is_new, 0, 0, 0, 0, 1 FROM bounces
  UNION ALL SELECT rt, vc, ch, ar, is_new, 0, CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END, 1, during_time, 0 FROM pages""",
      "visitors", "bounces", "pages")
_part("traffic", f"""
  SELECT {_bounds('w', '1 hour')}, vc, ch, ar, is_new, CAST(sum(uv) AS BIGINT) AS uv_ct, CAST(sum(sv) AS BIGINT) AS sv_ct,
         CAST(sum(pv) AS BIGINT) AS pv_ct, CAST(sum(dur) AS BIGINT) AS dur_sum, CAST(sum(uj) AS BIGINT) AS uj_ct
  FROM (SELECT *, {_bucket('rt', '1 hour')} AS w FROM traffic_rows) AS q GROUP BY w, vc, ch, ar, is_new""", "traffic_rows")
_part("page_firsts", """
  SELECT mid, page_id, CAST(rt AS DATE) AS dt, min(rt) AS rt FROM pages WHERE page_id IN ('home', 'good_detail')
  GROUP BY mid, page_id, CAST(rt AS DATE)""", "pages")
_part("page_views", f"""
  SELECT {_bounds('w', '1 hour')}, CAST(count(*) FILTER (page_id = 'home') AS BIGINT) AS home_uv_ct,
         CAST(count(*) FILTER (page_id = 'good_detail') AS BIGINT) AS good_detail_uv_ct
  FROM (SELECT *, {_bucket('rt', '1 hour')} AS w FROM page_firsts) AS q GROUP BY w""", "page_firsts")
_part("login_days", """
  SELECT uid, CAST(rt AS DATE) AS dt, min(rt) AS rt FROM pages WHERE last_page_id IS NULL OR last_page_id = 'login'
  GROUP BY uid, CAST(rt AS DATE)""", "pages")
_part("login_firsts", """
  SELECT *, coalesce(dt - lag(dt) OVER (PARTITION BY uid ORDER BY dt) >= 2, false) AS is_back FROM login_days""", "login_days")
_part("logins", f"""
  SELECT {_bounds('w', '1 hour')}, CAST(count(*) FILTER (is_back) AS BIGINT) AS back_ct, count(*) AS uu_ct
  FROM (SELECT *, {_bucket('rt', '1 hour')} AS w FROM login_firsts) AS q GROUP BY w""", "login_firsts")
_part("registered", f"""
  SELECT CAST(user_id AS VARCHAR) AS user_id, strftime(ts, '%Y-%m-%d') AS date_id, strftime(ts, {_HM}) AS create_time,
         CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) AS ts, date_trunc('second', ts) AS rt
  FROM events WHERE event_type = 'signup' AND value < 80""")
_part("registers", f"""
  SELECT {_bounds('w', '1 hour')}, count(*) AS register_ct
  FROM (SELECT *, {_bucket('rt', '1 hour')} AS w FROM registered) AS q GROUP BY w""", "registered")
_part("dic", "SELECT CAST(n_nationkey AS VARCHAR) AS dic_code, n_name AS dic_name FROM nation")
_part("cart_adds", f"""
  SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id, CAST(k AS VARCHAR) AS sku_id,
         CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS cart_price,
         CASE WHEN value < 30 THEN CAST(k AS VARCHAR) ELSE CAST(k - 50 AS VARCHAR) END AS sku_num, 'sku-' || k AS sku_name,
         '1' AS is_checked, strftime(ts, {_HM}) AS create_time, CASE WHEN value >= 30 THEN strftime(ts, {_HM}) END AS operate_time,
         '0' AS is_ordered, CAST(NULL AS VARCHAR) AS order_time, dic_code AS source_type_id, dic_name AS source_type_name,
         CAST(event_id AS VARCHAR) AS source_id
  FROM ev JOIN dic ON dic_code = CAST(k % 30 AS VARCHAR)
  WHERE event_type = 'click' AND (value < 30 OR (value < 80 AND k > 50))""", "ev", "dic")
_part("cart_firsts", """
  SELECT user_id, min(CAST(create_time AS TIMESTAMP)) AS rt FROM cart_adds
  GROUP BY user_id, substr(create_time, 1, 10)""", "cart_adds")
_part("carts", f"""
  SELECT {_bounds('w', '1 hour')}, count(*) AS cart_add_uu_ct
  FROM (SELECT *, {_bucket('rt', '1 hour')} AS w FROM cart_firsts) AS q GROUP BY w""", "cart_firsts")
_REST = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
_REST_DESC = ", ".join(c + " DESC" for c in _REST.split(", "))
_part("first_lines", f"""
  SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, {_REST}) = 1""")
_part("last_lines", f"""
  SELECT * FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, {_REST_DESC}) = 1""")
_part("first_facts", "SELECT * FROM first_lines JOIN orders ON l_orderkey = o_orderkey", "first_lines")
_part("user_days", "SELECT o_custkey, min(o_orderdate) AS first_day FROM first_facts GROUP BY o_custkey", "first_facts")
_part("orders_dws", f"""
  SELECT {_bounds('o_orderdate', '1 day')}, count(DISTINCT o_custkey) AS order_unique_user_count,
         count(DISTINCT o_custkey) FILTER (o_orderdate = first_day) AS order_new_user_count,
         CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS order_activity_reduce_amount,
         CAST(sum(CASE WHEN l_tax >= 0.04 THEN CAST(l_tax AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS order_coupon_reduce_amount,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS INTEGER)) AS DOUBLE) AS order_origin_total_amount
  FROM first_facts JOIN user_days USING (o_custkey) GROUP BY o_orderdate""", "first_facts", "user_days")
_part("paid_days", """
  SELECT DISTINCT o_custkey, o_orderdate FROM last_lines JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P'""",
      "last_lines")
_part("payments", f"""
  SELECT {_bounds('o_orderdate', '1 day')}, count(*) AS payment_suc_unique_user_count,
         CAST(count(*) FILTER (o_orderdate = first_day) AS BIGINT) AS payment_suc_new_user_count
  FROM (SELECT *, min(o_orderdate) OVER (PARTITION BY o_custkey) AS first_day FROM paid_days) AS q GROUP BY o_orderdate""", "paid_days")
_part("provinces", f"""
  SELECT {_bounds('o_orderdate', '1 day')}, CAST(c_nationkey AS VARCHAR) AS province_id, n_name AS province_name,
         count(DISTINCT l_orderkey) AS order_count, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS order_amount
  FROM last_lines JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
  LEFT JOIN nation ON n_nationkey = c_nationkey GROUP BY o_orderdate, c_nationkey, n_name""", "last_lines")
_part("chain", """
  SELECT CAST(n_nationkey AS VARCHAR) AS category3_id, n_name AS category3_name, CAST(n_regionkey AS VARCHAR) AS category2_id,
         r_name AS category2_name, substr(r_name, 1, 1) AS category1_id, 'group ' || substr(r_name, 1, 1) AS category1_name
  FROM nation LEFT JOIN region ON r_regionkey = n_regionkey""")
_part("sku", """
  SELECT p_partkey, p_name AS spu_id, p_brand AS trademark_id, CAST(p_size - 1 AS VARCHAR) AS category3_id FROM part""")
_NAMES = """'TM ' || trademark_id AS trademark_name, category1_id, category1_name, category2_id, category2_name,
         q.category3_id, category3_name"""
_part("user_spu", f"""
  SELECT stt, edt, trademark_id, {_NAMES}, user_id, spu_id, upper(spu_id) AS spu_name, order_count, order_amount
  FROM (SELECT {_bounds('o_orderdate', '1 day')}, trademark_id, category3_id, CAST(o_custkey AS VARCHAR) AS user_id, spu_id,
               count(DISTINCT l_orderkey) AS order_count, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS order_amount
        FROM first_facts LEFT JOIN sku ON p_partkey = l_partkey GROUP BY o_orderdate, trademark_id, category3_id, o_custkey, spu_id) AS q
  LEFT JOIN chain AS c ON c.category3_id = q.category3_id""", "first_facts", "sku", "chain")
_part("refunds", f"""
  SELECT stt, edt, trademark_id, {_NAMES}, user_id, refund_count
  FROM (SELECT {_bounds('l_shipdate', '1 day')}, trademark_id, category3_id, CAST(o_custkey AS VARCHAR) AS user_id,
               count(DISTINCT l_orderkey) AS refund_count
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN sku ON p_partkey = l_partkey
        WHERE l_returnflag = 'R' GROUP BY l_shipdate, trademark_id, category3_id, o_custkey) AS q
  LEFT JOIN chain AS c ON c.category3_id = q.category3_id""", "sku", "chain")
_part("keyword_rows", """
  SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS keyword FROM documents""")
_part("keywords", f"""
  SELECT {_bounds('w', '10 seconds')}, 'search' AS source, keyword, count(*) AS keyword_count
  FROM (SELECT keyword, TIMESTAMP '1970-01-01' + to_seconds((doc_id // 10) * 10) AS w FROM keyword_rows WHERE keyword <> '') AS q
  GROUP BY w, keyword""", "keyword_rows")

# Trade change records, as one table per source table.
_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
_MONEY = "CAST(CAST({} AS DECIMAL(18,2)) AS VARCHAR)"


def _money(c: str) -> str:
    return _MONEY.format(c)


_SHIP_TS = "CAST(CAST(epoch(l_shipdate) AS BIGINT) AS VARCHAR)"
_part("lines", f"SELECT *, {_ID} AS id, strftime(l_shipdate, {_HM}) AS made FROM lineitem")
_part("details", f"""
  SELECT id, CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id, 'sku-' || l_partkey AS sku_name,
         {_money('l_extendedprice')} AS order_price, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS sku_num, made AS create_time,
         dic_code AS source_type_id, dic_name AS source_type_name, CAST(l_suppkey AS VARCHAR) AS source_id,
         {_money('l_extendedprice')} AS split_total_amount, {_money('l_discount')} AS split_activity_amount,
         {_money('l_tax')} AS split_coupon_amount
  FROM lines JOIN dic ON dic_code = CAST(l_suppkey % 30 AS VARCHAR)""", "lines", "dic")
_part("activities", """
  SELECT id AS detail_id, 'a' || id AS order_detail_activity_id, CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) AS activity_id,
         CAST(l_linenumber AS VARCHAR) AS activity_rule_id FROM lines WHERE l_discount >= 0.05""", "lines")
_part("coupons", """
  SELECT id AS detail_id, 'c' || id AS order_detail_coupon_id, CAST(CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR) AS coupon_id,
         CAST(l_suppkey AS VARCHAR) AS coupon_use_id FROM lines WHERE l_tax >= 0.04""", "lines")
_part("order_states", """
  SELECT '1001' AS order_status, 'insert' AS type, NULL AS old_status, 'PFO' AS states
  UNION ALL SELECT '1003', 'update', '1001', 'P' UNION ALL SELECT '1005', 'update', '1001', 'F'
  UNION ALL SELECT '1006', 'update', '1005', 'F' UNION ALL SELECT '1002', 'update', '1001', 'O'
  UNION ALL SELECT '1003', 'update', NULL, 'O'""")
_NULLS = ["consignee_tel", "delivery_address", "order_comment", "out_trade_no", "trade_body", "expire_time", "process_status",
          "tracking_no", "parent_order_id", "activity_reduce_amount", "coupon_reduce_amount", "feight_fee", "feight_fee_reduce",
          "refundable_time"]
_part("order_infos", f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS info_id, 'Customer ' || o_custkey AS consignee, {_money('o_totalprice')} AS total_amount,
         order_status, CAST(o_custkey AS VARCHAR) AS user_id, o_orderpriority AS payment_way,
         CASE WHEN type = 'update' THEN strftime(o_orderdate + INTERVAL '10 minutes', {_HM}) END AS operate_time,
         CAST(o_custkey % 25 AS VARCHAR) AS province_id, {_money('o_totalprice')} AS original_total_amount, type, old_status,
         {', '.join(f'CAST(NULL AS VARCHAR) AS {c}' for c in _NULLS)}
  FROM orders JOIN order_states ON contains(states, o_orderstatus)""", "order_states")
_part("wide", """
  SELECT details.*, order_infos.* EXCLUDE (info_id), activities.* EXCLUDE (detail_id), coupons.* EXCLUDE (detail_id)
  FROM details JOIN order_infos ON info_id = order_id LEFT JOIN activities ON activities.detail_id = details.id
  LEFT JOIN coupons ON coupons.detail_id = details.id""", "details", "order_infos", "activities", "coupons")
_FACT = """id, order_id, user_id, sku_id, sku_name, sku_num, order_price, province_id, activity_id, activity_rule_id, coupon_id,
  create_time, source_id, source_type_id, source_type_name, split_activity_amount, split_coupon_amount, split_total_amount"""
_part("detail_facts", f"SELECT {_FACT} FROM wide WHERE type = 'insert'", "wide")
_part("paid", f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS paid_order, dic_code AS payment_type_code, dic_name AS payment_type_name,
         strftime(o_orderdate + INTERVAL '10 minutes', {_HM}) AS callback_time
  FROM orders JOIN dic ON dic_code = CAST(o_custkey % 30 AS VARCHAR) WHERE o_orderstatus <> 'P'""", "dic")
_part("pay_details", """
  SELECT id AS order_detail_id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id, coupon_id,
         payment_type_code, payment_type_name, callback_time, source_id, source_type_id, source_type_name, sku_num, order_price,
         split_activity_amount, split_coupon_amount, split_total_amount AS split_payment_amount
  FROM detail_facts JOIN paid ON paid_order = order_id""", "detail_facts", "paid")
_part("article_rows", """
  SELECT * FROM part WHERE p_type IN ('ECONOMY', 'STANDARD', 'PROMO')""")


def _user(e: str = "") -> str:
    return f"CAST({e}user_id AS VARCHAR) AS user_id"


_TS = "CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) AS ts"
_DAY = "strftime(ts, '%Y-%m-%d') AS date_id"
_AT = f"strftime(ts, {_HM})"
_ID_S = "CAST(event_id AS VARCHAR) AS id"
_SKU = "CAST(k AS VARCHAR) AS sku_id"
_OID = "CAST(event_id + 1000 AS VARCHAR) AS order_id"
_DT = "CAST(substr(stt, 1, 10) AS DATE) AS dt"


def _daily(source: str) -> str:
    return f"(SELECT *, {_DT} FROM {source}) AS q"


def _cents(c: str, alias: str | None = None) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE) AS {alias or c}"


def _long(c: str, alias: str) -> str:
    return f"CAST(sum({c}) AS BIGINT) AS {alias}"


def _goods(ids: list[str], names: list[str]) -> str:
    keys, on = ", ".join(["dt", *ids, *names]), " AND ".join(f"o.{c} = r.{c}" for c in ["dt", *ids])
    both = ", ".join(f"coalesce(o.{c}, r.{c}) AS {c}" for c in ["dt", *names])
    return _with(f"""
SELECT {both}, coalesce(order_count, 0) AS order_count, coalesce(uu_count, 0) AS uu_count, coalesce(order_amount, 0) AS order_amount,
       coalesce(refund_count, 0) AS refund_count, coalesce(refund_uu_count, 0) AS refund_uu_count
FROM (SELECT {keys}, {_long('order_count', 'order_count')}, count(DISTINCT user_id) AS uu_count, {_cents('order_amount')}
      FROM {_daily('user_spu')} GROUP BY {keys}) AS o
FULL JOIN (SELECT {keys}, {_long('refund_count', 'refund_count')}, count(DISTINCT user_id) AS refund_uu_count
      FROM {_daily('refunds')} GROUP BY {keys}) AS r ON {on}""", "user_spu", "refunds")


def _subsidy(reduce: str, alias: str, rate: str) -> str:
    return _with(f"""
SELECT dt, a AS {alias}, b AS origin_total_amount, CAST(CAST(a / b AS DECIMAL(38, 20)) AS DOUBLE) AS {rate}
FROM (SELECT dt, {_cents(reduce, 'a')}, {_cents('order_origin_total_amount', 'b')} FROM {_daily('orders_dws')} GROUP BY dt) AS z""",
                 "orders_dws")


def _channel(value: str, name: str) -> str:
    return _with(f"SELECT dt, ch, {value} AS {name} FROM {_daily('traffic')} GROUP BY dt, ch", "traffic")


def _per_session(c: str, alias: str | None = None) -> str:
    return f"CAST(sum({c}) AS DOUBLE) / nullif(CAST(sum(sv_ct) AS DOUBLE), 0)" + (f" AS {alias}" if alias else "")


_TYPES = f"""
  SELECT dt, is_new, {_long('uv_ct', 'uv_ct')}, {_long('pv_ct', 'pv_ct')}, {_long('sv_ct', 'sv_ct')}, {_long('uj_ct', 'uj_ct')},
         {_long('dur_sum', 'dur_sum')}, coalesce({_per_session('uj_ct')}, 0) AS uj_rate,
         coalesce({_per_session('dur_sum')}, 0) / 1000 AS avg_dur_sum, coalesce({_per_session('pv_ct')}, 0) AS avg_pv_ct
  FROM {_daily('traffic')} GROUP BY dt, is_new"""
_part("visitor_types", _TYPES, "traffic")
_HOURLY = f"""
  SELECT dt, CAST(substr(stt, 12, 2) AS INTEGER) AS hr, {_long('uv_ct', 'uv_ct')}, {_long('pv_ct', 'pv_ct')},
         {_long("CASE WHEN is_new = '1' THEN uv_ct ELSE 0 END", 'new_uv_ct')}
  FROM {_daily('traffic')} GROUP BY dt, hr"""
_part("hourly", _HOURLY, "traffic")


def _rows(source: str, label: str, value: str, rows: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT dt, '{k}' AS {label}, {_long(v, value)} FROM {_daily(source)} GROUP BY dt" for k, v in rows.items())


def _metric(label: str, c: str) -> str:
    return (f"SELECT dt, '{label}' AS type, CAST(max(CASE WHEN is_new = '1' THEN {c} END) AS DOUBLE) AS new, "
            f"CAST(max(CASE WHEN is_new <> '1' THEN {c} END) AS DOUBLE) AS old FROM visitor_types GROUP BY dt")


def _json_pages() -> str:
    """Events whose log line is whole JSON."""
    return "(SELECT * FROM pages WHERE NOT (event_type = 'error' AND value < 10)) AS q"


_IS_START = "(event_type = 'signup' AND value >= 80)"


def _dimensions(name: str) -> str:
    """Both configured dimensions in one table."""
    return _with(f"""
SELECT 'dim_sku_info' AS sink_table, CAST(p_partkey AS VARCHAR) AS id, {name} AS name, p_brand AS tm_id, CAST(NULL AS VARCHAR) AS segment
FROM article_rows
UNION ALL SELECT 'dim_customer', CAST(c_custkey AS VARCHAR), NULL, NULL, c_mktsegment FROM customer""", "article_rows")


def oracle_sql() -> dict[str, str]:
    """SQL per query; a stream must give what the same job gives on tables."""
    sql = _table_sql()
    sql |= {f"{name}_day": f"SELECT * FROM ({sql[name]}) AS every WHERE dt = DATE '{day}'" for name, day in REPORT_DAYS.items()}
    same = [
        "is_new_repair", "unique_visitor", "bounce", "log_split", "traffic_window", "page_view_window", "keyword_window",
        "login_window", "register_window", "cart_window", "refund_window", "payment_window",
        "dedup_first", "order_wide", "pay_detail", "order_window", "user_item_window",
    ]

    def fed(name: str, ship: str, line: str, seconds: int) -> str:
        """The same facts with the time their records come in as a stream."""
        assert ship in sql[name]
        return sql[name].replace(ship, f"CAST(CAST(epoch(o_orderdate) AS BIGINT) + {seconds} + 10 * {line} AS VARCHAR) AS ts")

    return sql | {f"stream_{n}": sql[n] for n in same} | {
        "stream_order_refund": fed("order_refund", f"{_SHIP_TS} AS ts", "l_linenumber", FEED_SECONDS["order_refund_info"]),
        "stream_refund_pay": fed("refund_pay", "CAST(CAST(epoch(p.l_shipdate) AS BIGINT) AS VARCHAR) AS ts", "p.l_linenumber",
                                 FEED_SECONDS["refund_payment"]),
        "stream_province_detail_window": sql["province_window"],
        "stream_dim_enrich": _with("""
SELECT p_brand AS trademark_id, p_name AS sku_name, count(*) AS n
FROM lineitem LEFT JOIN article_rows ON p_partkey = l_partkey GROUP BY ALL""", "article_rows"),
        "stream_report_channel_uv_day": sql["report_channel_uv_day"],
        "stream_dim_upsert": _dimensions("p_name"),
        "stream_province_window": f"""
SELECT {_bounds('o_orderdate', '1 day')}, CAST(c_nationkey AS VARCHAR) AS province_id, n_name AS province_name,
       count(DISTINCT o_orderkey) AS order_count, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS order_amount
FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
GROUP BY o_orderdate, c_nationkey, n_name""",
        "stream_interval_join": """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_shipdate AS pt, o_custkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE o_orderdate BETWEEN l_shipdate - INTERVAL 30 DAY AND l_shipdate + INTERVAL 30 DAY""",
    }


def _table_sql() -> dict[str, str]:
    return {
        "dedup_first": _with("SELECT * FROM first_lines", "first_lines"),
        "dedup_last": _with("SELECT * FROM last_lines", "last_lines"),
        "unique_visitor": _with("SELECT event_id, mid, ch, ts FROM visitors", "visitors"),
        "daily_unique_user": _with(
            "SELECT mid, CAST(rt AS DATE) AS dt, min(ts) AS ts FROM pages GROUP BY mid, CAST(rt AS DATE)", "pages"),
        "new_user_flag": _with("""
SELECT uid, dt, ts, dt = min(dt) OVER (PARTITION BY uid) AS is_first_ever
FROM (SELECT uid, CAST(rt AS DATE) AS dt, min(ts) AS ts FROM pages GROUP BY uid, CAST(rt AS DATE)) AS q""", "pages"),
        "order_flags": _with("""
SELECT event_id, row_number() OVER (PARTITION BY mid, CAST(rt AS DATE) ORDER BY rt, event_id) = 1 AS is_daily_first,
       row_number() OVER (PARTITION BY mid ORDER BY rt, event_id) = 1 AS is_first_ever FROM pages""", "pages"),
        "page_daily_unique": _with("SELECT mid, page_id, dt, epoch_ms(rt) AS ts FROM page_firsts", "page_firsts"),
        "returning_user": _with("SELECT uid, dt, is_back FROM login_firsts", "login_firsts"),
        "is_new_repair": _with("""
SELECT event_id, mid, ts, CASE WHEN is_new = '1' AND CAST(rt AS DATE) <> first_date THEN '0' ELSE is_new END AS is_new
FROM (SELECT *, first_value(CASE WHEN is_new = '1' THEN CAST(rt AS DATE) ELSE CAST(rt AS DATE) - 1 END)
             OVER (PARTITION BY mid ORDER BY ts, is_new DESC) AS first_date FROM pages) AS q""", "pages"),
        "bounce": _with("SELECT event_id, mid, ch, ts FROM bounces", "bounces"),
        "log_split": _with(f"""
SELECT 'dwd_traffic_error_log' AS topic, mid, CAST(NULL AS VARCHAR) AS page_id, ts, '{{"error_code":' || k || '}}' AS part
FROM {_json_pages()} WHERE event_type = 'error'
UNION ALL SELECT 'dwd_traffic_start_log', mid, NULL, ts, '{{"entry":"icon"}}' FROM {_json_pages()} WHERE {_IS_START}
UNION ALL SELECT 'dwd_traffic_page_log', mid, page_id, ts, CASE WHEN event_type = 'error' THEN '{{"error_code":' || k || '}}' END
FROM {_json_pages()} WHERE NOT {_IS_START}
UNION ALL SELECT 'dwd_traffic_display_log', mid, page_id, ts, 'i' || i
FROM (SELECT *, unnest(range(1, 1 + k % 4)) AS i FROM {_json_pages()} WHERE NOT {_IS_START}) AS d
UNION ALL SELECT 'dwd_traffic_action_log', mid, page_id, NULL, 'a' || i
FROM (SELECT *, unnest(range(1, 1 + k % 3)) AS i FROM {_json_pages()} WHERE NOT {_IS_START}) AS a""", "pages"),
        "log_dirty": _with("""
SELECT substr('{"common":{"mid":"' || mid || '","uid":"' || mid || '","', 1, 20) AS value, count(*) AS n
FROM pages WHERE event_type = 'error' AND value < 10 GROUP BY ALL""", "pages"),
        "explode_displays": _with(f"""
SELECT mid, page_id, ts, 'i' || i AS item, CAST(i AS VARCHAR) AS pos
FROM (SELECT *, unnest(range(1, 1 + k % 4)) AS i FROM {_json_pages()} WHERE NOT {_IS_START}) AS d""", "pages"),
        "explode_actions": _with(f"""
SELECT mid, page_id, ts + i * 10 AS ts, 'a' || i AS action_id
FROM (SELECT *, unnest(range(1, 1 + k % 3)) AS i FROM {_json_pages()} WHERE NOT {_IS_START}) AS d""", "pages"),
        "log_pages": _with(f"""
SELECT mid, ch, is_new, page_id, last_page_id, during_time, ts FROM {_json_pages()} WHERE NOT {_IS_START}""", "pages"),
        "log_errors_starts": _with(f"""
SELECT 'error' AS kind, mid, ts, '{{"error_code":' || k || '}}' AS body FROM {_json_pages()} WHERE event_type = 'error'
UNION ALL SELECT 'start', mid, ts, '{{"entry":"icon"}}' FROM {_json_pages()} WHERE {_IS_START}""", "pages"),
        "change_round_trip": _with(f"""
SELECT 'order_detail' AS "table", 'insert' AS type, count(*) AS n, CAST(0 AS BIGINT) AS turned, {_long('l_orderkey', 'order_sum')} FROM lineitem
UNION ALL SELECT 'order_detail_activity', 'insert', count(*), 0, {_long('l_orderkey', 's')} FROM lineitem WHERE l_discount >= 0.05
UNION ALL SELECT 'order_detail_coupon', 'insert', count(*), 0, {_long('l_orderkey', 's')} FROM lineitem WHERE l_tax >= 0.04
UNION ALL SELECT 'order_refund_info', 'insert', count(*), 0, {_long('l_orderkey', 's')} FROM lineitem WHERE l_returnflag = 'R'
UNION ALL SELECT 'refund_payment', 'insert', count(*), 0, {_long('l_orderkey', 's')} FROM lineitem
  WHERE l_returnflag = 'R' AND l_linestatus = 'F'
UNION ALL SELECT 'payment_info', 'update', count(*), 0, {_long('o_orderkey', 's')} FROM orders
UNION ALL SELECT 'order_info', type, count(*), count(old_status), NULL FROM order_infos GROUP BY type""", "order_infos"),
        "comment_add": _with(f"""
SELECT {_ID_S}, {_user()}, {_SKU}, {_OID}, {_DAY}, {_AT} AS create_time, dic_code AS appraise_code, dic_name AS appraise_name, {_TS}
FROM ev JOIN dic ON dic_code = CAST(k % 30 AS VARCHAR) WHERE event_type = 'error' AND value < 80""", "ev", "dic"),
        "favor_add": _with(f"""
SELECT {_ID_S}, {_user()}, {_SKU}, {_DAY}, {_AT} AS create_time, {_TS} FROM ev WHERE event_type = 'view' AND value < 70""", "ev"),
        "coupon_get": _with(f"""
SELECT {_ID_S}, CAST(k AS VARCHAR) AS coupon_id, {_user()}, {_DAY}, {_AT} AS get_time, {_TS}
FROM ev WHERE event_type = 'purchase' AND value < 20""", "ev"),
        "coupon_order": _with(f"""
SELECT {_ID_S}, CAST(k AS VARCHAR) AS coupon_id, {_user()}, {_OID}, {_DAY}, {_AT} AS order_time, {_TS}
FROM ev WHERE event_type = 'purchase' AND value >= 20 AND value < 60""", "ev"),
        "coupon_pay": _with(f"""
SELECT {_ID_S}, CAST(k AS VARCHAR) AS coupon_id, {_user()}, {_OID}, {_DAY}, {_AT} AS payment_time, {_TS}
FROM ev WHERE event_type = 'purchase' AND value >= 60""", "ev"),
        "cart_delta": _with("SELECT * FROM cart_adds", "cart_adds"),
        "user_register": _with("SELECT user_id, date_id, create_time, ts FROM registered", "registered"),
        "order_wide": _with("SELECT * FROM wide", "wide"),
        "order_detail": _with("SELECT * FROM detail_facts", "detail_facts"),
        "order_cancel": _with(f"""
SELECT {_FACT.replace('create_time', 'operate_time AS cancel_time')} FROM wide
WHERE type = 'update' AND old_status IS NOT NULL AND order_status = '1003'""", "wide"),
        "pay_detail": _with("SELECT * FROM pay_details", "pay_details"),
        "pay_upsert": _with(
            "SELECT order_detail_id, order_id, callback_time, max(CASE WHEN CAST(order_id AS BIGINT) % 2 = 0 THEN 'again ' ELSE '' END"
            " || payment_type_code) AS payment_type_code FROM pay_details GROUP BY ALL", "pay_details"),
        "order_refund": _with(f"""
SELECT 'r' || id AS id, CAST(l_suppkey AS VARCHAR) AS user_id, CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id,
       CAST(o_custkey % 25 AS VARCHAR) AS province_id, substr(made, 1, 10) AS date_id, made AS create_time,
       t.dic_code AS refund_type_code, t.dic_name AS refund_type_name, w.dic_code AS refund_reason_type_code,
       w.dic_name AS refund_reason_type_name, l_linestatus AS refund_reason_txt, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS refund_num,
       {_money('l_extendedprice')} AS refund_amount, {_SHIP_TS} AS ts
FROM lines JOIN orders ON o_orderkey = l_orderkey JOIN dic AS t ON t.dic_code = CAST(l_suppkey % 30 AS VARCHAR)
JOIN dic AS w ON w.dic_code = CAST(l_linenumber AS VARCHAR) WHERE l_returnflag = 'R' AND o_orderstatus = 'F'""", "lines", "dic"),
        "refund_pay": _with(f"""
SELECT 'p' || p.id AS id, CAST(o_custkey AS VARCHAR) AS user_id, CAST(p.l_orderkey AS VARCHAR) AS order_id,
       CAST(p.l_partkey AS VARCHAR) AS sku_id, CAST(o_custkey % 25 AS VARCHAR) AS province_id, dic_code AS payment_type_code,
       dic_name AS payment_type_name, substr(p.made, 1, 10) AS date_id, p.made AS callback_time,
       CAST(CAST(r.l_quantity AS INTEGER) AS VARCHAR) AS refund_num, {_money('p.l_extendedprice')} AS refund_amount,
       CAST(CAST(epoch(p.l_shipdate) AS BIGINT) AS VARCHAR) AS ts
FROM lines AS p JOIN lines AS r ON r.l_orderkey = p.l_orderkey AND r.l_partkey = p.l_partkey
JOIN orders ON o_orderkey = p.l_orderkey JOIN dic ON dic_code = CAST(p.l_suppkey % 30 AS VARCHAR)
WHERE p.l_returnflag = 'R' AND p.l_linestatus = 'F' AND r.l_returnflag = 'R' AND o_orderstatus = 'F'""", "lines", "dic"),
        "dim_route_project": _with("""
SELECT 'dim_sku_info' AS sink_table, 'id' AS sink_pk,
       CASE p_type WHEN 'ECONOMY' THEN 'insert' WHEN 'STANDARD' THEN 'update' ELSE 'bootstrap-insert' END AS type,
       CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_brand AS tm_id, CAST(NULL AS VARCHAR) AS segment, CAST(NULL AS VARCHAR) AS price
FROM article_rows
UNION ALL SELECT 'dim_customer', 'id', CASE c_mktsegment WHEN 'BUILDING' THEN 'update' ELSE 'insert' END,
       CAST(c_custkey AS VARCHAR), NULL, NULL, c_mktsegment, NULL FROM customer""", "article_rows"),
        "dim_upsert": _dimensions("CASE WHEN p_size > 25 THEN upper(p_name) ELSE p_name END"),
        "dim_enrich": _with("""
SELECT trademark_id, category1_name, category2_name, category3_name, count(*) AS n
FROM lineitem LEFT JOIN sku ON p_partkey = l_partkey LEFT JOIN chain ON chain.category3_id = sku.category3_id
GROUP BY ALL""", "sku", "chain"),
        "category_chain": _with("SELECT * FROM chain", "chain"),
        "traffic_window": _with("SELECT * FROM traffic", "traffic"),
        "page_view_window": _with("SELECT * FROM page_views", "page_views"),
        "keyword_window": _with("SELECT * FROM keywords", "keywords"),
        "keyword_dictionary": """
SELECT word, count(*) AS n FROM (
  SELECT unnest(regexp_extract_all(text, '(ation|tion|eau|ent|the|sh|[A-Za-z0-9]+|[\\p{L}\\p{N}])', 1)) AS word FROM documents) AS q
GROUP BY word""",
        "keyword_udtf": _with("SELECT keyword AS word, count(*) AS n FROM keyword_rows WHERE keyword <> '' GROUP BY keyword", "keyword_rows"),
        "login_window": _with("SELECT * FROM logins", "logins"),
        "register_window": _with("SELECT * FROM registers", "registers"),
        "cart_window": _with("SELECT * FROM carts", "carts"),
        "order_window": _with("SELECT * FROM orders_dws", "orders_dws"),
        "payment_window": _with("SELECT * FROM payments", "payments"),
        "province_window": _with("SELECT * FROM provinces", "provinces"),
        "user_item_window": _with("SELECT * FROM user_spu", "user_spu"),
        "refund_window": _with("SELECT * FROM refunds", "refunds"),
        "sum_window": _with(f"""
SELECT {_bounds('w', '1 hour')}, mid, {_long('during_time', 'during_time')}
FROM (SELECT *, {_bucket('rt', '1 hour')} AS w FROM pages) AS q GROUP BY w, mid""", "pages"),
        "province_sketch": _with("""
SELECT CAST(c_nationkey AS VARCHAR) AS province_id, count(DISTINCT o_custkey) AS user_count, true AS near
FROM last_lines JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY c_nationkey""", "last_lines"),
        "summary_table": _with(f"SELECT *, {_DT} FROM traffic", "traffic"),
        "time_functions": f"""
SELECT o_orderkey, epoch_ms(o_orderdate) AS ms, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, {_HM}) AS at,
       strftime(o_orderdate, '%Y-%m-%d') AS part, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS day_no,
       CASE WHEN o_orderstatus = 'O' THEN -1 ELSE 0 END AS order_no, CAST(o_orderdate AS DATE) = DATE '1998-10-03' AS that_day
FROM orders""",
        "report_activity": _subsidy("order_activity_reduce_amount", "activity_reduce_amount", "subsidy_rate"),
        "report_coupon": _subsidy("order_coupon_reduce_amount", "coupon_reduce_amount", "coupon_subsidy_rate"),
        "report_trademark": _goods(["trademark_id"], ["trademark_name"]),
        "report_trademark_amount": _with(f"""
SELECT dt, trademark_name, {_cents('order_amount')} FROM {_daily('user_spu')} GROUP BY dt, trademark_id, trademark_name""", "user_spu"),
        "report_category": _goods([f"category{i}_id" for i in (1, 2, 3)], [f"category{i}_name" for i in (1, 2, 3)]),
        "report_spu": _with(f"""
SELECT dt, spu_name, {_long('order_count', 'order_count')}, count(DISTINCT user_id) AS uu_count, {_cents('order_amount')}
FROM {_daily('user_spu')} GROUP BY dt, spu_id, spu_name""", "user_spu"),
        "report_top_trademark": _with(f"""
SELECT * FROM (SELECT dt, trademark_name, {_cents('order_amount')} FROM {_daily('user_spu')} GROUP BY dt, trademark_name) AS z
QUALIFY row_number() OVER (PARTITION BY dt ORDER BY order_amount DESC, trademark_name NULLS FIRST) <= 5""", "user_spu"),
        "report_total_amount": _with(f"""
SELECT dt, {_cents('order_amount', 'order_total_amount')} FROM {_daily('provinces')} GROUP BY dt""", "provinces"),
        "report_trade": _with(f"""
SELECT dt, '下单数' AS type, {_long('order_count', 'value')} FROM {_daily('user_spu')} GROUP BY dt
UNION ALL SELECT dt, '下单人数', count(DISTINCT user_id) FROM {_daily('user_spu')} GROUP BY dt
UNION ALL SELECT dt, '退单数', {_long('refund_count', 'value')} FROM {_daily('refunds')} GROUP BY dt
UNION ALL SELECT dt, '退单人数', count(DISTINCT user_id) FROM {_daily('refunds')} GROUP BY dt""", "user_spu", "refunds"),
        "report_province_orders": _with(f"""
SELECT dt, province_name, {_long('order_count', 'order_count')} FROM {_daily('provinces')} GROUP BY dt, province_id, province_name""",
                                        "provinces"),
        "report_province_amount": _with(f"""
SELECT dt, province_name, {_cents('order_amount')} FROM {_daily('provinces')}
WHERE province_name IS NOT NULL AND province_name <> '' GROUP BY dt, province_id, province_name""", "provinces"),
        "report_channel_uv": _channel("CAST(sum(uv_ct) AS BIGINT)", "uv_ct"),
        "report_channel_sessions": _channel("CAST(sum(sv_ct) AS BIGINT)", "sv_ct"),
        "report_channel_pages": _channel(_per_session("pv_ct"), "pv_per_session"),
        "report_channel_time": _channel(_per_session("dur_sum"), "dur_per_session"),
        "report_channel_bounce": _channel(_per_session("uj_ct"), "uj_rate"),
        "report_channel_uv_uj": _with(f"""
SELECT dt, ch, {_long('uv_ct', 'uv_ct')}, {_long('uj_ct', 'uj_ct')} FROM {_daily('traffic')} GROUP BY dt, ch""", "traffic"),
        "report_keyword": _with(f"""
SELECT dt, keyword, CAST(sum(keyword_count * CASE upper(source) WHEN 'SEARCH' THEN 10 WHEN 'ORDER' THEN 5 WHEN 'CART' THEN 2
       WHEN 'CLICK' THEN 1 ELSE 0 END) AS BIGINT) AS keyword_score FROM {_daily('keywords')} GROUP BY dt, keyword""", "keywords"),
        "report_visitor_type": _with("SELECT * FROM visitor_types", "visitor_types"),
        "report_visitor_table": _with(" UNION ALL ".join(_metric(k, c) for k, c in {
            "访客数(人)": "uv_ct", "总访问页面数(次)": "pv_ct", "跳出率(%)": "uj_rate", "平均在线时长(秒)": "avg_dur_sum",
            "平均访问页面数(人次)": "avg_pv_ct"}.items()), "visitor_types"),
        "report_hourly": _with("SELECT * FROM hourly", "hourly"),
        "report_hourly_filled": _with("""
SELECT d.dt, CAST(d.hr AS INTEGER) AS hr, coalesce(uv_ct, 0) AS uv_ct, coalesce(pv_ct, 0) AS pv_ct, coalesce(new_uv_ct, 0) AS new_uv_ct
FROM (SELECT dt, unnest(range(24)) AS hr FROM (SELECT DISTINCT dt FROM hourly) AS x) AS d
LEFT JOIN hourly AS h ON h.dt = d.dt AND h.hr = d.hr""", "hourly"),
        "report_funnel": _with(" UNION ALL ".join([
            _rows("page_views", "page_id", "uv_ct", {"home": "home_uv_ct", "good_detail": "good_detail_uv_ct"}),
            _rows("carts", "page_id", "uv_ct", {"cart": "cart_add_uu_ct"}),
            _rows("orders_dws", "page_id", "uv_ct", {"trade": "order_unique_user_count"}),
            _rows("payments", "page_id", "uv_ct", {"payment": "payment_suc_unique_user_count"}),
        ]), "page_views", "carts", "orders_dws", "payments"),
        "report_user_change": _with(" UNION ALL ".join([
            _rows("logins", "type", "user_ct", {"backCt": "back_ct", "activeUserCt": "uu_ct"}),
            _rows("registers", "type", "user_ct", {"newUserCt": "register_ct"}),
        ]), "logins", "registers"),
        "report_new_trade_users": _with(" UNION ALL ".join([
            _rows("orders_dws", "trade_type", "user_ct", {"order": "order_new_user_count"}),
            _rows("payments", "trade_type", "user_ct", {"payment": "payment_suc_new_user_count"}),
        ]), "orders_dws", "payments"),
    }
