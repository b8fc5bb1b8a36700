"""DuckDB SQL that states, independently of the Spark code, what each
registered query must return on the driver's tables.

The fragments rebuild the expected layer contents straight from ``events``
and ``customer`` (no JSON round trip): the injected defects are expressed by
the same residues the feed uses, so a difference means a Spark operator is
wrong, not the feed.
"""

from __future__ import annotations

from tributary.sources.feeds import CDC_DEFECTS, CLICK_DEFECTS, LATE_CHANGE

D = CLICK_DEFECTS

CLICK = f"""
click AS (
  SELECT event_id AS event_num,
         CAST(event_id AS VARCHAR) AS event_id,
         'USER-' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS user_key,
         ts,
         CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'
              WHEN 'purchase' THEN 'purchase' WHEN 'error' THEN 'search'
              ELSE 'user_login' END AS ctype,
         CASE WHEN event_type IN ('view', 'click', 'purchase')
              THEN 'PROD-' || lpad(json_extract_string(props, '$.k'), 4, '0') END AS product_id,
         's-' || CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id,
         CASE event_type WHEN 'view' THEN '/item' WHEN 'click' THEN '/basket'
              WHEN 'purchase' THEN '/pay' WHEN 'error' THEN '/find' ELSE '/home' END AS page_url,
         ['laptop', 'phone', 'kiosk'][user_id % 3 + 1] AS device_type,
         ['newsletter', 'partner', 'qr-code', 'none'][event_id % 4 + 1] AS referrer,
         CASE WHEN event_type = 'error'
              THEN 'query-' || json_extract_string(props, '$.k') END AS search_query,
         CASE WHEN event_type IN ('click', 'purchase') THEN value END AS cart_value,
         CASE WHEN event_type IN ('click', 'purchase')
              THEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 + 1 END AS quantity,
         event_num % {D['malformed']} = 0 AS malformed
  FROM (SELECT *, event_id AS event_num FROM events)
)"""

# Bronze rows, one per Kafka record (re-sends included).
BRONZE = CLICK + f""",
copies AS (
  SELECT *, CAST((event_num + CASE WHEN copy = 2 THEN 1 ELSE 0 END) % 3 AS INTEGER) AS kpart,
         event_num * 4 + copy AS koff,
         ts + CASE WHEN copy = 0 THEN INTERVAL 0 SECOND WHEN copy = 2 THEN INTERVAL 2 DAY
                   WHEN event_num % {D['early_copy']} = 0 THEN INTERVAL (-1) SECOND
                   ELSE INTERVAL 1 SECOND END AS kts,
         CASE WHEN event_num % {D['future']} = 0 THEN ts + INTERVAL 3 DAY ELSE ts END AS claimed
  FROM (SELECT *, unnest(CASE WHEN event_num % {D['late_copy']} = 0 THEN [0, 1, 2]
                              WHEN event_num % {D['resend']} = 0 THEN [0, 1] ELSE [0] END) AS copy
        FROM click)
),
bronze AS (
  SELECT CASE WHEN malformed THEN NULL ELSE event_id END AS event_id,
         CASE WHEN malformed OR event_num % {D['missing_user']} = 0 THEN NULL
              WHEN event_num % {D['padded_user']} = 0 THEN user_key || ' '
              ELSE user_key END AS user_id,
         CASE WHEN malformed THEN NULL
              WHEN event_num % {D['bad_time']} = 0 THEN 'some time ago'
              WHEN event_num % {D['offset_time']} = 0
                THEN strftime(claimed, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'
              ELSE strftime(claimed, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' END AS "timestamp",
         CASE WHEN malformed THEN NULL
              WHEN event_num % {D['bad_type']} = 0 THEN 'bogus' ELSE ctype END AS event_type,
         CASE WHEN malformed THEN NULL ELSE product_id END AS product_id,
         CASE WHEN malformed THEN NULL ELSE session_id END AS session_id,
         CASE WHEN malformed OR event_num % {D['bad_time']} = 0 THEN NULL ELSE claimed END AS event_ts,
         CASE WHEN malformed THEN NULL ELSE page_url END AS page_url,
         CASE WHEN malformed THEN NULL ELSE device_type END AS device_type,
         CASE WHEN malformed THEN NULL ELSE referrer END AS referrer,
         CASE WHEN malformed THEN NULL ELSE search_query END AS search_query,
         CASE WHEN malformed OR event_num % {D['bad_number']} = 0 THEN NULL ELSE cart_value END AS cart_value,
         CASE WHEN malformed THEN NULL ELSE quantity END AS quantity,
         kts AS kafka_timestamp, kpart AS kafka_partition, koff AS kafka_offset,
         event_num, copy
  FROM copies
)"""

# Silver rows: required fields present, first-ranked copy, cleaned keys, flags.
SILVER = BRONZE + """,
silver AS (
  SELECT event_id, lower(trim(user_id)) AS user_id, event_type, product_id,
         lower(trim(session_id)) AS session_id,
         kafka_timestamp, kafka_partition, kafka_offset,
         event_ts AS event_timestamp, page_url, device_type, referrer, search_query,
         cart_value, quantity,
         coalesce(event_type = 'purchase', false) AS is_conversion,
         coalesce(event_type IN ('add_to_cart', 'purchase'), false) AS is_cart_event
  FROM (SELECT *, row_number() OVER (PARTITION BY event_id
                    ORDER BY kafka_timestamp, kafka_partition, kafka_offset) AS nth
        FROM bronze
        WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND session_id IS NOT NULL
          AND event_type IS NOT NULL)
  WHERE nth = 1
)"""

BRONZE_OUT = """event_id, user_id, "timestamp", event_type, product_id, session_id,
  kafka_timestamp, kafka_partition, kafka_offset"""


def with_(cte: str, body: str) -> str:
    return f"WITH {cte}\n{body}"


# Change feed (same derivation as feeds.cdc_changes), in arrival order.
CDC = f"""
cdc AS (
  SELECT event_id AS change_num,
         event_id % {CDC_DEFECTS['no_image']} = 0 AS bare,
         CASE WHEN event_id % {CDC_DEFECTS['bad_op']} = 0 THEN 'x'
              WHEN event_id % {CDC_DEFECTS['read']} = 0 THEN 'r'
              WHEN event_type = 'signup' THEN 'c'
              WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS op,
         epoch_us(ts) // 1000 - CASE WHEN event_id % {LATE_CHANGE} = 0 THEN 864000000 ELSE 0 END AS ts_ms,
         epoch_us(ts) // 1000 AS arrived_ms,
         CASE WHEN event_id % {CDC_DEFECTS['no_image']} = 0 THEN NULL
              ELSE 'USER-' || lpad(CAST(user_id AS VARCHAR), 6, '0') END AS user_id,
         'user ' || CAST(user_id AS VARCHAR) || ' v' || CAST(event_id AS VARCHAR) AS name,
         'u' || CAST(event_id AS VARCHAR) || '@example.com' AS email
  FROM events
)"""

PROFILES = """
profiles AS (
  SELECT 'USER-' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS user_id,
         c_name AS name,
         lower(replace(c_name, '#', '.')) || '@example.com' AS email,
         c_acctbal
  FROM customer
)"""
