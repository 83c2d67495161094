"""The FIXTURES.md derivations in DuckDB SQL (the oracle side of plans/fixtures.py)."""

from __future__ import annotations

FIXTURES = {
    "handoff": """
h AS (SELECT event_id AS eid,
             lag(user_id) OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) AS src,
             user_id AS dst, CAST(round(value * 100) AS BIGINT) AS w, event_type, ts
      FROM events),
handoff AS (SELECT * FROM h WHERE src IS NOT NULL AND src <> dst
            AND event_type = 'signup'),
follow AS (SELECT * FROM h WHERE src IS NOT NULL AND src <> dst
           AND event_type = 'purchase'),
users AS (SELECT DISTINCT user_id FROM events)""",
    "usage_events": """
usage_events AS (SELECT event_id, ts, user_id,
  'FLB' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS consumer_account_locator,
  'acct' || CAST(user_id AS VARCHAR) AS consumer_account_name,
  CASE event_type WHEN 'purchase' THEN 'PURCHASE' WHEN 'signup' THEN 'TRIAL' WHEN 'view' THEN 'GET'
       ELSE event_type END AS event_type,
  CASE WHEN event_id % 3 = 0 THEN 'u' || CAST(user_id AS VARCHAR) || '@example.com' ELSE '' END AS consumer_email,
  CASE WHEN event_id % 4 = 0 THEN '{"first_name":"fn' || CAST(user_id AS VARCHAR) || '","last_name":"ln'
       || CAST(event_id AS VARCHAR) || '"}' END AS consumer_metadata,
  CASE WHEN event_id % 2 = 0 THEN 'GRAPH_APP_FREE' ELSE 'GRAPH_APP_PRO' END AS listing_name
  FROM events)""",
    "usage_apps": """
usage_apps AS (SELECT
  CASE WHEN c_custkey % 50 = 0 THEN '' ELSE 'FLB' || lpad(CAST(c_custkey AS VARCHAR), 5, '0') END
       AS consumer_account_locator,
  c_name AS consumer_account_name,
  CASE c_nationkey % 4 WHEN 0 THEN 'AWS_US_WEST_2' WHEN 1 THEN 'AZURE_WESTEUROPE' WHEN 2 THEN 'PUBLIC' END
       AS consumer_snowflake_region,
  'V2' AS current_version, CAST(c_custkey % 5 AS INTEGER) AS current_patch,
  TIMESTAMP '2024-01-01' + c_custkey * INTERVAL 1 DAY AS created_on,
  CASE c_custkey % 4 WHEN 0 THEN 'COMPLETE' WHEN 1 THEN 'DISABLED' WHEN 2 THEN 'PENDING' ELSE 'OTHER' END
       AS upgrade_state,
  CASE WHEN c_custkey % 2 = 0 THEN TIMESTAMP '2024-01-01' + (c_custkey + 10) * INTERVAL 1 DAY END
       AS last_upgraded_on,
  'GRAPH_APP_PACKAGE' AS package_name, c_custkey
  FROM customer)""",
    "halves": """
cust_old AS (SELECT * FROM customer WHERE c_custkey % 3 <> 0),
cust_new AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment
             FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0),
ord_old AS (SELECT * FROM orders WHERE o_orderkey % 3 <> 0),
ord_new AS (SELECT * FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0)""",
}


def cte(*names: str, extra: list[str] | tuple[str, ...] = ()) -> str:
    """``WITH <fixture CTEs>, <extra CTEs>`` (no trailing comma)."""
    parts = [FIXTURES[n].strip() for n in names] + [e.strip() for e in extra]
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""
