"""DuckDB SQL for the fixture sources (mirrors sources/fixtures.py).

Each string is a CTE list body over the driver's pre-registered views.
"""

from __future__ import annotations

from testbed.packets import BASE_EPOCH, ZERO_PORT, ZERO_ROLE

EVENTS = f"""
ev AS (
  SELECT CAST(ts AS TIMESTAMP) AS timestamp,
         CASE WHEN event_type = 'signup' THEN 'node_info' ELSE 'packet' END AS variant,
         CAST(user_id % 8 - 4 AS INTEGER) AS p_from,
         CAST(CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id % 3 END AS INTEGER) AS p_to,
         0 AS p_channel,
         CAST(floor(epoch(CAST(ts AS TIMESTAMP))) AS INTEGER) AS p_rx_time,
         event_type = 'error' AS encrypted,
         event_type IN ('click', 'purchase') AS decoded,
         CASE event_type WHEN 'click' THEN 'TEXT_MESSAGE_APP'
                         WHEN 'purchase' THEN 'PORT_A' ELSE '{ZERO_PORT}' END AS portnum,
         CASE WHEN event_type IN ('click', 'purchase') THEN props ELSE '' END AS payload_text,
         CAST(user_id AS INTEGER) AS n_num, '' AS n_user_id, '' AS n_short_name,
         '' AS n_long_name, '{ZERO_ROLE}' AS n_role, 0 AS n_last_heard, 0 AS n_hops_away,
         CAST(0.0 AS FLOAT) AS n_snr
  FROM events)"""

CUSTOMERS = f"""
cu AS (
  SELECT TIMESTAMP '1970-01-01 00:00:00' + to_seconds({BASE_EPOCH} + c_custkey * 60) AS timestamp,
         'node_info' AS variant,
         CAST(c_custkey - 500 AS INTEGER) AS n_num,
         c_name AS n_user_id, right(c_name, 4) AS n_short_name, c_name AS n_long_name,
         c_mktsegment AS n_role,
         CAST(CASE WHEN c_custkey % 10 = 0 THEN 0 ELSE {BASE_EPOCH} + c_custkey * 60 END
              AS INTEGER) AS n_last_heard,
         CAST(c_nationkey % 8 AS INTEGER) AS n_hops_away,
         CAST(c_acctbal / 100 AS FLOAT) AS n_snr
  FROM customer)"""

CONVERSATIONS = f"""
cv AS (
  SELECT TIMESTAMP '1970-01-01 00:00:00' + to_seconds({BASE_EPOCH} + conv_id * 60 + turn) AS timestamp,
         'packet' AS variant,
         CAST(conv_id - 50 AS INTEGER) AS p_from, -1 AS p_to,
         CAST(turn AS INTEGER) AS p_channel,
         CAST({BASE_EPOCH} + conv_id * 60 + turn AS INTEGER) AS p_rx_time,
         role = 'assistant' AS encrypted,
         role IN ('user', 'system') AS decoded,
         CASE role WHEN 'user' THEN 'TEXT_MESSAGE_APP'
                   WHEN 'system' THEN 'PORT_A' ELSE '{ZERO_PORT}' END AS portnum,
         CASE WHEN role IN ('user', 'system') THEN text ELSE '' END AS payload_text
  FROM conversations)"""

# All three as one topic, in one wide flat layout (nulls where a part is absent).
ALL = EVENTS + "," + CUSTOMERS + "," + CONVERSATIONS + """,
allp AS (
  SELECT timestamp, variant,
         CASE WHEN variant = 'packet' THEN p_from END AS p_from,
         CASE WHEN variant = 'packet' THEN p_to END AS p_to,
         CASE WHEN variant = 'packet' THEN p_channel END AS p_channel,
         CASE WHEN variant = 'packet' THEN p_rx_time END AS p_rx_time,
         CASE WHEN variant = 'packet' THEN encrypted END AS encrypted,
         CASE WHEN variant = 'packet' THEN decoded END AS decoded,
         CASE WHEN variant = 'packet' THEN portnum END AS portnum,
         CASE WHEN variant = 'packet' THEN payload_text END AS payload_text,
         CASE WHEN variant = 'node_info' THEN n_num END AS n_num,
         CASE WHEN variant = 'node_info' THEN n_user_id END AS n_user_id,
         CASE WHEN variant = 'node_info' THEN n_short_name END AS n_short_name,
         CASE WHEN variant = 'node_info' THEN n_long_name END AS n_long_name,
         CASE WHEN variant = 'node_info' THEN n_role END AS n_role,
         CASE WHEN variant = 'node_info' THEN n_last_heard END AS n_last_heard,
         CASE WHEN variant = 'node_info' THEN n_hops_away END AS n_hops_away,
         CASE WHEN variant = 'node_info' THEN n_snr END AS n_snr
  FROM ev
  UNION ALL
  SELECT timestamp, variant, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
         n_num, n_user_id, n_short_name, n_long_name, n_role, n_last_heard,
         n_hops_away, n_snr
  FROM cu
  UNION ALL
  SELECT timestamp, variant, p_from, p_to, p_channel, p_rx_time, encrypted, decoded,
         portnum, payload_text, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
  FROM cv)"""

KIND = ("CASE WHEN encrypted THEN 'ENCRYPTED' WHEN decoded THEN portnum ELSE '' END")
UNSIGNED = "(CAST({c} AS BIGINT) & 4294967295)"


def unsigned(c: str) -> str:
    return UNSIGNED.format(c=c)


def iso_local_text(c: str) -> str:
    """Java ISO local date-time text: seconds left out when zero."""
    return (f"CASE WHEN second({c}) = 0 THEN strftime({c}, '%Y-%m-%dT%H:%M') "
            f"ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S') END")


def epoch_to_ntz(c: str) -> str:
    return f"(TIMESTAMP '1970-01-01 00:00:00' + to_seconds({c}))"
