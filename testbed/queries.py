"""Registered queries and their DuckDB oracles.

Every query reads the driver's tables (or data Spark derives from them)
whole; nothing is sampled or capped. Job ids are fixed per query (md5 of the
name) so results can be compared with SQL.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetflow.operators import messages as M
from packetflow.operators.decode import decode_packets
from packetflow.operators.filters import keep_node_info, keep_packets, keep_text_messages
from packetflow.operators.nodes import node_info
from packetflow.operators.traffic import node_context, packet_traffic, payload_kind
from testbed import oracle as O
from testbed import packets as X
from testbed.descriptors import ENVELOPE, fixture_descriptor_set
from packetflow.sinks.webhook import ORDER_COLUMNS, send_notifications
from packetflow.sources.files import replay_offsets, replay_range
from testbed.packets import BASE_EPOCH
from testbed.senders import Places, answered

# Parameters of the registered queries (our choice; not values of the reference).
REPLAY_FROM = "2024-01-05T00:00:00+02:00"
REPLAY_TO = "2024-01-12T12:30:00+01:00"
REPLAY_WINDOW_MINUTES = 60
ZONE_EAST = "Europe/Warsaw"
ZONE_WEST = "America/New_York"


def job_id(name: str) -> str:
    return hashlib.md5(name.encode()).hexdigest()


def _traffic_sql(window_minutes: int, jid: str, source: str = "ctx") -> str:
    return f"""
SELECT from_node, to_node, CAST(count(*) AS INTEGER) AS packet_count,
       time_bucket(INTERVAL {window_minutes} MINUTE, timestamp) AS window_start,
       time_bucket(INTERVAL {window_minutes} MINUTE, timestamp)
         + INTERVAL {window_minutes} MINUTE AS window_end,
       kind, '{jid}' AS job_id
FROM {source}
GROUP BY ALL"""


_EVENTS_CTX = f"""WITH {O.EVENTS},
ctx AS (
  SELECT timestamp, {O.unsigned('p_from')} AS from_node, {O.unsigned('p_to')} AS to_node,
         {O.KIND} AS kind
  FROM ev WHERE variant = 'packet')"""


# ---------------------------------------------------------------- J1 traffic

def q_traffic_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packet_traffic(X.events_packets(spark, sf_dir, payload=False), 10, job_id("traffic_window"))


def q_traffic_window_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packet_traffic(X.events_packets(spark, sf_dir, payload=False), 24 * 60, job_id("traffic_window_1d"))


def q_node_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return node_context(X.events_packets(spark, sf_dir, payload=False))


def q_payload_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    packets = keep_packets(X.all_packets(spark, sf_dir))
    return packets.select("timestamp", F.col("packet.from").alias("packet_from"),
                          payload_kind().alias("kind"))


def q_replay_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    packets = replay_range(X.events_packets(spark, sf_dir, payload=False), REPLAY_FROM, REPLAY_TO)
    return packet_traffic(packets, REPLAY_WINDOW_MINUTES, job_id("replay_range"))


def q_replay_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3/S4 by offsets, over a log whose record times don't rise with the offsets."""
    packets = replay_offsets(X.offset_packets(spark, sf_dir), REPLAY_FROM, REPLAY_TO)
    return packet_traffic(packets, REPLAY_WINDOW_MINUTES, job_id("replay_offsets"))


# ----------------------------------------------------------------- filters

def q_variant_packet(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("packet")
    return keep_packets(X.all_packets(spark, sf_dir)).select(
        "timestamp", "variant", p["from"].alias("packet_from"), p["to"].alias("packet_to"),
        p["channel"].alias("channel"), p["encrypted"].alias("encrypted"),
        p["decoded"].alias("decoded"), p["portnum"].alias("portnum"))


def q_variant_node_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("node_info")
    return keep_node_info(X.all_packets(spark, sf_dir)).select(
        "timestamp", "variant", n["num"].alias("num"), n["user_id"].alias("user_id"),
        n["role"].alias("role"), n["last_heard"].alias("last_heard"))


def q_variant_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("packet")
    return keep_text_messages(X.all_packets(spark, sf_dir)).select(
        "timestamp", p["from"].alias("packet_from"), p["channel"].alias("channel"),
        p["rx_time"].alias("rx_time"))


# -------------------------------------------------------------- J2 node info

def q_node_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return node_info(X.customer_packets(spark, sf_dir), zone="UTC")


def q_node_info_zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return node_info(X.customer_packets(spark, sf_dir), zone=ZONE_EAST)


# ------------------------------------------------------------ J3 text messages

def _texts(spark, sf_dir, name):
    return M.text_messages(X.conversation_packets(spark, sf_dir), zone="UTC", job_id=job_id(name))


def q_text_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir, "text_messages")


def q_text_messages_zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.text_messages(X.conversation_packets(spark, sf_dir), zone=ZONE_WEST,
                           job_id=job_id("text_messages_zoned"))


def q_notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.notifications(_texts(spark, sf_dir, "notifications"))


def q_notification_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.notification_json(M.notifications(_texts(spark, sf_dir, "notification_bodies")))


def q_audit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.audit_lines(_texts(spark, sf_dir, "audit_lines"))


# ------------------------------------------------------------------ D1 decode

def _decoded_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_packets(X.raw_packets(spark, sf_dir), fixture_descriptor_set(), ENVELOPE)


def q_decoded_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 over the whole topic; the packet members, flattened."""
    p = F.col("packet")
    return _decoded_topic(spark, sf_dir).where(F.col("variant") == "packet").select(
        "timestamp", "variant",
        p["from"].alias("p_from"), p["to"].alias("p_to"), p["channel"].alias("p_channel"),
        p["rx_time"].alias("p_rx_time"), p["encrypted"].alias("encrypted"),
        p["decoded"].alias("decoded"), p["portnum"].alias("portnum"),
        p["payload"].cast("string").alias("payload_text"))


def q_decoded_node_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 over the whole topic; the node-info members, flattened."""
    n = F.col("node_info")
    return _decoded_topic(spark, sf_dir).where(F.col("variant") == "node_info").select(
        "timestamp", "variant",
        n["num"].alias("n_num"), n["user_id"].alias("n_user_id"),
        n["short_name"].alias("n_short_name"), n["long_name"].alias("n_long_name"),
        n["role"].alias("n_role"), n["last_heard"].alias("n_last_heard"),
        n["hops_away"].alias("n_hops_away"), n["snr"].alias("n_snr"))


# ----------------------------------------------- J1-J3 from protobuf bytes

def _bytes(spark, sf_dir):
    return X.raw_packets(spark, sf_dir)


def q_traffic_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    from packetflow.plans.jobs import traffic_plan
    return traffic_plan(_bytes(spark, sf_dir), fixture_descriptor_set(), ENVELOPE, 10,
                        job_id("traffic_decoded"))


def q_node_info_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    from packetflow.plans.jobs import node_info_plan
    return node_info_plan(_bytes(spark, sf_dir), fixture_descriptor_set(), ENVELOPE, zone="UTC")


def q_text_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    from packetflow.plans.jobs import text_plan
    return text_plan(_bytes(spark, sf_dir), fixture_descriptor_set(), ENVELOPE, zone="UTC",
                     job_id=job_id("text_decoded"))


# ---------------------------------------------------------------- streaming

def q_stream_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    from testbed.streams import stream_traffic
    return stream_traffic(spark, sf_dir, job_id("stream_traffic"))


def q_stream_traffic_flushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from testbed.streams import stream_traffic_flushed
    return stream_traffic_flushed(spark, sf_dir, job_id("stream_traffic_flushed"))


def q_node_info_sink_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4 into a table that keeps run and batch: a repeated batch replaces its rows."""
    from testbed.streams import node_info_sink
    return node_info_sink(spark, sf_dir, by_batch=True)


def q_webhook_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: each body with its place among its sender's messages, as a sender met them."""
    texts = M.text_messages(X.conversation_packets(spark, sf_dir), zone="UTC",
                            job_id=job_id("webhook_in_order"), record_time=True)
    return send_notifications(M.notifications(texts, ORDER_COLUMNS), Places(), ordered=True)


def q_webhook_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each body with the status of its answer, 0 where there was none."""
    return send_notifications(M.notifications(_texts(spark, sf_dir, "webhook_statuses")), answered)


def q_text_unknown_charset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: rows and characters by charset; one that the JVM doesn't know drops rows, not the job."""
    packets = X.conversation_packets(spark, sf_dir)

    def counted(charset):
        rows = M.text_messages(packets, charset, "UTC", job_id("text_unknown_charset"))
        return rows.agg(F.count("*").alias("n_rows"), F.coalesce(
            F.sum(F.length("text")), F.lit(0)).alias("n_chars")).withColumn("charset", F.lit(charset))

    return counted("utf-8").unionByName(counted("x-no-such-charset"))


def q_text_latin1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same payloads read in a charset of one byte a character."""
    return M.text_messages(X.conversation_packets(spark, sf_dir), "ISO-8859-1", "UTC",
                           job_id("text_latin1"))


def q_stream_traffic_restarts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from testbed.streams import stream_traffic_restarts
    return stream_traffic_restarts(spark, sf_dir, job_id("stream_traffic_restarts"))


def q_stream_traffic_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    from testbed.streams import stream_traffic_late
    return stream_traffic_late(spark, sf_dir, job_id("stream_traffic_late"))


def q_traffic_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    from testbed.streams import traffic_sink
    return traffic_sink(spark, sf_dir, job_id("traffic_sink"))


def q_traffic_replay_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    from testbed.streams import traffic_replay_twice
    return traffic_replay_twice(spark, sf_dir, job_id("traffic_replay_twice"))


def q_text_replay_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    from testbed.streams import text_replay_twice
    return text_replay_twice(spark, sf_dir, job_id("text_replay_twice"))


def q_text_sink_zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    from testbed.streams import text_sink_zoned
    return text_sink_zoned(spark, sf_dir, job_id("text_sink_zoned"), ZONE_WEST)


def q_audit_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    from testbed.streams import audit_sink
    return audit_sink(spark, sf_dir, job_id("audit_sink"))


def q_node_info_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    from testbed.streams import node_info_sink
    return node_info_sink(spark, sf_dir)


def q_text_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    from testbed.streams import text_sink
    return text_sink(spark, sf_dir, job_id("text_sink"))


# ------------------------------------------------------------------- registry

def _sql_registry() -> dict[str, str]:
    texts = f"""WITH {O.CONVERSATIONS},
tm AS (
  SELECT {O.unsigned('p_from')} AS from_node, {O.unsigned('p_to')} AS to_node,
         {O.epoch_to_ntz('p_rx_time')} AS time, p_channel AS channel,
         payload_text AS text, '{{jid}}' AS job_id
  FROM cv WHERE decoded AND portnum = 'TEXT_MESSAGE_APP')"""
    closed = "\nSELECT * FROM t WHERE window_end <= (SELECT max(timestamp) FROM ev) - INTERVAL 5 SECOND"
    node_sql = (f"WITH {O.CUSTOMERS}\nSELECT {O.unsigned('n_num')} AS node_id, "
                "n_user_id AS user_id, n_short_name AS user_name, "
                "n_long_name AS user_long_name, n_role AS user_role, "
                f"CASE WHEN n_last_heard <> 0 THEN {O.epoch_to_ntz('n_last_heard')} END "
                "AS last_heard, n_hops_away AS hops_away, n_snr AS snr FROM cu")
    all_ctx = (f"WITH {O.ALL},\nctx AS (SELECT timestamp, {O.unsigned('p_from')} AS from_node, "
               f"{O.unsigned('p_to')} AS to_node, {O.KIND} AS kind FROM allp "
               "WHERE variant = 'packet')")
    # Late delivery: kind-"" packets of week w arrive in slice w + 1; a row is
    # dropped when its window ended at or before max(event time of earlier
    # slices) - 5 s; windows are emitted up to the final watermark.
    late_sql = (f"WITH {O.EVENTS},\n"
                f"sl AS (SELECT *, CAST(floor((epoch(timestamp) - {BASE_EPOCH}) / {7 * 86400}) "
                "AS BIGINT) + CASE WHEN variant = 'packet' AND NOT encrypted "
                "AND NOT decoded THEN 1 ELSE 0 END AS slice FROM ev),\n"
                "mx AS (SELECT slice, max(timestamp) AS m FROM sl GROUP BY slice),\n"
                "wm AS (SELECT a.slice, (SELECT max(b.m) FROM mx b WHERE b.slice < a.slice) "
                "- INTERVAL 5 SECOND AS before FROM mx a),\n"
                f"ctx AS (SELECT timestamp, {O.unsigned('p_from')} AS from_node, "
                f"{O.unsigned('p_to')} AS to_node, {O.KIND} AS kind, wm.before, "
                "time_bucket(INTERVAL 10 MINUTE, timestamp) + INTERVAL 10 MINUTE AS wend "
                "FROM sl JOIN wm USING (slice) WHERE variant = 'packet'),\n"
                "kept AS (SELECT timestamp, from_node, to_node, kind FROM ctx "
                "WHERE before IS NULL OR wend > before),\n"
                "t AS (" + _traffic_sql(10, job_id("stream_traffic_late"), "kept") + ")"
                "\nSELECT * FROM t WHERE window_end <= (SELECT max(timestamp) FROM ev) "
                "- INTERVAL 5 SECOND")
    log_columns = ("AS timestamp, CAST(user_id % 4 AS INTEGER) AS part, "
                   "event_id * 2 + CASE WHEN event_type = 'error' THEN 601 ELSE 0 END AS off,")
    bodies = texts.replace("payload_text AS text,", "payload_text AS text, p_rx_time,") + (
        ", nt AS (SELECT from_node, p_rx_time, format('Message from node: ({{}}) on channel: ({{}})', "
        f"from_node, channel) AS title, 'Time: ' || {O.iso_local_text('time')} || chr(10) || 'Text: ' "
        "|| text AS message FROM tm),\nbd AS (SELECT from_node, p_rx_time, '{{' || chr(10) || "
        "'  \"title\" : ' || to_json(title) || ',' || chr(10) || '  \"message\" : ' || "
        "to_json(message) || ',' || chr(10) || '  \"priority\" : 2' || chr(10) || '}}' AS body FROM nt)\n")
    replay_lo = "TIMESTAMP '2024-01-04 22:00:00'"   # REPLAY_FROM in UTC
    replay_hi = "TIMESTAMP '2024-01-12 11:30:00'"   # REPLAY_TO in UTC
    return {
        "traffic_window": _EVENTS_CTX + _traffic_sql(10, job_id("traffic_window")),
        "traffic_window_1d": _EVENTS_CTX + _traffic_sql(1440, job_id("traffic_window_1d")),
        "node_context": _EVENTS_CTX + "\nSELECT timestamp, from_node, to_node, kind FROM ctx",
        "payload_kind": f"WITH {O.ALL}\nSELECT timestamp, p_from AS packet_from, "
                        f"{O.KIND} AS kind FROM allp WHERE variant = 'packet'",
        "replay_range": _EVENTS_CTX.replace(
            "WHERE variant = 'packet'",
            f"WHERE variant = 'packet' AND timestamp >= {replay_lo} AND timestamp < {replay_hi}")
        + _traffic_sql(REPLAY_WINDOW_MINUTES, job_id("replay_range")),
        "replay_offsets": f"WITH {O.EVENTS.replace('AS timestamp,', log_columns, 1)},\n"
        f"bd AS (SELECT part, min(off) FILTER (WHERE timestamp >= {replay_lo}) AS lo, "
        f"min(off) FILTER (WHERE timestamp >= {replay_hi}) AS hi FROM ev GROUP BY part),\n"
        f"ctx AS (SELECT timestamp, {O.unsigned('p_from')} AS from_node, "
        f"{O.unsigned('p_to')} AS to_node, {O.KIND} AS kind FROM ev JOIN bd USING (part) "
        "WHERE variant = 'packet' AND off >= lo AND (hi IS NULL OR off < hi))"
        + _traffic_sql(REPLAY_WINDOW_MINUTES, job_id("replay_offsets")),
        "stream_traffic_flushed": _EVENTS_CTX + _traffic_sql(10, job_id("stream_traffic_flushed")),
        "node_info_sink_by_batch": f"WITH one AS ({node_sql})\nSELECT *, unnest(['first', 'second']) "
                                   "AS run_id FROM one",
        "webhook_in_order": bodies.format(jid=job_id("webhook_in_order"))
        + "SELECT body, CAST(row_number() OVER (PARTITION BY from_node ORDER BY p_rx_time) AS INTEGER) "
          "AS status FROM bd",
        "webhook_statuses": bodies.format(jid=job_id("webhook_statuses"))
        + "SELECT body, CASE WHEN md5(body) < '1' THEN 0 WHEN md5(body) < '8' THEN 503 ELSE 200 END "
          "AS status FROM bd",
        "text_unknown_charset": texts.format(jid=job_id("text_unknown_charset"))
        + "\nSELECT count(*) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS n_chars, 'utf-8' AS charset "
          "FROM tm UNION ALL SELECT 0, 0, 'x-no-such-charset'",
        "text_latin1": texts.format(jid=job_id("text_latin1"))
        + "\nSELECT * REPLACE (array_to_string(list_transform(range(octet_length(encode(text))), "
          "lambda i: chr(CAST('0x' || substr(hex(encode(text)), 2 * i + 1, 2) AS INTEGER))), '') AS text) "
          "FROM tm",
        "variant_packet": f"WITH {O.ALL}\nSELECT timestamp, variant, p_from AS packet_from, "
                          "p_to AS packet_to, p_channel AS channel, encrypted, decoded, portnum "
                          "FROM allp WHERE variant = 'packet'",
        "variant_node_info": f"WITH {O.ALL}\nSELECT timestamp, variant, n_num AS num, "
                             "n_user_id AS user_id, n_role AS role, n_last_heard AS last_heard "
                             "FROM allp WHERE variant = 'node_info'",
        "variant_text": f"WITH {O.ALL}\nSELECT timestamp, p_from AS packet_from, "
                        "p_channel AS channel, p_rx_time AS rx_time FROM allp "
                        "WHERE variant = 'packet' AND decoded AND portnum = 'TEXT_MESSAGE_APP'",
        "node_info": node_sql,
        "text_messages": texts.format(jid=job_id("text_messages"))
        + "\nSELECT * FROM tm",
        "notifications": texts.format(jid=job_id("notifications"))
        + "\nSELECT format('Message from node: ({}) on channel: ({})', from_node, channel) AS title, "
          f"'Time: ' || {O.iso_local_text('time')} || chr(10) || 'Text: ' || text AS message, "
          "CAST(2 AS INTEGER) AS priority FROM tm",
        "node_info_zoned": node_sql.replace(
            O.epoch_to_ntz('n_last_heard'),
            f"timezone('{ZONE_EAST}', to_timestamp(n_last_heard))"),
        "text_messages_zoned": texts.replace(
            O.epoch_to_ntz('p_rx_time'), f"timezone('{ZONE_WEST}', to_timestamp(p_rx_time))")
        .format(jid=job_id("text_messages_zoned")) + "\nSELECT * FROM tm",
        "notification_bodies": texts.format(jid=job_id("notification_bodies"))
        + "\n, nt AS (SELECT format('Message from node: ({}) on channel: ({})', from_node, channel)"
          f" AS title, 'Time: ' || {O.iso_local_text('time')} || chr(10) || 'Text: ' || text "
          "AS message FROM tm)\n"
          "SELECT '{' || chr(10) || '  \"title\" : ' || to_json(title) || ',' || chr(10) || "
          "'  \"message\" : ' || to_json(message) || ',' || chr(10) || "
          "'  \"priority\" : 2' || chr(10) || '}' AS body FROM nt",
        "audit_lines": texts.format(jid=job_id("audit_lines"))
        + f"\nSELECT {O.iso_local_text('time')} || ' form: ' || from_node || ', chan: ' "
          "|| channel || ', text: ' || text AS line FROM tm",
        "decoded_packets": f"WITH {O.ALL}\nSELECT timestamp, variant, p_from, p_to, "
                           "p_channel, p_rx_time, encrypted, decoded, portnum, payload_text "
                           "FROM allp WHERE variant = 'packet'",
        "decoded_node_info": f"WITH {O.ALL}\nSELECT timestamp, variant, n_num, n_user_id, "
                             "n_short_name, n_long_name, n_role, n_last_heard, n_hops_away, "
                             "n_snr FROM allp WHERE variant = 'node_info'",
        "traffic_decoded": all_ctx + _traffic_sql(10, job_id("traffic_decoded")),
        "node_info_decoded": f"WITH {O.ALL}\nSELECT {O.unsigned('n_num')} AS node_id, "
                             "n_user_id AS user_id, n_short_name AS user_name, "
                             "n_long_name AS user_long_name, n_role AS user_role, "
                             f"CASE WHEN n_last_heard <> 0 THEN {O.epoch_to_ntz('n_last_heard')} "
                             "END AS last_heard, n_hops_away AS hops_away, n_snr AS snr "
                             "FROM allp WHERE variant = 'node_info'",
        "text_decoded": f"WITH {O.ALL}\nSELECT {O.unsigned('p_from')} AS from_node, "
                        f"{O.unsigned('p_to')} AS to_node, {O.epoch_to_ntz('p_rx_time')} AS time, "
                        "p_channel AS channel, payload_text AS text, "
                        f"'{job_id('text_decoded')}' AS job_id FROM allp "
                        "WHERE variant = 'packet' AND decoded AND portnum = 'TEXT_MESSAGE_APP'",
        "stream_traffic": _EVENTS_CTX + ", t AS (" + _traffic_sql(10, job_id("stream_traffic"))
        + ")" + closed,
        "stream_traffic_restarts": _EVENTS_CTX + ", t AS ("
        + _traffic_sql(10, job_id("stream_traffic_restarts")) + ")" + closed,
        "stream_traffic_late": late_sql,
        "traffic_sink": _EVENTS_CTX + ", t AS (" + _traffic_sql(10, job_id("traffic_sink"))
        + ")" + closed,
        "traffic_replay_twice": _EVENTS_CTX + _traffic_sql(10, job_id("traffic_replay_twice")),
        "text_replay_twice": texts.format(jid=job_id("text_replay_twice"))
        + "\nSELECT from_node, to_node, channel, time, text, job_id FROM tm",
        "text_sink_zoned": texts.replace(
            O.epoch_to_ntz('p_rx_time'), f"timezone('{ZONE_WEST}', to_timestamp(p_rx_time))")
        .format(jid=job_id("text_sink_zoned"))
        + "\nSELECT from_node, to_node, channel, time, text, job_id FROM tm",
        "audit_sink": texts.format(jid=job_id("audit_sink"))
        + f"\nSELECT {O.iso_local_text('time')} || ' form: ' || from_node || ', chan: ' "
          "|| channel || ', text: ' || text AS line FROM tm",
        "node_info_sink": node_sql,
        "text_sink": texts.format(jid=job_id("text_sink"))
        + "\nSELECT from_node, to_node, channel, time, text, job_id FROM tm",
    }


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "traffic_window": q_traffic_window,
    "traffic_window_1d": q_traffic_window_1d,
    "node_context": q_node_context,
    "payload_kind": q_payload_kind,
    "replay_range": q_replay_range,
    "replay_offsets": q_replay_offsets,
    "variant_packet": q_variant_packet,
    "variant_node_info": q_variant_node_info,
    "variant_text": q_variant_text,
    "node_info": q_node_info,
    "node_info_zoned": q_node_info_zoned,
    "text_messages": q_text_messages,
    "text_messages_zoned": q_text_messages_zoned,
    "notifications": q_notifications,
    "notification_bodies": q_notification_bodies,
    "audit_lines": q_audit_lines,
    "decoded_packets": q_decoded_packets,
    "decoded_node_info": q_decoded_node_info,
    "traffic_decoded": q_traffic_decoded,
    "node_info_decoded": q_node_info_decoded,
    "text_decoded": q_text_decoded,
    "stream_traffic": q_stream_traffic,
    "stream_traffic_restarts": q_stream_traffic_restarts,
    "stream_traffic_late": q_stream_traffic_late,
    "traffic_sink": q_traffic_sink,
    "traffic_replay_twice": q_traffic_replay_twice,
    "text_replay_twice": q_text_replay_twice,
    "audit_sink": q_audit_sink,
    "text_sink_zoned": q_text_sink_zoned,
    "node_info_sink": q_node_info_sink,
    "text_sink": q_text_sink,
    "stream_traffic_flushed": q_stream_traffic_flushed,
    "node_info_sink_by_batch": q_node_info_sink_by_batch,
    "webhook_in_order": q_webhook_in_order,
    "webhook_statuses": q_webhook_statuses,
    "text_unknown_charset": q_text_unknown_charset,
    "text_latin1": q_text_latin1,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return _sql_registry()
