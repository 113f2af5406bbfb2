"""One HTTP POST with a JSON body per text message.

Bodies are built by Spark (operators.messages.notification_json); delivery
runs inside `mapInPandas`, one request at a time per task, so the work is
spread over the cluster and nothing passes through the driver. Each row
comes back with the HTTP status (0 when the request failed): an I/O error is
logged and the stream goes on, and the status is otherwise ignored, as in the
reference. The sender is injectable so tests need no network. With a ledger
(sinks.ledger) each send is written down as it happens, and a repeated task or
batch sends only the rest.
"""

from __future__ import annotations

import http.client
import logging
import urllib.parse
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetflow.fixed import HTTP_TIMEOUT_S
from packetflow.operators.messages import notification_json
from packetflow.session import ship_package
from packetflow.sinks.batch import DEFAULT_RUN
from packetflow.sinks.ledger import Ledger, TaskRecords, not_sent

log = logging.getLogger(__name__)


Sender = Callable[[str], int]


# K2: columns that notes to be sent in order carry besides their own.
ORDER_COLUMNS = ("from_node", "record_time")


class HttpSender:
    """POST `body` as application/json to `uri`; returns the HTTP status.

    Each task keeps one connection open between messages. A redirect
    is a status like any other and is not followed. A message that takes longer
    than `timeout_s` is logged and skipped like any other failure. A message
    that meets a kept connection which the other side has closed is sent once
    more over a new one.
    """

    def __init__(self, uri: str, timeout_s: float = HTTP_TIMEOUT_S):
        if not uri:
            raise ValueError("text.http.uri is required")
        parts = urllib.parse.urlsplit(uri)
        if parts.scheme not in ("http", "https") or not parts.hostname:
            raise ValueError(f"not an http(s) address: {uri!r}")
        self.uri = uri
        self.timeout_s = timeout_s
        self.https, self.host, self.port = parts.scheme == "https", parts.hostname, parts.port
        self.path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
        self._kept = None

    def __getstate__(self):
        return self.__dict__ | {"_kept": None}      # connections stay in their process

    def connect(self):
        kind = http.client.HTTPSConnection if self.https else http.client.HTTPConnection
        return kind(self.host, self.port, timeout=self.timeout_s)

    def _post(self, body: bytes) -> int:
        try:
            self._kept.request("POST", self.path, body, {"Content-Type": "application/json"})
            with self._kept.getresponse() as response:
                response.read()                     # the connection is free again after that
                return response.status
        except BaseException:
            self._kept.close()
            self._kept = None
            raise

    def __call__(self, body: str) -> int:
        data = body.encode("utf-8")
        if self._kept is not None:
            try:
                return self._post(data)
            except (ConnectionResetError, BrokenPipeError):
                pass
        self._kept = self.connect()
        return self._post(data)


def send_notifications(notes: DataFrame, sender: Sender, tasks: int | None = None,
                       ordered: bool = False, ledger: Ledger | None = None,
                       batch_id: int = 0, run_id: str = DEFAULT_RUN) -> DataFrame:
    """(title, message, priority) rows -> (body, status) after sending each.

    Requests go one at a time per task. `tasks` spreads the bodies
    round-robin over that many tasks first (a small shuffle), so a source
    partition holding a large share of the messages does not make one task
    send them all in turn. `ordered` sends one sender's messages in the order
    of their record times instead (`notes` then has ORDER_COLUMNS too): its
    messages meet in one task, so a busy sender waits for itself.

    What `ledger` has of this batch isn't sent again, and isn't in the result.
    Messages are known by their body and, if ordered, by sender and record time.
    """
    order = ORDER_COLUMNS if ordered else ()
    bodies = notification_json(notes, order)
    bodies = bodies.withColumn("key", F.sha2(F.concat_ws(
        "\n", *(F.col(c).cast("string") for c in order), "body"), 256))
    folder, every = None, 1
    if ledger is not None:
        bodies = not_sent(bodies, ledger.sent(notes.sparkSession, batch_id, run_id))
        folder, every = ledger.attempt(batch_id, run_id), ledger.record_every
    if ordered:
        bodies = bodies.repartition(*([int(tasks)] if tasks else []), "from_node")
        bodies = bodies.sortWithinPartitions("record_time", "from_node")
    elif tasks:
        # By key: an attempt of a task finds what an earlier attempt of the same task has sent.
        bodies = bodies.repartition(int(tasks), *(["key"] if ledger else []))
    ship_package(notes.sparkSession)

    def post(body: str) -> int:
        try:
            return int(sender(body))
        except (OSError, http.client.HTTPException) as exc:
            log.error("webhook message not delivered: %s", exc)
            return 0

    def deliver(batches):
        records = TaskRecords(folder, every) if folder else None
        try:
            for pdf in batches:
                sent = []
                for key, body in zip(pdf["key"], pdf["body"]):
                    if records and records.sent_before(key):
                        continue
                    sent.append((body, post(body)))
                    if records:
                        records.add(key, sent[-1][1])
                yield pd.DataFrame(sent, columns=["body", "status"]).astype({"status": "int32"})
        finally:
            if records:
                records.flush()

    return bodies.select("key", "body").mapInPandas(deliver, "body string, status int")


def deliver_batch(notes: DataFrame, sender: Sender, tasks: int | None = None,
                  ordered: bool = False, ledger: Ledger | None = None, batch_id: int = 0,
                  run_id: str = DEFAULT_RUN) -> tuple[int, int]:
    """Send a micro-batch; returns (messages, failed) counted on the executors."""
    row = (send_notifications(notes, sender, tasks, ordered, ledger, batch_id, run_id)
           .agg(F.count(F.lit(1)).alias("n"),
                F.coalesce(F.sum((F.col("status") == 0).cast("int")), F.lit(0)).alias("failed"))
           .first())
    return int(row["n"]), int(row["failed"])
