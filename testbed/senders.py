"""Senders that answer without a network, by rules that SQL can repeat."""

from __future__ import annotations

import hashlib
import json
import sys
from collections import Counter

from pyspark import cloudpickle

# Python workers get these with the task; this package isn't installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Places:
    """Answers with the message's place among those that this task has sent for the same node."""

    def __init__(self):
        self.met: Counter[str] = Counter()

    def __call__(self, body: str) -> int:
        node = json.loads(body)["title"].split("(")[1].split(")")[0]
        self.met[node] += 1
        return self.met[node]


def answered(body: str) -> int:
    """One message in sixteen meets no server, seven meet a busy one."""
    digest = hashlib.md5(body.encode()).hexdigest()
    if digest < "1":
        raise OSError("no answer")
    return 503 if digest < "8" else 200
