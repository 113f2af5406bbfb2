"""Write PLANS.md: the physical plans of the three jobs, from raw bytes.

    python scripts/explain_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from packetflow.plans.jobs import node_info_plan, text_plan, traffic_plan  # noqa: E402
from packetflow.session import local_session, run_folder  # noqa: E402
from testbed import packets as X  # noqa: E402
from testbed.descriptors import ENVELOPE, fixture_descriptor_set  # noqa: E402
from packetflow.sources.files import parquet_packet_stream, parquet_packets  # noqa: E402
from packetflow.streaming.runner import run_to_end, start_stream  # noqa: E402

DESC = fixture_descriptor_set()


def captured(fn) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        fn()
    text = re.sub(r"#\d+L?", "", buf.getvalue())          # expression ids
    text = re.sub(r"file:/\S+", "file:…", text)           # local paths
    return text.strip()


def main(argv: list[str]) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session(8)
    folder = run_folder(spark, "plans")
    X.raw_packets(spark, sf_dir).write.parquet(f"{folder}/topic")
    raw = parquet_packets(spark, f"{folder}/topic", start="2024-01-02T00:00:00Z",
                          end="2024-01-20T00:00:00Z")
    sections = [
        ("J1 packet traffic, bounded replay (batch)",
         traffic_plan(raw, DESC, ENVELOPE, 10, "job").explain),
        ("J2 node info (batch)", node_info_plan(raw, DESC, ENVELOPE, "UTC").explain),
        ("J3 text messages (batch)", text_plan(raw, DESC, ENVELOPE, zone="UTC",
                                               job_id="job").explain),
    ]
    print("# Physical plans\n")
    print("Generated by `scripts/explain_plans.py` on `local[8]` (expression ids and "
          "paths removed).\n")
    for title, explain in sections:
        print(f"## {title}\n\n```\n{captured(lambda: explain('formatted'))}\n```\n")

    stream = traffic_plan(parquet_packet_stream(spark, f"{folder}/topic"), DESC, ENVELOPE, 10,
                          "job")
    q = run_to_end(start_stream(stream, f"{folder}/ck", "plan_stream", path=f"{folder}/out"))
    print("## J1 packet traffic, streaming (last micro-batch)\n\n```\n"
          f"{captured(q.explain)}\n```")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
