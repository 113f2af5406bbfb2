"""Merging the folders of a file table's closed batches.

A `TableTarget` has a folder for each batch, so that a replay can replace it.
Once a run has gone on by two batches, Spark can't replay a batch any more, and
its folder can be merged with others into few files. A manifest says which
folders have been merged into which; it is a small file that is there as a
whole or not at all, so a reader sees a batch either in its own folder or
merged, never both.

Merged batches' folders stay until the next merge, for readers that have
listed them before. One merge of a table runs at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetflow.sinks.files import hadoop_path, list_names, read_text, write_text

KEEP_BATCHES = 2                   # last batches of a run, which may still be replayed
FILE_BYTES = 128 << 20             # of a merged file, about
MANIFESTS, MERGED = "_manifest", "_merged"      # hidden from plain readers of the folder


def manifest(spark: SparkSession, path: str) -> dict:
    """{number, merged: [{folder, run_id, first, last}], replaced: [folder]} as of the last merge."""
    names = [n for n in list_names(spark, f"{path}/{MANIFESTS}") if n.isdigit()]
    if not names:
        return {"number": 0, "merged": [], "replaced": []}
    return json.loads(read_text(spark, f"{path}/{MANIFESTS}/{max(names)}"))


def is_merged(state: dict, run_id: str, batch_id: int) -> bool:
    return any(m["run_id"] == run_id and m["first"] <= batch_id <= m["last"] for m in state["merged"])


def batch_ids(spark: SparkSession, path: str, run_id: str) -> list[int]:
    names = list_names(spark, f"{path}/run_id={run_id}")
    return sorted(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))


def _size(spark: SparkSession, path: str) -> int:
    p, fs = hadoop_path(spark, path)
    return fs.getContentSummary(p).getLength()


def _remove(spark: SparkSession, path: str) -> None:
    p, fs = hadoop_path(spark, path)
    fs.delete(p, True)


def merge_batches(spark: SparkSession, path: str, run_id: str, fmt: str = "parquet",
                  keep: int = KEEP_BATCHES, file_bytes: int = FILE_BYTES) -> int:
    """Merge the run's closed batches; returns how many folders became one.

    Earlier merges that are still smaller than a file are merged again with
    them, so their number grows with the data, not with the merges. The flush
    of a stream (a negative batch id) stays apart, since it may be repeated.
    """
    state = manifest(spark, path)
    for folder in state["replaced"]:
        _remove(spark, f"{path}/{folder}")
    ids = [i for i in batch_ids(spark, path, run_id) if i >= 0]
    closed = [i for i in ids if i <= ids[-1] - keep and not is_merged(state, run_id, i)]
    small = [m for m in state["merged"]
             if m["run_id"] == run_id and _size(spark, f"{path}/{m['folder']}") < file_bytes]
    if not closed:
        if state["replaced"]:
            _commit(spark, path, state, state["merged"], [])
        return 0
    folders = [f"run_id={run_id}/batch_id={i}" for i in closed] + [m["folder"] for m in small]
    size = sum(_size(spark, f"{path}/{f}") for f in folders)
    merged = f"{MERGED}/{uuid.uuid4().hex}"
    rows = _read(spark, path, fmt, [f for f in folders if not f.startswith(MERGED)],
                 [f for f in folders if f.startswith(MERGED)])
    rows.coalesce(max(1, -(-size // file_bytes))).write.format(fmt).save(f"{path}/{merged}")
    entry = {"folder": merged, "run_id": run_id, "last": closed[-1],
             "first": min([closed[0], *(m["first"] for m in small)])}
    _commit(spark, path, state, [m for m in state["merged"] if m not in small] + [entry], folders)
    return len(folders)


def _commit(spark: SparkSession, path: str, state: dict, merged: list, replaced: list) -> None:
    number = state["number"] + 1
    write_text(spark, f"{path}/{MANIFESTS}/{number:08d}",
               json.dumps({"number": number, "merged": merged, "replaced": replaced}))
    if number > 2:
        _remove(spark, f"{path}/{MANIFESTS}/{number - 2:08d}")


def _read(spark: SparkSession, path: str, fmt: str, batches: list[str], merged: list[str]) -> DataFrame | None:
    """The rows of batch folders and of merged ones, with run and batch."""
    parts = []
    if batches:
        parts.append(spark.read.format(fmt).option("basePath", path)
                     .load([f"{path}/{f}" for f in batches]))
    if merged:
        parts.append(spark.read.format(fmt).load([f"{path}/{f}" for f in merged]))
    if not parts:
        return None
    parts = [p.withColumns({"run_id": F.col("run_id").cast("string"),
                            "batch_id": F.col("batch_id").cast("long")}) for p in parts]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """All rows of the table, each once, with run and batch."""
    state = manifest(spark, path)
    if not state["number"]:
        return spark.read.format(fmt).load(path)
    runs = [n.removeprefix("run_id=") for n in list_names(spark, path) if n.startswith("run_id=")]
    batches = [f"run_id={r}/batch_id={i}" for r in runs for i in batch_ids(spark, path, r)
               if not is_merged(state, r, i)]
    return _read(spark, path, fmt, batches, [m["folder"] for m in state["merged"]])
