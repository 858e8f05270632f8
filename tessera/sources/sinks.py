"""JSON-lines sinks and run reports."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Files, materialised


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """UTF-8 JSON lines in parallel files; nulls are kept."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_routed(df: DataFrame, paths: dict[str, str], kind: str = "kind") -> None:
    """The rows of each value of ``kind`` to its own path; rows are worked out once, whatever the number of paths."""
    rows = materialised(df.where(F.col(kind).isin([*paths])), "routed")
    for value, path in paths.items():
        write_jsonl(rows.where(F.col(kind) == value).drop(kind), path)


def write_pair(df: DataFrame, left: list[str], right: list[str], paths: tuple[str, str], order: str = "id") -> None:
    """Two projections of the same rows, both sorted by one key, so that line k of both belongs together."""
    ordered = df.orderBy(order)
    for columns, path in ((left, paths[0]), (right, paths[1])):
        write_jsonl(ordered.select(*columns), path)


def write_report(report: DataFrame | dict, path: str) -> dict:
    """A one-row aggregate (or a dict) as pretty JSON, on the file system that the path names; the dict is returned. Keys with nulls are left out."""
    found = report if isinstance(report, dict) else next((r.asDict(recursive=True) for r in report.limit(1).collect()), {})
    found = {k: v for k, v in found.items() if v is not None}
    Files(SparkSession.active(), path).write(path, json.dumps(found, ensure_ascii=False, indent=2, sort_keys=True, default=str))
    return found


def merge_report(new: dict, path: str) -> dict:
    """The report's old keys stay unless they are new; an old file that isn't a JSON object is noted."""
    old: dict = {}
    files = Files(SparkSession.active(), path)
    if files.exists(path):
        try:
            old = json.loads(files.read(path))
            if not isinstance(old, dict):
                raise ValueError
        except ValueError:
            old = {"previous_report_unreadable": True}
    return write_report(old | new, path)


def rewrite(df: DataFrame, path: str, backup: str | None = None) -> None:
    """Replace a JSON-lines folder that ``df`` may read: written beside it, then renamed; the first original is kept as backup and never overwritten."""
    path = path.rstrip("/")
    files, staged = Files(df.sparkSession, path), f"{path}.staged-{time.time_ns()}"
    write_jsonl(df, staged)
    if files.exists(path):
        if backup and not files.exists(backup):
            files.rename(path, backup)
        else:
            files.remove(path)
    files.rename(staged, path)
