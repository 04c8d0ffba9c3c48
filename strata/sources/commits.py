"""Numbered logs: the place where writers that run at the same time meet.

A log is a folder of small entries, 000000001.json, 000000002.json, ... An entry
is written once and complete, and of several writers of a number exactly one
succeeds. A writer reads the log, prepares its data beside it in a folder that
nobody else names, and then asks for the next number. A writer that comes too late
takes its data away and prepares it anew from the log as it is now, so what an
entry says is always true of all entries before it. Data that no entry names
(of a crash, of a writer that lost) is never read.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import SparkSession

from strata.sources.storage import add_marker, names, read_marker

#: How often a writer prepares its data anew before it gives up.
ATTEMPTS = 20
#: Entries that the driver opens itself; more are read by a job.
FEW = 200


class Conflict(Exception):
    """Another writer has taken the number."""


def read_log(spark: SparkSession, folder: str) -> list[dict]:
    """All entries by number; each holds its ``number``."""
    # Names with a leading dot are entries that are being written.
    found = [n for n in names(spark, folder) if n.endswith(".json") and not n.startswith(".")]
    if len(found) <= FEW:
        texts = [read_marker(spark, f"{folder}/{n}") for n in found]
    else:
        texts = [r[0] for r in spark.read.text([f"{folder}/{n}" for n in found], wholetext=True).collect()]
    return sorted(map(json.loads, texts), key=lambda e: e["number"])


def add_entry(spark: SparkSession, folder: str, number: int, entry: dict) -> dict:
    """Write entry ``number``; raises Conflict when it is there already."""
    entry = {"number": number, **entry}
    try:
        add_marker(spark, folder, f"{number:09d}.json", json.dumps(entry))
    except FileExistsError as exc:
        raise Conflict(f"{folder}: entry {number} is taken") from exc
    return entry


def commit(spark: SparkSession, folder: str, prepare: Callable[[list[dict]], tuple[dict, Callable[[], None]] | None]) -> dict | None:
    """Add what ``prepare`` makes of the log as its next entry; returns the entry.

    ``prepare`` gets all entries and returns an entry and a function that takes
    back what it has written for it, or None when there is nothing to add. It is
    called again, after that function, each time another writer comes first.
    """
    for _ in range(ATTEMPTS):
        entries = read_log(spark, folder)
        made = prepare(entries)
        if made is None:
            return None
        entry, undo = made
        try:
            return add_entry(spark, folder, len(entries) + 1, entry)
        except Conflict:
            undo()
    raise Conflict(f"{folder}: other writers came first {ATTEMPTS} times")
