"""Materialised layers: build a table once per input version, then read it.

A layer (raw, staging, a mart) is written as parquet under the shared
checkpoint folder (``spark.checkpoint.dir``), keyed by a fingerprint of its
inputs and of this package's code. Later reads of the same layer scan the
written table instead of recomputing its lineage, and a lost executor never
forces a rebuild from the sources: this is the written-table form of a lineage
cut.

Each build writes to a folder of its own and then adds a marker; readers take
the first marker, so a half-written table is never read and builders that race
do not disturb one another.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import strata
from strata.session import shared_dir
from strata.sources.storage import add_marker, delete, file_system, names

DONE = "_done"


@cache
def code_version() -> str:
    """Hash of the modules that layers are built by, so a layer never outlives its code."""
    root = Path(strata.__file__).parent
    h = hashlib.sha1()
    for part in ("functions", "operators", "plans", "sources"):
        for f in sorted((root / part).rglob("*.py")):
            h.update(f.read_bytes())
    return h.hexdigest()


def fingerprint(spark: SparkSession, paths: list[str], extra: str = "") -> str:
    """Hash of the code and of every input's path, size, file count and modification time.

    Three calls an input, however many files it holds. A file replaced in place
    changes its folder's modification time (it is created and renamed there).
    """
    h = hashlib.sha1((code_version() + "|" + extra).encode())
    for path in sorted(paths):
        fs, p = file_system(spark, path)
        summary = fs.getContentSummary(p)
        h.update(f"{path}:{summary.getLength()}:{summary.getFileCount()}:{fs.getFileStatus(p).getModificationTime()};".encode())
    return h.hexdigest()[:16]


def materialize(spark: SparkSession, name: str, inputs: list[str], build: Callable[[], DataFrame], extra: str = "") -> DataFrame:
    """Read layer ``name`` for these inputs, writing it first when absent."""
    target = shared_dir(spark, f"layers/{name}-{fingerprint(spark, inputs, extra)}")
    done = names(spark, f"{target}/{DONE}")
    if not done:
        own = uuid.uuid4().hex
        build().write.mode("errorifexists").parquet(f"{target}/{own}")
        add_marker(spark, f"{target}/{DONE}", own, "")
        done = names(spark, f"{target}/{DONE}")
    return spark.read.parquet(f"{target}/{next(n for n in done if not n.startswith('.'))}")


def drop_layers(spark: SparkSession, name: str | None = None) -> list[str]:
    """Delete all written layers (or those of one name); returns the folders that went."""
    base = shared_dir(spark, "layers")
    gone = [n for n in names(spark, base) if name is None or n.rpartition("-")[0] == name]
    for n in gone:
        delete(spark, f"{base}/{n}")
    return gone
