"""A numbered log of commits, which writers at the same time cannot lose.

Every commit is a file of its own, created only if no one else has created it, and readers take the
one of the highest number. A writer that finds its number taken either gives up or takes the next
one, so the log shows every run that ended well, in order.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tillgrain.sources.paths import children, create_text, read_text

LOG = "_commits"
_DIGITS = 12


class CommitRefused(RuntimeError):
    """Another writer committed since this one looked."""


@dataclass(frozen=True)
class Commit:
    version: int
    run: str
    seconds: float


def _place(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/{LOG}/{version:0{_DIGITS}d}"


def versions(spark: SparkSession, base: str) -> list[int]:
    """Numbers in the log, ascending."""
    return sorted(int(name) for name in children(spark, f"{base.rstrip('/')}/{LOG}") if name.isdigit())


def commit_at(spark: SparkSession, base: str, version: int) -> Commit:
    return Commit(version, **json.loads(read_text(spark, _place(base, version))))


def latest(spark: SparkSession, base: str) -> Commit | None:
    found = versions(spark, base)
    return commit_at(spark, base, found[-1]) if found else None


def commit(spark: SparkSession, base: str, run: str, seen: int, retry: bool = True) -> Commit:
    """Add ``run`` to the log as the successor of version ``seen`` (0 where there was none).

    If others committed meanwhile the run follows them, or with ``retry`` off is refused.
    """
    version = seen + 1
    while True:
        made = {"run": run, "seconds": time.time()}
        if create_text(spark, _place(base, version), json.dumps(made)):
            return Commit(version, **made)
        if not retry:
            raise CommitRefused(f"Version {version} of {base} was committed by {commit_at(spark, base, version).run}.")
        version += 1


def history(spark: SparkSession, base: str) -> DataFrame:
    """The log as rows: version, run, seconds since 1970."""
    rows = [(c.version, c.run, c.seconds) for c in (commit_at(spark, base, v) for v in versions(spark, base))]
    return spark.createDataFrame(rows, "version bigint, run string, seconds double")
