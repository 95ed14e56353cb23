"""Path expressions.  Paths are relative to the repository root, with no
leading or trailing slash; the root itself is the empty string."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def depth(path: Column) -> Column:
    return F.when(path == "", F.lit(0)).otherwise(F.size(F.split(path, "/")))


def parent(path: Column) -> Column:
    return F.when(F.instr(path, "/") > 0, F.regexp_extract(path, r"^(.*)/[^/]*$", 1)) \
        .otherwise(F.when(path == "", F.lit(None)).otherwise(F.lit("")))


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def ancestors(path: Column, include_self: bool = False) -> Column:
    """Non-root prefixes of ``path`` on ``/`` boundaries, shortest first."""
    parts = F.split(path, "/")
    n = F.size(parts) if include_self else F.size(parts) - 1
    return F.when((path == "") | (n < 1), F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(parts, 1, i), "/")))

