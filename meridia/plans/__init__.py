"""Named queries over the driver tables."""

from __future__ import annotations

from . import files, formats, more, ranged, streams, tables, texts, times, whole  # noqa: F401
from .registry import ORACLES, QUERIES


def queries() -> dict:
    """Every query by name."""
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of those that it can express."""
    return dict(ORACLES)
