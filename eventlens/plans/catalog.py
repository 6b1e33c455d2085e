"""All registered queries and their oracles (importing the plan modules
fills the registry)."""

from __future__ import annotations

from . import arrivals, courses, hot, iot, iot_job, parsers, streams, tables_sql, udfs  # noqa: F401
from .registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {k: v for k, v in ORACLES.items() if k in QUERIES}
