"""The query catalogue: importing this module registers every query.

Each ``*_queries`` module registers its queries (and DuckDB oracle SQL)
into ``registry.QUERIES`` / ``registry.ORACLE_SQL``.
"""

from __future__ import annotations

from . import (  # noqa: F401
    facility_queries, load_job_queries, load_queries, merge_queries, model_queries,
    payload_queries, poll_queries, slot_queries, streaming_queries,
)
from .registry import ORACLE_SQL, QUERIES  # noqa: F401
