"""The queries of the library over the driver's tables, with their SQL twins."""

from __future__ import annotations

from .bar_queries import BAR_QUERIES
from .event_queries import EVENT_QUERIES
from .stream_queries import STREAM_QUERIES

_ALL = BAR_QUERIES | EVENT_QUERIES | STREAM_QUERIES

QUERIES = {name: query for name, (query, _) in _ALL.items()}
ORACLE_SQL = {name: sql for name, (_, sql) in _ALL.items() if sql}
