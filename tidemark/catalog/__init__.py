"""Registry of named queries: each binds a plan to the driver's tables and, where
SQL can say the same, carries the SQL to check it against."""

from tidemark.catalog.registry import QUERIES, oracle_sql, queries  # noqa: F401

from tidemark.catalog import (  # noqa: F401  isort: skip
    relational,
    ranking,
    trips,
    races,
    logs,
    marts,
    survivors,
    flights,
    rentals,
    staff,
    ingest,
    quality,
    streams,
)
