"""All block queries, and the SQL that each is held against."""

from . import chunk_oracles, chunk_queries, oracles, queries  # noqa: F401  chunk_queries registers its own

QUERIES = queries.QUERIES
ORACLES = oracles.ORACLES | chunk_oracles.ORACLES
