"""The registered queries and their SQL twins."""

from threadloom.plans import bundles, curation, posts, reports, search, segments, stores, streams, texts, threads

_PARTS = [posts, curation, threads, segments, search, texts, streams, reports, stores, bundles]
QUERIES = {k: f for p in _PARTS for k, f in p.QUERIES.items()}
ORACLE_SQL = {k: s for p in _PARTS for k, s in p.ORACLE_SQL.items()}
