"""All queries of the core library with their SQL."""

from corpusloom.plans import incremental, reference_queries

_MODULES = (incremental, reference_queries)
QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
SQL = {name: sql for m in _MODULES for name, sql in m.SQL.items()}
