"""The query catalogue: each operator on the warehouse's tables, with its answer in SQL."""

from kelda.plans import behaviour, dims, facts, maintenance, metrics, quality, streams

_MODULES = (maintenance, dims, facts, metrics, behaviour, quality, streams)

ALL_QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ALL_SQL = {name: sql for m in _MODULES for name, sql in m.SQL.items()}
