"""Every operator bound to the star-schema test tables, with the same query in SQL.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame, ``ORACLES[name]`` is the
SQL another engine can run over the same tables.
"""

from tierflow.bindings import gold, incremental, landing, responses, shaping

_MODULES = (incremental, shaping, gold, responses, landing)
QUERIES = {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
