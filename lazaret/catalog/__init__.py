"""The queries the repository is checked with, each with the SQL that gives the same rows.

A module per theme; each has ``QUERIES`` and ``ORACLES``. A query takes the session and the folder
of the test tables and runs over whole tables.
"""

from lazaret.catalog import files, loops, monitoring, records, streams, validation

_MODULES = (validation, records, loops, files, streams, monitoring)

QUERIES = {name: q for m in _MODULES for name, q in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
