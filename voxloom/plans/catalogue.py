"""Every query on the driver tables, with its SQL where SQL can express it."""

from __future__ import annotations

from . import curation, live, logs, spectra, texts, voices

_MODULES = (curation, texts, voices, spectra, logs, live)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE_SQL = {name: sql for module in _MODULES for name, sql in module.SQL.items()}
