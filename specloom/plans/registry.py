"""All queries of the core with their SQL."""

from __future__ import annotations

from specloom.plans import catalog, ingesting, parsing, quality, reads, training, verification

#: Modules whose queries stand in the tables of ``catalog``, each under the id of its operator.
MODULES = (catalog, quality, reads, parsing, verification, ingesting)

QUERIES = {**catalog.QUERIES, **training.QUERIES}
ORACLE = {**catalog.ORACLE, **training.ORACLE}
