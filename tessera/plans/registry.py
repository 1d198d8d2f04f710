"""Every query of the library by name, and the SQL they are held against."""

from __future__ import annotations

from tessera.plans import cases, catalog, flows, sites

QUERIES = catalog.QUERIES | cases.QUERIES | flows.QUERIES | sites.QUERIES
ORACLE_SQL = catalog.ORACLE_SQL | cases.ORACLE_SQL | flows.ORACLE_SQL | sites.ORACLE_SQL
