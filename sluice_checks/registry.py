"""All registered queries and the SQL that gives the same rows."""

from __future__ import annotations

from sluice_checks import durable, kinds, oracle, queries

QUERIES = queries.QUERIES | kinds.QUERIES | durable.QUERIES
ORACLE = oracle.ORACLE | kinds.ORACLE | durable.ORACLE
