"""All queries of the operators with the DuckDB statement of each."""

from __future__ import annotations

from dimwright.plans import bindings, load_bindings, oracle

QUERIES = bindings.QUERIES | load_bindings.QUERIES
ORACLE = oracle.ORACLE | load_bindings.ORACLE
