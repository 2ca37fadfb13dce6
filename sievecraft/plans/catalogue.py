"""All queries over the driver's tables, with the SQL that gives the same rows."""

from __future__ import annotations

from sievecraft.plans import golden, relational

QUERIES = golden.QUERIES | relational.QUERIES
ORACLES = golden.ORACLES | relational.ORACLES
