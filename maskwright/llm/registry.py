"""The queries of this subpackage, one per operator, with production parameters."""

from __future__ import annotations

from maskwright.llm import queries, sql

QUERIES = {name: fn for name, fn in vars(queries).items() if name.startswith("op") and callable(fn)}
ORACLES = dict(sql.ORACLES)
