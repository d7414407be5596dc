"""One query for each operator of the inventory, and its SQL for comparison."""

from __future__ import annotations

import importlib

from loomwright.queries.base import QUERIES, SQL

for _name in ("scalars", "relational", "ranked", "plans", "nested", "tables", "streams"):
    importlib.import_module(f"loomwright.queries.{_name}")

__all__ = ["QUERIES", "SQL"]
