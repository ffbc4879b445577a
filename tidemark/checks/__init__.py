"""Queries over the given tables, each with SQL that must give the same rows."""

from __future__ import annotations

from tidemark.checks import catalogs, histories, migrations, rows, scalars, scripts, streams
from tidemark.checks.base import Check

ALL: dict[str, Check] = {}
for module in (migrations, histories, catalogs, rows, scalars, scripts, streams):
    for name, check in module.CHECKS.items():
        assert name not in ALL, name
        ALL[name] = check
