"""Named queries over the given tables, each with SQL that says the same where SQL can."""

from __future__ import annotations

from . import camera, detection, evaluation, hands, ingest, series, windows

FAMILIES = (series, windows, hands, detection, camera, evaluation, ingest)


def queries() -> dict:
    return {name: fn for family in FAMILIES for name, (fn, _) in family.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for family in FAMILIES for name, (_, sql) in family.QUERIES.items() if sql}
