"""All registered queries and SQL twins, in inventory order."""

from __future__ import annotations

from verification.ctes import with_ctes

from . import base, boards, checks, gold, io, sql_reports

MODULES = (base, gold, sql_reports, boards, checks, io)


def queries():
    return {name: run for module in MODULES for name, run in module.QUERIES.items()}


def oracle_sql():
    # the CTEs of all modules are known by now
    return {name: with_ctes(sql) for module in MODULES for name, sql in module.SQL.items()}
