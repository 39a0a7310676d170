"""Command line: ``python -m tidegauge.plans.cli status|migrate|rollback|query|list``.

Migrations are JSON lists of changes: kind, table, column, before, after.
"""

from __future__ import annotations

import argparse
import json
from datetime import datetime
from pathlib import Path

from tidegauge.operators.catalog import Change, Registry
from tidegauge.plans import registry
from tidegauge.session import get_session


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidegauge")
    sub = p.add_subparsers(dest="what", required=True)
    for name in ("status", "migrate", "rollback"):
        q = sub.add_parser(name)
        q.add_argument("registry")
        if name != "status":
            q.add_argument("--dry-run", action="store_true")
        if name == "migrate":
            q.add_argument("changes", type=Path)
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("tables")
    sub.add_parser("list")
    a = p.parse_args(args)
    if a.what == "list":
        print(*sorted(registry.queries()), sep="\n")
        return 0
    spark = get_session("tidegauge")
    if a.what == "query":
        registry.queries()[a.name](spark, a.tables).show(50, truncate=False)
        return 0
    r = Registry(spark, a.registry)
    if a.what == "status":
        r.status().show(truncate=False)
        print("version", r.version())
        return 0
    if a.what == "migrate":
        done = r.migrate([Change(**c) for c in json.loads(a.changes.read_text())], datetime.now(), a.dry_run)
    else:
        done = r.rollback(datetime.now(), a.dry_run)
    for c in done:
        print(c.kind, f"{c.table}.{c.column}", c.before, "->", c.after)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
