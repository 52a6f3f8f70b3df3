"""Run the exports of one warehouse: ``python -m whlens ENGINE LANDED OUT``
(or the same arguments after ``spark-submit whlens/__main__.py``).

Settings come from the environment as for the source jobs
(``QUERY_LOG_START``, ``QUERY_LOG_END``, ``EXPORT_METADATA``,
``COLUMN_STATS``, catalog / schema) and can be overridden by options. The
status of every export is printed; the exit code is 1 when one failed.
"""

from __future__ import annotations

import argparse
import dataclasses
import os
import sys

if not __package__:   # run as a file (spark-submit whlens/__main__.py): make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from whlens.plans.exports import KINDS, SPECS, Params, run_exports
from whlens.session import build_session, sizing_conf
from whlens.sources.files import TableSet


def main(argv: list[str] | None = None) -> int:
    engines = sorted({s.engine for s in SPECS})
    ap = argparse.ArgumentParser(prog="whlens", description="Run the exports of one warehouse on its landed system tables.")
    ap.add_argument("engine", choices=engines)
    ap.add_argument("landed", help="folder of landed system tables, one dataset per table name")
    ap.add_argument("out", help="output folder; exports go to OUT/ENGINE-logs/NAME")
    ap.add_argument("--start", help="window start YYYY-MM-DD (default $QUERY_LOG_START)")
    ap.add_argument("--end", help="window end YYYY-MM-DD (default $QUERY_LOG_END)")
    ap.add_argument("--kind", choices=KINDS, action="append", help="only metadata or only query logs")
    ap.add_argument("--format", default="parquet", help="format of the landed tables")
    ap.add_argument("--rest-pages", help="folder of landed REST history pages (Databricks fallback)")
    ap.add_argument("--executions", help="folder of landed execution batches (Athena)")
    ap.add_argument("--input-gb", type=float, help="size of the landed tables: sets split and shuffle sizes")
    ap.add_argument("--param", action="append", default=[], metavar="KEY=VALUE",
                    help="any Params field, e.g. ordered=false, events_closed=left, keep_unpriced=true")
    args = ap.parse_args(argv)

    overrides = {k: v for k, v in (("start", args.start), ("end", args.end), ("rest_pages", args.rest_pages),
                                   ("executions_path", args.executions)) if v}
    fields = {f.name: f for f in dataclasses.fields(Params)}
    for item in args.param:
        key, _, value = item.partition("=")
        if key not in fields:
            ap.error(f"unknown parameter {key!r}")
        if fields[key].type in ("bool", bool):
            overrides[key] = value.strip().lower() == "true"
        elif fields[key].type in ("int", int, "int | None"):
            overrides[key] = int(value)
        else:
            overrides[key] = value
    params = Params.from_env(**overrides)
    sizing = sizing_conf(int(args.input_gb * 1e9)) if args.input_gb else None
    spark = build_session(app_name=f"whlens-{args.engine}", extra_conf=sizing)
    tables = TableSet(spark, args.landed, fmt=args.format)
    status = run_exports(spark, args.engine, tables, args.out, params, kinds=tuple(args.kind or KINDS))
    rows = status.collect()          # one status row per export
    for r in rows:
        print(f"{r.export:32s} {r.status:15s} {'' if r.rows is None else r.rows:>12} {r.error or ''}")
    return 1 if any(r.status == "failed" for r in rows) else 0


if __name__ == "__main__":
    sys.exit(main())
