"""Command-line entry points (``spark-submit -m``-style or ``python -m skyfold``).

    python -m skyfold run --input <docs> --store <root> [--mode quarantine] [--multiline]
    python -m skyfold report --store <root> --out <folder> [--city NAME]

``run`` applies one batch of documents to the store; ``report`` writes the
dashboard's answers (tiles, extremes, range series and details, the stats
table), each whole, as CSV folders under ``--out``. An existing Spark session (spark-submit) is used as is.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from .session import build_session
    return build_session()


def _run(args) -> None:
    from .plans.pipeline import run
    r = run(_session(), args.input, args.store, mode=args.mode, multiline=args.multiline,
            on_duplicate=args.on_duplicate, fmt=args.format, layout=args.layout)
    print(f"records={r.records} rejected={r.rejected} version={r.version}")


def _report(args) -> None:
    from .operators import insights as I
    from .sources.snapshots import SnapshotStore, write_csv
    store = SnapshotStore(_session(), args.store, args.format)
    merged, stats, location = store.read("merged"), store.read("stats"), store.read("location")
    if merged is None:
        raise SystemExit(f"no committed tables under {args.store}")
    answers = {
        "current_vs_forecast": I.current_vs_forecast(merged), "hottest": I.hottest_current(merged),
        "coldest": I.coldest_current(merged), "highest_forecast": I.highest_forecast(merged),
        "lowest_forecast": I.lowest_forecast(merged), "places": I.place_names(location),
        "range": I.city_range(merged, args.city), "detail": I.city_detail(merged, stats, args.city),
        "stats": I.stats_table(stats),
    }
    for name, df in answers.items():
        write_csv(df, f"{args.out.rstrip('/')}/{name}", mode="overwrite")
        print(f"{name}: {args.out.rstrip('/')}/{name}")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="skyfold", description=__doc__.split("\n\n")[0])
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("run", "report"):
        s = sub.add_parser(name)
        s.add_argument("--store", required=True, help="root folder of the tables")
        s.add_argument("--format", choices=["parquet", "csv"], default="parquet")
        if name == "run":
            s.add_argument("--input", required=True, help="document file(s) or folder")
            s.add_argument("--mode", choices=["fail", "quarantine"], default="fail")
            s.add_argument("--layout", choices=["by_day", "versioned"], default="by_day")
            s.add_argument("--multiline", action="store_true", default=None, help="one document per file")
            s.add_argument("--on-duplicate", choices=["last", "error", "multiply"], default="last")
        else:
            s.add_argument("--out", required=True, help="folder of the answers")
            s.add_argument("--city", help="only this place's range series and detail")
    args = p.parse_args(argv)
    (_run if args.command == "run" else _report)(args)


if __name__ == "__main__":
    main()
