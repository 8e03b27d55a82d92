"""Print the formatted physical plan of registered queries.

Usage: python explain_plans.py [sf_dir] [name ...]   (default: the bench's headline queries)
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    from bench import HEADLINE
    from skyfold.plans import catalog
    from skyfold.session import build_session

    spark = build_session(master="local[4]", shuffle_partitions=4, app_name="skyfold-explain")
    qs = catalog.queries()
    for name in args or HEADLINE:
        print(f"==================== {name}")
        qs[name](spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
