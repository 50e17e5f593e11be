"""Print the physical plans of registered queries.

Usage: python tools/show_plans.py [--at-scale] [sf_dir] query [query ...]

``--at-scale`` lowers the rows-per-bucket limit so the small test data takes the bucketed
path that large inputs take, which shows the plan shape used at scale.
"""

from __future__ import annotations

import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])


def main() -> None:
    args = sys.argv[1:]
    at_scale = "--at-scale" in args
    args = [a for a in args if a != "--at-scale"]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    from staylens.operators import ordered
    from staylens.plans.registry import REGISTRY
    from staylens.session import build_session

    if at_scale:
        ordered.ROWS_PER_BUCKET = 500
    spark = build_session("local[4]", shuffle_partitions=4)
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        print(f"===== {name} {'(bucketed path)' if at_scale else ''} =====")
        REGISTRY[name](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
