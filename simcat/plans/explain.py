"""Print the formatted physical plan of registered queries.

Usage: python -m simcat.plans.explain [--sf DIR] name [name ...]
"""

from __future__ import annotations

import argparse


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("names", nargs="+")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    args = ap.parse_args()
    from simcat.plans.registry import load_all
    from simcat.session import get_spark
    spark = get_spark()
    qs = load_all()
    for name in args.names:
        print(f"==== {name}")
        qs[name].build(spark, args.sf).explain("formatted")


if __name__ == "__main__":
    main()
