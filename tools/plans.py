"""Print the formatted physical plan of registered queries.

usage: python tools/plans.py SF_DIR [--final] [name ...]

``--final`` runs each query first (noop sink) so the adaptive plan shown is
the final one (broadcasts, coalesced partitions and reused exchanges that
AQE chose at run time).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from farebox import catalog  # noqa: E402
from farebox.session import get_spark  # noqa: E402


def main():
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args else "/root/testdata/sf0.01"
    final = "--final" in args
    names = [a for a in args if a != "--final"] or list(catalog.queries())
    spark = get_spark("local[8]", shuffle_partitions=8)
    qs = catalog.queries()
    for name in names:
        df = qs[name](spark, sf_dir)
        if final:
            df.write.format("noop").mode("overwrite").save()
        print(f"==================== {name}")
        df.explain("formatted")


if __name__ == "__main__":
    main()
