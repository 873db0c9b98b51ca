"""Print the physical plan of registered queries (formatted, before execution).

Usage: python tools/explain.py [sf_dir] [key ...]
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    from patrolspark.catalog import QUERIES
    from patrolspark.session import get_session
    spark = get_session("local[8]", conf={"spark.sql.shuffle.partitions": "16"})
    spark.sparkContext.setLogLevel("ERROR")
    for k in keys or list(QUERIES):
        print(f"===== {k}")
        QUERIES[k](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
