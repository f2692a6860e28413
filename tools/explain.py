"""Print the physical plan of a registered query, before and after execution.

    python tools/explain.py kpi_rollup [/root/testdata/sf0.01]

After execution the adaptive plan shows the runtime choices (broadcast conversions, coalesced
or split partitions, reused exchanges).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    name = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.01"
    from strata.plans import driver
    from strata.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8)
    df = driver.QUERIES[name](spark, sf_dir)
    df.explain("formatted")
    df.collect()
    print("== after execution ==")
    print(df._jdf.queryExecution().executedPlan().toString())  # noqa: SLF001 - plan text only


if __name__ == "__main__":
    main()
