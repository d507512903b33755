"""Times every query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

A time covers everything the query does, its staged tables included, and the evaluation
of all result rows and columns. One untimed query starts the session first.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from rollbook.queries import REGISTRY  # noqa: E402
from rollbook.session import local_session  # noqa: E402


def timed(spark, query, folder: str) -> float:
    started = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or list(REGISTRY)
    spark = local_session()
    timed(spark, REGISTRY["q_golden"], folder)
    seconds = {name: timed(spark, REGISTRY[name], folder) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
