"""Time the registered queries; prints one JSON line.

Every query's rows are produced in full and thrown away.  The session settings are those of
``corpusforge.session``; one untimed query warms the JVM up.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpusforge import build_session  # noqa: E402
from corpusforge.catalog.queries import QUERIES  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:] or list(QUERIES)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        begun = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - begun, 3)

    run("rule_qa")
    seconds = {name: run(name) for name in chosen}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
