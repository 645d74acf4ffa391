"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Every query starts without the session's indexes, so building what it needs counts. A
first pass over the smallest tables next to it, where there are any, warms up the JVM
and is not timed. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import inputs  # noqa: E402
from catalog.queries import QUERIES  # noqa: E402
from lineloom.session import local_session, unstage  # noqa: E402

HEADLINE = (
    "chunk_java chunk_py chunk_sql chunk_markup chunk_merge chunk_all line_context trace_explain chunk_validate_summary "
    "embed_hash embed_batches semantic_search retrieval_context vector_search vector_search_batch graph_build graph_reach sql_group_by sql_window "
    "sql_recursive"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=2 * int(cpus) if cpus.isdigit() else 16)
    spark.sparkContext.setLogLevel("OFF")
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        for name in chosen:
            QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()
    times = {}
    for name in chosen:
        inputs.forget()
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begin, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    unstage(spark)
    spark.stop()


if __name__ == "__main__":
    main()
