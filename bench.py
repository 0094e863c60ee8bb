"""Times the registered queries; prints one JSON line.

Settings: BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS and BENCH_QUERIES (comma-separated names).
Every query runs into a sink that drops the rows, so all of its columns are computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hilvan import build_session, catalog  # noqa: E402

# One or two per family; BENCH_QUERIES=all runs everything.
HEADLINE = (
    "event_condense", "service_match", "full_outer_sync", "membership_labels", "snapshot_diff",
    "snapshot_summary", "majority_outliers", "pooled_majority", "duplicate_keys", "similar_names",
    "sequence_gaps", "sequence_dups", "state_sequence", "carry_forward", "version_asof",
    "whitespace_audit", "charset_audit", "key_value_extract", "port_text", "rules_port_values",
    "rules_cables", "error_priority", "bulk_update_table", "bulk_merge_ledger", "bulk_delete_ledger",
    "upsert", "find_by_name", "port_match_cables", "port_match_rings", "trace_elements",
    "audit_cable_trunks", "audit_splice_sequences", "audit_ports", "inventory_stats",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    spark = build_session(
        "bench", f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
        conf={"spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g")},
    )
    every = catalog.queries()
    names = list(every) if chosen == "all" else [n for n in (chosen.split(",") if chosen else HEADLINE) if n]
    # The first query would otherwise pay for starting the engine.
    every["snapshot_summary"](spark, sf_dir).collect()
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            every[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total seconds of registered queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
