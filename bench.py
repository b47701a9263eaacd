"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  folder with the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_ONLY    comma-separated query names instead of the headline set
"""

from __future__ import annotations

import json
import os
import time

from pelagia.session import local_session
from workload.queries import QUERIES

HEADLINE = (
    "nrs_derived_indices_data",
    "cpr_derived_indices_data",
    "combined_bgc_data",
    "nrs_depth_binned_ctd_data",
    "bgc_phytoplankton_abundance_genus_data",
    "bgc_phytoplankton_biovolume_species_data",
    "bgc_zooplankton_abundance_copepods_data",
    "cpr_phytoplankton_abundance_htg_data",
    "cpr_zooplankton_abundance_raw_data",
    "bgc_larval_fish_count_raw_data",
    "nearest_match",
    "band_join_pairs",
    "share_of_total",
    "count_distinct_filtered",
    "first_per_group",
    "gap_fill_rows",
    "index_upsert",
    "dq_report",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    partitions = int(cpus) if cpus.isdigit() else 8
    spark = local_session(cpus, partitions, os.environ.get("BENCH_MEMORY", "12g"))

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("group_sum")  # starts the executors; not counted
    seconds = {name: run(name) for name in (only or HEADLINE)}
    print(
        json.dumps(
            {
                "metric": "total wall-clock of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )


if __name__ == "__main__":
    main()
