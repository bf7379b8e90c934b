"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the
local cores. Every query runs whole, into a sink that discards rows.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import CHECKS  # noqa: E402
from ledgerstone.session import local_session  # noqa: E402

HEADLINE = (
    "dq_metrics dq_status mask_amount_band pii_scrub_text latest_by scd2_history neighbours_and_ordinal"
    " envelope_parse_cdc rules_r2_ranges rules_r6_uniqueness rules_r8_references silver_app_application"
    " silver_app_missing_document quarantine_app_missing_document dim_customer fact_application_document"
    " fact_application_timeline_event fact_application_current fact_arrangement_current fact_service_activity"
    " bridge_application_party_authority mv_application_documents fk_violations lifecycle_transition"
    " stream_dedup stream_scd2"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus=cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    CHECKS["dq_metrics"].query(spark, sf_dir).collect()  # start-up is not part of any query
    timings: dict[str, float] = {}
    for name in HEADLINE:
        started = time.perf_counter()
        CHECKS[name].query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - started, 3)
        print(name, timings[name], file=sys.stderr, flush=True)
    scale = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
