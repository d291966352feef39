"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Each query runs
from the raw tables to its last row (a no-op sink takes them all), once to
warm up the session and then BENCH_RUNS times; the median counts.
"""

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from telmart.plans import registry  # noqa: E402
from telmart.session import session  # noqa: E402

HEADLINE = [
    "gender_normalize", "crm_dedupe", "crm_window_counts", "crm_clean", "device_clean",
    "crm_device_full", "subscriber_week", "subscriber_activity",
    "total_devices", "devices_by_week", "active_devices", "active_customers_by_week",
    "revenue_by_gender", "revenue_by_gender_week", "revenue_by_age", "revenue_by_age_band_week",
    "revenue_by_segment_age_week", "revenue_by_mobile_type", "revenue_by_brand",
    "revenue_by_brand_week", "revenue_by_os_vendor_week", "customers_by_os",
    "customers_by_brand_week", "revenue_range_by_brand_week", "brand_by_age_band",
    "os_by_age_band", "decode_payload", "publish_week_json", "stream_enrich", "export_marts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = session(
        f"local[{cpus}]", cpus,
        **{
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            # Few local cores and little data: keep one task per core.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="telmart-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("revenue_by_brand_week")
    seconds = {
        name: round(statistics.median(run(name) for _ in range(runs)), 3)
        for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    }
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, raw tables to result, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
