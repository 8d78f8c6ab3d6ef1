"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from donorloom.catalog import load
from donorloom.session import build_session

HEADLINE = (
    "x01_file_health_fy", "x01_file_health_r12", "x02_x03_w09_report_groups", "a13_a14_file_health_measures",
    "x06_donor_table", "w01_donor_gift_number", "x11_retention", "x12_upgrade_downgrade", "j05_priority_code_key",
    "j16_table_diff", "a15_broker_report", "a27_giving_before_mailing", "f13_keep_first", "x09_transactions",
    "x16_monthly_totals", "x20_promo_history",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    catalog = load()
    times: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            catalog[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
