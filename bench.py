"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from rasterloom.plans import catalog  # noqa: E402
from rasterloom.session import builder  # noqa: E402

HEADLINE = (
    "channel_stats", "channel_stats_by_product", "two_level_stats_merge", "month_histogram", "class_percentages", "split_train_val", "sar_scale_classify",
    "standardize_bands", "resample_area_weighted", "gaussian_smooth", "gradient_bdvf", "local_variance", "otsu_threshold", "valid_windows", "land_mask_table",
    "region_stats", "region_adjacency", "best_merge", "gmm_mstep", "unary_argmin", "em_step", "glcm_measures", "unlike_pairs", "irgs_tile",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parent}:{os.environ.get('PYTHONPATH', '')}"
    spark = (
        builder("bench", f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    held = catalog.queries()
    times: dict[str, float] = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(2):  # the first run compiles code
            start = time.perf_counter()
            held[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        times[name] = round(best, 3)
    spark.stop()
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": Path(sf_dir).name}))


if __name__ == "__main__":
    main()
