"""Time the pipeline on raw CSV near the reference's stated input size.

The raw rows derived from the test tables are repeated ``copies`` times
(``explode(sequence(1, copies))``) and written once as CSV; the timed part
reads that CSV like any raw input. Duplicated rows are kept, as the
pipeline keeps duplicates.

usage: python tools/scale_check.py [sf_dir] [copies] [cpus]
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from chartwise.operators.clean import funnel  # noqa: E402
from chartwise.plans.runner import run_job  # noqa: E402
from chartwise.session import build_session, scratch_path  # noqa: E402
from chartwise.sources.csv import read_raw_csv, write_raw_csv  # noqa: E402
from chartwise.sources.fixtures import FIXTURE_CONFIG as CFG  # noqa: E402
from chartwise.sources.fixtures import raw_charts  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 40
    cpus = int(sys.argv[3]) if len(sys.argv) > 3 else 8
    spark = build_session(f"local[{cpus}]", "chartwise-scale", shuffle_partitions=4 * cpus,
                          extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="scale-", dir="/tmp"),
                                 "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="wh-", dir="/tmp"),
                                 "spark.driver.memory": "12g"})
    raw_csv = scratch_path(spark, "raw")
    t0 = time.perf_counter()
    rep = raw_charts(spark, sf).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("copy")
    write_raw_csv(rep, raw_csv)
    prep = time.perf_counter() - t0
    size = sum(os.path.getsize(os.path.join(raw_csv, f)) for f in os.listdir(raw_csv) if f.endswith(".csv"))
    out = {"raw_bytes": size, "prepare_s": round(prep, 1)}

    t0 = time.perf_counter()
    f = funnel(read_raw_csv(spark, raw_csv), CFG).first()
    out["funnel_s"] = round(time.perf_counter() - t0, 1)
    out["raw_rows"] = f.raw_rows
    for name, split in (("fused", False), ("split_files", True)):
        t0 = time.perf_counter()
        res = run_job(spark, raw_csv, scratch_path(spark, name), CFG, db=f"scale_{name}", split_files=split)
        out[f"run_{name}_s"] = round(time.perf_counter() - t0, 1)
        out[f"run_{name}_metrics"] = res.metrics
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
