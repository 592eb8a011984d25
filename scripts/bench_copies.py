"""Times the flagship build over several copies of the line items, for a size beside bench.py's.

    python scripts/bench_copies.py [COPIES] [SF_DIR]

Each copy has order keys of its own; parts and suppliers are the same, so groups get
more rows, as more days of the same business would give. The copies are written to a
temporary folder, which the operating system clears."""

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F

from marginflow.plans.stages import Workspace
from marginflow.session import build_session


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 15
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = build_session(f"local[{cpus}]", cpus)
    out = tempfile.mkdtemp(prefix="mf-copies-")
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_copy")
    more = lines.select("*", copy).withColumn("l_orderkey", F.col("l_orderkey") + F.col("_copy").cast("long") * F.lit(10**9)).drop("_copy")
    more.repartition(cpus).write.parquet(f"{out}/lineitem.parquet")
    for name in ("part", "supplier"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{out}/{name}.parquet")
    times = []
    for _ in range(4):
        ws = Workspace(spark, out)
        began = time.time()
        rows = ws.summary().count()
        times.append(time.time() - began)
    raw = Workspace(spark, out).raw()
    n = raw["purchases"].count() + raw["sales"].count()
    steady = statistics.median(times[1:])
    print(json.dumps({"metric": "flagship build", "copies": copies, "raw_rows": n, "summary_rows": rows,
                      "cold_sec": round(times[0], 2), "steady_sec": round(steady, 2), "rows_per_sec": round(n / steady)}))
    spark.stop()


if __name__ == "__main__":
    main()
