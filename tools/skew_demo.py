"""Skew experiment: one user holds a third of 3M events spread over 30 days.

Runs the sessioniser with time buckets of an hour and of a year (that is, one
window per user), and reports the largest group a single window task must hold
in each case.
usage: python tools/skew_demo.py [n_events]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from shopframe.plans.retail import sessionize  # noqa: E402
from shopframe.session import build_session  # noqa: E402


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    spark = build_session("local[8]", "skew", 64, {"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    base = spark.range(n).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50000 + 1).alias("uid"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(
            secs=(F.col("id") * 7919 % (30 * 86400)).cast("int"))).alias("ts"))

    def run(df):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    largest = {b: base.groupBy("uid", F.date_trunc(b, "ts")).count().agg(F.max("count")).first()[0] for b in ("hour", "year")}
    took = {b: run(sessionize(base, bucket=b)) for b in largest}
    for b in largest:
        print(f"events={n}, buckets of one {b}: largest group {largest[b]}, {took[b]:.1f}s")
    spark.stop()


if __name__ == "__main__":
    main()
