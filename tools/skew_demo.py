"""Hot-key check: sessionize a telemetry table where ONE vehicle holds most
rows, with a plain per-key window vs the two-level (key, chunk) scan.

The hot vehicle's rows are derived from ``events`` (each event replicated
with shifted timestamps via ``explode``), so the work grows with the table.
Prints one JSON line with wall times.  Usage: python tools/skew_demo.py [sf_dir] [copies]
"""

from __future__ import annotations

import json
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from stratum.operators.ordered import time_chunk  # noqa: E402
from stratum.functions.times import micros_between  # noqa: E402
from stratum.operators.sessions import sessionize  # noqa: E402
from stratum.session import get_session  # noqa: E402

GAP = 6 * 3600
CHUNK_UNIT = "hour"


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    spark = get_session(shuffle_partitions=16)
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("user_id").alias("vehicle_id"), "event_id", "ts")
    hot = (e.select(F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("c"), "event_id", "ts")
            .select(F.lit(-1).cast("long").alias("vehicle_id"),
                    (F.col("event_id") * copies + F.col("c")).alias("event_id"),
                    (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("c"))).alias("ts")))
    df = e.unionByName(hot).repartition(16)
    n_total, n_hot = df.count(), hot.count()

    def naive():
        w = Window.partitionBy("vehicle_id").orderBy("ts", "event_id")
        prev = F.lag("ts").over(w)
        new = prev.isNull() | (micros_between(prev, F.col("ts")) > F.lit(GAP * 1_000_000))
        s = df.withColumn("start", F.when(new, F.col("ts")))
        w2 = w.rowsBetween(Window.unboundedPreceding, 0)
        return s.withColumn("trip_start", F.last("start", ignorenulls=True).over(w2))

    def two_level():
        return sessionize(df, ["vehicle_id"], "ts", "event_id", time_chunk("ts", CHUNK_UNIT), gap_seconds=GAP)

    res = {"rows": n_total, "hot_rows": n_hot, "hot_share": round(n_hot / n_total, 3)}
    for name, fn in (("plain_window", naive), ("two_level", two_level)):
        fn().write.format("noop").mode("overwrite").save()          # warm
        t0 = time.perf_counter()
        fn().write.format("noop").mode("overwrite").save()
        res[f"{name}_sec"] = round(time.perf_counter() - t0, 2)
    a = naive().groupBy("vehicle_id", "trip_start").count()
    b = two_level().groupBy("vehicle_id", "trip_start").count()
    res["same_trips"] = a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    print(json.dumps(res))


if __name__ == "__main__":
    main()
