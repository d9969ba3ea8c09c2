"""Cost of the skew-safe fragment path against the plain window, sf0.1.

python tests/bench_fragments.py [sf_dir]  -- median of 3 per variant.
"""
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from quarry.operators import windows  # noqa: E402
from quarry.session import get_session  # noqa: E402


def timed(df):
    out = []
    for _ in range(3):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        out.append(time.perf_counter() - t0)
    return round(statistics.median(out), 2)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 16)
    spark.sparkContext.setLogLevel("ERROR")
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_type", "user_id", "ts", "event_id", "value")
    n = ev.count()
    for key in ("user_id", "event_type"):
        plain = ev.withColumn("lag", F.collect_list("value").over(
            Window.partitionBy(key).orderBy("ts", "event_id").rowsBetween(-10, -1)))
        frag = windows.lag_list(ev, [key], ["ts", "event_id"], "value", 10, "lag",
                                rows_per_fragment=max(1000, n // 200))
        print(f"lag_list by {key}: plain window {timed(plain)} s, fragments {timed(frag)} s", flush=True)
    day = ev.withColumn("day", F.to_date("ts"))
    plain = day.withColumn("ra", F.avg("value").over(Window.partitionBy("event_type").orderBy("day")))
    frag = windows.running_average(day, ["event_type"], "day", "value", "ra", rows_per_fragment=3)
    print(f"running_average by event_type: plain window {timed(plain)} s, fragments {timed(frag)} s", flush=True)


if __name__ == "__main__":
    main()
