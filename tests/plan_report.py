"""Summarize the physical plans of the batch queries (markdown table).

python tests/plan_report.py [sf_dir]  -- jobs, exchanges, broadcasts, top-k, scans.
Jobs are all that the query starts once its input documents are there: size
counts, cuts, small tables, model fits, and the result.  Streaming queries are
skipped (their result is a read-back of a sink).
"""
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.plans import all_queries  # noqa: E402
from quarry.session import get_session  # noqa: E402

STREAMING = {"stream_tumbling", "stream_tumbling_append", "stream_tumbling_update", "stream_late_rows", "poll_source_stream",
             "stream_harmonic_mean", "stream_sql_view", "text_stream", "stream_sliding", "stream_text_sink"}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 16)
    spark.sparkContext.setLogLevel("ERROR")
    print("| query | jobs | shuffles | broadcasts | top-k | scans (format: columns read; pushed filters) |")
    print("|---|---|---|---|---|---|")
    for name, fn in sorted(all_queries().items()):
        if name in STREAMING:
            continue
        spark.sparkContext.setJobGroup("inputs", "inputs")
        fn(spark, sf_dir)                                         # derives the input documents
        spark.sparkContext.setJobGroup(name, name)
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()          # final adaptive plan
        plan = df._jdf.queryExecution().executedPlan().toString()
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        shuffles = len(re.findall(r"ShuffleQueryStage|Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition", plan))
        bcast = len(re.findall(r"BroadcastQueryStage|BroadcastExchange", plan))
        topk = "yes" if "TakeOrderedAndProject" in plan else ""
        scans = []
        for m in re.finditer(r"(FileScan|Scan) (\w+)[^\n]*?ReadSchema: struct<([^>]*(?:<[^>]*>)*[^>]*)>", plan):
            cols = len(re.findall(r"(?:^|,)(\w+):", m.group(3)))
            scans.append(f"{m.group(2)}: {cols}")
        pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", plan)))
        print(f"| {name} | {jobs} | {shuffles} | {bcast} | {topk} | {', '.join(scans) or '-'}"
              f"{'; ' + '; '.join(pushed) if pushed else ''} |", flush=True)


if __name__ == "__main__":
    main()
