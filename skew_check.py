"""Local skew diagnostic for similar_pairs (not a registered query).

Usage: python skew_check.py SF_DIR BLOCK_SIZE
Takes the written base table of SF_DIR, gives a third of its rows one shared
tag instead of their own (those rows are then pairwise identical, so their
pairs are real output), runs similar_pairs and reports, from the Spark event
log, the task times of the heaviest stage (the prefix self-join).  Compare a
normal block size with a huge one (no salting).  Local only: the event log
goes to a fresh local temp folder.
"""
import glob
import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

evdir = tempfile.mkdtemp(prefix="skew-eventlog-")
spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "64")
         .config("spark.sql.autoBroadcastJoinThreshold", "-1")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.compress", "false")
         .config("spark.eventLog.dir", evdir).getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
from cohortkit.operators.similarity import similar_pairs  # noqa: E402
from cohortkit.plans.queries import _written_base  # noqa: E402

block = int(sys.argv[2])
base = _written_base(spark, sys.argv[1])
hot = F.pmod(F.col("id"), F.lit(3)) == 0   # a third of all rows
skewed = base.withColumn("tags", F.when(hot, F.array(F.struct(F.lit("HOT").alias("tag"), F.lit(False).alias("hidden")))).otherwise(F.col("tags")))
t = time.time()
n = similar_pairs(skewed, 0.75, block_size=block).agg(F.count(F.lit(1))).first()[0]
el = time.time() - t
spark.stop()
tasks = {}
fs = [x for x in glob.glob(evdir + "/**/*", recursive=True) if os.path.isfile(x)]
for line in (l for x in fs for l in open(x)):
    e = json.loads(line)
    if e["Event"] == "SparkListenerTaskEnd":
        ti = e["Task Info"]
        tasks.setdefault(e["Stage ID"], []).append(ti["Finish Time"] - ti["Launch Time"])
# the stage with the largest total task time is the self-join
sid, durs = max(tasks.items(), key=lambda kv: sum(kv[1]))
durs.sort()
print(json.dumps({"block_size": block, "pairs": n, "seconds": round(el, 1), "join_stage_tasks": len(durs),
                  "max_task_ms": durs[-1], "median_task_ms": durs[len(durs) // 2], "total_task_ms": sum(durs)}))
